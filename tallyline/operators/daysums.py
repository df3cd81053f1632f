"""R2 / D2 / A2 for many run dates in one pass over the facts.

Every measure of a period is a difference of two cumulative sums. The run
dates look these up at *points* only (each window's last day and the day before
its first), so facts are summed per account and point, those of a day counting
from the first point on or after it. An account's cumulative sums become one
row with a list, and each run date picks its two entries a window from that
list. A window's sum is the cumulative sum at its end less the one before its
start; its latest date is the running maximum at its end, if that lies inside
the window.

The number of run dates is a parameter, so the points of an account (at most
two for each window and date) are bounded whatever the facts are: a hot
account's list holds that many entries, and its facts collapsed to points
map-side. Rows are multiplied by the run dates last, behind every shuffle, sort
and join (terms join the accounts): what moves and lies on disk does not grow
with the dates.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import INVOICE_CURR_WINDOW, OTHER_WINDOW, Calendar
from ..functions.sqlexpr import lit
from .. import labels as L
from ..rules import RuleSet
from . import invoices, leads

AS_OF = "as_of"


def bounds_of(spark: SparkSession, dates: Iterable[_dt.date], windows: Callable[[Calendar], dict]) -> list[tuple]:
    """(run date, window, first day, last day) of every run date."""
    named = windows(Calendar.of("d"))
    cols = [f"{e} AS {name}_{end}" for name, pair in named.items() for end, e in zip(("lo", "hi"), pair)]
    rows = spark.createDataFrame([(d,) for d in sorted(set(dates))], "d date").selectExpr("d", *cols).collect()
    return [(r.d, name, r[f"{name}_lo"], r[f"{name}_hi"]) for r in rows for name in named]


def period_measures(rows: DataFrame, day: str, sums: dict[str, str], bounds: list[tuple], maxima: dict[str, str] = {}, keys=leads.ACCOUNT, side: DataFrame | None = None) -> DataFrame:
    """Per (account, run date): for every measure of ``sums`` its total
    ``total_<m>``, for every window ``<m>_<w>`` (sum), ``n_<m>_<w>`` (values
    that are not null), ``rows_<w>`` and ``all_rows``, and for every measure
    of ``maxima`` ``total_<m>`` and ``<m>_<w>``. ``side`` is inner-joined to
    the accounts by inn; its other columns are kept."""
    one = _dt.timedelta(days=1)
    points = sorted({p for _, _, lo, hi in bounds for p in (lo - one, hi)})
    place = {p: i for i, p in enumerate(points)}
    last = len(points)
    # the first point on or after the day; days after the last point, or none, count in the totals only
    cut = F.array(*[F.lit(p) for p in points])
    at = F.when(F.col("_day").isNull(), F.lit(last)).otherwise(F.size(F.filter(cut, lambda p: p < F.col("_day"))))
    parts = [F.count("*").alias("c_rows")]
    parts += [F.sum(F.expr(e)).alias(f"s_{m}") for m, e in sums.items()]
    parts += [F.count(F.expr(e)).alias(f"c_{m}") for m, e in sums.items()]
    parts += [F.max(F.expr(e)).alias(f"m_{m}") for m, e in maxima.items()]
    cells = rows.withColumn("_day", F.expr(day)).withColumn("_at", at).groupBy(*keys, "_at").agg(*parts)
    added = [c for c in cells.columns if c[:2] in ("s_", "c_")]
    tops = [c for c in cells.columns if c[:2] == "m_"]
    upto = Window.partitionBy(*keys).orderBy("_at")
    running = [F.sum(c).over(upto).alias(c) for c in added] + [F.max(c).over(upto).alias(c) for c in tops]
    # an entry holds for so many points, up to the next one
    holds = (F.lead("_at", 1, last).over(upto) - F.col("_at")).alias("_holds")
    entry = F.struct("_at", "_holds", *added, *tops)
    accounts = cells.select(*keys, "_at", holds, *running).groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_sums"))
    kept = []
    if side is not None:
        accounts, kept = accounts.join(side, "inn"), [c for c in side.columns if c != "inn"]
    # the place in the list (from 1; 0 before the first entry) of every point
    found = F.flatten(F.transform("_sums", lambda e, i: F.array_repeat(i + 1, e["_holds"])))
    found = F.concat(F.array_repeat(F.lit(0), F.col("_sums")[0]["_at"]), found)
    wanted: dict[_dt.date, dict] = {}
    for d, w, lo, hi in bounds:
        wanted.setdefault(d, {})[w] = (place[lo - one], place[hi], lo)
    windows = list(dict.fromkeys(b[1] for b in bounds))
    one_date = lambda d, of: F.struct(
        F.lit(d).alias(AS_OF), *[F.lit(of[w][k]).alias(f"{n}_{w}") for w in windows for k, n in enumerate(("before", "end", "lo"))])
    each = F.array(*[one_date(d, of) for d, of in wanted.items()])
    dated = accounts.select(*keys, *kept, "_sums", found.alias("_found")).withColumn("_d", F.explode(each))
    entry_at = lambda name: F.get("_sums", F.get("_found", F.col(f"_d.{name}")) - 1)
    looked = [entry_at(f"{n}_{w}").alias(f"_{n}_{w}") for w in windows for n in ("before", "end")]
    dated = dated.select(*keys, *kept, "_d", F.element_at("_sums", -1).alias("_all"), *looked)
    out = [F.col(f"_d.{AS_OF}").alias(AS_OF), F.col("_all.c_rows").alias("all_rows")]
    out += [F.col(f"_all.s_{m}").alias(f"total_{m}") for m in sums] + [F.col(f"_all.m_{m}").alias(f"total_{m}") for m in maxima]
    types = {f.name: f.dataType for f in accounts.schema["_sums"].dataType.elementType.fields}
    for w in windows:
        zero = lambda c, n, w=w: F.coalesce(F.col(f"_{n}_{w}.{c}"), F.lit(0)).cast(types[c])
        within = lambda c: (zero(c, "end") - zero(c, "before")).cast(types[c])  # noqa: E731, B023
        out.append(within("c_rows").alias(f"rows_{w}"))
        for m in sums:
            out += [within(f"s_{m}").alias(f"{m}_{w}"), within(f"c_{m}").alias(f"n_{m}_{w}")]
        for m in maxima:
            latest = F.col(f"_end_{w}.m_{m}")
            out.append(F.when(F.to_date(latest) >= F.col(f"_d.lo_{w}"), latest).alias(f"{m}_{w}"))
    return dated.select(*keys, *kept, *out)


def _or_zero(m: str, w: str) -> str:
    """As ``sum(CASE WHEN inside THEN m ELSE 0 END)``: null only where all rows
    are inside and none has a value."""
    return f"IF(all_rows = rows_{w} AND n_{m}_{w} = 0, NULL, {m}_{w})"


def _terms(terms: DataFrame | None) -> DataFrame | None:
    return None if terms is None else terms.select("inn", "payment_type")


def lead_accounts(firsts: DataFrame, dates, terms: DataFrame | None = None) -> DataFrame:
    """A1 before the pick, for every run date: the columns of
    ``leads.lead_accounts`` behind ``as_of``; ``firsts`` are first leads (R1).
    With ``terms``, of clients that have terms, and their ``payment_type``."""
    bounds = bounds_of(firsts.sparkSession, dates, Calendar.leads_windows)
    sums = {"cnt": "CAST(IF(sale > 0, 1, 0) AS BIGINT)", "purchase": "purchase", "sale": "sale"}
    got = period_measures(firsts, "date_add", sums, bounds, {"lead": "date_time_add"}, side=_terms(terms))
    cols = [AS_OF, *leads.ACCOUNT, *(["payment_type"] if terms is not None else []), "CAST(total_cnt AS BIGINT) AS total_cnt", "total_lead AS last_lead_dttm", "total_purchase", "total_sale"]
    for w in dict.fromkeys(b[1] for b in bounds):
        cols += [f"CAST(cnt_{w} AS BIGINT) AS cnt_{w}", f"{_or_zero('purchase', w)} AS purchase_{w}", f"{_or_zero('sale', w)} AS sale_{w}"]
    return got.selectExpr(*cols)


def leads_period_agg(firsts: DataFrame, terms: DataFrame, dates) -> DataFrame:
    """A1 + J1 for every run date (``as_of``); ``terms`` has inn and payment_type."""
    return leads.pick_of_terms(lead_accounts(firsts, dates, terms), (AS_OF,))


def invoice_measures(enriched: DataFrame, rules: RuleSet, dates, terms: DataFrame | None = None) -> DataFrame:
    """A2 before the pick, for every run date; ``terms`` as in ``lead_accounts``."""
    billable = enriched.where(f"nomenclature_text_gr = {lit(rules.billable_category)}").withColumnRenamed("partner_inn", "inn")
    bounds = bounds_of(enriched.sparkSession, dates, Calendar.invoice_windows)
    valid = f"invoice_status = {lit(L.STATUS_VALID)}"
    sums = {"inv": f"IF({valid}, invoice_amount, 0)", "rec": f"IF({valid}, receipt_amount, 0)", "cinv": "invoice_amount", "crec": "receipt_amount"}
    maxima = {"maxdt": f"IF({valid}, invoice_dt, NULL)", "cmax": "invoice_dt"}
    got = period_measures(billable, "CAST(invoice_dt AS DATE)", sums, bounds, maxima, side=_terms(terms))
    cols = [AS_OF, *leads.ACCOUNT, *(["payment_type"] if terms is not None else []), "total_inv AS total_invoice", "total_rec AS total_receipt", "total_maxdt AS total_max_invoice_dt"]
    for w in dict.fromkeys(b[1] for b in bounds):
        cols += [f"{_or_zero('inv', w)} AS inv_{w}", f"{_or_zero('rec', w)} AS rec_{w}", f"maxdt_{w}"]
    for w in sorted({*INVOICE_CURR_WINDOW.values(), OTHER_WINDOW}):  # any status, null when empty
        cols += [f"IF(n_{m}_{w} = 0, NULL, {m}_{w}) AS {m}_{w}" for m in ("cinv", "crec")] + [f"cmax_{w}"]
    return got.selectExpr(*cols)


def invoices_period_agg(enriched: DataFrame, terms: DataFrame, rules: RuleSet, dates) -> DataFrame:
    """A2 + J2 for every run date (``as_of``)."""
    return invoices.pick_of_terms(invoice_measures(enriched, rules, dates, terms), (AS_OF,))
