"""Leads: client key, branch, channel, week end, duplicates, period measures.

Operators: P11 (key remap + pad), P13 (branch), P16 (channel), P21 (week
end), W1 (duplicate flag), A1 (period aggregate), R1/R2/J1.

Scale notes
-----------
* Duplicate detection is a ``groupBy`` on the duplicate key keeping the
  smallest (timestamp, lead id) with ``min(struct)``. Struct buffers make it
  a sort-based aggregate, so the leads are dealt out by (key, lead id) first
  and it aggregates partially there: a hot key (one phone holding a third of
  all leads) collapses to one row per part before the second shuffle, whereas
  a ``row_number`` window would sort that whole key inside one task.
* The same aggregate keeps each group's latest lead, so the latest legal
  entity per client (W2) needs no second pass over the fact table.
* The period aggregate never joins the fact table to the terms table. Period
  bounds depend only on (payment terms, as_of), so every distinct window is
  evaluated once per lead inside one partial+final aggregate, and the
  per-client pick happens after the aggregate, on account-sized data. (That
  aggregate also carries the latest-lead struct, which makes it sort-based;
  at sf 0.1 it measured the same as the hash form without the struct.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.dates import Calendar, LEADS_PREV_WINDOW, LEADS_WINDOW, pick_by_terms, week_end
from ..functions.sqlexpr import case, lit
from ..functions.text import pad_short_key
from ..rules import RuleSet, with_lead_rules

DEDUP_KEYS = ("_dk_inn", "_dk_phone", "_dk_source", "_dk_city", "_dk_month")
#: what ``lead_groups`` reads of a lead
GROUP_COLUMNS = (
    *DEDUP_KEYS, "date_time_add", "lead_id", "inn", "city_invoice", "source_invoice", "date_add", "sale", "purchase",
    "legal_entity",
)
#: parts a duplicate group is dealt over
SALTS = 64
ACCOUNT = ("inn", "city_invoice", "source_invoice")


def lookup(key: str, pairs, default: str) -> str:
    return case([(f"{key} = {lit(k)}", lit(v)) for k, v in pairs], default)


# Expressions over the columns that ``with_lead_rules`` adds by raw key.
def client_key(raw: str) -> str:
    """Remap on the raw key first, else pad a key that lost its zero."""
    return f"coalesce(_remap, {pad_short_key(raw)})"


def lead_branch(city: str) -> str:
    """P13, on the raw key. NULL city of the default client gives NULL."""
    return case([(f"_empty_branch IS NOT NULL AND {city} = ''", "_empty_branch"), ("_own_branch", city)], "''")


def lead_channel(source: str, rules: RuleSet) -> str:
    """Ordered prefix test for listed clients, else ''."""
    inner = case([(f"startswith({source}, {lit(p)})", lit(c)) for p, c in rules.channel_prefixes], "''")
    return case([("_channelled", inner)], "''")


LEAD_OUT = (
    "project", "date_add", "date_time_add", "week_end", "inn", "city_invoice", "source_invoice", "legal_entity",
    "source", "company", "name", "phone", "city", "branch", "send_status", "send_date_time", "purchase", "sale",
    "lead_id",
)


def enrich_leads(leads: DataFrame, rules: RuleSet) -> DataFrame:
    """Leads with account columns and the duplicate key. The rule table is a
    local relation of known size, one row per key."""
    exprs = {
        "week_end": week_end("date_add"),
        "inn": client_key("inn"),
        "city_invoice": lead_branch("city"),
        "source_invoice": lead_channel("source", rules),
    }
    cols = [f"{exprs[c]} AS {c}" if c in exprs else c for c in LEAD_OUT]
    cols += [
        "inn AS _dk_inn",
        "phone AS _dk_phone",
        "source AS _dk_source",
        "IF(_by_city, city, '') AS _dk_city",
        "trunc(date_add, 'MM') AS _dk_month",
    ]
    return with_lead_rules(leads, rules).selectExpr(*cols)


def flag_duplicates(enriched: DataFrame, salts: int = SALTS) -> DataFrame:
    """Every lead with ``duplicate_flag`` ('' for the first of its group).

    The leads are read once and their full rows are shuffled once, dealt by
    (group, salt), so a hot group spreads over ``salts`` parts. Each part finds
    its own first lead where it lies; only those (group, salt, time, id) move
    again, to find the first of the group, and come back to the parts as flags.
    The group is one struct, which is never NULL and whose NULL fields equal
    each other, so plain equality joins it.

    The salt follows the lead id, so a task run again deals its rows alike. Its
    ``0 * rand()`` adds nothing; a CTE that is not deterministic is planned once
    for both of its readers, which share the one shuffle.
    """
    return enriched.sparkSession.sql(
        f"""
WITH dealt AS (
  SELECT /*+ REPARTITION(_group, _salt) */ * FROM (
    SELECT {", ".join(LEAD_OUT)}, struct({", ".join(DEDUP_KEYS)}) AS _group,
      CAST(pmod(xxhash64(lead_id), {int(salts)}) + 0 * rand(0) AS INT) AS _salt
    FROM {{enriched}})
), parts AS (
  SELECT _group, _salt, min(struct(date_time_add, lead_id)) AS _own FROM dealt GROUP BY _group, _salt
), firsts AS (
  SELECT _group, _salt, min(_own) OVER (PARTITION BY _group) AS _first FROM parts
)
SELECT {", ".join("d." + c for c in LEAD_OUT)},
  CASE WHEN struct(d.date_time_add, d.lead_id) = f._first THEN '' ELSE {lit(L.DUPLICATE_FLAG)} END AS duplicate_flag
FROM dealt d JOIN firsts f ON d._group = f._group AND d._salt = f._salt
""",
        enriched=enriched,
    )


def first_leads(enriched: DataFrame) -> DataFrame:
    """Only first-of-group leads, straight from the dedup aggregate."""
    return lead_groups(enriched).select("_f.*")


def lead_groups(enriched: DataFrame) -> DataFrame:
    """One row per duplicate group: its first lead (R1) and its latest lead.

    Keeping the latest (timestamp, id, legal entity) of every group lets the
    latest legal entity per client (W2) come out of the same pass over the
    fact table: the max over groups is the max over leads.

    The leads are dealt out before they are sorted for the aggregate: a scan
    task may read a whole file, and its sort would grow with it. They are dealt
    by group and lead, so that a hot group still collapses in every part.
    """
    enriched = enriched.select(*GROUP_COLUMNS).repartition(*DEDUP_KEYS, "lead_id")
    first = "min(struct(date_time_add, lead_id, inn, city_invoice, source_invoice, date_add, sale, purchase)) AS _f"
    latest = "max(struct(date_time_add, lead_id, legal_entity)) AS _latest"
    return enriched.groupBy(*DEDUP_KEYS).agg(F.expr(first), F.expr(latest))


def lead_accounts(groups: DataFrame, cal: Calendar) -> DataFrame:
    """A1 before the pick, plus W2's per-account latest lead.

    Account-sized output: the only thing later stages need from the fact
    table, so it is the natural place to cut lineage at scale.
    """
    return _window_measures(_measure_rows(groups), cal)


def _measure_rows(groups: DataFrame) -> DataFrame:
    """First leads as measure rows: one lead each, ``npos`` = 1 if paid."""
    return groups.selectExpr(
        "_f.inn AS inn", "_f.city_invoice AS city_invoice", "_f.source_invoice AS source_invoice",
        "_f.date_add AS date_add", "_f.date_time_add AS date_time_add",
        "CASE WHEN _f.sale > 0 THEN 1 ELSE 0 END AS npos", "_f.purchase AS purchase", "_f.sale AS sale", "_latest",
    )


def _window_measures(rows: DataFrame, cal: Calendar) -> DataFrame:
    """Measure rows (a lead, or a pre-aggregated closed month) -> totals and
    (count of paid, purchase, sale) for every distinct window."""
    aggs = [
        "CAST(sum(npos) AS BIGINT) AS total_cnt",
        "max(date_time_add) AS last_lead_dttm",
        "sum(purchase) AS total_purchase",
        "sum(sale) AS total_sale",
    ]
    for name, (lo, hi) in cal.leads_windows().items():
        inside = f"date_add BETWEEN {lo} AND {hi}"
        aggs += [
            f"CAST(sum(CASE WHEN {inside} THEN npos ELSE 0 END) AS BIGINT) AS cnt_{name}",
            f"sum(CASE WHEN {inside} THEN purchase ELSE 0 END) AS purchase_{name}",
            f"sum(CASE WHEN {inside} THEN sale ELSE 0 END) AS sale_{name}",
        ]
    aggs.append("max(_latest) AS latest")
    return rows.groupBy(*ACCOUNT).agg(*[F.expr(a) for a in aggs])


# ---------------------------------------------------------------------------
# Monthly snapshot of closed months (scale device for a daily run)
# ---------------------------------------------------------------------------
def snapshot_boundary(cal: Calendar) -> str:
    """First day of the previous month. Every leads window except the
    deposit window and the all-history totals starts on or after it, so
    months before it only ever count whole."""
    return cal.prev_month_01


def month_snapshot(groups: DataFrame, upto: str | None) -> DataFrame:
    """Closed months (< ``upto``; all without it) pre-aggregated per (account,
    month).

    Exact because duplicate groups never span months (the month is part of
    the duplicate key). Kept by month in ``plans/snapshot.py``."""
    firsts = groups.where(f"_dk_month < {upto}") if upto else groups
    return firsts.groupBy(
        F.expr("_f.inn AS inn"), F.expr("_f.city_invoice AS city_invoice"),
        F.expr("_f.source_invoice AS source_invoice"), F.expr("_dk_month AS month"),
    ).agg(
        F.expr("CAST(sum(CASE WHEN _f.sale > 0 THEN 1 ELSE 0 END) AS BIGINT) AS npos"),
        F.expr("sum(_f.purchase) AS purchase"),
        F.expr("sum(_f.sale) AS sale"),
        F.expr("max(_f.date_time_add) AS max_ts"),
        F.expr("max(_latest) AS latest"),
    )


def lead_accounts_incremental(snapshot: DataFrame, keyed: DataFrame, cal: Calendar) -> DataFrame:
    """Same result as ``lead_accounts`` over all months, reading only the
    open months from the fact table: a snapshot month enters the window
    aggregate as one measure row dated on its first day (inside the deposit
    window, outside every other), live months as single leads.

    The open-month filter is on the lead date itself (the boundary is a
    month start and duplicate groups are month-local), so on a table
    partitioned or sorted by date it prunes files before the scan."""
    boundary = snapshot_boundary(cal)
    # a lead without a date is in no window, only in the totals
    snap_rows = snapshot.where(f"month < {boundary} OR month IS NULL").selectExpr(
        *ACCOUNT, "month AS date_add", "max_ts AS date_time_add", "npos", "purchase", "sale", "latest AS _latest"
    )
    live_rows = _measure_rows(lead_groups(keyed.where(f"date_add >= {boundary}")))
    return _window_measures(live_rows.unionByName(snap_rows), cal)


def leads_window_measures(firsts: DataFrame, cal: Calendar) -> DataFrame:
    """A1 before the pick from first-lead rows (as ``first_leads`` gives)."""
    rows = firsts.selectExpr(
        *ACCOUNT, "date_add", "date_time_add", "CASE WHEN sale > 0 THEN 1 ELSE 0 END AS npos", "purchase", "sale",
        "CAST(NULL AS STRUCT<date_time_add: TIMESTAMP_NTZ, lead_id: BIGINT, legal_entity: STRING>) AS _latest",
    )
    return _window_measures(rows, cal).drop("latest")


def first_of_flagged(flagged: DataFrame) -> DataFrame:
    """R1 on flagged leads (as saved): the rows that are no duplicates."""
    return flagged.where("duplicate_flag = ''")


def latest_entity_of_leads(flagged: DataFrame) -> DataFrame:
    """W2 straight from the leads: latest legal entity per client key."""
    pick = "max(struct(date_time_add, lead_id, legal_entity)) AS _p"
    return flagged.groupBy("inn").agg(F.expr(pick)).selectExpr("inn", "_p.legal_entity AS legal_entity")


def latest_entity_of(accounts: DataFrame) -> DataFrame:
    """W2 from the account aggregate: latest legal entity per client key."""
    return accounts.groupBy("inn").agg(F.expr("max(latest) AS _p")).selectExpr(
        "inn", "_p.legal_entity AS legal_entity"
    )


LEADS_MEASURES = (
    "total_cnt", "last_lead_dttm", "total_purchase", "total_sale",
    "interval_cnt", "interval_purchase", "interval_sale",
    "prev_cnt", "prev_purchase", "prev_sale",
)


def pick_leads_measures(payment_type: str = "payment_type") -> list[str]:
    out = ["total_cnt", "last_lead_dttm", "total_purchase", "total_sale"]
    for prefix, mapping in (("interval", LEADS_WINDOW), ("prev", LEADS_PREV_WINDOW)):
        for fam in ("cnt", "purchase", "sale"):
            out.append(f"{pick_by_terms(payment_type, mapping, lambda w, fam=fam: f'{fam}_{w}')} AS {prefix}_{fam}")
    return out


def leads_period_agg(accounts: DataFrame, terms_cal: DataFrame, keep=()) -> DataFrame:
    """A1 + J1: per account measures, only clients that have terms (inner);
    ``keep`` are further columns to carry."""
    return pick_of_terms(accounts.join(terms_cal.select("inn", "payment_type"), "inn", "inner"), keep)


def pick_of_terms(joined: DataFrame, keep=()) -> DataFrame:
    """The per-client window pick of accounts that have their ``payment_type``."""
    return joined.selectExpr(*keep, *ACCOUNT, *pick_leads_measures())
