"""A1: the stored month snapshot and the flagged leads, kept by month.

Duplicate groups never span a month, so every month of leads can be flagged
and pre-aggregated on its own. Two tables are kept from run to run:

* ``leads_enriched``: every lead with its duplicate flag, by month;
* ``lead_months``: closed months, one row per (account, month).

``lead_month_marks`` holds a fingerprint of each month that was built: of the
files that its leads come from where the leads are read from files (only the
date column is read for it), else of the rows. A month whose fingerprint has
changed, because a late lead arrived or the rules changed, is built anew, and
so is every open month; all others are not read again. Marks are written
last, so a run that broke off repeats its months.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import Calendar
from ..operators import leads
from ..rules import RuleSet
from ..sinks import tables

MONTH = "lead_month"
#: month of leads without a date
UNDATED = "none"
_MONTH_SQL = f"coalesce(date_format(date_add, 'yyyy-MM'), '{UNDATED}')"


@dataclass(frozen=True)
class Built:
    """What an update did: months built anew, and all months there are."""

    rebuilt: tuple[str, ...]
    months: tuple[str, ...]


def month_marks(source: DataFrame, rules: RuleSet) -> DataFrame:
    """(month, leads, mark) of the raw leads."""
    rule_mark = int(hashlib.sha256(repr(rules).encode()).hexdigest()[:12], 16)
    files = ["_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"]
    try:
        rows = source.selectExpr(f"{_MONTH_SQL} AS month", f"xxhash64({', '.join(files)}) AS mark")
    except AnalysisException:  # not read from files
        rows = source.selectExpr(f"{_MONTH_SQL} AS month", f"xxhash64(to_json(struct({', '.join(source.columns)}))) AS mark")
    by_mark = rows.groupBy("month", "mark").agg(F.count("*").alias("leads"))
    mark = F.bit_xor(F.xxhash64("mark", "leads", F.lit(rule_mark)))
    return by_mark.groupBy("month").agg(F.sum("leads").alias("leads"), mark.alias("mark"))


def of_months(source: DataFrame, months) -> DataFrame:
    """Leads of these months, as ranges of dates that a scan can prune by."""
    dated = sorted(m for m in months if m != UNDATED)
    ranges = [f"(date_add >= DATE'{m}-01' AND date_add < add_months(DATE'{m}-01', 1))" for m in dated]
    ranges += ["date_add IS NULL"] if UNDATED in months else []
    return source.where(" OR ".join(ranges) or "false")


def update(spark: SparkSession, source: DataFrame, rules: RuleSet, cal: Calendar, database: str) -> Built:
    """Bring ``leads_enriched`` and ``lead_months`` of ``database`` up to date."""
    enriched, snapshot, marks = (f"{database}.{n}" for n in ("leads_enriched", "lead_months", "lead_month_marks"))
    now = {r.month: (r.leads, r.mark) for r in month_marks(source, rules).collect()}  # one row a month
    kept = {r.month: (r.leads, r.mark) for r in spark.table(marks).collect()} if tables.table_exists(spark, marks) else {}
    if not all(tables.table_exists(spark, t) for t in (enriched, snapshot)):
        drop(spark, database)
        kept = {}
    changed = {m for m in now.keys() | kept.keys() if now.get(m) != kept.get(m)}
    if changed or not kept:
        keyed = leads.enrich_leads(of_months(source, changed & now.keys()), rules)
        flagged = leads.flag_duplicates(keyed).withColumn(MONTH, F.expr(_MONTH_SQL))
        tables.replace_partitions(flagged, enriched, MONTH, changed)
        # open months are kept too: when they close, their rows are there
        rows = leads.month_snapshot(leads.lead_groups(keyed), None).withColumn(
            MONTH, F.expr(f"coalesce(date_format(month, 'yyyy-MM'), '{UNDATED}')"))
        tables.replace_partitions(rows, snapshot, MONTH, changed)
        table = spark.createDataFrame([(m, *v) for m, v in sorted(now.items())], "month string, leads long, mark long")
        tables.full_refresh(table, marks)
    return Built(tuple(sorted(changed)), tuple(sorted(now)))


def lead_accounts(spark: SparkSession, source: DataFrame, rules: RuleSet, cal: Calendar, database: str) -> DataFrame:
    """A1 before the pick: stored closed months, and the open months' leads."""
    closed = spark.table(f"{database}.lead_months").drop(MONTH)
    return leads.lead_accounts_incremental(closed, leads.enrich_leads(source, rules), cal)


def drop(spark: SparkSession, database: str) -> None:
    for n in ("leads_enriched", "lead_months", "lead_month_marks"):
        tables.drop_table(spark, f"{database}.{n}")
