"""The daily run -- rebuild the derived tables, then the outputs.

Order follows the declared dependencies (``pipeline.STAGES``): leads ->
payment terms -> invoices -> balance report; then the outbox tables, the
invoice documents and the audit log. Every table is replaced by one change of
its location; the audit log is appended. Nothing is collected: the run
summary is a one-row table like the rest.

Each finished table is noted in a ledger under a fingerprint of the inputs,
the rules and the run date (what carries the run's time: under that, too). A
run that broke off and is started again takes the noted tables as they stand
and goes on from the first that is missing; the audit log is not appended
twice. With other inputs or rules everything is built anew.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sqlexpr import ident, lit
from ..operators import outbox, reports
from ..rules import RuleSet
from ..session import remove_paths
from ..sinks import tables
from . import snapshot
from .pipeline import INPUT_TABLES, Inputs, Pipeline

LEDGER = "run_ledger"


def _marks(name: str, df: DataFrame) -> DataFrame:
    """One row: of the files that an input is read from, without reading their
    columns; else of its rows."""
    try:
        rows = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    except AnalysisException:  # not read from files
        rows = df.selectExpr(f"to_json(struct({', '.join(map(ident, df.columns))})) AS row")
    return rows.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*rows.columns)).alias("mark")).withColumn("name", F.lit(name))


def run_key(inputs: Inputs, rules: RuleSet, as_of: _dt.date, names=INPUT_TABLES) -> str:
    marks = reduce(DataFrame.unionByName, [_marks(n, inputs[n]) for n in names])
    found = sorted(tuple(r) for r in marks.select("name", "n", "mark").collect())  # one row an input
    return hashlib.sha256(repr((found, rules, as_of)).encode()).hexdigest()


class Ledger:
    """Tables that a run has finished."""

    def __init__(self, spark: SparkSession, database: str, key: str):
        self.spark, self.name, self.key = spark, f"{database}.{LEDGER}", key
        self._done = set()
        if tables.table_exists(spark, self.name):
            noted = spark.table(self.name).where(F.col("key").startswith(key)).select("key", "table").distinct().collect()
            self._done = {tuple(r) for r in noted}

    def has(self, table: str, extra: str = "") -> bool:
        return (self.key + extra, table) in self._done

    def note(self, table: str, extra: str = "") -> None:
        row = f"SELECT {lit(self.key + extra)} AS key, {lit(table)} AS table, current_timestamp() AS at"
        tables.append(self.spark.sql(row), self.name)
        self._done.add((self.key + extra, table))


def run_daily(
    spark: SparkSession,
    inputs: Inputs,
    rules: RuleSet,
    as_of: _dt.date,
    run_ts: _dt.datetime,
    database: str,
    log_path: str | None = None,
) -> dict[str, str]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    p = Pipeline(inputs, rules, as_of)
    ledger, at = Ledger(spark, database, run_key(inputs, rules, as_of)), f" {run_ts.isoformat()}"
    written: dict[str, str] = {}

    def save(name: str, build: Callable[[], DataFrame], extra: str = "") -> DataFrame:
        t = written[name] = f"{database}.{name}"
        if not (ledger.has(name, extra) and tables.table_exists(spark, t)):
            tables.full_refresh(build(), t)
            ledger.note(name, extra)
        return spark.table(t)

    # derived tables, in dependency order; leads are flagged and summed by
    # month, so only open and changed months are read; the invoice facts are
    # read once, what follows aggregates from the saved tables
    if not ledger.has("leads_enriched"):
        snapshot.update(spark, inputs["leads"], rules, p.cal, database)
        ledger.note("leads_enriched")
    written["leads_enriched"] = f"{database}.leads_enriched"
    p.use_saved("leads_enriched", spark.table(written["leads_enriched"]).drop(snapshot.MONTH))
    accounts = save("lead_accounts", lambda: snapshot.lead_accounts(spark, inputs["leads"], rules, p.cal, database))
    p.use_saved("lead_accounts", accounts)
    p.use_saved("invoices_enriched", save("invoices_enriched", lambda: p.invoices_enriched))
    p.use_saved("payment_terms_calendar", save("payment_terms_calendar", lambda: p.payment_terms_calendar))
    report = save("balance_report", lambda: p.balance_report)  # read by every output below
    p.use_saved("balance_report", report)

    # result sets and decisions
    for name in ("invoice_report", "new_invoices", "errors"):
        save(f"out_{name}", lambda name=name: p.outputs()[name])
    lines = outbox.invoice_lines_for(report, rules)
    save("invoice_documents", lambda: outbox.invoice_payload(lines, rules, run_ts), at)
    save("alert_outbox", lambda: outbox.outbox_errors(report, rules, as_of, run_ts).unionByName(
        outbox.outbox_warnings(report, rules, as_of, run_ts)), at)
    save("invoice_outbox", lambda: outbox.outbox_invoices(lines, rules, as_of))
    save("run_summary", lambda: reports.run_summary(lines))
    if log_path:
        if not ledger.has("audit_log", at + log_path):
            tables.append_json_log(outbox.audit_log(lines, run_ts).select("line"), log_path)
            ledger.note("audit_log", at + log_path)
        written["audit_log"] = log_path
    remove_paths(spark, p.made)
    return written
