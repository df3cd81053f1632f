"""A run that broke off goes on from the table that is missing."""

import os

import pytest

from tallyline.plans import run
from tallyline.plans.pipeline import driver_inputs
from tallyline.sinks import tables
from tallyline.sources import driver as D

from .conftest import SF_SMALL

STORED = ("leads_enriched", "lead_accounts", "invoices_enriched", "payment_terms_calendar")


@pytest.fixture()
def daily(spark, scratch):
    rules, db = D.driver_rules(), "tl_restart_" + os.path.basename(scratch).replace("-", "_").lower()

    def start(run_ts=D.RUN_TS, rules=rules):
        return run.run_daily(spark, driver_inputs(spark, SF_SMALL, rules), rules, D.AS_OF, run_ts, db, f"{scratch}/log")

    return start, db


def test_a_run_broken_after_invoices_rebuilds_only_the_report(spark, daily, monkeypatch, scratch):
    start, db = daily
    refresh, built = tables.full_refresh, []

    def breaking(df, name, **options):
        if name.endswith(".balance_report"):
            raise RuntimeError("lost")
        refresh(df, name, **options)

    monkeypatch.setattr(tables, "full_refresh", breaking)
    with pytest.raises(RuntimeError, match="lost"):
        start()
    before = {t: sorted(spark.table(f"{db}.{t}").inputFiles()) for t in STORED}

    def counting(df, name, **options):
        built.append(name.removeprefix(f"{db}."))
        refresh(df, name, **options)

    monkeypatch.setattr(tables, "full_refresh", counting)
    written = start()
    assert built[0] == "balance_report" and not set(built) & set(STORED)
    assert {t: sorted(spark.table(f"{db}.{t}").inputFiles()) for t in STORED} == before
    report = spark.table(written["balance_report"])
    assert report.count() == spark.table(written["out_invoice_report"]).count() > 0
    lines = spark.read.text(f"{scratch}/log").count()

    built.clear()
    start()  # all is there: nothing is built, the log is not appended again
    assert built == [] and spark.read.text(f"{scratch}/log").count() == lines == spark.table(written["invoice_documents"]).count()

    start(run_ts=D.RUN_TS.replace(hour=11))  # another time: only what carries it
    assert set(built) == {"invoice_documents", "alert_outbox"}


def test_the_key_follows_inputs_rules_and_date(spark, scratch):
    import dataclasses
    import datetime as dt

    from tallyline.plans.pipeline import Inputs

    path = f"{scratch}/t"
    spark.range(3).write.parquet(path)
    key = lambda rules=D.driver_rules(), day=D.AS_OF: run.run_key(
        Inputs.of({"a": spark.read.parquet(path), "b": spark.range(5).selectExpr("id", "id * 2 AS `odd name`")}), rules, day, ("a", "b"))
    first = key()
    assert key() == first
    assert key(day=D.AS_OF + dt.timedelta(days=1)) != first
    assert key(rules=dataclasses.replace(D.driver_rules(), billable_category="other")) != first
    spark.range(3).write.mode("append").parquet(path)
    assert key() != first
