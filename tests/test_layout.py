"""J8 / A3 / W4 by invoice id without a shuffle; A2 / R4 without the columns it does not read."""

import os

import pytest

from tallyline import labels as L
from tallyline.operators import invoices
from tallyline.plans.layout import colocate
from tallyline.plans.pipeline import Pipeline, driver_inputs
from tallyline.sinks import tables
from tallyline.sources import driver as D

from .conftest import SF_SMALL

RULES = D.driver_rules()


@pytest.fixture()
def sort_merge(spark):
    """Joins as they are between tables too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_invoice_facts_meet_without_an_exchange(spark, scratch, sort_merge):
    db = "tl_layout_" + os.path.basename(scratch).replace("-", "_").lower()
    plain = driver_inputs(spark, SF_SMALL, RULES)
    want = rows(Pipeline(plain, RULES, D.AS_OF).invoices_enriched)
    for _ in range(2):  # stored anew, too
        inputs = colocate(spark, plain, db, 4)
        p = Pipeline(inputs, RULES, D.AS_OF)
        assert rows(p.invoices_enriched) == want
    plan = plan_of(p.invoices_enriched)
    assert "SortMergeJoin" in plan and "hashpartitioning(invoice_id" not in plan
    by = {line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line}
    assert by <= {"organization_id", "partner_id", "partner_inn", "partner_name", "_rule_key"}, by  # dimensions and their rules
    assert "hashpartitioning(invoice_id" in plan_of(Pipeline(plain, RULES, D.AS_OF).invoices_enriched)
    assert len(os.listdir(tables._place(spark, f"{db}.by_invoice_invoice").removeprefix("file:") + tables.VERSIONS)) == 2


@pytest.mark.parametrize("category", [RULES.billable_category, L.CATEGORY_DEFAULT])
def test_period_measures_of_billable_invoices_only(spark, category):
    import dataclasses

    rules = dataclasses.replace(RULES, billable_category=category)
    p = Pipeline(driver_inputs(spark, SF_SMALL, rules), rules, D.AS_OF)
    whole = invoices.invoice_window_measures(p.invoices_enriched, p.cal, rules)
    assert rows(invoices.invoice_window_measures(p.billable_invoices, p.cal, rules)) == rows(whole)


def test_the_aggregate_joins_no_organisation_and_fewer_rows_meet_the_partners(spark, sort_merge):
    p = Pipeline(driver_inputs(spark, SF_SMALL, RULES), RULES, D.AS_OF)
    plan = p.billable_invoices._jdf.queryExecution().optimizedPlan().toString()
    assert "region" not in plan and "organization_name" not in plan  # organisations come from region
    billable, every = p.billable_invoices, p.invoices_enriched
    assert billable.count() == every.where(f"nomenclature_text_gr = '{RULES.billable_category}'").count() < every.count()
    partner_join = plan.index("Join LeftOuter, (partner_id")
    assert partner_join < plan.index("Join Inner, (invoice_id")  # printed top-down: billable first, partners last


def test_buckets_follow_the_rows(spark, monkeypatch):
    from tallyline.plans import layout

    inputs = {n: spark.range(k) for n, k in (("invoice", 10), ("invoice_line", 95), ("receipt_line", 30))}
    assert layout.buckets_for(inputs) == layout.LEAST
    monkeypatch.setattr(layout, "BUCKET_ROWS", 5)
    assert layout.buckets_for(inputs) == 19
