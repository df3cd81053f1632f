"""Many run dates from cumulative day sums == each run date on its own."""

import datetime as dt
from decimal import Decimal

from tallyline.functions.dates import Calendar
from tallyline.operators import daysums, invoices, leads
from tallyline.plans.pipeline import Pipeline, driver_inputs
from tallyline.sources import driver as D

from .conftest import SF_SMALL
from .test_months import RULES, SCHEMA, some_leads

DATES = [dt.date(2024, 1, 1), dt.date(2024, 1, 10), dt.date(2024, 1, 31), dt.date(2024, 2, 10), dt.date(2024, 2, 29), dt.date(2024, 3, 16)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_lead_accounts_of_every_date(spark):
    given = some_leads(3, 1500, dt.datetime(2023, 11, 20), 130)
    # an account whose leads have no sale, one whose leads have no date, one far in the past
    given += [("p", d, None, i, "E", "web", "c", "n", str(k), "", "b", "s", None, x, x, 5000 + k)
              for k, (i, d, x) in enumerate([("77", dt.date(2024, 1, 5), None), ("88", None, Decimal(3)), ("99", dt.date(1990, 1, 1), Decimal(4))])]
    firsts = leads.first_leads(leads.enrich_leads(spark.createDataFrame(given, SCHEMA), RULES)).cache()
    got = daysums.lead_accounts(firsts, DATES).cache()
    for d in DATES:
        one = leads.leads_window_measures(firsts, Calendar.of(d))
        assert rows(got.where(got.as_of == d).select(*one.columns)) == rows(one)


def test_invoice_measures_of_every_date(spark):
    rules = D.driver_rules()
    p = Pipeline(driver_inputs(spark, SF_SMALL, rules), rules, D.AS_OF)
    enriched = p.invoices_enriched.cache()
    got = daysums.invoice_measures(enriched, rules, DATES).cache()
    for d in DATES:
        one = invoices.invoice_window_measures(enriched, Calendar.of(d), rules)
        assert rows(got.where(got.as_of == d).select(*one.columns)) == rows(one)


def test_facts_are_read_once(spark, scratch):
    spark.createDataFrame(some_leads(4, 50, dt.datetime(2024, 1, 1), 60), SCHEMA).write.parquet(f"{scratch}/leads")
    firsts = leads.first_leads(leads.enrich_leads(spark.read.parquet(f"{scratch}/leads"), RULES))
    plan = daysums.lead_accounts(firsts, DATES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_facts(spark):
    firsts = leads.first_leads(leads.enrich_leads(spark.createDataFrame([], SCHEMA), RULES))
    assert daysums.lead_accounts(firsts, DATES).count() == 0


def _multiplied_last(df):
    """Rows meet the run dates above every shuffle, sort, aggregate and join."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate explode")]
    return not any(step in above for step in ("Join", "Aggregate", "Sort", "Window", "Repartition"))


def _terms_of(spark):
    return spark.createDataFrame([("77", "x", 1), ("88", "y", 2)], "inn string, payment_type string, other int")


def test_invoices_of_many_dates_move_as_accounts(spark):
    rules = D.driver_rules()
    schema = "partner_inn string, city_invoice string, source_invoice string, nomenclature_text_gr string, invoice_status string, invoice_dt timestamp_ntz, invoice_amount decimal(18,2), receipt_amount decimal(18,2)"
    facts = spark.createDataFrame([("77", "", "", rules.billable_category, "x", dt.datetime(2024, 1, 5), Decimal(1), Decimal(2))], schema)
    got = daysums.invoices_period_agg(facts, _terms_of(spark), rules, DATES)
    assert _multiplied_last(got) and got.count() == len(DATES)


def test_leads_of_many_dates_move_as_accounts(spark):
    given = [("p", dt.date(2024, 1, 5), None, i, "E", "web", "c", "n", str(k), "", "b", "s", None, Decimal(1), Decimal(2), k)
             for k, i in enumerate(("77", "88", "99"))]
    firsts = leads.first_leads(leads.enrich_leads(spark.createDataFrame(given, SCHEMA), RULES))
    got = daysums.leads_period_agg(firsts, _terms_of(spark), DATES)
    assert _multiplied_last(got) and got.count() == 2 * len(DATES)
