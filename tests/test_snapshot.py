"""SURVEY §4/§5: monthly snapshot + open months == full recompute."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from tallyline.functions.dates import Calendar
from tallyline.operators import leads
from tallyline.rules import RuleSet

SCHEMA = ("project string, date_add date, date_time_add timestamp_ntz, inn string, legal_entity string, "
          "source string, company string, name string, phone string, city string, branch string, "
          "send_status string, send_date_time timestamp_ntz, purchase decimal(18,2), sale decimal(18,2), lead_id long")


@pytest.fixture(scope="module")
def keyed(spark):
    rnd = random.Random(11)
    rows = []
    start = dt.datetime(2023, 11, 1)
    for i in range(4000):
        t = start + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 150))
        sale = None if rnd.random() < 0.05 else Decimal(rnd.randint(0, 5000)) / 100
        purchase = None if sale is None else (sale * Decimal("0.6")).quantize(Decimal("0.01"))
        rows.append(("p", t.date(), t, str(1000000000 + rnd.randint(0, 30)), f"E{rnd.randint(0, 5)}",
                     rnd.choice(["web", "call", "click"]), "c", "n", str(rnd.randint(0, 40)),
                     rnd.choice(["North", "South", "", None]), "b", "s", t, purchase, sale, i))
    rules = RuleSet(branch_clients=("1000000001", "1000000002"), dedup_city_clients=("1000000002",),
                    channel_clients=("1000000003",), channel_prefixes=(("c", "C"),))
    return leads.enrich_leads(spark.createDataFrame(rows, SCHEMA), rules).cache()


def _rows(df):
    return sorted((tuple(r) for r in df.drop("latest").collect()), key=repr)


@pytest.mark.parametrize("as_of", ["2024-01-01", "2024-02-14", "2024-03-16", "2024-03-31", "2024-04-02"])
def test_snapshot_plus_open_months_equals_full(spark, keyed, as_of):
    cal = Calendar.of(dt.date.fromisoformat(as_of))
    groups = leads.lead_groups(keyed)
    full = leads.lead_accounts(groups, cal)
    snap = leads.month_snapshot(groups, leads.snapshot_boundary(cal))
    inc = leads.lead_accounts_incremental(snap, keyed, cal)
    assert _rows(inc) == _rows(full)
    latest_full = {r.inn: r.latest for r in full.collect()}
    latest_inc = {r.inn: r.latest for r in inc.collect()}
    assert latest_full == latest_inc
    assert snap.count() > 0 or as_of == "2024-01-01"


def test_open_month_filter_reaches_the_scan(spark, scratch):
    """On a leads table stored with a date column, the open-month filter of
    the incremental path is pushed to the parquet scan."""
    import os

    path = os.path.join(scratch, "leads")
    rows = [("p", dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 1), "1000000001", "E", "web", "c", "n", "1", "", "b",
             "s", dt.datetime(2024, 1, 5, 1), Decimal("1.00"), Decimal("2.00"), 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    keyed = leads.enrich_leads(spark.read.parquet(path), RuleSet())
    cal = Calendar.of(dt.date(2024, 3, 10))
    inc = leads.lead_accounts_incremental(leads.month_snapshot(leads.lead_groups(keyed), leads.snapshot_boundary(cal)),
                                          keyed, cal)
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date_add,2024-02-01)" in plan
