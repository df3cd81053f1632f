"""A1: stored months, late leads, and the daily run on them."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest

from tallyline.functions.dates import Calendar
from tallyline.operators import leads
from tallyline.plans import snapshot
from tallyline.rules import RuleSet

from .test_snapshot import SCHEMA

RULES = RuleSet(branch_clients=("1000000001",), dedup_city_clients=("1000000002",), channel_clients=("1000000003",), channel_prefixes=(("c", "C"),))


def some_leads(seed, n, first, days, at=0):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        t = first + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * days - 1))
        sale = Decimal(rnd.randint(0, 5000)) / 100
        out.append(("p", t.date(), t, str(1000000000 + rnd.randint(0, 20)), f"E{rnd.randint(0, 5)}", rnd.choice(["web", "call"]), "c", "n",
                    str(rnd.randint(0, 30)), rnd.choice(["North", "", None]), "b", "s", t, sale, sale, at + i))
    return out


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture()
def stored(spark, scratch):
    path, db = f"{scratch}/leads", "tl_months_" + os.path.basename(scratch).replace("-", "_").lower()
    for k, month in enumerate((dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1))):
        write(spark, path, some_leads(k, 400, month, 28, at=1000 * k))
    write(spark, path, [("p", None, None, "1000000005", "E9", "web", "c", "n", "1", "", "b", "s", None, Decimal(1), Decimal(2), 9000)])
    spark.sql(f"CREATE DATABASE {db}")
    return path, db


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check(spark, path, db, as_of):
    cal, source = Calendar.of(dt.date.fromisoformat(as_of)), spark.read.parquet(path)
    built = snapshot.update(spark, source, RULES, cal, db)
    keyed = leads.enrich_leads(source, RULES)
    assert rows(spark.table(f"{db}.leads_enriched").drop(snapshot.MONTH)) == rows(leads.flag_duplicates(keyed))
    assert rows(snapshot.lead_accounts(spark, source, RULES, cal, db)) == rows(leads.lead_accounts(leads.lead_groups(keyed), cal))
    return built


def test_equal_to_the_full_recompute_at_five_run_dates(spark, stored):
    path, db = stored
    built = check(spark, path, db, "2024-01-10")
    assert built.rebuilt == built.months == ("2023-12", "2024-01", "2024-02", "2024-03", "none")
    for as_of in ("2024-01-31", "2024-02-10", "2024-03-31", "2024-04-02"):
        assert check(spark, path, db, as_of).rebuilt == ()  # nothing came, nothing is built


def test_a_late_lead_rebuilds_its_closed_month_only(spark, stored):
    path, db = stored
    check(spark, path, db, "2024-04-02")
    files = lambda t, m: set(spark.table(f"{db}.{t}").where(f"{snapshot.MONTH} = '{m}'").inputFiles())
    before = {m: (files("leads_enriched", m), files("lead_months", m)) for m in ("2023-12", "2024-01", "2024-02", "2024-03")}
    # earlier than all others of its duplicate group: it becomes the first lead of the group
    late = some_leads(1, 400, dt.datetime(2024, 1, 1), 28, at=1000)[:1]
    t = dt.datetime(2024, 1, 1)
    write(spark, path, [(late[0][0], t.date(), t, *late[0][3:-1], 20000)])
    assert check(spark, path, db, "2024-04-02").rebuilt == ("2024-01",)
    for m, kept in before.items():
        assert ((files("leads_enriched", m), files("lead_months", m)) == kept) == (m != "2024-01")


def test_other_rules_rebuild_all_and_a_lost_mark_its_month(spark, stored):
    path, db = stored
    cal, source = Calendar.of(dt.date(2024, 3, 10)), spark.read.parquet(path)
    snapshot.update(spark, source, RuleSet(), cal, db)
    assert len(check(spark, path, db, "2024-03-10").rebuilt) == 5
    marks = f"{db}.lead_month_marks"
    rest = spark.createDataFrame(spark.table(marks).where("month <> '2024-02'").collect(), "month string, leads long, mark long")
    from tallyline.sinks import tables

    tables.full_refresh(rest, marks)  # as if a run had broken off before its marks
    assert check(spark, path, db, "2024-03-10").rebuilt == ("2024-02",)


def test_rows_of_computed_leads_are_marked_by_content(spark, stored):
    path, db = stored
    cal, made = Calendar.of(dt.date(2024, 3, 10)), spark.createDataFrame(some_leads(5, 200, dt.datetime(2024, 1, 1), 60), SCHEMA)
    assert len(snapshot.update(spark, made, RULES, cal, db).rebuilt) >= 2
    assert snapshot.update(spark, made, RULES, cal, db).rebuilt == ()


def test_the_daily_run_reads_only_open_months_of_the_facts(spark, stored):
    path, db = stored
    cal, source = Calendar.of(dt.date(2024, 3, 10)), spark.read.parquet(path)
    snapshot.update(spark, source, RULES, cal, db)
    plan = snapshot.lead_accounts(spark, source, RULES, cal, db)._jdf.queryExecution().executedPlan().toString()
    facts = [line for line in plan.splitlines() if "PushedFilters" in line and path in line]
    assert facts and all("GreaterThanOrEqual(date_add,2024-02-01)" in line for line in facts)
    marks = snapshot.month_marks(source, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<date_add:date>" in marks
