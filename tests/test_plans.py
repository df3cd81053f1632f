"""Plan-shape guards for the scale design (skew, pushdown, no fact joins)."""

from tallyline.operators import invoices, leads
from tallyline.plans.registry import pipeline

from .conftest import SF_SMALL


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_aggregates_before_the_shuffle(spark):
    """A hot duplicate key collapses map-side: partial aggregate, then Exchange."""
    p = pipeline(spark, SF_SMALL)
    plan = _physical(leads.lead_groups(p.leads_keyed))
    assert "partial_min" in plan and "partial_max" in plan
    assert plan.index("partial_min") > plan.index("Exchange")  # printed top-down: partial sits below the shuffle


def _sorted_after_dealing(plan: str) -> bool:
    """The pick's partial aggregate lies above the exchange that deals rows out."""
    return "REPARTITION_BY_COL" in plan and plan.rindex("partial_min") < plan.index("REPARTITION_BY_COL")


def test_scan_tasks_do_not_sort_the_facts(spark):
    """A sort-based aggregate over a scan would hold a whole file in one task."""
    p = pipeline(spark, SF_SMALL)
    assert _sorted_after_dealing(_physical(leads.lead_groups(p.leads_keyed)))
    assert _sorted_after_dealing(_physical(invoices.top_line(p.invoice_lines)))
    assert _sorted_after_dealing(_physical(p.billable_invoices)) and _sorted_after_dealing(_physical(p.invoices_enriched))


def test_an_invoice_of_very_many_lines_lies_in_several_parts(spark):
    lines = spark.range(1000).selectExpr(
        "id DIV 1000 AS invoice_id", "CAST(id AS INT) AS line_no", "concat('t', id) AS nomenclature_text", "'c' AS nomenclature_text_gr",
        "CAST(id % 7 AS DECIMAL(18,2)) AS amount")
    dealt = invoices.dealt_lines(lines)
    by = _physical(dealt).split("Exchange hashpartitioning(")[1].split("REPARTITION")[0]
    assert by.count("#") == 2  # invoice and line number
    assert [tuple(r) for r in invoices.top_line(dealt).collect()] == [(0, "t6", "c")]


def test_dedup_flags_read_the_leads_once(spark):
    """One scan and one shuffle of full rows, shared by the readers of it."""
    p = pipeline(spark, SF_SMALL)
    flagged = leads.flag_duplicates(p.leads_keyed)
    flagged.collect()
    plan = _physical(flagged).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan and plan.count("FileScan") == 1 and "ReusedExchange" in plan
    full = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert sum("REPARTITION_BY_COL" in line for line in full) == 1
    assert "RoundRobin" not in plan
    # only (group, salt, time, id) moves besides
    assert all("_group" in line for line in full) and len(full) <= 3


def test_period_aggregate_never_joins_the_fact_table(spark):
    """The leads measures aggregate before any join with the terms table."""
    p = pipeline(spark, SF_SMALL)
    acc = leads.lead_accounts(leads.lead_groups(p.leads_keyed), p.cal)
    plan = _optimized(acc)
    assert "payment_type" not in plan and plan.count("Join") <= 1  # the rule table


def test_scan_prunes_columns_and_pushes_filters(spark):
    p = pipeline(spark, SF_SMALL)
    plan = _physical(p.inputs["invoice"].where("is_posted").select("invoice_id"))
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in scan
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,O))]" in scan


def test_small_rule_tables_do_not_shuffle_the_facts(spark):
    """Keyed rules are a local relation of known size: Spark broadcasts a
    small one by its own threshold, without a hint."""
    p = pipeline(spark, SF_SMALL)
    plan = _physical(p.leads_keyed)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "ResolvedHint" not in p.leads_keyed._jdf.queryExecution().analyzed().toString()


def test_daily_run_reads_the_facts_once(spark):
    """After a derived table is saved, nothing behind it reads the facts."""
    from tallyline.plans.pipeline import Pipeline

    base = pipeline(spark, SF_SMALL)
    p = Pipeline(base.inputs, base.rules, base.as_of, cut_lineage=False)
    saved = {n: getattr(p, n) for n in ("leads_enriched", "invoices_enriched")}
    q = Pipeline(base.inputs, base.rules, base.as_of, cut_lineage=False)
    for n, df in saved.items():
        df.createOrReplaceTempView(f"saved_{n}")
        q.use_saved(n, spark.createDataFrame([], df.schema))
    plan = _optimized(q.balance_report)
    assert "lineitem" not in plan and "events" not in plan


def test_shared_stages_are_materialised_once(spark):
    """The account aggregate and terms calendar are read back from parquet
    under spark.checkpoint.dir, so the report reads the fact table's
    aggregate, not the fact table, for them."""
    p = pipeline(spark, SF_SMALL)
    root = spark.sparkContext.getCheckpointDir()
    for df in (p.lead_accounts, p.payment_terms_calendar):
        files = df.inputFiles()
        assert files and all("tallyline-stages" in f for f in files)
        assert all(f.startswith(root) or root.split(":", 1)[-1] in f for f in files)


def test_a_changed_folder_gets_a_new_pipeline(spark, scratch):
    import os
    import shutil

    for name in os.listdir(SF_SMALL):
        shutil.copy(os.path.join(SF_SMALL, name), scratch)
    first = pipeline(spark, scratch)
    assert pipeline(spark, scratch) is first
    os.utime(os.path.join(scratch, "events.parquet"), (1, 1))
    assert pipeline(spark, scratch) is not first


def test_the_bundle_takes_its_extracts_from_the_written_report(spark, monkeypatch):
    from tallyline.plans import registry
    from tallyline.plans.pipeline import Pipeline, driver_inputs
    from tallyline.sinks import tables
    from tallyline.sources import driver as D

    plans, plain = {}, tables.write_bundle

    def write(frames, root, as_of):
        plans.update({n: df._jdf.queryExecution().optimizedPlan().toString() for n, df in frames.items()})
        return plain(frames, root, as_of)

    monkeypatch.setattr(tables, "write_bundle", write)
    rules = D.driver_rules()
    registry.q_report_bundle_counts(Pipeline(driver_inputs(spark, SF_SMALL, rules), rules, D.AS_OF))
    assert set(plans) == {"invoice_report", "new_invoices", "errors", "payment_terms"}
    assert "Join" in plans["invoice_report"] and "Join" not in plans["new_invoices"] + plans["errors"]
