"""K1-K8 and the streaming incremental ingest (S3)."""

import json
import os
import time

from tallyline.sinks import tables
from tallyline.sources.entity import Col, EntitySpec
from tallyline.streaming.incremental import start_incremental_ingest


def test_full_refresh_append_materialize(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    tables.full_refresh(a, "t_refresh")
    tables.full_refresh(spark.table("t_refresh").where("id = 1"), "t_refresh")  # reads the table it replaces
    assert [r.id for r in spark.table("t_refresh").collect()] == [1]
    tables.append(a, "t_append")
    tables.append(a, "t_append")
    assert spark.table("t_append").count() == 4
    tables.materialize(a, "t_mat")  # create-as-select
    swapped = spark.createDataFrame([("z", 9)], "v2 string, id2 long").selectExpr("id2", "v2")
    tables.materialize(swapped, "t_mat", truncate=False)  # positional insert
    assert sorted((r.id, r.v) for r in spark.table("t_mat").collect()) == [(1, "x"), (2, "y"), (9, "z")]
    tables.materialize(a.where("id = 2"), "t_mat", truncate=True)
    assert [r.id for r in spark.table("t_mat").collect()] == [2]
    # truncate keeps the definition, by position, also from the table itself
    tables.materialize(spark.sql("SELECT CAST(7 AS INT) AS v, 8 AS other"), "t_mat")
    assert spark.table("t_mat").dtypes == [("id", "bigint"), ("v", "string")]
    tables.materialize(spark.table("t_mat").selectExpr("id + 1", "v"), "t_mat")
    assert [tuple(r) for r in spark.table("t_mat").collect()] == [(8, "8")]
    tables.analyze(spark, ["t_mat"])
    assert tables.table_exists(spark, "t_mat") and not tables.table_exists(spark, "t_missing")


def test_bundle_and_json_log(spark, scratch):
    a = spark.createDataFrame([(1, None)], "id long, note string")
    paths = tables.write_bundle({"report": a, "errors": a.limit(0)}, scratch, "2024-01-25")
    assert spark.read.parquet(paths["report"]).count() == 1
    log = os.path.join(scratch, "log")
    tables.append_json_log(a.selectExpr("to_json(named_struct('id', id, 'note', note), map('ignoreNullFields','false')) AS value"), log)
    tables.append_json_log(a, log)  # rows become objects, nulls kept
    assert [r[0] for r in spark.read.text(log).collect()] == ['{"id":1,"note":null}'] * 2


def test_interrupted_definition_change_is_finished(spark):
    a, b = (spark.createDataFrame([(i,)], "id long") for i in (1, 2))
    tables.full_refresh(a, "t_swap")
    tables.full_refresh(b, "t_swap__next")
    spark.sql("DROP TABLE t_swap")  # broke off here: no table t_swap
    tables.recover(spark, "t_swap")
    assert [r.id for r in spark.table("t_swap").collect()] == [2] and not tables.table_exists(spark, "t_swap__next")
    tables.full_refresh(a, "t_swap")
    assert [r.id for r in spark.table("t_swap").collect()] == [1]
    tables.full_refresh(a.selectExpr("id", "'x' AS v"), "t_swap")  # other columns
    assert [tuple(r) for r in spark.table("t_swap").collect()] == [(1, "x")]
    tables.full_refresh(a.selectExpr("id", "'x' AS v"), "t_swap", partition_by=("v",))
    tables.full_refresh(b.selectExpr("id", "'y' AS v"), "t_swap", partition_by=("v",))
    assert [tuple(r) for r in spark.table("t_swap").collect()] == [(2, "y")]


def test_a_polling_reader_always_finds_a_whole_table(spark):
    import threading

    name = "t_polled"
    tables.full_refresh(spark.range(100).selectExpr("id", "0 AS version"), name)
    seen, errors, done = [], [], threading.Event()

    def poll():
        while not done.is_set():
            try:
                seen.append(tuple(spark.table(name).selectExpr("count(*)", "min(version)", "max(version)").first()))
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=poll)
    reader.start()
    for k in range(1, 6):
        time.sleep(0.3)
        tables.full_refresh(spark.range(100).selectExpr("id", f"{k} AS version"), name)
    done.set()
    reader.join()
    assert not errors and len(seen) > 3
    assert all(n == 100 and low == high for n, low, high in seen)
    assert spark.table(name).first().version == 5


def test_old_versions_go_and_a_wrong_count_changes_nothing(spark):
    import pytest

    name = "t_versions"
    for k in range(4):
        tables.full_refresh(spark.range(k + 1), name)
    folder = tables._place(spark, name).removeprefix("file:") + tables.VERSIONS
    assert len(os.listdir(folder)) == 2  # the current one and the one before
    with pytest.raises(ValueError, match="3 rows out of 5"):
        tables.full_refresh(spark.range(3), name, expect=5)
    assert spark.table(name).count() == 4 and len(os.listdir(folder)) == 2
    tables.full_refresh(spark.range(0), name, expect=0)
    assert spark.table(name).count() == 0
    spark.range(2).write.mode("append").saveAsTable(name)
    assert spark.table(name).count() == 2
    tables.drop_table(spark, name)
    assert not os.path.exists(folder) or not os.listdir(folder)


def test_streaming_ingest_only_new_files(spark, scratch):
    spec = EntitySpec(name="inv", columns=(Col("Ref_Key", "invoice_id"), Col("Sum", "amount", "float"), Col("G", "G")),
                      explode_column="G", detail_columns=(Col("N", "line_no", "int"),),
                      header_table="invoice", detail_table="invoice_line")
    landing, out, ckpt = (os.path.join(scratch, p) for p in ("landing", "out", "ckpt"))
    os.makedirs(landing)

    def land(name, doc):
        with open(os.path.join(landing, name), "w") as f:
            json.dump(doc, f)

    land("a.json", {"value": [{"Ref_Key": "a", "Sum": 1, "G": [{"N": 1}, {"N": 2}]}]})
    land("b.json", [{"Ref_Key": "b", "Sum": 2, "G": []}])
    q = start_incremental_ingest(spark, landing, spec, out, checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert sorted(r.invoice_id for r in spark.read.parquet(f"{out}/invoice").collect()) == ["a", "b"]
    assert spark.read.parquet(f"{out}/invoice_line").count() == 3
    time.sleep(1)
    land("c.json", {"value": [{"Ref_Key": "c", "Sum": 3, "G": None}]})
    q = start_incremental_ingest(spark, landing, spec, out, checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert sorted(r.invoice_id for r in spark.read.parquet(f"{out}/invoice").collect()) == ["a", "b", "c"]


def test_daily_run_writes_every_table(spark, scratch):
    from tallyline.plans.pipeline import driver_inputs
    from tallyline.plans.run import run_daily
    from tallyline.sources import driver as D

    from .conftest import SF_SMALL

    rules = D.driver_rules()
    log = os.path.join(scratch, "audit")
    written = run_daily(spark, driver_inputs(spark, SF_SMALL, rules), rules, D.AS_OF, D.RUN_TS, "tl_daily", log)
    counts = {k: spark.table(v).count() for k, v in written.items() if k != "audit_log"}
    assert counts["balance_report"] > 0 and counts["leads_enriched"] > 0
    assert counts["run_summary"] == 1
    assert counts["invoice_outbox"] == counts["invoice_documents"] == spark.read.text(log).count()
    assert counts["out_invoice_report"] == counts["balance_report"]
