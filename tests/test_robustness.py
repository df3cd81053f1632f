"""Inputs that must neither be lost nor stop a run, and those that must."""

import json
import os
from decimal import Decimal

import pytest

from tallyline import labels as L
from tallyline.functions.coerce import coerce_by_word
from tallyline.operators import balance, terms
from tallyline.rules import RuleSet
from tallyline.sources import entity, query, sheet
from tallyline.sources.entity import Col, EntitySpec

SHEET = "row_idx long, project string, legal_entity string, inn string, stop_flg string, deposit_min_value string, deposit_average_value string, payment_type string"


def value(spark, text, word, default=True):
    return spark.createDataFrame([(text,)], "c string").selectExpr(f"{coerce_by_word('c', word, default)} AS v").first().v


def test_whole_numbers_with_a_fraction_are_cut(spark):
    assert [value(spark, t, "int") for t in ("5.0", "12.7", "-3.9", "7", None, "1e3")] == [5, 12, -3, 7, 0, 1000]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, "seven", "int")


def test_offsets_become_utc_and_wall_clocks_stay(spark):
    cases = {
        "2024-01-01T01:00:00+03:00": "2023-12-31 22:00:00",
        "2024-01-01T01:00:00Z": "2024-01-01 01:00:00",
        "2024-01-01T01:00:00": "2024-01-01 01:00:00",
        "2024-01-01": "2024-01-01 00:00:00",
        "0000-00-00": None,
        "no date": None,
    }
    for text, want in cases.items():
        got = value(spark, text, "datetime")
        assert (None if got is None else str(got)) == want, text


def test_malformed_documents_fail(spark, scratch):
    spec = EntitySpec("e", (Col("a", "a"),))
    for name, text in (("good.json", '{"value": [{"a": 1}]}'), ("cut.json", '{"value": [{"a": 1}')):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        entity.read_entity_files(spark, scratch, spec).collect()
    docs = spark.createDataFrame([('{"value": [{"a": 1}]}',), ('{"value": [{"a": 1}',)], "t string")
    with pytest.raises(Exception, match="(?i)malformed"):
        entity.parse_entity_text(docs, "t", spec).collect()


def test_passthrough_keeps_every_field_with_its_type(spark, scratch):
    doc = {"value": [{"Ref_Key": "a", "Sum": 1.5, "G": [{"N": 1, "T": "x"}]}, {"Ref_Key": "b", "Sum": 2, "G": []}]}
    with open(os.path.join(scratch, "a.json"), "w") as f:
        json.dump(doc, f)
    spec = EntitySpec("e", explode_column="G")
    rec = entity.read_entity_files(spark, scratch, spec)
    assert dict(rec.dtypes)["Sum"] == "double" and rec.count() == 2
    assert entity.header_rows(rec, spec).columns == rec.columns
    detail = entity.detail_rows(rec, spec)
    assert sorted(map(tuple, detail.collect()), key=str) == [("a", 1, "x"), ("b", None, None)]


def test_landed_sets_become_tables(spark, scratch):
    from tallyline.plans.ingest import ingest_all, landings_from_json, table_inputs

    with open(os.path.join(scratch, "d.json"), "w") as f:
        json.dump({"value": [{"Ref_Key": "a", "Date": "2024-01-02", "G": [{"N": 1}, {"N": 2}]}, {"Ref_Key": "b", "Date": "2023-01-02", "G": []}]}, f)
    os.makedirs(os.path.join(scratch, "sheet"))
    with open(os.path.join(scratch, "sheet", "s.csv"), "w") as f:
        f.write(",".join(h for h, _, _ in sheet.TERMS_SHEET_COLUMNS) + "\np,e,1,,,,\n")
    conf = [{"name": "inv", "path": os.path.join(scratch, "d.json"), "columns": [["Ref_Key", "id"], ["Date", "dt", "datetime"], ["G", "G"]],
             "explode_column": "G", "detail_columns": [["N", "line_no", "int"]], "header_table": "invoice", "detail_table": "invoice_line"}]
    written = ingest_all(spark, landings_from_json(json.dumps(conf)), "tl_landed", os.path.join(scratch, "sheet"))
    inputs = table_inputs(spark, "tl_landed")
    assert set(written) == {"invoice", "invoice_line", "terms_sheet"}
    assert sorted(r.id for r in inputs["invoice"].collect()) == ["a", "b"]
    assert sorted((r.id, r.line_no) for r in inputs["invoice_line"].collect()) == [("a", 1), ("a", 2), ("b", 0)]
    assert inputs["terms_sheet"].first().project == "p"
    conf[0] |= {"cutoff_field": "Date", "cutoff": "2024-01-01"}  # the later document is there already
    ingest_all(spark, landings_from_json(json.dumps(conf)), "tl_landed")
    assert spark.table("tl_landed.invoice").count() == 2 and spark.table("tl_landed.invoice_line").count() == 3


def test_cut_off_leaves_out_whole_documents(spark):
    rec = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "")], "Ref_Key string, Date string")
    assert [r.Ref_Key for r in entity.incremental_records(rec, "Date", __import__("datetime").datetime(2024, 1, 1)).collect()] == ["b"]


def test_sheet_of_several_files_keeps_their_order(spark, scratch):
    head = ",".join(h for h, _, _ in sheet.TERMS_SHEET_COLUMNS)
    for name, n in (("a.csv", 3), ("b.csv", 30)):
        with open(os.path.join(scratch, name), "w") as f:
            f.write("\n".join([head, *[f"{name}{i},,,,,," for i in range(n)]]))
    got = [r.project for r in sheet.read_sheet_csv(spark, scratch).orderBy("row_idx").collect()]
    assert got == [f"a.csv{i}" for i in range(3)] + [f"b.csv{i}" for i in range(30)]


def test_deposit_cells_of_any_kind(spark):
    cells = ["7000\u00a0", "12345678901234567890", "1e400", "abc"]
    rows = [(i, "p", "e", "1000000001", None, c, "100", L.DEPOSIT) for i, c in enumerate(cells)]
    out = sorted(terms.clean_terms(spark.createDataFrame(rows, SHEET), RuleSet(terms_aliases=((L.DEPOSIT, L.DEPOSIT),))).collect(), key=lambda r: r.row_idx)
    assert out[0].deposit_min_value == Decimal("7000.00") and L.NOTE_MIN_DEFAULT not in out[0].comment
    for r in out[1:]:
        assert r.deposit_min_value == Decimal(L.DEFAULT_DEPOSIT_MIN) and L.NOTE_MIN_DEFAULT in r.comment


def test_null_keys_of_corrections_are_no_duplicates(spark):
    rows = [("a", None, "", 1), ("a", None, "", 2), ("b", "", "", 3)]
    df = spark.createDataFrame(rows, "inn string, city_invoice string, source_invoice string, correction int")
    got = balance.unique_lookup(df, balance.ACCOUNT, ["correction"], "corrections").collect()
    assert [r.correction for r in got] == [3]


def test_external_reads_in_ranges():
    got = query.jdbc_options("jdbc:x", "SELECT 1", "id", 0, 100, 8)
    assert got["dbtable"] == "(SELECT 1) q" and got["numPartitions"] == "8" and "query" not in got
    assert query.jdbc_options("jdbc:x", "SELECT 1")["query"] == "SELECT 1"
    with pytest.raises(ValueError, match="bound"):
        query.jdbc_options("jdbc:x", "SELECT 1", "id")


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from tallyline.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    Session.conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
