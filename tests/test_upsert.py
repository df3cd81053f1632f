"""S3 + K5 keyed loads, S1 refusals, S7 side by side."""

import datetime as dt
import json
import os

import pytest

from tallyline.plans import ingest
from tallyline.plans.ingest import IngestError, Landing, ingest_all
from tallyline.sinks import upsert
from tallyline.sources import entity
from tallyline.sources.entity import Col, EntitySpec

SPEC = EntitySpec(
    name="doc", columns=(Col("Ref_Key", "id"), Col("Date", "dated", "datetime"), Col("Sum", "amount", "int"), Col("G", "G")),
    explode_column="G", detail_columns=(Col("N", "line_no", "int"),), header_table="doc", detail_table="doc_line",
)
CUT = dt.datetime(2024, 1, 1)


def land(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump({"value": records}, f)
    return folder


def rec(key, date, total, *lines):
    return {"Ref_Key": key, "Date": date, "Sum": total, "G": [{"N": n} for n in lines]}


def rows(spark, db):
    header = sorted((r.id, str(r.dated)[:10], r.amount) for r in spark.table(f"{db}.doc").collect())
    return header, sorted((r.id, r.line_no) for r in spark.table(f"{db}.doc_line").collect())


@pytest.fixture()
def db(spark, scratch):
    return "tl_" + os.path.basename(scratch).replace("-", "_").lower()


def test_a_load_twice_is_a_load_once(spark, scratch, db):
    a = land(f"{scratch}/a", "1.json", [rec("x", "2024-01-05", 1, 1, 2), rec("y", "2024-02-05", 2, 1), rec("z", "2023-01-01", 3, 1)])
    landing = Landing(SPEC, a, cutoff_field="Date", cutoff=CUT)
    ingest_all(spark, [landing], db)
    once = rows(spark, db)
    assert once == ([("x", "2024-01-05", 1), ("y", "2024-02-05", 2)], [("x", 1), ("x", 2), ("y", 1)])
    ingest_all(spark, [landing], db)
    assert rows(spark, db) == once and spark.table(f"{db}.{upsert.LEDGER}").count() == 1
    # without the ledger (a crash before it was written) the merge alone holds
    spark.sql(f"DROP TABLE {db}.{upsert.LEDGER}")
    ingest_all(spark, [landing], db)
    assert rows(spark, db) == once


def test_newer_versions_replace_documents_and_their_lines(spark, scratch, db):
    a = land(f"{scratch}/a", "1.json", [rec("x", "2024-01-05", 1, 1, 2), rec("y", "2024-02-05", 2, 1), rec("w", "2024-03-01", 4, 7)])
    ingest_all(spark, [Landing(SPEC, a, cutoff_field="Date", cutoff=CUT)], db)
    # x twice in one batch (the later date counts) and in another month; y without lines; w as it was
    b = land(f"{scratch}/b", "1.json", [rec("x", "2024-01-06", 8, 5), rec("x", "2024-04-06", 9, 6), rec("y", "2024-02-07", 3)])
    ingest_all(spark, [Landing(SPEC, b, cutoff_field="Date", cutoff=CUT)], db)
    assert rows(spark, db) == (
        [("w", "2024-03-01", 4), ("x", "2024-04-06", 9), ("y", "2024-02-07", 3)],
        [("w", 7), ("x", 6), ("y", 0)],
    )
    months = {r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.doc").collect()}
    assert months == {"doc_month=2024-02", "doc_month=2024-03", "doc_month=2024-04"}


def test_only_touched_months_are_written(spark, scratch, db):
    a = land(f"{scratch}/a", "1.json", [rec("x", "2024-01-05", 1), rec("y", "2024-02-05", 2)])
    ingest_all(spark, [Landing(SPEC, a, cutoff_field="Date", cutoff=CUT)], db)
    files = lambda m: set(spark.table(f"{db}.doc").where(f"doc_month = '{m}'").inputFiles())
    before = files("2024-01"), files("2024-02")
    b = land(f"{scratch}/b", "1.json", [rec("y", "2024-02-06", 5)])
    ingest_all(spark, [Landing(SPEC, b, cutoff_field="Date", cutoff=CUT)], db)
    assert files("2024-01") == before[0] and not files("2024-02") & before[1]


def test_tables_of_a_full_load_take_merges(spark, scratch, db):
    a = land(f"{scratch}/a", "1.json", [rec("x", "2024-01-05", 1, 1), rec("n", None, 7, 3)])
    ingest_all(spark, [Landing(SPEC, a)], db)
    b = land(f"{scratch}/b", "1.json", [rec("x", "2024-01-07", 2, 4, 5)])
    ingest_all(spark, [Landing(SPEC, b, cutoff_field="Date", cutoff=CUT)], db)
    assert rows(spark, db) == ([("n", "None", 7), ("x", "2024-01-07", 2)], [("n", 3), ("x", 4), ("x", 5)])


@pytest.mark.parametrize("text, why", [
    ('{"odata.error": {"code": "x"}}', entity.NO_RECORDS),
    ('{"value": null}', entity.NO_RECORDS),
    ('{"value": [{"Ref_Key": "q", "Su', entity.MALFORMED),
])
def test_refused_documents_change_nothing_and_are_listed(spark, scratch, db, text, why):
    a = land(f"{scratch}/a", "1.json", [rec("x", "2024-01-05", 1, 1)])
    ingest_all(spark, [Landing(SPEC, a)], db)
    before = rows(spark, db)
    land(a, "2.json", [rec("y", "2024-01-05", 1, 1)])
    with open(f"{a}/bad.json", "w") as f:
        f.write(text)
    with pytest.raises(IngestError, match="no entity set"):
        ingest_all(spark, [Landing(SPEC, a)], db)
    assert rows(spark, db) == before
    (listed,) = spark.table(f"{db}.{ingest.QUARANTINE}").collect()
    assert (listed.entity, listed.refused) == ("doc", why) and listed.file.endswith("bad.json")
    with pytest.raises(Exception, match="without records|[Mm]alformed"):  # the plain reader stops, too
        entity.read_entity_files(spark, f"{a}/bad.json", SPEC).collect()


def test_an_empty_set_is_one(spark, scratch, db):
    ingest_all(spark, [Landing(SPEC, land(f"{scratch}/a", "1.json", []))], db)
    assert rows(spark, db) == ([], [])


def test_a_bad_set_fails_alone(spark, scratch, db):
    import dataclasses

    good = [Landing(dataclasses.replace(SPEC, name=f"s{i}", header_table=f"s{i}", detail_table=""), land(f"{scratch}/{i}", "1.json", [rec("x", "2024-01-05", i)]))
            for i in range(5)]
    bad = Landing(dataclasses.replace(SPEC, name="bad", header_table="bad"), f"{scratch}/nowhere")
    with pytest.raises(IngestError) as e:
        ingest_all(spark, [good[0], bad, *good[1:]], db, parallel=3)
    assert set(e.value.errors) == {"bad"} and set(e.value.written) == {f"s{i}" for i in range(5)}
    assert all(spark.table(f"{db}.s{i}").first().amount == i for i in range(5))


def test_records_with_a_field_named_value(spark, scratch):
    spec = EntitySpec(name="v", columns=(Col("Ref_Key", "id"), Col("value", "v", "int")))
    land(scratch, "1.json", [{"Ref_Key": "a", "value": 1}, {"Ref_Key": "b", "value": 2}])
    with open(f"{scratch}/2.json", "w") as f:
        json.dump([{"Ref_Key": "c", "value": 3}], f)
    header = entity.header_rows(entity.read_entity_files(spark, scratch, spec), spec)
    assert sorted((r.id, r.v) for r in header.collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_elements_without_a_mapping_keep_all_fields(spark, scratch):
    spec = EntitySpec(name="u", columns=(Col("Ref_Key", "id"), Col("G", "G")), explode_column="G")
    land(scratch, "1.json", [{"Ref_Key": "a", "G": [{"N": 1, "T": "x"}, {"T": "y", "Odd name": 2.5}]}, {"Ref_Key": "b", "G": []}])
    detail = entity.detail_rows(entity.read_entity_files(spark, scratch, spec), spec)
    assert detail.columns == ["id", "N", "Odd name", "T"]
    assert sorted(map(tuple, detail.collect()), key=str) == sorted([("a", "1", None, "x"), ("a", None, "2.5", "y"), ("b", None, None, None)], key=str)
