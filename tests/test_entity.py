"""S1-S5, N1-N4, P1-P4 on landed files."""

import json
import os

import pytest

from tallyline.sources import entity
from tallyline.sources.entity import Col, EntitySpec
from tallyline.sources.sheet import read_sheet_csv

SPEC = EntitySpec(
    name="invoice",
    columns=(Col("Ref_Key", "invoice_id"), Col("Date", "invoice_dt", "datetime"), Col("Sum", "amount", "float"),
             Col("Goods", "Goods")),
    explode_column="Goods",
    detail_columns=(Col("LineNumber", "line_no", "int"), Col("Content", "nomenclature_text"), Col("Sum", "amount", "float")),
    header_table="invoice", detail_table="invoice_line",
)


def _land(path, docs):
    os.makedirs(path, exist_ok=True)
    for i, d in enumerate(docs):
        with open(os.path.join(path, f"part-{i}.json"), "w") as f:
            json.dump(d, f, ensure_ascii=False)


DOCS = [
    {"value": [
        {"Ref_Key": "a", "Date": "2024-01-05T10:00:00", "Sum": 10.5, "Goods": [
            {"LineNumber": "1", "Content": "Оплата стоимости лидов", "Sum": 10.5}]},
        {"Ref_Key": "b", "Date": "0001-01-01T00:00:00", "Sum": None, "Goods": []},
    ]},
    [
        {"Ref_Key": "c", "Date": "", "Sum": "7", "Goods": None},
        {"Ref_Key": "d", "Date": "0000-00-00 00:00:00", "Sum": 1, "Goods": [
            {"LineNumber": 1, "Content": "SMM", "Sum": 1}, {"LineNumber": 2, "Content": None, "Sum": None}]},
        {"Ref_Key": "e", "Date": "garbage"},
    ],
]


def test_envelope_and_bare_list(spark, scratch):
    _land(scratch, DOCS)
    rec = entity.read_entity_files(spark, scratch, SPEC)
    header, detail = entity.ingest(rec, SPEC)
    h = {r.invoice_id: r for r in header.collect()}
    assert set(h) == {"a", "b", "c", "d", "e"}
    assert "Goods" not in header.columns  # N4
    assert h["a"].invoice_dt.isoformat() == "2024-01-05T10:00:00"
    assert all(h[k].invoice_dt is None for k in "bcde")  # sentinels, year 1, garbage
    assert h["b"].amount == 0.0 and h["c"].amount == 7.0  # P2: NULL -> 0
    d = sorted((r.invoice_id, r.line_no, r.nomenclature_text, r.amount) for r in detail.collect())
    assert d == [("a", 1, "Оплата стоимости лидов", 10.5), ("b", 0, None, 0.0), ("c", 0, None, 0.0),
                 ("d", 1, "SMM", 1.0), ("d", 2, None, 0.0), ("e", 0, None, 0.0)]  # C17


def test_line_classifier_on_detail(spark, scratch):
    from tallyline import labels as L

    spec = EntitySpec(**{**SPEC.__dict__, "classify_detail": L.LINE_CATEGORIES})
    _land(scratch, DOCS)
    rows = entity.detail_rows(entity.read_entity_files(spark, scratch, spec), spec).collect()
    cats = {(r.invoice_id, r.line_no): r.nomenclature_text_gr for r in rows}
    assert cats[("a", 1)] == "Лиды" and cats[("d", 1)] == "SMM" and cats[("d", 2)] == L.CATEGORY_DEFAULT


def test_parent_key_must_exist(spark):
    spec = EntitySpec(name="x", columns=(Col("Other", "o"), Col("L", "L")), ref_key="Ref_Key", explode_column="L",
                      detail_columns=(Col("a", "a"),))
    df = spark.createDataFrame([], entity.record_schema(spec))
    with pytest.raises(ValueError):
        entity.detail_rows(df, spec)


def test_incremental_cutoff(spark, scratch):
    import datetime as dt

    _land(scratch, DOCS)
    header = entity.header_rows(entity.read_entity_files(spark, scratch, SPEC), SPEC)
    assert [r.invoice_id for r in entity.incremental(header, "invoice_dt", dt.datetime(2024, 1, 5, 10)).collect()] == []
    assert [r.invoice_id for r in entity.incremental(header, "invoice_dt", dt.datetime(2024, 1, 1)).collect()] == ["a"]


def test_sheet_csv_with_human_headers(spark, scratch):
    path = os.path.join(scratch, "sheet.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('Ответственный,Юр. лицо (ИП/ООО),ИНН,На стопе,Порог остатка,Средний размер депозитов,Депозит,Лишнее\n')
        f.write('Ann,"A, LLC",123456789.0,,100,400,"счет 15 и 30 числа\nкаждого месяца",x\n')
        f.write('Ben,B,1000000002,На стопе,,,,y\n')
    rows = read_sheet_csv(spark, path).orderBy("row_idx").collect()
    assert [r.inn for r in rows] == ["123456789.0", "1000000002"]
    assert rows[0].payment_type == "счет 15 и 30 числа\nкаждого месяца" and rows[0].legal_entity == "A, LLC"
    assert rows[1].payment_type is None and rows[0].row_idx < rows[1].row_idx


def test_bad_number_raises_in_landed_records(spark, scratch):
    """The landed-record flavour raises on bad numeric text (ANSI)."""
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    _land(scratch, [{"value": [{"Ref_Key": "x", "Sum": "12abc", "Goods": []}]}])
    header = entity.header_rows(entity.read_entity_files(spark, scratch, SPEC), SPEC)
    if spark.conf.get("spark.sql.ansi.enabled") == "true":
        with pytest.raises((PySparkException, Py4JJavaError)):
            header.collect()
