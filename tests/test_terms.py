"""W6, P5-P10, W3, U1 on hand-made sheet rows (FIXTURES.md §4 terms)."""

import random
from decimal import Decimal

import pytest

from tallyline import labels as L
from tallyline.operators import terms
from tallyline.rules import RuleSet

SCHEMA = ("row_idx long, project string, legal_entity string, inn string, stop_flg string, "
          "deposit_min_value string, deposit_average_value string, payment_type string")
ROWS = [
    (0, "Ann", "A", "1000000001", None, "100", "400", None),  # leading blank -> '?' -> both numeric -> deposit
    (1, "Ann", "B", "1000000002", "На стопе", "100", "400", "депозит"),
    (2, "Ann", "C", "1000000003", None, "x", "y", None),  # blank after a value -> filled 'депозит'
    (3, "Ben", "D", "200000001.0", None, None, "10000-20000", "постоплата за месяц"),  # '.0' id + 9 chars
    (4, "Ben", "E", "abc", None, "1", "-5", "оплата с агентских"),  # non-numeric id
    (5, "Cat", "F", "1000000006", None, "5", None, "something unknown"),  # unknown -> weekly + note
    (6, "Cat", "G", "1000000001", None, "7", "8", "счет 15 и 30 числа\nкаждого месяца"),  # duplicate client
    (7, "Dan", "H", "1000000007", " НА СТОПЕ ", "postpay", "1", "депозит   "),  # alias with blanks
    (8, "Dan", "I", "1000000008", None, "12", " 2500 ", "депозит / была постоплата"),
]


@pytest.fixture()
def sheet(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_forward_fill_forms_agree_with_python(spark):
    rnd = random.Random(7)
    vals = [None if rnd.random() < 0.6 else f"v{i}" for i in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "row_idx long, payment_type string")
    expected, last = [], None
    for v in vals:
        last = v if v is not None else last
        expected.append(last)
    for df2 in (terms.forward_fill(df, "payment_type"),
                terms.forward_fill_two_phase(df, "payment_type", block_rows=1),
                terms.forward_fill_two_phase(df, "payment_type", block_rows=97),
                terms.forward_fill_two_phase(df.repartition(7), "payment_type", block_rows=1000)):
        got = [r.payment_type for r in df2.orderBy("row_idx").collect()]
        assert got == expected


def test_clean_terms_rows(sheet):
    out = {r.row_idx: r for r in terms.clean_terms(sheet, RuleSet()).collect()}
    assert out[0].payment_type == L.DEPOSIT and out[0].comment == L.NOTE_SET_DEPOSIT
    assert out[0].deposit_min_value == Decimal("100.00") and out[0].deposit_average_value == Decimal("400.00")
    assert out[1].stop_flg == "На стопе"  # as the sheet spells it
    assert out[2].payment_type == L.DEPOSIT  # forward-filled before the '?' marker
    assert out[2].deposit_min_value == L.DEFAULT_DEPOSIT_MIN and out[2].comment == L.NOTE_MIN_DEFAULT + L.NOTE_AVG_DEFAULT
    assert out[3].inn == "0200000001" and out[3].payment_type == L.MONTHLY
    assert out[3].deposit_min_value == 0 and out[3].comment == L.NOTE_AVG_DASH
    assert out[4].inn == "abc" and out[4].comment == L.NOTE_BAD_INN and out[4].payment_type == L.WEEKLY
    assert out[5].payment_type == L.WEEKLY and out[5].comment == L.NOTE_SET_WEEKLY
    assert out[6].payment_type == L.SEMI_MONTHLY
    assert out[7].payment_type == L.DEPOSIT and out[7].stop_flg == " НА СТОПЕ "
    assert out[7].deposit_min_value == L.DEFAULT_DEPOSIT_MIN and out[7].deposit_average_value == Decimal("1.00")
    assert out[8].deposit_average_value == Decimal("2500.00") and out[8].comment == ""


def test_question_mark_branches(spark):
    rows = [
        (0, "p", "e", "1000000001", None, L.SHEET_POSTPAY, "1", None),
        (1, "p", "e", "1000000002", None, "1", L.SHEET_STOPPED, "?"),
        (2, "p", "e", "1000000003", None, "1", "10-20", "?"),  # range is not numeric in the type step
    ]
    out = {r.row_idx: r for r in terms.clean_terms(spark.createDataFrame(rows, SCHEMA), RuleSet()).collect()}
    assert [out[i].payment_type for i in range(3)] == [L.WEEKLY] * 3
    assert out[2].comment == L.NOTE_SET_WEEKLY + L.NOTE_AVG_DASH


def test_dedup_and_union(spark, sheet):
    clean = terms.clean_terms(sheet, RuleSet())
    dedup = {r.inn: r for r in terms.dedup_terms(clean).collect()}
    assert dedup["1000000001"].payment_type == min(L.DEPOSIT, L.SEMI_MONTHLY)  # lowest text wins
    latest = spark.createDataFrame([("1000000001", "X"), ("1999999999", "New client"), (None, "no key")],
                                   "inn string, legal_entity string")
    missing = terms.missing_clients(latest, clean)
    assert {r.inn for r in missing.collect()} == {"1999999999", None}
    allt = {r.inn: r for r in terms.terms_all(terms.dedup_terms(clean), missing).collect()}
    assert allt["1999999999"].project == L.NO_INFO_PROJECT and allt["1999999999"].payment_type == L.WEEKLY
    assert allt["1999999999"].comment == L.NOTE_FILL_SHEET and allt["1999999999"].stop_flg is None
