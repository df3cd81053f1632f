"""Property tests: helpers agree with plain Python on random inputs."""

import random
import re
from decimal import ROUND_DOWN, ROUND_HALF_EVEN, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.functions.money import vat_included
from tallyline.functions.text import NUMERIC_TEXT, grouped_int_py, is_numeric_text

_NUM = re.compile(NUMERIC_TEXT)


def _py_numeric(s):
    """The reference accepted what float() accepts; ours is the regex subset."""
    if s is None:
        return False
    try:
        float(s)
    except ValueError:
        return False
    return bool(_NUM.match(s))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" +-.e0123456789abn_", max_size=8)), min_size=1, max_size=60))
def test_numeric_text_matches_python_subset(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.selectExpr(is_numeric_text("x")).collect()]
    assert got == [_py_numeric(v) for v in values]


def test_half_even_whole_numbers_match_python(spark):
    rnd = random.Random(3)
    vals = [Decimal(rnd.randint(-10**9, 10**9)) / 100 for _ in range(2000)] + [Decimal(k) + Decimal("0.5") for k in range(-5, 6)]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(18,2)")
    got = [r[0] for r in df.selectExpr(grouped_int_py("x")).collect()]
    for v, g in zip(vals, got):
        q = v.quantize(Decimal(1), rounding=ROUND_HALF_EVEN)
        exp = f"{int(q):,}".replace(",", " ")
        assert g == exp, v


def test_vat_truncation_on_many_amounts(spark):
    df = spark.range(0, 300000).selectExpr("CAST(id AS DECIMAL(18,0)) / 100 AS amount")
    bad = df.selectExpr("amount", f"{vat_included('amount')} AS vat").where(
        "vat != CAST(CAST(amount * 100 * 5 DIV 105 AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2))"
    )
    assert bad.count() == 0
    sample = df.selectExpr("amount", f"{vat_included('amount')} AS vat").where("amount IN (1.47, 2.94, 1234.56)").collect()
    for r in sample:
        assert r.vat == (r.amount * 5 / 105).quantize(Decimal("0.01"), rounding=ROUND_DOWN)
