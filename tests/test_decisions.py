"""D3-D8, C19, C20, D12/C15, R8-R11 on the driver data and literal rows."""

import datetime as dt
from decimal import Decimal

import pytest

from tallyline import labels as L
from tallyline.operators import decisions
from tallyline.plans.registry import pipeline
from tallyline.rules import RuleSet, SplitRule

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def report(spark):
    return pipeline(spark, SF_SMALL).balance_report.cache()


def test_flag_iff_no_reason(report):
    """The flag is yes exactly when the short reason is empty."""
    bad = report.where(
        f"(new_invoice_flag = '{L.YES}') != (new_invoice_description_short = '')"
    ).count()
    assert bad == 0
    assert report.count() > 0


def test_report_has_58_columns(report):
    assert len(report.columns) == 58


BASE = ("inn string, project string, stop_flg string, payment_type string, deposit_min_value decimal(18,2), "
        "deposit_average_value decimal(18,2), prev_cnt long, interval_sale decimal(28,2), "
        "ig_interval_invoice_corrected decimal(28,2), correction decimal(18,2), ig_curr_invoice decimal(28,2), "
        "partner_id long, contract_id long, partner_name string, legal_entity string, leads_prev_start date, "
        "leads_prev_end date, invoice_curr_start date, invoice_curr_end date")


def base_row(inn, pt=L.DEPOSIT, dmin="100", davg="500", prev=3, sale="50", corr_inv="200", corr=None, curr=None,
             pid=1, cid=1, project="Ann", stop=None):
    d = dt.date(2024, 1, 1)
    dec = lambda v: None if v is None else Decimal(v)
    return (inn, project, stop, pt, dec(dmin), dec(davg), prev, dec(sale), dec(corr_inv), dec(corr), dec(curr),
            pid, cid, "P", "E", d, d, d, d)


def test_amount_and_flag_boundaries(spark):
    rules = RuleSet(excluded_clients=("x",))
    rows = [
        base_row("above", corr_inv="200", sale="50"),   # balance 150 > min 100: blocked, amount 0
        base_row("equal", corr_inv="150", sale="50"),   # balance 100 == min: flag yes, amount 0 (C20)
        base_row("below", corr_inv="120", sale="50"),   # 70: yes, average deposit
        base_row("negative", corr_inv="10", sale="50"),  # -40: yes, average + 40
        base_row("postpay", pt=L.WEEKLY, corr_inv="10", sale="50"),  # sale - invoices
        base_row("invoiced", curr="5"),                  # current invoice blocks
        base_row("noleads", prev=0),
        base_row("nopartner", corr_inv="0", pid=None),
        base_row("x", corr_inv="0"),                    # excluded: amount still computed (C20): 500 + 50
        base_row("stopped", corr_inv="0", stop=L.STOP_FLAG),
        base_row("noterms", corr_inv="0", project=L.NO_INFO_PROJECT),
    ]
    out = {r.inn: r for r in decisions.decision_columns(spark.createDataFrame(rows, BASE), rules).collect()}
    assert out["above"].new_invoice_flag == L.NO and out["above"].new_invoice_description_short == L.REASON_ABOVE_MIN
    assert out["equal"].new_invoice_flag == L.YES and out["equal"].new_invoice_amount == 0
    assert out["below"].new_invoice_amount == Decimal("500")
    assert out["negative"].new_invoice_amount == Decimal("540")
    assert out["postpay"].new_invoice_amount == Decimal("40")
    assert out["invoiced"].new_invoice_description_short == L.REASON_ALREADY_INVOICED
    assert out["noleads"].new_invoice_description_short == L.REASON_NO_LEADS
    assert out["nopartner"].new_invoice_description_short == L.REASON_ACCOUNTING_SETUP
    assert out["nopartner"].new_invoice_errors == L.ERR_SETUP_HEAD + L.ERR_SETUP_PARTNER + L.ERR_SETUP_BLANK
    assert out["x"].new_invoice_description_short == L.REASON_EXCLUDED and out["x"].new_invoice_amount == Decimal("550")
    assert out["stopped"].new_invoice_description_short == L.REASON_STOPPED
    assert out["noterms"].new_invoice_description_short == L.REASON_NO_TERMS
    assert out["invoiced"].new_invoice_description_long.endswith(L.LONG_ALREADY_AMOUNT + "5")


def test_split_parts_add_up(spark):
    rules = RuleSet(split_rules=(SplitRule("c", 1, 0.5), SplitRule("c", 2, 0.5, "p2", "k2"),
                                 SplitRule("d", 1, 0.3), SplitRule("d", 2, 0.3), SplitRule("d", 3, 0.4)))
    df = spark.createDataFrame(
        [("c", Decimal("1277.57"), 1, 1), ("d", Decimal("100.01"), 1, 1), ("e", Decimal("9.99"), 1, 1)],
        "inn string, new_invoice_amount decimal(18,2), partner_id long, contract_id long",
    )
    out = decisions.split_invoices(df, rules).collect()
    by = {}
    for r in out:
        by.setdefault(r.inn, []).append(r)
    assert sum(r.new_invoice_amount for r in by["c"]) == Decimal("1277.57")
    assert sorted(r.new_invoice_amount for r in by["c"]) == [Decimal("638.78"), Decimal("638.79")]
    assert {(r.partner_id, r.contract_id) for r in by["c"]} == {("1", "1"), ("p2", "k2")}
    assert sum(r.new_invoice_amount for r in by["d"]) == Decimal("100.01") and len(by["d"]) == 3
    assert len(by["e"]) == 1 and by["e"][0].share == 1.0


def test_split_rules_must_sum_to_one():
    with pytest.raises(ValueError):
        RuleSet(split_rules=(SplitRule("c", 1, 0.5), SplitRule("c", 2, 0.4)))


def test_alert_window():
    assert decisions.in_alert_window(dt.datetime(2024, 1, 1, 9, 50))
    assert decisions.in_alert_window(dt.datetime(2024, 1, 1, 11, 50))
    assert not decisions.in_alert_window(dt.datetime(2024, 1, 1, 11, 51))


def test_alert_gate_prunes_outside_window(spark, report):
    gated = decisions.gate_alerts(report, dt.datetime(2024, 1, 1, 8, 0))
    assert gated.count() == 0
    plan = gated._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan  # folded to an empty relation: nothing scanned


def test_pandas_null_semantics(spark):
    """NULL stop flag is 'not stopped'; NULL project is not 'no info'."""
    rows = [("1", None, L.NO, 1, Decimal("5"), None, 1, "Ann", L.WEEKLY, Decimal("-1"), Decimal("0"))]
    df = spark.createDataFrame(rows, "inn string, stop_flg string, new_invoice_flag string, prev_cnt long, "
                               "interval_sale decimal(18,2), partner_id long, contract_id long, project string, "
                               "payment_type string, interval_invoices_minus_leads decimal(18,2), "
                               "deposit_min_value decimal(18,2)")
    assert decisions.select_errors(df, RuleSet()).count() == 1  # partner missing
    assert decisions.select_warnings(df.withColumn("partner_id", df.contract_id), RuleSet()).count() == 1


def test_corrected_is_at_least_invoices_and_receipts(spark):
    agg = pipeline(spark, SF_SMALL).invoices_agg
    bad = agg.where(
        "interval_invoice_corrected < greatest(interval_invoice, interval_receipt) "
        "OR total_invoice_corrected < greatest(total_invoice, total_receipt)"
    )
    assert bad.count() == 0 and agg.count() > 0


def test_duplicate_correction_key_fails_loudly(spark):
    """A duplicate key in a side table raises inside the job."""
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    from tallyline.operators.balance import unique_lookup

    df = spark.createDataFrame([("1", "", "", Decimal("1")), ("1", "", "", Decimal("2")), ("2", "", "", Decimal("3"))],
                               "inn string, city_invoice string, source_invoice string, correction decimal(18,2)")
    looked = unique_lookup(df, ("inn", "city_invoice", "source_invoice"), ["correction"], "deposit corrections")
    with pytest.raises((PySparkException, Py4JJavaError)) as err:
        looked.collect()
    assert "duplicate key in deposit corrections" in str(err.value)
    ok = unique_lookup(df.where("inn = '2'"), ("inn", "city_invoice", "source_invoice"), ["correction"], "x")
    assert [r.correction for r in ok.collect()] == [Decimal("3")]


def test_warning_boundary_twice_minimum(spark):
    """Deposit balance exactly 2 x minimum warns; just above does not."""
    rows = [("a", Decimal("200")), ("b", Decimal("200.01")), ("c", Decimal("-0.01"))]
    df = spark.createDataFrame(rows, "inn string, interval_invoices_minus_leads decimal(18,2)").selectExpr(
        "*", "CAST(NULL AS STRING) AS stop_flg", f"'{L.NO}' AS new_invoice_flag", "'Ann' AS project", "1L AS partner_id",
        "1L AS contract_id", "2L AS prev_cnt",
        f"CASE WHEN inn = 'c' THEN '{L.WEEKLY}' ELSE '{L.DEPOSIT}' END AS payment_type",
        "CAST(100 AS decimal(18,2)) AS deposit_min_value")
    got = sorted(r.inn for r in decisions.select_warnings(df, RuleSet()).collect())
    assert got == ["a", "c"]  # c: any terms, balance below zero


def test_rules_json_loader(tmp_path):
    import json

    from tallyline.__main__ import _rules_from_json

    path = tmp_path / "rules.json"
    path.write_text(json.dumps({
        "lead_key_remap": [["1", "2"]], "excluded_clients": ["9"],
        "split_rules": [{"inn": "5", "part_no": 1, "share": 0.5}, {"inn": "5", "part_no": 2, "share": 0.5}],
        "line_categories": [["contains", ["x"], "X"]],
    }))
    r = _rules_from_json(str(path))
    assert r.lead_key_remap == (("1", "2"),) and r.excluded_clients == ("9",)
    assert len(r.split_rules) == 2 and r.line_categories == (("contains", ("x",), "X"),)
