"""Rule lists of any length are joined as tables."""

from decimal import Decimal

from tallyline.operators import decisions, leads
from tallyline.rules import RuleSet, SplitRule, with_client_rules, with_lead_rules, with_manager, with_partner_rules

N = 10_000


def many() -> RuleSet:
    k = [f"k{i}" for i in range(N)]
    return RuleSet(
        lead_key_remap=tuple((x, f"m{x}") for x in k), invoice_key_remap=tuple((x, f"i{x}") for x in k),
        branch_clients=tuple(k), branch_default=tuple((x, f"b{x}") for x in k), dedup_city_clients=tuple(k),
        channel_clients=tuple(k), branch_by_partner=tuple((x, "name", f"p{x}") for x in k),
        branch_by_comment=tuple((x, "c", m, f"{m}{x}") for x in k for m in ("eq", "ne")), excluded_clients=tuple(k),
        branch_join_any=tuple(k), manager_contacts=tuple((x, f"@{x}") for x in k),
        split_rules=tuple(SplitRule(x, j, 0.5, f"p{x}" if j == 2 else None) for x in k for j in (1, 2)),
    )


def test_ten_thousand_rules_of_each_kind(spark):
    rules = many()
    df = spark.createDataFrame([("k9999", "", "name", "c"), ("k9999", "x", "other", "c"), ("k0", "x", "other", "d"),
                                ("none", "x", "name", "c"), (None, "x", None, None)], "inn string, city string, name string, note string").coalesce(1)
    lead = with_lead_rules(df, rules).selectExpr(f"{leads.client_key('inn')} AS k", f"{leads.lead_branch('city')} AS b", "_by_city", "_channelled").collect()
    assert [tuple(r) for r in lead[:4]] == [("mk9999", "bk9999", True, True), ("mk9999", "x", True, True), ("mk0", "x", True, True), ("none", "", False, False)]
    assert lead[4].k is None and lead[4].b == ""
    from tallyline.operators.invoices import invoice_branch

    got = with_partner_rules(df, rules, "inn").selectExpr("_pkey", f"{invoice_branch('name', 'note')} AS b").collect()
    assert [tuple(r) for r in got] == [("ik9999", "pk9999"), ("ik9999", "eqk9999"), ("ik0", "nek0"), (None, ""), (None, "")]
    assert [r._excluded for r in with_client_rules(df, rules).collect()] == [True, True, True, False, False]
    assert [r._manager for r in with_manager(df, rules, "inn").collect()] == ["(@k9999)"] * 2 + ["(@k0)", "", ""]


def test_splits_by_join_add_up(spark):
    row = ("k7", "", "", Decimal("10.01"), 5, 6)
    df = spark.createDataFrame([row, ("zz", *row[1:])], "inn string, city_invoice string, source_invoice string, new_invoice_amount decimal(18,2), partner_id long, contract_id long")
    got = sorted((r.inn, r.part_no, r.share, r.new_invoice_amount, r.partner_id) for r in decisions.split_invoices(df, many()).collect())
    assert got == [("k7", 1, 0.5, Decimal("5.01"), "5"), ("k7", 2, 0.5, Decimal("5.00"), "pk7"), ("zz", 1, 1.0, Decimal("10.01"), "5")]


def test_first_rule_of_a_key_holds_and_no_rules_mean_no_join(spark):
    df = spark.createDataFrame([("a",)], "inn string")
    rules = RuleSet(lead_key_remap=(("a", "x"), ("a", "y")))
    assert with_lead_rules(df, rules).first()._remap == "x"
    plan = with_lead_rules(df, RuleSet())._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
