"""New-invoice decision: D4-D8, D12-D14, R8-R11.

The short reason (D5) is built once and the flag (D4) is derived from it, so
"flag is yes iff the reason is empty" (C19) holds by construction.
SQL three-valued logic is kept where the report was SQL (a NULL condition
is not a match); the row filters R8-R10 follow the original pandas masks,
where comparisons with NULL are False and `!=` with NULL is True (C8).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from .. import labels as L
from ..functions.dates import period_text
from ..functions.money import MONEY, vat_included
from ..functions.sqlexpr import case, lit
from ..functions.text import grouped_int_sql
from ..rules import RuleSet, with_client_rules, with_splits
from .balance import balance_expr


def decision_exprs(rules: RuleSet) -> dict[str, str]:
    """Balance, reasons, amount and errors as expressions of the base row."""
    bal = balance_expr("ig_interval_invoice_corrected", "correction", "interval_sale")
    bal_raw = "(coalesce(ig_interval_invoice_corrected, 0) + coalesce(correction, 0) - interval_sale)"
    dep = f"payment_type = {lit(L.DEPOSIT)}"
    excluded = "_excluded"
    stopped = f"lower(trim(stop_flg)) = {lit(L.STOP_FLAG)}"
    no_leads = "prev_cnt = 0"
    already = "ig_curr_invoice > 0"
    above_min = f"{dep} AND {bal} > deposit_min_value"
    no_setup = "(partner_id IS NULL OR contract_id IS NULL)"
    no_terms = f"project = {lit(L.NO_INFO_PROJECT)}"
    has_terms = f"project != {lit(L.NO_INFO_PROJECT)}"
    setup_tail = f"IF(partner_id IS NULL, {lit(L.LONG_NO_PARTNER_TAIL)}, {lit(L.LONG_NO_CONTRACT_TAIL)})"
    # the ordered rule list: condition, short text, long text
    reasons = [
        (excluded, lit(L.REASON_EXCLUDED),
         f"concat(coalesce(partner_name, legal_entity), {lit(L.LONG_EXCLUDED_INN)}, inn, {lit(L.LONG_EXCLUDED_TAIL)})"),
        (stopped, lit(L.REASON_STOPPED), lit(L.LONG_STOPPED)),
        (no_leads, lit(L.REASON_NO_LEADS), period_text(L.LONG_NO_LEADS, "leads_prev_start", "leads_prev_end")),
        (already, lit(L.REASON_ALREADY_INVOICED),
         f"concat({period_text(L.LONG_ALREADY_FROM, 'invoice_curr_start', 'invoice_curr_end')}, "
         f"{lit(L.LONG_ALREADY_AMOUNT)}, {grouped_int_sql('ig_curr_invoice')})"),
        (above_min, lit(L.REASON_ABOVE_MIN),
         f"concat({lit(L.LONG_ABOVE_MIN_HEAD)}, {grouped_int_sql(bal)}, {lit(L.LONG_ABOVE_MIN_MID)}, "
         f"{grouped_int_sql('deposit_min_value')}, {lit(L.LONG_ABOVE_MIN_TAIL)})"),
        (no_setup, lit(L.REASON_ACCOUNTING_SETUP), f"concat({lit(L.LONG_SETUP_HEAD)}, inn, {setup_tail})"),
        (no_terms, lit(L.REASON_NO_TERMS), f"concat({lit(L.LONG_NO_TERMS)}, inn)"),
    ]
    short = case([(c, s) for c, s, _ in reasons], "''")
    long = case([(c, t) for c, _, t in reasons], "''")
    # Nothing where the period is settled; a deposit client's average and
    # what its balance lacks; other clients' revenue less what was invoiced
    settled = f"{no_leads} OR {already} OR ({dep} AND {bal_raw} >= deposit_min_value)"
    amount = case(
        [(settled, "0"), (f"{dep} AND {bal_raw} IS NOT NULL", f"deposit_average_value + greatest(-{bal_raw}, 0)")],
        "interval_sale - coalesce(ig_interval_invoice_corrected, 0)",
    )
    # The ordered rule list: account state, condition, text
    missing = [("partner_id", L.ERR_SETUP_PARTNER), ("contract_id", L.ERR_SETUP_CONTRACT)]
    gaps = ", ".join(f"IF({c} IS NULL, {lit(t)}, {lit(L.ERR_SETUP_BLANK)})" for c, t in missing)
    active = "prev_cnt > 0 AND interval_sale > 0"
    problems = [
        (active, no_terms, lit(L.ERR_NO_TERMS)),
        (active, f"{has_terms} AND {no_setup}", f"concat({lit(L.ERR_SETUP_HEAD)}, {gaps})"),
        ("interval_sale > 0", f"{has_terms} AND {already} AND {bal} < deposit_min_value",
         f"concat({lit(L.ERR_INVOICED_HEAD)}, {grouped_int_sql('ig_curr_invoice')}, {lit(L.ERR_INVOICED_MID)}, "
         f"{grouped_int_sql(bal)})"),
    ]
    errors = f"IF({excluded}, '', {case([(f'{state} AND {c}', text) for state, c, text in problems], lit(''))})"
    return {
        "interval_invoices_minus_leads": bal,
        "new_invoice_description_short": short,
        "new_invoice_description_long": long,
        "new_invoice_amount": amount,
        "new_invoice_errors": errors,
    }


def decision_columns(base: DataFrame, rules: RuleSet) -> DataFrame:
    """Adds balance, flag (from the short reason), reasons, amount, errors."""
    ex = decision_exprs(rules)
    flag = f"CASE WHEN new_invoice_description_short = '' THEN {lit(L.YES)} ELSE {lit(L.NO)} END AS new_invoice_flag"
    out = [f"{v} AS {k}" for k, v in ex.items()]
    return with_client_rules(base, rules).selectExpr(*base.columns, *out).selectExpr("*", flag)


# --------------------------------------------------------------------------
# Row selections (pandas semantics, C8)
# --------------------------------------------------------------------------
def not_stopped(stop_flg: str = "stop_flg") -> str:
    """P25: lower(stop).fillna('') != stop label."""
    return f"(coalesce(lower(trim({stop_flg})), '') != {lit(L.STOP_FLAG)})"


def not_excluded(report: DataFrame, rules: RuleSet) -> DataFrame:
    """Accounts of clients that may be invoiced (a NULL client may)."""
    return with_client_rules(report, rules).where("NOT _excluded").select(*report.columns)


def select_new_invoices(report: DataFrame) -> DataFrame:
    """Flag yes and not stopped (not gated by the alert window)."""
    return report.where(f"new_invoice_flag = {lit(L.YES)} AND {not_stopped()}")


def errors_predicate() -> str:
    return (
        f"coalesce(new_invoice_flag = {lit(L.NO)}, false) AND {not_stopped()} "
        f"AND coalesce(prev_cnt > 0 AND interval_sale > 0, false) "
        f"AND (coalesce(project = {lit(L.NO_INFO_PROJECT)}, false) OR partner_id IS NULL OR contract_id IS NULL)"
    )


def warnings_predicate() -> str:
    low = (
        f"(coalesce(payment_type = {lit(L.DEPOSIT)} AND interval_invoices_minus_leads <= deposit_min_value * 2, false) "
        f"OR coalesce(interval_invoices_minus_leads < 0, false))"
    )
    return (
        f"coalesce(new_invoice_flag = {lit(L.NO)}, false) AND {not_stopped()} "
        f"AND NOT (project <=> {lit(L.NO_INFO_PROJECT)}) AND partner_id IS NOT NULL AND contract_id IS NOT NULL "
        f"AND coalesce(prev_cnt > 0, false) AND {low}"
    )


def select_errors(report: DataFrame, rules: RuleSet) -> DataFrame:
    """Accounts that should be invoiced but cannot be."""
    return not_excluded(report, rules).where(errors_predicate())


def select_warnings(report: DataFrame, rules: RuleSet) -> DataFrame:
    """Set-up complete, had leads, balance low."""
    return not_excluded(report, rules).where(warnings_predicate())


def in_alert_window(run_ts: _dt.datetime, window=("09:50:00", "11:50:00")) -> bool:
    """Alerts only between the window bounds (inclusive), run clock."""
    lo, hi = (_dt.time.fromisoformat(w) for w in window)
    return lo <= run_ts.time() <= hi


def gate_alerts(df: DataFrame, run_ts: _dt.datetime, window=("09:50:00", "11:50:00")) -> DataFrame:
    """R11 as a literal predicate: Catalyst folds it; outside the window the
    plan becomes an empty relation and nothing is scanned."""
    return df.where(lit(in_alert_window(run_ts, window)))


# --------------------------------------------------------------------------
# Split, invoice line, VAT
# --------------------------------------------------------------------------
def split_invoices(new_invoices: DataFrame, rules: RuleSet) -> DataFrame:
    """D12 (C15, intended behaviour): each account with split rules becomes
    one row per part; amount x share (exact decimal, half up) with the last
    part taking the remainder so parts add up exactly. Other accounts pass as
    one part of share 1.

    The parts come by a join with the split rules, one row per client.
    """
    amount = f"CAST(new_invoice_amount AS {MONEY})"
    whole = "array(named_struct('part_no', 1, 'share', 1.0D, 'last', true, 'p_partner', CAST(NULL AS STRING), "\
            "'p_contract', CAST(NULL AS STRING), 'before', CAST(array() AS array<double>)))"

    def of(share: str) -> str:
        return f"CAST({amount} * CAST({share} AS DECIMAL(9,6)) AS {MONEY})"

    earlier = f"aggregate(before, CAST(0 AS {MONEY}), (a, x) -> CAST(a + {of('x')} AS {MONEY}))"
    keep = [c for c in new_invoices.columns if c not in ("new_invoice_amount", "partner_id", "contract_id")]
    exploded = with_splits(new_invoices, rules).selectExpr(*new_invoices.columns, f"inline(coalesce(_parts, {whole}))")
    return exploded.selectExpr(
        *keep,
        "coalesce(p_partner, CAST(partner_id AS STRING)) AS partner_id",
        "coalesce(p_contract, CAST(contract_id AS STRING)) AS contract_id",
        "part_no",
        "share",
        f"CAST(CASE WHEN last THEN {amount} - {earlier} ELSE {of('share')} END AS {MONEY}) AS new_invoice_amount",
    )


def invoice_line(df: DataFrame) -> DataFrame:
    """D13 + D14: text, quantity, unit price and VAT of the invoice line.

    Post-pay price is revenue per lead over the whole account (not halved by a
    split, C15); quantity is the lead count times the part's share.
    """
    dep = f"payment_type = {lit(L.DEPOSIT)}"
    return df.selectExpr(
        "*",
        f"CASE WHEN {dep} THEN {lit(L.LINE_TEXT_DEPOSIT)} ELSE {lit(L.LINE_TEXT_POSTPAY)} END AS line_text",
        f"CASE WHEN {dep} THEN CAST(0 AS DOUBLE) ELSE interval_cnt * share END AS line_quantity",
        f"CAST(CASE WHEN {dep} THEN new_invoice_amount ELSE round(try_divide(interval_sale, interval_cnt), 2) END "
        f"AS {MONEY}) AS line_price",
        f"{vat_included('new_invoice_amount')} AS vat_amount",
    )
