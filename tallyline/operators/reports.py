"""Report assembly and extracts: D10, D11, R12, R13, O1, A7/M5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.dates import period_text
from ..functions.sqlexpr import lit

REPORT_COLUMNS = (
    "inn", "project", "stop_flg", "legal_entity", "city_invoice", "pm_comment", "source_invoice",
    "txt_payment_type", "payment_type", "deposit_min_value", "deposit_average_value",
    "txt_interval_leads", "interval_leads", "interval_cnt", "interval_purchase", "interval_sale",
    "interval_invoices", "interval_invoice", "interval_receipt", "interval_correction",
    "interval_max_invoice_dt", "txt_interval_invoice", "interval_invoices_minus_leads",
    "new_invoice_flag", "new_invoice_description_short", "new_invoice_description_long",
    "new_invoice_amount", "new_invoice_errors",
    "txt_total_leads", "total_cnt", "total_purchase", "total_sale",
    "total_invoices", "total_invoice", "total_receipt", "total_max_invoice_dt",
    "txt_total_invoice", "total_invoices_minus_leads",
    "txt_check", "prev_cnt", "prev_purchase", "prev_sale",
    "curr_invoice", "curr_receipt", "curr_max_invoice_dt", "last_lead_dttm",
    "txt_comment", "comment", "partner_id", "contract_id", "contract_number", "currency_id",
    "organization_id", "organization_name", "organization_inn", "manager_key",
    "individual_number", "individual_description",
)

_EXPR = {
    "legal_entity": "coalesce(partner_name, legal_entity)",
    "pm_comment": "coalesce(pm_comment_raw, '')",
    "txt_payment_type": lit(L.TXT_PAYMENT_TYPE),
    "txt_interval_leads": lit(L.TXT_INTERVAL_LEADS),
    "interval_leads": period_text(L.INTERVAL_LEADS_PREFIX, "leads_start", "leads_end"),
    "interval_invoices": period_text(L.INTERVAL_INVOICES_PREFIX, "invoice_start", "invoice_end"),
    "interval_invoice": "coalesce(ig_interval_invoice, 0)",
    "interval_receipt": "coalesce(ig_interval_receipt, 0)",
    "interval_correction": "coalesce(correction, 0)",
    "interval_max_invoice_dt": "ig_interval_max_invoice_dt",
    "txt_interval_invoice": lit(L.TXT_INTERVAL_INVOICE),
    "txt_total_leads": lit(L.TXT_TOTAL_LEADS),
    "total_invoices": lit(L.TXT_TOTAL_INVOICES),
    "total_invoice": "coalesce(ig_total_invoice, 0) + coalesce(correction, 0)",
    "total_receipt": "coalesce(ig_total_receipt, 0) + coalesce(correction, 0)",
    "total_max_invoice_dt": "ig_total_max_invoice_dt",
    "txt_total_invoice": lit(L.TXT_TOTAL_INVOICE),
    "total_invoices_minus_leads": "coalesce(ig_total_invoice, 0) + coalesce(correction, 0) - total_sale",
    "txt_check": lit(L.TXT_CHECK),
    "curr_invoice": "coalesce(ig_curr_invoice, 0)",
    "curr_receipt": "coalesce(ig_curr_receipt, 0)",
    "curr_max_invoice_dt": "ig_curr_max_invoice_dt",
    "txt_comment": lit(L.TXT_COMMENT),
}


def report_full(decided: DataFrame) -> DataFrame:
    """The 58-column balance report (one row per leads account)."""
    return decided.selectExpr(*[f"{_EXPR[c]} AS {c}" if c in _EXPR else c for c in REPORT_COLUMNS])


NEW_INVOICE_COLUMNS = (
    "inn", "project", "legal_entity", "city_invoice", "source_invoice",
    "payment_type", "deposit_min_value", "deposit_average_value",
    "interval_cnt", "interval_purchase", "interval_sale", "interval_invoice", "interval_receipt",
    "interval_correction", "interval_invoices_minus_leads",
    "new_invoice_flag", "new_invoice_description_short", "new_invoice_description_long",
    "new_invoice_amount", "new_invoice_errors",
    "partner_id", "contract_id", "organization_id", "manager_key",
)


def report_new_invoices(report: DataFrame) -> DataFrame:
    """Flag yes, 24-column extract."""
    return report.where(f"new_invoice_flag = {lit(L.YES)}").select(*NEW_INVOICE_COLUMNS)


def report_errors(report: DataFrame) -> DataFrame:
    """Rows with a non-empty error text."""
    return report.where("new_invoice_errors != ''")


def report_ordered(report: DataFrame) -> DataFrame:
    """O1: balance ascending (NULLs first), account keys break ties.

    A global sort is a range-partitioned shuffle: it scales, and is only
    worth paying when the consumer needs order (a file or a screen)."""
    keys = ("interval_invoices_minus_leads", "inn", "city_invoice", "source_invoice")
    return report.orderBy(*[F.col(c).asc_nulls_first() for c in keys])


def run_summary(new_invoices: DataFrame) -> DataFrame:
    """A7 + M5: one-row count of issued invoices and its message."""
    msg = (
        f"CASE WHEN count(1) = 0 THEN {lit(L.SUMMARY_NONE)} WHEN count(1) = 1 THEN {lit(L.SUMMARY_ONE)} "
        f"WHEN count(1) < 5 THEN replace({lit(L.SUMMARY_FEW)}, '{{n}}', CAST(count(1) AS STRING)) "
        f"ELSE replace({lit(L.SUMMARY_MANY)}, '{{n}}', CAST(count(1) AS STRING)) END AS message"
    )
    return new_invoices.agg(F.expr("count(1) AS invoice_count"), F.expr(msg))


def zero_amount_invoices(report: DataFrame) -> DataFrame:
    """C20 quality check: accounts flagged for a new invoice whose amount is
    0 (a deposit client exactly at its minimum balance)."""
    return report.where(f"new_invoice_flag = {lit(L.YES)} AND new_invoice_amount = 0").select(
        "inn", "city_invoice", "source_invoice", "payment_type", "deposit_min_value",
        "interval_invoices_minus_leads", "new_invoice_amount",
    )
