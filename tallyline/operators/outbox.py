"""Messages and documents as tables: M1-M5, N5, K6, J12.

Delivery (chat, accounting API) is outside Spark; what the job produced per
row -- message bodies, invoice documents, log lines -- is a column
expression here, so the outbox is one distributed projection of the report,
never a driver loop. All user text is HTML-escaped (C22: the original
escaped only in one of its three messages).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from .. import labels as L
from ..functions.sqlexpr import case, in_list, lit
from ..functions.text import grouped_int_py, html_escape
from ..rules import RuleSet, with_manager
from .decisions import gate_alerts, select_errors, select_new_invoices, select_warnings


_PROJECT_RAW = "coalesce(project, 'None')"
_ENTITY_RAW = "coalesce(legal_entity, 'None')"


def fmt(x: str) -> str:
    """Whole number, space thousands, half to even; 'nan' for NULL."""
    return f"CASE WHEN {x} IS NULL THEN 'nan' ELSE {grouped_int_py(x)} END"


def comment_word(source: str, rules: RuleSet) -> str:
    """Channel code back to its invoice comment; 'нет' otherwise."""
    return case([(f"{source} = {lit(code)}", lit(c)) for c, code in rules.channel_comments], lit(L.MSG_COMMENT_NONE))


def _inn_line(rules: RuleSet) -> str:
    city = html_escape("coalesce(city_invoice, '')")
    return (
        f"concat({lit(L.MSG_INN_OPEN)}, coalesce(inn, 'None'), "
        f"CASE WHEN length({city}) > 0 THEN concat({lit(L.MSG_CITY)}, {city}) ELSE '' END, "
        f"{lit(L.MSG_COMMENT_OPEN)}, {comment_word('source_invoice', rules)}, {lit(L.MSG_COMMENT_CLOSE)})"
    )


def _pm_comment() -> str:
    return (
        f"CASE WHEN trim(coalesce(pm_comment, '')) = '' OR pm_comment = 'None' THEN '' "
        f"ELSE concat({lit(L.MSG_PM_COMMENT)}, {html_escape('pm_comment')}) END"
    )


def _project() -> str:
    """The manager and, from ``with_manager``, the handle."""
    return f"concat({lit(L.MSG_PM)}, {html_escape(_PROJECT_RAW)}, ' ', _manager)"


def _invoice_sum() -> str:
    return fmt("greatest(interval_invoice, interval_receipt)")


def error_body(rules: RuleSet) -> str:
    """M1: cannot-invoice alert."""
    no_terms = f"coalesce(project = {lit(L.NO_INFO_PROJECT)}, false)"
    project = f"CASE WHEN {no_terms} THEN {lit(L.MSG_UNKNOWN_PROJECT)} ELSE {_project()} END"
    accountant = f"CASE WHEN partner_id IS NULL OR contract_id IS NULL THEN {lit(rules.accountant_mention)} ELSE '' END"
    pm = _pm_comment()
    return (
        f"concat('<b>', {project}, {accountant}, '</b>\\n\\n', "
        f"'<b>\\'', {html_escape(_ENTITY_RAW)}, '\\'</b>\\n', "
        f"CASE WHEN {pm} != '' THEN concat('<b>', {pm}, '</b>\\n') ELSE '' END, "
        f"{_inn_line(rules)}, '\\n\\n', "
        f"'<b>', {lit(L.MSG_CANNOT_INVOICE)}, '</b>\\n\\n', "
        f"{lit(L.MSG_PROBLEMS)}, '\\n', "
        f"CASE WHEN {no_terms} THEN {lit(L.MSG_PROBLEM_NO_TERMS)} ELSE '' END, "
        f"CASE WHEN partner_id IS NULL THEN {lit(L.MSG_PROBLEM_NO_PARTNER)} ELSE '' END, "
        f"CASE WHEN contract_id IS NULL THEN {lit(L.MSG_PROBLEM_NO_CONTRACT)} ELSE '' END, '\\n', "
        f"{lit(L.MSG_DETAILS)}, '\\n\\n', "
        f"{lit(L.MSG_LEAD_COST)}, {fmt('interval_sale')}, '\\n', "
        f"{lit(L.MSG_INVOICE_SUM)}, {_invoice_sum()}, '\\n', "
        f"{lit(L.MSG_CORRECTION)}, {fmt('interval_correction')}, '\\n\\n', "
        f"{lit(L.MSG_TOTAL_BALANCE)}, {fmt('interval_invoices_minus_leads')})"
    )


def warning_severity() -> str:
    """M2: due soon / under-billed / overdue."""
    return case(
        [
            ("interval_invoices_minus_leads >= deposit_min_value", lit(L.MSG_DUE_SOON)),
            (f"payment_type != {lit(L.DEPOSIT)}", lit(L.MSG_UNDER_BILLED)),
        ],
        lit(L.MSG_OVERDUE),
    )


def _deposit_details() -> str:
    return (
        f"concat({lit(L.MSG_DEPOSIT_MIN)}, {fmt('deposit_min_value')}, '\\n', "
        f"{lit(L.MSG_DEPOSIT_AVG)}, {fmt('deposit_average_value')}, '\\n\\n')"
    )


def warning_body(rules: RuleSet) -> str:
    """M2: payment due / overdue alert."""
    pm = _pm_comment()
    dep = f"payment_type = {lit(L.DEPOSIT)}"
    return (
        f"concat('<b>', {_project()}, '</b>\\n\\n', "
        f"'<b>\\'', {html_escape(_ENTITY_RAW)}, '\\'</b>\\n', "
        f"'<b>', CASE WHEN {pm} != '' THEN concat({pm}, '\\n') ELSE '' END, '</b>', "
        f"{_inn_line(rules)}, '\\n\\n', {warning_severity()}, '\\n\\n', "
        f"{lit(L.MSG_BALANCE)}, {fmt('interval_invoices_minus_leads')}, '\\n\\n', "
        f"{lit(L.MSG_DETAILS_ITALIC)}, '\\n\\n', "
        f"{lit(L.MSG_TERMS)}, coalesce(payment_type, 'None'), '\\n', "
        f"CASE WHEN {dep} THEN {_deposit_details()} ELSE '' END, "
        f"{lit(L.MSG_LEAD_COST)}, {fmt('interval_sale')}, '\\n', "
        f"{lit(L.MSG_INVOICE_SUM)}, {_invoice_sum()}, '\\n', "
        f"{lit(L.MSG_CORRECTION)}, {fmt('interval_correction')}, '\\n\\n', "
        f"CASE WHEN new_invoice_errors != '' THEN concat({lit(L.MSG_REASON)}, new_invoice_errors) ELSE '' END)"
    )


def invoice_body(rules: RuleSet) -> str:
    """M3: new-invoice notice (deposit and post-pay variants)."""
    pm = _pm_comment()
    dep = f"payment_type = {lit(L.DEPOSIT)}"
    deposit = (
        f"concat({_deposit_details()}, {lit(L.MSG_LEAD_COST)}, {fmt('interval_sale')}, '\\n', "
        f"{lit(L.MSG_INVOICE_SUM)}, {_invoice_sum()}, '\\n', "
        f"{lit(L.MSG_CORRECTION)}, {fmt('interval_correction')}, '\\n', "
        f"{lit(L.MSG_REMAINDER)}, {fmt('interval_invoices_minus_leads')})"
    )
    per_lead = "CASE WHEN interval_cnt != 0 THEN try_divide(interval_sale, interval_cnt) ELSE 0 END"
    postpay = (
        f"concat({lit(L.MSG_LEAD_COUNT)}, {fmt('interval_cnt')}, '\\n', "
        f"{lit(L.MSG_LEAD_COST)}, {fmt('interval_sale')}, '\\n', "
        f"{lit(L.MSG_LEAD_PRICE)}, {fmt(per_lead)}, '\\n')"
    )
    return (
        f"concat('<b>', {lit(L.MSG_RESPONSIBLE)}, {_project()}, '</b>\\n\\n', "
        f"'<b>\\'', {html_escape(_ENTITY_RAW)}, '\\'</b>\\n', "
        f"'<b>', CASE WHEN {pm} != '' THEN concat({pm}, '\\n') ELSE '' END, '</b>', "
        f"{_inn_line(rules)}, '\\n\\n', "
        f"{lit(L.MSG_INVOICE)}, {fmt('new_invoice_amount')}, {lit(L.MSG_RUB_VAT)}, {fmt('vat_amount')}, ')\\n\\n', "
        f"{lit(L.MSG_DETAILS_ITALIC)}, '\\n\\n', "
        f"CASE WHEN {dep} THEN {deposit} ELSE {postpay} END)"
    )


ALERT_COLUMNS = ("as_of", "channel", "severity", "inn", "city_invoice", "source_invoice", "body")


def outbox_errors(report: DataFrame, rules: RuleSet, as_of: _dt.date, run_ts: _dt.datetime) -> DataFrame:
    """M1 + M4 over R9, gated by R11."""
    rows = with_manager(gate_alerts(select_errors(report, rules), run_ts), rules)
    return rows.selectExpr(
        f"{lit(as_of)} AS as_of", f"{lit(L.CHANNEL_ALARM)} AS channel", "'error' AS severity",
        "inn", "city_invoice", "source_invoice", f"{error_body(rules)} AS body",
    )


def outbox_warnings(report: DataFrame, rules: RuleSet, as_of: _dt.date, run_ts: _dt.datetime) -> DataFrame:
    """M2 + M4 over R10, gated by R11."""
    rows = with_manager(gate_alerts(select_warnings(report, rules), run_ts), rules)
    return rows.selectExpr(
        f"{lit(as_of)} AS as_of", f"{lit(L.CHANNEL_DUE_SOON)} AS channel", f"{warning_severity()} AS severity",
        "inn", "city_invoice", "source_invoice", f"{warning_body(rules)} AS body",
    )


def invoice_comment(rules: RuleSet) -> str:
    """Document comment: channel word, else a comment-driven branch, else ''."""
    return case(
        [(f"source_invoice = {lit(code)}", lit(c)) for c, code in rules.channel_comments]
        + [(in_list("city_invoice", rules.comment_branches), "city_invoice")],
        "''",
    )


def _doc_value(src, consts: dict, columns: dict) -> str:
    if isinstance(src, bool):
        return lit(src)
    if isinstance(src, int):
        return str(src)
    kind, _, val = src.partition(":")
    if kind == "col":
        return columns.get(val, val)
    if kind == "const":
        return f"CAST({lit(consts.get(val))} AS STRING)"
    return lit(val)


def invoice_payload(lines: DataFrame, rules: RuleSet, run_ts: _dt.datetime) -> DataFrame:
    """The accounting document (header + array of one line) as JSON,
    with the document's own field names (labels.DOCUMENT_FIELDS)."""
    consts = dict(rules.document_constants)
    columns = {
        "run_date": lit(run_ts.strftime("%Y-%m-%dT%H:%M:%S")),
        "partner_id": "CAST(partner_id AS STRING)",
        "contract_id": "CAST(contract_id AS STRING)",
        "organization_id": "CAST(organization_id AS STRING)",
        "manager_key": "CAST(manager_key AS STRING)",
        "comment": invoice_comment(rules),
    }

    def pairs(fields):
        return ", ".join(f"{lit(n)}, {_doc_value(v, consts, columns)}" for n, v in fields)

    line = f"named_struct({pairs(L.DOCUMENT_LINE_FIELDS)})"
    doc = f"named_struct({pairs(L.DOCUMENT_FIELDS)}, {lit(L.DOCUMENT_LINES_FIELD)}, array({line}))"
    return lines.selectExpr(
        "inn", "city_invoice", "source_invoice", "part_no", "share",
        "CAST(partner_id AS STRING) AS partner_id", "CAST(contract_id AS STRING) AS contract_id",
        "new_invoice_amount", "vat_amount",
        f"to_json({doc}, map('ignoreNullFields', 'false')) AS payload",
    )


def outbox_invoices(lines: DataFrame, rules: RuleSet, as_of: _dt.date) -> DataFrame:
    """M3 + M4: one notice per invoice to be created."""
    return with_manager(lines, rules).selectExpr(
        f"{lit(as_of)} AS as_of", f"{lit(L.CHANNEL_NEW_INVOICE)} AS channel", "'invoice' AS severity",
        "inn", "city_invoice", "source_invoice", "part_no", f"{invoice_body(rules)} AS body",
    )


def audit_log(lines: DataFrame, run_ts: _dt.datetime) -> DataFrame:
    """K6: one JSON log line per invoice (correction NULL -> 0)."""
    entry = (
        f"named_struct('datetime', {lit(run_ts.isoformat())}, 'inn', inn, 'status', CAST(NULL AS INT), "
        "'new_invoice_amount', new_invoice_amount, 'interval_invoice', interval_invoice, "
        "'interval_receipt', interval_receipt, 'correction', coalesce(interval_correction, 0), "
        "'interval_sale', interval_sale, 'response_body', CAST(NULL AS STRING))"
    )
    return lines.selectExpr("inn", "part_no", f"to_json({entry}, map('ignoreNullFields', 'false')) AS line")


def invoice_lines_for(report: DataFrame, rules: RuleSet) -> DataFrame:
    """R8 -> D12 -> D13/D14: the invoices to create, one row per part."""
    from .decisions import invoice_line, split_invoices

    return invoice_line(split_invoices(select_new_invoices(report), rules))

