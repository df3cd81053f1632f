"""Query registry: name -> (Spark query, DuckDB oracle SQL or None).

Every Spark query takes (spark, sf_dir), reads the driver tables through the
domain views and returns a lazy DataFrame with decimals cast to double (the
oracle does the same), so both sides can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .. import labels as L
from ..functions.dates import Calendar
from ..operators import balance, daysums, decisions, invoices, leads, outbox, partners, reports, terms
from ..sources import driver as D
from . import oracle as O
from ..rules import with_manager
from ..session import app_id, ensure_checkpoint_dir, folder_version
from .pipeline import Pipeline, driver_inputs

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def to_driver_types(df: DataFrame) -> DataFrame:
    """Decimals leave as double (both engines convert the exact value)."""
    from ..functions.sqlexpr import ident

    fields = df.schema.fields
    if not any(isinstance(f.dataType, DecimalType) for f in fields):
        return df
    return df.selectExpr(
        *[
            f"CAST({ident(f.name)} AS DOUBLE) AS {ident(f.name)}" if isinstance(f.dataType, DecimalType) else ident(f.name)
            for f in fields
        ]
    )


_PIPELINES: dict[tuple, Pipeline] = {}


def pipeline(spark: SparkSession, sf_dir: str, as_of=None) -> Pipeline:
    """One lazily built pipeline per (session, data folder, run date):
    queries that share stages share the same plans and materialised stages.
    When the folder's tables change, its pipelines are built anew."""
    as_of = as_of or D.AS_OF
    version = folder_version(spark, sf_dir)
    key = (id(spark), app_id(spark), sf_dir, as_of, version)
    if key not in _PIPELINES:
        for old in [k for k in _PIPELINES if k[:3] == key[:3] and k[4] != version]:
            del _PIPELINES[old]
        rules = D.driver_rules()
        _PIPELINES[key] = Pipeline(driver_inputs(spark, sf_dir, rules), rules, as_of)
    return _PIPELINES[key]


def register(name: str, sql: str | None = None, needs=()):
    def deco(fn: Callable[[Pipeline], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_driver_types(fn(pipeline(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = O.build(sql, needs)
        return fn

    return deco


# ====================================================================== leads


@register(
    "lead_dedup",
    "SELECT * REPLACE (CAST(purchase AS DOUBLE) AS purchase, CAST(sale AS DOUBLE) AS sale) FROM leads_enriched",
    ["leads_enriched"],
)
def q_lead_dedup(p: Pipeline) -> DataFrame:
    """Every lead with its duplicate flag."""
    return p.leads_enriched


_HOT = "IF(lead_id % 3 = 0, {}, {})"


@register(
    "lead_dedup_hot",
    f"""SELECT lead_id, date_add, date_time_add,
  CASE WHEN row_number() OVER (
    PARTITION BY CASE WHEN lead_id % 3 = 0 THEN 'hot' ELSE inn END, CASE WHEN lead_id % 3 <> 0 THEN phone END,
      CASE WHEN lead_id % 3 = 0 THEN 'web' ELSE source END, CASE WHEN lead_id % 3 = 0 THEN '' ELSE dk_city END, dk_month
    ORDER BY date_time_add NULLS FIRST, lead_id) > 1
  THEN {O.q(L.DUPLICATE_FLAG)} ELSE '' END AS duplicate_flag
FROM leads_k""",
    ["leads_k"],
)
def q_lead_dedup_hot(p: Pipeline) -> DataFrame:
    """W1 with a third of all leads under one client, source and (missing) phone."""
    hot = p.leads_keyed.withColumns({
        k: F.expr(_HOT.format(v, k))
        for k, v in (("_dk_inn", "'hot'"), ("_dk_phone", "NULL"), ("_dk_source", "'web'"), ("_dk_city", "''"))
    })
    return leads.flag_duplicates(hot).select("lead_id", "date_add", "date_time_add", "duplicate_flag")


LEADS_AGG_SQL = f"""SELECT inn, city_invoice, source_invoice, total_cnt, last_lead_dttm,
  {O.dbl('total_purchase', 'total_sale')}, interval_cnt, {O.dbl('interval_purchase', 'interval_sale')},
  prev_cnt, {O.dbl('prev_purchase', 'prev_sale')} FROM leads_grp"""


@register("leads_period_agg", LEADS_AGG_SQL, ["leads_grp"])
def q_leads_period_agg(p: Pipeline) -> DataFrame:
    """A1 + R1 + R2 + J1."""
    terms_cal = p.payment_terms_calendar  # starts the leads and terms chains together
    return leads.leads_period_agg(p.lead_accounts, terms_cal)


@register("week_end", "SELECT lead_id, date_add, week_end FROM leads_enriched", ["leads_enriched"])
def q_week_end(p: Pipeline) -> DataFrame:
    """P21."""
    return p.leads_keyed.select("lead_id", "date_add", "week_end")


@register(
    "lead_key_remap",
    "SELECT lead_id, inn AS raw_inn, inn_c AS inn FROM leads_k",
    ["leads_k"],
)
def q_lead_key_remap(p: Pipeline) -> DataFrame:
    """P11 (raw key -> client key)."""
    return p.leads_keyed.selectExpr("lead_id", "_dk_inn AS raw_inn", "inn")


@register("lead_branch", "SELECT lead_id, city, city_invoice FROM leads_k", ["leads_k"])
def q_lead_branch(p: Pipeline) -> DataFrame:
    """P13."""
    return p.leads_keyed.select("lead_id", "city", "city_invoice")


@register("lead_channel", "SELECT lead_id, source, source_invoice FROM leads_k", ["leads_k"])
def q_lead_channel(p: Pipeline) -> DataFrame:
    """P16."""
    return p.leads_keyed.select("lead_id", "source", "source_invoice")


# ====================================================================== terms
TERMS_CLEAN_SQL = f"""SELECT row_idx, project, legal_entity, inn, stop_flg, payment_type,
  {O.dbl('deposit_min_value', 'deposit_average_value')}, comment FROM terms_clean"""


@register("terms_clean", TERMS_CLEAN_SQL, ["terms_clean"])
def q_terms_clean(p: Pipeline) -> DataFrame:
    """P5-P10: the cleaned sheet."""
    return p.payment_terms


@register("ffill", "SELECT row_idx, payment_type FROM terms_ff", ["terms_ff"])
def q_ffill(p: Pipeline) -> DataFrame:
    """W6 with the default block size (one block here, bounded in general)."""
    return terms.forward_fill(p.inputs["terms_sheet"], "payment_type").select("row_idx", "payment_type")


@register("ffill_two_phase", "SELECT row_idx, payment_type FROM terms_ff", ["terms_ff"])
def q_ffill_two_phase(p: Pipeline) -> DataFrame:
    """W6, scalable form (blocks of 1024 rows so several blocks carry)."""
    return terms.forward_fill_two_phase(p.inputs["terms_sheet"], "payment_type", block_rows=1024).select(
        "row_idx", "payment_type"
    )


@register(
    "is_numeric_text",
    f"SELECT row_idx, deposit_min_value, COALESCE(regexp_matches(deposit_min_value, '{O.NUM}'), false) AS is_numeric FROM terms_sheet_v",
    ["terms_sheet_v"],
)
def q_is_numeric_text(p: Pipeline) -> DataFrame:
    """P7."""
    from ..functions.text import is_numeric_text

    s = p.inputs["terms_sheet"]
    return s.selectExpr("row_idx", "deposit_min_value", f"{is_numeric_text('deposit_min_value')} AS is_numeric")


@register("terms_id_clean", "SELECT row_idx, inn, comment FROM terms_clean", ["terms_clean"])
def q_terms_id_clean(p: Pipeline) -> DataFrame:
    """P6 (with its note inside the comment)."""
    return p.payment_terms.select("row_idx", "inn", "comment")


@register("terms_type", "SELECT row_idx, payment_type FROM terms_clean", ["terms_clean"])
def q_terms_type(p: Pipeline) -> DataFrame:
    """P8."""
    return p.payment_terms.select("row_idx", "payment_type")


@register(
    "terms_deposit",
    f"SELECT row_idx, {O.dbl('deposit_min_value', 'deposit_average_value')} FROM terms_clean",
    ["terms_clean"],
)
def q_terms_deposit(p: Pipeline) -> DataFrame:
    """P9."""
    return p.payment_terms.select("row_idx", "deposit_min_value", "deposit_average_value")


@register("terms_notes", "SELECT row_idx, comment FROM terms_clean", ["terms_clean"])
def q_terms_notes(p: Pipeline) -> DataFrame:
    """P10."""
    return p.payment_terms.select("row_idx", "comment")


@register(
    "stop_flag",
    f"SELECT row_idx, stop_flg, COALESCE(lower(trim(stop_flg)), '') != {O.q(L.STOP_FLAG)} AS not_stopped FROM terms_clean",
    ["terms_clean"],
)
def q_stop_flag(p: Pipeline) -> DataFrame:
    """P25."""
    return p.payment_terms.selectExpr("row_idx", "stop_flg", f"{decisions.not_stopped()} AS not_stopped")


TERMS_SQL = f"""SELECT project, legal_entity, inn, stop_flg, payment_type,
  {O.dbl('deposit_min_value', 'deposit_average_value')}, comment FROM {{t}}"""


@register("terms_dedup", TERMS_SQL.format(t="terms_dedup"), ["terms_dedup"])
def q_terms_dedup(p: Pipeline) -> DataFrame:
    """W3."""
    return p.terms_dedup


@register("latest_entity", "SELECT inn, legal_entity FROM latest_entity", ["latest_entity"])
def q_latest_entity(p: Pipeline) -> DataFrame:
    """W2."""
    return p.latest_entity


@register("terms_missing_clients", "SELECT inn, legal_entity FROM terms_missing", ["terms_missing"])
def q_terms_missing(p: Pipeline) -> DataFrame:
    """R7 + J11."""
    return p.missing_clients


@register("terms_all", TERMS_SQL.format(t="terms_all"), ["terms_all"])
def q_terms_all(p: Pipeline) -> DataFrame:
    """U1."""
    return p.terms_all


TERMS_CAL_SQL = f"""SELECT project, legal_entity, inn, stop_flg, payment_type,
  {O.dbl('deposit_min_value', 'deposit_average_value')}, comment, leads_start, leads_end, leads_prev_start,
  leads_prev_end, invoice_start, invoice_end, invoice_curr_start, invoice_curr_end FROM terms_cal"""


@register("terms_calendar", TERMS_CAL_SQL, ["terms_cal"])
def q_terms_calendar(p: Pipeline) -> DataFrame:
    """D2."""
    return p.payment_terms_calendar


@register("report_terms", TERMS_CAL_SQL, ["terms_cal"])
def q_report_terms(p: Pipeline) -> DataFrame:
    """The payment-terms result set."""
    return p.payment_terms_calendar


_CAL_D = O.cal_sql("as_of")
CALENDAR_SQL = (
    "SELECT as_of, "
    + ", ".join(f"{v} AS {k}" for k, v in _CAL_D.items())
    + " FROM (SELECT DISTINCT date_add AS as_of FROM leads_v) d"
)


@register("calendar", CALENDAR_SQL, ["leads_v"])
def q_calendar(p: Pipeline) -> DataFrame:
    """D1 for every day that has leads (a back-fill calendar)."""
    days = p.inputs["leads"].select(F.col("date_add").alias("as_of")).distinct()
    return days.selectExpr("as_of", *Calendar.of("as_of").exprs())


@register(
    "period_text",
    "SELECT inn, concat("
    + O.q(L.INTERVAL_LEADS_PREFIX)
    + ", "
    + O.ds("leads_start")
    + ", "
    + O.q(L.PERIOD_TO)
    + ", "
    + O.ds("leads_end")
    + ") AS interval_leads FROM terms_cal",
    ["terms_cal"],
)
def q_period_text(p: Pipeline) -> DataFrame:
    """P22."""
    from ..functions.dates import period_text

    t = p.payment_terms_calendar
    return t.selectExpr("inn", f"{period_text(L.INTERVAL_LEADS_PREFIX, 'leads_start', 'leads_end')} AS interval_leads")


# =================================================================== invoices
@register("top_line", "SELECT * FROM top_line", ["top_line"])
def q_top_line(p: Pipeline) -> DataFrame:
    """W4."""
    return invoices.top_line(p.invoice_lines)


@register(
    "receipts_by_invoice",
    "SELECT invoice_id, CAST(receipt_amount AS DOUBLE) AS receipt_amount, receipt_dt FROM receipts_gr",
    ["receipts_gr"],
)
def q_receipts_by_invoice(p: Pipeline) -> DataFrame:
    """R3 + J9 + A3."""
    return p.receipts_by_invoice


@register(
    "line_category",
    "SELECT invoice_id, line_no, nomenclature_text, nomenclature_text_gr, CAST(amount AS DOUBLE) AS amount FROM lines_v",
    ["lines_v"],
)
def q_line_category(p: Pipeline) -> DataFrame:
    """P18."""
    return p.inputs["invoice_line"]


@register(
    "invoices_enriched",
    "SELECT * REPLACE (CAST(invoice_amount AS DOUBLE) AS invoice_amount, CAST(receipt_amount AS DOUBLE) AS receipt_amount) FROM invoices_enriched",
    ["invoices_enriched"],
)
def q_invoices_enriched(p: Pipeline) -> DataFrame:
    """J8 + P12 + P14 + P17 + P19 + P20."""
    return p.invoices_enriched


for _name, _col, _doc in (
    ("invoice_status", "invoice_status", "P19"),
    ("payment_status", "invoice_payment_status", "P20"),
    ("invoice_branch", "city_invoice", "P14"),
    ("invoice_channel", "source_invoice", "P17"),
    ("invoice_key_remap", "partner_inn", "P12"),
):

    def _mk(col=_col, doc=_doc):
        def fn(p: Pipeline) -> DataFrame:
            return p.invoices_enriched.select("invoice_id", col)

        fn.__doc__ = doc
        return fn

    register(_name, f"SELECT invoice_id, {_col} FROM invoices_enriched", ["invoices_enriched"])(_mk())


INV_AGG_SQL = f"""SELECT inn, city_invoice, source_invoice,
  {O.dbl('total_invoice', 'total_invoice_corrected', 'total_receipt')}, total_max_invoice_dt,
  {O.dbl('interval_invoice', 'interval_invoice_corrected', 'interval_receipt')}, interval_max_invoice_dt,
  {O.dbl('curr_invoice', 'curr_receipt')}, curr_max_invoice_dt FROM invoices_grp"""


@register("invoices_period_agg", INV_AGG_SQL, ["invoices_grp"])
def q_invoices_period_agg(p: Pipeline) -> DataFrame:
    """A2 + R4 + J2 + A6."""
    return p.invoices_agg


@register(
    "curr_period_null_sum",
    "SELECT inn, city_invoice, source_invoice, CAST(curr_invoice AS DOUBLE) AS curr_invoice, CAST(curr_receipt AS DOUBLE) AS curr_receipt FROM invoices_grp",
    ["invoices_grp"],
)
def q_curr_period_null_sum(p: Pipeline) -> DataFrame:
    """A5: current-period sums stay NULL when nothing matches."""
    return p.invoices_agg.select(*invoices.ACCOUNT, "curr_invoice", "curr_receipt")


# =================================================================== partners
PARTNER_SQL_COLS = (
    "inn, city_invoice, partner_name, partner_id, contract_id, contract_number, currency_id, organization_id, "
    "organization_name, organization_inn, manager_key, individual_number, individual_description"
)


@register("partners_pick", f"SELECT {PARTNER_SQL_COLS} FROM partners_pick", ["partners_pick"])
def q_partners_pick(p: Pipeline) -> DataFrame:
    """J3 + R5 + W5."""
    return p.partners_pick


@register(
    "partner_branch",
    "SELECT inn, partner_name, partner_id, contract_id, city_invoice FROM partner_cand",
    ["partner_cand"],
)
def q_partner_branch(p: Pipeline) -> DataFrame:
    """P15 on every live candidate."""
    i = p.inputs
    c = partners.partner_candidates(i["partner"], i["contract"], i["organization"], i["individual"], p.rules)
    return c.select("inn", "partner_name", "partner_id", "contract_id", "city_invoice")


# ==================================================================== balance
@register(
    "balance_core",
    f"""SELECT inn, city_invoice, source_invoice, payment_type, interval_cnt, CAST(interval_sale AS DOUBLE) AS interval_sale,
        {O.dbl('interval_invoice', 'interval_receipt', 'interval_correction', 'interval_invoices_minus_leads')} FROM report""",
    ["report"],
)
def q_balance_core(p: Pipeline) -> DataFrame:
    """D3 + J4 + J6 (minimum end-to-end slice)."""
    return balance.balance_core(p.balance_base)


@register(
    "join_residual",
    "SELECT inn, city_invoice, source_invoice, partner_id, contract_id FROM report",
    ["report"],
)
def q_join_residual(p: Pipeline) -> DataFrame:
    """Partner on client AND (same branch OR any-branch client)."""
    return p.balance_base.select(*invoices.ACCOUNT, "partner_id", "contract_id")


@register(
    "join_corrections",
    "SELECT inn, city_invoice, source_invoice, CAST(raw_correction AS DOUBLE) AS correction, pm_comment FROM report",
    ["report"],
)
def q_join_corrections(p: Pipeline) -> DataFrame:
    """J7 with the uniqueness guard."""
    return p.balance_base.selectExpr(*invoices.ACCOUNT, "correction", "coalesce(pm_comment_raw, '') AS pm_comment")


@register(
    "total_balance",
    f"""SELECT inn, city_invoice, source_invoice, total_cnt, {O.dbl('total_purchase', 'total_sale', 'total_invoice', 'total_receipt')},
        total_max_invoice_dt, CAST(total_invoices_minus_leads AS DOUBLE) AS total_invoices_minus_leads FROM report""",
    ["report"],
)
def q_total_balance(p: Pipeline) -> DataFrame:
    """D9."""
    return balance.total_balance(p.balance_base)


# ================================================================== decisions
REPORT_MONEY = (
    "deposit_min_value", "deposit_average_value", "interval_purchase", "interval_sale", "interval_invoice",
    "interval_receipt", "interval_correction", "interval_invoices_minus_leads", "new_invoice_amount",
    "total_purchase", "total_sale", "total_invoice", "total_receipt", "total_invoices_minus_leads",
    "prev_purchase", "prev_sale", "curr_invoice", "curr_receipt",
)


def report_select(cols) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in REPORT_MONEY else c for c in cols)


REPORT_SQL = f"SELECT {report_select(reports.REPORT_COLUMNS)} FROM report"


@register("report_full", REPORT_SQL, ["report"])
def q_report_full(p: Pipeline) -> DataFrame:
    """The flagship 58-column balance report."""
    return p.balance_report


for _name, _cols, _doc in (
    ("invoice_flag", ("new_invoice_flag",), "D4"),
    ("invoice_reason", ("new_invoice_description_short",), "D5"),
    ("invoice_reason_text", ("new_invoice_description_long",), "D6"),
    ("invoice_amount", ("new_invoice_amount",), "D7"),
    ("invoice_errors", ("new_invoice_errors",), "D8"),
):

    def _mk2(cols=_cols, doc=_doc):
        def fn(p: Pipeline) -> DataFrame:
            return p.balance_report.select(*invoices.ACCOUNT, *cols)

        fn.__doc__ = doc
        return fn

    register(_name, f"SELECT inn, city_invoice, source_invoice, {report_select(_cols)} FROM report", ["report"])(_mk2())


@register(
    "report_new_invoices",
    f"SELECT {report_select(reports.NEW_INVOICE_COLUMNS)} FROM report WHERE new_invoice_flag = {O.q(L.YES)}",
    ["report"],
)
def q_report_new_invoices(p: Pipeline) -> DataFrame:
    """R12."""
    return reports.report_new_invoices(p.balance_report)


@register("report_errors", f"SELECT {report_select(reports.REPORT_COLUMNS)} FROM report WHERE new_invoice_errors != ''", ["report"])
def q_report_errors(p: Pipeline) -> DataFrame:
    """R13."""
    return reports.report_errors(p.balance_report)


@register(
    "report_ordered",
    f"SELECT {report_select(reports.REPORT_COLUMNS)} FROM report ORDER BY interval_invoices_minus_leads NULLS FIRST, inn, city_invoice, source_invoice",
    ["report"],
)
def q_report_ordered(p: Pipeline) -> DataFrame:
    """O1."""
    return reports.report_ordered(p.balance_report)


# ============================================================ decisions out
def _lines(p: Pipeline) -> DataFrame:
    """The invoices to create; ``invoice_lines`` are the lines of past ones,
    which the report is built from."""
    return p._memo("new_invoice_lines", lambda: outbox.invoice_lines_for(p.balance_report, p.rules))


SPLIT_COLS = (
    "inn", "city_invoice", "source_invoice", "payment_type", "part_no", "share", "partner_id", "contract_id",
    "new_invoice_amount",
)


@register(
    "select_new_invoices",
    f"SELECT {report_select(reports.REPORT_COLUMNS)} FROM new_inv",
    ["new_inv"],
)
def q_select_new_invoices(p: Pipeline) -> DataFrame:
    """R8."""
    return decisions.select_new_invoices(p.balance_report)


@register("select_errors", f"SELECT {report_select(reports.REPORT_COLUMNS)} FROM report WHERE {O.ERRORS_WHERE}", ["report"])
def q_select_errors(p: Pipeline) -> DataFrame:
    """R9."""
    return decisions.select_errors(p.balance_report, p.rules)


@register("select_warnings", f"SELECT {report_select(reports.REPORT_COLUMNS)} FROM report WHERE {O.WARNINGS_WHERE}", ["report"])
def q_select_warnings(p: Pipeline) -> DataFrame:
    """R10."""
    return decisions.select_warnings(p.balance_report, p.rules)


@register(
    "alerts_in_window",
    f"""SELECT inn, city_invoice, source_invoice, 'error' AS kind FROM report WHERE {O.ERRORS_WHERE}
        UNION ALL SELECT inn, city_invoice, source_invoice, 'warning' FROM report WHERE {O.WARNINGS_WHERE}""",
    ["report"],
)
def q_alerts_in_window(p: Pipeline) -> DataFrame:
    """Alert rows at a run time inside the window (all of them here)."""
    ts = D.RUN_TS
    e = decisions.gate_alerts(decisions.select_errors(p.balance_report, p.rules), ts)
    w = decisions.gate_alerts(decisions.select_warnings(p.balance_report, p.rules), ts)
    return e.selectExpr(*invoices.ACCOUNT, "'error' AS kind").unionByName(
        w.selectExpr(*invoices.ACCOUNT, "'warning' AS kind")
    )


@register(
    "invoice_split",
    f"SELECT inn, city_invoice, source_invoice, payment_type, part_no, share, partner_id, contract_id, "
    f"CAST(new_invoice_amount AS DOUBLE) AS new_invoice_amount FROM split",
    ["split"],
)
def q_invoice_split(p: Pipeline) -> DataFrame:
    """D12 + U2: one row per invoice part, parts add up exactly."""
    return decisions.split_invoices(decisions.select_new_invoices(p.balance_report), p.rules).select(*SPLIT_COLS)


@register(
    "invoice_line",
    "SELECT inn, city_invoice, source_invoice, part_no, line_text, line_quantity, line_price FROM inv_lines",
    ["inv_lines"],
)
def q_invoice_line(p: Pipeline) -> DataFrame:
    """D13."""
    return _lines(p).select(*invoices.ACCOUNT, "part_no", "line_text", "line_quantity", "line_price")


@register(
    "vat_extract",
    "SELECT inn, city_invoice, source_invoice, part_no, CAST(new_invoice_amount AS DOUBLE) AS new_invoice_amount, "
    "vat_amount FROM inv_lines",
    ["inv_lines"],
)
def q_vat_extract(p: Pipeline) -> DataFrame:
    """VAT inside the amount, truncated to exact cents."""
    return _lines(p).select(*invoices.ACCOUNT, "part_no", "new_invoice_amount", "vat_amount")


_SUMMARY_SQL = (
    f"SELECT CAST(count(*) AS BIGINT) AS invoice_count, CASE WHEN count(*) = 0 THEN {O.q(L.SUMMARY_NONE)} "
    f"WHEN count(*) = 1 THEN {O.q(L.SUMMARY_ONE)} "
    f"WHEN count(*) < 5 THEN replace({O.q(L.SUMMARY_FEW)}, '{{n}}', CAST(count(*) AS VARCHAR)) "
    f"ELSE replace({O.q(L.SUMMARY_MANY)}, '{{n}}', CAST(count(*) AS VARCHAR)) END AS message FROM split"
)


@register("run_summary", _SUMMARY_SQL, ["split"])
def q_run_summary(p: Pipeline) -> DataFrame:
    """A7 + M5."""
    return reports.run_summary(decisions.split_invoices(decisions.select_new_invoices(p.balance_report), p.rules))


@register(
    "manager_lookup",
    "SELECT inn, city_invoice, source_invoice, project, CASE "
    + " ".join(f"WHEN project = {O.q(m)} THEN {O.q('(' + h + ')')}" for m, h in O.R.manager_contacts)
    + " ELSE '' END AS manager_handle FROM report",
    ["report"],
)
def q_manager_lookup(p: Pipeline) -> DataFrame:
    """Manager -> chat handle, '' when unknown."""
    return with_manager(p.balance_report, p.rules).selectExpr(*invoices.ACCOUNT, "project", "_manager AS manager_handle")


# ===================================================================== outbox
@register(
    "outbox_errors",
    f"SELECT {O.q(D.AS_OF.isoformat())}::DATE AS as_of, {O.q(L.CHANNEL_ALARM)} AS channel, 'error' AS severity, "
    f"inn, city_invoice, source_invoice, {O.ERROR_BODY} AS body FROM report WHERE {O.ERRORS_WHERE}",
    ["report"],
)
def q_outbox_errors(p: Pipeline) -> DataFrame:
    """M1 + M4."""
    return outbox.outbox_errors(p.balance_report, p.rules, D.AS_OF, D.RUN_TS)


@register(
    "outbox_warnings",
    f"SELECT {O.q(D.AS_OF.isoformat())}::DATE AS as_of, {O.q(L.CHANNEL_DUE_SOON)} AS channel, {O.SEVERITY} AS severity, "
    f"inn, city_invoice, source_invoice, {O.WARNING_BODY} AS body FROM report WHERE {O.WARNINGS_WHERE}",
    ["report"],
)
def q_outbox_warnings(p: Pipeline) -> DataFrame:
    """M2 + M4."""
    return outbox.outbox_warnings(p.balance_report, p.rules, D.AS_OF, D.RUN_TS)


@register(
    "outbox_invoices",
    f"SELECT {O.q(D.AS_OF.isoformat())}::DATE AS as_of, {O.q(L.CHANNEL_NEW_INVOICE)} AS channel, 'invoice' AS severity, "
    f"inn, city_invoice, source_invoice, part_no, {O.INVOICE_BODY} AS body FROM inv_lines",
    ["inv_lines"],
)
def q_outbox_invoices(p: Pipeline) -> DataFrame:
    """M3 + M4."""
    return outbox.outbox_invoices(_lines(p), p.rules, D.AS_OF)


# ==================================================================== sources
def _docs(p: Pipeline, spec=None):
    from ..sources import entity

    spec = spec or D.document_spec()
    key = f"records_{spec.name}"
    return spec, p._memo(key, lambda: entity.parse_entity_text(p.inputs["entity_documents"], "payload", spec))


@register("src_json_envelope", O.DOC_HEADER_SQL, ["docs_v"])
def q_src_json_envelope(p: Pipeline) -> DataFrame:
    """S1 + S2 + N4: envelope and bare-list documents -> typed header rows."""
    from ..sources import entity

    spec, rec = _docs(p)
    return entity.header_rows(rec, spec)


@register(
    "proj_mapping",
    "SELECT ref, raw_date AS doc_date, number, CAST(amount_raw AS VARCHAR) AS amount, CAST(is_posted AS VARCHAR) AS is_posted, "
    "partner_key, comment FROM docs_v",
    ["docs_v"],
)
def q_proj_mapping(p: Pipeline) -> DataFrame:
    """Select + rename by mapping, no typing."""
    from ..sources import entity

    spec, rec = _docs(p)
    return entity.header_rows(rec, spec, cast=False)


@register("proj_coerce_null_default", O.DOC_HEADER_SQL, ["docs_v"])
def q_proj_coerce_null_default(p: Pipeline) -> DataFrame:
    """Landed-record typing (NULL numbers -> 0)."""
    from ..sources import entity

    spec, rec = _docs(p)
    return entity.header_rows(rec, spec, null_default=True)


@register(
    "proj_coerce_strict",
    "SELECT ref, doc_date, number, CAST(CAST(amount_raw AS DECIMAL(18,2)) AS DOUBLE) AS amount, is_posted, partner_key, "
    "comment FROM docs_v",
    ["docs_v"],
)
def q_proj_coerce_strict(p: Pipeline) -> DataFrame:
    """Sheet typing (NULL stays NULL)."""
    from ..sources import entity

    spec, rec = _docs(p)
    return entity.header_rows(rec, spec, null_default=False)


@register("proj_date_sentinel", "SELECT ref, raw_date, doc_date FROM docs_v", ["docs_v"])
def q_proj_date_sentinel(p: Pipeline) -> DataFrame:
    """Date sentinels, bad and out-of-range dates -> NULL."""
    from ..functions.coerce import coerce_datetime

    _, rec = _docs(p)
    return rec.selectExpr("Ref_Key AS ref", "Date AS raw_date", f"{coerce_datetime('Date')} AS doc_date")


@register(
    "nested_explode",
    "SELECT ref, line_no_raw IS NOT NULL AS has_line FROM doc_lines_v",
    ["doc_lines_v"],
)
def q_nested_explode(p: Pipeline) -> DataFrame:
    """Explode with the parent key; empty / NULL arrays keep one row."""
    _, rec = _docs(p)
    return rec.selectExpr("Ref_Key AS ref", "explode_outer(lines) AS _e").selectExpr("ref", "_e IS NOT NULL AS has_line")


@register(
    "nested_flatten",
    "SELECT ref, CAST(COALESCE(line_no_raw, 0) AS BIGINT) AS line_no, text, "
    "CAST(CAST(COALESCE(sum_raw, 0) AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM doc_lines_v",
    ["doc_lines_v"],
)
def q_nested_flatten(p: Pipeline) -> DataFrame:
    """N2 (+N3): flattened, renamed, typed detail rows (C17 zeros)."""
    from ..sources import entity

    spec, rec = _docs(p)
    return entity.detail_rows(rec, spec)


@register(
    "ingest_header_detail",
    "SELECT 'document' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM docs_v "
    "UNION ALL SELECT 'document_line', CAST(count(*) AS BIGINT) FROM doc_lines_v",
    ["docs_v", "doc_lines_v"],
)
def q_ingest_header_detail(p: Pipeline) -> DataFrame:
    """N4 + K5: one payload -> header table + detail table (row counts)."""
    from ..sources import entity

    spec, rec = _docs(p)
    header, detail = entity.ingest(rec, spec)
    return header.groupBy().agg(F.expr(f"'{spec.header_table}' AS table_name"), F.expr("count(1) AS row_count")).unionByName(
        detail.groupBy().agg(F.expr(f"'{spec.detail_table}' AS table_name"), F.expr("count(1) AS row_count"))
    )


@register(
    "src_incremental",
    O.DOC_HEADER_SQL + f" WHERE doc_date > TIMESTAMP '{D.ENTITY_AS_OF_CUTOFF.isoformat(sep=' ')}'",
    ["docs_v"],
)
def q_src_incremental(p: Pipeline) -> DataFrame:
    """S3: only documents dated strictly after the cut-off."""
    from ..sources import entity

    spec, rec = _docs(p)
    return entity.incremental(entity.header_rows(rec, spec), "doc_date", D.ENTITY_AS_OF_CUTOFF)


@register(
    "src_incremental_detail",
    "SELECT l.ref, CAST(COALESCE(l.line_no_raw, 0) AS BIGINT) AS line_no, l.text, "
    "CAST(CAST(COALESCE(l.sum_raw, 0) AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM doc_lines_v l JOIN docs_v d USING (ref) "
    f"WHERE d.doc_date > TIMESTAMP '{D.ENTITY_AS_OF_CUTOFF.isoformat(sep=' ')}'",
    ["docs_v", "doc_lines_v"],
)
def q_src_incremental_detail(p: Pipeline) -> DataFrame:
    """S3 on whole documents: the lines of excluded documents stay out."""
    from ..sources import entity

    spec, rec = _docs(p)
    return entity.detail_rows(entity.incremental_records(rec, "Date", D.ENTITY_AS_OF_CUTOFF), spec)


@register(
    "ingest_landed_rows",
    "SELECT 'document' AS table_name, ref, doc_date, number, CAST(CAST(COALESCE(amount_raw, 0) AS DECIMAL(18,2)) AS DOUBLE) AS amount, "
    "is_posted, partner_key, comment, NULL::BIGINT AS line_no, NULL::VARCHAR AS text FROM docs_v UNION ALL "
    "SELECT 'document_line', ref, NULL, NULL, CAST(CAST(COALESCE(sum_raw, 0) AS DECIMAL(18,2)) AS DOUBLE), NULL, NULL, NULL, "
    "CAST(COALESCE(line_no_raw, 0) AS BIGINT), text FROM doc_lines_v",
    ["docs_v", "doc_lines_v"],
)
def q_ingest_landed_rows(p: Pipeline) -> DataFrame:
    """S1-S4 + N1-N4 + K5 + S7: documents landed as files, ingested into
    their header and detail tables, and all rows of both read back."""
    import uuid

    from ..session import shared_stage_path
    from . import ingest

    docs = p.inputs["entity_documents"]
    spark, spec = docs.sparkSession, D.document_spec()
    path = shared_stage_path(spark, "landing")
    docs.select("payload").write.text(path)
    spec = replace(spec, header_table=f"document_{uuid.uuid4().hex[:12]}", detail_table=f"document_line_{uuid.uuid4().hex[:12]}")
    written = ingest.ingest_all(spark, [ingest.Landing(spec, path, multi_line=False)], _sink_db(spark))
    header = spark.table(written[spec.header_table]).selectExpr(
        "'document' AS table_name", "*", "CAST(NULL AS BIGINT) AS line_no", "CAST(NULL AS STRING) AS text")
    detail = spark.table(written[spec.detail_table]).selectExpr("'document_line' AS table_name", "*")
    return header.unionByName(detail, allowMissingColumns=True)


DOC_ROWS_SQL = """SELECT 'document' AS table_name, ref, doc_date, number, CAST(CAST(COALESCE(amount_raw, 0) AS DECIMAL(18,2)) AS DOUBLE) AS amount,
{posted} AS is_posted, partner_key, comment, NULL::BIGINT AS line_no, NULL::VARCHAR AS text FROM docs_v d WHERE {where}
UNION ALL SELECT 'document_line', l.ref, NULL, NULL, CAST(CAST(COALESCE(sum_raw, 0) AS DECIMAL(18,2)) AS DOUBLE), NULL, NULL, NULL,
CAST({line} AS BIGINT), text FROM doc_lines_v l JOIN docs_v d ON l.ref = d.ref WHERE {where}"""


def _land(df: DataFrame, column: str) -> str:
    from ..session import shared_stage_path

    path = shared_stage_path(df.sparkSession, "landing")
    df.select(column).write.text(path)
    return path


def _own_tables(spec):
    import uuid

    return replace(spec, header_table=f"document_{uuid.uuid4().hex[:12]}", detail_table=f"document_line_{uuid.uuid4().hex[:12]}")


_FIRST_CUT = "2000-01-01 00:00:00"
_SECOND_CUT = D.ENTITY_AS_OF_CUTOFF.isoformat(sep=" ")


@register(
    "ingest_upsert",
    DOC_ROWS_SQL.format(
        posted=f"d.is_posted AND d.doc_date <= TIMESTAMP '{_SECOND_CUT}'",
        where=f"d.doc_date > TIMESTAMP '{_FIRST_CUT}'",
        line=f"CASE WHEN d.doc_date > TIMESTAMP '{_SECOND_CUT}' AND line_no_raw = 2 THEN 3 ELSE COALESCE(line_no_raw, 0) END",
    ),
    ["docs_v", "doc_lines_v"],
)
def q_ingest_upsert(p: Pipeline) -> DataFrame:
    """S3 + K5: all dated documents, then newer versions of those after the
    cut-off (not posted, other line numbers), each load done twice."""
    from datetime import datetime

    from . import ingest

    docs = p.inputs["entity_documents"]
    spark, spec = docs.sparkSession, _own_tables(D.document_spec())
    newer = "replace(replace(payload, '\"Posted\":true', '\"Posted\":false'), '\"LineNumber\":2', '\"LineNumber\":3') AS payload"
    loads = [
        ingest.Landing(spec, _land(docs, "payload"), False, "Date", datetime.fromisoformat(_FIRST_CUT)),
        ingest.Landing(spec, _land(docs.selectExpr(newer), "payload"), False, "Date", D.ENTITY_AS_OF_CUTOFF),
    ]
    for landing in loads:
        for _ in range(2):
            written = ingest.ingest_all(spark, [landing], _sink_db(spark))
    header = spark.table(written[spec.header_table]).drop("doc_month").selectExpr(
        "'document' AS table_name", "*", "CAST(NULL AS BIGINT) AS line_no", "CAST(NULL AS STRING) AS text")
    detail = spark.table(written[spec.detail_table]).drop("doc_month").selectExpr("'document_line' AS table_name", "*")
    return header.unionByName(detail, allowMissingColumns=True)


@register(
    "ingest_refused",
    "SELECT 'malformed' AS refused, CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS loaded FROM docs_v "
    "UNION ALL SELECT 'no records', CAST(2 * count(*) AS BIGINT), 0 FROM docs_v",
    ["docs_v"],
)
def q_ingest_refused(p: Pipeline) -> DataFrame:
    """Whole documents beside a truncated one, an error answer and an empty
    value for each; the load stops, and what was refused is listed."""
    from ..sinks import tables
    from . import ingest

    docs = p.inputs["entity_documents"]
    spark, spec = docs.sparkSession, _own_tables(D.document_spec())
    spec = replace(spec, name=f"refused_{spec.header_table}")
    broken = (
        "explode(array(payload, left(payload, length(payload) - 1), "
        "concat('{\"odata.error\":{\"code\":\"', doc_id, '\"}}'), '{\"value\":null}')) AS payload"
    )
    db = _sink_db(spark)
    try:
        ingest.ingest_all(spark, [ingest.Landing(spec, _land(docs.selectExpr(broken), "payload"), False)], db)
    except ingest.IngestError:
        pass
    loaded = spark.table(f"{db}.{spec.header_table}").count() if tables.table_exists(spark, f"{db}.{spec.header_table}") else 0
    listed = spark.table(f"{db}.{ingest.QUARANTINE}").where(F.col("entity") == spec.name)
    return listed.groupBy("refused").agg(F.count("*").alias("n"), F.lit(loaded).cast("long").alias("loaded"))


@register(
    "nested_flatten_unmapped",
    "SELECT ref, CAST(line_no_raw AS BIGINT) AS line_no, text, CAST(CAST(sum_raw AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM doc_lines_v",
    ["doc_lines_v"],
)
def q_nested_flatten_unmapped(p: Pipeline) -> DataFrame:
    """N2 of landed files without a mapping of the elements: all their fields,
    as text."""
    from ..sources import entity

    docs = p.inputs["entity_documents"]
    spec = replace(D.document_spec(), detail_columns=())
    detail = entity.detail_rows(entity.read_entity_files(docs.sparkSession, _land(docs, "payload"), spec, multi_line=False), spec)
    return detail.selectExpr("ref", "CAST(LineNumber AS BIGINT) AS line_no", "Text AS text", "CAST(Sum AS DECIMAL(18,2)) AS amount")


@register("sink_truncate_insert", "SELECT CAST(1 AS BIGINT) AS row_no, inn, CAST(payment_type AS VARCHAR) AS note FROM terms_dedup", ["terms_dedup"])
def q_sink_truncate_insert(p: Pipeline) -> DataFrame:
    """K4: replaced by position; the table keeps its names and types."""
    from ..sinks import tables

    df = p.terms_dedup
    name = _table(df.sparkSession, "truncate_insert")
    tables.materialize(df.selectExpr("CAST(0 AS BIGINT) AS row_no", "inn", "project AS note"), name)
    tables.materialize(df.selectExpr("CAST(1 AS INT) AS a", "inn AS b", "payment_type AS c"), name)
    return df.sparkSession.table(name)


@register(
    "src_passthrough",
    'SELECT ref AS "Ref_Key", raw_date AS "Date", number AS "Number", CAST(amount_raw AS VARCHAR) AS "Amount", '
    'CAST(is_posted AS VARCHAR) AS "Posted", partner_key AS "Partner_Key", comment AS "Comment" FROM docs_v',
    ["docs_v"],
)
def q_src_passthrough(p: Pipeline) -> DataFrame:
    """No mapping -> the raw fields as landed."""
    from ..sources import entity

    spec, rec = _docs(p, D.passthrough_spec())
    return entity.header_rows(rec, spec, cast=False)


@register(
    "ingest_all_counts",
    "SELECT 'documents' AS entity, 'header' AS part, CAST(count(*) AS BIGINT) AS row_count FROM docs_v "
    "UNION ALL SELECT 'documents', 'detail', CAST(count(*) AS BIGINT) FROM doc_lines_v "
    "UNION ALL SELECT 'partner_refs', 'header', CAST(count(*) AS BIGINT) FROM docs_v",
    ["docs_v", "doc_lines_v"],
)
def q_ingest_all_counts(p: Pipeline) -> DataFrame:
    """A batch of entity ingests from one landing, rows per table."""
    from ..sources import entity

    out = None
    for spec in (D.document_spec(), D.partner_ref_spec()):
        _, rec = _docs(p, spec)
        header, detail = entity.ingest(rec, spec)
        parts = [("header", header)] + ([("detail", detail)] if detail is not None else [])
        for part, df in parts:
            c = df.groupBy().agg(
                F.expr(f"'{spec.name}' AS entity"), F.expr(f"'{part}' AS part"), F.expr("count(1) AS row_count")
            )
            out = c if out is None else out.unionByName(c)
    return out


@register(
    "src_csv_terms",
    "SELECT row_idx, project, legal_entity, inn, stop_flg, deposit_min_value, deposit_average_value, payment_type "
    "FROM terms_sheet_v",
    ["terms_sheet_v"],
)
def q_src_csv_terms(p: Pipeline) -> DataFrame:
    """Sheet CSV records (human headers) -> mapped text columns."""
    from ..sources.sheet import parse_sheet_lines

    return parse_sheet_lines(p.inputs["terms_sheet_lines"], "line", "row_idx")


@register(
    "src_param_query",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' "
    "AND o_orderstatus = 'F'",
    [],
)
def q_src_param_query(p: Pipeline) -> DataFrame:
    """A query with named bind parameters over a DataFrame."""
    import datetime as _dt

    from ..sources.query import param_query

    orders = p.inputs["orders_raw"]
    return param_query(
        orders.sparkSession,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderdate >= :start AND o_orderstatus = :status",
        {"start": _dt.datetime(1998, 1, 1), "status": "F"},
        orders=orders,
    )


@register("invoice_payload", O.PAYLOAD_SQL, ["inv_lines"])
def q_invoice_payload(p: Pipeline) -> DataFrame:
    """The accounting document (header + one line) as JSON."""
    return outbox.invoice_payload(_lines(p), p.rules, D.RUN_TS)


@register("audit_log", O.AUDIT_SQL, ["inv_lines"])
def q_audit_log(p: Pipeline) -> DataFrame:
    """K6: one JSON log line per invoice."""
    return outbox.audit_log(_lines(p), D.RUN_TS)


# ====================================================================== sinks
def _sink_db(spark: SparkSession) -> str:
    """A database whose managed tables live in the shared checkpoint folder."""
    from ..session import ensure_checkpoint_dir

    db = "tallyline_sinks"
    root = ensure_checkpoint_dir(spark).rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/tallyline-warehouse'")
    return db


def _table(spark: SparkSession, stem: str) -> str:
    import uuid

    return f"{_sink_db(spark)}.{stem}_{uuid.uuid4().hex[:12]}"


@register("sink_full_refresh", TERMS_CLEAN_SQL, ["terms_clean"])
def q_sink_full_refresh(p: Pipeline) -> DataFrame:
    """K1: load, then refresh from a query that reads the table itself; the
    refresh replaces the content (no duplicates, readers never see it empty)."""
    from ..sinks import tables

    spark = p.payment_terms.sparkSession
    name = _table(spark, "payment_terms")
    tables.full_refresh(p.payment_terms, name)
    tables.full_refresh(spark.table(name), name)
    return spark.table(name)


@register(
    "sink_append",
    "SELECT invoice_status, CAST(2 * count(*) AS BIGINT) AS row_count FROM invoices_enriched GROUP BY invoice_status",
    ["invoices_enriched"],
)
def q_sink_append(p: Pipeline) -> DataFrame:
    """K2: two append loads of the same rows."""
    from ..sinks import tables

    src = p.invoices_enriched.select("invoice_id", "invoice_status")
    spark = src.sparkSession
    name = _table(spark, "invoice_status_log")
    tables.append(src, name)
    tables.append(src, name)
    return spark.table(name).groupBy("invoice_status").agg(F.expr("count(1) AS row_count"))


@register("sink_ctas", TERMS_CAL_SQL, ["terms_cal"])
def q_sink_ctas(p: Pipeline) -> DataFrame:
    """K3: materialise a query into a new table (create-as-select)."""
    from ..sinks import tables

    spark = p.payment_terms_calendar.sparkSession
    name = _table(spark, "payment_terms_calendar")
    tables.materialize(p.payment_terms_calendar, name)
    return spark.table(name)


@register(
    "sink_insert_positional",
    "SELECT invoice_id, invoice_status AS status FROM invoices_enriched WHERE invoice_status = "
    + O.q(L.STATUS_VALID)
    + " UNION ALL SELECT invoice_id, invoice_payment_status FROM invoices_enriched",
    ["invoices_enriched"],
)
def q_sink_insert_positional(p: Pipeline) -> DataFrame:
    """K4: insert into an existing table by position (names differ)."""
    from ..sinks import tables

    e = p.invoices_enriched
    spark = e.sparkSession
    name = _table(spark, "invoice_flags")
    tables.materialize(e.where(f"invoice_status = {O.q(L.STATUS_VALID)}").selectExpr("invoice_id", "invoice_status AS status"), name)
    tables.materialize(e.selectExpr("invoice_id", "invoice_payment_status AS anything"), name, truncate=False)
    return spark.table(name)


def _bundle(p: Pipeline) -> dict[str, str]:
    """The dated bundle; the report runs once, its extracts are taken from
    the report as written."""
    from ..session import shared_stage_path
    from ..sinks import tables

    spark = p.inputs["leads"].sparkSession
    root, day = shared_stage_path(spark, "bundle"), D.AS_OF.isoformat()
    paths = tables.write_bundle({"invoice_report": p.outputs()["invoice_report"]}, root, day)
    p.use_saved("balance_report", spark.read.parquet(paths["invoice_report"]))
    rest = {name: df for name, df in p.outputs().items() if name not in paths}
    return {**paths, **tables.write_bundle(rest, root, day)}


@register(
    "report_bundle_counts",
    "SELECT 'errors' AS name, CAST(count(*) AS BIGINT) AS row_count FROM report WHERE new_invoice_errors != '' "
    "UNION ALL SELECT 'invoice_report', CAST(count(*) AS BIGINT) FROM report "
    f"UNION ALL SELECT 'new_invoices', CAST(count(*) AS BIGINT) FROM report WHERE new_invoice_flag = {O.q(L.YES)} "
    "UNION ALL SELECT 'payment_terms', CAST(count(*) AS BIGINT) FROM terms_cal",
    ["report", "terms_cal"],
)
def q_report_bundle_counts(p: Pipeline) -> DataFrame:
    """K7 + T2: the named result sets written under one dated folder."""
    spark, paths = p.inputs["leads"].sparkSession, _bundle(p)
    out = None
    for name, path in sorted(paths.items()):
        c = spark.read.parquet(path).groupBy().agg(F.expr(f"'{name}' AS name"), F.expr("count(1) AS row_count"))
        out = c if out is None else out.unionByName(c)
    return out


# ------------------------------------------------ what was written, read back
def register_as(name: str, like: str):
    """Another way to the rows of query ``like``."""

    def deco(fn):
        register(name)(fn)
        ORACLE[name] = ORACLE[like]
        return fn

    return deco


@register_as("report_bundle_errors", "report_errors")
def q_report_bundle_errors(p: Pipeline) -> DataFrame:
    """K7 + T2: the error extract as the dated bundle holds it."""
    spark, paths = p.inputs["leads"].sparkSession, _bundle(p)
    return spark.read.parquet(paths["errors"])


@register_as("daily_run_report", "report_full")
def q_daily_run_report(p: Pipeline) -> DataFrame:
    """The balance report as a whole daily run leaves it, the run done
    twice (the second takes the finished tables)."""
    import uuid

    from . import run

    spark = p.inputs["leads"].sparkSession
    db = f"tallyline_daily_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{ensure_checkpoint_dir(spark).rstrip('/')}/{db}'")
    for _ in range(2):
        written = run.run_daily(spark, p.inputs, p.rules, p.as_of, D.RUN_TS, db)
    return spark.table(written["balance_report"])


@register_as("invoices_colocated", "invoices_enriched")
def q_invoices_colocated(p: Pipeline) -> DataFrame:
    """J8 + A3 + W4 from tables stored by invoice id."""
    import uuid

    from . import layout

    spark = p.inputs["invoice"].sparkSession
    db = f"tallyline_layout_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{ensure_checkpoint_dir(spark).rstrip('/')}/{db}'")
    return Pipeline(layout.colocate(spark, p.inputs, db), p.rules, p.as_of).invoices_enriched


@register(
    "table_statistics",
    "SELECT 'leads' AS entity, true AS found, CAST(count(*) AS BIGINT) AS row_count FROM leads_enriched "
    "UNION ALL SELECT 'nowhere', false, NULL::BIGINT",
    ["leads_enriched"],
)
def q_table_statistics(p: Pipeline) -> DataFrame:
    """K8 + O2: the row count that ANALYZE put into the catalog."""
    from ..sinks import tables

    spark, name = p.inputs["leads"].sparkSession, _table(p.inputs["leads"].sparkSession, "leads")
    tables.full_refresh(p.inputs["leads"], name)
    tables.analyze(spark, [name])
    stored = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Statistics'")
    found = {n: tables.table_exists(spark, t) for n, t in (("leads", name), ("nowhere", f"{name}_nowhere"))}
    counted = stored.selectExpr(
        "'leads' AS entity", f"{str(found['leads']).lower()} AS found", "CAST(regexp_extract(data_type, '(\\\\d+) rows', 1) AS BIGINT) AS row_count")
    return counted.unionByName(spark.sql(f"SELECT 'nowhere' AS entity, {str(found['nowhere']).lower()} AS found, CAST(NULL AS BIGINT) AS row_count"))


# ================================================================== snapshot
def _snap_cal():
    return Calendar.of(D.SNAPSHOT_AS_OF)


@register(
    "lead_month_snapshot",
    f"""SELECT inn, city_invoice, source_invoice, CAST(date_trunc('month', date_add) AS DATE) AS month,
        CAST(sum(CASE WHEN sale > 0 THEN 1 ELSE 0 END) AS BIGINT) AS npos,
        CAST(sum(purchase) AS DOUBLE) AS purchase, CAST(sum(sale) AS DOUBLE) AS sale, max(date_time_add) AS max_ts
        FROM leads_enriched WHERE duplicate_flag = '' AND date_add < {O.C_SNAP['prev_month_01']}
        GROUP BY inn, city_invoice, source_invoice, CAST(date_trunc('month', date_add) AS DATE)""",
    ["leads_enriched"],
)
def q_lead_month_snapshot(p: Pipeline) -> DataFrame:
    """Closed months pre-aggregated per (account, month)."""
    snap = leads.month_snapshot(leads.lead_groups(p.leads_keyed), leads.snapshot_boundary(_snap_cal()))
    return snap.drop("latest")


@register(
    "leads_period_agg_snapshot",
    LEADS_AGG_SQL.replace("FROM leads_grp", "FROM leads_grp_snap"),
    ["leads_grp_snap"],
)
def q_leads_period_agg_snapshot(p: Pipeline) -> DataFrame:
    """A1 at a later run date from stored months + open months only: the
    tables are built for an earlier run date, then brought up to date; equal
    to the full recompute."""
    from . import snapshot

    cal, source = _snap_cal(), p.inputs["leads"]
    spark = source.sparkSession
    db = f"{_sink_db(spark)}_months"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{ensure_checkpoint_dir(spark).rstrip('/')}/tallyline-months'")
    for run_date in (D.AS_OF, D.SNAPSHOT_AS_OF):
        snapshot.update(spark, source, p.rules, Calendar.of(run_date), db)
    return leads.leads_period_agg(snapshot.lead_accounts(spark, source, p.rules, cal, db), terms.terms_calendar(p.terms_all, cal))


# ============================================================ many run dates
def _of_dates(sql: str, table: str) -> str:
    return sql.replace("SELECT inn", "SELECT as_of, inn").replace(f"FROM {table}", f"FROM {table}_quarter")


@register("leads_period_agg_quarter", _of_dates(LEADS_AGG_SQL, "leads_grp"), ["leads_grp_quarter"])
def q_leads_period_agg_quarter(p: Pipeline) -> DataFrame:
    """A1 at every run date of a quarter, from one pass over the leads."""
    return daysums.leads_period_agg(p.first_leads, p.terms_all, O.QUARTER)


@register("invoices_period_agg_quarter", _of_dates(INV_AGG_SQL, "invoices_grp"), ["invoices_grp_quarter"])
def q_invoices_period_agg_quarter(p: Pipeline) -> DataFrame:
    """A2 at every run date of a quarter, from one pass over the invoices."""
    return daysums.invoices_period_agg(p.invoices_enriched, p.terms_all, p.rules, O.QUARTER)


# ============================================================ other run dates
def _leads_agg_of(v: Pipeline) -> DataFrame:
    terms_cal = v.payment_terms_calendar
    return leads.leads_period_agg(v.lead_accounts, terms_cal)


def _register_variant(suffix: str, as_of) -> None:
    def wrap(build):
        def fn(p: Pipeline) -> DataFrame:
            return build(pipeline(p.inputs["leads"].sparkSession, p.sf_dir, as_of=as_of))

        return fn

    register(f"leads_period_agg_{suffix}", LEADS_AGG_SQL.replace("FROM leads_grp", f"FROM leads_grp_{suffix}"),
             [f"leads_grp_{suffix}"])(wrap(_leads_agg_of))
    register(f"invoices_period_agg_{suffix}", INV_AGG_SQL.replace("FROM invoices_grp", f"FROM invoices_grp_{suffix}"),
             [f"invoices_grp_{suffix}"])(wrap(lambda v: v.invoices_agg))
    register(f"report_full_{suffix}", REPORT_SQL.replace("FROM report", f"FROM report_{suffix}"),
             [f"report_{suffix}"])(wrap(lambda v: v.balance_report))


for _sfx, _d in D.VARIANT_AS_OF.items():
    _register_variant(_sfx, _d)


@register(
    "quality_zero_amount_yes",
    f"SELECT inn, city_invoice, source_invoice, payment_type, {O.dbl('deposit_min_value', 'interval_invoices_minus_leads', 'new_invoice_amount')} "
    f"FROM report WHERE new_invoice_flag = {O.q(L.YES)} AND new_invoice_amount = 0",
    ["report"],
)
def q_quality_zero_amount_yes(p: Pipeline) -> DataFrame:
    """C20: flagged 'yes' with a zero amount (listed, not hidden)."""
    return reports.zero_amount_invoices(p.balance_report)
