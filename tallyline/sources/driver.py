"""Domain views over the driver's TPC-H-style tables.

Leads come from ``events``, the raw terms sheet from ``customer``, invoices
and receipts from ``orders``, lines from ``lineitem`` (+ ``part``), partners
and contracts from ``customer`` + ``supplier``, organisations from
``region``, managers from ``nation``. The mapping is a set of narrow
projections (no shuffle except the lineitem/part dimension join), so every
query's work grows with the driver tables. The same mapping is written in
SQL in ``plans/oracle.py``.

Client key of client k: ``7700000000 + k`` as text, except k % 10 == 3,
whose key starts with a zero (``0`` + ``700000000 + k``); such clients
appear without the zero in leads and the sheet, as ids that went through a
number do.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.classify import categorize
from ..functions.money import MONEY
from ..functions.sqlexpr import lit
from ..rules import RuleSet, SplitRule
from ..session import app_id, folder_version

AS_OF = _dt.date(2024, 1, 25)
# a later run date: January is a closed month then (monthly snapshot path)
SNAPSHOT_AS_OF = _dt.date(2024, 3, 10)
# more run dates: first half of a month, last day of a month, the next month
VARIANT_AS_OF = {"d10": _dt.date(2024, 1, 10), "d31": _dt.date(2024, 1, 31), "feb": _dt.date(2024, 2, 10)}
RUN_TS = _dt.datetime(2024, 1, 25, 10, 0, 0)
BASE_DAY = _dt.date(2024, 1, 1)
ORDER_EPOCH = _dt.date(1995, 1, 1)
SUPPLIER_PARTNER_OFFSET = 1_000_000_000
MANAGERS = ("Ann", "Ben", "Cat", "Dan", "Eve")


def raw_key(k: int) -> str:
    return str(700000000 + k) if k % 10 == 3 else str(7700000000 + k)


def client_key(k: int) -> str:
    return "0" + raw_key(k) if k % 10 == 3 else raw_key(k)


def raw_key_sql(k: str) -> str:
    return f"CASE WHEN {k} % 10 = 3 THEN CAST({k} + 700000000 AS STRING) ELSE CAST({k} + 7700000000 AS STRING) END"


def client_key_sql(k: str) -> str:
    return (
        f"CASE WHEN {k} % 10 = 3 THEN concat('0', CAST({k} + 700000000 AS STRING)) "
        f"ELSE CAST({k} + 7700000000 AS STRING) END"
    )


def driver_rules() -> RuleSet:
    """Synthetic rules keyed to driver clients (no real-world values)."""
    return RuleSet(
        lead_key_remap=((raw_key(1), client_key(2)), (raw_key(23), client_key(24)), (raw_key(8), client_key(9))),
        invoice_key_remap=((client_key(21), client_key(22)),),
        branch_clients=(raw_key(3), raw_key(5), raw_key(6), raw_key(7), raw_key(9)),
        branch_default=((raw_key(3), "North"),),
        dedup_city_clients=(raw_key(5), raw_key(6), raw_key(7), raw_key(9)),
        branch_by_partner=(
            (client_key(5), "Customer#000000005", "North"),
            (client_key(5), "Supplier#000000005", "South"),
            (client_key(6), "Customer#000000006", "North"),
            (client_key(6), "Supplier#000000006", "South"),
            (client_key(7), "Customer#000000007", "North"),
            (client_key(9), "Customer#000000009", "North"),
            (client_key(9), "Supplier#000000009", "South"),
        ),
        branch_by_comment=(
            (client_key(3), "North", "eq", "North"),
            (client_key(3), "North", "ne", "South"),
        ),
        channel_clients=(raw_key(0), raw_key(4), raw_key(12)),
        channel_prefixes=(("cl", "C"), ("pu", "P"), ("v", "V")),
        channel_comments=(("clicks", "C"), ("purchases", "P")),
        channel_default="V",
        excluded_clients=(client_key(11), client_key(15)),
        branch_join_any=(client_key(3),),
        split_rules=(
            SplitRule(client_key(2), 1, 0.5),
            SplitRule(client_key(2), 2, 0.5, str(SUPPLIER_PARTNER_OFFSET + 4), str(SUPPLIER_PARTNER_OFFSET + 4)),
            SplitRule(client_key(12), 1, 0.3),
            SplitRule(client_key(12), 2, 0.3, str(SUPPLIER_PARTNER_OFFSET + 1), str(SUPPLIER_PARTNER_OFFSET + 1)),
            SplitRule(client_key(12), 3, 0.4, str(SUPPLIER_PARTNER_OFFSET + 2), str(SUPPLIER_PARTNER_OFFSET + 2)),
        ),
        line_categories=(
            ("contains", ("PROMO",), L.CATEGORY_BILLABLE),
            ("equals", ("ECONOMY small ring",), "Автообзвон"),
            ("contains", ("widget", "Widget"), "Агентские услуги"),
            ("contains", ("STANDARD",), L.CATEGORY_BILLABLE),
            ("contains", ("LARGE",), "Трафик"),
            ("contains", ("MEDIUM",), L.CATEGORY_BILLABLE),
        ),
        manager_contacts=(("Ann", "@example_1"), ("Ben", "@example_2"), ("Cat", "@example_3"), ("Dan", "@example_4")),
        issuers=(("5500000000", "paid traffic"), ("5500000001", "paid traffic"), ("5500000002", "paid traffic")),
        accountant_mention=", @example_accountant",
        document_constants=tuple(
            (k, f"00000000-0000-0000-0000-{i:012d}")
            for i, k in enumerate(("structural_unit", "responsible", "currency", "terms", "delivery", "item"), 1)
        ),
    )


_READS: dict[tuple, DataFrame] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One resolved scan per (session, table version); views over the same
    table share it (Catalyst prunes columns per use)."""
    key = (id(spark), app_id(spark), sf_dir, folder_version(spark, sf_dir), name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _READS[key]


def _shift_day(ts: str, extra: int = 0) -> str:
    """Map a 1995..2001 date onto January 2024 (31-day cycle)."""
    return (
        f"date_add({lit(BASE_DAY)}, CAST((datediff(CAST({ts} AS DATE), {lit(ORDER_EPOCH)}) + {extra}) % 31 AS INT))"
    )


# ---------------------------------------------------------------- leads ----
def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    sale = (
        f"CASE WHEN event_id % 50 = 7 THEN CAST(0 AS {MONEY}) WHEN event_id % 113 = 5 THEN CAST(NULL AS {MONEY}) "
        f"ELSE CAST(value AS {MONEY}) END"
    )
    return (
        _read(spark, sf_dir, "events")
        # events lie in one month; a third of them moves a month back, a third forward
        .selectExpr("* EXCEPT (ts)", "timestampadd(DAY, 31 * (CAST(event_id % 3 AS INT) - 1), ts) AS ts", f"{sale} AS _sale")
        .selectExpr(
            "concat('proj-', CAST(user_id % 4 AS STRING)) AS project",
            "CAST(ts AS DATE) AS date_add",
            "ts AS date_time_add",
            f"CASE WHEN event_id % 997 = 0 THEN CAST(NULL AS STRING) ELSE {raw_key_sql('user_id')} END AS inn",
            "concat('LE ', CAST(user_id AS STRING), ' ', event_type) AS legal_entity",
            "event_type AS source",
            "concat('Co ', CAST(user_id AS STRING)) AS company",
            "concat('Lead ', CAST(event_id AS STRING)) AS name",
            "get_json_object(props, '$.k') AS phone",
            "CASE event_id % 4 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN '' END AS city",
            "concat('B', CAST(event_id % 3 AS STRING)) AS branch",
            "CASE WHEN event_id % 2 = 0 THEN 'sent' ELSE 'queued' END AS send_status",
            "ts AS send_date_time",
            f"CAST(_sale * 0.6BD AS {MONEY}) AS purchase",
            "_sale AS sale",
            "event_id AS lead_id",
        )
    )


# ------------------------------------------------------------ terms sheet ----
def terms_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dirty hand-kept sheet: blanks, '?', ranges, '.0' ids, 9-char ids."""
    a = L.TERMS_ALIASES
    managers = ", ".join(lit(m) for m in MANAGERS)
    return (
        _read(spark, sf_dir, "customer")
        .selectExpr("*", "CAST(round(abs(c_acctbal)) AS BIGINT) AS _x")
        .selectExpr(
            "c_custkey AS row_idx",
            f"element_at(array({managers}), CAST(c_nationkey % 5 + 1 AS INT)) AS project",
            "c_name AS legal_entity",
            "CASE WHEN c_custkey % 211 = 13 OR c_custkey % 31 = 30 THEN CAST(NULL AS STRING)"
            " WHEN c_custkey % 97 = 11 THEN concat('X', CAST(c_custkey AS STRING))"
            " WHEN c_custkey % 10 = 3 THEN CAST(c_custkey + 700000000 AS STRING)"
            " WHEN c_custkey % 10 = 7 THEN concat(CAST(c_custkey + 7700000000 AS STRING), '.0')"
            " WHEN c_custkey % 50 = 49 THEN CAST(c_custkey + 7700000000 - 1 AS STRING)"
            " ELSE CAST(c_custkey + 7700000000 AS STRING) END AS inn",
            f"CASE WHEN c_custkey % 17 = 0 THEN {lit('На стопе')} WHEN c_custkey % 41 = 1 THEN {lit('НА СТОПЕ ')} END"
            " AS stop_flg",
            f"CASE WHEN c_custkey % 19 = 4 THEN {lit(L.SHEET_POSTPAY)} WHEN c_custkey % 23 = 6 THEN CAST(NULL AS STRING)"
            " WHEN c_custkey % 29 = 8 THEN 'n/a' ELSE CAST(_x AS STRING) END AS deposit_min_value",
            f"CASE WHEN c_custkey % 19 = 4 THEN {lit(L.SHEET_POSTPAY)} WHEN c_custkey % 37 = 10 THEN {lit(L.SHEET_STOPPED)}"
            " WHEN c_custkey % 7 = 2 THEN concat(CAST(_x * 4 AS STRING), '-', CAST(_x * 8 AS STRING))"
            " WHEN c_custkey % 31 = 9 THEN '-5' WHEN c_custkey % 43 = 12 THEN CAST(NULL AS STRING)"
            " WHEN c_custkey % 11 = 5 THEN concat(' ', CAST(_x * 4 AS STRING), ' ')"
            " ELSE CAST(_x * 4 AS STRING) END AS deposit_average_value",
            "CASE WHEN c_custkey % 13 = 5 OR c_custkey = 0 THEN CAST(NULL AS STRING)"
            f" WHEN c_mktsegment = 'BUILDING' AND c_custkey % 3 = 0 THEN {lit(a[0][0])}"
            f" WHEN c_mktsegment = 'BUILDING' AND c_custkey % 3 = 1 THEN {lit(a[1][0])}"
            f" WHEN c_mktsegment = 'BUILDING' THEN {lit(a[2][0])}"
            f" WHEN c_mktsegment = 'AUTOMOBILE' THEN {lit(a[5][0])}"
            f" WHEN c_mktsegment = 'MACHINERY' THEN {lit(a[6][0])}"
            f" WHEN c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0 THEN {lit(a[3][0])}"
            f" WHEN c_mktsegment = 'HOUSEHOLD' THEN {lit(a[4][0])}"
            " ELSE 'by agreement' END AS payment_type",
        )
    )


# -------------------------------------------------------------- invoices ----
def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS invoice_id",
        "concat('INV-', CAST(o_orderkey AS STRING)) AS invoice_number",
        f"timestampadd(HOUR, CAST(o_orderkey % 24 AS INT), CAST({_shift_day('o_orderdate')} AS TIMESTAMP_NTZ)) AS invoice_dt",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'clicks' WHEN '2-HIGH' THEN 'purchases'"
        " WHEN '3-MEDIUM' THEN 'North' WHEN '5-LOW' THEN 'misc' END AS invoice_comment",
        f"CAST(o_totalprice AS {MONEY}) AS invoice_amount",
        "o_orderstatus != 'O' AS is_posted",
        "o_orderstatus = 'P' AS is_deleted",
        "o_orderkey % 5 AS organization_id",
        f"CASE WHEN o_orderkey % 4 = 1 THEN o_custkey + {SUPPLIER_PARTNER_OFFSET} ELSE o_custkey END AS partner_id",
    )


def invoice_lines(spark: SparkSession, sf_dir: str, rules: RuleSet) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    text = "concat(p_type, ' ', p_name)"
    return li.join(p, F.expr("l_partkey = p_partkey"), "left").selectExpr(
        "l_orderkey AS invoice_id",
        "l_linenumber AS line_no",
        f"{text} AS nomenclature_text",
        f"{categorize(text, rules.line_categories)} AS nomenclature_text_gr",
        f"CAST(l_extendedprice AS {MONEY}) AS amount",
    )


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS receipt_id",
        f"CAST({_shift_day('o_orderdate', 3)} AS TIMESTAMP_NTZ) AS receipt_dt",
        "o_orderstatus != 'O' AS is_posted",
        "o_orderkey % 10 = 0 AS is_deleted",
    )


def receipt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line by line, or, for some invoices, exactly what was billed."""
    net = f"CAST(CAST(l_extendedprice AS {MONEY}) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS {MONEY})"
    exact = _read(spark, sf_dir, "orders").where("o_orderkey % 14 = 7").selectExpr(
        "o_orderkey AS receipt_id", "o_orderkey AS invoice_id", f"CAST(o_totalprice AS {MONEY}) AS receipt_amount")
    by_line = (
        _read(spark, sf_dir, "lineitem")
        .where("l_orderkey % 14 != 7")
        .selectExpr("l_orderkey", f"{net} AS _net")
        .selectExpr(
            "l_orderkey AS receipt_id",
            "l_orderkey AS invoice_id",
            f"CAST(CASE WHEN l_orderkey % 9 = 0 THEN -_net WHEN l_orderkey % 6 = 0 THEN _net * 3 ELSE _net END"
            f" AS {MONEY}) AS receipt_amount",
        )
    )
    return by_line.unionByName(exact)


# ------------------------------------------------------------ dimensions ----
def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS partner_id", "c_name AS partner_name",
        f"{client_key_sql('c_custkey')} AS partner_inn", "'customer' AS partner_type",
    )
    s = _read(spark, sf_dir, "supplier").selectExpr(
        f"s_suppkey + {SUPPLIER_PARTNER_OFFSET} AS partner_id", "s_name AS partner_name",
        f"{client_key_sql('s_suppkey')} AS partner_inn", "'supplier' AS partner_type",
    )
    return c.unionByName(s)


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partners(spark, sf_dir).selectExpr(
        "partner_id AS contract_id",
        "concat('K-', CAST(partner_id AS STRING)) AS contract_number",
        "partner_id",
        "partner_id % 5 AS organization_id",
        "'RUB' AS currency_id",
        "CASE WHEN partner_id % 7 = 0 THEN 'other' ELSE 'paid traffic' END AS description",
        "partner_id % 11 = 0 AS is_deleted",
    )


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "region").selectExpr(
        "CAST(r_regionkey AS BIGINT) AS organization_id",
        "r_name AS organization_name",
        "CAST(CAST(r_regionkey AS BIGINT) + 5500000000 AS STRING) AS organization_inn",
        "CAST(r_regionkey AS BIGINT) AS manager_key",
    )


def individuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS individual_id",
        "concat('IND-', CAST(n_nationkey AS STRING)) AS individual_number",
        "n_name AS description",
    )


def deposit_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One correction row per client (most of them 0)."""
    return _read(spark, sf_dir, "customer").selectExpr(
        f"{client_key_sql('c_custkey')} AS inn", "'' AS city_invoice", "'' AS source_invoice",
        f"CAST(CASE WHEN c_custkey % 11 = 4 THEN c_acctbal ELSE 0 END AS {MONEY}) AS correction",
    )


def pm_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manager-comment row per client (most of them empty)."""
    return _read(spark, sf_dir, "customer").selectExpr(
        f"{client_key_sql('c_custkey')} AS inn", "'' AS city_invoice", "'' AS source_invoice",
        "CASE WHEN c_custkey % 13 = 2 THEN concat('check <', c_name, '> & call') ELSE '' END AS comment",
    )


# ------------------------------------------------- landed documents (S1) ----
LINE_TYPE = "array<struct<LineNumber:int,Text:string,Sum:double>>"
ENTITY_AS_OF_CUTOFF = _dt.datetime(2024, 1, 15)


def entity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed JSON document per event: envelope for even ids, bare list
    for odd ids; date sentinels, bad dates, empty / NULL line arrays."""
    date = (
        "CASE event_id % 9 WHEN 0 THEN '0000-00-00' WHEN 1 THEN '' WHEN 2 THEN '0' "
        "WHEN 3 THEN '0000-00-00 00:00:00' WHEN 4 THEN '0001-01-01T00:00:00' WHEN 5 THEN 'not a date' "
        "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") END"
    )
    lines = (
        f"CASE event_id % 5 WHEN 0 THEN CAST(array() AS {LINE_TYPE}) WHEN 1 THEN CAST(NULL AS {LINE_TYPE}) "
        "ELSE array(named_struct('LineNumber', 1, 'Text', event_type, 'Sum', value), "
        "named_struct('LineNumber', 2, 'Text', props, 'Sum', value * 2)) END"
    )
    rec = (
        "named_struct('Ref_Key', concat('doc-', CAST(event_id AS STRING)), "
        f"'Date', {date}, 'Number', CAST(event_id AS STRING), "
        "'Amount', CASE WHEN event_id % 11 = 3 THEN CAST(NULL AS DOUBLE) ELSE value END, "
        "'Posted', event_id % 3 != 0, 'Partner_Key', CAST(user_id AS STRING), 'Comment', event_type, "
        f"'lines', {lines})"
    )
    return _read(spark, sf_dir, "events").selectExpr(
        "event_id AS doc_id",
        f"CASE WHEN event_id % 2 = 0 THEN to_json(named_struct('value', array({rec}))) ELSE to_json(array({rec})) END"
        " AS payload",
    )


def terms_sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms sheet rendered as CSV records (one per row), for S5."""
    cols = "project, legal_entity, inn, stop_flg, deposit_min_value, deposit_average_value, payment_type"
    opts = "map('ignoreLeadingWhiteSpace', 'false', 'ignoreTrailingWhiteSpace', 'false')"
    return terms_sheet(spark, sf_dir).selectExpr("row_idx", f"to_csv(struct({cols}), {opts}) AS line")


def document_spec():
    """Ingest config of the landed documents (mapping as data)."""
    from .entity import Col, EntitySpec

    return EntitySpec(
        name="documents",
        columns=(
            Col("Ref_Key", "ref"), Col("Date", "doc_date", "datetime"), Col("Number", "number"),
            Col("Amount", "amount", "money"), Col("Posted", "is_posted", "boolean"),
            Col("Partner_Key", "partner_key"), Col("Comment", "comment"), Col("lines", "lines"),
        ),
        ref_key="Ref_Key",
        explode_column="lines",
        detail_columns=(Col("LineNumber", "line_no", "int"), Col("Text", "text"), Col("Sum", "amount", "money")),
        header_table="document",
        detail_table="document_line",
    )


def passthrough_spec():
    """No mapping: raw fields under their own names, as text."""
    from .entity import Col, EntitySpec

    raw = ("Ref_Key", "Date", "Number", "Amount", "Posted", "Partner_Key", "Comment")
    return EntitySpec(name="documents_raw", columns=tuple(Col(f, f) for f in raw))


def partner_ref_spec():
    """A second entity set landed in the same documents (S7 batch)."""
    from .entity import Col, EntitySpec

    return EntitySpec(name="partner_refs", columns=(Col("Partner_Key", "partner_key"), Col("Comment", "comment")))
