"""Invoices: top line, receipts, enrichment, period aggregate.

Operators: P18 (line category), W4 (largest line), R3/J9/A3 (receipts per
invoice), J8 (enrichment joins), P12 (partner key remap), P14 (branch),
P17 (channel), P19 (status), P20 (payment status), R4/J2/A2 (period
aggregate), A5 (NULL-when-empty current sums), A6 (conditional max).

Scale notes: the line pick (W4, a struct pick: sort-based, so the lines are
dealt out first, ``dealt_lines``) and the receipt sums (A3, hash) are
aggregates keyed by invoice id with partial aggregation, so an invoice with a
huge number of lines collapses per part, and both come out hash-partitioned
by invoice id for the enrichment joins. Dimension joins (organisation,
partner) are left to AQE, which broadcasts them when their runtime size is
under the broadcast threshold and sort-merges otherwise. The period aggregate
follows the leads design: every distinct window once, pick per client after,
on account-sized rows (materialised once as ``invoice_measures``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.classify import categorize
from ..functions.dates import Calendar, INVOICE_CURR_WINDOW, INVOICE_WINDOW, pick_by_terms
from ..functions.sqlexpr import case, lit
from ..rules import RuleSet, with_partner_rules
from .leads import lookup

ACCOUNT = ("inn", "city_invoice", "source_invoice")
#: line numbers of an invoice that are dealt to one part
LINES_TOGETHER = 64


def classify_lines(lines: DataFrame, rules: RuleSet) -> DataFrame:
    """Add the category of each line text."""
    return lines.withColumn("nomenclature_text_gr", F.expr(categorize("nomenclature_text", rules.line_categories)))


def dealt_lines(lines: DataFrame) -> DataFrame:
    """Lines dealt out by invoice for the line pick (W4), which sorts them: a
    scan task may read a whole file, and its sort would grow and spill with
    it. An invoice of very many lines lies in several parts, by line number."""
    return lines.repartition(F.col("invoice_id"), F.expr(f"line_no DIV {LINES_TOGETHER}"))


def top_line(lines: DataFrame) -> DataFrame:
    """Largest line per invoice (NULL amounts last, then line no, text)."""
    pick = (
        "min(struct(amount IS NULL AS a_null, -amount AS neg_amount, line_no, nomenclature_text, "
        "nomenclature_text_gr)) AS _p"
    )
    return lines.groupBy("invoice_id").agg(F.expr(pick)).selectExpr(
        "invoice_id", "_p.nomenclature_text AS nomenclature_text", "_p.nomenclature_text_gr AS nomenclature_text_gr"
    )


def live_receipt_lines(receipts: DataFrame, receipt_lines: DataFrame) -> DataFrame:
    """R3 + J9: the lines of posted, not deleted receipts."""
    live = receipts.where("is_posted = true AND is_deleted = false").select("receipt_id", "receipt_dt")
    return receipt_lines.join(live, "receipt_id", "inner").select("invoice_id", "receipt_amount", "receipt_dt")


def sum_receipts(live_lines: DataFrame) -> DataFrame:
    """A3: sum and latest date per invoice."""
    return live_lines.groupBy("invoice_id").agg(
        F.expr("sum(receipt_amount) AS receipt_amount"), F.expr("max(receipt_dt) AS receipt_dt")
    )


def receipts_by_invoice(receipts: DataFrame, receipt_lines: DataFrame) -> DataFrame:
    """R3 + J9 + A3: posted, not deleted receipts; sum and latest date."""
    return sum_receipts(live_receipt_lines(receipts, receipt_lines))


# Expressions over the columns that ``with_partner_rules`` adds by partner key.
def invoice_branch(partner_name: str, comment: str | None) -> str:
    """Partner-name rules, then comment rules ('ne' is plain !=, C2)."""
    found = [f"try_element_at(filter(_pnames, r -> r.name = {partner_name}), 1).branch"]
    if comment is not None:
        match = f"IF(r.same, {comment} = r.comment, {comment} != r.comment)"
        found.append(f"try_element_at(filter(_pcomments, r -> {match}), 1).branch")
    return f"coalesce({', '.join(found)}, '')"


def invoice_channel(comment: str, rules: RuleSet) -> str:
    """Comment -> code for listed clients, with a non-empty default."""
    return case([("_pchannel", lookup(comment, rules.channel_comments, lit(rules.channel_default)))], "''")


def invoice_status(is_posted: str = "is_posted", is_deleted: str = "is_deleted") -> str:
    """Unposted, deleted, valid -- in this order."""
    return case(
        [(f"{is_posted} = false", lit(L.STATUS_UNPOSTED)), (f"{is_deleted} = true", lit(L.STATUS_DELETED))],
        lit(L.STATUS_VALID),
    )


def payment_status(receipt: str = "receipt_amount", amount: str = "invoice_amount") -> str:
    """P20 (C3): zero/missing first; negative or NULL amount -> error label."""
    return case(
        [
            (f"coalesce({receipt}, 0) = 0", lit(L.PAY_UNPAID)),
            (f"{receipt} > 0 AND {receipt} < {amount}", lit(L.PAY_PART)),
            (f"{receipt} = {amount}", lit(L.PAY_FULL)),
            (f"{receipt} > {amount}", lit(L.PAY_OVER)),
        ],
        lit(L.PAY_ERROR),
    )


def enrich_invoices(
    invoices: DataFrame,
    lines: DataFrame,
    receipts_agg: DataFrame,
    organizations: DataFrame,
    partners: DataFrame,
    rules: RuleSet,
) -> DataFrame:
    """Invoice -> top line, receipts, organisation, partner (all left)."""
    top = top_line(lines)
    orgs = organizations.select("organization_id", "organization_name", "organization_inn")
    parts = partners.select("partner_id", "partner_name", "partner_inn", "partner_type")
    parts = with_partner_rules(parts, rules)  # at partner size, not at fact size
    j = (
        invoices.join(top, "invoice_id", "left")
        .join(receipts_agg, "invoice_id", "left")
        .join(orgs, "organization_id", "left")
        .join(parts, "partner_id", "left")
    )
    return j.selectExpr(
        "invoice_id",
        "invoice_number",
        "invoice_dt",
        f"{invoice_branch('partner_name', 'invoice_comment')} AS city_invoice",
        f"{invoice_channel('invoice_comment', rules)} AS source_invoice",
        "nomenclature_text",
        f"coalesce(nomenclature_text_gr, {lit(L.CATEGORY_DEFAULT)}) AS nomenclature_text_gr",
        f"{invoice_status()} AS invoice_status",
        "organization_name",
        "organization_inn",
        "partner_name",
        "coalesce(_pkey, partner_inn) AS partner_inn",
        "partner_type",
        "invoice_amount",
        "coalesce(receipt_amount, CAST(0 AS decimal(18,2))) AS receipt_amount",
        "receipt_dt",
        f"{payment_status()} AS invoice_payment_status",
    )


def billable_invoices(
    invoices: DataFrame, lines: DataFrame, receipts_agg: DataFrame, partners: DataFrame, rules: RuleSet
) -> DataFrame:
    """R4 first: what the period aggregate reads, of billable invoices only.

    The category is known from the line pick, which is keyed by invoice id
    like the invoices and the receipt sums: the others are gone before rows
    move to the partners, and organisations are not joined at all."""
    top = top_line(lines)
    default = lit(L.CATEGORY_DEFAULT)
    own = f"coalesce(nomenclature_text_gr, {default})"
    if rules.billable_category == L.CATEGORY_DEFAULT:  # invoices without lines belong to it
        j = invoices.join(top, "invoice_id", "left").where(f"{own} = {lit(rules.billable_category)}")
    else:
        j = invoices.join(top.where(f"nomenclature_text_gr = {lit(rules.billable_category)}"), "invoice_id")
    parts = with_partner_rules(partners.select("partner_id", "partner_name", "partner_inn"), rules)
    j = j.join(receipts_agg, "invoice_id", "left").join(parts, "partner_id", "left")
    return j.selectExpr(
        "invoice_id",
        "invoice_dt",
        f"{invoice_branch('partner_name', 'invoice_comment')} AS city_invoice",
        f"{invoice_channel('invoice_comment', rules)} AS source_invoice",
        f"{own} AS nomenclature_text_gr",
        f"{invoice_status()} AS invoice_status",
        "coalesce(_pkey, partner_inn) AS partner_inn",
        "invoice_amount",
        "coalesce(receipt_amount, CAST(0 AS decimal(18,2))) AS receipt_amount",
    )


def invoice_window_measures(enriched: DataFrame, cal: Calendar, rules: RuleSet) -> DataFrame:
    """A2 before the pick (R4 billable filter first)."""
    billable = enriched.where(f"nomenclature_text_gr = {lit(rules.billable_category)}")
    valid = f"invoice_status = {lit(L.STATUS_VALID)}"
    d = "CAST(invoice_dt AS DATE)"
    aggs = [
        f"sum(CASE WHEN {valid} THEN invoice_amount ELSE 0 END) AS total_invoice",
        f"sum(CASE WHEN {valid} THEN receipt_amount ELSE 0 END) AS total_receipt",
        f"max(CASE WHEN {valid} THEN invoice_dt END) AS total_max_invoice_dt",
    ]
    windows = cal.invoice_windows()
    for name, (lo, hi) in windows.items():
        inside = f"{valid} AND {d} BETWEEN {lo} AND {hi}"
        aggs += [
            f"sum(CASE WHEN {inside} THEN invoice_amount ELSE 0 END) AS inv_{name}",
            f"sum(CASE WHEN {inside} THEN receipt_amount ELSE 0 END) AS rec_{name}",
            f"max(CASE WHEN {inside} THEN invoice_dt END) AS maxdt_{name}",
        ]
    for name in sorted(set(INVOICE_CURR_WINDOW.values()) | {"week"}):
        lo, hi = windows[name]
        inside = f"{d} BETWEEN {lo} AND {hi}"  # any status (C5)
        aggs += [
            f"sum(CASE WHEN {inside} THEN invoice_amount END) AS cinv_{name}",
            f"sum(CASE WHEN {inside} THEN receipt_amount END) AS crec_{name}",
            f"max(CASE WHEN {inside} THEN invoice_dt END) AS cmax_{name}",
        ]
    grouped = billable.withColumnRenamed("partner_inn", "inn").groupBy(*ACCOUNT)
    return grouped.agg(*[F.expr(a) for a in aggs])


def greater_sum(receipt: str, invoice: str) -> str:
    """C4: receipts if strictly greater, else invoices (max of sums)."""
    return f"CASE WHEN {receipt} > {invoice} THEN {receipt} ELSE {invoice} END"


INVOICE_MEASURES = (
    "total_invoice", "total_invoice_corrected", "total_receipt", "total_max_invoice_dt",
    "interval_invoice", "interval_invoice_corrected", "interval_receipt", "interval_max_invoice_dt",
    "curr_invoice", "curr_receipt", "curr_max_invoice_dt",
)


def invoices_period_agg(enriched: DataFrame, terms_cal: DataFrame, cal: Calendar, rules: RuleSet) -> DataFrame:
    """A2 + J2: per account invoice measures for clients with terms."""
    return pick_invoice_measures(invoice_window_measures(enriched, cal, rules), terms_cal)


def pick_invoice_measures(measures: DataFrame, terms_cal: DataFrame, keep=()) -> DataFrame:
    """J2 + the per-client window pick on account-sized measures."""
    return pick_of_terms(measures.join(terms_cal.select("inn", "payment_type"), "inn", "inner"), keep)


def pick_of_terms(measures: DataFrame, keep=()) -> DataFrame:
    """The window pick of measures that have their ``payment_type``."""

    def pick(mapping, prefix):
        return pick_by_terms("payment_type", mapping, lambda w: f"{prefix}_{w}")

    inv, rec = pick(INVOICE_WINDOW, "inv"), pick(INVOICE_WINDOW, "rec")
    return measures.selectExpr(
        *keep,
        *ACCOUNT,
        "total_invoice",
        f"{greater_sum('total_receipt', 'total_invoice')} AS total_invoice_corrected",
        "total_receipt",
        "total_max_invoice_dt",
        f"{inv} AS interval_invoice",
        f"{greater_sum(rec, inv)} AS interval_invoice_corrected",
        f"{rec} AS interval_receipt",
        f"{pick(INVOICE_WINDOW, 'maxdt')} AS interval_max_invoice_dt",
        f"{pick(INVOICE_CURR_WINDOW, 'cinv')} AS curr_invoice",
        f"{pick(INVOICE_CURR_WINDOW, 'crec')} AS curr_receipt",
        f"{pick(INVOICE_CURR_WINDOW, 'cmax')} AS curr_max_invoice_dt",
    )
