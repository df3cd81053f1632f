"""Account balance: J4-J7, D3, D9.

All inputs here are account-sized (already aggregated), so these joins move
per-account rows, never fact rows. The leads side carries the terms columns
from its inner terms join (J1), which is exactly what the left terms join
(J6) would add, since terms hold one row per client.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import BOUND_COLUMNS
from ..functions.sqlexpr import lit
from ..rules import RuleSet, with_client_rules
from .invoices import ACCOUNT, INVOICE_MEASURES
from .leads import pick_leads_measures
from .partners import PARTNER_COLUMNS
from .terms import TERMS_COLUMNS


def leads_with_terms(accounts: DataFrame, terms_cal: DataFrame) -> DataFrame:
    """A1 + J1 keeping every terms column for the report."""
    j = accounts.join(terms_cal, "inn", "inner")
    terms_cols = [c for c in (*TERMS_COLUMNS, *BOUND_COLUMNS) if c != "inn"]
    return j.selectExpr(*ACCOUNT, *pick_leads_measures(), *terms_cols)


def unique_lookup(df: DataFrame, keys, values, name: str) -> DataFrame:
    """A keyed side table that must hold one row per key.

    The original fanned report rows out on duplicate keys; here a duplicate
    key raises at run time, inside the job (no driver-side check).
    """
    aggs = [
        F.expr(f"CASE WHEN count(1) > 1 THEN raise_error({lit('duplicate key in ' + name)}) ELSE first({v}) END AS {v}")
        for v in values
    ]
    known = df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))  # a NULL key never joins
    return known.groupBy(*keys).agg(*aggs)


def balance_expr(corrected: str, correction: str, sale: str) -> str:
    """D3: corrected invoices + correction - lead revenue (all coalesced)."""
    return f"(coalesce({corrected}, 0) + coalesce({correction}, 0) - coalesce({sale}, 0))"


def balance_base(
    leads_terms: DataFrame,
    invoice_agg: DataFrame,
    partner_pick: DataFrame,
    deposit_corrections: DataFrame,
    pm_corrections: DataFrame,
    rules: RuleSet,
) -> DataFrame:
    """J4 + J5 + J7: one row per leads account with every input measure."""
    lg = with_client_rules(leads_terms, rules).alias("lg")
    ig = invoice_agg.selectExpr(*ACCOUNT, *[f"{c} AS ig_{c}" for c in INVOICE_MEASURES]).alias("ig")
    p = partner_pick.selectExpr("inn AS p_inn", "city_invoice AS p_city", *PARTNER_COLUMNS).alias("p")
    corr = unique_lookup(deposit_corrections, ACCOUNT, ["correction"], "deposit corrections").alias("corr")
    pm = unique_lookup(pm_corrections, ACCOUNT, ["comment"], "manager comments").selectExpr(
        *ACCOUNT, "comment AS pm_comment_raw"
    ).alias("pm")

    def on(other: str):
        return F.expr(" AND ".join(f"lg.{k} = {other}.{k}" for k in ACCOUNT))

    p_cond = F.expr("lg.inn = p.p_inn AND (lg.city_invoice = p.p_city OR lg._any_branch)")
    j = (
        lg.join(ig, on("ig"), "left")
        .join(p, p_cond, "left")
        .join(corr, on("corr"), "left")
        .join(pm, on("pm"), "left")
    )
    return j.selectExpr(
        *[f"lg.{c}" for c in leads_terms.columns],
        *[f"ig.ig_{c}" for c in INVOICE_MEASURES],
        *[f"p.{c}" for c in PARTNER_COLUMNS],
        "corr.correction AS correction",
        "pm.pm_comment_raw AS pm_comment_raw",
    )


def balance_core(base: DataFrame) -> DataFrame:
    """Minimum slice: account, period revenue, invoices, balance."""
    return base.selectExpr(
        *ACCOUNT,
        "payment_type",
        "interval_cnt",
        "interval_sale",
        "coalesce(ig_interval_invoice, 0) AS interval_invoice",
        "coalesce(ig_interval_receipt, 0) AS interval_receipt",
        "coalesce(correction, 0) AS interval_correction",
        f"{balance_expr('ig_interval_invoice_corrected', 'correction', 'interval_sale')} AS interval_invoices_minus_leads",
    )


def total_balance(base: DataFrame) -> DataFrame:
    """Whole-history totals (uncorrected sums)."""
    return base.selectExpr(
        *ACCOUNT,
        "total_cnt",
        "total_purchase",
        "total_sale",
        "coalesce(ig_total_invoice, 0) + coalesce(correction, 0) AS total_invoice",
        "coalesce(ig_total_receipt, 0) + coalesce(correction, 0) AS total_receipt",
        "ig_total_max_invoice_dt AS total_max_invoice_dt",
        "coalesce(ig_total_invoice, 0) + coalesce(correction, 0) - total_sale AS total_invoices_minus_leads",
    )
