"""Partner / contract pick per (client, branch): J3, R5, P15, W5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..rules import RuleSet, issuer_table, with_partner_rules
from .invoices import invoice_branch

PARTNER_COLUMNS = (
    "partner_name", "partner_id", "contract_id", "contract_number", "currency_id",
    "organization_id", "organization_name", "organization_inn", "manager_key",
    "individual_number", "individual_description",
)


def partner_candidates(
    partners: DataFrame, contracts: DataFrame, organizations: DataFrame, individuals: DataFrame, rules: RuleSet
) -> DataFrame:
    """J3 + R5: live contracts of the allowed issuers, with their branch."""
    p = partners.select("partner_id", "partner_name", "partner_inn")
    c = contracts.select(
        "contract_id", "contract_number", "partner_id", "organization_id", "currency_id", "description", "is_deleted"
    )
    o = organizations.select("organization_id", "organization_name", "organization_inn", "manager_key")
    i = individuals.selectExpr(
        "individual_id AS manager_key", "individual_number", "description AS individual_description"
    )
    p = with_partner_rules(p, rules)
    j = (
        p.join(c, "partner_id", "inner")
        .join(o, "organization_id", "inner")
        .join(i, "manager_key", "inner")
        .where("is_deleted = false")
        .join(issuer_table(partners.sparkSession, rules), ["organization_inn", "description"], "left_semi")
    )
    return j.selectExpr(
        "partner_inn AS inn",
        f"{invoice_branch('partner_name', None)} AS city_invoice",
        *PARTNER_COLUMNS,
    )


def pick_partners(
    partners: DataFrame, contracts: DataFrame, organizations: DataFrame, individuals: DataFrame, rules: RuleSet
) -> DataFrame:
    """Lowest partner name per (raw partner key, branch); ties by ids."""
    cand = partner_candidates(partners, contracts, organizations, individuals, rules)
    pick = F.expr(f"min(struct({', '.join(PARTNER_COLUMNS)})) AS _p")
    return cand.groupBy("inn", "city_invoice").agg(pick).selectExpr(
        "inn", "city_invoice", *[f"_p.{c} AS {c}" for c in PARTNER_COLUMNS]
    )
