"""Client-specific rules as data.

The original job spelled these out as CASE branches and Python dicts. Here
they are rows supplied by the caller. Rules keyed by a client, partner or
manager grow with the customer base: they become tables with one row per key
(``lead_rules``, ``partner_rules``, ``client_rules``, ...) that operators
join; Spark picks the join from their size. Only the ordered pattern lists
(line categories, source prefixes, terms aliases, comment words) are literal
expressions. No list has a size limit.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import labels as L


@dataclass(frozen=True)
class SplitRule:
    """One part of a client's invoice split.

    ``partner_id`` / ``contract_id`` of None keep the account's own pair.
    """

    inn: str
    part_no: int
    share: float
    partner_id: str | None = None
    contract_id: str | None = None


@dataclass(frozen=True)
class RuleSet:
    # raw lead key -> client key (tested before padding)
    lead_key_remap: tuple[tuple[str, str], ...] = ()
    # partner key -> client key on the invoice side (no padding there)
    invoice_key_remap: tuple[tuple[str, str], ...] = ()
    # raw lead keys whose lead city is the branch
    branch_clients: tuple[str, ...] = ()
    # raw lead key -> branch to use when the lead city is ''
    branch_default: tuple[tuple[str, str], ...] = ()
    # raw lead keys whose duplicates are only looked for within one city
    dedup_city_clients: tuple[str, ...] = ()
    # (partner key, partner name, branch)
    branch_by_partner: tuple[tuple[str, str, str], ...] = ()
    # (partner key, invoice comment, "eq" | "ne", branch)
    branch_by_comment: tuple[tuple[str, str, str, str], ...] = ()
    # clients with channel codes; leads are tested on the raw key, invoices on
    # the partner key
    channel_clients: tuple[str, ...] = ()
    # ordered (lead source prefix, channel code); first match wins
    channel_prefixes: tuple[tuple[str, str], ...] = ()
    # (invoice comment, channel code); other comments get channel_default
    channel_comments: tuple[tuple[str, str], ...] = ()
    channel_default: str = ""
    # clients never invoiced
    excluded_clients: tuple[str, ...] = ()
    # clients whose partner matches whatever the branch
    branch_join_any: tuple[str, ...] = ()
    split_rules: tuple[SplitRule, ...] = ()
    # (kind, patterns, label), first match wins
    line_categories: tuple[tuple[str, tuple[str, ...], str], ...] = L.LINE_CATEGORIES
    billable_category: str = L.CATEGORY_BILLABLE
    terms_aliases: tuple[tuple[str, str], ...] = L.TERMS_ALIASES
    # project manager -> chat handle
    manager_contacts: tuple[tuple[str, str], ...] = ()
    # (issuing organisation key, contract description) pairs that may bill
    issuers: tuple[tuple[str, str], ...] = ()
    # mention appended to alerts when accounting set-up is missing
    accountant_mention: str = ""
    # instance record ids the invoice document refers to (key -> id)
    document_constants: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        shares: dict[str, float] = {}
        for r in self.split_rules:
            shares[r.inn] = shares.get(r.inn, 0.0) + r.share
        for inn, total in shares.items():
            if abs(total - 1.0) > 1e-9:
                raise ValueError(f"split shares for {inn} sum to {total}, not 1")

    @property
    def comment_branches(self) -> tuple[str, ...]:
        """Branches that come from the invoice comment (used for payloads)."""
        return tuple(dict.fromkeys(r[3] for r in self.branch_by_comment))



# --------------------------------------------------------------------------
# Keyed rules as tables, one row per key
# --------------------------------------------------------------------------
def first_of(pairs) -> dict:
    """key -> value; of several rules with one key the first holds."""
    out: dict = {}
    for k, v in pairs:
        out.setdefault(k, v)
    return out


def _table(spark: SparkSession, columns: dict[str, tuple[list, pa.DataType]]) -> DataFrame:
    """A local relation, so that the planner knows its size."""
    return spark.createDataFrame(pa.table({n: pa.array(v, t) for n, (v, t) in columns.items()}))


def _join(df: DataFrame, key: str, table: DataFrame | None, defaults: dict[str, str]) -> DataFrame:
    """Left join the rule columns of a row's ``key``; without rules, their
    defaults as literals and no join."""
    if table is None:
        return df.selectExpr("*", *[f"{d} AS {c}" for c, d in defaults.items()])
    names = df.columns
    joined = df.join(table, F.col(key) == F.col("_rule_key"), "left")
    return joined.selectExpr(*[f"`{c}`" for c in names], *[f"coalesce({c}, {d}) AS {c}" for c, d in defaults.items()])


def with_lead_rules(leads: DataFrame, rules: RuleSet, key: str = "inn") -> DataFrame:
    """Add, by raw lead key: ``_remap``, ``_own_branch``, ``_empty_branch``,
    ``_by_city``, ``_channelled``."""
    remap, default = first_of(rules.lead_key_remap), first_of(rules.branch_default)
    branch, city, channel = set(rules.branch_clients), set(rules.dedup_city_clients), set(rules.channel_clients)
    keys = sorted({*remap, *default, *branch, *city, *channel})
    table = keys and _table(leads.sparkSession, {
        "_rule_key": (keys, pa.string()),
        "_remap": ([remap.get(k) for k in keys], pa.string()),
        "_own_branch": ([k in branch for k in keys], pa.bool_()),
        "_empty_branch": ([default.get(k) for k in keys], pa.string()),
        "_by_city": ([k in city for k in keys], pa.bool_()),
        "_channelled": ([k in channel for k in keys], pa.bool_()),
    })
    text, flag = "CAST(NULL AS STRING)", "false"
    return _join(leads, key, table or None, {
        "_remap": text, "_own_branch": flag, "_empty_branch": text, "_by_city": flag, "_channelled": flag})


_NAMES = pa.list_(pa.struct([("name", pa.string()), ("branch", pa.string())]))
_COMMENTS = pa.list_(pa.struct([("same", pa.bool_()), ("comment", pa.string()), ("branch", pa.string())]))


def with_partner_rules(df: DataFrame, rules: RuleSet, key: str = "partner_inn") -> DataFrame:
    """Add, by partner key: ``_pkey`` (remapped key), ``_pchannel`` and the
    ordered lists ``_pnames`` and ``_pcomments``."""
    remap, channel = first_of(rules.invoice_key_remap), set(rules.channel_clients)
    names: dict[str, list] = {}
    comments: dict[str, list] = {}
    for k, name, branch in rules.branch_by_partner:
        names.setdefault(k, []).append({"name": name, "branch": branch})
    for k, text, match, branch in rules.branch_by_comment:
        comments.setdefault(k, []).append({"same": match == "eq", "comment": text, "branch": branch})
    keys = sorted({*remap, *channel, *names, *comments})
    table = keys and _table(df.sparkSession, {
        "_rule_key": (keys, pa.string()),
        "_pkey": ([remap.get(k) for k in keys], pa.string()),
        "_pchannel": ([k in channel for k in keys], pa.bool_()),
        "_pnames": ([names.get(k, []) for k in keys], _NAMES),
        "_pcomments": ([comments.get(k, []) for k in keys], _COMMENTS),
    })
    return _join(df, key, table or None, {
        "_pkey": "CAST(NULL AS STRING)",
        "_pchannel": "false",
        "_pnames": "CAST(array() AS array<struct<name:string,branch:string>>)",
        "_pcomments": "CAST(array() AS array<struct<same:boolean,comment:string,branch:string>>)",
    })


def with_client_rules(df: DataFrame, rules: RuleSet, key: str = "inn") -> DataFrame:
    """Add, by client key: ``_excluded``, ``_any_branch``."""
    excluded, anywhere = set(rules.excluded_clients), set(rules.branch_join_any)
    keys = sorted(excluded | anywhere)
    table = keys and _table(df.sparkSession, {
        "_rule_key": (keys, pa.string()),
        "_excluded": ([k in excluded for k in keys], pa.bool_()),
        "_any_branch": ([k in anywhere for k in keys], pa.bool_()),
    })
    return _join(df, key, table or None, {"_excluded": "false", "_any_branch": "false"})


def with_manager(df: DataFrame, rules: RuleSet, key: str = "project") -> DataFrame:
    """Add ``_manager``: '(handle)' of a known manager, else ''."""
    handles = first_of(rules.manager_contacts)
    table = handles and _table(df.sparkSession, {
        "_rule_key": (list(handles), pa.string()), "_manager": ([f"({h})" for h in handles.values()], pa.string())})
    return _join(df, key, table or None, {"_manager": "''"})


def with_splits(df: DataFrame, rules: RuleSet, key: str = "inn") -> DataFrame:
    """Add ``_parts``: the client's invoice parts in order, each with the
    shares before it; null without split rules."""
    by_inn: dict[str, list] = {}
    for r in sorted(rules.split_rules, key=lambda r: (r.inn, r.part_no)):
        own = by_inn.setdefault(r.inn, [])
        own.append({"part_no": r.part_no, "share": r.share, "last": False, "p_partner": r.partner_id,
                    "p_contract": r.contract_id, "before": [p["share"] for p in own]})
    for own in by_inn.values():
        own[-1]["last"] = True
    part = pa.struct([("part_no", pa.int32()), ("share", pa.float64()), ("last", pa.bool_()), ("p_partner", pa.string()),
                      ("p_contract", pa.string()), ("before", pa.list_(pa.float64()))])
    table = by_inn and _table(df.sparkSession, {
        "_rule_key": (list(by_inn), pa.string()), "_parts": (list(by_inn.values()), pa.list_(part))})
    kind = "array<struct<part_no:int,share:double,last:boolean,p_partner:string,p_contract:string,before:array<double>>>"
    return _join(df, key, table or None, {"_parts": f"CAST(NULL AS {kind})"})


def issuer_table(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """organization_inn, description pairs that may bill."""
    pairs = sorted(set(rules.issuers))
    return _table(spark, {"organization_inn": ([a for a, _ in pairs], pa.string()), "description": ([d for _, d in pairs], pa.string())})
