"""Payment terms: sheet cleaning, one row per client, missing clients, calendar.

Operators: W6 (forward fill, two forms), P5 (missing marker), P6 (id clean),
P7 (numeric test), P8 (terms canonicalisation), P9 (deposit values), P10
(notes), W3 (one row per client), R7/J11 (clients missing from the sheet),
U1 (union), D2 (period bounds). W2 (latest legal entity per client) comes
out of the leads aggregate: ``leads.latest_entity_of``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import labels as L
from ..functions.dates import BOUND_COLUMNS, Calendar, period_bounds
from ..functions.money import MONEY
from ..functions.sqlexpr import case, lit
from ..functions.text import is_numeric_text, pad_short_key, py_strip, strip_float_suffix
from ..rules import RuleSet

SHEET_COLUMNS = (
    "project", "legal_entity", "inn", "stop_flg",
    "deposit_min_value", "deposit_average_value", "payment_type",
)
TERMS_COLUMNS = (
    "project", "legal_entity", "inn", "stop_flg", "payment_type",
    "deposit_min_value", "deposit_average_value", "comment",
)
DEFAULT_BLOCK_ROWS = 1 << 20


# --------------------------------------------------------------------------
# W6 forward fill
# --------------------------------------------------------------------------
def forward_fill(df: DataFrame, col: str, order_col: str = "row_idx") -> DataFrame:
    """Fill NULLs with the last value before them in ``order_col`` order.

    Never one global window (that would put every row in one task): blocks
    of at most ``DEFAULT_BLOCK_ROWS`` rows fill in parallel, see
    ``forward_fill_two_phase``."""
    return forward_fill_two_phase(df, col, order_col, DEFAULT_BLOCK_ROWS)


def forward_fill_two_phase(
    df: DataFrame, col: str, order_col: str = "row_idx", block_rows: int = DEFAULT_BLOCK_ROWS
) -> DataFrame:
    """Scalable form (C9): fill inside fixed row-number blocks in parallel,
    carry each block's last value forward over the (tiny) per-block table,
    and use the carried value where the in-block fill found nothing.

    The per-block table has (max(row_idx) - min(row_idx)) / block_rows rows;
    only that table passes through a single-partition window, and it joins
    back as a broadcast when AQE sees how small it is.
    """
    base = df.withColumn("_blk", F.expr(f"CAST(floor({order_col} / {int(block_rows)}) AS BIGINT)"))
    in_block = Window.partitionBy("_blk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    filled = base.withColumn("_in", F.last(F.col(col), ignorenulls=True).over(in_block))
    tails = base.groupBy("_blk").agg(
        F.expr(f"max(CASE WHEN {col} IS NOT NULL THEN struct({order_col} AS o, {col} AS v) END) AS _t")
    )
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select("_blk", F.last(F.col("_t.v"), ignorenulls=True).over(before).alias("_carry"))
    out = filled.join(carry, "_blk", "left")
    return out.withColumn(col, F.expr("coalesce(_in, _carry)")).drop("_blk", "_in", "_carry")


# --------------------------------------------------------------------------
# P5-P10 sheet cleaning
# --------------------------------------------------------------------------
def clean_terms(sheet: DataFrame, rules: RuleSet, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Raw sheet (all text + row_idx) -> cleaned payment terms with notes."""
    df = forward_fill_two_phase(sheet, "payment_type", "row_idx", block_rows)
    df = df.fillna(L.MISSING_MARK, subset=["inn", "payment_type", "deposit_min_value", "deposit_average_value"])

    inn = pad_short_key(strip_float_suffix("inn"))  # P6
    is_q = f"payment_type = {lit(L.MISSING_MARK)}"
    q_weekly = (
        f"(deposit_min_value = {lit(L.SHEET_POSTPAY)} OR deposit_average_value = {lit(L.SHEET_POSTPAY)} "
        f"OR deposit_average_value = {lit(L.SHEET_STOPPED)})"
    )
    q_dep = f"({is_numeric_text('deposit_min_value')} AND {is_numeric_text('deposit_average_value')})"
    alias = case([(f"payment_type = {lit(raw)}", lit(canon)) for raw, canon in rules.terms_aliases], "NULL")
    canon = case(  # P8 (sees the uncut average)
        [(f"{is_q} AND {q_weekly}", lit(L.WEEKLY)), (f"{is_q} AND {q_dep}", lit(L.DEPOSIT)), (is_q, lit(L.WEEKLY))],
        f"coalesce({alias}, {lit(L.WEEKLY)})",
    )
    note_type = case(
        [
            (f"{is_q} AND {q_weekly}", lit(L.NOTE_SET_WEEKLY)),
            (f"{is_q} AND {q_dep}", lit(L.NOTE_SET_DEPOSIT)),
            (is_q, lit(L.NOTE_SET_WEEKLY)),
            (f"{alias} IS NULL", lit(L.NOTE_SET_WEEKLY)),
        ],
        "''",
    )
    # Average cut at a '-' that is not the first character
    dash = "instr(deposit_average_value, '-')"
    av_cut = case(
        [(f"{dash} > 1", py_strip(f"substring(deposit_average_value, 1, {dash} - 1)"))],
        py_strip("deposit_average_value"),
    )
    step1 = df.selectExpr(
        "row_idx", "project", "legal_entity",
        f"{inn} AS inn",
        "stop_flg",
        f"{canon} AS payment_type",
        "deposit_min_value AS _mn",
        f"{av_cut} AS _av",
        f"CASE WHEN NOT {is_numeric_text(inn)} THEN {lit(L.NOTE_BAD_INN)} ELSE '' END AS _n1",
        f"{note_type} AS _n2",
        f"CASE WHEN {dash} > 1 THEN {lit(L.NOTE_AVG_DASH)} ELSE '' END AS _n3",
    )
    dep = f"payment_type = {lit(L.DEPOSIT)}"

    def amount(c):  # NULL for text that is no number, or one too large for money
        return f"IF({is_numeric_text(c)}, try_cast(try_cast({py_strip(c)} AS DOUBLE) AS {MONEY}), NULL)"

    mn_ok, av_ok = (f"({amount(c)} IS NOT NULL)" for c in ("_mn", "_av"))

    def value(c, ok, default):
        return case(
            [(f"{dep} AND {ok}", amount(c)),
             (dep, f"CAST({default} AS {MONEY})")],
            f"CAST(0 AS {MONEY})",
        )

    return step1.selectExpr(
        "row_idx", "project", "legal_entity", "inn", "stop_flg", "payment_type",
        f"{value('_mn', mn_ok, L.DEFAULT_DEPOSIT_MIN)} AS deposit_min_value",
        f"{value('_av', av_ok, L.DEFAULT_DEPOSIT_AVG)} AS deposit_average_value",
        f"concat(_n1, _n2, _n3, CASE WHEN {dep} AND NOT {mn_ok} THEN {lit(L.NOTE_MIN_DEFAULT)} ELSE '' END, "
        f"CASE WHEN {dep} AND NOT {av_ok} THEN {lit(L.NOTE_AVG_DEFAULT)} ELSE '' END) AS comment",
    )


# --------------------------------------------------------------------------
# W3 / W2 / R7 / U1 / D2
# --------------------------------------------------------------------------
def dedup_terms(clean: DataFrame) -> DataFrame:
    """One row per client, lowest terms text first; ties by project,
    legal entity, sheet row. min(struct) = partial+final aggregate."""
    pick = (
        "min(struct(payment_type, project, legal_entity, row_idx, stop_flg, deposit_min_value, "
        "deposit_average_value, comment)) AS _p"
    )
    return clean.groupBy("inn").agg(F.expr(pick)).selectExpr(
        *[f"_p.{c} AS {c}" if c != "inn" else "inn" for c in TERMS_COLUMNS]
    )


def missing_clients(latest: DataFrame, clean_terms_df: DataFrame) -> DataFrame:
    """Lead clients with no sheet row (NOT EXISTS -> left anti)."""
    return latest.join(clean_terms_df.select("inn"), "inn", "left_anti")


def terms_all(dedup: DataFrame, missing: DataFrame) -> DataFrame:
    """Maintained terms plus weekly defaults for missing clients."""
    defaults = missing.selectExpr(
        f"{lit(L.NO_INFO_PROJECT)} AS project",
        "legal_entity",
        "inn",
        "CAST(NULL AS STRING) AS stop_flg",
        f"{lit(L.WEEKLY)} AS payment_type",
        f"CAST(0 AS {MONEY}) AS deposit_min_value",
        f"CAST(0 AS {MONEY}) AS deposit_average_value",
        f"{lit(L.NOTE_FILL_SHEET)} AS comment",
    )
    return dedup.select(*TERMS_COLUMNS).unionByName(defaults)


def terms_calendar(terms: DataFrame, cal: Calendar) -> DataFrame:
    """Terms + eight period bounds for the given as_of."""
    b = period_bounds("payment_type", cal)
    return terms.selectExpr(*TERMS_COLUMNS, *[f"{b[c]} AS {c}" for c in BOUND_COLUMNS])
