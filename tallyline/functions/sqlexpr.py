"""Spark SQL expression text helpers.

Operators assemble their (often rule-generated) expressions as Spark SQL
text and hand a whole projection to ``selectExpr`` / ``F.expr`` in one call.
The JVM parses and analyses it once; the plan is the same as with the
Column DSL, but building it costs one gateway round trip instead of one per
sub-expression, which matters for CASE chains generated from rule tables.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit(v) -> str:
    """A Spark SQL literal for a Python value (strings fully escaped)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{v}L" if abs(v) > 2**31 - 1 else str(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    if isinstance(v, Decimal):
        return f"{v}BD"
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP_NTZ'{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE'{v.isoformat()}'"
    s = str(v)
    s = s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t")
    return f"'{s}'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def case(branches, default: str = "NULL") -> str:
    """CASE WHEN c1 THEN v1 ... ELSE default END (branches: (cond, value))."""
    branches = list(branches)
    if not branches:
        return default
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in branches)
    return f"CASE {body} ELSE {default} END"


def in_list(col: str, values) -> str:
    values = list(values)
    if not values:
        return "false"
    return f"{col} IN ({', '.join(lit(v) for v in values)})"


def any_of(conds) -> str:
    conds = list(conds)
    return "(" + " OR ".join(conds) + ")" if conds else "false"


def E(sql: str) -> Column:
    return F.expr(sql)


def alias(sql: str, name: str) -> str:
    return f"{sql} AS {ident(name)}"
