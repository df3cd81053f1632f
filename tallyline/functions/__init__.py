"""Expression helpers. They return Spark SQL expression text, applied with
``selectExpr`` / ``F.expr`` (JVM-side, codegen-friendly)."""

from .classify import categorize
from .dates import Calendar, period_bounds, period_text, week_end
from .money import money, vat_included
from .sqlexpr import E, case, in_list, lit
from .text import (
    grouped_int_py,
    grouped_int_sql,
    html_escape,
    is_numeric_text,
    pad_short_key,
    strip_float_suffix,
)

__all__ = [
    "Calendar", "period_bounds", "period_text", "week_end", "money", "vat_included", "categorize",
    "E", "case", "in_list", "lit", "grouped_int_py", "grouped_int_sql", "html_escape",
    "is_numeric_text", "pad_short_key", "strip_float_suffix",
]
