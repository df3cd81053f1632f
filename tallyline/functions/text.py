"""Text helpers: numeric test, key padding, number formatting, escaping.

All return Spark SQL expression text over an input expression.
"""

from __future__ import annotations

from .sqlexpr import lit

# White space as text functions see it: also the non-breaking and other
# Unicode spaces that sheet cells hold (Java's \s is ASCII only).
SPACE = r"[\s\x1c-\x1f\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
# A number as plain decimal text, optional sign and exponent, blanks around.
# nan / inf / digit underscores are not numbers here (documented divergence).
NUMERIC_TEXT = rf"^{SPACE}*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?{SPACE}*$"


def is_numeric_text(c: str) -> str:
    """Never NULL; NULL text is not numeric."""
    return f"coalesce({c} RLIKE {lit(NUMERIC_TEXT)}, false)"


def strip_float_suffix(c: str) -> str:
    """'123.0' -> '123' (ids that went through a float)."""
    return f"regexp_replace({c}, {lit(r'\.0$')}, '')"


def pad_short_key(c: str) -> str:
    """Ids that lost a leading zero: 9 or 11 characters get one back."""
    return f"CASE WHEN length({c}) IN (9, 11) THEN concat('0', {c}) ELSE {c} END"


def py_strip(c: str) -> str:
    """str.strip(): all leading/trailing whitespace, not only blanks."""
    return f"regexp_replace({c}, {lit(f'^{SPACE}+|{SPACE}+$')}, '')"


def grouped_int_sql(c: str) -> str:
    """Whole number with space thousands, SQL rounding (half away from zero)."""
    return f"translate(format_number(round({c}, 0), 0), ',', ' ')"


def grouped_int_py(c: str) -> str:
    """Whole number with space thousands, Python rounding (half to even)."""
    return f"translate(format_number(bround({c}, 0), 0), ',', ' ')"


def html_escape(c: str) -> str:
    """Escape & < > " ' the way html.escape does (& first)."""
    out = f"replace({c}, '&', '&amp;')"
    for ch, ent in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = f"replace({out}, {lit(ch)}, {lit(ent)})"
    return out
