"""Type coercion by mapping (P2, P3, P4), as Spark SQL expression text."""

from __future__ import annotations

from .sqlexpr import lit

# Sentinels meaning "no date" in landed records.
DATE_SENTINELS = ("0", "0000-00-00", "0000-00-00 00:00:00", "")
# Range a nanosecond timestamp can hold; outside it the original got NULL.
TS_MIN = "1677-09-22 00:00:00"
TS_MAX = "2262-04-11 00:00:00"

TYPE_WORDS = {
    "datetime": "timestamp_ntz",
    "int": "bigint",
    "float": "double",
    "money": "decimal(18,2)",
    "string": "string",
    "boolean": "boolean",
}


# a time of day followed by Z or a UTC offset
ZONED = r"\d{2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)$"


def coerce_datetime(c: str) -> str:
    """Sentinels and unparseable text -> NULL; a wall clock without an
    offset is kept, one with an offset becomes UTC."""
    text = f"trim(CAST({c} AS STRING))"
    utc = f"convert_timezone(current_timezone(), 'UTC', CAST(try_cast({text} AS TIMESTAMP) AS TIMESTAMP_NTZ))"
    parsed = f"IF({text} RLIKE {lit(ZONED)}, {utc}, try_cast({text} AS TIMESTAMP_NTZ))"
    sentinels = ", ".join(lit(s) for s in DATE_SENTINELS)
    return (
        f"CASE WHEN {text} IS NULL OR {text} IN ({sentinels}) THEN CAST(NULL AS TIMESTAMP_NTZ) "
        f"WHEN {parsed} >= TIMESTAMP_NTZ'{TS_MIN}' AND {parsed} < TIMESTAMP_NTZ'{TS_MAX}' THEN {parsed} END"
    )


def coerce_number_default(c: str, type_word: str) -> str:
    """P2 (landed-record flavour): NULL -> 0, then cast; bad text raises (ANSI)."""
    t = TYPE_WORDS[type_word]
    return f"coalesce({cast_strict(c, type_word)}, CAST(0 AS {t}))"


def cast_strict(c: str, type_word: str) -> str:
    """P3 (sheet flavour): plain cast, NULL stays NULL; unknown words pass."""
    if type_word == "datetime":
        return coerce_datetime(c)
    if type_word not in TYPE_WORDS:
        return c
    if type_word == "int":  # '5.0' and '12.7' are whole numbers 5 and 12
        return f"CAST(CAST({c} AS DECIMAL(38,10)) AS {TYPE_WORDS[type_word]})"
    return f"CAST({c} AS {TYPE_WORDS[type_word]})"


def coerce_by_word(c: str, type_word: str, null_default: bool) -> str:
    if type_word == "datetime":
        return coerce_datetime(c)
    if type_word in ("int", "float", "money") and null_default:
        return coerce_number_default(c, type_word)
    return cast_strict(c, type_word)
