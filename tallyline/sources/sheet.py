"""The hand-kept payment-terms sheet as CSV: S5 (+ P1, P3).

Everything is read as text with the header row naming the columns; the
mapping renames human headers to field names. Row order matters (the terms
column is forward-filled), so ``row_idx`` is assigned at the scan:
``monotonically_increasing_id`` is increasing within a split, and a quoted
multi-line CSV file is one split. Spark packs a folder's files by size, so
the ids only order the rows of one file; the files are ordered by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.coerce import cast_strict
from ..functions.sqlexpr import ident, lit

# FIXED VALUES: the sheet's human headers -> field names (all read as text)
TERMS_SHEET_COLUMNS = (
    ("Ответственный", "project", "string"),
    ("Юр. лицо (ИП/ООО)", "legal_entity", "string"),
    ("ИНН", "inn", "string"),
    ("На стопе", "stop_flg", "string"),
    ("Порог остатка", "deposit_min_value", "string"),
    ("Средний размер депозитов", "deposit_average_value", "string"),
    ("Депозит", "payment_type", "string"),
)


def read_sheet_csv(spark: SparkSession, path: str, columns=TERMS_SHEET_COLUMNS) -> DataFrame:
    """CSV with a header row -> mapped text columns + row_idx."""
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("inferSchema", False)
        .csv(path)
    )
    own = raw.selectExpr("monotonically_increasing_id() AS _row", "_metadata.file_path AS _file", "*")
    # files in the order of their names, rows in the order of each file
    files = own.groupBy("_file").agg(F.min("_row").alias("_first"))
    files = files.select("_file", "_first", F.row_number().over(Window.orderBy("_file")).alias("_nr"))
    ordered = own.join(files, "_file").withColumn("row_idx", (F.col("_nr") - 1) * F.lit(1 << 40) + F.col("_row") - F.col("_first"))
    return map_sheet(ordered, columns)


def parse_sheet_lines(lines: DataFrame, line_col: str, order_col: str, columns=TERMS_SHEET_COLUMNS) -> DataFrame:
    """S5 on a text column holding one CSV record per row (no header row)."""
    schema = ", ".join(f"{ident(h)} STRING" for h, _, _ in columns)
    opts = "map('ignoreLeadingWhiteSpace', 'false', 'ignoreTrailingWhiteSpace', 'false')"
    parsed = lines.selectExpr(
        f"{ident(order_col)} AS row_idx", f"from_csv({ident(line_col)}, {lit(schema)}, {opts}) AS _r"
    )
    return map_sheet(parsed.selectExpr("row_idx", "_r.*"), columns)


def map_sheet(raw: DataFrame, columns=TERMS_SHEET_COLUMNS) -> DataFrame:
    """P1 + P3: keep the mapped headers, rename, cast (no NULL default)."""
    return raw.selectExpr("row_idx", *[f"{cast_strict(ident(h), w)} AS {ident(t)}" for h, t, w in columns])
