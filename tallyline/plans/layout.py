"""Invoice tables that meet without a shuffle.

Invoices, their lines and the lines of live receipts are all read by invoice
id, by every run. ``colocate`` stores them once as tables bucketed and sorted
by it: the line pick (W4), the receipt sums (A3) and the joins of the
enrichment (J8) then work bucket by bucket, with no exchange before the first
dimension join. Which receipts are live (R3) is settled when the tables are
stored, where receipt lines meet their receipts by receipt id.

The number of buckets is the same for all three and follows the largest
table's rows, as a task holds a whole bucket of each; tables of another number
are stored anew.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import invoices
from ..sinks import tables
from .pipeline import INPUT_TABLES, Inputs

KEY = "invoice_id"
#: rows of the largest table in one bucket, and the fewest buckets
BUCKET_ROWS = 2_000_000
LEAST = 8
PREFIX = "by_invoice_"


def buckets_for(inputs: Inputs) -> int:
    most = max(inputs[n].count() for n in ("invoice", "invoice_line", "receipt_line"))
    return max(LEAST, -(-most // BUCKET_ROWS))


def colocate(spark: SparkSession, inputs: Inputs, database: str, buckets: int | None = None) -> Inputs:
    """Store the invoice facts by invoice id; the inputs with these in place.
    Without ``buckets`` their number follows from the rows."""
    buckets = buckets or buckets_for(inputs)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    live = invoices.live_receipt_lines(inputs["receipt"], inputs["receipt_line"])
    stored = {"invoice": inputs["invoice"], "invoice_line": inputs["invoice_line"], "live_receipt_line": live}
    for name, df in stored.items():
        tables.full_refresh(df, f"{database}.{PREFIX}{name}", bucket_by=(buckets, KEY))
    return colocated(spark, inputs, database)


def colocated(spark: SparkSession, inputs: Inputs, database: str) -> Inputs:
    """The inputs with tables that ``colocate`` stored earlier."""
    own = {n: (lambda n=n: spark.table(f"{database}.{PREFIX}{n}")) for n in ("invoice", "invoice_line", "live_receipt_line")}
    return Inputs({**{n: (lambda n=n: inputs[n]) for n in INPUT_TABLES}, **own})
