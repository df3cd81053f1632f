"""Keyed upsert of incremental loads (S3 + K5).

An incremental load may come again: after a crash, from a scheduler's retry,
or with newer versions of documents that were loaded before. Rows are merged
by document key, so the outcome does not depend on how often a load ran:

* ``latest_versions`` keeps one version of each document of a batch;
* ``merge_by_key`` replaces all rows of the batch's documents. Tables are
  partitioned by the month of the document (``PART``); only partitions that
  hold old or new rows of these documents are read and written anew, by a
  dynamic partition overwrite of rows that were written to the shared
  checkpoint folder first;
* a ledger table names the batches that were applied, by a fingerprint of the
  landed files, so that the same batch is not even read again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sqlexpr import ident, lit
from ..session import landed_files
from .tables import append, full_refresh, replace_partitions, table_exists

#: partition column: month of the document, or ``NO_MONTH``
PART, NO_MONTH = "doc_month", "none"
LEDGER = "ingest_ledger"


def month_of(date_expr: str) -> str:
    return f"coalesce(date_format({date_expr}, 'yyyy-MM'), '{NO_MONTH}')"


def latest_versions(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key: the largest by ``order`` (SQL), ties by content. A
    partial aggregate, so a key that comes very often collapses map-side."""
    whole = f"struct({', '.join(map(ident, rows.columns))})"
    rank = f"struct({', '.join([*order, f'to_json({whole})'])})"
    return rows.groupBy(ident(key)).agg(F.expr(f"max_by({whole}, {rank})").alias("_row")).select("_row.*")


def merge_by_key(rows: DataFrame, name: str, key: str, old_part: DataFrame | None = None) -> None:
    """Replace the rows of all keys of ``rows`` (with ``PART``) in table
    ``name``. A table without ``PART`` is partitioned first: ``old_part``
    gives (key, PART) of its documents."""
    spark = rows.sparkSession
    if not table_exists(spark, name):
        rows.write.partitionBy(PART).saveAsTable(name)
        return
    if PART not in spark.table(name).columns:
        if old_part is None:
            raise ValueError(f"{name} has no column {PART}")
        with_part = spark.table(name).join(old_part, key, "left").fillna(NO_MONTH, [PART])
        full_refresh(with_part, name, partition_by=(PART,))
    target = spark.table(name)
    keys = rows.select(key).distinct()
    # the key and the partition are all that is read of the whole table
    touched = target.join(keys, key, "left_semi").select(PART).unionByName(rows.select(PART)).distinct()
    months = [r[0] for r in touched.collect()]  # as many as partitions, not rows
    kept = target.where(F.col(PART).isin(months)).join(keys, key, "left_anti")
    # documents may all have left a month
    replace_partitions(kept.unionByName(rows.select(*kept.columns)), name, PART, months)


def fingerprint(spark: SparkSession, path: str, *settings) -> str:
    """Of the landed files (names, sizes, modification times) and what is
    asked of them."""
    return hashlib.sha256(repr((landed_files(spark, path), settings)).encode()).hexdigest()


def applied(spark: SparkSession, database: str, entity: str, batch: str) -> bool:
    name = f"{database}.{LEDGER}"
    if not table_exists(spark, name):
        return False
    return not spark.table(name).where((F.col("entity") == entity) & (F.col("batch") == batch)).isEmpty()


def note_applied(spark: SparkSession, database: str, entity: str, batch: str, documents: int, records: int) -> None:
    row = f"SELECT {lit(entity)} AS entity, {lit(batch)} AS batch, {documents}L AS documents, {records}L AS records, current_timestamp() AS at"
    append(spark.sql(row), f"{database}.{LEDGER}")
