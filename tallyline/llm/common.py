"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize_shared

WORD_RE = r"[^\x20\x09-\x0D]+"

#: bytes of text that one vectorised step inside a task handles at once
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: one write in the shared checkpoint folder, read back."""
    return materialize_shared(df, name)


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def bucket_of(col: Column, modulus: int) -> Column:
    """crc32(value as text) mod ``modulus``; null stays null."""
    return (F.crc32(col.cast("string").cast("binary")) % F.lit(modulus)).cast("int")


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cut a batch into row ranges of about ``limit`` bytes of ``column``, so
    that memory does not follow the batch size. A single longer text is a
    slice of its own."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def release() -> None:
    """Give memory that a task no longer uses back to the system: a Python
    worker is used again by later stages and would keep it until it ends."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def word_lists(text: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text (null: none) as one flat
    array, and the offsets of each text's words in it."""
    text = pc.fill_null(text, "")
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(text)
    flat, off = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not keep.all():
        off = np.concatenate([[0], np.cumsum(keep)])[off]
        flat = flat.filter(pa.array(keep))
    return flat, off.astype(np.int64)


def encoded_words(flat: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct words and the code of every word."""
    d = flat.dictionary_encode()
    return d.dictionary.to_pylist(), d.indices.to_numpy(zero_copy_only=False)
