"""Document fingerprints: a threshold-scaled sketch of word shingles.

A fingerprint holds every 64-bit hash of a five-word shingle that lies below
a fixed fraction (1 / ``SCALE``) of the hash space. The union of two
fingerprints is the fingerprint of the union, and overlaps of fingerprints
estimate overlaps of the documents, however unequal their lengths. A text
whose hashes all lie above the fraction keeps its smallest one, so that any
text with a word has a fingerprint; a text of fewer than five words is one
shingle.

Everything is DataFrame functions; the text of the next document comes by a
window over ranges of ids, with the first row of every range copied into the
range before it, so that the text is shuffled once and a window holds
about ``RANGE_ROWS`` rows; rows that repeat one id stay together in one.

Defined results: a null text is empty; texts without words have the
fingerprint of no hashes, and are like each other only; a null id comes
first; rows that repeat an id follow each other in the order of their text's
hash; a single row is followed by itself; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_of

SHINGLE = 5
SCALE = 8
RANGE_ROWS = 2_000
MAX_SPLITS = 1_024
_LEAST = -(1 << 63)


def add_sketch(df: DataFrame, text_col: str, out: str, scale: int = SCALE) -> DataFrame:
    """Add ``out``: the sorted hashes that the sketch of ``text_col`` keeps."""
    words = F.filter(F.split(F.lower(F.col(text_col)), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = df.withColumn("_w", F.transform(words, lambda w: F.xxhash64(w)))
    shingles = F.when(
        F.size("_w") >= SHINGLE,
        F.transform(
            F.sequence(F.lit(0), F.size("_w") - SHINGLE),
            lambda i: F.xxhash64(*[F.get(F.col("_w"), i + j) for j in range(SHINGLE)]),
        ),
    ).when(F.size("_w") > 0, F.array(F.xxhash64("_w"))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_s", shingles)
    limit = _LEAST + (1 << 64) // scale
    df = df.withColumn("_k", F.filter("_s", lambda h: h < F.lit(limit)))
    least = F.when(F.size("_s") > 0, F.array(F.array_min("_s"))).otherwise(F.col("_s"))
    kept = F.when(F.size("_k") > 0, F.array_sort(F.array_distinct("_k"))).otherwise(least)
    return df.withColumn(out, kept).drop("_w", "_s", "_k")


def fingerprint_text(sketch: Column, scale: int = SCALE) -> Column:
    """``<scale>:`` and the hashes as 16 hex digits each."""
    return F.concat(F.lit(f"{scale}:"), F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard estimate of two sketches; two of no hashes are alike."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.coalesce(F.try_divide(both, F.size(a) + F.size(b) - both), F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Share of ``a`` that ``b`` holds, estimated; 1 for an ``a`` of none."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(a)), F.lit(1.0))


def _ranges(ids: DataFrame, range_rows: int) -> tuple[Column, int]:
    """Range number of a row by its ``_id``, from at most ``MAX_SPLITS``
    quantiles and equal steps between two of them."""
    n = ids.count()
    wanted = max(1, -(-n // range_rows))
    splits = min(wanted, MAX_SPLITS)
    steps = -(-wanted // splits)
    at = [i / splits for i in range(splits + 1)]
    cuts = sorted(set(ids.agg(F.percentile_approx("_id", at, 10_000)).first()[0] or [0])) if n else [0]
    table = F.array(*[F.lit(c) for c in cuts])
    i = F.greatest(F.size(F.filter(table, lambda c: c <= F.col("_id"))), F.lit(1))
    low, high = F.get(table, i - 1), F.coalesce(F.get(table, i), F.lit(cuts[-1]))
    share = (F.col("_id").cast("double") - low.cast("double")) / F.greatest(high.cast("double") - low.cast("double"), F.lit(1.0))
    step = F.least(F.greatest(F.floor(share * steps), F.lit(0)), F.lit(steps - 1))
    return (i * steps + step).cast("long"), n


def with_next(docs: DataFrame, carried: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add ``next_<c>`` for the columns ``carried`` of the row that follows
    in the order of doc_id (after the last: the first)."""
    docs = docs.withColumn("_id", F.coalesce(F.col("doc_id"), F.lit(_LEAST)))
    number, n = _ranges(docs.select("_id"), range_rows)
    docs = docs.withColumn("_range", number)
    # one row per range: the first id goes to the range before, the very first to the last
    firsts = docs.groupBy("_range").agg(F.min("_id").alias("_id"))
    order = Window.orderBy("_range")
    last = F.max("_range").over(Window.partitionBy())
    firsts = firsts.select("_id", F.coalesce(F.lag("_range").over(order), last).alias("_to"), F.lag("_range").over(order).isNull().alias("_wrap"))
    # written first, so that the planner knows how few rows they are
    firsts = stage(firsts, "fingerprint-firsts")
    places = F.array(
        F.struct(F.col("_range").alias("r"), F.lit(0).alias("ghost")),
        F.struct(F.col("_to").alias("r"), F.when(F.col("_wrap"), 2).otherwise(1).alias("ghost")),
    )
    rows = docs.join(firsts, "_id", "left").withColumn("_p", F.explode(F.filter(places, lambda p: p["r"].isNotNull())))
    w = Window.partitionBy("_p.r").orderBy(F.col("_p.ghost") == 2, "_id", F.col("_p.ghost"), "_order")
    rows = rows.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
    return rows.where(F.col("_p.ghost") == 0).drop("_p", "_range", "_to", "_wrap", "_id")


def fingerprint_documents(docs: DataFrame, scale: int = SCALE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next: see the module for the edited text."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    base = base.withColumn("_order", F.xxhash64("text"))
    rows = with_next(add_sketch(base, "text", "sketch", scale), ["text", "sketch"], range_rows)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = add_sketch(rows, "edited", "edited_sketch", scale)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("sketch"), scale).alias("fingerprint"),
        fingerprint_text(F.col("edited_sketch"), scale).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
