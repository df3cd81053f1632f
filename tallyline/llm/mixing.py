"""Mixing sources to target weights by weighted sampling without replacement.

Method: Efraimidis-Spirakis. Every document gets an exponential key
``-ln(u) / quality`` (u from a hash of the document, so reruns agree); the
documents of a source, sorted by key, are taken until the source's token
budget is met. Complete epochs come first: a source whose budget is e times
its size and a rest gives every document e times, and only the rest is drawn.

The sort is never a whole source in one task. Keys are dealt into key ranges
(``rows_per_range`` documents each, more ranges for larger sources), sizes
are summed per range, the prefix sums run over those sums, and only the one
range of each source that holds the budget's end is sorted row by row. The
document at the budget's end is replaced by the document beyond it whose size
is closest to the words still missing, so a source misses its target by less
than a document.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, last in the order; repeated rows are separate
documents with equal keys, taken one by one where the budget ends in them
(columns beside ``tie`` decide nothing); a null, non-positive or non-finite quality counts
as ``MIN_QUALITY``; an empty table gives no rows; extra columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, stage, text_of

MIN_QUALITY = 0.05
MAX_EPOCHS = 3
ROWS_PER_RANGE = 4_000
#: equal rows that one part holds when they are told apart again
PART_ROWS = 1_000
#: symbols that prose has little of
SYMBOLS = "#$%&*|<>{}[]\\^~=+@_"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_RE)).cast("long")


def symbol_quality(text: Column) -> Column:
    """1 for plain prose, less with a growing share of symbols."""
    plain = F.length(F.translate(text, SYMBOLS, ""))
    share = 1 - plain / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(MIN_QUALITY), 1 - 4 * share)


def source_targets(sizes: DataFrame, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """source, source_size, n_docs, weight, target from one row per source.

    Targets share the total by weight; a target above ``max_epochs`` times
    the source's size is cut there and the excess shared among the others by
    weight until none is above. That is ``min(cap, level * weight)`` for one
    level, found by going through the sources in the order of cap / weight.
    One row per source passes the windows here, never a document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    w = sizes.withColumn("weight", ((rank - 1) % 3 + 1).cast("double"))
    w = w.withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    whole = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    w = (
        w.withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("caps", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weights", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("caps")) / F.col("weights"))
    )
    # the first source that stays below its cap sets the level of all others
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(whole)
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("cap") / F.col("weight"))).over(whole)
    first_level = F.min(F.when(F.col("cap") / F.col("weight") == F.col("first"), F.col("level"))).over(whole)
    w = w.withColumn("any_level", level).withColumn("first", first).withColumn("first_level", first_level)
    target = F.when(
        F.col("any_level").isNull(), F.col("cap")
    ).otherwise(F.least(F.col("cap"), F.col("first_level") * F.col("weight")))
    return w.select("source", "source_size", "n_docs", "weight", target.alias("target"))


def mix(docs: DataFrame, source: str, size: str, quality: str, tie: list[str], max_epochs: float = MAX_EPOCHS, rows_per_range: int = ROWS_PER_RANGE, seed: int = 17) -> DataFrame:
    """Add ``source_size``, ``target``, ``copies`` (times the document is
    taken) and ``taken`` (its words in the mix).

    ``tie`` names the columns that identify a document; they seed its key and
    break ties. ``docs`` is read several times: pass a stored table."""
    base = docs.withColumnRenamed(source, "source").withColumnRenamed(size, "size")
    # equal rows are one row with a count until the end
    base = base.groupBy(*base.columns).agg(F.count(F.lit(1)).alias("_m"))
    words = F.col("size") * F.col("_m")
    q = F.col(quality)
    q = F.when(q.isNull() | F.isnan(q) | ~(q > MIN_QUALITY) | (q == float("inf")), F.lit(MIN_QUALITY)).otherwise(q)
    h = F.xxhash64(F.lit(seed), *tie)
    # 53 bits of the hash: 0 < u < 1
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    keyed = base.withColumn("_key", -F.log(u) / q)

    sources = source_targets(base.groupBy("source").agg(F.sum(words).alias("source_size"), F.sum("_m").alias("n_docs")), max_epochs)
    sources = (
        sources.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
        .withColumn("_ranges", F.ceil(F.col("n_docs") / F.lit(rows_per_range)))
    )
    sources = stage(sources, "mix-sources")
    same = F.col("source").eqNullSafe(F.col("_s"))

    def add(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.withColumnRenamed("source", "_s"), same, "left").drop("_s")

    full = add(keyed, sources.drop("n_docs", "weight"))
    # of documents of any quality, at most a share of 1 / (e * scale) has
    # floor(ln(key) * scale) in common
    full = full.withColumn("_range", F.floor(F.log(F.greatest("_key", F.lit(1e-300))) * F.col("_ranges")))

    per = full.groupBy("source", "_range").agg(F.sum(words).alias("words"))
    run = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    per = add(per, sources.select("source", "_rest")).withColumn("upto", F.sum("words").over(run))
    last = (
        per.where(F.col("upto") > F.col("_rest"))
        .groupBy("source")
        .agg(F.min_by(F.struct("_range", "words", "upto"), "_range").alias("e"))
        .select("source", F.col("e._range").alias("_end"), (F.col("e.upto") - F.col("e.words")).alias("_before"))
    )
    last = stage(last, "mix-ends")
    full = add(full, last)

    order = Window.partitionBy("source").orderBy("_key", *tie).rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        full.where(F.col("_range") == F.col("_end"))
        .withColumn("_upto", F.col("_before") + F.sum(words).over(order))
        .withColumn("_nr", F.row_number().over(order))
    )
    ends = stage(ends.select("source", "_key", "_nr", "_upto", "_rest", "_before", "size", *tie), "mix-end-ranges")
    # the last document that still fits, per source
    cut = ends.groupBy("source").agg(
        F.max(F.when(F.col("_upto") <= F.col("_rest"), F.struct("_key", "_nr", *tie))).alias("_cut"),
        F.coalesce(F.max(F.when(F.col("_upto") <= F.col("_rest"), F.col("_upto"))), F.first("_before")).alias("_got"),
    )
    full = add(full, cut)
    me = F.struct("_key", *tie)
    upto = F.struct("_cut._key", *[F.col(f"_cut.{t}").alias(t) for t in tie])
    inside = (F.col("_range") < F.col("_end")) | F.col("_end").isNull() | ((F.col("_range") == F.col("_end")) & F.col("_cut").isNotNull() & (me <= upto))
    drawn = (F.col("_rest") > 0) & (F.col("size") > 0)
    full = full.withColumn("_n_in", F.when(drawn & F.coalesce(inside, F.lit(False)), F.col("_m")).otherwise(F.lit(0)).cast("long"))
    # of the equal rows that the budget ends in, as many as fit
    edge = ends.where((F.col("_upto") > F.col("_rest")) & (F.col("size") > 0)).groupBy("source").agg(F.min(F.struct("_key", "_nr", "size", *tie)).alias("_edge"))
    full = add(full, stage(edge, "mix-edges"))
    room = F.col("_rest") - F.col("_got")
    at_edge = F.col("_edge").isNotNull() & (me == F.struct("_edge._key", *[F.col(f"_edge.{t}").alias(t) for t in tie]))
    fit = F.floor(room / F.greatest(F.col("size"), F.lit(1))).cast("long")
    full = full.withColumn("_n_in", F.when(drawn & F.coalesce(at_edge, F.lit(False)), F.least(fit, F.col("_m"))).otherwise(F.col("_n_in")))

    # one closing document per source: beyond the cut, closest to what is missing
    gap = room - F.coalesce(F.floor(room / F.col("_edge.size")) * F.col("_edge.size"), F.lit(0))
    off = F.abs(F.col("size") - gap)
    closing = (
        full.where((F.col("_n_in") < F.col("_m")) & (F.col("size") > 0) & (off < gap))
        .groupBy("source")
        .agg(F.min(F.struct(off.alias("off"), F.col("_key"), *tie)).alias("_close"))
    )
    closing = stage(closing, "mix-closing")
    full = add(full, closing)
    is_close = F.col("_close").isNotNull() & (F.col("_n_in") < F.col("_m")) & (
        F.struct("_key", *tie) == F.struct("_close._key", *[F.col(f"_close.{t}").alias(t) for t in tie])
    )
    full = full.withColumn("_n_in", F.col("_n_in") + F.when(F.coalesce(is_close, F.lit(False)), 1).otherwise(0))
    # every row again, the equal ones in parts that may go to several tasks
    full = full.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_m - 1) div {PART_ROWS}"))))
    full = full.repartition(*tie, "_part").withColumn(
        "_i", F.explode(F.expr(f"sequence(_part * {PART_ROWS} + 1, least(_m, (_part + 1) * {PART_ROWS}))"))
    )
    copies = F.col("_epochs") + F.when(F.col("_i") <= F.col("_n_in"), 1).otherwise(0)
    copies = F.when(F.col("size") > 0, copies).otherwise(0).cast("long")
    drop = ["_m", "_key", "_epochs", "_rest", "_ranges", "_range", "_end", "_before", "_cut", "_got", "_n_in", "_edge", "_close", "_part", "_i"]
    return (
        full.withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop(*drop)
        .withColumnRenamed("source", source)
        .withColumnRenamed("size", size)
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text hash, source, size, source_size, target, copies, taken of
    every row of ``docs`` (doc_id, text, source)."""
    text = text_of()
    narrow = docs.select(
        F.col("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col("source").cast("string").alias("source"),
        n_words(text).alias("size"),
        symbol_quality(text).alias("quality"),
    )
    return mix(stage(narrow, "mix-docs"), "source", "size", "quality", ["doc_id", "text_hash"], **options).drop("quality")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    text = text_of()
    picked = mix_documents(docs, **options).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("source").alias("__source"), F.col("copies").alias("__copies")
    )
    # equal rows are taken __low times each, and __more of them once more
    picked = picked.groupBy("__id", "__hash", "__source").agg(F.sum("__copies").alias("__sum"), F.count(F.lit(1)).alias("__n"))
    picked = picked.where("__sum > 0").selectExpr("__id", "__hash", "__source", "__sum div __n AS __low", "__sum % __n AS __more")
    picked = stage(picked, "mix-picked")
    same = (
        F.col("doc_id").eqNullSafe(F.col("__id"))
        & (F.xxhash64(text) == F.col("__hash"))
        & F.col("source").cast("string").eqNullSafe(F.col("__source"))
    )
    times = F.explode(F.sequence(F.lit(1), F.col("__low").cast("int")))
    whole = docs.join(picked.where("__low > 0"), same).withColumn("__copy", times).select(*docs.columns)
    # at most two groups of equal rows a source; only rows that differ in
    # further columns are told apart there
    some = docs.join(picked.where("__more > 0"), same).groupBy(*docs.columns, "__id", "__hash", "__source", "__more").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__id", "__hash", "__source").orderBy(F.xxhash64(*docs.columns)).rowsBetween(Window.unboundedPreceding, -1)
    some = some.withColumn("__n", F.least(F.col("__n"), F.col("__more") - F.coalesce(F.sum("__n").over(before), F.lit(0)))).where("__n > 0")
    some = some.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__n - 1) div {PART_ROWS}"))))
    some = some.withColumn("__copy", F.explode(F.expr(f"sequence(__part * {PART_ROWS} + 1, least(__n, (__part + 1) * {PART_ROWS}))")))
    return whole.unionByName(some.select(*docs.columns))
