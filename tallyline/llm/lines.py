"""Line dedup by a log-template tree.

A line's tokens are parsed to a fixed depth: by token count, then by the
leading tokens. Tokens with a digit are variable fields (``<*>``). In lines
of ``SHORT`` to ``LONG`` tokens the leading ``LEAD`` share (``MIN_LEAD``
tokens at least) is the path in the tree and everything behind it a wildcard;
shorter and longer lines are parsed to their last token. The leaf is the
line's template.

Evidence are distinct texts, not documents. Templates that ``MIN_DOCS`` texts
hold are common; a text's other lines are its own. A common template recurs
when texts with ``MIN_DOCS`` different sets of own lines hold it whose own
lines are ``OWN_SHARE`` of their tokens or more. Copies share their own lines,
and near copies have few: that tells boilerplate from the lines of copied
documents, which stay for the near-duplicate operators. All lines of recurring
templates are dropped, in copies as well.

Only distinct (template, text) pairs and the common lines are shuffled to
count.

Defined results: a null text is empty and has no lines; lines without tokens
are never dropped; a document may lose all lines and then is empty; rows that
repeat an id and text count as one document and get equal results; an empty
table gives no rows; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of

MIN_DOCS = 20
OWN_SHARE = 0.5
SHORT, LONG = 6, 16
MIN_LEAD, LEAD = 4, 0.6
_WS = r"\x20\x09-\x0D"
_FIELD = rf"(?<![^{_WS}])[^{_WS}0-9]*+[0-9][^{_WS}]*+"


def _depth(n: Column) -> Column:
    """How many leading tokens a line of n tokens is parsed to."""
    lead = F.greatest(F.lit(MIN_LEAD), F.ceil(n * LEAD).cast("int"))
    return F.when((n >= SHORT) & (n <= LONG), lead).otherwise(n)


def add_templates(df: DataFrame, text_col: str) -> DataFrame:
    """Add ``lines`` (array<string>) and ``keys`` (array<bigint>), the
    template of each line, null for a line without tokens."""
    text = F.col(text_col)
    df = df.withColumn("lines", F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n")))
    masked = F.transform("lines", lambda x: F.when(x.rlike("[0-9]"), F.regexp_replace(x, _FIELD, "<*>")).otherwise(x))
    df = df.withColumn("_masked", masked)
    df = df.withColumn("_t", F.transform("_masked", lambda x: F.filter(F.split(x, f"[{_WS}]+"), lambda w: w != "")))
    keys = F.transform("_t", lambda t: F.when(F.size(t) > 0, F.xxhash64(F.size(t), F.slice(t, F.lit(1), _depth(F.size(t))))))
    return df.withColumn("keys", keys).withColumn("sizes", F.transform("_t", F.size)).drop("_masked", "_t")


def _keyed(docs: DataFrame) -> DataFrame:
    base = docs.select(F.col("doc_id"), text_of().alias("_text")).withColumn("text_hash", F.xxhash64("_text"))
    return add_templates(base, "_text")


def _mark(key: Column) -> Column:
    """36 bits of a key, which can be added up."""
    return F.shiftrightunsigned(key, 28)


def size_table(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, pos, key, n (tokens), total (tokens of the text),
    mark (sum over its lines): one row per line with a key."""
    base = _keyed(docs).select("doc_id", "text_hash", "keys", "sizes")
    zero = F.lit(0).cast("long")
    base = base.withColumn("total", F.aggregate("sizes", zero, lambda x, n: x + n))
    base = base.withColumn("mark", F.aggregate("keys", zero, lambda x, k: x + F.coalesce(_mark(k), zero)))
    places = F.transform("keys", lambda k, i: F.struct(i.alias("pos"), k.alias("key"), F.get("sizes", i).alias("n")))
    rows = base.withColumn("p", F.explode(F.filter(places, lambda p: p["key"].isNotNull())))
    return rows.select("doc_id", "text_hash", "p.pos", "p.key", "p.n", "total", "mark")


def witnessed(table: DataFrame, min_docs: int = MIN_DOCS, own_share: float = OWN_SHARE) -> DataFrame:
    """key of the templates that recur in texts with own lines."""
    texts = table.select("key", "text_hash").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("texts"))
    common = stage(texts.where(F.col("texts") >= min_docs).select("key"), "lines-common")
    shared = stage(table.join(common, "key").select("text_hash", "pos", "key", "n", "total", "mark").distinct(), "lines-shared")
    own = shared.groupBy("text_hash", "total", "mark").agg(F.sum("n").alias("n"), F.sum(_mark(F.col("key"))).alias("marks"))
    own = own.where(F.col("total") - F.col("n") >= F.lit(own_share) * F.col("total")).select("text_hash", (F.col("mark") - F.col("marks")).alias("own"))
    pairs = shared.select("key", "text_hash").distinct().join(own, "text_hash").select("key", "own").distinct()
    return pairs.groupBy("key").agg(F.count(F.lit(1)).alias("owns")).where(F.col("owns") >= min_docs).select("key")


def drop_boilerplate(docs: DataFrame, min_docs: int = MIN_DOCS, own_share: float = OWN_SHARE) -> DataFrame:
    """All columns of ``docs`` with ``text`` rid of recurring lines, and
    ``__n_lines`` and ``__n_dropped``."""
    table = stage(size_table(docs), "lines")
    return _without(docs, table, stage(witnessed(table, min_docs, own_share), "lines-recurring"))


def _without(docs: DataFrame, table: DataFrame, gone: DataFrame) -> DataFrame:
    drop = table.join(gone, "key").select("doc_id", "text_hash", "pos").distinct()
    drop = drop.groupBy("doc_id", "text_hash").agg(F.collect_list("pos").alias("__drop"))
    drop = drop.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__th"), "__drop")
    here = docs.withColumn("__h", F.xxhash64(text_of()))
    both = here.join(drop, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left")
    lines = F.when(text_of() == "", F.array().cast("array<string>")).otherwise(F.split(text_of(), "\n"))
    both = both.withColumn("__lines", lines)
    kept = F.array_join(F.filter("__lines", lambda x, i: ~F.array_contains(F.col("__drop"), i)), "\n")
    text = F.when(F.col("__drop").isNull(), F.col("text")).otherwise(kept)
    out = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return both.select(*out, F.size("__lines").alias("__n_lines"), F.coalesce(F.size("__drop"), F.lit(0)).alias("__n_dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, own_share: float = OWN_SHARE) -> DataFrame:
    """doc_id, text (rid of recurring lines), n_lines, n_dropped."""
    got = drop_boilerplate(docs.select("doc_id", "text"), min_docs, own_share)
    return got.withColumnRenamed("__n_lines", "n_lines").withColumnRenamed("__n_dropped", "n_dropped")


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), x AS (
  SELECT text, string_split(text, chr(10)) AS lines FROM d WHERE text <> '' GROUP BY text
), l AS (
  SELECT text, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM x
), t AS (
  SELECT text, line, pos, list_filter(regexp_split_to_array(
    regexp_replace(line, '[^{_WS}0-9]*[0-9][^{_WS}]*', '<*>', 'g'), '[{_WS}]+'), lambda w: w <> '') AS tok FROM l
), k AS (
  SELECT text, line, pos, len(tok) AS n, CASE WHEN len(tok) = 0 THEN NULL WHEN len(tok) BETWEEN {SHORT} AND {LONG}
    THEN row(len(tok), tok[1:greatest({MIN_LEAD}, CAST(ceil(len(tok) * {LEAD}) AS INTEGER))]) ELSE row(len(tok), tok) END AS key FROM t
), c AS (
  SELECT key FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT text) >= {MIN_DOCS}
), o AS (
  SELECT text, list(hash(key) ORDER BY hash(key)) FILTER (key NOT IN (SELECT key FROM c)) AS own
  FROM k WHERE key IS NOT NULL GROUP BY text
  HAVING coalesce(sum(n) FILTER (key NOT IN (SELECT key FROM c)), 0) >= {OWN_SHARE} * sum(n)
), r AS (
  SELECT key FROM k JOIN o USING (text) WHERE key IN (SELECT key FROM c) GROUP BY key HAVING count(DISTINCT own) >= {MIN_DOCS}
), s AS (
  SELECT text, count(*) AS n_lines, count(*) FILTER (key IS NOT NULL AND key IN (SELECT key FROM r)) AS n_dropped,
    string_agg(line, chr(10) ORDER BY pos) FILTER (key IS NULL OR key NOT IN (SELECT key FROM r)) AS kept
  FROM k GROUP BY text
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_dropped, 0) AS INTEGER) AS n_dropped,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (text)
"""
