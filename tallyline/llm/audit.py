"""Filter interaction audit: what every order of five document filters
removes, keeps and loses, counted in one incremental pass over the files.

Method: a stream reads all files as available-now micro-batches. A document's
mask holds the filters that it fails; A to D need its text alone. E ("a smaller doc_id has the same text") needs all other documents:
state keyed by text keeps the smallest id seen so far, and when a smaller one
arrives it retracts the mask that it counted earlier, without E, and counts
it again with E. What leaves the stream are deltas of the part counters (an
exactly-once file sink); their sums over all micro-batches are the documents
per part and mask, from which the 120 orders follow by arithmetic on at most
32 masks a part.

Scale: texts never leave the scan; a row of about 100 bytes a document is
shuffled twice (to its labels, to its text's state). Copies of a text that
arrive in one Arrow batch are combined before the shuffle, so a text that a
third of all rows hold reaches its state as a few rows a batch. The state of
about ``GROUP_TEXTS`` texts is one entry of the state store (a Python call
for each single text would cost more than its work); it lies in RocksDB,
beyond memory, with its log in the shared checkpoint folder, so a lost
executor's state is rebuilt from there.

Odd cases: null text is the empty text; null doc_id is smaller than nothing
and nothing is smaller than it, so such a row never fails E and makes none
fail; rows that repeat a doc_id and text do not make each other fail; several
label rows of one doc_id count as one that is 1 where any of them is; an
empty table has no parts and gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from contextlib import contextmanager
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..session import shared_stage_path
from .common import stage, text_of

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
ORDERS = ["".join(p) for p in permutations(FILTERS)]

#: micro-batches that the files are dealt to (fewer where there are fewer files)
BATCHES = 8
#: texts that share one entry of the state store, on average
GROUP_TEXTS = 512
#: parts that rows of one doc_id are dealt to where they meet the labels
SALTS = 8
#: state beyond memory; only changes go to the shared folder at each commit;
#: no space is set aside (4 MB a state partition) before it is needed
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

COMBINED = "bucket long, text_key string, doc_id long, later boolean, part string, mask int, good int, toxic int, n long"
DELTA = "part string, mask int, good int, toxic int, n long"
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"#$%&*|"


def text_mask(text: bytes, length: int) -> int:
    """The failures of A to D of a text of ``length`` code points, as a bit
    mask. ``bytes.split`` splits at the six ASCII white space characters."""
    words = text.split()
    mask = BIT["A"] if len(words) < 100 else 0
    if 100 * len(set(words)) < 80 * len(words):
        mask |= BIT["B"]
    if 100 * (len(text) - len(text.translate(None, _UPPER))) > 10 * length:
        mask |= BIT["C"]
    if len(text.translate(None, _MARKS)) < len(text):
        mask |= BIT["D"]
    return mask


def judge(batches):
    """(doc_id, part, text) to (doc_id, part, text_key, mask)."""
    for batch in batches:
        text = batch.column("text")
        keys, masks = [], []
        for value, length in zip(text.cast(pa.binary()), pc.utf8_length(text).to_pylist()):
            value = value.as_py()
            keys.append(hashlib.sha256(value).hexdigest()[:32])
            masks.append(text_mask(value, length))
        columns = [batch.column("doc_id"), batch.column("part"), pa.array(keys, pa.string()), pa.array(masks, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "text_key", "mask"])


def reduced_labels(labels: DataFrame) -> DataFrame:
    """One row a doc_id, dealt to every salt."""
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    one = one.agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    return one.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))


def audited_rows(docs: DataFrame, labels: DataFrame, groups: int) -> DataFrame:
    """The narrow row of every document; works on streams and on tables."""
    part = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part, text_of().alias("text"))
    rows = rows.mapInArrow(judge, "doc_id long, part string, text_key string, mask int")
    spread = F.when(F.col("doc_id").isNull(), F.lit(1 << 20)).otherwise(F.lit(SALTS))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("text_key", "part"), spread).cast("int"))
    rows = rows.join(labels, ["doc_id", "salt"], "left")
    zero = F.lit(0)
    return rows.select(
        F.pmod(F.xxhash64("text_key"), F.lit(groups)).alias("bucket"),
        "text_key",
        "doc_id",
        "part",
        "mask",
        F.coalesce("good", zero).alias("good"),
        F.coalesce("toxic", zero).alias("toxic"),
    )


def combine(batches):
    """Within an Arrow batch: rows of a text's smallest id stay apart, later
    ids and rows without one become counts."""
    kept = ["bucket", "text_key", "doc_id", "later", "part", "mask", "good", "toxic"]
    for batch in batches:
        rows = batch.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        least = rows.groupby("text_key")["doc_id"].transform("min")
        rows["later"] = (rows["doc_id"] > least).fillna(False).astype(bool)
        rows["doc_id"] = rows["doc_id"].mask(rows["later"])
        out = rows.groupby(kept, dropna=False, sort=False).size().reset_index(name="n")
        yield pa.RecordBatch.from_pandas(out, schema=_COMBINED, preserve_index=False)


_COMBINED = pa.schema(
    [
        ("bucket", pa.int64()),
        ("text_key", pa.string()),
        ("doc_id", pa.int64()),
        ("later", pa.bool_()),
        ("part", pa.string()),
        ("mask", pa.int32()),
        ("good", pa.int32()),
        ("toxic", pa.int32()),
        ("n", pa.int64()),
    ]
)


def retract(held: dict, rows) -> Counter:
    """Apply rows (text_key, doc_id, later, part, mask, good, toxic, n) to the
    state ``held`` {text_key: [smallest id, mask, {(part, good, toxic): n}]};
    what changes in the counters (part, mask, good, toxic)."""
    delta: Counter = Counter()
    e = BIT["E"]
    for text, doc_id, later, part, mask, good, toxic, n in rows:
        if later:
            delta[part, mask | e, good, toxic] += n
            continue
        if doc_id is None:
            delta[part, mask, good, toxic] += n
            continue
        known = held.get(text)
        if known and known[0] < doc_id:
            delta[part, mask | e, good, toxic] += n
            continue
        if known is None or doc_id < known[0]:
            for (p, g, t), k in known[2].items() if known else ():
                delta[p, mask, g, t] -= k
                delta[p, mask | e, g, t] += k
            known = held[text] = [doc_id, mask, {}]
        own = (part, good, toxic)
        known[2][own] = known[2].get(own, 0) + n
        delta[part, mask, good, toxic] += n
    return delta


def _update(key, frames, state):
    held = {}
    if state.exists:
        for text, doc_id, mask, owners in json.loads(state.get[0]):
            held[text] = [doc_id, mask, {tuple(o[:3]): o[3] for o in owners}]
    delta: Counter = Counter()
    for f in frames:
        ids = [None if pd.isna(x) else int(x) for x in f["doc_id"]]
        columns = [f[c].tolist() for c in ("later", "part", "mask", "good", "toxic", "n")]
        delta.update(retract(held, zip(f["text_key"].tolist(), ids, *columns)))
    entries = [[t, i, m, [[*o, n] for o, n in owners.items()]] for t, (i, m, owners) in held.items()]
    state.update((json.dumps(entries),))
    rows = [(*k, n) for k, n in delta.items() if n]
    if rows:
        yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """The session's settings ``conf`` for a while."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES, group_texts: int = GROUP_TEXTS) -> DataFrame:
    """Documents per (part, mask, good, toxic) of the Parquet files at
    ``path``, kept by the stream."""
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    groups = max(1, -(-table.count() // group_texts))
    labels = stage(reduced_labels(labels), "audit-labels")
    # a pattern of one name: a plain path would have to be a folder
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // batches))).parquet(pattern)
    narrow = audited_rows(stream, labels, groups).mapInArrow(combine, COMBINED)
    deltas = narrow.groupBy("bucket").applyInPandasWithState(
        _update, DELTA, "entries string", "append", GroupStateTimeout.NoTimeout
    )
    root = shared_stage_path(spark, "audit-deltas")
    with settings(spark, STATE_STORE):
        query = (
            deltas.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{root}/log")
            .trigger(availableNow=True)
            .start(f"{root}/rows")
        )
        query.awaitTermination()
    found = spark.read.schema(DELTA).parquet(f"{root}/rows")
    total = found.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return total.where("n <> 0")


def interactions(part: str, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> list[tuple]:
    """The 600 rows of a part from its documents per mask (all, of quality 1,
    toxic)."""
    masks = np.arange(1 << len(FILTERS))
    steps, total = [], dict.fromkeys(FILTERS, 0)
    for order in ORDERS:
        gone = np.zeros(len(masks), dtype=bool)
        for k, f in enumerate(order, 1):
            fails = (masks & BIT[f]) > 0
            here, redundant = fails & ~gone, fails & gone
            gone = gone | fails
            total[f] += int(n[here].sum())
            counts = (n[~gone], n[here], n[redundant], n[masks == BIT[f]], good[here], toxic[here])
            steps.append((part, order, k, *(int(c.sum()) for c in counts)))
    return [(*s, total[s[1][s[2] - 1]]) for s in steps]


def _orders(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    size = 1 << len(FILTERS)
    n, good, toxic = (np.bincount(frame["mask"], weights=frame[c], minlength=size).astype(np.int64) for c in ("n", "good", "toxic"))
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pd.DataFrame(interactions(key[0], n, good, toxic), columns=names)


def audit(counted: DataFrame) -> DataFrame:
    """All orders and steps of every part, from its counters: a group holds
    at most 32 rows."""
    by_mask = counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )
    return by_mask.groupBy("part").applyInPandas(_orders, RESULT)


def audit_documents(spark: SparkSession, path: str, labels: DataFrame, **options) -> DataFrame:
    return audit(counters(spark, path, labels, **options))


ORACLE_SQL = """
WITH lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents
), m AS (
  SELECT t.part, coalesce(lab.good, 0) AS good, coalesce(lab.toxic, 0) AS toxic,
         CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * len(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN t.doc_id > least THEN 16 ELSE 0 END AS mask
  FROM t LEFT JOIN lab ON t.doc_id = lab.doc_id
), c AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
  JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
), s AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, coalesce(list_sum(bits[1:i - 1]), 0)::INTEGER AS earlier
  FROM o CROSS JOIN range(1, 6) r(i)
), r AS (
  SELECT c.part, s.filter_order, s.step, s.bit,
         CAST(sum(CASE WHEN c.mask & (s.bit | s.earlier) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN c.mask & s.bit > 0 AND c.mask & s.earlier = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN c.mask & s.bit > 0 AND c.mask & s.earlier > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN c.mask = s.bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN c.mask & s.bit > 0 AND c.mask & s.earlier = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN c.mask & s.bit > 0 AND c.mask & s.earlier = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM c CROSS JOIN s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""
