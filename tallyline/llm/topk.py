"""Exact top-k search by distributed histogram selection.

Every query is scored against every row, several times: each pass adds up a
global histogram of the scores within the interval that still holds a
query's kth score, and narrows the interval to one histogram cell, until a
cell is one score wide or holds few rows. The last pass keeps the rows at or
above the interval's lower end; ties go to the smaller id. No pass keeps the
scores, so memory is one block of scores whatever the table's size.

Queries go in blocks of at most ``query_block`` vectors. Only a block is
broadcast, and its size is bounded by that parameter; the rows stay where
they are read.

Scores are integer inner products of ``floor(scale * x)``, computed in
doubles when their size proves them exact, else in 64-bit integers.

Defined results: vectors that are null, or hold null or non-finite
components, take no part, nor do rows with a null id; shorter vectors count
as padded with zeros; a query's own row is any row of its id; of rows that
repeat a query's id the smallest vector is the query; a repeated candidate
row is a candidate each time; an empty table gives no rows. Scores must fit
64-bit integers: beyond that they wrap around.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stage

K = 10
SCALE = 1024
CELLS = 1024
QUERY_BLOCK = 4096
ROW_BLOCK = 2048
#: an interval with at most so many rows per wanted row needs no further pass
SLACK = 8
EXACT = float(1 << 53)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """id, v (array<bigint>) of the rows that take part."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return df.where(x.isNotNull() & F.col(id_col).isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))).alias("v"),
    )


def _matrix(col: pa.Array, dim: int | None = None) -> np.ndarray:
    off = col.offsets.to_numpy().astype(np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    n = np.diff(off)
    wide = int(n.max()) if len(n) else 0
    if len(n) and (n == wide).all():
        m = flat.reshape(len(n), wide)
    else:
        m = np.zeros((len(n), wide), np.int64)
        m[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(off[:-1] - off[0], n)] = flat
    if dim is not None and m.shape[1] != dim:
        m = np.pad(m, ((0, 0), (0, max(0, dim - m.shape[1]))))[:, :dim]
    return m


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer scores, one row per query."""
    if q.size == 0 or c.size == 0:
        return np.zeros((len(q), len(c)), np.int64)
    most = float(np.abs(q.astype(np.float64)).max()) * float(np.abs(c.astype(np.float64)).max()) * q.shape[1]
    if most < EXACT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _blocks(batches, dim: int):
    for b in batches:
        for s in range(0, b.num_rows, ROW_BLOCK):
            part = b.slice(s, ROW_BLOCK)
            yield part.column("id").to_numpy(), _matrix(part.column("v"), dim)


def _search_block(rows: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    sc = rows.sparkSession.sparkContext
    dim = q.shape[1]
    held = sc.broadcast((ids, q))

    def bounds(batches):
        qi, qm = held.value
        lo = np.full(len(qi), np.iinfo(np.int64).max)
        hi, n = np.full(len(qi), np.iinfo(np.int64).min), np.zeros(len(qi), np.int64)
        for ci, cm in _blocks(batches, dim):
            s = _scores(qm, cm)
            own = qi[:, None] == ci[None, :]
            lo = np.minimum(lo, np.where(own, np.iinfo(np.int64).max, s).min(axis=1))
            hi = np.maximum(hi, np.where(own, np.iinfo(np.int64).min, s).max(axis=1))
            n += len(ci) - own.sum(axis=1)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(lo[at]), pa.array(hi[at]), pa.array(n[at])], names=["q", "lo", "hi", "n"])

    seen = rows.mapInArrow(bounds, "q long, lo long, hi long, n long").groupBy("q").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"))
    lo, hi = np.zeros(len(ids), object), np.full(len(ids), -1, object)
    want, inside = np.full(len(ids), k), np.zeros(len(ids), np.int64)
    for r in seen.collect():  # at most query_block rows
        lo[r.q], hi[r.q], inside[r.q] = r.lo, r.hi, r.n

    # [lo, hi] holds the kth score of each query; `want` of its rows are wanted
    while (open_ := np.flatnonzero((inside > SLACK * np.maximum(want, 1)) & (hi > lo) & (inside > want))).size:
        width = np.array([-(-(int(hi[i]) - int(lo[i]) + 1) // CELLS) for i in open_], object)
        state = sc.broadcast((open_, lo[open_].astype(np.int64), hi[open_].astype(np.int64), width.astype(np.uint64)))

        def histogram(batches, state=state):
            (qi, qm), (at, low, high, wide) = held.value, state.value
            total = np.zeros((len(at), CELLS), np.int64)
            row = np.arange(len(at))[:, None] * CELLS
            for ci, cm in _blocks(batches, dim):
                s = _scores(qm[at], cm)
                ok = (qi[at][:, None] != ci[None, :]) & (s >= low[:, None]) & (s <= high[:, None])
                cell = ((s.astype(np.uint64) - low[:, None].astype(np.uint64)) // wide[:, None]).astype(np.int64)
                total += np.bincount((row + cell)[ok], minlength=total.size).reshape(total.shape)
            r, c = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(c), pa.array(total[r, c])], names=["r", "cell", "n"])

        cells = rows.mapInArrow(histogram, "r long, cell long, n long").groupBy("r", "cell").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy("r").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0))
        need = cells.withColumn("above", above)
        wanted = rows.sparkSession.createDataFrame([(i, int(want[q])) for i, q in enumerate(open_)], "r long, want long")
        hit = need.join(F.broadcast(wanted), "r").where("above >= want").groupBy("r").agg(F.max(F.struct("cell", "above", "n")).alias("e"))
        for r in hit.select("r", "e.*").collect():  # at most query_block rows
            i = open_[r.r]
            step = int(width[r.r])
            low = int(lo[i]) + r.cell * step
            lo[i], hi[i] = low, min(int(hi[i]), low + step - 1)
            want[i], inside[i] = want[i] - (r.above - r.n), r.n
        state.unpersist()

    floor_ = sc.broadcast(lo.astype(np.int64))

    def keep(batches):
        qi, qm = held.value
        out: list[tuple] = []
        best: list[list] = [[] for _ in qi]
        for ci, cm in _blocks(batches, dim):
            s = _scores(qm, cm)
            ok = (qi[:, None] != ci[None, :]) & (s >= floor_.value[:, None])
            for i in np.flatnonzero(ok.any(axis=1)):
                at = np.flatnonzero(ok[i])
                # of ties in this partition only the k smallest ids can be among the k
                at = at[np.lexsort((ci[at], -s[i][at]))[:k]]
                best[i] = sorted(best[i] + [(-int(s[i][j]), int(ci[j])) for j in at])[:k]
        for i, own in enumerate(best):
            out += [(int(qi[i]), c, -s) for s, c in own]
        cols = list(zip(*out, strict=True)) if out else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    found = rows.mapInArrow(keep, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best of ``vectors``
    (all, if fewer). Both have columns id, v (see ``integer_vectors``)."""
    rows = stage(vectors, "topk-rows")
    asked = stage(queries.groupBy("id").agg(F.min("v").alias("v")), "topk-queries")
    n, dim = asked.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    dim = max(dim or 0, rows.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    spark = rows.sparkSession
    out = None
    blocks = -(-n // query_block) if n else 0
    dealt = asked.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(2 * blocks or 1)))
    for b in range(2 * blocks):
        # a hash bucket of about half a block; a fuller one is cut by row
        own = dealt.where(F.col("_b") == b).select("id", "v").orderBy("id").toArrow()
        for s in range(0, own.num_rows, query_block):
            part = own.slice(s, query_block).combine_chunks()
            ids = part.column("id").to_numpy()
            m = _matrix(part.column("v").combine_chunks() if isinstance(part.column("v"), pa.ChunkedArray) else part.column("v"), dim)
            got = stage(_search_block(rows, ids, m, k), "topk-found")
            out = got if out is None else out.unionByName(got)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out
