"""Removal of repeated passages, by suffix sorting.

Every byte covered by a ``width``-byte string that also starts anywhere else
is found exactly; matches never cross documents. Sorting the suffixes of a
whole corpus would compare mostly text that occurs once, so three steps
narrow it down first, none of which loses a match:

1. Anchors. Of the ``gram``-byte strings in a window of ``width`` bytes, the
   one with the smallest hash is its anchor; equal windows have equal
   anchors at equal places. Consecutive windows with one anchor are a
   region. Regions whose anchor occurs nowhere else hold no repeat; regions
   that occur twice as a whole are repeats throughout.
2. Cells. Of the regions left, one per distinct text, windows are dealt by
   the anchor's place in them into ``cell`` wide ranges. All windows of a
   cell share a core of ``width - cell`` bytes at least, and are keyed by it.
   A passage in very many documents thus meets only where nearly a whole
   window agrees. Cells are settled as regions were.
   Where the open cells of one key hold more than ``shard_bytes``, they are
   dealt into cells half as wide and settled again, down to single windows,
   whose core is the whole window and settles them.
3. Suffix sorting. Cells still open, one per distinct text, are dealt into
   shards by key. A shard's suffixes are sorted by induction with queues on
   disk (``induced``); neighbours that agree in ``width`` bytes are repeats.

Hashes have 64 bits; texts are told apart by two of them.

Defined results: a null text is empty; texts shorter than ``width`` hold no
repeat; repeated rows are separate documents, so that all they hold from
``width`` bytes on is a repeat; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, release, stage, text_of
from .induced import suffix_buckets

WIDTH = 400
GRAM = 64
CELL = 112
#: a worker holds some 100 times a shard's bytes while it sorts it
SHARD_BYTES = 1_000_000
#: bytes of text that are looked at together, of one document or of several;
#: a worker holds some 100 times as much
PART = 1 << 18


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class PolyHash:
    """Hashes of all substrings of an array, from prefix sums."""

    POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, base: int = 0x9E3779B97F4A7C15):
        n = len(values)
        with np.errstate(over="ignore"):
            if base not in self.POWERS or len(self.POWERS[base][0]) < n:
                size = max(n + n // 4, 1 << 20)
                one = np.ones(1, np.uint64)
                self.POWERS[base] = tuple(
                    np.cumprod(np.concatenate([one, np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64))
                )
            self.up, down = self.POWERS[base]
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum((values.astype(np.uint64) + np.uint64(1)) * down[:n], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.sums[start + length] - self.sums[start]) * self.up[start]
            return _mix(h + np.asarray(length).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def all(self, length: int) -> np.ndarray:
        """Of every substring of one length."""
        n = len(self.sums) - 1 - length + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        with np.errstate(over="ignore"):
            return _mix((self.sums[length:] - self.sums[:-length]) * self.up[:n])


def _regions(data: np.ndarray, size: np.ndarray, width: int, gram: int):
    """Of documents laid end to end: document, first and last window start,
    anchor's place (all from the start of ``data``), anchor hash, two hashes
    of the region's text."""
    empty = np.empty(0, np.int64)
    if len(data) < width:
        return empty, empty, empty, empty, *[np.empty(0, np.uint64)] * 3
    poly, second = PolyHash(data), PolyHash(data, 0xC2B2AE3D27D4EB4F)
    h = poly.all(gram)
    # smallest hash (its upper bits) of each window, the leftmost of equals
    low = np.uint64((1 << 24) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    span, w = width - gram + 1, 1
    while 2 * w <= span:
        key = np.minimum(key[:-w], key[w:])
        w *= 2
    if span > w:
        key = np.minimum(key[: len(key) - (span - w)], key[span - w:])
    end = np.cumsum(size)
    doc = np.repeat(np.arange(len(size)), size)
    start = np.flatnonzero(np.arange(len(data)) + width <= end[doc])
    anchor = (key[start] & low).astype(np.int64)
    # an anchor lies inside one document, so a new document has a new anchor
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[start[1:]] != doc[start[:-1]])
    first = np.flatnonzero(new)
    a = start[first]
    b = start[np.append(first[1:], len(start)) - 1] if len(first) else empty
    p = anchor[first]
    return doc[a], a, b, p, h[p], poly.of(a, b + width - a), second.of(a, b + width - a)


def _parts(batch: pa.RecordBatch, width: int):
    """Rows of a batch as bytes, in slices; a very long text in several, that
    overlap so that every window is in one: (row numbers, offset in the text,
    bytes, sizes)."""
    for b in byte_slices(batch, "text", PART):
        texts = b.column("text").cast(pa.binary())
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        if b.num_rows == 1 and size[0] > PART + width:
            whole = np.frombuffer(texts[0].as_py(), np.uint8)
            for s in range(0, len(whole) - width + 1, PART):
                part = whole[s:s + PART + width - 1]
                yield b, s, part, np.array([len(part)])
        else:
            yield b, 0, np.frombuffer(b"".join(texts.to_pylist()), np.uint8), size


def region_table(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """uid, a, b (first and last window), p (anchor's place), m (anchor), r1,
    r2 (region's text) for rows (uid, text)."""

    def run(batches):
        for whole in batches:
            for b, shift, data, size in _parts(whole, width):
                doc, lo, hi, p, m, r1, r2 = _regions(data, size, width, gram)
                begin = (np.cumsum(size) - size)[doc] - shift
                ids = b.column("uid").take(pa.array(doc))
                longs = [pa.array(x) for x in (lo - begin, hi - begin, p - begin)]
                hashes = [pa.array(x.view(np.int64)) for x in (m, r1, r2)]
                yield pa.RecordBatch.from_arrays([ids, *longs, *hashes], names=["uid", "a", "b", "p", "m", "r1", "r2"])
        release()

    return docs.select("uid", "text").mapInArrow(run, "uid long, a long, b long, p long, m long, r1 long, r2 long")


def _settle(table: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows (key, r1, r2, uid, a, b) into those whose text occurs twice
    or more, and one row for each text of the keys that have several."""
    kinds = table.groupBy(*key, "r1", "r2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("uid", "a")).alias("one"))
    kinds = stage(kinds, "repeat-kinds")
    several = kinds.groupBy(*key).agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1")
    twice = table.join(kinds.where("n > 1").select(*key, "r1", "r2"), [*key, "r1", "r2"], "left_semi")
    open_ = kinds.join(several.select(*key), key, "left_semi").select(*key, "r1", "r2", "one.uid", "one.a")
    return twice, open_


def _cells(text: np.ndarray, a: int, b: int, p: int, width: int, gram: int, cell: int) -> list[tuple]:
    """Of windows a to b, whose bytes are ``text``: first and last window,
    anchor's place, key, two hashes and bytes of every cell."""
    poly, second = PolyHash(text), PolyHash(text, 0xC2B2AE3D27D4EB4F)
    out: list[tuple] = []
    for c in range((p - b) // cell, (p - a) // cell + 1):
        lo, hi = c * cell, min((c + 1) * cell, width - gram + 1) - 1
        s, e = max(a, p - hi), min(b, p - lo)
        core = poly.of(np.array([p - lo - a]), width + lo - hi)[0]
        key = _mix(np.array([core], np.uint64) + np.uint64(c))[0]
        at, n = np.array([s - a]), e + width - s
        out.append((s, e, p, key, poly.of(at, n)[0], second.of(at, n)[0], text[s - a:e - a + width].tobytes()))
    return out


def _cell_batch(uid: list, cells: list[tuple]) -> pa.RecordBatch:
    s, e, p, key, r1, r2, data = zip(*cells, strict=True)
    longs = [pa.array(x, pa.int64()) for x in (uid, s, e, p)]
    hashes = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (key, r1, r2)]
    return pa.RecordBatch.from_arrays([*longs, *hashes, pa.array(data, pa.binary())], names=["uid", "a", "b", "p", "key", "r1", "r2", "data"])


CELLS = "uid long, a long, b long, p long, key long, r1 long, r2 long, data binary"


def cell_table(docs: DataFrame, regions: DataFrame, width: int, gram: int, cell: int) -> DataFrame:
    """uid, a, b, p, key, r1, r2, data: the cells of ``regions`` (uid, a, b, p),
    with their text."""
    lists = regions.groupBy("uid").agg(F.array_sort(F.collect_set(F.struct("a", "b", "p"))).alias("regions"))
    wanted = docs.join(lists, "uid").dropDuplicates(["uid"]).select("uid", "text", "regions")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                raw = np.frombuffer(batch.column("text")[k].as_py().encode("utf-8", "surrogatepass"), np.uint8)
                out: list[tuple] = []
                for r in batch.column("regions")[k].as_py():
                    out += _cells(raw[r["a"]:r["b"] + width], r["a"], r["b"], r["p"], width, gram, cell)
                if out:
                    yield _cell_batch([batch.column("uid")[k].as_py()] * len(out), out)

    return wanted.mapInArrow(run, CELLS)


def narrower(cells: DataFrame, width: int, gram: int, cell: int) -> DataFrame:
    """The same for ``cells`` (uid, a, b, p, data), dealt into cells of another
    width."""

    def run(batches):
        for whole in batches:
            for batch in byte_slices(whole, "data"):
                uid, out = [], []
                for r in batch.to_pylist():
                    own = _cells(np.frombuffer(r["data"], np.uint8), r["a"], r["b"], r["p"], width, gram, cell)
                    uid += [r["uid"]] * len(own)
                    out += own
                yield _cell_batch(uid, out)

    return cells.select("uid", "a", "b", "p", "data").mapInArrow(run, CELLS)


def repeated_windows(cells: list[bytes], width: int) -> list[np.ndarray]:
    """For each cell, which of its windows start with a ``width``-byte string
    that another window of the cells starts with too."""
    size = np.array([len(c) for c in cells])
    # bytes from 2 on; 1 ends a cell, and a 0 the text
    text = np.ones(int(size.sum()) + len(cells) + 1, np.uint16)
    begin = np.cumsum(size + 1) - size - 1
    valid = np.zeros(len(text), bool)
    for s, c in zip(begin, cells, strict=True):
        text[s:s + len(c)] = np.frombuffer(c, np.uint8).astype(np.uint16) + 2
        valid[s:s + len(c) - width + 1] = True
    text[-1] = 0
    poly = PolyHash(text)
    hit = np.zeros(len(text), bool)
    last_at, last_hash = -1, None
    for bucket in suffix_buckets(text, poly.of, width):
        own = bucket[valid[bucket]]
        if not len(own):
            continue
        h = poly.of(own, width)
        same = h[1:] == h[:-1]
        hit[own[1:][same]] = hit[own[:-1][same]] = True
        if last_hash is not None and h[0] == last_hash:
            hit[last_at] = hit[own[0]] = True
        last_at, last_hash = own[-1], h[-1]
    return [np.flatnonzero(hit[s:s + n - width + 1]) for s, n in zip(begin, size, strict=True)]


def _runs(at: np.ndarray) -> list[tuple[int, int]]:
    """First and last of every run of consecutive numbers."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) != 1)
    return list(zip(at[np.concatenate([[0], cut + 1])].tolist(), at[np.append(cut, len(at) - 1)].tolist(), strict=True))


def open_cells(docs: DataFrame, width: int, gram: int, cell: int, key_bytes: int) -> tuple[DataFrame, DataFrame, int]:
    """Runs of repeated windows found without sorting (uid, a, b); cells left
    to sort (key, uid, a, data), of one key ``key_bytes`` at most, and their
    bytes."""
    regions = stage(region_table(docs, width, gram), "repeat-regions")
    twice, open_ = _settle(regions, ["m"])
    spans = twice.select("uid", "a", "b")
    wanted = regions.join(open_.select("m", "r1", "r2", "uid", "a"), ["m", "r1", "r2", "uid", "a"], "left_semi")
    cells, parts, total = cell_table(docs, wanted, width, gram, cell), [], 0
    while True:
        cells = stage(cells, "repeat-cells")
        twice, open_ = _settle(cells.drop("data"), ["key"])
        spans = spans.unionByName(twice.select("uid", "a", "b"))
        left = cells.join(open_, ["key", "r1", "r2", "uid", "a"], "left_semi").dropDuplicates(["key", "r1", "r2"])
        left = stage(left.select("key", "uid", "a", "b", "p", "data"), "repeat-open")
        sizes = stage(left.groupBy("key").agg(F.sum(F.length("data")).alias("bytes")), "repeat-sizes")
        hot = sizes.where(F.col("bytes") > key_bytes).select("key")
        got = sizes.agg(F.sum("bytes"), F.max("bytes")).first()
        if cell == 1 or (got[1] or 0) <= key_bytes:
            parts.append(left)
            total += int(got[0] or 0)
            break
        parts.append(left.join(hot, "key", "left_anti"))
        total += int(sizes.where(F.col("bytes") <= key_bytes).agg(F.sum("bytes")).first()[0] or 0)
        cell = -(-cell // 2)
        cells = narrower(left.join(hot, "key", "left_semi"), width, gram, cell)
    left = parts[0]
    for part in parts[1:]:
        left = left.unionByName(part)
    return spans, left.select("key", "uid", "a", "data"), total


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, cell: int = CELL, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """uid, a, b: runs of windows of ``docs`` (uid, text) that are repeats,
    by their first and last start; runs may touch or overlap."""
    spans, left, total = open_cells(docs, width, gram, cell, shard_bytes)
    shards = max(1, -(-total // shard_bytes))

    def search(table):
        cells = table.column("data").to_pylist()
        uid, a = table.column("uid").to_pylist(), table.column("a").to_pylist()
        out = [(uid[i], a[i] + s, a[i] + e) for i, hit in enumerate(repeated_windows(cells, width)) for s, e in _runs(hit)]
        cols = list(zip(*out, strict=True)) if out else [[], [], []]
        release()
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["uid", "a", "b"])

    found = left.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard").applyInArrow(search, "uid long, a long, b long")
    return spans.unionByName(found)


def remove_repeats(docs: DataFrame, width: int = WIDTH, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) of
    every row of ``docs`` (doc_id, text)."""
    plain = docs.select("doc_id", text_of().alias("text"))
    plain = plain.withColumn("uid", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(plain.select("uid", "text"), width, **options)
    spans = stage(spans.groupBy("uid").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans")), "repeat-spans")
    both = plain.join(spans, "uid", "left").select("doc_id", "text", "spans")

    def run(batches):
        for whole in batches:
            for b in byte_slices(whole, "text"):
                raw = [t.encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
                removed, runs, kept = [], [], []
                for data, own in zip(raw, b.column("spans").to_pylist(), strict=True):
                    at, parts, gone, n, reach = 0, [], 0, 0, -1
                    for s in own or ():
                        a, e = s["a"], s["b"] + width
                        if a > reach:  # a new run; runs that touch are one
                            n += 1
                            parts.append(data[at:a])
                            gone += e - a
                            at = reach = e
                        elif e > reach:
                            gone += e - reach
                            at = reach = e
                    parts.append(data[at:])
                    removed.append(gone)
                    runs.append(n)
                    kept.append(b"".join(parts))
                longs = [pa.array(x, pa.int64()) for x in ([len(d) for d in raw], removed, runs)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *longs, pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = both.select("doc_id").schema
    for c in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(c, "long")
    return both.mapInArrow(run, schema.add("kept", "binary"))

