import random
import tracemalloc
from unittest.mock import Mock

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyline.llm import repeats
from tallyline.llm.induced import suffix_buckets

from .helpers import CLASHING, doc, frame, odd_docs, with_extras


def brute(rows, width):
    seen = {}
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, t in texts:
        for s in range(len(t) - width + 1):
            seen[t[s:s + width]] = seen.get(t[s:s + width], 0) + 1
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - width + 1):
            if seen[t[s:s + width]] > 1:
                gone[s:s + width] = b"\1" * width
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def check(spark, rows, width, **options):
    got = repeats.remove_repeats(frame(spark, rows), width, **options)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got.collect()]
    assert sorted(got, key=str) == brute(rows, width)


def passages(seed, n, width):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice("abcdefgh é\n") for _ in range(k))
    shared = [text(rng.randrange(width // 2, 3 * width)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [text(rng.randrange(0, 2 * width))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s) // 2)
            parts += [s[a:a + rng.randrange(width // 2, 2 * width)], text(rng.randrange(0, width))]
        rows.append(doc(i, "".join(parts)))
    return rows


@pytest.mark.parametrize(("width", "gram", "cell"), [(40, 8, 9), (40, 16, 25), (60, 8, 14)])
def test_equals_brute_force(spark, width, gram, cell):
    check(spark, passages(width + gram, 80, width), width, gram=gram, cell=cell, shard_bytes=3000)


def test_a_key_of_many_cells_is_cut_before_the_shards(spark):
    rng = random.Random(11)
    text = lambda k: "".join(rng.choice("abcdefgh é") for _ in range(k))
    shared = text(50)
    rows = [doc(i, text(20) + shared + text(20)) for i in range(150)]
    check(spark, rows, 40, gram=8, cell=9, shard_bytes=3000)
    docs = frame(spark, rows).select(F.col("doc_id").alias("uid"), "text")
    for limit, held in ((10**9, False), (3000, True)):
        left = repeats.open_cells(docs, 40, 8, 9, limit)[1]
        largest = left.groupBy("key").agg(F.sum(F.length("data")).alias("n")).agg(F.max("n")).first()[0] or 0
        assert (largest <= 3000) == held


def test_few_letters_and_runs(spark):
    rng = random.Random(8)
    rows = [doc(i, "".join(rng.choice("ab") for _ in range(rng.randrange(200)))) for i in range(30)]
    rows += [doc(100, "a" * 500), doc(101, "ab" * 100), doc(102, "abc" * 40 + "x" + "abc" * 40), doc(103, "a" * 29), doc(104, "z" * 30), doc(105, "z" * 31)]
    check(spark, rows, 30, gram=8, cell=7, shard_bytes=2000)


def test_odd_rows_at_the_production_width(spark):
    check(spark, odd_docs(), repeats.WIDTH)


def test_a_very_long_text_is_cut_into_overlapping_parts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PART", 500)
    rows = passages(3, 30, 40)
    long = "".join(r[1] for r in rows[:12])
    check(spark, [*rows, doc(900, long)], 40, gram=8, cell=9)


def test_extra_columns_and_empty_table(spark):
    rows = odd_docs()[:20]
    got = repeats.remove_repeats(frame(spark, with_extras(rows), CLASHING)).collect()
    assert len(got) == 20
    assert repeats.remove_repeats(frame(spark, [])).collect() == []


def test_suffix_order_with_queues_on_disk():
    rng = random.Random(9)
    for _ in range(200):
        t = [rng.randint(1, rng.choice([1, 2, 4, 20])) for _ in range(rng.randint(1, 60))] + [0]
        text = np.array(t, np.uint16)
        poly = repeats.PolyHash(text)
        got = np.concatenate(list(suffix_buckets(text, poly.of, 1000, memory=rng.choice([1, 5, 1000])))).tolist()
        assert got[::-1] == sorted(range(len(t) - 1), key=lambda i: t[i:])


def test_a_worker_holds_a_slice_of_a_batch_at_a_time(monkeypatch):
    monkeypatch.setattr(repeats.PolyHash, "POWERS", {})
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefgh ", k=2000)) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"uid": list(range(len(texts))), "text": texts})
    docs = Mock()
    repeats.region_table(docs, repeats.WIDTH, repeats.GRAM)
    run = docs.select.return_value.mapInArrow.call_args.args[0]
    cells = [t[:500].encode() for t in texts] * 4
    cells = cells[:repeats.SHARD_BYTES // 500]
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in run(iter([batch]))) >= len(texts)
        assert tracemalloc.get_traced_memory()[1] < 100e6  # 4 MB of text
        tracemalloc.reset_peak()
        repeats.repeated_windows(cells, repeats.WIDTH)
        assert tracemalloc.get_traced_memory()[1] < 200e6  # a whole shard
    finally:
        tracemalloc.stop()
