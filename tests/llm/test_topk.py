import math
import random

from tallyline.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    import numpy as np

    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = set()
    for q, qv in queries.items():
        s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)[:k]
        out |= {(q, r + 1, i, -x) for r, (x, i) in enumerate(s)}
    return out


def run(spark, rows, k=10, **options):
    vectors = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4), "vec_id", "embedding")
    got = topk.top_k(vectors, vectors.where("id % 100 = 0"), k, **options)
    return [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()]


def test_against_brute_force_with_ties_nulls_and_a_hot_vector(spark):
    rng = random.Random(1)
    hot = [0.5, -0.25, 0.125, 1.0]
    rows = [(i, hot if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(4)], 0) for i in range(600)]
    rows += [(700, None, 1), (800, [1.0, None, 0.0, 0.0], 1), (900, [float("nan")] * 4, 1), (901, [float("inf"), 0.0, 0.0, 0.0], 1), (None, hot, 1)]
    rows += [(1000, [0.1, 0.2], None), (1001, [], 2), (1100, [], 2)]
    got = run(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows, 10)
    assert set(run(spark, rows, query_block=2)) == set(got)


def test_refines_histograms_over_a_wide_range(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELLS", 4)
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-100, 100) for _ in range(8)], 0) for i in range(1500)]
    assert set(run(spark, rows, 3)) == brute(rows, 3)


def test_fewer_rows_than_k_and_empty_tables(spark):
    rows = [(0, [1.0], 0), (5, [2.0], 0)]
    assert run(spark, rows) == [(0, 1, 5, 2048 * 1024)]
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 0)]) == []
    assert run(spark, [(100, [1.0], 0)]) == []
