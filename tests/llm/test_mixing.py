import pytest
from pyspark.sql import functions as F

from tallyline.llm import mixing

from .helpers import CLASHING, DOC, doc, frame, odd_docs, with_extras


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: 3.0 * sizes[s] for s in over})


def check(rows, got):
    import re

    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    taken, largest = {}, {}
    for g in got:
        assert g["source_size"] == sizes[g["source"]]
        assert g["target"] == pytest.approx(want[g["source"]])
        assert 0 <= g["taken"] <= 3 * g["size"] and g["taken"] == g["copies"] * g["size"]
        taken[g["source"]] = taken.get(g["source"], 0) + g["taken"]
        largest[g["source"]] = max(largest.get(g["source"], 0), g["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s]


def test_targets_and_words_taken(spark):
    rows = odd_docs()
    docs = frame(spark, rows)
    got = mixing.mix_documents(docs, rows_per_range=5).collect()
    check(rows, got)
    again = mixing.mix_documents(docs.repartition(7), rows_per_range=5).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["text_hash"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_small_source_stops_at_three_times_its_size(spark):
    rows = [doc(i, "w " * 50, source="a") for i in range(20)] + [doc(99, "one two", source="b")]
    got = mixing.mix_documents(frame(spark, rows)).collect()
    check(rows, got)
    (b,) = [g for g in got if g["source"] == "b"]
    assert b["target"] == 6.0 and b["taken"] == 6


def test_better_documents_are_taken_more_often(spark):
    rows = [doc(i, "plain words here " * 3 if i % 2 else "#$%& *** [[ ]] ~~ ^^ ||", source="ab"[i % 4 // 2]) for i in range(2000)]
    got = mixing.mix_documents(frame(spark, rows)).where("source = 'a'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg("copies").alias("c")).collect()
    rate = {r["odd"]: r["c"] for r in got}
    assert rate[1] > rate[0]


def test_edges(spark):
    assert mixing.mix_documents(frame(spark, [])).collect() == []
    assert mixing.mixed_rows(frame(spark, [])).count() == 0
    empty = mixing.mix_documents(frame(spark, [doc(1, None), doc(2, ""), doc(3, " \n")])).collect()
    assert [(g["size"], g["taken"], g["target"]) for g in empty] == [(0, 0, 0.0)] * 3


def test_rows_are_repeated_with_their_own_columns(spark):
    rows = with_extras(odd_docs())
    docs = frame(spark, rows, CLASHING)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    want = {}
    for g in mixing.mix_documents(docs.select(*[c.split()[0] for c in DOC.split(", ")])).collect():
        want[g["doc_id"]] = want.get(g["doc_id"], 0) + g["copies"]
    got = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_equal_rows_at_the_end_of_the_budget(spark):
    """A budget may end inside a large group of equal rows: as many as fit."""
    rows = [doc(1, "w " * 10, source="a")] * 1500 + [doc(i, "x " * 10, source="b") for i in range(500)]
    rows += [doc(7, "w " * 7, source=None)] * 2100
    got = mixing.mix_documents(frame(spark, rows), rows_per_range=50).collect()
    assert len(got) == len(rows)
    taken, target = {}, {}
    for g in got:
        taken[g["source"]] = taken.get(g["source"], 0) + g["taken"]
        target[g["source"]] = g["target"]
    assert all(abs(taken[s] - target[s]) <= 10 for s in target)
    assert len({g["copies"] for g in got if g["source"] == "a"}) == 2


def test_mixed_equal_rows_that_differ_in_other_columns(spark):
    rows = [doc(1, "w " * 10, lang="en" if i % 3 else None, source="a") for i in range(1500)]
    rows += [doc(i, "x " * 10, source="b") for i in range(500)]
    docs = frame(spark, rows)
    want = {r["source"]: r["n"] for r in mixing.mix_documents(docs).groupBy("source").agg(F.sum("copies").alias("n")).collect()}
    out = mixing.mixed_rows(docs)
    assert {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()} == want
    most = out.groupBy("lang", "source").count().where("source = 'a'").collect()
    low = want["a"] // 1500
    assert all(low * n <= r["count"] <= (low + 1) * n for r in most for n in [sum(x[3] == "a" and x[2] == r["lang"] for x in rows)])


def test_key_ranges_stay_small_for_poor_documents(spark):
    rows = [doc(i, "#$%& *** [[ ]] ~~", source="a") for i in range(4000)] + [doc(-i, "a b c", source="b") for i in range(1, 10)]
    rows = frame(spark, rows)
    check([tuple(r) for r in rows.collect()], mixing.mix_documents(rows, rows_per_range=100).collect())
