import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyline.llm import components, jaccard

from .helpers import CLASHING, DOC, doc, frame, odd_docs, with_extras

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, k, percent):
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(UPPER))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]) or (sets[a] and sets[b] and rows[a][0] == rows[b][0]):
            parent[find(a)] = find(b)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0], len(sets[i]), least[find(i)] if sets[i] else r[0]) for i, r in enumerate(rows))


def check(spark, rows, k=4, percent=85):
    rows = [r for r in rows if r[0] is not None]
    got = jaccard.similar_components(frame(spark, rows), shingle=k, percent=percent)
    assert sorted((r["id"], r["n"], r["component"]) for r in got.collect()) == brute(rows, k, percent)


def near_copies(seed, n, length, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        rows.append(doc(rng.randrange(10**9), " ".join(w)))
    return rows


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_equals_brute_force_on_odd_rows(spark, k, percent):
    check(spark, odd_docs(), k, percent)


def test_hot_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    check(spark, near_copies(1, 150, 120, 9) + odd_docs()[:40])


def test_small_sets_with_frequent_tokens(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    rows = [r for s in range(8) for r in near_copies(s % 4, 14, 10 + 6 * s, 4)]
    check(spark, rows)
    check(spark, rows, 5, 80)


def test_shared_passage_does_not_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    monkeypatch.setattr(jaccard, "FREQUENT", 5)
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [doc(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 90))) + " " + passage) for i in range(60)]
    check(spark, rows + [doc(100, passage), doc(101, passage + " more")])


def test_bounds_are_never_below_the_truth(spark):
    rng = random.Random(11)
    rows = [r for r in near_copies(12, 30, 60, 14) + near_copies(13, 20, 9, 4) + odd_docs()[:15] if r[0] is not None]
    docs = frame(spark, rows).selectExpr("doc_id AS id", "text")
    none = jaccard.np.empty(0, jaccard.np.uint64)
    for percent in (60, 85):
        prefixes = jaccard._sets_by_row(docs, 4, percent, none).where("n > 0").dropDuplicates(["class"]).cache()
        sets = {r["class"]: set(r.tokens) for r in jaccard._sets_by_row(docs, 4, percent, none, whole=True).collect()}
        ids = [r["class"] for r in prefixes.select("class").collect()]
        pairs = [(a, b) for a in ids for b in rng.sample(ids, 12) if a != b]
        got = jaccard._bounded(spark.createDataFrame(pairs, "a long, b long"), prefixes, percent).collect()
        assert len(got) == len(pairs)
        for r in got:
            common, union = len(sets[r.a] & sets[r.b]), len(sets[r.a] | sets[r.b])
            assert common <= r.common
            assert r.near or 100 * common < percent * union


def test_chain_of_links_and_threshold(spark):
    words = [f"w{i}" for i in range(400)]
    chain = [doc(i, " ".join(words[4 * i:4 * i + 103])) for i in range(40)]  # 92 of 108 shared: 85.2 %
    apart = [doc(100 + i, " ".join(words[200 + 9 * i:200 + 9 * i + 103])) for i in range(5)]
    check(spark, chain + apart)


def test_one_per_group_keeps_the_smallest_id(spark):
    rows = odd_docs()
    docs = frame(spark, with_extras(rows), CLASHING)
    out = jaccard.one_per_group(docs)
    assert out.columns == docs.columns
    known = [r for r in rows if r[0] is not None]
    want = {i for i, n, c in brute(known, 5, 80) if i == c}
    ids = [r["doc_id"] for r in out.collect()]
    assert set(ids) == want | {None} and len(ids) == len(want) + 1


def test_empty_table(spark):
    assert jaccard.similar_components(frame(spark, [])).collect() == []
    assert jaccard.one_per_group(frame(spark, [])).collect() == []


def test_components_of_random_links(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, i) for i in range(2000, 2100)]
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {(r["node"], r["component"]) for r in got} == {(x, find(x)) for x in linked}
    assert len(got) == len(linked)


def test_frequent_tokens_are_counted_over_all_documents_and_whole_sets(spark):
    """A word run in as many documents as FREQUENT, and no document more."""
    def rows(n):
        return [doc(i, "one two three four five six seven " + " ".join(f"x{i}y{k}" for k in range(30))) for i in range(n)]

    def count(n):
        texts = frame(spark, rows(n)).selectExpr("doc_id AS id", "text")
        return len(jaccard.frequent_tokens(texts, 4))

    assert count(jaccard.FREQUENT) == 4 and count(jaccard.FREQUENT - 1) == 0


def test_unlinked_copies_with_edits_of_their_own_meet_no_pairs(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(120):  # 10 words of their own change some 40 of 147 shingles
        words = list(base)
        for k in rng.sample(range(150), 10):
            words[k] = f"own{i}k{k}"
        rows.append(doc(i, " ".join(words)))
    pairs, plain = [], jaccard.stage

    def stage(df, name):
        out = plain(df, name)
        if name == "jaccard-rest":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stage", stage)
    check(spark, rows)
    assert pairs[0] < 5 * len(rows)


def test_counted_tokens_move_in_three_bytes_and_once_a_task(spark, monkeypatch):
    some = np.array([0, 1, 255, 256, 65536, (1 << 22) - 1], np.uint32)
    packed = jaccard._three_bytes(some)
    assert len(packed) == 3 * len(some) and (jaccard._from_three_bytes(packed) == some).all()
    rows = [doc(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(i % 30))) for i in range(200)]
    texts = frame(spark, rows).select("text")
    flat = [np.unique(jaccard.shingle_sets(pa.array([r["text"]]), 4)[0]) >> np.uint64(30) for r in texts.collect()]
    token, n = np.unique(np.concatenate(flat), return_counts=True)
    monkeypatch.setattr(jaccard, "FREQUENT", 56)
    monkeypatch.setattr(jaccard, "SET_BYTES", 200)
    assert 0 < (n >= 56).sum() < len(n)
    for held in (1, 100, 1 << 20):
        monkeypatch.setattr(jaccard, "HELD_TOKENS", held)
        assert (jaccard.frequent_tokens(texts, 4) == token[n >= 56]).all()
