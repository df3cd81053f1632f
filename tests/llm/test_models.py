"""Language identification and the quality classifier."""

import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import langid, quality

from .helpers import CLASHING, doc, frame, odd_docs, with_extras


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "bab"]
    lattice = langid.Lattice(pieces)
    rng = np.random.default_rng(1)
    prob = rng.random((len(pieces) + 1, 3))
    words = ["a", "b", "ab", "babab", "xaby", "", "abab" * 3, "ab" * 20, "x" * 40]
    got = lattice.log_prob(words, prob)
    for w, row in zip(words, got, strict=True):
        text = langid.WORD_START + w
        total = [np.ones(3)]
        for end in range(1, len(text) + 1):
            total.append(sum((total[s] * prob[pieces.index(text[s:end])] for s in range(end) if text[s:end] in pieces), np.zeros(3)))
            if text[end - 1] not in pieces:
                total[end] = total[end] + total[end - 1] * prob[-1]
        np.testing.assert_allclose(row, np.log(total[-1]), rtol=1e-9)


def test_expected_counts_are_those_of_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba"]
    lattice = langid.Lattice(pieces)
    prob = np.random.default_rng(2).random((len(pieces) + 1, 1))
    words, weight = ["abab", "ba", "b"], np.array([2.0, 1.0, 3.0])
    want = np.zeros(len(pieces) + 1)
    for w, n in zip(words, weight, strict=True):
        text, found = langid.WORD_START + w, []
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
            seg = [text[a:b] for a, b in itertools.pairwise(at)]
            if all(s in pieces for s in seg):
                found.append((math.prod(prob[pieces.index(s), 0] for s in seg), seg))
        z = sum(p for p, _ in found)
        for p, seg in found:
            for s in seg:
                want[pieces.index(s)] += n * p / z
    np.testing.assert_allclose(lattice.expected(words, weight, prob), want, rtol=1e-9)


def test_long_words_count_like_short_ones(monkeypatch):
    lattice = langid.Lattice(["▁", "a", "b", "ab", "▁a", "ba", "bab"])
    rng = np.random.default_rng(3)
    prob = rng.random((8, 1)) / 4
    words = ["".join(rng.choice(list("abx"), n)) for n in (1, 4, 9, 12, 20, 24)]
    want = lattice.expected(words, np.arange(1.0, 7.0), prob)
    monkeypatch.setattr(langid, "SHORT", 3)
    monkeypatch.setattr(langid, "LONG_CHARS", 25)
    np.testing.assert_allclose(lattice.expected(words, np.arange(1.0, 7.0), prob), want, rtol=1e-9)
    monkeypatch.undo()
    long = lattice.expected(["x" * 5000], np.array([2.0]), prob * 1e-6)
    np.testing.assert_allclose(long[[-1, 0]], [10_000, 2], rtol=1e-6)


def test_languages_without_spaces(spark):
    rng = random.Random(5)
    syllables = {"xx": ["the", "ing", "and", "ous"], "yy": ["der", "ung", "sch", "ein"]}
    text = lambda lang: " ".join("".join(rng.choice(syllables[lang]) for _ in range(40)) for _ in range(3))
    rows = [(i, text(lang), lang, None, None) for i, lang in enumerate(rng.choice(["xx", "yy"]) for _ in range(80))]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify_documents(frame(spark, rows), F.col("doc_id") % 4 != 2, ["doc_id"]).collect()}
    assert all(got[i] == lang for i, _, lang, _, _ in rows if i % 4 == 2)


def labelled(n):
    rng = random.Random(3)
    syllables = {"en": ["the", "ing", "and", "ous", "th"], "de": ["der", "ung", "sch", "ein", "ü"], "fr": ["les", "eau", "é", "tion", "que"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(syllables))
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60)))
        rows.append((i, text, lang, None, None))
    return rows


def test_languages_of_held_out_texts(spark):
    rows = labelled(300) + [doc(1000, None, "en"), doc(1001, "", None), doc(1002, "123 !? 456", "de"), doc(1003, "schein" * 5000, "zz"), doc(1004, "the", None)]
    docs = frame(spark, with_extras(rows), CLASHING)
    learn = F.col("doc_id") % 4 != 2
    got = {r["doc_id"]: r for r in langid.identify_documents(docs, learn & (F.col("doc_id") < 1000), ["doc_id"]).collect()}
    right = [got[i]["lang_pred"] == lang for i, _, lang, _, _ in rows[:300] if i % 4 == 2]
    assert sum(right) >= 0.98 * len(right)
    for i in (1000, 1001, 1002):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[1003]["lang_pred"] == "de" and all(0 <= r["score"] <= 1 for r in got.values())
    out = langid.identify_documents(docs, learn, docs.columns, out=("__lang", "__score"))
    assert out.columns == [*docs.columns, "__lang", "__score"] and out.count() == len(rows)
    assert out.where("doc_id = 1000 AND text IS NOT NULL").count() == 0


def test_language_edges(spark):
    assert langid.identify_documents(frame(spark, []), F.lit(True), ["doc_id"]).collect() == []
    got = langid.identify_documents(frame(spark, odd_docs()), F.lit(False), ["doc_id"]).collect()
    assert len(got) == len(odd_docs()) and {r["lang_pred"] for r in got} == {"und"}


def junk(n):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(20, 120))]
        good = rng.random() < 0.7
        if not good:
            w = [x + rng.choice(["%%%", "$$$"]) for x in w] if i % 2 else [x.upper() + "!!" for x in w]
        rows.append(doc(i, " ".join(w)))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_of_held_out_texts(spark):
    rows, labels = junk(400)
    rows += odd_docs()[:0] + [doc(1000, None), doc(1001, ""), doc(1002, "x" * 200_000), doc(1001, "")]
    docs = frame(spark, with_extras(rows), CLASHING)
    table = spark.createDataFrame([(i, y) for i, y in labels if i % 3 != 1] + [(0, None), (2, 7), (None, 1)], "doc_id long, label int")
    got = quality.classify_documents(docs, table).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    right = [(score[i] >= 0.5) == (y == 1) for i, y in labels if i % 3 == 1]
    assert sum(right) >= 0.97 * len(right)


def test_quality_edges(spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    docs = frame(spark, odd_docs())
    assert {r["score"] for r in quality.classify_documents(docs, none).collect()} == {0.5}
    assert {r["score"] for r in quality.classify_documents(docs, one).collect()} == {1.0}
    assert quality.classify_documents(frame(spark, []), none).collect() == []


def test_ranker_prefers_the_good_of_each_pair():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 4))
    y = (x[:, 0] - 0.5 * x[:, 2] + 0.1 * rng.normal(size=500) > 0.6).astype(int)
    r = quality.fit(x, y, pairs=20_000)
    s = r.score(x)
    assert (s[y == 1][:, None] > s[y == 0][None, :]).mean() > 0.99
    assert abs((s < 0.5).mean() - (y == 0).mean()) < 0.01  # the quantile


def test_no_language_is_lost_by_thinning(spark):
    rows = [doc(i, f"{chr(97 + i) * 4} {chr(98 + i) * 3} " * 300, f"l{i:02d}") for i in range(20)] + [doc(3, "dddd eee", "l03")] * 5
    got = langid.sample_by_language(frame(spark, rows), 1000).collect()
    assert {r["lang"] for r in got} == {f"l{i:02d}" for i in range(20)}
    assert {len(r["text"]) for r in got} <= {1000, len("aaaa bbb " * 300), len("dddd eee")}


def test_labelled_rows_of_one_id_stay_within_the_bound(spark, monkeypatch):
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(x)) or fit(x, y))
    docs = frame(spark, [doc(1, "a b c " * (1 + i)) for i in range(400)] + [doc(1, "equal")] * 400)
    table = spark.createDataFrame([(1, i % 2) for i in range(300)], "doc_id long, label int")
    assert quality.classify_documents(docs, table, train_rows=100).count() == 800
    assert quality.classify_documents(docs, table).count() == 800
    assert 60 <= seen[0] <= 150 and seen[1] == 802
