import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tallyline.llm import registry, variants

from ..conftest import SF_SMALL
from .helpers import CLASHING, DOC, doc, frame, odd_docs, with_extras


def counted(rows):
    """The vocabulary by the rule, run by run."""
    found = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def edits(word, letters):
    for i in range(len(word) + 1):
        yield word[:i] + word[i + 1 :]
        for c in letters:
            yield word[:i] + c + word[i:]
            yield word[:i] + c + word[i + 1 :]


def brute(vocab, near_of):
    forms, rows = {}, []
    for w, n in vocab.items():
        near = near_of(w)
        best = min(near, key=lambda x: (-vocab[x], [ord(c) for c in x]), default=None)
        forms[w] = best if best is not None and vocab[best] >= 10 * n else None
        rows.append([w, forms[w], None, n, len(near), vocab[best] if forms[w] else None])
    for r in rows:
        root = r[0]
        while forms[root]:
            root = forms[root]
        r[2] = root
    return sorted(tuple(r) for r in rows)


def by_edits(vocab):
    letters = {c for w in vocab for c in w}
    return lambda w: {x for x in edits(w, letters) if x in vocab and x != w}


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_equals_brute_force_on_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    vocab = counted(rows)
    got = result(registry.QUERIES["op12_variants"](spark, SF_SMALL))
    assert got == brute(vocab, by_edits(vocab))
    assert sum(r[1] is not None for r in got) >= 5


def variant_docs():
    """Families of words with chains of forms, double letters, accents,
    capitals, one very long word and words that differ only in length."""
    rng = random.Random(3)
    rows = odd_docs(5, 20)
    base = ["eeeeeeee", "abababab", "großartig", "ÀÉcolelangue", "mississippi", "z" * 400]
    for k, word in enumerate(base):
        chain = word
        for step in range(4):
            times = 2 * 11 ** (3 - step)
            rows += [doc(1000 * k + 100 * step + j, " ".join([chain] * (times // 4 + 1))) for j in range(4)]
            i = rng.randrange(len(chain))
            chain = rng.choice([chain[:i] + chain[i + 1 :], chain[:i] + "q" + chain[i + 1 :], chain[:i] + "q" + chain[i:]])
    rows += [doc(7001, "Ärgernis ÄRGERNIS ärgernis×÷×a b"), doc(7002, "tie-aaaabbb1aaaabbb2aaaabbc"), doc(7003, None)]
    return rows


def test_families_of_words(spark):
    rows = variant_docs()
    vocab = counted(rows)
    got = result(variants.group_variants(variants.occurrences(frame(spark, with_extras(rows), CLASHING))))
    near = {w: {x for x in vocab if one_edit(w, x)} for w in vocab}
    assert got == brute(vocab, near.__getitem__)
    assert any(r[2] not in (r[0], r[1]) for r in got)


def test_every_pair_one_edit_apart_meets_once(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abéiqy") for _ in range(rng.randrange(7, 10))) for _ in range(1500)})
    vocab = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    pairs = [tuple(sorted(r)) for r in variants.near_pairs(vocab).select("a", "b").collect()]
    assert sorted(pairs) == sorted((a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b))


def test_ties_go_to_the_smallest_code_points(spark):
    rows = [("aaaaaaa", 2), ("aaaaaaz", 20), ("aaaaaaÿ", 20), ("aaaaaab", 19)]
    vocab = spark.createDataFrame(rows, "word string, n long")
    got = {r.word: (r.form, r.form_n, r.n_near) for r in variants.best_forms(vocab, variants.near_pairs(vocab)).collect()}
    assert got["aaaaaaa"] == ("aaaaaaz", 20, 3)
    assert got["aaaaaab"] == (None, None, 3)


def test_long_chains_reach_their_root(spark):
    rows = [(f"w{i}", f"w{i + 1}" if i < 13 else None) for i in range(14)]
    forms = spark.createDataFrame(rows, "word string, form string")
    assert {r.root for r in variants.with_roots(forms).collect()} == {"w13"}


def test_empty_tables(spark):
    assert result(variants.group_variants(variants.occurrences(frame(spark, [], DOC)))) == []
    short = frame(spark, [doc(1, "too short here"), doc(2, "")])
    assert result(variants.group_variants(variants.occurrences(short))) == []
    assert variants.occurrences(short).where(F.length("word") > 0).count() == 0
