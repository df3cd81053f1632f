"""Spelling variant grouping: words one edit apart, and each rare word's
frequent form.

Method: a word's letters are hashed to ``SYMBOLS`` symbols. Two words one
edit apart have reduced words that are equal or one edit apart, so the full
one-edit neighbourhood of every distinct reduced word is generated and joined
with the reduced vocabulary; the words behind each pair of reduced words that
meet are verified on their original letters. A pair of reduced words is
generated from one of its two sides: the longer one deletes (what the shorter
would reach by an insertion), and of two equally long ones the one with the
smaller symbol replaces. A reduced word travels as the 64 bits of a polynomial
of its symbols, whose neighbours follow by arithmetic; words whose polynomials
collide are only verified in vain.

A word's form is its near word of largest count (ties: smallest by code
points) if that count is at least ``RATIO`` times its own. Counts grow by that
factor from form to form, so following them ends; it is done by doubling.

Scale: words are counted with partial aggregates, so frequent words collapse
before the shuffle; what is joined is the vocabulary (words of at least
``MIN_LENGTH`` code points that occur twice), about L * (SYMBOLS + 1) / 2
rows of 16 bytes for a reduced word of L letters. Nothing is broadcast or
collected. All pairs that meet are verified: the words behind one reduced
word are compared with those behind its neighbours, which 8 symbols keep few
(7 letters have 2 M reduced words, 10 letters 1,000 M).

Odd cases: null texts have no words; a null id is the empty string where
words are perturbed; copies count as often as they occur; words without a
near word have n_near 0 and a null form; an empty table gives no rows. Words
of any length take part. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
SYMBOLS = 8
#: one occurrence in so many is perturbed
SLIP = 31

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: an odd number, so that it has an inverse among 64-bit numbers
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int = SLIP) -> DataFrame:
    """(word) of every run of letters, only A-Z lower-cased. Where ``slip``
    divides h = crc32 of ``<id>:<run>``, its code point h % length goes."""
    # a shorter run gives a shorter word, so only runs of enough letters are taken
    run = RUN.replace("+", f"{{{MIN_LENGTH},}}")
    text = F.translate(F.col(text_col).cast("string"), _UPPER, _UPPER.lower())
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(run), F.lit(0))).alias("run"),
    )
    h, n = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")), F.length("run")
    at = F.pmod(h, n).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, n))
    return runs.select(F.when(F.pmod(h, F.lit(slip)) == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n) of the words long and frequent enough."""
    return words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def symbols(words: pa.Array, k: int = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """The symbols (1 to k) of all letters, and the offsets of the words."""
    units = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype="<u4")
    lengths = np.fromiter((len(w) for w in words.to_pylist()), dtype=np.int64, count=len(words))
    return (units % k + 1).astype(np.uint64), np.concatenate([[0], np.cumsum(lengths)])


def _powers(n: int) -> np.ndarray:
    out = np.empty(n + 1, dtype=np.uint64)
    out[0] = 1
    if n:
        out[1:] = np.uint64(_BASE)
        out = np.multiply.accumulate(out)
    return out


def reduced_codes(batches):
    """(word, n) with the code of its reduced word."""
    for batch in batches:
        if batch.num_rows:
            letters, off = symbols(batch.column("word"))
            lengths = np.diff(off)
            place = np.arange(off[-1]) - np.repeat(off[:-1], lengths)
            terms = letters * _powers(int(lengths.max()))[place]
            code = np.add.reduceat(terms, off[:-1]).view(np.int64)
            reduced = (letters + np.uint64(96)).astype(np.uint8).tobytes().decode()
            text = [reduced[a:b] for a, b in zip(off[:-1], off[1:])]
            columns = [batch.column("word"), batch.column("n"), pa.array(code), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "code", "reduced"])


def neighbours(batches, k: int = SYMBOLS):
    """(code, near) of distinct reduced words: all that a deletion makes, and
    what a replacement by a larger symbol makes."""
    for batch in batches:
        words = np.array(batch.column("reduced").to_pylist(), dtype=object)
        codes = batch.column("code").to_numpy().view(np.uint64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for size in np.unique(sizes):
            own = sizes == size
            letters = np.frombuffer("".join(words[own]).encode(), dtype=np.uint8).reshape(-1, size).astype(np.uint64) - np.uint64(96)
            code, power = codes[own][:, None], _powers(int(size))[:size]
            terms = letters * power
            before = np.cumsum(terms, axis=1) - terms
            deleted = before + (code - before - terms) * np.uint64(_INVERSE)
            # of equal letters in a row only the first is deleted
            first = np.ones(letters.shape, dtype=bool)
            first[:, 1:] = letters[:, 1:] != letters[:, :-1]
            made, who = [deleted[first]], [np.nonzero(first)[0]]
            for s in range(2, k + 1):
                less = letters < np.uint64(s)
                replaced = code + (np.uint64(s) - letters) * power
                made.append(replaced[less])
                who.append(np.nonzero(less)[0])
            near, code = np.concatenate(made), codes[own][np.concatenate(who)]
            for a in range(0, len(near), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(code[part].view(np.int64)), pa.array(near[part].view(np.int64))], names=["code", "near"])


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b) of every two words of ``vocab`` (word, n) that differ
    by one inserted, deleted or replaced code point; each pair once."""
    coded = stage(vocab.mapInArrow(reduced_codes, "word string, n long, code long, reduced string"), "variants-coded")
    reduced = coded.groupBy("code", "reduced").agg(F.count("*").alias("held"))
    made = reduced.mapInArrow(neighbours, "code long, near long")
    present = coded.select(F.col("code").alias("near")).distinct()
    # words of one reduced word meet too, where it has several
    own = reduced.where("held > 1").select("code", F.col("code").alias("near"))
    met = made.join(present, "near", "left_semi").select("code", "near").unionByName(own).distinct()
    met = stage(met, "variants-met")
    a = coded.select("code", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = coded.select(F.col("code").alias("near"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    pairs = met.join(a, "code").join(b, "near")
    # within one reduced word each pair would come twice
    pairs = pairs.where((F.col("code") != F.col("near")) | (F.col("a") < F.col("b")))
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")


def best_forms(vocab: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n)."""
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    by_word = pairs.select(F.explode(sides).alias("s")).select("s.*").groupBy("word")
    best = by_word.agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    rows = vocab.join(best, "word", "left")
    form_n = -F.col("best.minus")
    frequent = form_n >= F.lit(ratio) * F.col("n")
    return rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, form_n).alias("form_n"),
    )


def with_roots(forms: DataFrame) -> DataFrame:
    """Add ``root``: the word that following the forms ends at. Each round
    doubles the steps taken."""
    links = forms.where("form is not null").select("word", F.col("form").alias("root"))
    links = stage(links, "variants-links")
    while True:
        next_ = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(next_, "root", "left")
        moved = stage(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variants-links")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return forms.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of the vocabulary of ``words``
    (one row an occurrence)."""
    vocab = stage(vocabulary(words), "variants-vocabulary")
    forms = stage(best_forms(vocab, near_pairs(vocab), ratio), "variants-forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
