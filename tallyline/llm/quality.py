"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text. The weights
maximise the likelihood that, of a good and a bad document, the good one is
preferred: logistic loss on the difference of their features. The score's
threshold is the quantile of the training scores at the share of bad
documents, and the result is ``1 / (1 + exp(threshold - score))``.

Features are computed once for every document, in Spark tasks; only a sample
of about ``train_rows`` labelled feature rows (a documented bound on fitting
only) reaches the driver.

Defined results: a null text is empty, and an empty text has features of
zeros; labels that are null or not 0 or 1 are left out; a document with
several labels is learnt once with each; with labels of one kind only, or
none, every score is that kind's, or 0.5; repeated rows get equal scores; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import byte_slices, encoded_words, stage, text_of, word_lists

TRAIN_ROWS = 20_000
PAIRS = 100_000
RIDGE = 1e-3

#: byte classes, in the order of their numbers
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\n\v\f\r",
    "stop": b".",
    "comma": b",;:",
    "shout": b"!?",
    "quote": b"'\"-()/",
    "pipe": b"|",
    "symbol": b"#$%&*<>{}[]\\^~=+@_`",
}
FEATURES = [*CLASSES, "beyond_ascii", "length", "words", "word_length", "distinct_words", "commonest_word", "lines", "distinct_lines", "line_length", "words_a_stop"]


def _byte_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.uint8)
    for i, chars in enumerate(CLASSES.values()):
        table[list(chars)] = i
    return table


def _distinct(codes: np.ndarray, off: np.ndarray, n_codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: the number of distinct codes, and the count of the commonest."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    key, count = np.unique(row * max(n_codes, 1) + codes, return_counts=True)
    row = key // max(n_codes, 1)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, row, count)
    return np.bincount(row, minlength=n), most


def features(text: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text (no nulls)."""
    n = len(text)
    size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer("".join(text.to_pylist()).encode("utf-8", "surrogatepass"), np.uint8)
    k = len(CLASSES) + 1
    row = np.repeat(np.arange(n, dtype=np.int64) * k, size)
    by_class = np.bincount(row + _byte_table()[data], minlength=n * k).reshape(n, k)
    per_byte = by_class / np.maximum(size, 1)[:, None]

    flat, off = word_lists(text)
    words, codes = encoded_words(flat)
    n_words = np.diff(off)
    kinds, most = _distinct(codes, off, len(words))
    lines = pc.split_pattern(text, "\n")
    line_off = lines.offsets.to_numpy().astype(np.int64)
    line_off -= line_off[0]
    line_texts, line_codes = encoded_words(lines.flatten())
    line_kinds, _ = _distinct(line_codes, line_off, len(line_texts))
    n_lines = np.diff(line_off)
    per_word = np.maximum(n_words, 1)
    rest = [
        np.log1p(size),
        np.log1p(n_words),
        np.log1p((size - by_class[:, 3]) / per_word),
        kinds / per_word,
        most / per_word,
        np.log1p(n_lines),
        line_kinds / np.maximum(n_lines, 1),
        np.log1p(size / np.maximum(n_lines, 1)),
        by_class[:, 4] / per_word,
    ]
    out = np.column_stack([np.sqrt(per_byte), *rest])
    out[size == 0] = 0.0
    return out


def add_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``features`` (array<double>) of every row's text."""
    plain = docs.select(*keep, text_of().alias("_text"))

    def run(batches):
        for whole in batches:
            for b in byte_slices(whole, "_text"):
                x = features(b.column("_text"))
                rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in range(b.num_columns - 1)], rows], names=[*keep, "features"])

    return plain.mapInArrow(run, plain.select(*keep).schema.add("features", ArrayType(DoubleType())))


class Ranker:
    """Weights, standardisation and threshold."""

    def __init__(self, mean, scale, weights, threshold, constant=None):
        self.mean, self.scale, self.weights, self.threshold, self.constant = mean, scale, weights, threshold, constant

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = (x - self.mean) / self.scale @ self.weights - self.threshold
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 5) -> Ranker:
    """Bradley-Terry weights from labelled feature rows, by Newton's method."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranker(None, None, None, None, 1.0 if len(good) else 0.0 if len(bad) else 0.5)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(z.shape[1])

    def loss(w):
        return np.logaddexp(0.0, -d @ w).mean() + RIDGE * w @ w

    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(np.clip(d @ w, -60, 60)))  # chance given to the wrong order
        grad = -(d * p[:, None]).mean(axis=0) + 2 * RIDGE * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + 2 * RIDGE * np.eye(len(w))
        step, t, now = np.linalg.solve(hess, grad), 1.0, loss(w)
        while loss(w - t * step) > now and t > 1e-6:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-6:
            break
    s = np.sort(z @ w)
    cut = len(bad) / len(y)
    return Ranker(mean, scale, w, float(np.quantile(s, cut)))


def train(featured: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Ranker:
    """``featured``: doc_id, features; ``labels``: doc_id, label (0 or 1).

    Equal rows of one id count once, and the joined rows are thinned to about
    ``train_rows``, however many rows an id has in either table."""
    known = labels.where("label IN (0, 1)").select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    rows = featured.select("doc_id", "features").join(known, "doc_id").select("doc_id", "features", "label").distinct()
    rows = stage(rows, "quality-labelled")
    n = rows.count()
    if n > train_rows:
        u = F.pmod(F.xxhash64(F.lit(31), "doc_id", "features", "label"), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.where(u < train_rows / n)
    rows = rows.toArrow()
    if not rows.num_rows:
        return Ranker(None, None, None, None, 0.5)
    rows = rows.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    x = rows.column("features").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    return fit(x, rows.column("label").to_numpy())


def score(featured: DataFrame, keep: list[str], ranker: Ranker) -> DataFrame:
    """``keep`` and ``score`` (0 to 1) of every row."""
    
    plain = featured.select(*keep, "features")

    def run(batches):
        for b in batches:
            x = b.column("features").flatten().to_numpy().reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in range(b.num_columns - 1)], pa.array(ranker.score(x))], names=[*keep, "score"])

    return plain.mapInArrow(run, plain.select(*keep).schema.add("score", "double"))


def classify_documents(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, score of every row of ``docs``; ``labels`` (doc_id, label)
    holds only the rows to learn from."""
    featured = stage(add_features(docs, ["doc_id"]), "quality-features")
    return score(featured, ["doc_id"], train(featured, labels, train_rows))
