"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public
vocabulary. A word's probability in a language is the sum over all its
segmentations into pieces of the product of their probabilities, found by
the forward algorithm; a text's is the product over its words. The pieces'
probabilities are learnt by expectation maximisation (forward-backward
expected counts) on labelled texts.

Training uses a sample of about ``train_chars`` characters per language,
drawn by a hash of the document (a documented bound on fitting only; every
text is predicted whole). Word counts and expected counts are added up in
Spark; only the model itself (pieces x languages) passes the driver. Words
are scored once per task and kept in a bounded cache.

Defined results: a null text, or one without a letter, is ``und`` with score
0; so is every text if no labelled text was given; ties go to the first
language in code point order; repeated rows get equal results; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, encoded_words, release, stage, word_lists

UND = "und"
VOCABULARY_FILE = "piece_bpe_32k.model"
TRAIN_CHARS = 3_000_000
ITERATIONS = 3
SMOOTHING = 0.01
WORD_START = "▁"
#: words up to this length go through the vectorised pass, in plain doubles;
#: longer ones are rescaled (prediction) or summed as logarithms (training)
SHORT = 24
#: characters of long words that training handles at once, or a single word
LONG_CHARS = 50_000
WORD_CACHE = 200_000
#: and at most so many characters, but for those of one slice of text
CACHE_CHARS = 8 << 20


def default_vocabulary() -> list[str]:
    """The text pieces of the public vocabulary."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY_FILE))
    plain = (i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i)))
    return [sp.id_to_piece(i) for i in plain]


class Lattice:
    """All segmentations of many words over a vocabulary.

    Substrings are looked up by a polynomial hash of their code points. The
    last piece number stands for any single character that is no piece."""

    BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

    def __init__(self, pieces: list[str]):
        self.n_pieces = len(pieces) + 1
        self.longest = max((len(p) for p in pieces), default=1)
        inv = pow(int(self.BASE), -1, 1 << 64)
        self.inv = np.uint64(inv)
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), "<u4").astype(np.uint64)
        n = np.fromiter((len(p) for p in pieces), np.int64, len(pieces))
        ends = np.cumsum(n)
        sums, pw = self._sums(codes)
        h = self._hash(sums, pw, ends - n, n)
        order = np.argsort(h)
        self.keys, self.ids = h[order], order
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def _sums(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of code * inv^i, and base^i."""
        n = len(codes)
        with np.errstate(over="ignore"):
            down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), self.inv)]), dtype=np.uint64)[:n]
            up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), self.BASE)]), dtype=np.uint64)[:n]
            return np.concatenate([[np.uint64(0)], np.cumsum((codes + np.uint64(1)) * down, dtype=np.uint64)]), up

    def _hash(self, sums, up, start, n) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (sums[start + n] - sums[start]) * up[start] + np.uint64(0xD6E8FEB86659FD93) * np.asarray(n).astype(np.uint64)
            h ^= h >> np.uint64(32)
            return h * np.uint64(0xD6E8FEB86659FD93)

    def edges(self, words: list[str]):
        """Per edge: first character (over all words), length, piece, word;
        per word its first character. Words get the word-start mark."""
        marked = [WORD_START + w for w in words]
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        n = np.fromiter((len(w) for w in marked), np.int64, len(words))
        first = np.concatenate([[0], np.cumsum(n)])
        word = np.repeat(np.arange(len(words)), n)
        room = first[word + 1] - np.arange(len(codes))
        sums, up = self._sums(codes)
        starts, lens, ids = [], [], []
        lone = np.ones(len(codes), bool)
        for m in range(1, self.longest + 1):
            at = np.flatnonzero(room >= m)
            if not len(at):
                break
            h = self._hash(sums, up, at, m)
            ok = self.seen[(h >> np.uint64(44)).astype(np.int64)]
            at, h = at[ok], h[ok]
            k = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = self.keys[k] == h
            at = at[hit]
            starts.append(at)
            lens.append(np.full(len(at), m))
            ids.append(self.ids[k[hit]])
            if m == 1:
                lone[at] = False
        at = np.flatnonzero(lone)
        starts.append(at)
        lens.append(np.ones(len(at), np.int64))
        ids.append(np.full(len(at), self.n_pieces - 1))
        start = np.concatenate(starts)
        return start, np.concatenate(lens), np.concatenate(ids), word[start], first

    def forward(self, edges, prob: np.ndarray) -> np.ndarray:
        """Summed path weight from the word's start to every node (node of
        character c of word w: c + w; one more node ends each word)."""
        start, m, ids, word, first = edges
        alpha = np.zeros((first[-1] + len(first) - 1, prob.shape[1]))
        alpha[first[:-1] + np.arange(len(first) - 1)] = 1.0
        at_end = start + m - first[word]
        order = np.lexsort((start + m + word, at_end))
        self._sweep(alpha, at_end[order], (start + word)[order], (start + m + word)[order], prob, ids[order])
        return alpha

    def backward(self, edges, prob: np.ndarray) -> np.ndarray:
        start, m, ids, word, first = edges
        beta = np.zeros((first[-1] + len(first) - 1, prob.shape[1]))
        beta[first[1:] + np.arange(len(first) - 1)] = 1.0
        left = first[word + 1] - start
        order = np.lexsort((start + word, left))
        self._sweep(beta, left[order], (start + m + word)[order], (start + word)[order], prob, ids[order])
        return beta

    def _long_expected(self, words: list[str], weight: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """As ``expected``, with sums of logarithms that cannot underflow."""
        start, m, ids, word, first = self.edges(words)
        n, own = len(words), np.arange(len(words))
        source, target, step = start + word, start + m + word, logp[ids]
        at_end, left = start + m - first[word], first[word + 1] - start
        ends = []
        for node, level, a, b in ((first[:-1] + own, at_end, source, target), (first[1:] + own, left, target, source)):
            value = np.full(first[-1] + n, -np.inf)
            value[node] = 0.0
            order = np.lexsort((b, level))
            lev, a, b, p = level[order], a[order], b[order], step[order]
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(lev)) + 1, [len(lev)]])
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                t = b[s:e]
                heads = np.concatenate([[0], np.flatnonzero(np.diff(t)) + 1])
                value[t[heads]] = np.logaddexp.reduceat(value[a[s:e]] + p[s:e], heads)
            ends.append(value)
        alpha, beta = ends
        w = np.exp(alpha[source] + step + beta[target] - alpha[first[1:] + own][word]) * weight[word]
        return np.bincount(ids, w, self.n_pieces)

    @staticmethod
    def _sweep(value, level, source, target, prob, ids) -> None:
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1, [len(level)]])
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if a == b:
                continue
            t = target[a:b]
            heads = np.concatenate([[0], np.flatnonzero(np.diff(t)) + 1])
            value[t[heads]] += np.add.reduceat(value[source[a:b]] * prob[ids[a:b]], heads, axis=0)

    def log_prob(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """Log probability of every word (rows) in every language."""
        out = np.empty((len(words), prob.shape[1]))
        short = np.fromiter((len(w) <= SHORT for w in words), bool, len(words))
        at = np.flatnonzero(short)
        for s in range(0, len(at), 20_000):
            own = at[s:s + 20_000]
            e = self.edges([words[i] for i in own])
            alpha = self.forward(e, prob)
            out[own] = np.log(alpha[e[4][1:] + np.arange(len(own))])
        for i in np.flatnonzero(~short):
            out[i] = self._long(words[i], prob)
        return out

    def _long(self, word: str, prob: np.ndarray) -> np.ndarray:
        """As ``log_prob``, rescaled at every character."""
        start, m, ids, _, first = self.edges([word])
        order = np.argsort(start + m, kind="stable")
        start, end, ids = start[order], (start + m)[order], ids[order]
        bounds = np.searchsorted(end, np.arange(1, first[-1] + 2))
        alpha = np.zeros((first[-1] + 1, prob.shape[1]))
        alpha[0] = 1.0
        scale = np.zeros(prob.shape[1])
        for t in range(1, first[-1] + 1):
            a, b = bounds[t - 1], bounds[t]
            alpha[t] = (alpha[start[a:b]] * prob[ids[a:b]]).sum(axis=0)
            if t % 8 == 0:  # keep the nodes still in reach near 1
                low = max(0, t - self.longest)
                top = alpha[low:t + 1].max(axis=0)
                alpha[low:t + 1] /= top
                scale += np.log(top)
        return np.log(alpha[first[-1]]) + scale

    def expected(self, words: list[str], weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """Expected count of every piece, each word counted ``weight`` times."""
        total = np.zeros(self.n_pieces)
        size = np.fromiter((len(w) for w in words), np.int64, len(words))
        at = np.flatnonzero(size <= SHORT)
        for s in range(0, len(at), 20_000):
            own = at[s:s + 20_000]
            e = self.edges([words[i] for i in own])
            alpha, beta = self.forward(e, prob), self.backward(e, prob)
            start, m, ids, word, first = e
            z = alpha[first[1:] + np.arange(len(own)), 0]
            w = alpha[start + word, 0] * prob[ids, 0] * beta[start + m + word, 0] * (weight[own] / z)[word]
            total += np.bincount(ids, w, self.n_pieces)
        at = np.flatnonzero(size > SHORT)
        at = at[np.argsort(size[at], kind="stable")]  # like lengths share their levels
        with np.errstate(divide="ignore"):
            logp = np.log(prob[:, 0]) if len(at) else prob
        ends = np.cumsum(size[at])
        s = 0
        while s < len(at):
            base = ends[s - 1] if s else 0
            stop = max(s + 1, int(np.searchsorted(ends, base + LONG_CHARS, side="right")))
            own = at[s:stop]
            total += self._long_expected([words[i] for i in own], weight[own], logp)
            s = stop
        return total


def has_letter(text: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def sample_by_language(docs: DataFrame, train_chars: int) -> DataFrame:
    """lang, text: about ``train_chars`` characters per language.

    Documents are drawn whole, by a hash of the id. A language that is thinned
    also keeps its document of the smallest hash, of which at most
    ``train_chars`` characters are learnt from, so that no language is lost."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text", "doc_id")
    mark = F.xxhash64(F.lit(37), "doc_id", "text")
    share = known.groupBy("lang").agg(
        F.least(F.lit(1.0), F.lit(float(train_chars)) / F.greatest(F.sum(F.length("text")), F.lit(1))).alias("share"),
        F.min(mark).alias("first"),
    ).collect()  # one row per language
    first = {r.lang: r.first for r in share if r.share < 1}
    share = {r.lang: r.share for r in share}
    if not share:
        return known.where("false").select("lang", "text")
    u = F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    per = F.create_map(*[F.lit(x) for kv in sorted(share.items()) for x in kv])
    drawn = u < F.try_element_at(per, F.col("lang"))
    sample = known.where(drawn).select("lang", "text")
    if not first:
        return sample
    firsts = F.create_map(*[F.lit(x) for kv in sorted(first.items()) for x in kv])
    kept = known.where(~drawn & (mark == F.try_element_at(firsts, F.col("lang"))))
    kept = kept.select("lang", F.substring("text", 1, int(train_chars)).alias("text"))
    return sample.unionByName(kept.dropDuplicates(["lang"]))


def train(docs: DataFrame, pieces: list[str], train_chars: int = TRAIN_CHARS, iterations: int = ITERATIONS) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (pieces + 1, languages) from rows
    (doc_id, text, lang); rows without a language are left out."""

    def count(batches):
        for whole in batches:
            for b in byte_slices(whole, "text"):
                flat, off = word_lists(b.column("text"))
                langs = b.column("lang").dictionary_encode()
                if not len(flat):
                    continue
                words, codes = encoded_words(flat)
                lang = np.repeat(langs.indices.to_numpy(), np.diff(off))
                key, n = np.unique(lang.astype(np.int64) * len(words) + codes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.dictionary.take(pa.array(key // len(words))).cast(pa.string()),
                        pa.array([words[i] for i in key % len(words)], pa.string()),
                        pa.array(n, pa.int64()),
                    ],
                    names=["lang", "word", "n"],
                )

    words = sample_by_language(docs, train_chars).mapInArrow(count, "lang string, word string, n long")
    words = stage(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    langs = sorted(r.lang for r in words.select("lang").distinct().collect())
    prob = np.full((len(pieces) + 1, len(langs)), 1.0 / (len(pieces) + 1))
    sc = docs.sparkSession.sparkContext
    vocabulary = sc.broadcast(pieces)
    for _ in range(iterations if langs else 0):
        model = sc.broadcast(prob)

        def expect(batches, model=model):
            lattice = Lattice(vocabulary.value)
            total = np.zeros((lattice.n_pieces, len(langs)))
            for b in batches:
                lang, word = b.column("lang").to_pylist(), b.column("word").to_pylist()
                n = b.column("n").to_numpy()
                lang = np.array([langs.index(x) for x in lang])
                for k in np.unique(lang):
                    at = np.flatnonzero(lang == k)
                    total[:, k] += lattice.expected([word[i] for i in at], n[at].astype(float), model.value[:, k:k + 1])
            p, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(k), pa.array(total[p, k])], names=["piece", "lang", "n"])

        counts = np.full(prob.shape, SMOOTHING)
        got = words.select("lang", "word", "n").mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        table = got.toArrow()  # at most pieces x languages rows
        counts[table.column("piece").to_numpy(), table.column("lang").to_numpy()] += table.column("n").to_numpy()
        prob = counts / counts.sum(axis=0)
        model.unpersist()
    return langs, prob


def identify(docs: DataFrame, keep: list[str], langs: list[str], prob: np.ndarray, pieces: list[str], out=("lang_pred", "score")) -> DataFrame:
    """``keep``, the predicted language and its score (posterior, all
    languages equally likely beforehand) for every row of ``docs`` (text)."""
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast((langs, prob, pieces))
    cols = keep if "text" in keep else [*keep, "text"]
    plain = docs.select(*[F.col("text").cast("string").alias("text") if c == "text" else F.col(c) for c in cols])
    schema = plain.select(*keep).schema.add(out[0], "string").add(out[1], "double")

    def run(batches):
        names, p, vocabulary = model.value
        lattice = Lattice(vocabulary)
        cache: dict[str, int] = {}
        held = 0
        rows = np.zeros((0, len(names)))
        for whole in batches:
            for b in byte_slices(whole, "text"):
                text = b.column("text")
                flat, off = word_lists(text)
                words, codes = encoded_words(flat)
                new = [w for w in words if w not in cache]
                held += sum(map(len, new))
                if len(cache) + len(new) > WORD_CACHE or held > CACHE_CHARS:
                    cache, rows, new, held = {}, rows[:0].copy(), words, sum(map(len, words))
                rows = np.concatenate([rows, lattice.log_prob(new, p)]) if new and names else rows
                cache.update(zip(new, range(len(cache), len(cache) + len(new)), strict=True))
                n = len(text)
                if not names:
                    pred, score = [UND] * n, np.zeros(n)
                else:
                    table = rows[np.fromiter((cache[w] for w in words), np.int64, len(words))] if words else rows[:0]
                    ends = np.concatenate([np.zeros((1, len(names))), np.cumsum(table[codes], axis=0)]) if words else np.zeros((1, len(names)))
                    logp = ends[off[1:]] - ends[off[:-1]]
                    best = logp.argmax(axis=1)
                    score = 1.0 / np.exp(logp - logp.max(axis=1, keepdims=True)).sum(axis=1)
                    letter = has_letter(text)
                    pred = [names[k] if ok else UND for k, ok in zip(best, letter, strict=True)]
                    score = np.where(letter, score, 0.0)
                own = [b.column(c) for c in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(pred, pa.string()), pa.array(score)], names=[*keep, *out])
        del lattice, cache, rows
        release()

    return plain.mapInArrow(run, schema)


def identify_documents(docs: DataFrame, learn, keep: list[str], train_chars: int = TRAIN_CHARS, out=("lang_pred", "score")) -> DataFrame:
    """Train on the rows of ``docs`` where the condition ``learn`` holds,
    then identify all rows."""
    pieces = default_vocabulary()
    langs, prob = train(docs.where(learn), pieces, train_chars)
    return identify(docs, keep, langs, prob, pieces, out)
