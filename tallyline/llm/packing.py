"""Best-fit packing of tokenised documents into fixed-length sequences.

Method: bin completion (branch and bound). Around the largest document still
unpacked, the undominated fillings of one sequence are enumerated; a filling
is dominated when one of its documents could be swapped for a larger one
left outside. Branches whose accumulated waste shows that they cannot beat
the incumbent are pruned; the incumbent starts as the best-fit-decreasing
solution, and is kept if the search finds nothing better within its node
budget (the budget bounds time only: every document is always packed).

Limits of the enumeration: a level tries its 3 largest sizes that fit, a bin's
enumeration ends after 400 steps or at the first filling without waste, the
``MAX_FILLINGS`` fullest fillings are branched on, and dominance is tested by
swaps of one document for one. Where best fit misses the lower bound, a group
may thus keep more sequences than the fewest possible.

At scale the pieces are dealt into groups by a hash of their identity. A
group holds about ``group_tokens`` tokens whatever the corpus size, so no
group grows with a hot key, and every group is packed on its own. A group
loses less than one sequence to rounding, i.e. under
``seq_len / group_tokens`` of the output.

Defined results: null or empty text is a document of only the closing id; a
repeated row is packed as often as it occurs; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, encoded_words, release, stage, text_of, word_lists

SEQ_LEN = 4096
END_ID = 1
TOKENIZER_FILE = "word_bpe_49k.json"
GROUP_TOKENS = 4_000_000
NODE_BUDGET = 2_000
MAX_FILLINGS = 4
WORD_CACHE = 300_000
#: bytes of text that are tokenised together: what a worker holds besides its
#: words is some 30 times as much
ENCODE_BYTES = 1 << 20

PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


#: punctuation that the tokenizer splits off a letter or digit before it
_TAIL = re.compile(r"^(.*[0-9A-Za-z])([.,;:!?%&$*#]+)$", re.S)

#: words that the tokenizer's normaliser only puts in lower case and its
#: splitter keeps whole; they go straight to its model, spelt byte by byte
_PLAIN = re.compile(r"[a-zA-Z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")


def _byte_spelling() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of whole texts by way of their distinct words.

    The tokenizer drops white space and no token spans it, so a text's ids
    are its words' ids one after the other; likewise a word's with closing
    punctuation. It ignores case, but for its special tokens, which all hold
    ``<|``. Words are encoded once and kept in a bounded cache: one flat
    array of ids, and each word's place there."""

    def __init__(self, path: str, cache: int = WORD_CACHE):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.spelling = _byte_spelling()
        self.size = cache
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if _PLAIN.fullmatch(w)]
        other = [w for w in words if not _PLAIN.fullmatch(w)]
        words, found, n = plain + other, [], []
        for w in plain:
            low = w.lower()
            if not low.isascii():
                low = low.encode().decode("latin-1").translate(self.spelling)
            ids = [t.id for t in self.model.tokenize(low)]
            found += ids
            n.append(len(ids))
        for s in range(0, len(other), 4096):
            for e in self.tok.encode_batch(other[s:s + 4096], add_special_tokens=False):
                found += e.ids
                n.append(len(e.ids))
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words)), strict=True))
        self.ids = np.concatenate([self.ids, np.array(found, np.uint32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(n, dtype=np.int64)])

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the offsets of each text's ids."""
        special = pc.any(pc.match_substring(pc.fill_null(text, ""), "<|")).as_py()
        flat, off = word_lists(text, lower=not special)
        words, codes = encoded_words(flat)
        if not words:
            return np.empty(0, np.uint32), np.zeros(len(off), np.int64)
        tails = [None if w[-1].isalnum() else _TAIL.match(w) for w in words]
        parts = [w if t is None else t[1] for w, t in zip(words, tails, strict=True)]
        ends = [t[2] if t else "" for t in tails]
        new = {w for w in parts if w not in self.place} | {w for w in ends if w not in self.place}
        if len(self.place) + len(new) > self.size:
            self.clear()
            new = {*parts, *ends}
        if new:
            self._learn(list(new))
        a = np.fromiter((self.place[w] for w in parts), np.int64, len(parts))[codes]
        b = np.fromiter((self.place[w] for w in ends), np.int64, len(ends))[codes]
        which = np.column_stack([a, b]).ravel()
        n = self.ends[which + 1] - self.ends[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(self.ends[which] - upto[:-1], n) + np.arange(upto[-1])]
        return ids, upto[2 * off]


def tokenize_pieces(docs: DataFrame, path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, salt: one row per piece."""

    def run(batches):
        enc = WordEncoder(path)
        end = np.array([end_id], np.uint32)
        for whole in batches:
            for b in byte_slices(whole, "text", ENCODE_BYTES):
                ids, off = enc.encode(b.column("text"))
                rows = []
                for i, d in enumerate(b.column("doc_id").to_pylist()):
                    own = np.concatenate([ids[off[i]:off[i + 1]], end]).astype("<u4")
                    for k, s in enumerate(range(0, len(own), seq_len)):
                        part = own[s:s + seq_len]
                        c = zlib.crc32(part.tobytes())
                        rows.append((d, k, s, len(part), c, zlib.crc32(b"%d/%d" % (d or 0, k), c)))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"],
                )
        del enc
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, PIECES_SCHEMA)


def _fillings(room: int, sizes: list[int], left: dict[int, int], most: int) -> list[list[int]]:
    """Undominated ways to fill ``room`` from the multiset ``left`` (sizes
    ascending): fullest first, at most ``most`` of them."""
    found: list[list[int]] = []
    steps = 0

    def go(room: int, hi: int, used: list[int], taken: dict[int, int]) -> bool:
        nonlocal steps
        i = min(hi, bisect.bisect_right(sizes, room) - 1)
        while i >= 0 and left[sizes[i]] - taken.get(sizes[i], 0) <= 0:
            i -= 1
        if i < 0:
            found.append(used)
            return room == 0 or len(found) >= 4 * most
        tried = 0
        while i >= 0 and tried < 3:
            s = sizes[i]
            if left[s] - taken.get(s, 0) > 0:
                steps += 1
                tried += 1
                if go(room - s, i, [*used, s], taken | {s: taken.get(s, 0) + 1}) or steps > 400:
                    return True
            i -= 1
        return False

    go(room, len(sizes) - 1, [], {})
    kept: list[list[int]] = []
    for f in sorted(found, key=lambda f: (-sum(f), len(f))):
        if f not in kept and not _dominated(room, f, sizes, left):
            kept.append(f)
        if len(kept) >= most:
            break
    return kept or ([max(found, key=sum)] if found else [[]])


def _dominated(room: int, filling: list[int], sizes: list[int], left: dict[int, int]) -> bool:
    """Whether one document of the filling could be swapped for a larger one
    outside it that still fits."""
    slack = room - sum(filling)
    if slack == 0:
        return False
    for s in set(filling):
        i = bisect.bisect_right(sizes, s + slack) - 1
        while i >= 0 and sizes[i] > s:
            if left[sizes[i]] - filling.count(sizes[i]) > 0:
                return True
            i -= 1
    return False


def best_fit_decreasing(lengths: list[int], cap: int) -> list[list[int]]:
    """Bins of lengths: each goes to the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, x)
        if i < len(rooms):
            r = rooms[i]
            b = by_room[r].pop()
            if not by_room[r]:
                del by_room[r]
                rooms.pop(i)
        else:
            r, b = cap, len(bins)
            bins.append([])
        bins[b].append(x)
        if (room := r - x) > 0:
            if room not in by_room:
                by_room[room] = []
                bisect.insort(rooms, room)
            by_room[room].append(b)
    return bins


def bin_completion(lengths: list[int], cap: int, node_budget: int = NODE_BUDGET) -> list[list[int]]:
    """Pack ``lengths`` (1..cap) into few bins; lists of lengths."""
    if not lengths:
        return []
    best = best_fit_decreasing(lengths, cap)
    total = sum(lengths)
    least = max(-(-total // cap), sum(2 * x > cap for x in lengths))
    if len(best) <= least:
        return best
    left: dict[int, int] = {}
    for x in lengths:
        left[x] = left.get(x, 0) + 1
    sizes = sorted(left)
    packed: list[list[int]] = []

    def frame(waste: int) -> list:
        """A choice: fillings not yet tried, its bin now packed, waste before."""
        big = sizes[-1]
        left[big] -= 1
        ways = _fillings(cap - big, sizes, left, MAX_FILLINGS)
        left[big] += 1
        return [[[big, *w] for w in ways[::-1]], False, waste]

    stack, budget = [frame(0)], node_budget + 2 * len(best)
    while stack and budget > 0:
        top = stack[-1]
        if top[1]:
            for x in packed.pop():
                if left[x] == 0:
                    bisect.insort(sizes, x)
                left[x] += 1
            top[1] = False
        if not top[0]:
            stack.pop()
            continue
        budget -= 1
        own = top[0].pop()
        packed.append(own)
        top[1] = True
        for x in own:
            left[x] -= 1
            if left[x] == 0:
                sizes.pop(bisect.bisect_left(sizes, x))
        waste = top[2] + cap - sum(own)
        if not sizes:
            if len(packed) < len(best):
                best = [list(p) for p in packed]
                if len(best) <= least:
                    break
        elif max(-(-(total + waste) // cap), len(packed) + 1) < len(best):
            stack.append(frame(waste))
    return best


def _pack_group(seq_len: int, node_budget: int):
    def run(key, table):
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = table.column("length").to_numpy()
        bins = bin_completion([int(x) for x in lengths], seq_len, node_budget)
        starts = {int(x): int(i) for x, i in zip(*np.unique(-lengths, return_index=True), strict=True)}
        seq, off = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        base = int(key[0].as_py()) << 32
        for b, own in enumerate(bins):
            at = 0
            for x in own:
                i = starts[-x]
                starts[-x] += 1
                seq[i], off[i] = base + b, at
                at += x
        return table.drop_columns(["grp"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))

    return run


def pack(pieces: DataFrame, seq_len: int = SEQ_LEN, group_tokens: int = GROUP_TOKENS, node_budget: int = NODE_BUDGET) -> DataFrame:
    """Give every piece its sequence and its place there."""
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-int(total) // group_tokens))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("salt"), F.lit(groups))).drop("salt")
    return dealt.groupBy("grp").applyInArrow(_pack_group(seq_len, node_budget), out)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, seq_len: int = SEQ_LEN, end_id: int = END_ID, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and pack every document; only those
    longer than ``seq_len`` are cut."""
    pieces = stage(tokenize_pieces(docs, tokenizer_path or default_tokenizer_path(), seq_len, end_id), "pieces")
    return pack(pieces, seq_len, group_tokens)
