"""Suffix sorting by induction, with queues that spill to disk.

``suffix_buckets`` yields the positions of a text in suffix order, bucket by
bucket. Positions are S or L by whether their suffix is smaller or larger
than the next one's. The sorted leftmost-S suffixes induce the order of all
L suffixes in one ascending pass, and those the order of all S suffixes in
one descending pass. The leftmost-S suffixes themselves are sorted by a
first pass over their unsorted positions, which orders the substrings
between them, and by sorting the string of those substrings' names.

The passes' priority queues are keyed by first symbol: what a pass pushes
for a symbol arrives in suffix order, so that each queue is a file that is
appended to and read once. A queue holds at most ``memory`` positions before
it goes to its file.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

MEMORY = 1 << 20


class DiskQueue:
    """One append-only queue of positions per symbol."""

    def __init__(self, symbols: int, folder: str, memory: int = MEMORY):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(symbols)]
        self.held = [0] * symbols
        self.spilled = [False] * symbols
        self.folder, self.memory = folder, memory

    def _file(self, c: int) -> str:
        return os.path.join(self.folder, f"{id(self)}-{c}.queue")

    def push(self, positions: np.ndarray, symbols: np.ndarray) -> None:
        """Append positions to the queues of their symbols, in order."""
        if not len(positions):
            return
        order = np.argsort(symbols, kind="stable")
        positions, symbols = positions[order], symbols[order]
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        for part, c in zip(np.split(positions, cuts), symbols[np.concatenate([[0], cuts])], strict=True):
            self.parts[c].append(part)
            self.held[c] += len(part)
            if self.held[c] > self.memory:
                with open(self._file(c), "ab") as f:
                    for p in self.parts[c]:
                        p.tofile(f)
                self.parts[c], self.held[c], self.spilled[c] = [], 0, True

    def take(self, c: int) -> np.ndarray:
        """All positions of a symbol, in the order they came; empties it."""
        parts, self.parts[c], self.held[c] = self.parts[c], [], 0
        if self.spilled[c]:
            parts = [np.fromfile(self._file(c), np.int64), *parts]
            os.remove(self._file(c))
            self.spilled[c] = False
        return np.concatenate(parts) if parts else np.empty(0, np.int64)


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S)."""
    n = len(text)
    diff = np.sign(text[1:].astype(np.int32) - text[:-1].astype(np.int32)).astype(np.int8)
    at = np.where(diff != 0, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.concatenate([np.where(at < n, diff[np.minimum(at, n - 2)] > 0, False), [True]])


def _induce(text, small, lms, symbols: int, folder: str, memory: int):
    """Yield, from the largest symbol to the smallest, (symbol, L positions
    ascending, S positions descending) given the leftmost-S positions."""
    by_symbol = DiskQueue(symbols, folder, memory)
    by_symbol.push(lms, text[lms])
    queue, done = DiskQueue(symbols, folder, memory), DiskQueue(symbols, folder, memory)
    for c in range(symbols):
        source = queue.take(c)
        while len(source):  # pushes to the same symbol go on behind
            done.push(source, np.full(len(source), c))
            before = source[source > 0] - 1
            before = before[~small[before]]
            own = text[before] == c
            queue.push(before[~own], text[before[~own]])
            source = before[own]
        source = by_symbol.take(c)
        before = source[source > 0] - 1
        queue.push(before, text[before])
    queue = DiskQueue(symbols, folder, memory)
    for c in range(symbols - 1, -1, -1):
        found, source = [], queue.take(c)
        while len(source):
            found.append(source)
            before = source[source > 0] - 1
            before = before[small[before]]
            own = text[before] == c
            queue.push(before[~own], text[before[~own]])
            source = before[own]
        large = done.take(c)
        source = large[::-1]
        before = source[source > 0] - 1
        before = before[small[before]]
        queue.push(before, text[before])
        yield c, large, np.concatenate(found) if found else np.empty(0, np.int64)


def _sorted_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, by their first ``depth``
    names at least (all, if shorter): by doubling."""
    rank, k = names.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while k < depth and len(rank) and rank.max() + 1 < len(rank):
        after = np.full(len(rank), -1, np.int64)
        after[:-k or None] = rank[k:] if k < len(rank) else -1
        key = rank * (len(rank) + 1) + after + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(len(rank), np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank, k = new, 2 * k
    return order


def suffix_buckets(text: np.ndarray, hashes, depth: int, memory: int = MEMORY):
    """Yield arrays of positions, in suffix order from the largest suffix to
    the smallest; suffixes equal in their first ``depth`` symbols are next to
    each other. ``text`` (small unsigned integers) ends in its only 0, which
    is left out;
    ``hashes(start, length)`` gives hashes of substrings."""
    symbols = int(text.max()) + 1
    small = suffix_types(text)
    is_lms = small.copy()
    is_lms[0] = False
    is_lms[1:] &= ~small[:-1]
    lms = np.flatnonzero(is_lms)
    with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
        found = [s[is_lms[s]] for _, _, s in _induce(text, small, lms, symbols, folder, memory)]
        end = len(text) - 1
        order = np.concatenate([np.concatenate([*found, np.empty(0, np.int64)]), [end]])[::-1]
        after = np.append(lms[1:], end)
        place = np.searchsorted(lms, order)
        length = after[place] - order + 1
        h = hashes(order, np.minimum(length, len(text) - order))
        new = np.ones(len(order), bool)
        new[1:] = (h[1:] != h[:-1]) | (length[1:] != length[:-1])
        names = np.empty(len(lms), np.int64)
        names[place] = np.cumsum(new) - 1
        if not new.all():  # a name spans two symbols at least
            order = lms[_sorted_names(names, depth // 2 + 1)]
        for _, large, s in _induce(text, small, order, symbols, folder, memory):
            yield s
            yield large[::-1]
