"""Periodic run detection by online dyadic square catching (operator 11).

A run of period q and length 4q or more contains an aligned block of the power of two L with
L <= q < 2L that begins less than L words after the run does, and so at least 3q words of the
run follow the block's start.  As words are appended, each completed block therefore gets
catchers, one for each period of its level: a catcher (s, q) compares the words from s on
with those q later, word by word as they come, and is dropped at the first difference.  One
whose comparison reaches 2q words has caught squares (xx and, overlapping it, another), which
are widened to both sides as far as the period holds; right ends that reach the last word
stay open and grow with the words appended later.  Catches of the same stretch merge into one
run; the shortest period it was caught with is its smallest (multiples of it give the same
stretch again).

All documents of a slice form one stream of word numbers in which no two documents share a
number, so no comparison outlives its document and all catchers advance together in numpy: a
block's catchers make their first comparison against the next block in one pass over it, the
few that remain advance by differences of a rolling hash.  A run is reported only after its
words themselves were compared, so the hash can cost time but never a wrong run.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, mix64, slices

#: Runs are as long as four of their periods at least; the levels' proof needs it.
LEAST_PERIODS = 4
LEAST_WORDS = 6
#: Words appended at once.
APPEND = 1 << 16

_BASE = np.uint64(0xB5297A4D3F84D5B5)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


class Catchers:
    """The catchers of one stream of word numbers: ``append`` words in any pieces, ``runs``
    then gives the runs of what was appended so far."""

    def __init__(self, capacity: int, longest: int):
        """``capacity``: words that will come at most; ``longest``: of a document."""
        self.words = np.zeros(capacity, np.int64)
        self.n = 0
        with np.errstate(over="ignore"):
            self.powers = np.full(capacity + 1, _BASE, np.uint64)
            self.powers[0] = 1
            np.cumprod(self.powers, out=self.powers)
        self.sums = np.zeros(capacity + 1, np.uint64)
        self.levels = [1 << k for k in range(64) if LEAST_PERIODS << k <= longest]
        none = np.zeros(0, np.int64)
        self.live = (none, none, none)      # start, period, words compared
        self.open = (none, none, none)      # start, period, end so far
        self.closed = [(none, none, none)]

    def _same(self, at: np.ndarray, size: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Are ``size`` words from ``at`` on those ``d`` later (by their hash)?"""
        with np.errstate(over="ignore"):
            return ((self.sums[at + size] - self.sums[at]) * self.powers[d]
                    == self.sums[at + d + size] - self.sums[at + d])

    def append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        self.words[old:self.n] = words
        with np.errstate(over="ignore"):
            values = mix64(words.astype(np.uint64)) * self.powers[old:self.n]
            np.cumsum(values, out=values)
            self.sums[old + 1:self.n + 1] = self.sums[old] + values
        new = [self.live, *(self._begin(size, old) for size in self.levels)]
        s, d, done = (np.concatenate(x) for x in zip(*new))
        upto = np.minimum(2 * d, self.n - s - d)
        alive = self._same(s + done, upto - done, d)
        s, d, done = s[alive], d[alive], upto[alive]
        caught = done == 2 * d
        self.live = (s[~caught], d[~caught], done[~caught])
        self._widen(s[caught], d[caught])

    def _begin(self, size: int, old: int) -> tuple:
        """The catchers of the blocks of ``size`` words whose next block has been completed by
        this append, after their first comparison."""
        lo, hi = max(0, old // size - 1), self.n // size - 1
        if hi <= lo:
            return self.closed[0]
        blocks = self.words[lo * size:(hi + 1) * size].reshape(-1, size)
        at, d = np.divmod(np.flatnonzero((blocks[1:] == blocks[:-1, :1]).ravel()), size)
        s, d = (at + lo) * size, d + size
        if size > 1:                        # the second words, where they are there already
            later = np.minimum(s + 1 + d, self.n - 1)
            alive = (s + 1 + d >= self.n) | (self.words[s + 1] == self.words[later])
            s, d = s[alive], d[alive]
        return s, d, np.ones(len(s), np.int64)

    def _widen(self, s: np.ndarray, d: np.ndarray) -> None:
        """Extend catches to the left, and these and the open runs to the right."""
        order = np.lexsort((s, d))
        s, d = s[order], d[order]
        first = np.ones(len(s), bool)       # of a chain of catches of one stretch
        first[1:] = (d[1:] != d[:-1]) | (s[1:] - s[:-1] > d[1:])
        s, d = s[first], d[first]
        lo, hi = np.zeros(len(s), np.int64), s.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self._same(s - mid, mid, d)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        a, d, b = (np.concatenate(x) for x in zip(self.open, (s - lo, d, s + 3 * d)))
        lo, hi = np.zeros(len(a), np.int64), self.n - b
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self._same(b - d, mid, d)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        b = b + lo
        still = b == self.n
        self.open = (a[still], d[still], b[still])
        self.closed.append((a[~still], d[~still], b[~still]))

    def runs(self, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> tuple:
        """(start, length, period) arrays of the runs, by start, then period."""
        a, d, b = (np.concatenate(x) for x in zip(*self.closed, self.open))
        long = b - a >= np.maximum(least_words, least_periods * d)
        a, d, b = a[long], d[long], b[long]
        order = np.lexsort((d, b, a))
        a, d, b = a[order], d[order], b[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, d, b = a[first], d[first], b[first]
        w = self.words
        if not all(np.array_equal(w[i:k - q], w[i + q:k]) for i, q, k in zip(a, d, b)):
            a, d, b = self._word_by_word(least_words, least_periods)
        order = np.lexsort((d, a))
        return a[order], (b - a)[order], d[order]

    def _word_by_word(self, least_words: int, least_periods: int) -> tuple:
        """The same without the hash, should it ever have misled."""
        w, found = self.words[:self.n], {}
        for d in range(1, 2 * self.levels[-1]):
            same = np.concatenate([[False], w[d:] == w[:-d], [False]])
            edge = np.flatnonzero(same[1:] != same[:-1])
            for i, k in zip(edge[::2].tolist(), (edge[1::2] + d).tolist()):
                if k - i >= max(least_words, least_periods * d):
                    found.setdefault((i, k), d)
        out = np.array([(i, d, k) for (i, k), d in found.items()], np.int64).reshape(-1, 3)
        return out[:, 0], out[:, 1], out[:, 2]


def runs_of(texts: pa.Array, least_words: int = LEAST_WORDS,
            least_periods: int = LEAST_PERIODS) -> tuple[pa.Array, pa.Array]:
    """The runs of each text (a list column) and the text without its repeated words."""
    fresh_number, split, numbers = count().__next__, [], []
    for text in texts.cast(pa.binary()).to_pylist():
        words = (text or b"").split()       # bytes split at the six blanks of WORD
        split.append(words)
        own = defaultdict(fresh_number)     # no number is used in two documents
        numbers.append(np.fromiter(map(own.__getitem__, words), np.int64, len(words)))
    ends = np.cumsum([len(x) for x in numbers])
    stream = np.concatenate([*numbers, np.zeros(0, np.int64)])
    catchers = Catchers(len(stream), max(map(len, numbers), default=0))
    for k in range(0, len(stream), APPEND):
        catchers.append(stream[k:k + APPEND])
    start, length, period = catchers.runs(least_words, least_periods)
    doc = np.searchsorted(ends, start, "right")
    begins = ends - [len(x) for x in numbers]
    start = start - begins[doc] if len(start) else start
    offsets = np.searchsorted(doc, np.arange(len(texts) + 1))
    texts_out = []
    for k, words in enumerate(split):
        mine = slice(offsets[k], offsets[k + 1])
        if mine.start < mine.stop:
            depth = np.zeros(len(words) + 1, np.int64)
            np.add.at(depth, start[mine] + period[mine], 1)
            np.add.at(depth, start[mine] + length[mine], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
        texts_out.append(b" ".join(words))
    found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)],
                                       ["start", "length", "period"])
    return (pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found).cast(_RUN),
            pa.array(texts_out, pa.binary()).cast(pa.string()))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of ``docs``.

    Words are runs of characters other than blanks, numbered from 0 and compared as they are.
    ``runs``: every maximal stretch (start, length, period) of smallest period q and at least
    max(``least_words``, ``least_periods`` * q) words, by start, then period; ``least_periods``
    is 4 or more.  ``collapsed``: the words, joined by one blank, without those that a run
    holds after its first q words.  Null and empty texts have no runs and an empty
    ``collapsed``; each of several rows with one id (or none) gets its own row; an empty table
    gives an empty result; other columns are ignored.  No row is shuffled: one map over the
    texts, which holds about a megabyte of text (or one longer text) at a time.
    """
    if least_periods < LEAST_PERIODS:
        raise ValueError(f"least_periods is at least {LEAST_PERIODS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *runs_of(rows.column(1), least_words, least_periods)],
                    ["doc_id", "runs", "collapsed"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id bigint, runs {RUNS}, collapsed string")
