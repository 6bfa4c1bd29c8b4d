"""Periodic runs of words: squares are caught by dyadic blocks as words are appended."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from energylake.llm.common import map_texts, pick

LEAST_LENGTH = 12
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One 64-bit name for each pair of names."""
    z = (left ^ (left >> np.uint64(31))) * ODD[0] + (right ^ (right >> np.uint64(29))) * ODD[1]
    return (z ^ (z >> np.uint64(32))) * ODD[2]


class Catchers:
    """The runs of a sequence to which symbols are appended, a few or many at a time.

    Level k names every stretch of m = 2**k symbols, equal stretches alike, and holds a
    catcher for each completed block, a stretch that begins at a multiple of m.  Of a run with
    period p between 2m and 4m, some block and its copy p further on lie within the run.  So
    each appended symbol ends one stretch a level, which is compared with the two blocks that
    began 2m to 4m before it.  An equal pair is stretched to both sides by names of falling
    length; if the whole is two periods long, a square is caught, and all squares of a period
    that touch come out as the same run.  Periods below 8 are left to blocks of two symbols,
    as a run has ``least`` symbols at least.  Time is n log n for n symbols, also if they all repeat.

    Names are 64-bit hashes.  Every run is compared symbol by symbol at the end, so a
    collision can't change the result: it is found, and the work is done again with other names.
    """

    def __init__(self, least: int = LEAST_LENGTH, longest: int | None = None, seed: int = 0):
        if least < 10:  # a run of period 7 or less must hold a block of two and its copy
            raise ValueError("runs shorter than 10 are not supported")
        self.least, self.longest, self.seed = least, longest, seed
        self.symbols = np.empty(0, np.int64)
        self.names: list[np.ndarray] = []
        self.open = np.empty((0, 2), np.int64)  # start and period of what reaches the end
        self.closed: dict[tuple[int, int], int] = {}

    def append(self, symbols: np.ndarray) -> None:
        before = len(self.symbols)
        self.symbols = np.concatenate([self.symbols, np.asarray(symbols, np.int64)])
        n = len(self.symbols)
        if n == before:
            return
        longest = n if self.longest is None else min(n, self.longest)
        self._name(longest)
        # starts of equal stretches and how much later the other is; what reached the end goes on
        at, period = [self.open[:, 0]], [self.open[:, 1]]
        for k in range(1, len(self.names)):
            m = 1 << k
            if m > 2 and 4 * m > longest:
                break
            stretch = np.arange(max(0, before - m + 1), n - m + 1)
            for a, p in self._equal(k, m, stretch):
                at.append(a)
                period.append(p)
        self._stretch(np.concatenate(at), np.concatenate(period), n)

    def _name(self, longest: int) -> None:
        """Names of the stretches that the new symbols end, level by level."""
        n, k = len(self.symbols), 0
        while 1 << k <= longest:
            m = 1 << k
            if k == len(self.names):
                self.names.append(np.empty(0, np.uint64))
            old = len(self.names[k])
            if k == 0:
                new = self.symbols[old:].astype(np.uint64)
                new = mixed(new, new + np.uint64(self.seed))
            else:
                below, h = self.names[k - 1], m >> 1
                new = mixed(below[old:n - m + 1], below[old + h:n - m + 1 + h])
            self.names[k] = np.concatenate([self.names[k], new])
            k += 1

    def _equal(self, k: int, m: int, stretch: np.ndarray):
        """Blocks equal to a stretch that began up to 4m later: their starts and distances."""
        names = self.names[k]
        if m == 2:
            for p in range(1, 8):
                block = stretch[(stretch >= p) & ((stretch - p) % 2 == 0)] - p
                block = block[names[block] == names[block + p]]
                yield block, np.full(len(block), p)
            return
        own = stretch // m
        for back in (2, 3):
            later = stretch[own >= back]
            block = (later // m - back) * m
            same = names[block] == names[later]
            yield block[same], (later - block)[same]

    def _stretch(self, at: np.ndarray, period: np.ndarray, n: int) -> None:
        """Extend equal pairs to both sides and keep the runs."""
        left, right = np.zeros_like(at), np.zeros_like(at)
        for k in range(len(self.names) - 1, -1, -1):
            m, names = 1 << k, self.names[k]
            top = len(names) - 1
            a = at - left - m
            left += m * ((a >= 0) & (names[np.maximum(a, 0)] == names[np.clip(a + period, 0, top)]))
            a = at + right
            b = a + period
            right += m * ((b <= top) & (names[np.minimum(a, top)] == names[np.minimum(b, top)]))
        start, end = at - left, at + period + right
        whole = end - start >= np.maximum(2 * period, self.least)
        self.open = np.unique(np.stack([start, period], 1)[end == n], axis=0)
        shut = np.unique(np.stack([start, end, period], 1)[whole & (end < n)], axis=0)
        for s, e, p in shut.tolist():
            self.closed[s, e] = min(p, self.closed.get((s, e), p))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of every run so far, the smallest period of each stretch."""
        n, best = len(self.symbols), dict(self.closed)
        for s, p in self.open.tolist():
            if n - s >= max(2 * p, self.least):
                best[s, n] = min(p, best.get((s, n), p))
        w = self.symbols
        if not all(np.array_equal(w[s:e - p], w[s + p:e]) for (s, e), p in best.items()):
            again = Catchers(self.least, self.longest, self.seed + 1)
            again.append(w)
            return again.runs()
        return sorted((s, e - s, p) for (s, e), p in best.items())


def runs_of(texts: list[list[bytes]], least: int = LEAST_LENGTH) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words; all are appended to one sequence, with marks between them."""
    number: dict[bytes, int] = {}
    symbols, starts, at = [], [], 0
    for i, words in enumerate(texts):
        starts.append(at)
        symbols.extend([number.setdefault(w, len(number)) for w in words])
        symbols.append(-1 - i)  # a mark of its own: nothing repeats across it
        at += len(words) + 1
    catchers = Catchers(least, max(map(len, texts), default=0) or 1)
    catchers.append(np.array(symbols, np.int64))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = catchers.runs()
    where = np.searchsorted(starts, [s for s, _, _ in found], "right") - 1
    for i, (s, length, p) in zip(where.tolist(), found):
        out[i].append((s - starts[i], length, p))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """Words joined by a space, of each run only the first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


def find_runs(docs: DataFrame, least: int = LEAST_LENGTH, id_col: str = "doc_id", text_col: str = "text",
              rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document: doc_id, runs (start, length, period in words) and collapsed text.

    Words are stretches without ASCII white space.  A run has ``least`` words and two
    periods at least, its period is its smallest, and no neighbouring word extends it.  Runs
    come by start, then period.  ``collapsed`` holds the words outside runs and the first
    period of each run, joined by one space.  A null or empty text has no words: no runs and
    an empty collapsed text.  Repeated rows are searched each for itself.  ``rewrite`` may turn
    the words of a row into others before, given its id and words in UTF-8.
    """
    own = pick(docs, doc_id=id_col, key=id_col, text=text_col)
    number = own.columns.index("key")
    added = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    struct = pa.struct([(f.name, pa.int64()) for f in RUN.fields])

    def make():
        def work(texts, keys):
            words = [(t or "").encode().split() for t in texts]
            if rewrite is not None:
                words = [rewrite(k, w) for k, w in zip(keys, words)]
            runs = runs_of(words, least)
            flat = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields=list(struct))
            return [pa.ListArray.from_arrays(pa.array(offsets), values),
                    pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string())]
        return work

    return map_texts(own, "text", added, make, also=number).drop("key")
