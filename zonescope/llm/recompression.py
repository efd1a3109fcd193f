"""Periodic runs of words, found with a run-length grammar by recompression.

The words of a batch of documents form one sequence with a different
separator around each document.  Block compression (``a a a`` becomes one
symbol) and pair compression (the alphabet is split in two by a hash bit, and
every left symbol followed by a right one is joined) alternate until each
document is one symbol.  Equal stretches are parsed alike except near their
ends, so a longest common extension climbs the levels while both sides agree
and comes down where they differ, with a few steps a level; all extensions of
a batch are answered together.

A run of exponent e >= 3 and period p holds a point i of the harmonic grid
0, (e-2)p, 2(e-2)p, ... of its document such that the p words from i on repeat
p words later.  Grid points whose first, middle and last word agree are
candidates; the grammar extends them both ways to the exact run.  No suffix
array, no all-pairs comparison: about n ln(n) grid points a document.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from zonescope.llm.common import arrow_map, byte_texts, id_and_text, slices

#: A run repeats its period at least so often and has at least so many words.
EXPONENT = 4
LEAST_WORDS = 6
#: Text that shares one grammar, in bytes; a longer document has one of its own.
GRAMMAR_BYTES = 4 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>, text string"


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every c of ``counts``, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


class Grammar:
    """Levels of symbols over a sequence whose ids below ``separators`` occur once each and are never joined.

    ``symbols[k]`` are the symbols of level k, ``parent[k]`` their places on
    level k + 1, ``first[k]`` the places on level k where those of level k + 1
    begin (closed by the length), ``blocks[k]`` whether level k + 1 joins
    blocks of one symbol or else pairs.
    """

    def __init__(self, sequence: np.ndarray, separators: int):
        self.symbols = [sequence.astype(np.int64)]
        self.parent: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.blocks: list[bool] = []
        self.separators = separators
        self._next = int(sequence.max()) + 1
        turn = 0
        while True:
            self._join_blocks()
            free = self.symbols[-1] >= separators
            if not (free[:-1] & free[1:]).any():
                break
            turn += 1
            self._join_pairs(free, turn)

    def _name(self, keys: np.ndarray) -> np.ndarray:
        """A new symbol for every distinct key."""
        distinct, names = np.unique(keys, return_inverse=True)
        names = names + self._next
        self._next += len(distinct)
        return names

    def _close(self, begins: np.ndarray, joined: np.ndarray, keys: np.ndarray, blocks: bool) -> None:
        """Add a level: its symbols begin at ``begins``; those at ``joined`` are new and named by ``keys``."""
        below = self.symbols[-1]
        above = below[begins].copy()
        above[joined] = self._name(keys)
        starts = np.zeros(len(below), np.int32)
        starts[begins] = 1
        self.parent.append(np.cumsum(starts, dtype=np.int32) - 1)
        self.first.append(np.append(begins, len(below)).astype(np.int32))
        self.blocks.append(blocks)
        self.symbols.append(above)

    def _join_blocks(self) -> None:
        below = self.symbols[-1]
        begins = np.flatnonzero(np.append(True, below[1:] != below[:-1]))
        if len(begins) == len(below):
            return
        lengths = np.diff(np.append(begins, len(below)))
        joined = np.flatnonzero(lengths > 1)
        self._close(begins, joined, below[begins[joined]] * (len(below) + 1) + lengths[joined], True)

    def _join_pairs(self, free: np.ndarray, turn: int) -> None:
        below = self.symbols[-1]
        bit = ((below.astype(np.uint64) + np.uint64(turn * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * _MIX) >> np.uint64(63) == 1
        one, other = bit & free, ~bit & free
        pair = one[:-1] & other[1:]
        back = other[:-1] & one[1:]
        if np.count_nonzero(back) > np.count_nonzero(pair):
            pair = back
        if not pair.any():
            return
        begins = np.flatnonzero(np.append(True, ~pair))
        joined = np.flatnonzero(np.append(pair, False)[begins])
        at = begins[joined]
        self._close(begins, joined, below[at] * self._next + below[at + 1], False)

    def _steps(self, level: int, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray | int:
        """How far two equal symbols may go on together on this level: to the end of the shorter block, else one."""
        if level >= len(self.blocks) or not self.blocks[level]:
            return 1
        first, up = self.first[level], self.parent[level]
        if forward:
            return np.minimum(first[up[x] + 1] - x, first[up[y] + 1] - y)
        return np.minimum(x - first[up[x]], y - first[up[y]]) + 1

    def agreement(self, a: np.ndarray, b: np.ndarray, forward: bool = True) -> np.ndarray:
        """Longest common extension of each pair of places: how many words agree from there on (or backwards), those at the places included."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        begin, way = x.copy(), 1 if forward else -1
        top = len(self.blocks)
        differ = np.zeros(len(x), np.int64)
        climbing = np.arange(len(x))
        for level in range(top + 1):
            live, risen = climbing, []
            while live.size:
                at_x, at_y = x[live], y[live]
                same = self.symbols[level][at_x] == self.symbols[level][at_y]
                differ[live[~same]] = level
                live, at_x, at_y = live[same], at_x[same], at_y[same]
                if level < top and live.size:
                    up, first = self.parent[level], self.first[level]
                    up_x, up_y = up[at_x], up[at_y]
                    edge = (first[up_x] == at_x) & (first[up_y] == at_y) if forward else (first[up_x + 1] - 1 == at_x) & (first[up_y + 1] - 1 == at_y)
                    rise = live[edge]
                    x[rise], y[rise] = up_x[edge], up_y[edge]
                    risen.append(rise)
                    live, at_x, at_y = live[~edge], at_x[~edge], at_y[~edge]
                step = self._steps(level, at_x, at_y, forward) * way
                x[live], y[live] = at_x + step, at_y + step
            climbing = np.concatenate(risen) if risen else climbing[:0]
        for level in range(top - 1, -1, -1):
            live = np.flatnonzero(differ > level)
            first = self.first[level]
            x[live], y[live] = (first[x[live]], first[y[live]]) if forward else (first[x[live] + 1] - 1, first[y[live] + 1] - 1)
            while live.size:
                at_x, at_y = x[live], y[live]
                same = self.symbols[level][at_x] == self.symbols[level][at_y]
                live, at_x, at_y = live[same], at_x[same], at_y[same]
                step = self._steps(level, at_x, at_y, forward) * way
                x[live], y[live] = at_x + step, at_y + step
        return np.abs(x - begin)


def _grid(offsets: np.ndarray, sizes: np.ndarray, low: int, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid points (place, period) of all documents for the periods from ``low`` to ``2 * low - 1``."""
    docs = np.flatnonzero(sizes >= np.maximum(least, exponent * low))
    counts = np.minimum(2 * low - 1, sizes[docs] // exponent) - low + 1
    docs = np.repeat(docs, counts)
    periods = low + _ranges(counts)
    points = (sizes[docs] - 2 * periods) // ((exponent - 2) * periods) + 1
    places = np.repeat(offsets[docs], points) + _ranges(points) * np.repeat((exponent - 2) * periods, points)
    return places, np.repeat(periods, points)


def find_runs(words: np.ndarray, sizes: np.ndarray, exponent: int = EXPONENT, least: int = LEAST_WORDS) -> tuple[np.ndarray, ...]:
    """All runs of documents whose word ids (from 0) follow each other in ``words``: document, start, length and smallest period, by document, start and period.

    A run is a stretch of at least ``max(least, exponent * period)`` words
    that no neighbouring word extends with its period; ``exponent`` is 3 or more.
    """
    if exponent < 3:
        raise ValueError("the grid needs an exponent of 3 or more")
    n_docs = len(sizes)
    offsets = np.cumsum(sizes) - sizes + np.arange(n_docs) + 1
    sequence = np.empty(len(words) + n_docs + 1, np.int64)
    is_word = np.ones(len(sequence), bool)
    bounds = np.append(offsets - 1, len(sequence) - 1)
    is_word[bounds] = False
    sequence[bounds] = np.arange(n_docs + 1)
    sequence[is_word] = words + n_docs + 1
    grammar = Grammar(sequence, n_docs + 1)
    covered_by = np.zeros(len(sequence), np.int32)
    covered_to = np.zeros(len(sequence), np.int64)
    found: list[np.ndarray] = []
    low, most = 1, int(sizes.max(initial=0)) // exponent
    while low <= most:
        at, period = _grid(offsets, sizes, low, exponent, least)
        for shift_of in (lambda p: 0, lambda p: p - 1, lambda p: p // 2):
            here = at + shift_of(period)
            same = sequence[here] == sequence[here + period]
            at, period = at[same], period[same]
        # Multiples of the period of a run already found there give the same run again.
        fresh = (covered_by[at] == 0) | (period % np.maximum(covered_by[at], 1) != 0) | (at + 2 * period > covered_to[at])
        at, period = at[fresh], period[fresh]
        ahead = grammar.agreement(at, at + period)
        whole = ahead >= period
        at, period, ahead = at[whole], period[whole], ahead[whole]
        behind = grammar.agreement(at - 1, at + period - 1, forward=False)
        start, length = at - behind, behind + ahead + period
        long = length >= np.maximum(least, exponent * period)
        runs = np.unique(np.stack([start[long], length[long], period[long]], axis=1), axis=0)
        for s, n, p in runs.tolist():
            covered_by[s : s + n], covered_to[s : s + n] = p, s + n
        found.append(runs)
        low *= 2
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    # The same stretch under several periods: its smallest comes first (the others are multiples of it).
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, (np.diff(runs[:, :2], axis=0) != 0).any(axis=1))] if len(runs) else runs
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    doc = np.searchsorted(offsets, runs[:, 0], side="right") - 1
    return doc, runs[:, 0] - offsets[doc], runs[:, 1], runs[:, 2]


def periodic_runs(
    df: DataFrame,
    exponent: int = EXPONENT,
    least: int = LEAST_WORDS,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document's periodic runs of words and its text with the repetitions cut.

    Returns one row per row of ``df``: doc_id, n_words, runs (start, length and
    smallest period in words, by start, then period), best (the run of greatest
    length / period; ties: smallest start, then period; null without a run) and
    text (words joined by one space, without those that any run holds after its
    first period).  ``rewrite`` may replace a document's words before the search.

    Null and empty texts have no words, no run and the empty text; repeated rows
    are handled row by row, null ids are carried along; other columns, whatever
    their names, never reach the operator.  A text of any length is one
    sequence: memory grows with the longest single text, not with the batch.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.Table.from_batches([_measure(part, exponent, least, rewrite) for part in slices(batch, GRAMMAR_BYTES)]).combine_chunks().to_batches()[0]

        return step

    return arrow_map(id_and_text(df, id_col, text_col), SCHEMA, make)


def _measure(batch: pa.RecordBatch, exponent: int, least: int, rewrite) -> pa.RecordBatch:
    ids = batch.column("doc_id").to_pylist()
    documents = [text.split() for text in byte_texts(batch)]
    if rewrite is not None:
        documents = [rewrite(i, words) for i, words in zip(ids, documents, strict=True)]
    sizes = np.array([len(words) for words in documents], np.int64)
    flat = pa.array([w for words in documents for w in words], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    doc, start, length, period = find_runs(flat.astype(np.int64), sizes, exponent, least)
    bounds = np.searchsorted(doc, np.arange(len(documents) + 1))
    best, texts = [], []
    for d, words in enumerate(documents):
        here = list(zip(*(column[bounds[d] : bounds[d + 1]].tolist() for column in (start, length, period)), strict=True))
        if not here:
            best.append(None)
            texts.append(b" ".join(words))
            continue
        s, n, p = max(here, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]))
        best.append({"start": s, "length": n, "period": p})
        keep = np.ones(len(words), bool)
        for s, n, p in here:
            keep[s + p : s + n] = False
        texts.append(b" ".join([words[i] for i in np.flatnonzero(keep).tolist()]))
    runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], fields=list(RUN_TYPE.value_type)))
    columns = [batch.column("doc_id"), pa.array(sizes), runs, pa.array(best, RUN_TYPE.value_type), pa.array(texts, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "best", "text"])
