"""Exact top-k search by inner product over an impact-ordered index, score at a time.

A block of vectors of whole numbers is indexed by posting segments: all components whose magnitude has the same
number of binary digits, the segment's quantised impact. Segments are processed by descending impact for all queries
of a tile; what a vector still holds in the segments to come bounds the rest of its score (Cauchy-Schwarz). A query
stops only when that proves that no vector outside a few possible members can be among its best; those members are
scored exactly in whole numbers.

Defined results: vectors that are missing or hold missing or non-finite components take no part, nor do rows without a
vec_id. Components of any size count in full (64 times a component beyond the range of a double is the largest double);
a score that does not fit a long counts as the nearest long. Vectors of different length never meet; empty ones
score 0. A row never finds a row of its own vec_id; otherwise repeated rows are candidates of their own. Ties go to
the smaller vec_id. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.tiles import (
    Found, best_of_rows, finite_vectors, kth_largest, merge_by_heaps, row_batches, search_tiles)

SCALE = 64
LARGEST = np.finfo(np.float64).max
LONG = np.iinfo(np.int64)
FEW = 4               # a query is scored exactly once at most this many times k vectors are possible
EXACT_VALUES = 4_000_000


class ImpactIndex:
    """Posting segments of a block, in descending impact: vector positions, components and values."""

    def __init__(self, values: np.ndarray):
        self.shape = values.shape
        impact = np.frexp(np.abs(values))[1]          # binary digits of a whole number
        impact[values == 0] = 0
        vectors, parts = np.nonzero(impact)
        level = impact[vectors, parts]
        order = np.argsort(-level, kind="stable")
        self.vectors, self.parts = vectors[order], parts[order]
        self.values = values[self.vectors, self.parts]
        self.levels, self.begins = np.unique(-level[order], return_index=True)

    def segments(self):
        """Vector positions, components, values of one impact after the other."""
        ends = np.append(self.begins[1:], len(self.values))
        for lo, hi in zip(self.begins, ends):
            yield self.vectors[lo:hi], self.parts[lo:hi], self.values[lo:hi]


def whole_numbers(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * SCALE), -LARGEST, LARGEST)


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, in longs where every sum fits, otherwise in
    Python's whole numbers."""
    with np.errstate(over="ignore"):
        wide = np.abs(q).max(axis=1, initial=0) * np.abs(c).max(axis=1, initial=0) * q.shape[1] >= 2.0 ** 62
    scores = np.zeros(len(q), np.int64)
    narrow = np.flatnonzero(~wide)
    # a component beyond a long meets zeros alone here
    limited = lambda x: np.clip(x[narrow], -2.0 ** 62, 2.0 ** 62).astype(np.int64)
    scores[narrow] = (limited(q) * limited(c)).sum(axis=1)
    for i in np.flatnonzero(wide):
        score = sum(int(a) * int(b) for a, b in zip(q[i].tolist(), c[i].tolist()))
        scores[i] = min(max(score, LONG.min), LONG.max)
    return scores


def best_in_tile(queries: np.ndarray, candidates: np.ndarray, same: np.ndarray, k: int) -> Found:
    q, c = whole_numbers(queries), whole_numbers(candidates)
    n = len(c)
    q_top, c_top = np.abs(q).max(axis=1, initial=0), np.abs(c).max(initial=0)
    with np.errstate(over="ignore"):
        exact32 = q_top.max(initial=0) * c_top * max(1, q.shape[1]) < 2 ** 24
    number = np.float32 if exact32 else np.float64
    score = np.zeros((len(q), n), number)
    # wide numbers are searched by parts of their largest, which changes no order among a query's scores
    shift = 0 if exact32 else -np.frexp(c_top)[1]
    shifts = np.zeros(len(q), int) if exact32 else -np.frexp(q_top)[1]
    scaled = np.ldexp(q, shifts[:, None])
    longest = np.ldexp(2.0 ** 63, shifts + shift)[:, None]     # scores beyond it are equal
    rest = (np.ldexp(c, shift) ** 2).sum(axis=1)
    q_norm = np.sqrt((scaled * scaled).sum(axis=1))
    # sums in floating point are off by less than these; none are where single precision holds every sum
    slack = q_norm[:, None] * (0.0 if exact32 else 1e-9 * np.sqrt(rest.max(initial=0)))
    rounding = 0.0 if exact32 else 1e-12 * rest.max(initial=0)
    open_, parts = np.arange(len(q)), []

    def stop(last: bool) -> None:
        nonlocal open_
        if not len(open_):
            return
        error = slack[open_] if last else q_norm[open_, None] * np.sqrt(rest + rounding) + slack[open_]
        now = score[open_].astype(np.float64)
        now[same[open_]] = -np.inf
        least = np.minimum(kth_largest(now - error, k)[:, None], longest[open_])
        least[least < -longest[open_]] = -np.inf
        possible = (now + error >= least) & ~same[open_]
        counts = possible.sum(axis=1)
        done = np.flatnonzero((counts <= FEW * k) | last)
        for lo, hi in row_batches(counts[done], max(1, EXACT_VALUES // max(1, q.shape[1]))):
            i, j = np.nonzero(possible[done[lo:hi]])
            step = max(1, EXACT_VALUES // max(1, q.shape[1]))
            for at in range(0, len(i), step):
                a, b = open_[done[lo:hi][i[at:at + step]]], j[at:at + step]
                parts.append(best_of_rows(a, b, exact_scores(q[a], c[b]), k))
        open_ = np.delete(open_, done)

    for vectors, columns, values in ImpactIndex(c).segments():
        if not len(open_):
            break
        values = np.ldexp(values, shift)
        held, used = np.unique(vectors), np.unique(columns)
        segment = np.zeros(c.shape, number)
        segment[vectors, columns] = values
        if 2 * len(held) * len(used) > c.size:
            score[open_] += scaled[open_].astype(number) @ segment.T
        else:
            score[np.ix_(open_, held)] += scaled[np.ix_(open_, used)].astype(number) @ segment[np.ix_(held, used)].T
        rest = np.maximum(rest - np.bincount(vectors, values * values, minlength=n), 0)
        stop(False)
    rest = np.zeros(n)
    stop(True)
    if not parts:
        return np.empty(0, int), np.empty(0, int), np.empty(0, np.int64)
    return best_of_rows(*(np.concatenate(x) for x in zip(*parts)), k)


def top_k(rows: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a condition on ``vec_id``."""
    found = search_tiles(finite_vectors(rows, vec_id, vector), is_query,
                         lambda q, c, same: best_in_tile(q, c, same, k), "long")
    return merge_by_heaps(found, k)
