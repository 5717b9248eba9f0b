"""Nearest neighbours by cosine: a block matrix join over int8 product tiles.

In a tile, unit vectors are rounded to int8 with a scale of their own. The integer product of two codes gives the
cosine up to a bound that follows from the norms of what rounding dropped (Cauchy-Schwarz), so every pair that may be
among the nearest survives; the survivors are computed again in double precision from the original vectors. Heaps
merge the tiles. The result is exact.

Defined results: vectors that are missing, zero, or hold missing or non-finite components take no part, nor do rows
without a vec_id. Vectors of
different length never meet. A row never finds a row of its own vec_id; otherwise repeated rows are candidates of
their own. Ties go to the smaller vec_id. Fewer candidates than ``k`` are all returned. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.tiles import (
    Found, best_of_rows, finite_vectors, kth_largest, merge_by_heaps, row_batches, search_tiles)

SLACK = 1e-9          # above the rounding of double arithmetic in the bounds
EXACT_VALUES = 4_000_000


def int8_codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, norms of the decoded vectors, norms of the rests."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(unit - decoded, axis=1)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def nearest_in_tile(queries: np.ndarray, candidates: np.ndarray, same: np.ndarray, k: int) -> Found:
    # a power of two, so that scaling changes no digit and no square overflows
    q = np.ldexp(queries, -np.frexp(np.abs(queries).max(axis=1, keepdims=True))[1])
    c = np.ldexp(candidates, -np.frexp(np.abs(candidates).max(axis=1, keepdims=True))[1])
    q_norm, c_norm = _norms(q), _norms(c)
    q_codes, q_scale, q_len, q_rest = int8_codes(q / q_norm[:, None])
    c_codes, c_scale, _, c_rest = int8_codes(c / c_norm[:, None])
    # products of int8 sum up exactly in single precision up to 1,040 components
    number = np.float32 if q.shape[1] <= 1040 else np.float64
    about = (q_codes.astype(number) @ c_codes.astype(number).T) * (q_scale[:, None] * c_scale)
    error = q_len[:, None] * c_rest + q_rest[:, None] + SLACK
    least = np.where(same, -np.inf, about - error)
    survives = (about + error >= kth_largest(least, k)[:, None]) & ~same
    parts = []
    for lo, hi in row_batches(survives.sum(axis=1), max(1, EXACT_VALUES // q.shape[1])):
        i, j = np.nonzero(survives[lo:hi])
        for at in range(0, len(i), EXACT_VALUES // q.shape[1] or 1):
            a, b = i[at:at + EXACT_VALUES // q.shape[1]] + lo, j[at:at + EXACT_VALUES // q.shape[1]]
            parts.append(best_of_rows(a, b, (q[a] * c[b]).sum(axis=1) / (q_norm[a] * c_norm[b]), k))
    if not parts:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return best_of_rows(*(np.concatenate(x) for x in zip(*parts)), k)


def nearest_neighbours(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id",
                       vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a condition on ``vec_id``."""
    vectors = finite_vectors(rows, vec_id, vector).filter(F.exists("v", lambda x: x != 0))
    found = search_tiles(vectors, is_query, lambda q, c, same: nearest_in_tile(q, c, same, k), "double")
    return merge_by_heaps(found, k)
