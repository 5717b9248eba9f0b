"""A stated query set against all rows, in blocks: the tiles of a query block and a candidate block, and heaps that
merge what the tiles found."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.session import stage

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 1024

Found = tuple[np.ndarray, np.ndarray, np.ndarray]   # positions of queries and candidates, scores


def finite_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id`` and the vector as doubles ``v`` of ``dim`` components, without vectors that are missing or hold a
    missing or non-finite component, and without rows whose vec_id is missing, which no result could name."""
    v = F.col(vector).cast("array<double>")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", number)).withColumn("dim", F.size("v"))


def search_tiles(vectors: DataFrame, is_query: Column, search: Callable[[np.ndarray, np.ndarray, np.ndarray], Found],
                 score_type: str, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``query_id``, ``vec_id``, ``score`` of what ``search`` finds in every tile.

    ``search(queries, candidates, same)`` gets two matrices and says which pairs it kept; ``same`` marks pairs of one
    vec_id, and candidates come in the order of their vec_ids. Only vectors of equal length meet. A vec_id that
    repeats is one query, by its smallest vector.
    """
    stored = stage(vectors.withColumn("is_query", is_query), "vectors")
    counts = stored.agg(F.count("*"), F.count_if("is_query")).first()
    blocks = [max(1, math.ceil(n / size)) for n, size in zip(counts, (candidate_block, query_block))]
    number = F.monotonically_increasing_id()
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # columns of their own: with attributes that both sides share, Spark prunes what the tiles need
    candidates = stored.select(*[F.col(c).alias(c) for c in ("vec_id", "v", "dim")], number.alias("row")).select(
        "vec_id", "v", "dim", block(blocks[0]).alias("cb"), other(blocks[1]).alias("qb"))
    queries = (
        stored.filter("is_query").groupBy("vec_id").agg(F.min("v").alias("v")).select(
            "vec_id", "v", F.size("v").alias("dim"), F.col("vec_id").alias("row"))
        .select("vec_id", "v", "dim", block(blocks[1]).alias("qb"), other(blocks[0]).alias("cb")))

    def tile(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        c = c.sort_values("vec_id", kind="stable")
        q_ids, c_ids = q["vec_id"].to_numpy(), c["vec_id"].to_numpy()
        kept_q, kept_c, score = search(np.stack(q["v"]), np.stack(c["v"]), q_ids[:, None] == c_ids)
        return pd.DataFrame({"query_id": q_ids[kept_q], "vec_id": c_ids[kept_c], "score": score})

    keys = ["dim", "qb", "cb"]
    return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(
        tile, f"query_id long, vec_id long, score {score_type}")


def merge_by_heaps(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query with their rank; ties go to the smaller vec_id. One heap is open at a time."""
    score_type = found.schema["score"].dataType.simpleString()
    arrow = {"double": pa.float64(), "bigint": pa.int64()}[score_type]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap, out = None, [], []

        def close() -> None:
            best = sorted(heap, reverse=True)
            out.extend((query, rank, -neg, score) for rank, (score, neg) in enumerate(best, 1))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 4
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), arrow))],
                names=["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for q, v, s in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if q != query:
                    close()
                    query, heap = q, []
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                elif (s, -v) > heap[0]:
                    heapq.heapreplace(heap, (s, -v))
            yield flush()
        close()
        yield flush()

    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(
        merge, f"query_id long, rank int, vec_id long, score {score_type}")


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """Per row; minus infinity where the row is shorter."""
    n = values.shape[1]
    return np.partition(values, n - k, axis=1)[:, n - k] if n >= k else np.full(len(values), -np.inf)


def row_batches(counts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose counts sum to about ``limit``."""
    begin = total = 0
    for i, n in enumerate(counts.tolist()):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(counts):
        yield begin, len(counts)


def best_of_rows(rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, k: int) -> Found:
    """The ``k`` best of each row; ties go to the smaller column."""
    falling = ~scores if scores.dtype.kind == "i" else -scores      # the least long has no negative
    order = np.lexsort((columns, falling, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    return rows[keep], columns[keep], scores[keep]
