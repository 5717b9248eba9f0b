"""Packing documents into windows of a fixed number of tokens, best fit decreasing.

Every document becomes its ids and an end id. Documents longer than a window are first cut into full windows and a
rest. The rests are dealt out into groups of about ``GROUP_PIECES`` pieces; inside a group the longest piece goes
first, into the open window with the least room that still holds it, which a segment tree over the remaining
capacities finds in a logarithmic number of steps. A group leaves one or two windows partly filled, so padding does
not depend on the size of the input.

Defined results: a missing or empty text is one piece that holds the end id alone. A missing doc_id is kept. Repeated
rows are packed as often as they occur. Other columns of the documents are ignored. An empty table packs to no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.tokens import by_size, encoder
from invoicelake.session import stage

WINDOW = 2048
END_ID = 1
GROUP_PIECES = 4096

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class CapacityTree:
    """Open windows by remaining capacity: a segment tree of counts, one leaf for each capacity."""

    def __init__(self, window: int):
        self.size = 1 << max(1, (window - 1).bit_length())
        self.count = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, capacity: int, change: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least capacity of at least ``need``, and that capacity."""
        node = need + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not self.count[node]:
                    node += 1
        capacity = node - self.size
        self._add(capacity, -1)
        return self.windows[capacity].pop(), capacity


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The window and the offset of each piece; ``lengths`` come in descending order, none above ``window``."""
    windows, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, opened = CapacityTree(window), 0
    for i, n in enumerate(lengths.tolist()):
        found = tree.take(n) if n < window else None
        if found is None:
            target, capacity = opened, window
            opened += 1
        else:
            target, capacity = found
        windows[i], offsets[i] = target, window - capacity
        if n < capacity:
            tree.put(capacity - n, target)
    return windows, offsets


def document_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
                    keep_ids: bool = False, cached_bytes: int | None = None) -> DataFrame:
    """Pieces of at most ``window`` ids; with ``keep_ids`` the ids themselves, as little-endian 32-bit numbers."""
    names = [part.split()[0] for part in PIECES.split(", ")] + ["ids"] * keep_ids
    end = np.array([end_id], "<u4").tobytes()
    types = [pa.int64()] * 5 + [pa.binary()] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer, True, cached_bytes)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in by_size(texts):
                rows = []
                for doc_id, ids in zip(doc_ids[lo:hi], code.encode(texts[lo:hi])):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start:4 * (start + window)]
                        row = (doc_id, start, len(piece) // 4, zlib.crc32(piece), total)
                        rows.append((*row, piece) if keep_ids else row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, PIECES + ", ids binary" * keep_ids)


def pack(pieces: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``sequence_id`` and ``offset`` for every piece; offsets have no gaps and start at 0 in each sequence.

    The pieces are stored once, numbered as they are written, and dealt out by that number: equal rows, however
    many, spread over the groups, and a repeated task deals them out the same way.
    """
    stored = stage(pieces.withColumn("__piece", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(stored.count() / group_pieces))
    columns = pieces.columns

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "__piece"], ascending=[False, True], kind="stable")
        windows, offsets = best_fit_decreasing(group["length"].to_numpy(), window)
        out = group[columns].copy()
        out["sequence_id"] = group["__group"].to_numpy() * np.int64(2 ** 32) + windows
        out["offset"] = offsets
        return out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return (
        stored.withColumn("__group", F.pmod(F.xxhash64("__piece"), F.lit(groups)))
        .groupBy("__group").applyInPandas(fill, f"{schema}, sequence_id long, `offset` long")
    )


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
                   cached_bytes: int | None = None) -> DataFrame:
    """``cached_bytes`` bounds what a Python worker remembers of the tokenizer's work."""
    return pack(document_pieces(docs, tokenizer, window, end_id, cached_bytes=cached_bytes), window)


def sequences(packed: DataFrame) -> DataFrame:
    """The windows themselves: ids of the pieces of a sequence (packed with ``keep_ids``) in order of their offset.
    A sequence holds at most ``window`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("pieces")).select(
        "sequence_id", F.aggregate("pieces", F.unhex(F.lit("")), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["length"]).alias("length"))
