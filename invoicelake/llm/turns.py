"""Turns of conversations in order, however long a conversation is.

Equal turns are counted first, then all turns are sorted over the cluster by conversation and turn, so a conversation
with a third of all rows is spread over many ranges. Inside a range its turns are handed on block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 128
BLOCK_BYTES = 1 << 20

KEYS = ("conv_id", "turn", "role", "text")


def in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies, sorted by these; missing values come first. ``rows`` brings copies itself."""
    counted = rows.groupBy(*KEYS).agg(F.sum("copies").cast("long").alias("copies"))
    return counted.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int, bool, list[tuple]]]:
    """Conversation, number of the block (ascending over all ranges), whether the block is the whole conversation
    (False also where that cannot be known at the ends of a range), and its rows (turn, role, text, copies)."""
    number, size, rows = TaskContext.get().partitionId() << 32, 0, []
    current, whole, began = None, False, False
    for batch in batches:
        for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
            new = began and conv != current
            if new or len(rows) >= BLOCK_ROWS or size > BLOCK_BYTES:
                yield current, number, whole and new, rows
                number, size, rows = number + 1, 0, []
                whole = new
            current, began = conv, True
            rows.append(row)
            size += len(row[2])
    if began:
        yield current, number, False, rows
