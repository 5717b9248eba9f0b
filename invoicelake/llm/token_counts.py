"""Number of tokens of every whole text, by a public tokenizer; the ids never leave the task.

Texts reach the library in batches balanced by size, and long texts in segments cut where the tokenizer always cuts.

Defined results: a missing or empty text has 0 bytes and 0 tokens. Missing doc_ids, repeated rows and other columns
do no harm; each row gives one row. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.tokens import by_size, encoder

LIMIT = 512


def token_counts(docs: DataFrame, tokenizer: str, drops_space: bool = False, limit: int = LIMIT) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer, drops_space)
        for batch in batches:
            texts, counts = batch.column(1).to_pylist(), []
            for lo, hi in by_size(texts):
                counts += [len(ids) // 4 for ids in code.encode(texts[lo:hi])]
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(batch.column(1)), pa.int64()), 0)
            n_tokens = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, n_tokens, pc.greater(n_tokens, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
