"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from invoicelake.llm import language, mixing, neardup, packing, pii
from invoicelake.llm.queries import reach_workers
from invoicelake.session import stage

ENCODER_BYTES = 50_000_000   # half of what packing alone remembers: workers keep it through the stages that follow


def small_batches(spark: SparkSession) -> None:
    """Bounds what Python workers are sent at once: 10,000 texts, Spark's bound, lie in an executor's memory several times.

    The setting stays, as the frames of the stages are run by the caller."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", neardup.BYTES_AT_ONCE)


def identify(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops the documents that are in no language: without text or without a letter."""
    small_batches(spark)
    return language.keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each class of near duplicates."""
    return neardup.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Puts the kind of personal data in its place."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Takes each document as often as the target of its source asks for, at most twice, to the word."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Cuts and packs the documents into windows; one row per piece."""
    small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), cached_bytes=ENCODER_BYTES)


STAGES = [
    ("language", identify), ("near_duplicates", deduplicate), ("personal_data", redact), ("mixing", mix),
    ("packing", pack),
]

ORACLE_SQL = None  # the language model, the samples and the tokenizer are out of reach of SQL


def run(spark: SparkSession, folder: str) -> DataFrame:
    reach_workers(spark)
    docs = spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
