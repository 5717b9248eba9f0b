"""The registered queries of this subpackage and the SQL that checks those SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake.llm import (
    language, mixing, neardup, neighbours, packing, pii, prefix_trie, repair, secrets, sharding, token_counts, token_files,
    topk)


def reach_workers(spark: SparkSession) -> None:
    """Python workers that start from now on find this package where the driver found it."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot")


def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents"))


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "class_id", F.lower(F.hex("label")).alias("class_key"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(table(spark, folder, "conversations")))


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.summaries(repair.repair(repair.damage(table(spark, folder, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_packing, op2_mixing, op3_nearest_neighbours, op4_token_counts, op5_exact_top_k, op6_token_files,
        op7_secrets, op8_personal_data, op9_language, op10_near_duplicates, op11_prefix_trie, op12_sharding,
        op13_conversation_repair)}

ORACLES: dict[str, str] = {
    "op2_mixing": """
        WITH d AS (
          SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
          FROM documents
        ), s AS (
          SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                 CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                   WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
          FROM d GROUP BY source
        ), l AS (
          SELECT *, 2.0 * source_size AS most, (1.5 * sum(source_size) OVER ()
                   - coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM s
        ), t AS (
          SELECT source, source_size, least(most::DOUBLE, (SELECT max(level::DOUBLE) FROM l WHERE most / weight >= level) * weight) AS target
          FROM l
        ), p AS (
          SELECT doc_id, source, size, source_size, target, least(round(target), 2 * source_size) AS quota,
                 coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
          FROM d JOIN t USING (source)
        ), q AS (
          SELECT source, CAST(least(round(target), 2 * source_size) AS BIGINT) AS quota,
                 CAST(ceil(least(round(target), 2 * source_size) / 512) AS BIGINT) AS blocks FROM t
        ), h AS (
          SELECT source, quota, blocks, (sum(quota) OVER w - quota) / sum(quota) OVER () AS low,
                 sum(quota) OVER w / sum(quota) OVER () AS high
          FROM q WHERE quota > 0 WINDOW w AS (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING)
        ), i AS (
          SELECT range AS slot, CAST((CAST(range AS HUGEINT) * 2654435769) % 4294967296 AS DOUBLE) / 4294967296 AS u
          FROM range(CAST((SELECT coalesce(sum(blocks), 0) FROM h) AS BIGINT))
        ), r AS (
          SELECT slot, source, blocks, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS block
          FROM i JOIN h ON u >= low AND u < high
        ), a AS (
          SELECT source, unnest(range(blocks)) AS block FROM h
        ), x AS (
          SELECT source, block, row_number() OVER (ORDER BY source NULLS LAST, block) AS k
          FROM a WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.source IS NOT DISTINCT FROM a.source AND r.block = a.block)
        ), y AS (
          SELECT slot, row_number() OVER (ORDER BY slot) AS k FROM r WHERE block >= blocks
        ), slots AS (
          SELECT slot, source, block FROM r WHERE block < blocks UNION ALL SELECT slot, source, block FROM x JOIN y USING (k)
        ), b AS (
          SELECT source, pos, unnest(range(CAST(begin_ // 512 AS BIGINT), CAST((end_ - 1) // 512 + 1 AS BIGINT))) AS block
          FROM (SELECT source, pos, CAST(pos + run * source_size AS BIGINT) AS begin_,
                       CAST(least(pos + run * source_size + size, quota) AS BIGINT) AS end_
                FROM p, (VALUES (0), (1)) AS runs(run) WHERE size > 0) WHERE end_ > begin_
        ), f AS (
          SELECT b.source AS of, b.pos AS at, min(slot) AS first_slot
          FROM b JOIN slots ON slots.source IS NOT DISTINCT FROM b.source AND slots.block = b.block GROUP BY ALL
        ) SELECT doc_id, size, source_size, target,
                 CAST(greatest(0, least(pos + size, quota) - pos)
                    + greatest(0, least(pos + source_size + size, quota) - pos - source_size) AS BIGINT) AS taken, first_slot
          FROM p LEFT JOIN f ON p.source IS NOT DISTINCT FROM f.of AND p.pos = f.at AND p.size > 0""",
    "op5_exact_top_k": """
        WITH v AS (
          SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
          FROM embeddings
          WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ), r AS (
          SELECT query_id, vec_id, score,
                 CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
          FROM s
        ) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
