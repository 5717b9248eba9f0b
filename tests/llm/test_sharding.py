"""Shards along the Hilbert curve: the law, the contents, and what a reader can leave out."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoicelake.llm import sharding
from invoicelake.llm.queries import op12_sharding, reach_workers

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("place", T.StringType())])


@pytest.fixture(autouse=True, scope="module")
def workers(spark):
    reach_workers(spark)


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_goes_through_neighbours(dimensions, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dimensions))).T
    place = sharding.hilbert_index(points, bits)
    assert sorted(place) == list(range(points.shape[1]))
    steps = np.abs(np.diff(points[:, np.argsort(place)], axis=1))
    assert (steps.sum(axis=0) == 1).all()


def rows(n=1500):
    chance = random.Random(2)
    out = [(chance.choice([None, i, i]), "é" * chance.randint(0, 40) if chance.random() < 0.9 else None,
            chance.choice(["de", "en", "", None]), f"src{chance.randint(0, 30)}", "x", "y") for i in range(n)]
    return out + [(7, "the same", "en", "src1", "x", "y")] * (n // 2) + [(None, None, None, None, None, None)] * 5


def test_law_rows(spark, tmp_path):
    wanted = rows()
    spark.createDataFrame(wanted, DOCUMENTS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = op12_sharding(spark, str(tmp_path)).collect()
    texts = [(r[0], (r[1] or "").encode()) for r in wanted]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len(t) + 8, zlib.crc32(t)) for i, t in texts)
    slots = {}
    for r in found:
        assert r.law == "rows" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    in_order = [r.curve for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert in_order == sorted(in_order)


def test_hot_copies_are_dealt_over_shards(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "same", "en", "a", "x", "y")], DOCUMENTS)
    many = docs.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(25_003)))).drop("n")
    found = sharding.shard_documents(many, 4).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last")).collect()
    assert sorted((r.shard, r.n, r.last) for r in found) == [(0, 6251, 6250), (1, 6251, 6250), (2, 6251, 6250), (3, 6250, 6249)]


def test_fewer_documents_than_shards(spark):
    docs = spark.createDataFrame(rows()[:3], DOCUMENTS)
    found = sharding.shard_documents(docs).collect()
    assert len({r.shard for r in found}) == 3 and {r.slot for r in found} == {0}
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_written_shards_hold_all_documents_and_are_left_out(spark, tmp_path):
    docs = spark.createDataFrame(rows(), DOCUMENTS)
    path = f"{tmp_path}/shards"
    manifest = sharding.write_shards(docs, path).collect()
    assert len(manifest) == 24 and sum(r.rows for r in manifest) == docs.count()
    back = spark.read.parquet(path)
    columns = DOCUMENTS.fieldNames()
    assert Counter(map(tuple, back.select(columns).collect())) == Counter(map(tuple, docs.collect()))
    for name, low, high in (("doc_id", 200, 250), ("size", None, 12), ("lang", "en", "en"), ("source", "src5", None)):
        value = F.col("doc_id") if name == "doc_id" else F.coalesce(F.octet_length("text"), F.lit(0)) + 8 if name == "size" else F.col(name)
        wanted = docs.filter((value >= low) if low is not None else F.lit(True)).filter(
            (value <= high) if high is not None else F.lit(True)).filter(value.isNotNull())
        assert sharding.read_shards(spark, path, name, low, high).count() == wanted.count()
    ids = [r for r in manifest if r.max_doc_id is not None and r.max_doc_id >= 200 and r.min_doc_id <= 250]
    assert len(ids) < 20     # the rest need not be read
