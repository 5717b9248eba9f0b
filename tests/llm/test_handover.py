"""What the operators leave on disk while they run, and what is sent to a Python worker at once."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from invoicelake import session
from invoicelake.llm import neardup


def staged(spark):
    folder = Path(session.shared_folder(spark).removeprefix("file:")) / "staged" / spark.sparkContext.applicationId
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def shuffles(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for d in dirs for p in Path(d).rglob("shuffle_*")}


@pytest.fixture()
def docs(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(60)) for _ in range(40)]
    near = [t + " and a few more" for t in texts[:10]]
    return spark.createDataFrame(list(enumerate(texts + near)), "doc_id long, text string")


def test_a_staged_table_leaves_no_shuffle_behind(spark):
    before, key = shuffles(spark), spark.conf.get(session.SHUFFLE_CLEANUP)
    df = session.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):         # the files are deleted by a thread of their own
        if shuffles(spark) <= before:
            break
        spark.range(1).count()
    assert shuffles(spark) <= before and spark.conf.get(session.SHUFFLE_CLEANUP) == key
    assert df.agg(F.sum("count")).first()[0] == 1000


def test_passing_tables_go_also_after_a_failure(spark):
    before = staged(spark)
    with pytest.raises(ValueError), session.passing(spark):
        kept = session.stage(spark.range(3), "kept", keep=True)
        session.stage(spark.range(3), "passing")
        raise ValueError
    assert [n.split("-")[0] for n in staged(spark) - before] == ["kept"] and kept.count() == 3


def test_near_duplicates_leave_the_classes_alone_on_disk(spark, docs):
    before = staged(spark)
    found = neardup.near_duplicates(docs)
    assert {n.split("-")[0] for n in staged(spark) - before} == {"classes"}
    assert {r.doc_id: r.class_id for r in found.collect()} == {i: i if i < 40 else i - 40 for i in range(50)}


def test_batches_to_workers_are_bounded_in_bytes(spark, docs, monkeypatch):
    key, seen, whole = "spark.sql.execution.arrow.maxBytesPerBatch", [], neardup.document_frequencies
    before = spark.conf.get(key)
    monkeypatch.setattr(neardup, "document_frequencies", lambda d: (seen.append(spark.conf.get(key)), whole(d))[1])
    neardup.near_duplicates(docs)
    assert seen == [neardup.BYTES_AT_ONCE] and spark.conf.get(key) == before


def test_stages_that_the_caller_runs_get_bounded_batches(spark, docs):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        stages = dict(corpus_pipeline.STAGES)
        for name in ("language", "packing"):
            spark.conf.set(key, before)
            stages[name](spark, docs.withColumns({"lang": F.lit("en"), "source": F.lit("a")}), "")
            assert spark.conf.get(key) == neardup.BYTES_AT_ONCE
    finally:
        spark.conf.set(key, before)


def test_what_common_shingles_settle_is_what_all_document_frequencies_say():
    rng, states = np.random.default_rng(8), []
    pool = np.sort(rng.integers(0, 2 ** 63, 300, dtype=np.uint64))
    common = rng.random(300) < 0.3
    for _ in range(400):
        factor = np.where(common, rng.uniform(1, 1.2), rng.uniform(1.2, 1.5, 300))
        a = rng.random(300) < 0.8
        b = a ^ (rng.random(300) < rng.uniform(0, 0.4))
        counts = [rng.choice([1, 1, 1, 3], 300) for _ in range(2)]
        counts[1] = np.where(rng.random(300) < 0.9, counts[0], counts[1])
        exact, rough = [], []
        for has, n in zip((a, b), counts):
            exact.append(neardup.to_bytes((pool[has], (n * factor)[has])))
            rough.append(neardup.to_bytes((pool[has], np.where(common, n * factor, -n)[has])))
        found = neardup.settled(*rough, 1.2, 1.5)
        links = neardup.Vector(exact[0]).links(neardup.Vector(exact[1]))
        assert found is None or found == links
        states.append(found)
    assert {True, False, None} == set(states)


def test_exact_weights_are_looked_up_for_unsettled_contents_only(spark, docs, monkeypatch):
    seen, whole = [], neardup._exact
    monkeypatch.setattr(neardup, "_exact", lambda counted, *rest: (seen.append(counted.count()), whole(counted, *rest))[1])
    neardup.near_duplicates(docs)
    assert seen == [0]          # ten links of plain similarity above 0.9
