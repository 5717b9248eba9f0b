import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from invoicelake.functions.ordering import (
    Cut, ntile_columns, ntile_ranks, rank_cuts, running_totals, top_rows)
from invoicelake.operators.rfm import rfm_scores, rfm_segments, segment_rollup
from invoicelake.operators.gold import customer_features
from conftest import SNAPSHOT


def table(spark, rng, n, values):
    ids = rng.sample(range(10 * n + 10), n)
    return spark.createDataFrame([(f"c{i}", float(values(rng))) for i in ids], "id string, v double").cache()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7, 11, 400])
@pytest.mark.parametrize("values", [
    lambda r: r.random(), lambda r: 1, lambda r: r.choice([1, 1, 1, 2, 9]), lambda r: -r.randrange(40)],
    ids=["distinct", "one", "hot", "days"])
def test_ntile_is_the_built_in_one(spark, rng, n, values):
    df = table(spark, rng, n, values)
    wanted = F.ntile(5).over(Window.orderBy("v", "id"))
    wrong = ntile_columns(df, {"b": F.col("v")}, "id").withColumn("w", wanted).filter("b <> w")
    assert wrong.count() == 0


@pytest.mark.parametrize("limit", [0, 40, 2000])
@pytest.mark.parametrize("values", [
    lambda r: r.random(), lambda r: r.choice([3, 3, 3, 3, 4, 5]), lambda r: 1.5],
    ids=["distinct", "hot", "one"])
def test_narrowing_finds_the_same_buckets(spark, rng, values, limit):
    df = table(spark, rng, 3000, values)
    cuts = rank_cuts(df, {"v": F.col("v")}, "id", ntile_ranks(5), ranked_directly=limit)["v"]
    bucket = sum((c.beyond(F.col("v"), F.col("id")).cast("int") for c in cuts), F.lit(1))
    wanted = F.ntile(5).over(Window.orderBy("v", "id"))
    assert df.select(bucket.alias("b"), wanted.alias("w")).filter("b <> w").count() == 0


@pytest.mark.parametrize("top", [0.0, 10.0 ** 6])
def test_a_value_most_rows_share_leaves_few_candidates(spark, monkeypatch, top):
    """One value holds 80 % of the rows, at either end; no more keys than the limit go to one task."""
    from invoicelake.functions import ordering
    rows = 40_000
    df = spark.range(rows).select(
        F.format_string("c%07d", "id").alias("id"),
        F.when(F.col("id") % 5 != 0, top).otherwise(F.pmod(F.xxhash64("id"), F.lit(9973)) + 1.0).alias("v")).cache()
    pick, sizes = ordering._pick, []

    def counted(data, searches, candidates, item):
        sizes.extend(data.filter(candidates(s)).select(item(s)).distinct().count() for s in searches.values())
        return pick(data, searches, candidates, item)

    monkeypatch.setattr(ordering, "_pick", counted)
    ranks = [1, 1000, 7999, 8000, 8001, 8500, 20_000, 32_000, 32_001, 36_000, rows]
    cuts = rank_cuts(df, {"v": F.col("v")}, "id", lambda n: ranks, ranked_directly=100 * len(ranks))["v"]
    assert sizes and max(sizes) <= 100
    order = [(r.v, r.id) for r in df.orderBy("v", "id").collect()]
    for rank, cut in zip(ranks, cuts):
        within = [x for x in order if x[0] < cut.value or x[0] == cut.value and (cut.tie is None or x[1] <= cut.tie)]
        assert len(within) == rank


def test_a_repeated_or_missing_tie_is_refused(spark):
    for tie in (None, "same"):
        df = spark.createDataFrame([(tie, 1.0)] * 50, "id string, v double")
        with pytest.raises(ValueError):
            rank_cuts(df, {"v": F.col("v")}, "id", ntile_ranks(5), ranked_directly=0)


def test_bucket_sizes_differ_by_one_at_most(spark, rng):
    df = ntile_columns(table(spark, rng, 1003, lambda r: r.randrange(4)), {"b": F.col("v")}, "id")
    sizes = [r["count"] for r in df.groupBy("b").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) == 1


def test_no_row_crosses_the_network_for_a_score(spark, rng):
    df = table(spark, rng, 100, lambda r: r.random())
    plan = ntile_columns(df, {"b": F.col("v")}, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_missing_values_come_first(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0)], "id string, v double")
    assert {r.id: r.b for r in ntile_columns(df, {"b": F.col("v")}, "id", 3).collect()} == {"b": 1, "a": 2, "c": 3}


def test_cut_without_tie_takes_the_whole_value():
    assert Cut(1.0) == Cut(1.0, None)


@pytest.mark.parametrize("share", [1, 10, 37, 100])
def test_top_rows(spark, rng, share):
    df = table(spark, rng, 100, lambda r: r.randrange(6))
    got = {r.id for r in top_rows(df, F.col("v"), "id", lambda n: share).collect()}
    wanted = {r.id for r in df.orderBy(F.desc("v"), "id").limit(share).collect()}
    assert got == wanted


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_running_totals(spark, rng, ranges):
    rows = [(g, float(v), rng.randrange(9)) for g in "xy" for v in rng.sample(range(500), 200)]
    rows.append(("x", None, 5))
    df = spark.createDataFrame(rows, "g string, v double, w long")
    naive = F.coalesce(F.sum("w").over(
        Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    got = running_totals(df, "g", "v", ["w"], ranges)
    assert got.count() == len(rows)
    assert got.join(df.withColumn("naive", naive).withColumnRenamed("v", "v2"),
                    ["g", "w"]).filter("v <=> v2 AND naive <> w_before").count() == 0


def test_rfm(silver):
    features = customer_features(silver, SNAPSHOT)
    rows = {r.customer_id: r for r in rfm_segments(features).collect()}
    assert set(rows) == {"a", "b"} and all(r.segment for r in rows.values())
    assert (rows["a"].r_score, rows["b"].r_score) == (2, 1)  # the most recent is best
    assert rfm_scores(features).count() == 2
    assert sum(r.customers for r in segment_rollup(rfm_segments(features)).collect()) == 2
