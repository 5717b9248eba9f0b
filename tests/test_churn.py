import math
import threading

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from invoicelake.operators import churn, tree_scoring
from invoicelake.schema import FEATURES
from invoicelake.session import cache_memory


@pytest.fixture(scope="module")
def snapshot(spark):
    """Churn depends on the order count, and recency says nothing about it."""
    df = spark.range(400).select(
        F.format_string("k%03d", F.col("id")).alias("customer_id"),
        *[((F.col("id") * (7 + 2 * i)) % 11).cast("double").alias(f) for i, f in enumerate(FEATURES)],
    ).withColumn("cancel_rate", F.when(F.col("customer_id") > "k100", F.col("cancel_rate")))
    return df.withColumn("churned", (F.col("frequency") < 5).cast("int")).cache()


@pytest.fixture(scope="module")
def model(snapshot):
    return churn.train(snapshot, rounds=3)


def test_probability_and_expected_loss(model, snapshot):
    scored = churn.score(model, snapshot, "run-1")
    row = scored.agg(
        F.min("churn_probability").alias("lo"), F.max("churn_probability").alias("hi"),
        F.max(F.abs(F.col("revenue_at_risk") - F.col("churn_probability") * F.col("revenue_365d"))).alias("off"),
    ).first()
    assert 0 <= row.lo < row.hi <= 1 and row.off <= 0.01
    assert scored.filter("model_run_id = 'run-1'").count() == 400
    assert scored.filter("cancel_rate IS NULL").count() > 0  # scoring leaves the features as they are


def test_negative_spend_is_no_risk(spark):
    row = spark.createDataFrame([(-5.0,)], "revenue_365d double").select(*churn.at_risk(F.lit(0.123456))).first()
    assert (row.churn_probability, row.revenue_at_risk) == (0.1235, 0.0)


def test_model_that_ranks_is_publishable(model, snapshot):
    metrics = churn.evaluate(model, snapshot)
    assert metrics["auc"] > 0.95 and metrics["customers"] == 400
    assert metrics["precision_top_decile"] == 1.0
    assert 0.3 < metrics["churn_base_rate"] < 0.6
    churn.require_publishable(metrics)


def test_model_without_a_signal_is_refused(snapshot):
    noise = snapshot.withColumn("churned", F.when(F.col("recency_days") > 4, 1).otherwise(0))
    blind = churn.train(noise.withColumn("churned", (F.col("tenure_days") > 5).cast("int")), rounds=2)
    metrics = churn.evaluate(blind, noise)
    assert metrics["baseline_recency_auc"] == 1.0
    with pytest.raises(churn.PublishRefused):
        churn.require_publishable(metrics)


def test_rank_auc_is_the_evaluators(spark, rng):
    rows = [(rng.choice([0.1, 0.4, 0.4, 0.9, rng.random()]), rng.randrange(2)) for _ in range(700)]
    df = spark.createDataFrame(rows, "p double, churned int")
    theirs = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0).evaluate(
        df.withColumn("y", F.col("churned").cast("double")))
    row = churn.rank_auc(df, "p").first()
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    exact = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert row.customers == 700 and abs(row.auc - exact) < 1e-12 and abs(theirs - exact) < 1e-9


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "p double, churned int")
    assert churn.rank_auc(df, "p").first().auc is None


def test_top_decile_has_at_least_one_customer(snapshot):
    few = snapshot.limit(4)
    assert churn.top_decile(few).count() == 1
    assert churn.top_decile_precision(snapshot).first().customers == 40


def test_saved_model_scores_the_same(model, snapshot, tmp_path):
    churn.save_model(model, str(tmp_path / "model"))
    loaded = churn.load_model(str(tmp_path / "model"))
    assert churn.score(loaded, snapshot).exceptAll(churn.score(model, snapshot)).count() == 0


def test_run_record(spark, snapshot):
    row = churn.run_record(snapshot, "r", churn.model_params(), {"auc": 0.123456}).first()
    assert row.params["max_iter"] == "300" and row.metrics == {"auc": 0.1235} and row.created_by


def test_rates_price_customers_without_a_model(snapshot):
    rates = churn.churn_rate_by_recency(snapshot).collect()
    assert {r.r_score for r in rates} == {1, 2, 3, 4, 5} and all(0 <= r.p <= 1 for r in rates)


def test_column_expressions_score_as_the_fitted_pipeline(model, snapshot):
    odd = snapshot.limit(6).withColumns({
        f: F.when(F.col("customer_id") == "k002", F.lit(1e300)).when(F.col("customer_id") == "k003", F.lit(float("-inf"))).otherwise(F.col(f)) for f in FEATURES})
    rows = snapshot.unionByName(odd)
    check = churn.scoring_check(model, rows).first()
    assert (check.customers, check.apart) == (406, 0)
    # the fitted pipeline refuses a row with NaN; as an expression it is above every threshold
    nan, high = (churn.probabilities(model, snapshot.limit(1).withColumns({f: F.lit(v) for f in FEATURES})).first().p
                 for v in (float("nan"), float("inf")))
    assert nan == high
    plan = churn.probabilities(model, rows)._jdf.queryExecution().toString()
    assert "UDF" not in plan and "vector" not in plan.lower()


def test_a_clashing_column_keeps_its_place(model, snapshot):
    extra = snapshot.withColumn("a.b", F.lit(1))
    assert churn.probabilities(model, extra).columns == [*extra.columns, "p"]


def test_node_table_scores_by_hand(model, snapshot):
    trees = {}
    for tree, node, feature, threshold, left, right, prediction in tree_scoring.node_table(model.stages[-1], FEATURES):
        trees.setdefault(tree, {})[node] = (feature, threshold, left, right, prediction)
    assert len(trees) == 3
    for row in churn.probabilities(model, snapshot).limit(50).collect():
        raw = 0.0
        for (number, nodes), weight in zip(sorted(trees.items()), model.stages[-1].treeWeights):
            at = 0
            while nodes[at][4] is None:
                at = nodes[at][2] if (row[nodes[at][0]] or 0.0) <= nodes[at][1] else nodes[at][3]
            raw += weight * nodes[at][4]
        assert abs(row.p - 1 / (1 + math.exp(-2 * raw))) < 1e-12


def test_a_fit_has_few_tasks_however_many_files_its_snapshot_has(spark, snapshot, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    scattered = snapshot.repartition(40)
    few = churn.packed(scattered)
    assert few.rdd.getNumPartitions() == cores
    assert few.exceptAll(snapshot).count() == snapshot.exceptAll(few).count() == 0
    monkeypatch.setattr(churn, "ROWS_PER_TASK", snapshot.count() // (2 * cores))      # more rows, more tasks
    assert churn.packed(scattered).rdd.getNumPartitions() == 2 * cores
    one = snapshot.coalesce(1)
    assert churn.packed(one) is one
    monkeypatch.undo()
    fitted = []
    monkeypatch.setattr(churn.GBTClassifier, "_fit", lambda self, df: fitted.append(df.rdd.getNumPartitions()) or self)
    monkeypatch.setattr(churn, "Pipeline", lambda stages: stages[-1])
    churn.train(scattered, 1)
    assert fitted == [cores]


def test_fits_run_side_by_side_if_memory_allows(snapshot, monkeypatch):
    other = snapshot.withColumn("churned", 1 - F.col("churned"))
    alone = [churn.train(s, 2) for s in (snapshot, other)]
    for memory in (10**9, 0):
        monkeypatch.setattr(churn, "cache_memory", lambda spark: memory)
        fits = churn.train_all([snapshot, other], 2)
        for fit, same in zip(fits, alone):
            assert churn.score(fit, snapshot).exceptAll(churn.score(same, snapshot)).count() == 0
    meet = threading.Barrier(2, timeout=60)
    monkeypatch.setattr(churn, "train", lambda s, rounds: meet.wait())
    monkeypatch.setattr(churn, "cache_memory", lambda spark: 10**9)
    assert sorted(churn.train_all([snapshot, other])) == [0, 1]                        # both are at work at once
    monkeypatch.setattr(churn, "cache_memory", lambda spark: 0)
    monkeypatch.setattr(churn, "train", lambda s, rounds: threading.current_thread() is threading.main_thread())
    assert churn.train_all([snapshot, other]) == [True, True]


def test_the_memory_for_cached_data_is_known(spark):
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert 0.2 * heap < cache_memory(spark) < heap
