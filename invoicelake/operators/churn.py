"""The churn model: boosted trees trained, checked out of time and applied without leaving Spark."""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.functions.expressions import as_double, round_half_even, round_half_up
from invoicelake.functions.ordering import running_totals, top_rows
from invoicelake.operators.gold import active_customers
from invoicelake.operators.rfm import rfm_scores
from invoicelake.operators.tree_scoring import with_probability
from invoicelake.schema import FEATURES
from invoicelake.session import cache_memory, shared_folder, stage

# --- fixed values: the model's settings -------------------------------------------
MAX_DEPTH = 3
LEARNING_RATE = 0.05
ROUNDS = 300
SEED = 42
MAX_BINS = 255
MIN_ROWS_PER_LEAF = 20
# --- how fits are laid out
ROWS_PER_TASK = 500_000   # of a snapshot; what a fit caches of so many rows stays far below an executor's memory
FIT_BYTES_PER_ROW = 400   # what a fit keeps cached per customer: binned features, count, predictions of three rounds
CACHE_SHARE = 0.5         # of the memory for cached data that fits side by side may fill
# ----------------------------------------------------------------------------------


class PublishRefused(RuntimeError):
    """The model ranks no better than the recency rule; its scores may not be published."""


def train(snapshot: DataFrame, rounds: int = ROUNDS) -> PipelineModel:
    """Fit on a labelled snapshot. Spark's trees take no missing values, so those count as 0."""
    shared_folder(snapshot.sparkSession)  # long boosting chains are checkpointed there
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0D) AS _{c}" for c in FEATURES)
    trees = GBTClassifier(
        featuresCol="_features", labelCol="churned", predictionCol="_prediction",
        maxDepth=MAX_DEPTH, stepSize=LEARNING_RATE, maxIter=rounds, seed=SEED, maxBins=MAX_BINS,
        minInstancesPerNode=MIN_ROWS_PER_LEAF, checkpointInterval=10)
    trees.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    return Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        VectorAssembler(inputCols=[f"_{c}" for c in FEATURES], outputCol="_features"),
        trees,
    ]).fit(packed(snapshot))


def packed(snapshot: DataFrame) -> DataFrame:
    """The same rows in a few partitions per core at most.

    Each round is six stages, and half of them have as many tasks as the snapshot has partitions but a row for four of
    them at most: with one partition per small file most of a fit is starting tasks."""
    cores = snapshot.sparkSession.sparkContext.defaultParallelism
    if snapshot.rdd.getNumPartitions() <= cores:
        return snapshot
    return snapshot.coalesce(cores * max(1, math.ceil(snapshot.count() / (cores * ROWS_PER_TASK))))


def train_all(snapshots: list[DataFrame], rounds: int = ROUNDS) -> list[PipelineModel]:
    """A fit on each of several stored snapshots, side by side if what they keep cached fits into memory together.

    A round is a chain of short jobs that leave most cores idle, which the rounds of the other fits then use."""
    spark = snapshots[0].sparkSession
    shared_folder(spark)
    needed = FIT_BYTES_PER_ROW * sum(s.count() for s in snapshots)
    if needed > CACHE_SHARE * cache_memory(spark):
        return [train(s, rounds) for s in snapshots]
    with ThreadPoolExecutor(len(snapshots)) as pool:
        fits = [pool.submit(inheritable_thread_target(spark)(train), s, rounds) for s in snapshots]
        return [fit.result() for fit in fits]


def probabilities(model: PipelineModel, customers: DataFrame) -> DataFrame:
    """The customers with their unrounded churn probability ``p``, from the fitted trees as column expressions."""
    return with_probability(customers, model.stages[-1], FEATURES)


def transformed(model: PipelineModel, customers: DataFrame) -> DataFrame:
    """The same by the fitted pipeline's own vectors: what ``probabilities`` is checked against."""
    return model.transform(customers).select(
        *customers.columns, vector_to_array("_probability")[1].alias("p"))


def scoring_check(model: PipelineModel, customers: DataFrame) -> DataFrame:
    """One row: customers scored, and how many of them the two ways of scoring put more than 1e-9 apart."""
    both = transformed(model, probabilities(model, customers).withColumnRenamed("p", "expected"))
    return both.agg(
        F.count("*").alias("customers"),
        F.count_if(F.abs(F.col("p") - F.col("expected")) > 1e-9).alias("apart"))


def at_risk(p: Column) -> list[Column]:
    """Published probability and expected loss, both from the unrounded probability."""
    spend = F.greatest(F.col("revenue_365d"), F.lit(0.0))
    return [round_half_even(p, 4).alias("churn_probability"),
            round_half_even(p * spend, 2).alias("revenue_at_risk")]


def score(model: PipelineModel, customers: DataFrame, run_id: str | None = None) -> DataFrame:
    scored = probabilities(model, customers).select(*customers.columns, *at_risk(F.col("p")))
    return scored.withColumn("model_run_id", F.lit(run_id)) if run_id else scored


def rank_auc(df: DataFrame, score_column: str, label: str = "churned") -> DataFrame:
    """Exact area under the ROC curve from ranks; ties earn half. One row: auc, customers."""
    counts = stage(
        df.groupBy(F.col(score_column).cast("double").alias("score"), F.lit(0).alias("one"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")),
        "score_counts")
    won = as_double(F.col("pos")) * (F.col("neg_before") + F.col("neg") / 2)
    return running_totals(counts, "one", "score", ["neg"]).agg(
        F.sum(won).alias("won"), as_double(F.sum("pos")).alias("pos"),
        as_double(F.sum("neg")).alias("neg"),
    ).select(
        F.try_divide("won", F.col("pos") * F.col("neg")).alias("auc"),
        (F.col("pos") + F.col("neg")).cast("long").alias("customers"))


def recency_auc(snapshot: DataFrame) -> DataFrame:
    """What the rule "longest since the last order" achieves."""
    return rank_auc(snapshot, "recency_days").select(
        round_half_up(F.col("auc"), 4).alias("baseline_recency_auc"), "customers")


def top_decile(snapshot: DataFrame, score_column: str = "recency_days") -> DataFrame:
    """The tenth of the customers with the highest score, at least one; ties by customer_id."""
    return top_rows(snapshot, F.col(score_column), "customer_id", lambda n: max(1, n // 10))


def top_decile_precision(snapshot: DataFrame, score_column: str = "recency_days") -> DataFrame:
    return top_decile(snapshot, score_column).agg(
        F.count("*").alias("customers"),
        F.sum("churned").alias("churned"),
        F.avg("churned").alias("precision"))


def churn_base_rate(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(
        F.count("*").alias("customers"), F.avg("churned").alias("churn_base_rate"))


def evaluate(model: PipelineModel, snapshot: DataFrame) -> dict[str, float]:
    """Five figures for a labelled snapshot the model has not seen."""
    scored = stage(
        probabilities(model, snapshot).select("customer_id", "recency_days", "churned", "p"), "scored")
    base = churn_base_rate(scored).first()
    return {
        "auc": rank_auc(scored, "p").first().auc,
        "baseline_recency_auc": rank_auc(scored, "recency_days").first().auc,
        "precision_top_decile": top_decile_precision(scored, "p").first().precision,
        "churn_base_rate": base.churn_base_rate,
        "customers": base.customers,
    }


def publishable(metrics: dict[str, float]) -> bool:
    return metrics["auc"] > metrics["baseline_recency_auc"]


def require_publishable(metrics: dict[str, float]) -> None:
    if not publishable(metrics):
        raise PublishRefused(
            f"AUC {metrics['auc']:.4f} does not beat the recency rule "
            f"({metrics['baseline_recency_auc']:.4f})")


def new_run_id() -> str:
    return uuid.uuid4().hex


def run_record(df: DataFrame, run_id: str, params: dict, metrics: dict[str, float]) -> DataFrame:
    """One row of the run table: what was trained, by whom, how well it did."""
    def mapping(values: dict, kind: str) -> Column:
        pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast(kind))]
        return F.create_map(*pairs)

    return df.sparkSession.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("created_at"),
        F.current_user().alias("created_by"),
        mapping(params, "string").alias("params"),
        mapping({k: round(float(v), 4) for k, v in metrics.items()}, "double").alias("metrics"))


def model_params(rounds: int = ROUNDS) -> dict:
    return {"max_depth": MAX_DEPTH, "learning_rate": LEARNING_RATE, "max_iter": rounds, "random_state": SEED}


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def churn_rate_by_recency(snapshot: DataFrame) -> DataFrame:
    """The observed churn rate per recency quintile of a stored snapshot: at most five rows."""
    return rfm_scores(snapshot).groupBy("r_score").agg(
        F.try_divide(as_double(F.sum("churned")), F.count("*")).alias("p"))


def risk_by_rate(snapshot: DataFrame, rfm: DataFrame) -> DataFrame:
    """Revenue at risk without a model: each active customer takes the rate of their quintile.

    The rates are five rows at most, one per quintile."""
    return (
        active_customers(rfm).join(F.broadcast(churn_rate_by_recency(snapshot)), "r_score")
        .select(*rfm.columns, *at_risk(F.col("p")))
    )
