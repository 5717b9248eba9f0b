"""The tables the registered queries share: each is derived once per session and folder, and stored."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession

from invoicelake.operators import churn, findings, gold, rfm, silver
from invoicelake.plans import pipeline
from invoicelake.session import stage, staging_path
from invoicelake.sources.landing import read_landing
from invoicelake.sources.orders_model import derive_bronze


class Workspace:
    _opened: dict[tuple[str, str], Workspace] = {}
    _lock = threading.RLock()

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Workspace:
        with cls._lock:
            key = (spark.sparkContext.applicationId, folder.rstrip("/"))
            return cls._opened.setdefault(key, cls(spark, folder))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def landing(self) -> str:
        """The folder of text extracts the pipeline starts from."""
        path = staging_path(self.spark, "landing")
        derive_bronze(self.spark, self.folder).write.parquet(path)
        return path

    @cached_property
    def bronze(self) -> DataFrame:
        return read_landing(self.spark, self.landing)

    @property
    def labelled(self) -> DataFrame:
        return silver.label_rows(self.bronze)

    @cached_property
    def written(self) -> tuple[DataFrame, Observation]:
        """The stored lines of both layers, and what was counted while they were written."""
        watched, seen = silver.watched(pipeline.layered(self.labelled))
        return stage(watched, "lines", partition_by="layer"), seen

    @property
    def lines(self) -> DataFrame:
        """Typed, deduplicated, labelled lines of both layers."""
        return self.written[0]

    @property
    def silver(self) -> DataFrame:
        return pipeline.layer(self.lines, "silver")

    @cached_property
    def days(self) -> dict[str, dt.date]:
        return gold.snapshot_days(self.silver)

    @cached_property
    def kpis(self) -> DataFrame:
        return stage(gold.monthly_kpis(self.silver), "kpis")

    @cached_property
    def products(self) -> DataFrame:
        return stage(gold.product_performance(self.silver), "products")

    @cached_property
    def features(self) -> DataFrame:
        return stage(gold.customer_features(self.silver, self.days["score_at"]), "features")

    @cached_property
    def rfm(self) -> DataFrame:
        return stage(rfm.rfm_segments(self.features), "rfm")

    @cached_property
    def snapshots(self) -> tuple[DataFrame, DataFrame]:
        """The older and the newer snapshot of the out-of-time split."""
        return pipeline.stored_snapshots(self.silver, self.days)

    @cached_property
    def test_snapshot(self) -> DataFrame:
        """The newer one, alone if the older one is not made yet."""
        if "snapshots" in self.__dict__:
            return self.snapshots[1]
        return pipeline.newest_snapshot(self.silver, self.days)

    @cached_property
    def pairs(self) -> DataFrame:
        return stage(findings.reversal_pairs(self.silver), "pairs")

    @cached_property
    def rate_risk(self) -> DataFrame:
        """Revenue at risk from observed rates: what the risk queries are checked on."""
        return stage(churn.risk_by_rate(self.test_snapshot, self.rfm), "rate_risk")

    @cached_property
    def evaluation(self) -> tuple[DataFrame, DataFrame, dict[str, float]]:
        return pipeline.evaluate_model(
            self.silver, self.days, churn.ROUNDS, snapshots=self.snapshots, model=self.checked_model)

    @cached_property
    def checked_model(self) -> PipelineModel:
        """The model of the older snapshot: the one that is evaluated."""
        return churn.train(self.snapshots[0], churn.ROUNDS)

    @cached_property
    def model(self) -> PipelineModel:
        """The model of the newest snapshot; the fit that is evaluated is another, on the older one."""
        return churn.train(self.test_snapshot, churn.ROUNDS)

    @cached_property
    def model_scores(self) -> DataFrame:
        """Revenue at risk by the model, without the run it is recorded under: no evaluation is needed for it."""
        return stage(churn.score(self.model, gold.active_customers(self.rfm)), "model_scores")

    @property
    def model_risk(self) -> DataFrame:
        """The scores with their run. What both need is made together, as far as nothing of it is there."""
        if not {"features", "snapshots", "test_snapshot"} & self.__dict__.keys():
            self.features, self.snapshots = pipeline.stored_customers(self.silver, self.days)
        if not {"checked_model", "evaluation", "model"} & self.__dict__.keys():
            self.checked_model, self.model = churn.train_all(list(self.snapshots), churn.ROUNDS)
        return pipeline.of_run(self.model_scores, self.evaluation[1])

    def gold_tables(self, risk: DataFrame | None = None) -> dict[str, DataFrame]:
        return {
            "gold_monthly_kpis": self.kpis,
            "gold_product_performance": self.products,
            "gold_customer_rfm": self.rfm,
            "gold_customer_churn_risk": self.rate_risk if risk is None else risk,
        }


def over(query: Callable[[Workspace], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A registered query from a function of the workspace."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        with Workspace._lock:
            return query(Workspace.of(spark, folder))
    return run
