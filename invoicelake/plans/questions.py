"""Standing questions over the gold tables, and the scoring of SQL answers from elsewhere."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from invoicelake.functions.expressions import round_half_up
from invoicelake.operators import findings, measures
from invoicelake.operators.compare import outcome_table, results_match
from invoicelake.operators.screening import UnsafeSQL, require_read, screen_queries
from invoicelake.schema import HIGH_RISK
from invoicelake.sources.catalog import register_views


@dataclass
class Gold:
    """The four gold tables a question is asked of, and what it is asked about."""

    kpis: DataFrame
    products: DataFrame
    rfm: DataFrame
    risk: DataFrame
    year: int
    home: str


def top_foreign(t: Gold, n: int = 5) -> DataFrame:
    abroad = measures.revenue_measures(t.kpis.filter(F.col("country") != t.home), ["country"])
    return abroad.select("country", "gross_revenue").orderBy(F.desc("gross_revenue"), "country").limit(n)


def best_month(t: Gold) -> DataFrame:
    months = measures.revenue_measures(t.kpis, ["month"]).select("month", "net_revenue")
    return months.orderBy(F.desc("net_revenue"), "month").limit(1)


def at_risk_country(t: Gold) -> DataFrame:
    return (
        t.rfm.filter(F.col("segment") == "At Risk").groupBy("country")
        .agg(F.count("*").alias("customers"))
        .orderBy(F.desc("customers"), "country").limit(1)
    )


def top_cancelled(t: Gold, n: int = 5) -> DataFrame:
    return (
        t.products.select("stock_code", "description", "cancelled_value")
        .orderBy(F.desc("cancelled_value"), "stock_code").limit(n)
    )


QUESTIONS: dict[str, Callable[[Gold], DataFrame]] = {
    "net_revenue_year": lambda t: measures.year_slice(t.kpis, t.year).select("net_revenue"),
    "top_foreign": top_foreign,
    "leakage_pct": lambda t: measures.revenue_measures(t.kpis).select(
        round_half_up(F.col("leakage") * 100, 2).alias("leakage_pct")),
    "best_month": best_month,
    "segment_counts": lambda t: measures.segment_counts(t.rfm),
    "total_risk": lambda t: measures.risk_cards(t.risk).select("revenue_at_risk"),
    "top_risk": lambda t: findings.call_list(t.risk, 10).select("customer_id", "revenue_at_risk"),
    "top_cancelled": top_cancelled,
    "high_risk": lambda t: t.risk.filter(F.col("churn_probability") > HIGH_RISK).agg(
        F.count("*").alias("customers")),
    "at_risk_country": at_risk_country,
    "monthly_net": lambda t: measures.revenue_measures(
        measures.in_year(t.kpis, t.year), ["month"]).select("month", "net_revenue"),
}


AT_ONCE = 4          # cases that are scored at the same time
CASE_SECONDS = 600.0

CASE = "question string, sql string, candidate string"


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of {question, sql} records, with a candidate answer to each."""
    return spark.read.schema(CASE).option(
        "multiLine", True).json(path)


class _Limit:
    """Cancels the Spark jobs that a thread starts from now on, once its time is up."""

    def __init__(self, spark: SparkSession, seconds: float):
        self.sc, self.seconds, self.tag = spark.sparkContext, seconds, f"case-{uuid.uuid4().hex}"
        self.done, self.over = threading.Event(), False

    def _watch(self) -> None:
        self.over = not self.done.wait(self.seconds)
        while not self.done.wait(0.2):     # a case may start several jobs
            self.sc.cancelJobsWithTag(self.tag)

    def __enter__(self) -> _Limit:
        self.sc.addJobTag(self.tag)
        self.sc.setInterruptOnCancel(True)
        threading.Thread(target=self._watch, daemon=True).start()
        return self

    def __exit__(self, *_) -> None:
        self.done.set()
        self.sc.removeJobTag(self.tag)


def _score(spark: SparkSession, case: Row, seconds: float) -> tuple[str, bool, str | None]:
    """Question, verdict and SQL; no SQL if the time ran out."""
    if case.blocked_because:
        return case.question, False, f"BLOCKED: {case.blocked_because}"
    with _Limit(spark, seconds) as limit:
        try:
            require_read(spark, case.safe_sql)
            return case.question, results_match(spark.sql(case.sql), spark.sql(case.safe_sql)), case.safe_sql
        except UnsafeSQL as problem:
            return case.question, False, f"BLOCKED: {problem}"
        except Exception as problem:  # a candidate may be wrong SQL: it fails, the run goes on
            if limit.over:
                return case.question, False, None
            return case.question, False, f"ERROR: {type(problem).__name__}: {str(problem)[:200]}"


def score_answers(
    spark: SparkSession, cases: DataFrame, tables: dict[str, DataFrame], at_once: int = AT_ONCE, seconds: float = CASE_SECONDS
) -> DataFrame:
    """Run every candidate through the screen and compare its result with the reference query's.

    The whole result counts: no row limit is added. A few cases run at a time; each has its own job tag, and the jobs of
    one that takes longer than ``seconds`` are cancelled while the others go on. As a runaway may have held the cores that
    another case waited for, those out of time are run once more, one after the other, before they fail. Only cases and
    verdicts pass through the driver, ``at_once`` of them ahead; the comparisons are Spark jobs.
    """
    register_views(tables)
    rows = screen_queries(cases, "candidate", row_limit=None).orderBy("question").toLocalIterator()
    outcomes, waiting, late = [], [], []

    def finish() -> None:
        case, result = waiting.pop(0)
        outcome = result.result()
        (late.append(case) if outcome[2] is None else outcomes.append(outcome))

    with ThreadPoolExecutor(at_once) as pool:
        for case in rows:
            waiting.append((case, pool.submit(inheritable_thread_target(spark)(_score), spark, case, seconds)))
            if len(waiting) > 2 * at_once:
                finish()
        while waiting:
            finish()
    for question, ok, sql in (_score(spark, case, seconds) for case in late):
        outcomes.append((question, ok, f"ERROR: not done within {seconds:g} s" if sql is None else sql))
    return outcome_table(sorted(outcomes), cases)


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    outcomes.withColumn("sql", F.regexp_replace("sql", r"\s+", " ")).write.mode("overwrite").json(path)
