"""Recency, frequency and monetary scores and the customer segments made from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.functions.expressions import first_that_holds
from invoicelake.functions.ordering import ntile_columns
from invoicelake.schema import CUSTOMER_RFM, SEGMENT_RULES, conform


def rfm_scores(features: DataFrame) -> DataFrame:
    """Quintiles 1-5 (5 is best); ties are broken by customer_id.

    ``features`` is read several times to find the quintile borders, so pass a stored table.
    """
    return ntile_columns(
        features,
        {
            "r_score": -F.col("recency_days"),
            "f_score": F.col("frequency"),
            "m_score": F.col("monetary"),
        },
        tie="customer_id",
    )


def rfm_segments(features: DataFrame, rules: Iterable[tuple[str, str]] = SEGMENT_RULES) -> DataFrame:
    """Scores and the segment: the first rule (name and SQL condition on the scores) that holds."""
    return conform(rfm_scores(features).withColumn("segment", first_that_holds(rules)), CUSTOMER_RFM)


def segment_rollup(rfm: DataFrame) -> DataFrame:
    return (
        rfm.groupBy("segment")
        .agg(F.count("*").alias("customers"),
             F.sum(F.col("revenue_365d").cast("decimal(28,2)")).alias("total"))
        .select("segment", "customers",
                F.round("total", 0).cast("double").alias("revenue_365d"))
        .orderBy(F.desc("revenue_365d"), "segment")
    )
