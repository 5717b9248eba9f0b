"""Bronze text lines -> typed, deduplicated, labelled lines -> silver and quarantine."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoicelake.functions.expressions import first_that_holds
from invoicelake.schema import LABELLED, LINE, MIN_RETENTION, MONEY, REJECT_RULES, SILVER, conform


class QualityGateFailed(RuntimeError):
    """Too few lines passed; nothing may be published."""


def _typed(field: T.StructField) -> Column:
    """One declared column read from its text: trimmed text, or NULL where a cast fails."""
    text = F.col(field.metadata.get("read_from", field.name))
    if not isinstance(field.dataType, T.StringType):
        return text.try_cast(field.dataType).alias(field.name)
    trimmed = F.trim(text)
    return (F.upper(trimmed) if field.metadata.get("upper_case") else trimmed).alias(field.name)


def typed_lines(bronze: DataFrame) -> DataFrame:
    """The eight columns under their declared types."""
    return bronze.select(*[_typed(field) for field in LINE.fields])


def dedupe_lines(bronze: DataFrame) -> DataFrame:
    """One row per distinct line. Copies of a line are combined before the shuffle."""
    return typed_lines(bronze).dropDuplicates()


def label_rows(bronze: DataFrame, rules: Iterable[tuple[str, str]] = REJECT_RULES) -> DataFrame:
    """Distinct typed lines, each with its cancellation flag and the name of the first rule that rejects it (NULL = clean).

    ``rules`` are names and SQL conditions on the typed columns and the flag."""
    flagged = dedupe_lines(bronze).withColumn("is_cancellation", F.col("invoice").startswith("C"))
    return conform(flagged.withColumn("reject_reason", first_that_holds(rules)), LABELLED)


def with_line_value(labelled: DataFrame) -> DataFrame:
    """Add the day and the signed value, rounded half up in exact arithmetic."""
    value = F.round(F.col("quantity") * F.col("price"), MONEY.scale)
    return labelled.withColumns(
        {"invoice_date": F.col("invoice_ts").cast("date"), "line_value": value.try_cast(MONEY)})


def to_silver(labelled: DataFrame) -> DataFrame:
    return conform(with_line_value(labelled.filter(F.col("reject_reason").isNull())).select(*SILVER.names), SILVER)


def to_quarantine(labelled: DataFrame) -> DataFrame:
    return labelled.filter(F.col("reject_reason").isNotNull())


def reject_report(labelled: DataFrame) -> DataFrame:
    """Lines per reason, clean lines under NULL."""
    return (
        labelled.groupBy("reject_reason").agg(F.count("*").alias("lines"))
        .orderBy(F.desc("lines"), "reject_reason")
    )


def retention(labelled: DataFrame) -> DataFrame:
    """One row: deduplicated lines, clean lines, their share."""
    return labelled.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("reject_reason").isNull()).alias("kept"),
    ).withColumn("retention", F.try_divide("kept", "total"))


def watched(labelled: DataFrame) -> tuple[DataFrame, Observation]:
    """The lines, and what is counted of them in the very pass that writes them: no scan of its own.

    Put it on lines whose shuffles are over, so that a repeated task counts nothing twice."""
    seen = Observation(f"lines-{uuid.uuid4().hex}")
    clean = F.col("reject_reason").isNull()
    return labelled.observe(
        seen, F.count(F.lit(1)).alias("total"), F.count_if(clean).alias("kept"), F.count_if(~clean).alias("quarantined")), seen


def quality_gate(spark: SparkSession, seen: Observation, minimum: float = MIN_RETENTION) -> DataFrame:
    """The verdict on the lines just written: total, kept, retention, passed."""
    counts = seen.get
    row = spark.createDataFrame([(counts["total"], counts["kept"])], "total long, kept long")
    return row.withColumn("retention", F.try_divide("kept", "total")).withColumn(
        "passed", F.coalesce(F.col("retention") >= minimum, F.lit(False)))


def require_quality(gate: DataFrame, minimum: float = MIN_RETENTION) -> None:
    """Stop before anything is published when the gate's verdict is no."""
    row = gate.first()
    if not row.passed:
        raise QualityGateFailed(f"{row.kept} of {row.total} lines are clean, below {minimum:.0%}")


def split_reconcile(seen: Observation, stored: dict[str, DataFrame]) -> DataFrame:
    """Proof that the split loses nothing: the rows of the stored layers against the lines that went into them."""
    counted = [df.select(F.lit(name).alias("layer")) for name, df in stored.items()]
    return reduce(DataFrame.union, counted).agg(
        F.lit(seen.get["total"]).cast("long").alias("labelled"), *[F.count_if(F.col("layer") == name).alias(name) for name in stored],
    ).withColumn("balanced", F.col("labelled") == sum((F.col(name) for name in stored), F.lit(0)))
