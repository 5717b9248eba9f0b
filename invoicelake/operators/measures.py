"""Ratio-of-sums measures over the gold tables, correct at any grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.functions.expressions import as_double, ratio
from invoicelake.schema import HIGH_RISK


def money_sum(column: str | Column) -> Column:
    """Exact sum of published two-digit money; the order of addition cannot change it."""
    value = F.col(column) if isinstance(column, str) else column
    return as_double(F.sum(value.cast("decimal(28,2)")))


def revenue_measures(kpis: DataFrame, by: list[str | Column] | None = None) -> DataFrame:
    """Gross, cancelled and net revenue, leakage, orders and average order value."""
    return (
        kpis.groupBy(*(by or []))
        .agg(
            money_sum("gross_revenue").alias("gross_revenue"),
            money_sum("cancelled_value").alias("cancelled_value"),
            money_sum("net_revenue").alias("net_revenue"),
            F.sum("orders").alias("total_orders"))
        .withColumn("leakage", ratio(F.col("cancelled_value"), F.col("gross_revenue")))
        .withColumn("avg_order_value", ratio(F.col("gross_revenue"), F.col("total_orders")))
    )


def calendar(span: DataFrame) -> DataFrame:
    """One row per day between the dates ``first_day`` and ``final_day`` of a one-row frame."""
    return span.select(
        F.explode(F.sequence("first_day", "final_day")).alias("date")
    ).select(
        "date", F.year("date").alias("year"),
        F.date_format("date", "MMM yyyy").alias("month"),
        (F.year("date") * 100 + F.month("date")).alias("month_no"))


def calendar_of(kpis: DataFrame) -> DataFrame:
    """The calendar of all months that have facts, from first to last day."""
    return calendar(kpis.agg(
        F.min("month").alias("first_day"), F.last_day(F.max("month")).alias("final_day")))


def by_calendar_month(days: DataFrame, kpis: DataFrame) -> DataFrame:
    """Revenue measures for every month of the calendar; months without facts stay, as NULL."""
    facts = revenue_measures(kpis, ["month"]).withColumnRenamed("month", "date")
    return (
        days.filter(F.dayofmonth("date") == 1)
        .join(facts, "date", "left")
        .select("date", "year", "month", "month_no", "gross_revenue", "cancelled_value",
                "net_revenue", "leakage", "total_orders", "avg_order_value")
    )


def net_revenue_yoy(days: DataFrame, kpis: DataFrame) -> DataFrame:
    """Growth of net revenue on the same month of the year before.

    NULL without a prior year; -1 where this month is empty but the one a year before is not.
    """
    months = by_calendar_month(days, kpis).select("date", "month_no", "net_revenue")
    prior = months.select(
        F.add_months("date", 12).alias("date"), F.col("net_revenue").alias("prior_net_revenue"))
    change = F.coalesce(F.col("net_revenue"), F.lit(0.0)) - F.col("prior_net_revenue")
    return months.join(prior, "date", "left").withColumn(
        "yoy", F.try_divide(change, "prior_net_revenue"))


def in_year(kpis: DataFrame, year: int) -> DataFrame:
    """The months of one year, as a range of dates so that the scan can skip the others."""
    first, after = (F.lit(f"{y}-01-01").cast("date") for y in (year, year + 1))
    return kpis.filter((F.col("month") >= first) & (F.col("month") < after))


def year_slice(kpis: DataFrame, year: int) -> DataFrame:
    return revenue_measures(in_year(kpis, year))


def top_countries(kpis: DataFrame, n: int = 10) -> DataFrame:
    return (
        revenue_measures(kpis, ["country"]).select("country", "net_revenue")
        .orderBy(F.desc("net_revenue"), "country").limit(n)
    )


def product_measures(products: DataFrame, by: list[str]) -> DataFrame:
    return (
        products.groupBy(*by)
        .agg(money_sum("gross_revenue").alias("product_gross_revenue"),
             money_sum("cancelled_value").alias("product_cancelled_value"))
        .withColumn("product_cancel_rate",
                    ratio(F.col("product_cancelled_value"), F.col("product_gross_revenue")))
    )


def top_cancelled(products: DataFrame, n: int = 10) -> DataFrame:
    return (
        product_measures(products, ["description"])
        .select("description", "product_cancelled_value")
        .orderBy(F.desc("product_cancelled_value"), "description").limit(n)
    )


def cancel_rate_table(products: DataFrame, minimum: float = 1000) -> DataFrame:
    return (
        product_measures(products, ["description"])
        .filter(F.col("product_gross_revenue") > minimum)
        .orderBy(F.desc("product_cancel_rate"), "description")
    )


def product_like(products: DataFrame, pattern: str) -> DataFrame:
    return products.filter(F.col("description").like(pattern))


def segment_counts(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("segment").agg(F.count("*").alias("customers"))


def risk_cards(risk: DataFrame, threshold: float = HIGH_RISK) -> DataFrame:
    """Active customers, revenue at risk and the high-risk part (probability >= threshold)."""
    high = F.col("churn_probability") >= threshold
    return risk.agg(
        F.count("*").alias("active_customers"),
        money_sum("revenue_at_risk").alias("revenue_at_risk"),
        F.count_if(high).alias("high_risk_customers"),
        F.coalesce(money_sum(F.when(high, F.col("revenue_at_risk"))), F.lit(0.0))
        .alias("high_risk_revenue"))


def risk_scatter(risk: DataFrame) -> DataFrame:
    return risk.select("customer_id", "recency_days", "revenue_365d", "churn_probability")
