"""The findings a reader acts on: keying errors, adjusted leakage, call and win-back lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from invoicelake.functions.expressions import as_double, ratio
from invoicelake.operators.measures import money_sum
from invoicelake.schema import (
    CALL_LIST_SIZE, ENTRY_MAX_UNITS, ENTRY_MAX_VALUE, HIGH_RISK, RETAINED_SHARES, REVERSAL_MINUTES)


def _minute(ts: str) -> Column:
    """Minutes of wall-clock time since 1970."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) * 1440 + F.hour(ts) * 60 + F.minute(ts)


def reversal_pairs(silver: DataFrame, minutes: int = REVERSAL_MINUTES) -> DataFrame:
    """Cancellations that undo a sale of the same customer, product and units shortly before, one to one.

    A sale is undone once, the last one first: sales open a bracket and cancellations close one. A cancellation whose
    bracket was opened longer ago than ``minutes``, or never, undoes nothing. Whether two lines are a pair depends only on
    what lies between them, so time is cut into slots of the window's width and brackets are matched in every two
    neighbouring slots with a cancellation in the second; no list of candidate pairs is made, and a busy (customer, product,
    units) is spread over its slots. Within one instant sales come before cancellations, each by invoice and value.
    """
    key = ["customer_id", "stock_code", "units"]
    lines = silver.filter(
        F.col("customer_id").isNotNull() & F.col("stock_code").isNotNull() & F.col("is_cancellation").isNotNull()
    ).select(
        "customer_id", "stock_code", F.abs("quantity").alias("units"), "invoice_ts", "invoice",
        "line_value", "is_cancellation", F.floor(_minute("invoice_ts") / minutes).alias("slot"))
    spans = lines.filter("is_cancellation").select(*key, F.col("slot").alias("span")).distinct()
    events = lines.withColumn("span", F.explode(F.array(F.col("slot"), F.col("slot") + 1))).join(
        spans, [*key, "span"], "left_semi")
    order = ["invoice_ts", "is_cancellation", "invoice", "line_value"]
    depth = F.sum(F.when(F.col("is_cancellation"), -1).otherwise(1)).over(
        Window.partitionBy(*key, "span").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # a sale and the cancellation that closes it have one level, and nothing of that level lies between them
    levelled = events.withColumn("level", depth + F.col("is_cancellation").cast("int"))
    before = F.lag(F.struct("is_cancellation", "invoice", "invoice_ts", "line_value")).over(
        Window.partitionBy(*key, "span", "level").orderBy(*order))
    return (
        levelled.withColumn("sale", before)
        .filter(F.col("is_cancellation") & (F.col("slot") == F.col("span")) & ~F.col("sale.is_cancellation")
                & (F.col("invoice_ts") <= F.col("sale.invoice_ts") + F.expr(f"INTERVAL {minutes} MINUTES")))
        .select(
            *key,
            F.col("sale.invoice").alias("sale_invoice"),
            F.col("invoice").alias("cancel_invoice"),
            F.col("sale.invoice_ts").alias("sale_ts"),
            F.col("invoice_ts").alias("cancel_ts"),
            as_double(F.col("sale.line_value")).alias("sale_value"),
            as_double(-F.col("line_value")).alias("cancelled_value"))
    )


def reversal_share(pairs: DataFrame, kpis: DataFrame) -> DataFrame:
    """The part of all cancelled value that the pairs explain. Totals come from the gold table."""
    flagged = pairs.agg(F.count("*").alias("pairs"), money_sum("cancelled_value").alias("flagged_value"))
    everything = kpis.agg(money_sum("cancelled_value").alias("cancelled_value"))
    return (
        flagged.unionByName(everything, allowMissingColumns=True)
        .agg(F.max("pairs").alias("pairs"),
             F.coalesce(F.max("flagged_value"), F.lit(0.0)).alias("flagged_value"),
             F.max("cancelled_value").alias("cancelled_value"))
        .withColumn("share", ratio(F.col("flagged_value"), F.col("cancelled_value")))
    )


def leakage_adjusted(pairs: DataFrame, kpis: DataFrame) -> DataFrame:
    """Leakage per year as reported and without the flagged sales and cancellations.

    Both sides are taken off the yearly totals instead of removing lines from silver.
    """
    def money(column: str) -> Column:
        return F.col(column).cast("decimal(28,2)")

    reported = kpis.select(
        F.year("month").alias("year"), money("gross_revenue").alias("gross"),
        money("cancelled_value").alias("cancelled"))
    flagged = pairs.select(
        F.year("sale_ts").alias("year"), money("sale_value").alias("flagged_gross")
    ).unionByName(
        pairs.select(F.year("cancel_ts").alias("year"),
                     money("cancelled_value").alias("flagged_cancelled")),
        allowMissingColumns=True)
    sums = (
        reported.unionByName(flagged, allowMissingColumns=True)
        .groupBy("year")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
               for c in ("gross", "cancelled", "flagged_gross", "flagged_cancelled")])
    )
    return sums.select(
        "year",
        ratio(F.col("cancelled"), F.col("gross")).alias("leakage_reported"),
        ratio(F.col("cancelled") - F.col("flagged_cancelled"), F.col("gross") - F.col("flagged_gross"))
        .alias("leakage_adjusted"))


def order_entry_check(
    silver: DataFrame, units: int = ENTRY_MAX_UNITS, value: int = ENTRY_MAX_VALUE
) -> DataFrame:
    """Sale lines that should have needed a second confirmation."""
    return silver.filter(
        ~F.col("is_cancellation") & ((F.col("quantity") > units) | (F.col("line_value") > value)))


def call_list(risk: DataFrame, size: int = CALL_LIST_SIZE) -> DataFrame:
    """The customers with the highest expected loss."""
    return (
        risk.select("customer_id", "country", "revenue_365d", "churn_probability", "revenue_at_risk")
        .orderBy(F.desc("revenue_at_risk"), "customer_id").limit(size)
    )


def risk_concentration(risk: DataFrame, size: int = CALL_LIST_SIZE) -> DataFrame:
    """How much of the base and of the risk the call list holds."""
    whole = risk.agg(
        F.count("*").alias("customers"), money_sum("revenue_at_risk").alias("revenue_at_risk"))
    top = call_list(risk, size).agg(
        F.count("*").alias("top_customers"), money_sum("revenue_at_risk").alias("top_revenue_at_risk"))
    return (
        whole.unionByName(top, allowMissingColumns=True)
        .agg(*[F.max(c).alias(c) for c in
               ("customers", "revenue_at_risk", "top_customers", "top_revenue_at_risk")])
        .withColumn("customer_share", ratio(F.col("top_customers"), F.col("customers")))
        .withColumn("risk_share", ratio(F.col("top_revenue_at_risk"), F.col("revenue_at_risk")))
    )


def winback_list(
    risk: DataFrame, threshold: float = HIGH_RISK, size: int = CALL_LIST_SIZE
) -> DataFrame:
    """Likely leavers who are not on the call list."""
    called = call_list(risk, size).select("customer_id")
    return (
        risk.filter(F.col("churn_probability") >= threshold)
        .join(called, "customer_id", "left_anti")
        .select("customer_id", "country", "revenue_365d", "churn_probability", "revenue_at_risk")
    )


def segment_share(rfm: DataFrame) -> DataFrame:
    """Customers and 365-day revenue per segment, with its share of the total of the few segments."""
    return (
        rfm.groupBy("segment")
        .agg(F.count("*").alias("customers"), money_sum("revenue_365d").alias("revenue_365d"))
        .withColumn("share", ratio(
            F.col("revenue_365d"),
            F.sum(F.col("revenue_365d").cast("decimal(28,2)")).over(Window.partitionBy())))
    )


def retention_scenarios(
    risk: DataFrame, shares: tuple[float, ...] = RETAINED_SHARES, size: int = CALL_LIST_SIZE
) -> DataFrame:
    """Revenue kept if calls retain a share of the call list's risk."""
    listed = call_list(risk, size).agg(money_sum("revenue_at_risk").alias("call_list_risk"))
    return listed.select(
        F.explode(F.array(*[F.lit(s) for s in shares])).alias("retained_share"), "call_list_risk",
    ).withColumn("retained_revenue", F.col("call_list_risk") * F.col("retained_share"))


def call_routing(risk: DataFrame, size: int = CALL_LIST_SIZE) -> DataFrame:
    """Who makes each call: Champions go to senior account managers."""
    called = risk.orderBy(F.desc("revenue_at_risk"), "customer_id").limit(size)
    return called.select(
        "customer_id", "segment", "revenue_at_risk",
        F.when(F.col("segment") == "Champions", "senior account manager")
        .otherwise("account manager").alias("caller"))


def risk_share(risk: DataFrame) -> DataFrame:
    """Revenue at risk as a part of the active customers' yearly spend."""
    return risk.agg(
        F.count("*").alias("customers"),
        money_sum("revenue_at_risk").alias("revenue_at_risk"),
        money_sum("revenue_365d").alias("revenue_365d"),
    ).withColumn("share", ratio(F.col("revenue_at_risk"), F.col("revenue_365d")))
