"""A bronze extract derived from an orders/lineitem star schema, with every kind of bad line in it.

The hash ``h`` of a line's keys (0-99) decides what is wrong with it; see FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake.schema import BRONZE


def _text(column: Column) -> Column:
    return column.cast("string")


def spread(lines: DataFrame) -> DataFrame:
    """A table of fewer splits than cores is dealt out to all of them; a large one stays as it is."""
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines.repartition(cores) if lines.rdd.getNumPartitions() < cores else lines


def derive_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Join the star schema into text invoice lines. No hints: Spark sizes the small sides itself."""
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    orders = table("orders").select(
        F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("ck"),
        F.substring(_text(F.col("o_orderdate")), 1, 10).alias("day"),
    )
    lineitem = table("lineitem").select(
        F.col("l_orderkey").alias("ok"), F.col("l_partkey").alias("pk"),
        F.col("l_linenumber").alias("ln"), F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_returnflag").alias("rf"))
    # what hangs on an order is joined to the orders: lines are shuffled by order and by part, but not by customer too
    placed = orders.join(
        table("customer").select(F.col("c_custkey").alias("ck"), F.col("c_nationkey").alias("n_nationkey")), "ck"
    ).join(table("nation").select("n_nationkey", "n_name"), "n_nationkey")
    base = (
        spread(lineitem)
        .join(placed, "ok")
        .join(table("part").select(F.col("p_partkey").alias("pk"), "p_name"), "pk")
    )
    h, ok, pk = F.col("h"), F.col("ok"), F.col("pk")
    cancel = (F.col("rf") == "R") & (ok % 5 == 0)
    code = _text(10000 + pk)
    lines = (
        base.withColumn("h", (ok * 7 + pk * 3 + F.col("ln") * 11) % 100)
        # h = 8 lands twice; one explode instead of a second pass over the joins
        .withColumn("copy", F.explode(F.when(h == 8, F.array(F.lit(1), F.lit(2)))
                                      .otherwise(F.array(F.lit(1)))))
        .select(
            F.when(h == 0, F.concat(F.lit("A"), _text(ok)))
            .when(cancel, F.concat(F.lit("C"), _text(ok)))
            .otherwise(_text(ok)).alias("invoice"),
            F.when(h == 1, "POST").when(h == 2, "m")
            .when(pk % 7 == 0, F.concat(F.lit(" "), code, F.lit("a ")))
            .otherwise(code).alias("stock_code"),
            F.concat("p_name", F.lit(" ")).alias("description"),
            F.when(h == 3, "abc")
            .when((cancel & (h != 4)) | (~cancel & (h == 4)), _text(-F.col("qty")))
            .otherwise(_text(F.col("qty"))).alias("quantity"),
            F.when(h == 7, "not a date").otherwise(
                F.concat("day", F.lit(" "), F.lpad(_text(8 + h % 10), 2, "0"), F.lit(":00:00"))
            ).alias("invoice_date"),
            F.when(h == 5, "0").when(h == 6, "").otherwise(
                F.concat(_text(1 + pk % 20), F.lit("."), F.lpad(_text(pk % 100), 2, "0"))
            ).alias("price"),
            F.when(ok % 20 != 0, _text(F.col("ck"))).alias("customer_id"),
            F.col("n_name").alias("country"),
        )
    )
    # planted keying errors: 80,000 units, reversed 12 minutes later; some reversed twice, some a minute too late, and some
    # with a second error and reversal in between
    def event(sale: bool, at: str, suffix: str = "") -> Column:
        return F.struct(
            F.lit("" if sale else "C").alias("mark"), F.lit("80000" if sale else "-80000").alias("units"),
            F.lit(f" {at}:00").alias("at"), F.lit(suffix).alias("suffix"))

    usual = [event(True, "09:15"), event(False, "09:27")]
    error = F.explode(
        F.when(ok % 4000 == 3, F.array(*usual, event(False, "09:28", "b")))
        .when(ok % 4000 == 1003, F.array(*usual, event(True, "10:00", "n"), event(False, "10:17", "n")))
        .when(ok % 4000 == 2003, F.array(*usual, event(True, "09:20", "s"), event(False, "09:30", "s")))
        .otherwise(F.array(*usual)))
    planted = (
        orders.filter(ok % 1000 == 3)
        .select("*", error.alias("e"))
        .select(
            F.concat("e.mark", _text(900000000 + ok), "e.suffix").alias("invoice"),
            F.lit("23843").alias("stock_code"), F.lit("PAPER CRAFT").alias("description"),
            F.col("e.units").alias("quantity"), F.concat("day", "e.at").alias("invoice_date"),
            F.lit("2.08").alias("price"), _text(F.col("ck")).alias("customer_id"),
            F.lit("NATION_0").alias("country"),
        )
    )
    return lines.unionByName(planted).select(*BRONZE.names)
