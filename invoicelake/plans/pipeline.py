"""The whole run: landing folder -> bronze -> silver -> gold -> churn scores, published by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake.operators import churn, gold, rfm, silver
from invoicelake.schema import (
    ACTIVE_DAYS, CHURN_RISK, FEATURES, HORIZON_DAYS, LABELLED, MIN_RETENTION, PRODUCT_CODE, RECENT_ORDER_DAYS, REJECT_RULES,
    SEGMENT_RULES, SILVER, conform)
from invoicelake.session import stage
from invoicelake.sources.catalog import (
    create_schema, documented, drop_old_versions, finished, publish_table, save_parquet, save_table, save_view, stage_key,
    version_name)
from invoicelake.sources.landing import landing_key, with_audit

COMMENTS = {
    "bronze_transactions": "Invoice lines as received, all text, with source file and time of ingestion",
    "lines": "One version of the typed, deduplicated, labelled lines; read it through the silver views",
    "silver_transactions": "Clean product sales and cancellations, one row per line; cancellations have a negative line_value",
    "silver_quarantine": "Lines kept out of silver, each with its reject_reason",
    "gold_monthly_kpis": "Additive measures per month and country",
    "gold_product_performance": "Lifetime totals per product",
    "gold_customer_rfm": "Behaviour, quintile scores and segment per customer at the snapshot date",
    "gold_customer_churn_risk": "Active customers: churn_probability for the next 90 days, revenue_at_risk = probability x revenue_365d",
    "model_runs": "One row per trained model: parameters and out-of-time metrics",
}

COLUMN_COMMENTS = {
    "invoice": "Invoice number; C marks a cancellation, A a bad-debt correction",
    "stock_code": "Product code in upper case; postage, fees and samples have codes of other forms",
    "description": "Product text as received",
    "quantity": "Units; below zero on cancellations",
    "invoice_ts": "Time of the invoice by the shop's clock",
    "invoice_date": "Day of the invoice; in bronze its time as received",
    "price": "Price of one unit",
    "customer_id": "Customer number; empty for sales without an account",
    "country": "Country of the customer",
    "is_cancellation": "Whether the invoice cancels an earlier sale",
    "reject_reason": "The first rule that keeps the line out of silver",
    "line_value": "quantity x price, rounded to the penny",
    "month": "First day of the month",
    "gross_revenue": "Value of sales before cancellations",
    "cancelled_value": "Value of cancellations, above zero",
    "net_revenue": "Sales less cancellations",
    "orders": "Distinct sales invoices",
    "customers": "Distinct buyers; not additive over months or countries",
    "units": "Units sold before cancellations",
    "units_sold": "Units sold before cancellations",
    "first_purchase": "Day of the first sale",
    "last_purchase": "Day of the last sale",
    "frequency": "Distinct sales invoices up to the snapshot",
    "monetary": "Net value up to the snapshot",
    "revenue_365d": "Net value of the last 365 days before the snapshot",
    "orders_90d": "Sales invoices of the last 90 days before the snapshot",
    "distinct_products": "Distinct products bought",
    "cancel_rate": "Cancelled invoices as a share of all invoices",
    "avg_order_value": "Net value per sales invoice",
    "recency_days": "Days from the last sale to the snapshot",
    "tenure_days": "Days from the first sale to the snapshot",
    "as_of": "Snapshot day; the features know nothing of it or later",
    "r_score": "Quintile of recency, 5 for the latest buyers",
    "f_score": "Quintile of frequency, 5 for the most orders",
    "m_score": "Quintile of value, 5 for the highest",
    "segment": "Name of the customer's group by its scores",
    "churn_probability": "Modelled probability of no sale in the next 90 days",
    "revenue_at_risk": "churn_probability x revenue_365d",
    "model_run_id": "Run of model_runs the score comes from",
    "_source_file": "Landed file the line was read from",
    "_ingested_at": "Time the line was read",
}

LAYERS = {"silver": SILVER, "quarantine": LABELLED}


def layered(labelled: DataFrame) -> DataFrame:
    """Labelled lines ready to be stored once, one folder per layer.

    One pass over bronze and one deduplication feed both silver and quarantine, and either is
    read by partition pruning. Lines are sorted by date inside each file, so that date filters
    skip row groups.
    """
    return silver.with_line_value(labelled).withColumn(
        "layer", F.when(F.col("reject_reason").isNull(), "silver").otherwise("quarantine")
    ).sortWithinPartitions("layer", "invoice_date")


def layer(stored: DataFrame, name: str) -> DataFrame:
    """One layer of the stored lines."""
    schema = LAYERS[name]
    return conform(stored.filter(F.col("layer") == name).select(*schema.names), schema)


def layer_counts(stored: DataFrame) -> DataFrame:
    """(reject_reason, lines) of the stored lines, clean lines under NULL: a one-column scan."""
    return stored.groupBy("reject_reason").agg(F.count("*").alias("lines"))


def publish_layer(spark: SparkSession, version: str, name: str, view: str, key: str = "") -> DataFrame:
    columns = LAYERS[name].names
    return save_view(spark, view, version, columns, f"layer = '{name}'", COMMENTS[view.split(".")[-1]], key)


def evaluate_model(
    clean: DataFrame, days: dict[str, dt.date], rounds: int = churn.ROUNDS,
    horizon: int = HORIZON_DAYS, notes: dict[str, str] | None = None, snapshots: tuple[DataFrame, DataFrame] | None = None,
    model: PipelineModel | None = None,
) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Train on the older snapshot, test on the newer: (newer snapshot, run record, metrics). ``notes`` go into the record
    with the parameters; ``snapshots`` are the older and the newer one, where they are stored already, and ``model`` is the
    fit on the older one, where it is there."""
    train_on, test_on = snapshots or stored_snapshots(clean, days, horizon)
    metrics = churn.evaluate(model or churn.train(train_on, rounds), test_on)
    params = churn.model_params(rounds) | {
        "train_snapshot": str(days["train_at"]), "test_snapshot": str(days["test_at"]),
        "horizon_days": horizon} | (notes or {})
    # stored, so that the record keeps its time and identifier on every later read
    record = stage(churn.run_record(clean, churn.new_run_id(), params, metrics), "model_run")
    return test_on, record, metrics


def stored_snapshots(
    clean: DataFrame, days: dict[str, dt.date], horizon: int = HORIZON_DAYS,
) -> tuple[DataFrame, DataFrame]:
    """The older and the newer snapshot, made in one pass and stored in a folder each."""
    dates = [days["train_at"], days["test_at"]]
    both = gold.churn_snapshots(clean, dates, horizon).withColumn("__at", F.col("as_of").cast("string"))
    stored = stage(both, "snapshots", partition_by="__at")
    return tuple(stored.filter(F.col("__at") == str(at)).drop("__at") for at in dates)


def stored_customers(
    clean: DataFrame, days: dict[str, dt.date], horizon: int = HORIZON_DAYS,
) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """The features of all customers at ``score_at`` and the two snapshots, made in one pass and stored in a folder each."""
    names = ["train_at", "test_at", "score_at"]
    every = gold.labelled_customers(clean, [days[n] for n in names], horizon).withColumn("__at", F.col("as_of").cast("string"))
    kept = every.filter((F.col("as_of") == F.lit(days["score_at"])) | (F.col("recency_days") <= ACTIVE_DAYS))
    stored = stage(kept, "customers", partition_by="__at")
    older, newer, latest = (stored.filter(F.col("__at") == str(days[n])).drop("__at") for n in names)
    return latest.drop("churned"), (older, newer)


def newest_snapshot(clean: DataFrame, days: dict[str, dt.date], horizon: int = HORIZON_DAYS) -> DataFrame:
    return stage(gold.churn_snapshot(clean, days["test_at"], horizon), "test_snapshot")


def earlier_record(spark: SparkSession, table: str, key: str) -> DataFrame | None:
    """The run record of an evaluation that an interrupted run has finished; the first, if there are several."""
    if not spark.catalog.tableExists(table):
        return None
    found = spark.table(table).filter(F.col("params")["stage_key"] == key).orderBy("created_at", "run_id").limit(1)
    return None if found.isEmpty() else found


def score_customers(
    model: PipelineModel, customers: DataFrame, record: DataFrame
) -> DataFrame:
    """Scores for the active base, each carrying the run it comes from."""
    return of_run(churn.score(model, gold.active_customers(customers)), record)


def of_run(scores: DataFrame, record: DataFrame) -> DataFrame:
    """Scores as they are published, with the run they come from."""
    return conform(scores.withColumn("model_run_id", F.lit(record.first().run_id)), CHURN_RISK)


def run_report(counts: DataFrame, days: dict[str, dt.date], metrics: dict[str, float]) -> DataFrame:
    """What a run did, as (section, name, value) rows."""
    rows = [("snapshot", k, str(v)) for k, v in days.items()]
    rows += [("metric", k, str(round(v, 4))) for k, v in metrics.items()]
    lines = counts.select(
        F.lit("lines").alias("section"), F.coalesce("reject_reason", F.lit("clean")).alias("name"),
        F.col("lines").cast("string").alias("value"))
    return lines.unionByName(
        counts.sparkSession.createDataFrame(rows, "section string, name string, value string"))


def run_pipeline(
    spark: SparkSession, landing: str, schema: str, gold_folder: str | None = None,
    rounds: int = churn.ROUNDS, minimum_retention: float = MIN_RETENTION,
    model_path: str | None = None, resume: bool = False,
) -> DataFrame:
    """Run every stage in order and return the run report.

    Nothing is replaced before the quality gate has passed, and churn scores are published only
    if the model beats the recency rule; the run record is kept either way.

    Every published view names the key of its stage: the landed files, the rules and the parameters it depends on, and
    the key of the stage before. With ``resume``, stages whose view shows their key are taken as they are, so a run
    after a lost driver does again only what was not finished.
    """
    def publish(name: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
        if resume and finished(spark, f"{schema}.{name}", key):
            return spark.table(f"{schema}.{name}")
        return publish_table(documented(make(), COLUMN_COMMENTS), f"{schema}.{name}", COMMENTS[name], key)

    create_schema(spark, schema, "Retail invoices: bronze, silver and gold tables")
    lines_key = stage_key("lines", landing_key(spark, landing), REJECT_RULES, PRODUCT_CODE, minimum_retention)
    gold_key = stage_key("gold", lines_key, ACTIVE_DAYS, RECENT_ORDER_DAYS, SEGMENT_RULES)
    model_key = stage_key("model", gold_key, FEATURES, rounds, HORIZON_DAYS, churn.model_params(rounds))
    # the silver view is switched last: where it shows the key, bronze and quarantine do
    if not (resume and finished(spark, f"{schema}.silver_transactions", lines_key)):
        write_lines(spark, landing, schema, minimum_retention, lines_key)
    lines = spark.table(f"{schema}.silver_transactions")
    counts = layer_counts(spark.table(f"{schema}.silver_quarantine")).unionByName(
        lines.agg(F.lit(None).cast("string").alias("reject_reason"), F.count("*").alias("lines")))

    days = gold.snapshot_days(lines)
    tables = {
        "gold_monthly_kpis": publish("gold_monthly_kpis", gold_key, lambda: gold.monthly_kpis(lines)),
        "gold_product_performance": publish(
            "gold_product_performance", gold_key, lambda: gold.product_performance(lines)),
    }
    customers = publish("gold_customer_rfm", gold_key, lambda: rfm.rfm_segments(
        stage(gold.customer_features(lines, days["score_at"]), "features")))
    tables["gold_customer_rfm"] = customers

    test_on, runs = None, f"{schema}.model_runs"
    record = earlier_record(spark, runs, model_key) if resume else None
    if record is None:
        test_on, record, metrics = evaluate_model(lines, days, rounds, HORIZON_DAYS, {"stage_key": model_key})
        save_table(record, runs, COMMENTS["model_runs"], mode="append")
    else:
        metrics = record.first().metrics
    churn.require_publishable(metrics)

    def scored() -> DataFrame:
        # refit on the newest labelled snapshot
        model = churn.train(newest_snapshot(lines, days) if test_on is None else test_on, rounds)
        if model_path:
            churn.save_model(model, model_path)
        return score_customers(model, customers, record)

    tables["gold_customer_churn_risk"] = publish(
        "gold_customer_churn_risk", stage_key("risk", model_key, model_path), scored)
    if gold_folder:
        for name, df in tables.items():
            save_parquet(df, f"{gold_folder.rstrip('/')}/{name}")
    report = run_report(counts, days, metrics)
    if gold_folder:
        report.write.mode("overwrite").json(f"{gold_folder.rstrip('/')}/run_report")
    return report


def write_lines(spark: SparkSession, landing: str, schema: str, minimum_retention: float, key: str) -> None:
    """A version of bronze and one of the labelled lines, which the three views are switched to once the gate has passed.

    A delivery that fails the gate leaves no version behind and no view changed."""
    raw, version = version_name(f"{schema}.bronze_transactions"), version_name(f"{schema}.lines")
    bronze = save_table(documented(with_audit(spark, landing), COLUMN_COMMENTS), raw, COMMENTS["bronze_transactions"])
    # documented before it is watched, so that the pass that writes the lines is the one that counts them
    watched, seen = silver.watched(documented(layered(silver.label_rows(bronze)), COLUMN_COMMENTS))
    save_table(watched, version, COMMENTS["lines"], partition_by="layer")
    try:
        silver.require_quality(silver.quality_gate(spark, seen, minimum_retention), minimum_retention)
    except silver.QualityGateFailed:
        for table in (version, raw):
            spark.sql(f"DROP TABLE {table}")
        raise
    save_view(spark, f"{schema}.bronze_transactions", raw, bronze.columns, "TRUE", COMMENTS["bronze_transactions"], key)
    # both layers are views of the version just checked: publishing copies no line
    publish_layer(spark, version, "quarantine", f"{schema}.silver_quarantine", key)
    publish_layer(spark, version, "silver", f"{schema}.silver_transactions", key)
    drop_old_versions(spark, schema, "bronze_transactions_")
    drop_old_versions(spark, schema, "lines_")
