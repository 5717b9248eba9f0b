"""Every query by name, over the tables of a folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoicelake.operators import churn, compare, findings, gold, measures, rfm, screening, silver, tree_scoring
from invoicelake.plans import pipeline, questions
from invoicelake.plans.workspace import Workspace, over
from invoicelake.schema import FEATURES
from invoicelake.session import stage, staging_path
from invoicelake.sources import catalog, landing
from invoicelake.sources.catalog import register_gold_folder, save_parquet
from invoicelake.sources.landing import read_extract_lines, read_text_extract, union_extracts, with_audit

YEAR = 2000
HOME = "NATION_0"


def published(df: DataFrame) -> DataFrame:
    """Exact money as DOUBLE, the type the published tables have."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name) for f in df.schema.fields])


def bronze_union(ws: Workspace) -> DataFrame:
    """Two extracts in different formats, one per invoice parity, stacked as text."""
    csv, parquet = staging_path(ws.spark, "extract_csv"), staging_path(ws.spark, "extract_parquet")
    even = F.coalesce(F.length("invoice") % 2 == 0, F.lit(False))
    ws.bronze.filter(even).write.csv(
        csv, header=True, quote='"', escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    other = ws.bronze.filter(~even)
    other.toDF(*[f"Column {i}" for i, _ in enumerate(other.columns)]).write.parquet(parquet)
    return union_extracts([
        read_text_extract(ws.spark, csv), read_text_extract(ws.spark, parquet, "parquet"),
    ])


def extract_lines(ws: Workspace) -> DataFrame:
    """Files of different headings in one folder: quoted line breaks, blank cells, and lines cut short."""
    folder, key = staging_path(ws.spark, "extract_lines"), F.col("o_orderkey")
    orders = ws.table("orders").select("o_orderkey")
    text = key.cast("string")
    note = F.when(key % 3 == 0, 'two\nlines, "quoted"').when(key % 3 == 1, "plain").otherwise("")
    whole = orders.filter(key % 5 != 0).select(
        text.alias("Number"), F.lit("71001").alias("Code"), note.alias("What"), F.lit("1").alias("Units"),
        F.lit("2015-01-01").alias("On"), F.lit("2.5").alias("At"), F.lit("c").alias("For"), F.lit("Norway").alias("In"))
    cut = orders.filter(key % 5 == 0).select(text.alias("Invoice"), F.lit("cut short").alias("Rest"))
    for lines in (whole, cut):
        lines.write.mode("append").csv(folder, header=True, quote='"', escape='"', emptyValue="")
    return read_extract_lines(ws.spark, folder).select("invoice", "description", F.col("_damaged").alias("damaged"))


def bronze_audit(ws: Workspace) -> DataFrame:
    return with_audit(ws.spark, ws.landing)


def bronze_provenance(ws: Workspace) -> DataFrame:
    """The audited rows with what can be said of their audit columns in every run."""
    return bronze_audit(ws).withColumns({
        "from_landing": F.contains(F.col("_source_file"), F.lit(ws.landing.rsplit("/", 1)[-1])),
        "has_time": F.col("_ingested_at").isNotNull()}).drop("_source_file", "_ingested_at")


def landing_status(ws: Workspace) -> DataFrame:
    """Two deliveries into one folder, of which bronze has loaded the first, with the even lengths of invoice numbers."""
    folder = staging_path(ws.spark, "deliveries")
    even = F.coalesce(F.length("invoice") % 2 == 0, F.lit(False))
    ws.bronze.filter(even).write.parquet(folder)
    bronze = stage(with_audit(ws.spark, folder), "first_delivery")
    ws.bronze.filter(~even).write.mode("append").parquet(folder)
    return landing.landing_status(landing.landing_manifest(ws.spark, folder), bronze)


def data_dictionary(ws: Workspace) -> DataFrame:
    """Comments and filled rows of every column, read back from the catalog's silver and gold tables."""
    schema = f"dictionary_{uuid.uuid4().hex[:12]}"
    tables = {"silver_transactions": ws.silver, "gold_monthly_kpis": ws.kpis,
              "gold_product_performance": ws.products, "gold_customer_rfm": ws.rfm}
    catalog.create_schema(ws.spark, schema, "Tables of one data dictionary")
    for name, df in tables.items():
        catalog.publish_table(
            catalog.documented(df, pipeline.COLUMN_COMMENTS), f"{schema}.{name}", pipeline.COMMENTS[name])
    found = stage(catalog.data_dictionary(ws.spark, schema, list(tables)), "data_dictionary")
    ws.spark.sql(f"DROP SCHEMA `{schema}` CASCADE")
    return found.select("table_name", "column_name", "comment", "filled")


def parquet_sink(ws: Workspace) -> DataFrame:
    return save_parquet(ws.kpis, staging_path(ws.spark, "sink"))


def gold_views(ws: Workspace) -> DataFrame:
    """Rows of every gold table, stored in one folder and read back by name."""
    folder = staging_path(ws.spark, "gold")
    for name, df in ws.gold_tables().items():
        save_parquet(df, f"{folder}/{name}")
    return ws.spark.sql(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS table_rows FROM {name}"
        for name in register_gold_folder(ws.spark, folder)))


def oot_snapshots(ws: Workspace) -> DataFrame:
    """Both labelled snapshots of the out-of-time split."""
    return gold.churn_snapshot(ws.silver, ws.days["train_at"]).withColumn("split", F.lit("train")).unionByName(
        gold.churn_snapshot(ws.silver, ws.days["test_at"]).withColumn("split", F.lit("test")))


def sql_log(ws: Workspace) -> DataFrame:
    """Texts to screen: statements written about every part, and every chat message."""
    key, name = F.col("p_partkey"), F.col("p_name")
    read = F.concat(F.lit("SELECT stock_code FROM gold_product_performance WHERE description LIKE '%"), name, F.lit("%'"))
    kind = key % 10
    statement = (
        F.when(kind == 0, read)
        .when(kind == 1, F.concat(read, F.lit(" LIMIT "), key.cast("string")))
        .when(kind == 2, F.concat(F.lit("```sql\n"), read, F.lit(";\n```")))
        .when(kind == 3, F.concat(F.lit("DELETE FROM gold_product_performance WHERE description = '"), name, F.lit("'")))
        .when(kind == 4, F.concat(read, F.lit("; DROP TABLE gold_customer_rfm")))
        .when(kind == 5, F.concat(read, F.lit(" -- all of them")))
        .when(kind == 6, F.concat(
            F.lit("WITH x AS (SELECT 'drop it; it''s -- "), name,
            F.lit("' AS note) SELECT * FROM x limit 1"), key.cast("string")))
        .when(kind == 7, F.concat(F.lit("SELECT `reflect`('java.lang.System', 'getProperty', '"), name, F.lit("')")))
        .when(kind == 8, F.concat(F.lit("SELECT * FROM `TEXT`.`/landing/"), name, F.lit("`")))
        .otherwise(F.lit("  "))
    )
    return ws.table("part").select(
        F.concat(F.lit("part-"), key.cast("string")).alias("query_id"), statement.alias("sql")
    ).unionByName(ws.table("conversations").select(
        F.concat(F.lit("chat-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
        .alias("query_id"), F.col("text").alias("sql")))


def result_match(ws: Workspace) -> DataFrame:
    """Country totals from the gold table against the same from silver: renamed, reordered, widened."""
    reference = measures.revenue_measures(ws.kpis, ["country"]).select("country", "gross_revenue")
    result = (
        ws.silver.groupBy("country")
        .agg(F.sum(F.when(~F.col("is_cancellation"), F.col("line_value"))).alias("total"),
             F.count("*").alias("lines"))
        .select("lines", (F.col("total") * 1.001).alias("total"), F.col("country").alias("Nation"))
    )
    return compare.column_matches(reference, result)


def eval_outcomes(ws: Workspace) -> DataFrame:
    # the cases of this package are read by the driver: executors may not have its files
    cases = ws.spark.createDataFrame(
        json.loads((Path(__file__).parent / "eval_cases.json").read_text()), questions.CASE)
    return questions.score_answers(ws.spark, cases, ws.gold_tables())


def publish_gate(ws: Workspace) -> DataFrame:
    metrics = F.col("metrics")
    return ws.evaluation[1].select(
        metrics["auc"].alias("auc"), metrics["baseline_recency_auc"].alias("baseline_recency_auc"),
        F.lit(churn.publishable(ws.evaluation[2])).alias("publishable"))


def model_eval(ws: Workspace) -> DataFrame:
    return ws.evaluation[1].select(*[
        F.col("metrics")[name].alias(name) for name in ws.evaluation[2]])


def churn_model(ws: Workspace) -> DataFrame:
    """Importance of every feature in the fitted trees."""
    weights = ws.model.stages[-1].featureImportances.toArray().tolist()
    return ws.spark.range(1).select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(f) for f in FEATURES]), F.array(*[F.lit(w) for w in weights])))
        .alias("feature", "importance"))


class Asked:
    """The gold tables of a workspace for one question (see ``questions.Gold``): only those it reads are made."""

    year, home = YEAR, HOME

    def __init__(self, ws: Workspace, risk: Callable[[Workspace], DataFrame] | None):
        self._ws, self._risk = ws, risk

    @property
    def kpis(self) -> DataFrame:
        return self._ws.kpis

    @property
    def products(self) -> DataFrame:
        return self._ws.products

    @property
    def rfm(self) -> DataFrame:
        return self._ws.rfm

    @property
    def risk(self) -> DataFrame | None:
        return self._risk(self._ws) if self._risk else None


def ask(name: str, risk: Callable[[Workspace], DataFrame] | None = None):
    return over(lambda ws: questions.QUESTIONS[name](Asked(ws, risk)))


BRONZE_AND_SILVER = {
    "bronze_scan": lambda ws: ws.bronze,
    "bronze_audit": bronze_audit,
    "bronze_provenance": bronze_provenance,
    "bronze_union": bronze_union,
    "landing_status": landing_status,
    "extract_lines": extract_lines,
    "dedupe_lines": lambda ws: published(silver.dedupe_lines(ws.bronze)),
    "label_rows": lambda ws: published(ws.labelled),
    "silver": lambda ws: published(silver.to_silver(ws.labelled)),
    "quarantine": lambda ws: published(silver.to_quarantine(ws.labelled)),
    "reject_report": lambda ws: silver.reject_report(ws.labelled),
    "retention": lambda ws: silver.retention(ws.labelled),
    "quality_gate": lambda ws: silver.quality_gate(ws.spark, ws.written[1]),
    "split_reconcile": lambda ws: silver.split_reconcile(
        ws.written[1], {name: pipeline.layer(ws.lines, name) for name in ("silver", "quarantine")}),
}

GOLD = {
    "monthly_kpis": lambda ws: gold.monthly_kpis(ws.silver),
    "product_performance": lambda ws: gold.product_performance(ws.silver),
    "snapshot_dates": lambda ws: gold.snapshot_dates(ws.silver),
    "customer_features": lambda ws: gold.customer_features(ws.silver, ws.days["score_at"]),
    "active_customers": lambda ws: gold.active_customers(ws.features),
    "returned_customers": lambda ws: gold.returned_customers(ws.silver, ws.days["test_at"]),
    "churn_snapshot": lambda ws: gold.churn_snapshot(ws.silver, ws.days["test_at"]),
    "churned_anti": lambda ws: gold.churned_customers(ws.silver, ws.days["test_at"]),
    "retained_semi": lambda ws: gold.retained_customers(ws.silver, ws.days["test_at"]),
    "oot_snapshots": oot_snapshots,
    "rfm_scores": lambda ws: rfm.rfm_scores(ws.features).select(
        "customer_id", "r_score", "f_score", "m_score"),
    "rfm_segments": lambda ws: rfm.rfm_segments(ws.features),
    "segment_rollup": lambda ws: rfm.segment_rollup(ws.rfm),
}

CHURN = {
    "churn_base_rate": lambda ws: churn.churn_base_rate(ws.test_snapshot),
    "recency_auc": lambda ws: churn.recency_auc(ws.test_snapshot),
    "top_decile": lambda ws: churn.top_decile_precision(ws.test_snapshot),
    "risk_by_rate": lambda ws: churn.risk_by_rate(ws.test_snapshot, ws.rfm),
    "churn_model": churn_model,
    "scoring_check": lambda ws: churn.scoring_check(ws.model, gold.active_customers(ws.rfm)),
    "model_nodes": lambda ws: tree_scoring.nodes(ws.rfm, ws.model.stages[-1], FEATURES),
    "model_eval": model_eval,
    "model_runs": lambda ws: ws.evaluation[1],
    "publish_gate": publish_gate,
    "churn_risk": lambda ws: ws.model_risk,
    "run_report": lambda ws: pipeline.run_report(
        pipeline.layer_counts(ws.lines), ws.days, ws.evaluation[2]),
}

MEASURES = {
    "calendar": lambda ws: measures.calendar_of(ws.kpis),
    "calendar_kpis": lambda ws: measures.by_calendar_month(measures.calendar_of(ws.kpis), ws.kpis),
    "bi_overview": lambda ws: measures.revenue_measures(ws.kpis),
    "bi_leakage_by_month": lambda ws: measures.by_calendar_month(
        measures.calendar_of(ws.kpis), ws.kpis).select("date", "month", "month_no", "leakage"),
    "bi_yoy": lambda ws: measures.net_revenue_yoy(measures.calendar_of(ws.kpis), ws.kpis),
    "bi_year_slice": lambda ws: measures.year_slice(ws.kpis, YEAR),
    "bi_top_countries": lambda ws: measures.top_countries(ws.kpis),
    "bi_top_cancelled": lambda ws: measures.top_cancelled(ws.products),
    "bi_cancel_rate_table": lambda ws: measures.cancel_rate_table(ws.products),
    "bi_segment_counts": lambda ws: measures.segment_counts(ws.rfm),
    "product_like": lambda ws: measures.product_like(ws.products, "%widget%"),
}

FINDINGS = {
    "reversal_pairs": lambda ws: findings.reversal_pairs(ws.silver),
    "reversal_share": lambda ws: findings.reversal_share(ws.pairs, ws.kpis),
    "leakage_adjusted": lambda ws: findings.leakage_adjusted(ws.pairs, ws.kpis),
    "order_entry_check": lambda ws: published(findings.order_entry_check(ws.silver)),
    "segment_share": lambda ws: findings.segment_share(ws.rfm),
}

# Each of these runs on the model's scores and, as <name>_by_rate, on scores that SQL can check.
ON_SCORES = {
    "bi_risk_cards": lambda ws, risk: measures.risk_cards(risk),
    "bi_scatter": lambda ws, risk: measures.risk_scatter(risk),
    "call_list": lambda ws, risk: findings.call_list(risk),
    "risk_concentration": lambda ws, risk: findings.risk_concentration(risk),
    "winback_list": lambda ws, risk: findings.winback_list(risk),
    "retention_scenarios": lambda ws, risk: findings.retention_scenarios(risk),
    "call_routing": lambda ws, risk: findings.call_routing(risk),
    "risk_share": lambda ws, risk: findings.risk_share(risk),
}

SINKS = {"parquet_sink": parquet_sink, "gold_views": gold_views, "data_dictionary": data_dictionary}

CHECKS = {
    "screen_queries": lambda ws: screening.screen_queries(sql_log(ws)),
    "result_match": result_match,
    "eval_cases": eval_outcomes,
    "eval_accuracy": lambda ws: compare.accuracy(eval_outcomes(ws)),
}

RISK_QUESTIONS = ("total_risk", "top_risk", "high_risk")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for group in (BRONZE_AND_SILVER, GOLD, CHURN, MEASURES, FINDINGS, SINKS, CHECKS):
        named |= {name: over(query) for name, query in group.items()}
    for name, query in ON_SCORES.items():
        named[name] = over(lambda ws, q=query: q(ws, ws.model_scores))
        named[f"{name}_by_rate"] = over(lambda ws, q=query: q(ws, ws.rate_risk))
    for name in questions.QUESTIONS:
        if name in RISK_QUESTIONS:
            named[f"q_{name}"] = ask(name, lambda ws: ws.model_scores)
            named[f"q_{name}_by_rate"] = ask(name, lambda ws: ws.rate_risk)
        else:
            named[f"q_{name}"] = ask(name)
    return named
