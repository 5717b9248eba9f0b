import time

import pytest

from invoicelake.operators import churn, silver as s
from invoicelake.plans import pipeline, questions
from invoicelake.plans.workspace import Workspace
from conftest import TESTDATA


@pytest.fixture(scope="module")
def landing(spark):
    return Workspace.of(spark, TESTDATA).landing


def test_full_run(spark, landing, tmp_path, monkeypatch):
    monkeypatch.setattr(churn, "publishable", lambda metrics: True)
    report = pipeline.run_pipeline(spark, landing, "spark_catalog.full", str(tmp_path / "gold"), rounds=2,
                                   model_path=str(tmp_path / "model"))
    values = {(r.section, r.name): r.value for r in report.collect()}
    assert values["lines", "clean"] == "5525" and values["lines", "unparseable"] == "198"
    assert values["snapshot", "score_at"] == "2001-08-02"
    assert spark.table("full.bronze_transactions").count() == 6068
    clean, rejected = spark.table("full.silver_transactions"), spark.table("full.silver_quarantine")
    assert (clean.count(), rejected.count()) == (5525, 482)
    risk = spark.table("full.gold_customer_churn_risk")
    run = spark.table("full.model_runs").first()
    assert risk.filter(f"model_run_id = '{run.run_id}'").count() == risk.count() > 0
    assert run.params["train_snapshot"] == "2001-02-03"
    for name in ("gold_monthly_kpis", "gold_product_performance", "gold_customer_rfm", "gold_customer_churn_risk"):
        stored = spark.read.parquet(str(tmp_path / "gold" / name))
        assert stored.exceptAll(spark.table(f"full.{name}")).count() == 0 and stored.count() > 0
    assert spark.read.json(str(tmp_path / "gold" / "run_report")).count() == report.count()
    assert churn.load_model(str(tmp_path / "model")).stages
    for name in pipeline.COMMENTS.keys() - {"lines", "model_runs"}:
        described = {c.name: c.description for c in spark.catalog.listColumns(f"full.{name}")}
        assert described == {c: pipeline.COLUMN_COMMENTS[c] for c in described}


def test_bad_extract_replaces_nothing(spark, landing):
    with pytest.raises(s.QualityGateFailed):
        pipeline.run_pipeline(spark, landing, "gated", rounds=1, minimum_retention=0.99)
    assert not spark.catalog.tableExists("gated.silver_transactions")
    assert not spark.catalog.tableExists("gated.silver_quarantine")
    assert spark.catalog.listTables("gated") == []      # neither views nor versions of the refused delivery


def test_rerun_switches_to_the_new_version(spark, bronze, tmp_path, monkeypatch):
    def stop(*args):
        raise churn.PublishRefused("enough")
    monkeypatch.setattr(pipeline, "evaluate_model", stop)
    bronze.coalesce(1).write.parquet(str(tmp_path / "landing"))
    for run in range(4):
        with pytest.raises(churn.PublishRefused):
            pipeline.run_pipeline(spark, str(tmp_path / "landing"), "again", minimum_retention=0.5)
        bronze.limit(1).selectExpr(
            f"'9{run}' AS invoice", *bronze.columns[1:]).write.mode("append").parquet(str(tmp_path / "landing"))
    versions = [t.name for t in spark.catalog.listTables("again") if t.name.startswith("lines_")]
    assert len(versions) == 2
    assert len([t for t in spark.catalog.listTables("again") if t.name.startswith("bronze_transactions_")]) == 2
    delivered = spark.table("again.bronze_transactions").count()
    bronze.selectExpr("'bad' AS invoice", *bronze.columns[1:]).write.mode("append").parquet(str(tmp_path / "landing"))
    with pytest.raises(s.QualityGateFailed):
        pipeline.run_pipeline(spark, str(tmp_path / "landing"), "again", minimum_retention=0.999)
    assert spark.table("again.bronze_transactions").count() == delivered == bronze.count() + 3
    assert spark.table("again.silver_transactions").count() == 9
    assert spark.table("again.silver_quarantine").count() == 5


def test_a_resumed_run_does_only_what_was_not_finished(spark, landing, tmp_path, monkeypatch):
    monkeypatch.setattr(churn, "publishable", lambda metrics: True)
    done, lost = [], {"scores"}
    def watch(owner, name, label):
        inner = getattr(owner, name)
        def run(*args, **kwargs):
            done.append(label)
            if label in lost:
                raise RuntimeError(f"the driver is lost before {label}")
            return inner(*args, **kwargs)
        monkeypatch.setattr(owner, name, run)
    for owner, name, label in (
            (pipeline, "write_lines", "lines"), (pipeline.gold, "monthly_kpis", "kpis"),
            (pipeline.gold, "product_performance", "products"), (pipeline.rfm, "rfm_segments", "customers"),
            (pipeline, "evaluate_model", "model"), (pipeline, "score_customers", "scores")):
        watch(owner, name, label)
    folder = str(tmp_path / "landing")
    spark.read.parquet(landing).write.parquet(folder)
    run = lambda rounds=1: pipeline.run_pipeline(spark, folder, "resumed", rounds=rounds, resume=True)
    every = ["lines", "kpis", "products", "customers", "model", "scores"]
    with pytest.raises(RuntimeError, match="before scores"):
        run()
    assert done == every
    lost, done[:] = set(), []
    first = sorted(map(tuple, run().collect()))
    assert done == ["scores"] and spark.table("resumed.model_runs").count() == 1
    done.clear()
    assert sorted(map(tuple, run().collect())) == first and done == []         # nothing is left to do
    run(rounds=2)
    assert done == ["model", "scores"]                                         # another parameter of the model
    done.clear()
    one = spark.read.parquet(landing).limit(1)
    one.selectExpr("'777777' AS invoice", *one.columns[1:]).write.mode("append").parquet(folder)
    run(rounds=2)
    assert done == every                                                       # another delivery


def test_weak_model_publishes_no_scores(spark, landing, monkeypatch):
    monkeypatch.setattr(churn, "publishable", lambda metrics: False)
    with pytest.raises(churn.PublishRefused):
        pipeline.run_pipeline(spark, landing, "refused", rounds=1)
    assert spark.table("refused.model_runs").count() == 1
    assert spark.table("refused.gold_customer_rfm").count() > 0
    assert not spark.catalog.tableExists("refused.gold_customer_churn_risk")


def test_candidates_are_scored(spark, tmp_path):
    tables = {"gold_t": spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")}
    (tmp_path / "cases.json").write_text("""[
      {"question": "right", "sql": "SELECT SUM(v) AS s FROM gold_t", "candidate": "SELECT MIN(k) AS k, SUM(v) AS total FROM gold_t"},
      {"question": "wrong", "sql": "SELECT SUM(v) AS s FROM gold_t", "candidate": "SELECT MAX(v) AS s FROM gold_t"},
      {"question": "unsafe", "sql": "SELECT SUM(v) AS s FROM gold_t", "candidate": "DROP TABLE gold_t"},
      {"question": "broken", "sql": "SELECT SUM(v) AS s FROM gold_t", "candidate": "SELECT nothing FROM gold_t"}]""")
    cases = questions.read_cases(spark, str(tmp_path / "cases.json"))
    outcomes = questions.score_answers(spark, cases, tables)
    assert {r.question: r.ok for r in outcomes.collect()} == {
        "right": True, "wrong": False, "unsafe": False, "broken": False}
    questions.write_outcomes(outcomes, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 4


def test_a_runaway_case_is_stopped_and_the_others_are_scored(spark):
    endless = "SELECT sum(a.id * b.id % 7) AS s FROM range(100000000) a JOIN range(100000000) b ON a.id <> b.id"
    cases = spark.createDataFrame(
        [("endless", "SELECT 1 AS s", endless), ("file", "SELECT 1 AS s", "SELECT * FROM `Text`.`/etc/hostname`")]
        + [(f"case {i}", f"SELECT id FROM shown WHERE id > {i}", f"SELECT id AS n FROM shown WHERE id >= {i + 1 + i // 5}")
           for i in range(6)], questions.CASE)
    begin = time.monotonic()
    found = {r.question: r for r in questions.score_answers(spark, cases, {"shown": spark.range(20)}, 3, 8).collect()}
    assert [found[f"case {i}"].ok for i in range(6)] == [True] * 5 + [False]
    assert not found["endless"].ok and "not done within" in found["endless"].sql
    assert not found["file"].ok and found["file"].sql.startswith("BLOCKED")
    assert time.monotonic() - begin < 120
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
