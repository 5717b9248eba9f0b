import pytest

from conftest import TESTDATA
from invoicelake.operators import churn, gold
from invoicelake.plans import questions, registry
from invoicelake.plans.workspace import Workspace
from invoicelake.sources.orders_model import derive_bronze


def test_scores_need_one_fit_and_their_record_a_second(spark, monkeypatch):
    fits = []
    train = churn.train
    monkeypatch.setattr(churn, "ROUNDS", 2)
    monkeypatch.setattr(churn, "train", lambda *args: fits.append(args) or train(*args))
    ws = Workspace(spark, TESTDATA)
    lists = registry.ON_SCORES["call_list"](ws, ws.model_scores).collect()
    assert registry.CHURN["model_nodes"](ws).count() > 0
    assert registry.CHURN["scoring_check"](ws).first().apart == 0
    assert registry.churn_model(ws).count() == 9
    assert len(fits) == 1
    risk = registry.CHURN["churn_risk"](ws)
    assert len(fits) == 2
    assert risk.select("model_run_id").distinct().first()[0] == ws.evaluation[1].first().run_id
    assert registry.ON_SCORES["call_list"](ws, risk).collect() == lists


@pytest.mark.parametrize("name, made", [
    ("high_risk", set()), ("top_risk", set()), ("total_risk", set()), ("at_risk_country", {"rfm"}), ("best_month", {"kpis"}),
    ("top_cancelled", {"products"})])
def test_a_question_makes_only_the_tables_it_reads(spark, name, made):
    found = set()

    class Tables:
        def __getattr__(self, table):
            found.add(table)
            return spark.createDataFrame([], {
                "rfm": "segment string, country string", "kpis": "month date, country string, gross_revenue double, "
                "cancelled_value double, net_revenue double, orders long, customers long, units long",
                "products": "stock_code string, description string, cancelled_value double"}[table])

    risk = spark.createDataFrame(
        [("a", "Norway", 2.0, 0.9, 1.8)],
        "customer_id string, country string, revenue_365d double, churn_probability double, revenue_at_risk double")
    questions.QUESTIONS[name](registry.Asked(Tables(), lambda ws: risk)).collect()
    assert found == made


def test_lines_are_joined_by_order_and_part_alone(spark):
    plan = derive_bronze(spark, TESTDATA)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if "Relation" in line and "l_linenumber" in line)
    depth, joins = len(plan[at]), 0
    for line in reversed(plan[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            depth = indent
            joins += "Join" in line
    assert joins == 2


def test_churn_risk_reads_the_lines_once_for_all_dates(spark, monkeypatch):
    asked, totals = [], gold._customer_totals
    monkeypatch.setattr(churn, "ROUNDS", 2)
    monkeypatch.setattr(gold, "_customer_totals", lambda silver, dates, horizon: asked.append(len(dates)) or totals(silver, dates, horizon))
    ws = Workspace(spark, TESTDATA)
    risk = registry.CHURN["churn_risk"](ws)
    assert risk.count() == ws.rfm.filter("recency_days <= 365").count() > 0
    assert asked == [3]
    assert ws.test_snapshot is ws.snapshots[1]
    apart = [gold.customer_features(ws.silver, ws.days["score_at"]),
             *[gold.churn_snapshot(ws.silver, ws.days[at]) for at in ("train_at", "test_at")]]
    for made, want in zip([ws.features, *ws.snapshots], apart):
        assert made.schema.simpleString() == want.schema.simpleString()
        assert made.count() == want.count() > 0 and made.exceptAll(want).count() == 0
