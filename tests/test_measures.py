import datetime as dt

import pytest

from invoicelake.operators import measures as m
from invoicelake.schema import MONTHLY_KPIS, PRODUCT_PERFORMANCE


def kpi(month, country, gross, cancelled, orders=1):
    return (dt.date.fromisoformat(month), country, gross, cancelled, orders, 1, 1, gross - cancelled)


@pytest.fixture(scope="module")
def kpis(spark):
    return spark.createDataFrame([
        kpi("2014-01-01", "Norway", 100.0, 10.0, 4), kpi("2014-01-01", "Spain", 300.0, 0.0, 1),
        kpi("2014-03-01", "Norway", 0.0, 5.0, 0), kpi("2015-01-01", "Norway", 800.0, 20.0, 2),
    ], MONTHLY_KPIS)


def test_ratios_are_ratios_of_sums(kpis):
    row = m.revenue_measures(kpis).first()
    assert (row.gross_revenue, row.cancelled_value, row.total_orders) == (1200.0, 35.0, 7)
    assert row.leakage == 35 / 1200 and row.avg_order_value == 1200 / 7
    assert m.revenue_measures(kpis, ["month"]).filter("month = '2014-03-01'").first().leakage is None


def test_calendar(kpis):
    days = m.calendar_of(kpis).collect()
    assert len(days) == 365 + 31 and days[0].date == dt.date(2014, 1, 1)
    first = next(d for d in days if d.date == dt.date(2014, 12, 25))
    assert (first.year, first.month, first.month_no) == (2014, "Dec 2014", 201412)


def test_calendar_months_without_facts_stay(kpis):
    months = m.by_calendar_month(m.calendar_of(kpis), kpis).collect()
    assert len(months) == 13 and sum(r.net_revenue is None for r in months) == 10


def test_yoy_blanks(kpis):
    rows = {str(r.date)[:7]: r.yoy for r in m.net_revenue_yoy(m.calendar_of(kpis), kpis).collect()}
    assert rows["2015-01"] == 1.0            # 390 -> 780
    assert rows["2014-01"] is None           # no prior year
    assert rows["2014-02"] is None


def test_yoy_of_a_month_that_vanished(spark):
    kpis = spark.createDataFrame([kpi("2014-01-01", "N", 100.0, 0.0), kpi("2015-02-01", "N", 1.0, 0.0)], MONTHLY_KPIS)
    rows = {str(r.date)[:7]: r.yoy for r in m.net_revenue_yoy(m.calendar_of(kpis), kpis).collect()}
    assert rows["2015-01"] == -1.0 and rows["2015-02"] is None


def test_slices_and_tops(kpis):
    assert m.year_slice(kpis, 2015).first().net_revenue == 780.0
    assert [r.country for r in m.top_countries(kpis, 1).collect()] == ["Norway"]


def test_product_tables(spark):
    products = spark.createDataFrame([
        ("1", "KETTLE", 1, 2000.0, 100.0, 1), ("2", "TEAPOT", 1, 900.0, 800.0, 1),
        ("3", "KETTLE", 1, 500.0, 0.0, 1), ("4", "SET OF 5", 1, 0.0, 7.0, 1)], PRODUCT_PERFORMANCE)
    assert [(r.description, r.product_cancel_rate) for r in m.cancel_rate_table(products).collect()] == [("KETTLE", 0.04)]
    assert [r.description for r in m.top_cancelled(products, 2).collect()] == ["TEAPOT", "KETTLE"]
    assert m.product_like(products, "%SET OF 5%").count() == 1


def test_risk_cards_count_the_threshold_itself(spark):
    risk = spark.createDataFrame([("a", 0.5, 10.0), ("b", 0.4999, 20.0)],
                                 "customer_id string, churn_probability double, revenue_at_risk double")
    row = m.risk_cards(risk).first()
    assert (row.active_customers, row.revenue_at_risk, row.high_risk_customers, row.high_risk_revenue) == (2, 30.0, 1, 10.0)
    assert m.risk_cards(risk, 0.9).first().high_risk_revenue == 0.0
