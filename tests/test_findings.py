import datetime as dt

import pytest

from invoicelake.operators import findings as f
from invoicelake.operators import gold, silver as s
from invoicelake.schema import BRONZE

START = dt.datetime(2015, 3, 8, 9, 0)


def lines_to_silver(spark, lines):
    return s.to_silver(s.label_rows(spark.createDataFrame(lines, BRONZE)))


def line(invoice, minutes, units, customer="x", code="71001", price="2"):
    at = START + dt.timedelta(minutes=minutes)
    return (invoice, code, "t", str(units), at.strftime("%Y-%m-%d %H:%M:%S"), price, customer, "Norway")


def brute_force(rows):
    """Every cancellation takes the last sale that is left, if it is at most 16 minutes old."""
    found, open_sales = [], {}
    known = [r for r in rows if r.customer_id and r.stock_code]
    for r in sorted(known, key=lambda r: (r.invoice_ts, r.is_cancellation, r.invoice, r.line_value)):
        left = open_sales.setdefault((r.customer_id, r.stock_code, abs(r.quantity)), [])
        if not r.is_cancellation:
            left.append(r)
        elif left and r.invoice_ts - left[-1].invoice_ts <= dt.timedelta(minutes=16):
            sale = left.pop()
            found.append((sale.invoice, r.invoice, sale.invoice_ts, r.invoice_ts))
    return sorted(found)


def test_window_borders(spark):
    clean = lines_to_silver(spark, [
        line("1", 0, 5), line("C1", 16, -5),                       # exactly 16 minutes: a pair
        line("2", 0, 6), line("C2", 16.1, -6),                     # a moment too late
        line("C3", 0, -7), line("3", 1, 7),                        # cancelled before it was sold
        line("4", 3, 8), line("C4", 3, -8),                        # the same instant: a pair
        line("5", 0, 9, customer=None), line("C5", 1, -9, customer=None),
        line("6", 0, 10), line("C6", 1, -10, code="71002"),
    ])
    assert {(r.sale_invoice, r.cancel_invoice) for r in f.reversal_pairs(clean).collect()} == {("1", "C1"), ("4", "C4")}


def test_a_sale_is_undone_once_and_the_last_one_first(spark):
    clean = lines_to_silver(spark, [
        line("1", 0, 5), line("C1", 5, -5), line("C2", 6, -5),                                  # cancelled twice
        line("3", 0, 6), line("4", 4, 6), line("C4", 8, -6), line("C3", 9, -6),                 # one inside the other
        line("5", 0, 7), line("6", 10, 7), line("C6", 12, -7), line("C5", 17, -7),              # the outer one is too late
        line("C7", 0, -8), line("7", 1, 8), line("C8", 2, -8),                                  # nothing to undo at first
    ])
    assert {(r.sale_invoice, r.cancel_invoice) for r in f.reversal_pairs(clean).collect()} == {
        ("1", "C1"), ("4", "C4"), ("3", "C3"), ("6", "C6"), ("7", "C8")}


def test_pairs_equal_brute_force(spark, rng):
    lines = [
        line(f"{'C' if sign < 0 else ''}{i}", rng.randrange(0, 400) / 4, sign * rng.choice([1, 2]),
             customer=rng.choice("xy"), price=rng.choice(["1", "2"]))
        for i in range(160) for sign in [rng.choice([1, 1, -1])]]
    lines += [line("7", 5, 1), line("7", 5, 1, price="3"), line("8", 5, 1)]  # many sales at one instant
    clean = lines_to_silver(spark, lines)
    pairs = f.reversal_pairs(clean)
    got = sorted((r.sale_invoice, r.cancel_invoice, r.sale_ts, r.cancel_ts) for r in pairs.collect())
    assert got == brute_force(clean.collect()) and len(got) > 20


def test_busy_key_emits_one_row_per_cancellation(spark):
    lines = [line(str(i), i % 90, 1) for i in range(600)] + [line(f"C{i}", i % 90, -1) for i in range(300)]
    assert f.reversal_pairs(lines_to_silver(spark, lines)).count() == 300


def test_leakage_without_the_errors(spark):
    clean = lines_to_silver(spark, [
        line("1", 0, 1000), line("C1", 5, -1000), line("2", 0, 10), line("C2", 2000, -1)])
    kpis, pairs = gold.monthly_kpis(clean), f.reversal_pairs(clean)
    year, = f.leakage_adjusted(pairs, kpis).collect()
    assert year.year == 2015 and year.leakage_reported == 2002 / 2020 and year.leakage_adjusted == 2 / 20
    share = f.reversal_share(pairs, kpis).first()
    assert (share.pairs, share.flagged_value, share.share) == (1, 2000.0, 2000 / 2002)


def test_one_sale_undone_twice_is_taken_off_once(spark):
    clean = lines_to_silver(spark, [line("1", 0, 4), line("C1", 5, -4), line("C2", 6, -4), line("2", 0, 10)])
    year, = f.leakage_adjusted(f.reversal_pairs(clean), gold.monthly_kpis(clean)).collect()
    assert year.leakage_adjusted == 8 / 20 and year.leakage_reported == 16 / 28


def test_entry_check(spark):
    clean = lines_to_silver(spark, [
        line("1", 0, 5000), line("2", 0, 5001), line("3", 0, 100, price="100"), line("4", 0, 100, price="100.01"),
        line("C5", 0, -9000)])
    assert {r.invoice for r in f.order_entry_check(clean).collect()} == {"2", "4"}


@pytest.fixture(scope="module")
def risk(spark):
    rows = [(f"c{i:03d}", "Norway", 1000.0 + i, 0.9 if i % 2 else 0.2, float(i), "Champions" if i > 195 else "Loyal")
            for i in range(200)]
    return spark.createDataFrame(
        rows, "customer_id string, country string, revenue_365d double, churn_probability double, "
              "revenue_at_risk double, segment string").cache()


def test_call_and_winback_lists(risk):
    called = [r.customer_id for r in f.call_list(risk).collect()]
    assert called == [f"c{i:03d}" for i in range(199, 99, -1)]
    assert {r.customer_id for r in f.winback_list(risk).collect()} == {f"c{i:03d}" for i in range(1, 100, 2)}


def test_concentration_scenarios_and_share(risk):
    row = f.risk_concentration(risk).first()
    assert (row.customers, row.top_customers, row.customer_share) == (200, 100, 0.5)
    assert row.risk_share == sum(range(100, 200)) / sum(range(200))
    kept = {r.retained_share: r.retained_revenue for r in f.retention_scenarios(risk).collect()}
    assert kept[0.2] == 14950 * 0.2 and len(kept) == 3
    assert f.risk_share(risk).first().share == 19900 / (200 * 1000 + 19900)


def test_routing_and_segment_share(risk):
    callers = {r.customer_id: r.caller for r in f.call_routing(risk).collect()}
    assert len(callers) == 100 and callers["c199"] == "senior account manager" and callers["c150"] == "account manager"
    assert sum(r.share for r in f.segment_share(risk).collect()) == pytest.approx(1)
