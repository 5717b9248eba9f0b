import pytest

from invoicelake.operators import silver as s
from invoicelake.schema import BRONZE, SchemaMismatch, SILVER, conform


def reasons(spark, *rows):
    lines = [r + ("x", "Norway") for r in rows]
    df = s.label_rows(spark.createDataFrame(lines, BRONZE))
    return {r.invoice: r.reject_reason for r in df.collect()}


def test_each_bad_line_gets_its_reason(labelled):
    found = {r.invoice: r.reject_reason for r in labelled.collect()}
    assert {k: v for k, v in found.items() if v} == {
        "504": "non_product_code", "A505": "bad_debt_adjustment", "506": "zero_or_negative_price",
        "507": "stock_writeoff", "508": "unparseable"}


def test_layers_add_up_and_values_are_signed(labelled, silver):
    assert labelled.count() == 11 and silver.count() == 6
    assert s.to_quarantine(labelled).count() == 5
    row = s.split_reconcile(
        written(labelled), {"silver": s.to_silver(labelled), "quarantine": s.to_quarantine(labelled)}).first()
    assert (row.labelled, row.silver, row.quarantine, row.balanced) == (11, 6, 5, True)
    cancelled = silver.filter("invoice = 'C503'").first()
    assert cancelled.is_cancellation and float(cancelled.line_value) == -7.5


def test_first_rule_wins(spark):
    found = reasons(
        spark,
        ("A1", "POST", "t", "x", "2015-01-01", "1"),       # unreadable before bad debt
        ("A2", "POST", "t", "1", "2015-01-01", "1"),       # bad debt before product code
        ("3", "POST", "t", "-1", "2015-01-01", "0"),       # product code before price
        ("4", "71001", "t", "-1", "2015-01-01", "0"),      # price before sign
    )
    assert found == {"A1": "unparseable", "A2": "bad_debt_adjustment", "3": "non_product_code",
                     "4": "zero_or_negative_price"}


def test_edges(spark):
    found = reasons(
        spark,
        (None, "71001", "t", "1", "2015-01-01", "1"),      # no invoice: falls through every rule
        ("2", None, "t", "1", "2015-01-01", "1"),          # no code: the same
        ("3", "71001", "t", "0", "2015-01-01", "1"),       # nothing sold is still a sale
        ("C4", "71001", "t", "0", "2015-01-01", "1"),      # nothing cancelled is a write-off
        ("c5", "71001", "t", "-1", "2015-01-01", "1"),     # a small c is not a cancellation
        ("6", "71001", "t", "1", "2015-01-01", "NaN"),
        ("7", "71001", "t", "1", "01/12/2010 08:26", "1"),
        ("8", "71001", "t", "2.0", "2015-01-01", "1"),
        ("9", "71001", "t", " 7 ", "2015-01-01 08:26", "1"),
        ("10", "7100", "t", "1", "2015-01-01", "1"),
        ("11", "71001", "t", "2147483647", "2015-01-01", "99999999999999"),  # larger than money can be
    )
    assert found == {
        None: None, "2": None, "3": None, "C4": "stock_writeoff", "c5": "stock_writeoff",
        "6": "unparseable", "7": "unparseable", "8": "unparseable", "9": None,
        "10": "non_product_code", "11": "unparseable"}


def written(labelled):
    lines, seen = s.watched(labelled)
    lines.write.format("noop").mode("overwrite").save()
    return seen


def test_gate(spark, labelled):
    seen = written(labelled)
    row = s.quality_gate(spark, seen).first()
    assert (row.total, row.kept, row.passed) == (11, 6, False)
    with pytest.raises(s.QualityGateFailed):
        s.require_quality(s.quality_gate(spark, seen))
    s.require_quality(s.quality_gate(spark, seen, 0.5), minimum=0.5)
    with pytest.raises(s.QualityGateFailed):
        s.require_quality(s.quality_gate(spark, written(labelled.limit(0))))


def test_the_gate_counts_in_the_pass_that_writes(spark, bronze, tmp_path):
    lines, seen = s.watched(s.label_rows(bronze))
    plan, bare = (df._jdf.queryExecution().executedPlan().toString() for df in (lines, s.label_rows(bronze)))
    assert plan.count("CollectMetrics") == 1
    assert [plan.count(x) for x in ("Exchange", "Scan")] == [bare.count(x) for x in ("Exchange", "Scan")]
    lines.write.parquet(str(tmp_path / "lines"))
    assert seen.get == {"total": 11, "kept": 6, "quarantined": 5}


def test_reject_report_counts_every_line(labelled):
    counts = [(r.reject_reason, r.lines) for r in s.reject_report(labelled).collect()]
    assert counts[0] == (None, 6) and sum(n for _, n in counts) == 11


def test_copies_are_combined_before_the_shuffle(bronze):
    plan = s.dedupe_lines(bronze)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1


def test_conform_names_the_odd_column(silver):
    with pytest.raises(SchemaMismatch, match="line_value"):
        conform(silver.drop("line_value"), SILVER)
