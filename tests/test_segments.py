from invoicelake.functions.expressions import first_that_holds
from invoicelake.operators import rfm, silver
from invoicelake.schema import SEGMENT_RULES


def test_every_pair_of_scores_has_its_segment(spark):
    df = spark.range(25).selectExpr("CAST(id DIV 5 + 1 AS INT) AS r_score", "CAST(id % 5 + 1 AS INT) AS f_score")
    found = {(x.r_score, x.f_score): x.s for x in df.withColumn("s", first_that_holds(SEGMENT_RULES)).collect()}
    assert {found[p] for p in [(4, 4), (5, 5), (4, 5)]} == {"Champions"}
    assert {found[p] for p in [(4, 1), (5, 2)]} == {"Promising"}
    assert {found[p] for p in [(3, 3), (3, 5), (4, 3), (5, 3)]} == {"Loyal"}
    assert {found[p] for p in [(1, 3), (2, 5)]} == {"At Risk"}
    assert {found[p] for p in [(1, 1), (2, 2)]} == {"Hibernating"}
    assert {found[p] for p in [(3, 1), (3, 2)]} == {"Needs Attention"}


def test_other_rules_work_too(spark, bronze):
    late = (("late", "invoice_ts >= TIMESTAMP_NTZ '2015-06-01 00:00:00'"), ("dear", "price > 8"))
    found = {r.invoice: r.reject_reason for r in silver.label_rows(bronze, late).collect()}
    assert found["510"] == "late" and found["504"] == found["A505"] == "dear" and found["508"] is None


def test_other_segments_work_too(spark, silver):
    from invoicelake.operators import gold
    features = gold.customer_features(silver, "2015-06-20").cache()
    rules = (("new", "r_score = 5"), ("old", "TRUE"))
    assert {r.segment for r in rfm.rfm_segments(features, rules).collect()} <= {"new", "old"}
