import datetime as dt
import math

import pytest

from invoicelake.operators import compare
from invoicelake.operators.compare import column_matches, results_match, row_differences, rows_match


def frame(spark, columns, *rows):
    return spark.createDataFrame(list(rows), columns)


def test_renamed_reordered_rounded_and_widened(spark):
    want = frame(spark, "city string, total double", ("Oslo", 200.0), ("Bergen", 80.0))
    got = frame(spark, "n int, sum double, Town string", (1, 80.3, "Bergen"), (2, 199.5, "Oslo"))
    assert results_match(want, got)
    assert {r.reference_column: r.matched_by for r in column_matches(want, got).collect()} == {
        "city": "Town", "total": "sum"}


def test_wrong_numbers_and_row_counts(spark):
    want = frame(spark, "v double", (50.0,))
    assert not results_match(want, frame(spark, "v double", (51.0,)))
    assert not results_match(want, frame(spark, "v double", (50.0,), (50.0,)))
    assert not results_match(want, frame(spark, "v string", ("50.0",)))
    assert not results_match(want, want.limit(0))
    assert results_match(want.limit(0), want.limit(0))


def test_dates_match_by_day(spark):
    want = frame(spark, "d timestamp", (dt.datetime(2015, 3, 1),))
    assert results_match(want, frame(spark, "d date", (dt.date(2015, 3, 1),)))
    assert not results_match(want, frame(spark, "d date", (dt.date(2015, 3, 2),)))


def test_missing_values(spark):
    want = frame(spark, "v double, t string", (1.0, None), (None, "a"))
    assert results_match(want, frame(spark, "v double, t string", (None, "a"), (1.0, None)))
    assert not results_match(want, frame(spark, "v double, t string", (0.0, "a"), (1.0, None)))


def test_columns_need_the_same_multiplicities(spark):
    assert not results_match(frame(spark, "t string", ("a",), ("a",), ("b",)),
                             frame(spark, "t string", ("a",), ("b",), ("b",)))


@pytest.mark.parametrize("slot", [3, 1_000_000])
def test_close_equals_position_by_position(spark, rng, monkeypatch, slot):
    monkeypatch.setattr(compare, "POSITIONS_PER_SLOT", slot)
    for _ in range(4):
        want = [round(rng.choice([5.0, 5.0, 5.0, rng.random() * 100]), 2) for _ in range(60)]
        got = [round(v * (1 + rng.choice([0, 0.004, 0.0049, 0.006 * rng.randrange(2)])), 2) for v in want]
        wanted = all(abs(g - w) <= 1e-8 + 0.005 * abs(w) for w, g in zip(sorted(want), sorted(got)))
        rng.shuffle(got)
        assert results_match(frame(spark, "v double", *[(v,) for v in want]),
                             frame(spark, "g double", *[(v,) for v in got])) == wanted


def brute(want, got):
    """First close column of ``got`` per column of ``want``; equal ones come first."""
    def close(w, g):
        if w is None or g is None or not (math.isfinite(w) and math.isfinite(g)):
            return w == g or (w is not None and g is not None and w != w and g != g)
        return abs(g - w) <= 1e-8 + 0.005 * abs(w)
    place = lambda v: (v is not None, v is not None and v != v, 0 if v is None or v != v else v)
    matches = {}
    for w, values in want.items():
        values = sorted(values, key=place)
        near = [g for g in sorted(got) if all(map(close, values, sorted(got[g], key=place)))]
        same = [g for g in near if list(map(repr, values)) == list(map(repr, sorted(got[g], key=place)))]
        matches[w] = (same + near + [None])[0]
    return matches


@pytest.mark.parametrize("slot", [7, 1_000_000])
def test_many_columns_against_every_pair(spark, rng, monkeypatch, slot):
    monkeypatch.setattr(compare, "POSITIONS_PER_SLOT", slot)
    rows, special = 150, [None, math.inf, -math.inf, math.nan, 0.0]
    columns = [[rng.choice([5.0, round(rng.random() * 100, 2), *special]) for _ in range(rows)] for _ in range(25)]
    columns += [list(columns[i]) for i in range(5)]                 # equal columns
    def moved(values, most):                                        # near ones, some of them in one place too far off
        out = [v if v is None or not math.isfinite(v) else round(v * (1 + rng.random() * most), 2) for v in values]
        rng.shuffle(out)
        return out
    want = {f"w{i:02}": v for i, v in enumerate(columns)}
    got = {f"g{i:02}": moved(v, rng.choice([0, 0.002, 0.004, 0.006, 0.02])) for i, v in enumerate(columns * 3)}
    asked = []
    close = compare._close
    monkeypatch.setattr(compare, "_close", lambda steps, pairs, rtol: asked.append(pairs) or close(steps, pairs, rtol))
    table = lambda side: frame(
        spark, ", ".join(f"{name} double" for name in side), *zip(*side.values()))
    found = {r.reference_column: r.matched_by for r in column_matches(table(want), table(got)).collect()}
    expected = brute(want, got)
    assert found == expected
    assert all(len({w for w, _ in pairs}) == len(pairs) for pairs in asked)   # one candidate per column and round
    assert sum(map(len, asked)) < 5 * len(want)                               # of 30 * 90 pairs


def test_infinite_and_nan_are_close_to_themselves_alone(spark):
    far = frame(spark, "v double", (math.inf,), (1.0,))
    assert results_match(far, frame(spark, "g double", (1.001,), (math.inf,)))
    assert not results_match(far, frame(spark, "g double", (1.0,), (7.0,)))
    lost = frame(spark, "v double", (math.nan,), (1.0,))
    assert results_match(lost, frame(spark, "g double", (math.nan,), (1.001,)))
    assert not results_match(lost, frame(spark, "g double", (1.0,), (7.0,)))


def test_strict_mode(spark):
    want = frame(spark, "a int, b string", (1, "x"), (2, "y"), (2, "y"))
    assert rows_match(want, frame(spark, "a int, b string", (2, "y"), (1, "x"), (2, "y")))
    swapped = frame(spark, "a int, b string", (1, "y"), (2, "x"), (2, "y"))
    assert not rows_match(want, swapped) and results_match(want, swapped)
    assert {(r.a, r.b): r.surplus for r in row_differences(want, swapped).collect()} == {
        (1, "x"): 1, (2, "y"): 1, (1, "y"): -1, (2, "x"): -1}


def test_a_right_answer_of_many_rows_is_right(spark):
    from invoicelake.plans.questions import score_answers
    case = ("all", "SELECT id FROM many", "SELECT id AS number FROM many")
    cases = spark.createDataFrame([case], "question string, sql string, candidate string")
    assert [r.ok for r in score_answers(spark, cases, {"many": spark.range(500)}).collect()] == [True]
