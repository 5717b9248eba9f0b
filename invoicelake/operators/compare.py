"""Does a result say the same as a reference? Comparison of two tables as Spark jobs."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoicelake.functions.expressions import round_half_even
from invoicelake.functions.ordering import running_totals
from invoicelake.session import stage

RELATIVE_TOLERANCE = 0.005
ABSOLUTE_TOLERANCE = 1e-8
POSITIONS_PER_SLOT = 1_000_000
PROBES = 64
NUMBERS = (T.NumericType, T.BooleanType)


def row_differences(reference: DataFrame, result: DataFrame) -> DataFrame:
    """Strict mode: rows that one side has more often; ``surplus`` > 0 means the reference does."""
    signed = reference.withColumn("_side", F.lit(1)).unionByName(result.withColumn("_side", F.lit(-1)))
    return (
        signed.groupBy(*reference.columns).agg(F.sum("_side").alias("surplus"))
        .filter(F.col("surplus") != 0)
    )


def rows_match(reference: DataFrame, result: DataFrame) -> bool:
    return row_differences(reference, result).isEmpty()


def _value_counts(df: DataFrame) -> DataFrame:
    """How often each value occurs in each column: (name, numeric, number, item, n).

    Numbers are rounded to two digits and dates cut to the day. Copies of a value are counted
    before the shuffle, so a column that is mostly one value makes no large group.
    """
    def entry(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        numeric = isinstance(field.dataType, NUMBERS)
        if numeric:
            number = round_half_even(value.cast("double"), 2) + F.lit(0.0)  # no negative zero
            item = number.cast("string")
        else:
            number = F.lit(None).cast("double")
            dated = isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            item = F.date_format(value, "yyyy-MM-dd") if dated else value.cast("string")
        return F.struct(
            F.lit(field.name).alias("name"), F.lit(numeric).alias("numeric"),
            number.alias("number"), F.coalesce(item, F.lit("\u0000")).alias("item"))

    return (
        df.select(F.inline(F.array(*[entry(f) for f in df.schema.fields])))
        .groupBy("name", "numeric", "number", "item").agg(F.count("*").alias("n"))
    )


def _fingerprints(values: DataFrame) -> DataFrame:
    """One row per column: rows, and what is equal for columns that hold the same values equally often."""
    digest = lambda seed: F.sum(F.xxhash64(F.lit(seed), "item", "n").cast("decimal(20,0)"))
    return values.groupBy("side", "name", "numeric").agg(
        F.sum("n").alias("rows"), F.count("*").alias("distinct_values"), digest(1).alias("a"), digest(2).alias("b"))


def _paired(values: DataFrame, pairs: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """The rows of each pair's two columns, under the name of the reference column. No reference column is in two
    pairs, so there are at most twice as many copies as reference columns."""
    listed = F.broadcast(values.sparkSession.createDataFrame(pairs, "wanted string, found string"))
    want, got = (values.filter(F.col("side") == side).drop("side") for side in ("want", "got"))
    return (want.join(listed, F.col("name") == F.col("wanted")).drop("name", "found"),
            got.join(listed, F.col("name") == F.col("found")).drop("name", "found"))


def _same(values: DataFrame, pairs: list[tuple[str, str]]) -> set[str]:
    """Reference columns of the pairs that hold the same values equally often."""
    want, got = _paired(values, pairs)
    counted = want.unionByName(got.withColumn("n", -F.col("n"))).groupBy("wanted", "item").agg(F.sum("n").alias("n"))
    equal = counted.groupBy("wanted").agg(F.every(F.col("n") == 0).alias("equal")).filter("equal")
    return {row.wanted for row in equal.collect()}


def _probes(steps: DataFrame, rows: int) -> dict[tuple[str, str], list[float | None]]:
    """Each column's sorted values at ``PROBES`` evenly spread positions: that many rows per column are collected."""
    last, gaps = max(rows - 1, 1), PROBES - 1
    first_from = lambda position: F.expr(f"({gaps} * ({position}) + {last - 1}) div {last}")
    held = (
        steps.withColumn("first", first_from("n_before"))
        .withColumn("beyond", F.least(first_from("n_before + n"), F.lit(PROBES))).filter("first < beyond")
        .select("side", "name", "number", F.explode(F.sequence("first", F.col("beyond") - 1)).alias("probe")))
    found: dict[tuple[str, str], list[float | None]] = {}
    for row in sorted(held.collect(), key=lambda row: row.probe):
        found.setdefault((row.side, row.name), []).append(row.number)
    return found


def _is_close(w: float | None, g: float | None, rtol: float) -> bool:
    if w is None or g is None or not (math.isfinite(w) and math.isfinite(g)):
        return w == g or (w is not None and g is not None and math.isnan(w) and math.isnan(g))
    return abs(g - w) <= ABSOLUTE_TOLERANCE + rtol * abs(w)


def _close(steps: DataFrame, pairs: list[tuple[str, str]], rtol: float) -> set[str]:
    """Reference columns of the pairs whose sorted values lie close together, position by position.

    A column is kept as steps: value v holds ``n`` positions from ``n_before`` on. Steps are cut at slot
    borders, and within a slot the two columns' steps are merged by start, so positions are
    compared without ever being written out one by one.
    """
    def in_slots(placed: DataFrame, value: str) -> DataFrame:
        slot = F.explode(F.sequence(
            F.floor(F.col("n_before") / POSITIONS_PER_SLOT),
            F.floor((F.col("n_before") + F.col("n") - 1) / POSITIONS_PER_SLOT)))
        return placed.withColumn("slot", slot).select(
            "wanted", "slot", F.greatest(F.col("n_before"), F.col("slot") * POSITIONS_PER_SLOT).alias("start"),
            F.struct("number").alias(value))

    want, got = _paired(steps, pairs)
    merged = in_slots(want, "w").unionByName(in_slots(got, "g"), allowMissingColumns=True)
    so_far = Window.partitionBy("wanted", "slot").orderBy("start").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    w = F.last("w", ignorenulls=True).over(so_far)["number"]
    g = F.last("g", ignorenulls=True).over(so_far)["number"]
    finite = lambda x: F.abs(x) < F.lit(math.inf)
    near = finite(w) & finite(g) & (F.abs(g - w) <= ABSOLUTE_TOLERANCE + rtol * F.abs(w))
    return {row.wanted for row in (
        merged.withColumn("close", g.eqNullSafe(w) | F.coalesce(near, F.lit(False)))
        .groupBy("wanted").agg(F.every("close").alias("close")).filter("close").collect())}


def _first_right(
    candidates: dict[str, list[str]], test: Callable[[list[tuple[str, str]]], set[str]]
) -> dict[str, str]:
    """Per reference column, its first candidate that passes. A round tests one candidate of each column."""
    matches: dict[str, str] = {}
    while pairs := [(w, found[0]) for w, found in sorted(candidates.items()) if found]:
        right = test(pairs)
        matches |= {w: g for w, g in pairs if w in right}
        candidates = {w: candidates[w][1:] for w, _ in pairs if w not in right}
    return matches


def _matches(values: DataFrame, columns: list[Row], rtol: float) -> dict[str, str]:
    """Matches of the reference's columns; ``columns`` are their fingerprints, one row per column."""
    key = lambda row: (row.numeric, row.distinct_values, row.a, row.b)
    want, got = ([row for row in columns if row.side == side] for side in ("want", "got"))
    alike = lambda row: sorted(g.name for g in got if key(g) == key(row))
    matches = _first_right({row.name: alike(row) for row in want}, lambda pairs: _same(values, pairs))
    left = [row for row in want if row.numeric and row.name not in matches]
    # equal columns share one verdict: the first of them stands for all
    first = {side: {key(row): row.name for row in sorted(rows, key=lambda row: row.name, reverse=True)}
             for side, rows in (("want", left), ("got", [row for row in got if row.numeric]))}
    if not first["want"] or not first["got"]:
        return matches
    column = F.concat_ws(":", "side", "name")
    placed = values.withColumn("column", column).filter(
        F.col("column").isin([f"{side}:{name}" for side in first for name in first[side].values()]))
    steps = stage(running_totals(placed, "column", "number", ["n"]).select(
        "side", "name", "number", "n", "n_before"), "column_steps")
    probes = _probes(steps, want[0].rows)
    possible = {
        w: [g for g in sorted(first["got"].values())
            if all(_is_close(x, y, rtol) for x, y in zip(probes["want", w], probes["got", g]))]
        for w in first["want"].values()}
    close = _first_right(possible, lambda pairs: _close(steps, pairs, rtol))
    return matches | {row.name: close[name] for row in left if (name := first["want"][key(row)]) in close}


def column_matches(
    reference: DataFrame, result: DataFrame, rtol: float = RELATIVE_TOLERANCE
) -> DataFrame:
    """Per reference column, the first result column with the same values (in any row order).

    Extra, renamed and reordered columns are fine; numbers may differ by ``rtol``; the number of
    rows must be the same. Infinite values and NaN are close to themselves alone.

    Columns are compared by digests first: fingerprints name the pairs that are equal, and sorted values at a
    few positions rule out most that are not close. Only what is left is compared whole, one
    candidate per reference column in a round, so the rows written grow with the columns, not with their pairs.
    """
    values = stage(
        _value_counts(reference).withColumn("side", F.lit("want")).unionByName(
            _value_counts(result).withColumn("side", F.lit("got"))), "column_values")
    # one row per column and PROBES rows per numeric column reach the driver
    columns = _fingerprints(values).collect()
    matches: dict[str, str] = {}
    if not columns:  # both are empty: every column matches
        matches = {c: min(result.columns) for c in reference.columns}
    elif {row.side for row in columns} == {"want", "got"} and len({row.rows for row in columns}) == 1:
        matches = _matches(values, columns, rtol)
    return reference.sparkSession.createDataFrame(
        [(c, matches.get(c), c in matches) for c in reference.columns],
        "reference_column string, matched_by string, matched boolean")


def results_match(
    reference: DataFrame, result: DataFrame, rtol: float = RELATIVE_TOLERANCE
) -> bool:
    return column_matches(reference, result, rtol).agg(F.every("matched")).first()[0]


def outcome_table(outcomes: list[tuple[str, bool, str]], like: DataFrame) -> DataFrame:
    """One row per case: question, verdict, SQL."""
    return like.sparkSession.createDataFrame(outcomes, "question string, ok boolean, sql string")


def accuracy(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count("*").alias("cases"), F.count_if("ok").alias("passed"),
        F.avg(F.col("ok").cast("double")).alias("accuracy"))
