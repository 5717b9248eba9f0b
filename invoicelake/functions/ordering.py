"""Global order without a global sort: exact rank cuts and distributed running totals.

A window over a whole table sends every row to one task. Two things are enough to avoid it:

* ``rank_cuts`` finds the exact key that sits at a given rank. Once the few cut keys are known
  as literals, a bucket number (NTILE) or membership of the top n rows is a plain expression on
  the row: no sort, no shuffle, no join.
* ``running_totals`` adds up in order over ranges of values and shifts each range by the totals
  of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Candidates are narrowed down until this many are left for all ranks together, then ranked as they are.
RANKED_DIRECTLY = 500_000
STEPS = 200             # quantiles per narrowing round
ACCURACY = 10_000       # percentile_approx: rank error of at most 1/ACCURACY of the rows
PREFIX_STEP = 2         # characters added per round when many rows share the value at a cut


@dataclass
class Cut:
    """The key at one rank. ``tie`` None means that all rows with the value are within the rank."""

    value: float
    tie: str | None = None

    def beyond(self, value: Column, tie: Column) -> Column:
        """Whether a row comes after the cut in the order (value, tie)."""
        after = value > self.value
        if self.tie is None:
            return after
        return after | ((value == self.value) & (tie > self.tie))


@dataclass
class _Search:
    """A rank being looked for among the values strictly between ``low`` and ``high`` (None: no border)."""

    key: str
    rank: int
    low: float | None = None
    high: float | None = None
    below: int = 0        # rows in front of the candidates
    inside: int = 0       # candidates
    value: float | None = None   # once it is known, the candidates are the rows that hold it
    prefix: str = ""      # ... and whose tie starts with this
    tie: str | None = None

    def candidates(self) -> Column:
        column, found = F.col(self.key), F.lit(True)
        if self.value is not None:
            return column == self.value
        if self.low is not None:
            found = found & (column > self.low)
        if self.high is not None:
            found = found & (column < self.high)
        return found


def order_value(value: Column) -> Column:
    """Any numeric column as the DOUBLE it is ordered by; missing values come first."""
    return F.coalesce(value.cast("double"), F.lit(float("-inf")))


def rank_cuts(
    df: DataFrame, keys: dict[str, Column], tie: str, ranks: Callable[[int], list[int]],
    ranked_directly: int = RANKED_DIRECTLY,
) -> dict[str, list[Cut]]:
    """The exact keys at some ranks of the order (value, tie), for several values at once.

    ``ranks`` maps the row count to 1-based ranks; ``tie`` names a unique text column. Every step
    is one aggregate combined before its shuffle, so a value that a third of all rows share costs
    one row per task. Only cut keys and counts reach the driver. ``df`` is read a few times: pass
    a stored table.
    """
    data = df.select(F.col(tie).alias("_tie"), *[order_value(c).alias(k) for k, c in keys.items()])
    n = data.count()
    wanted = ranks(n) if n else []
    searches = [_Search(k, rank, inside=n) for k in keys for rank in wanted]
    few = max(1, ranked_directly // max(1, len(searches)))
    _narrow(data, searches, few)
    _rank_directly(data, searches)
    _find_ties(data, searches, few)
    return {k: [Cut(s.value, s.tie) for s in searches if s.key == k] for k in keys}


def _grid(value: str, steps: int = STEPS) -> Column:
    shares = ", ".join(f"{i / steps}D" for i in range(steps + 1))
    return F.expr(f"percentile_approx({value}, array({shares}), {ACCURACY})")


def _bracket(grid: list[float], share: float) -> tuple[float | None, float | None]:
    """Two quantiles around the rank; at an end of the candidates only one of them."""
    at = int(share * STEPS)
    return (grid[at - 1] if at >= 2 else None), (grid[at + 2] if at + 2 < STEPS else None)


def _narrow(data: DataFrame, searches: list[_Search], few: int) -> None:
    """Leave few candidates to every search: quantiles among the candidates, then exact counts.

    The rows that hold a border value are counted apart from those strictly inside. So a value that many rows share
    is either the answer or leaves the candidates, and every round leaves out one value at least."""
    while wide := [s for s in searches if s.value is None and s.inside > few]:
        # searches that still share their candidates share one pass over them
        shared = list({(s.key, s.low, s.high): s for s in wide}.items())
        row = data.select(*[
            F.when(s.candidates(), F.col(s.key)).alias(f"c{i}") for i, (_, s) in enumerate(shared)
        ]).agg(*[_grid(f"c{i}").alias(f"grid_{i}") for i in range(len(shared))]).first()
        grids = {key: row[f"grid_{i}"] for i, (key, _) in enumerate(shared)}
        brackets = [_bracket(grids[s.key, s.low, s.high], (s.rank - s.below) / s.inside) for s in wide]
        counts = data.agg(*[
            F.count_if(s.candidates() & part).alias(f"n{i}_{j}")
            for i, (s, bracket) in enumerate(zip(wide, brackets))
            for j, part in enumerate(_parts(F.col(s.key), *bracket))]).first()
        for i, (s, (low, high)) in enumerate(zip(wide, brackets)):
            sizes = [counts[f"n{i}_{j}"] for j in range(5)]
            part = 0
            while s.below + sizes[part] < s.rank:
                s.below += sizes[part]
                part += 1
            s.inside = sizes[part]
            if part in (1, 3):
                s.value = low if part == 1 else high
            elif part == 0:
                s.high = low
            elif part == 4:
                s.low = high
            else:
                s.low, s.high = s.low if low is None else low, s.high if high is None else high


def _parts(value: Column, low: float | None, high: float | None) -> list[Column]:
    """Before, at, between, at and after two borders; what has no border is empty."""
    none = F.lit(False)
    before, at_low = (none, none) if low is None else (value < low, value == low)
    after, at_high = (none, none) if high is None else (value > high, value == high)
    if low is not None and low == high:
        at_high = none
    return [before, at_low, ~(before | at_low | at_high | after), at_high, after]


def _rank_directly(data: DataFrame, searches: list[_Search]) -> None:
    """Few candidates: their keys are ranked as they are."""
    small = {i: s for i, s in enumerate(searches) if s.value is None}
    found = _pick(data, small, _Search.candidates, lambda s: F.struct(F.col(s.key).alias("value"), "_tie"))
    for i, (key, _, _) in found.items():
        s = small[i]
        s.value, s.tie, s.below, s.inside = key.value, key._tie, s.rank - 1, 1


def _find_ties(data: DataFrame, searches: list[_Search], few: int) -> None:
    """Where a cut falls between rows of one value, find the row by its identifier."""
    open_ = {i: s for i, s in enumerate(searches) if s.tie is None and s.rank < s.below + s.inside}

    def candidates(s: _Search) -> Column:
        return s.candidates() & F.col("_tie").startswith(s.prefix)

    def item(s: _Search) -> Column:
        if s.inside <= few:
            return F.col("_tie")
        return F.substring("_tie", 1, len(s.prefix) + PREFIX_STEP)

    while open_:
        picked = _pick(data, open_, candidates, item)
        for i, s in open_.items():
            found, before_it, n = picked.get(i, (None, 0, 0))
            whole = s.inside <= few or found is None or len(found) < len(s.prefix) + PREFIX_STEP
            if found is None or whole and n > 1:
                raise ValueError("the tie-breaker is missing or repeated in rows of one value")
            if whole:
                s.tie = found
            else:
                s.prefix, s.below, s.inside = found, s.below + before_it, n
        open_ = {i: s for i, s in open_.items() if s.tie is None}


def _pick(
    data: DataFrame, searches: dict[int, _Search],
    candidates: Callable[[_Search], Column], item: Callable[[_Search], Column],
) -> dict[int, tuple]:
    """Per search the item in which its rank falls, the candidates before it, and its count."""
    if not searches:
        return {}
    hits = F.array(*[
        F.when(candidates(s), F.struct(F.lit(i).alias("search"), item(s).alias("item"),
                                       F.lit(s.rank - s.below).alias("target")))
        for i, s in searches.items()
    ])
    counts = (
        data.select(F.inline(F.filter(hits, lambda hit: hit.isNotNull())))
        .groupBy("search", "target", "item").agg(F.count("*").alias("n"))
    )
    up_to = F.sum("n").over(Window.partitionBy("search").orderBy("item"))
    rows = (
        counts.withColumn("up_to", up_to)
        .filter((F.col("up_to") >= F.col("target")) & (F.col("up_to") - F.col("n") < F.col("target")))
        .collect()  # one row per search
    )
    return {r.search: (r.item, r.up_to - r.n, r.n) for r in rows}


def ntile_ranks(buckets: int) -> Callable[[int], list[int]]:
    """The last rank of every bucket but the final one; the first n mod k buckets hold one more."""
    def ranks(n: int) -> list[int]:
        size, larger = divmod(n, buckets)
        return [min(i * size + min(i, larger), n) for i in range(1, buckets)]
    return ranks


def ntile_columns(
    df: DataFrame, keys: dict[str, Column], tie: str, buckets: int = 5
) -> DataFrame:
    """NTILE(buckets) over (value, tie) for each key, as expressions on the row."""
    cuts = rank_cuts(df, keys, tie, ntile_ranks(buckets))
    scores = {
        name: reduce(
            lambda a, b: a + b,
            [cut.beyond(order_value(keys[name]), F.col(tie)).cast("int") for cut in cuts[name]],
            F.lit(1))
        for name in keys
    }
    return df.withColumns(scores)


def top_rows(df: DataFrame, value: Column, tie: str, ranks: Callable[[int], int]) -> DataFrame:
    """The first rows of the order (value descending, tie), as a filter rather than a sort.

    ``ORDER BY ... LIMIT n`` gathers its n rows in one place; this also works when n is a share
    of a large table.
    """
    key = -value.cast("double")
    cuts = rank_cuts(df, {"_key": key}, tie, lambda n: [ranks(n)])["_key"]
    if not cuts:
        return df
    return df.filter(~cuts[0].beyond(order_value(key), F.col(tie)))


def running_totals(
    df: DataFrame, group: str, order: str, weights: list[str], ranges: int | None = None
) -> DataFrame:
    """Add ``<weight>_before``: the sum over the rows of the group that come earlier in ``order``.

    ``df`` has one row per (group, order) and is read three times: pass a stored table. The cut
    points decide only how evenly the work is spread, never the result. What is broadcast is one
    row per group and range, so ``group`` must be something small, such as a column name.
    """
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.groupBy(group).agg(
        _grid(order, ranges).alias("_cuts"))
    ranged = df.join(F.broadcast(cuts), group).withColumn(
        "_range", F.size(F.filter("_cuts", lambda cut: cut < F.col(order)))).drop("_cuts")
    within = Window.partitionBy(group, "_range").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)
    across = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(group, "_range").agg(*[F.sum(w).alias(f"_{w}") for w in weights])
        .select(group, "_range",
                *[F.coalesce(F.sum(f"_{w}").over(across), F.lit(0)).alias(f"_{w}") for w in weights])
    )
    local = ranged.withColumns(
        {f"{w}_before": F.coalesce(F.sum(w).over(within), F.lit(0)) for w in weights})
    return (
        local.join(F.broadcast(offsets), [group, "_range"])
        .withColumns({f"{w}_before": F.col(f"{w}_before") + F.col(f"_{w}") for w in weights})
        .drop("_range", *[f"_{w}" for w in weights])
    )
