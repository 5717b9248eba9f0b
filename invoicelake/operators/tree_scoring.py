"""Fitted boosted trees as plain column expressions: scores without a vector column or a model object in the tasks."""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES_TOGETHER = 25   # trees per expression; the sums of these are added at the end


def _number(value: float) -> str:
    if math.isinf(value):
        return f"double('{'-' if value < 0 else ''}Infinity')"
    return f"{value!r}D"


def _steps(node, names: list[str]) -> str:
    """The node as nested IFs over the named columns; a value up to the threshold goes left, NaN goes right."""
    if not node.subtreeDepth():
        return _number(node.prediction())
    split = node.split()
    column, border = names[split.featureIndex()], _number(split.threshold())
    return f"IF({column} <= {border}, {_steps(node.leftChild(), names)}, {_steps(node.rightChild(), names)})"


def tree_expressions(model: GBTClassificationModel, names: list[str]) -> list[str]:
    """One SQL expression per tree, its weight included. ``names`` are columns of doubles in the order of the features."""
    return [f"{_number(weight)} * {_steps(tree._java_obj.rootNode(), names)}"
            for tree, weight in zip(model.trees, model.treeWeights)]


def node_table(model: GBTClassificationModel, features: list[str]) -> list[tuple]:
    """(tree, node, feature, threshold, left, right, prediction), nodes numbered from the root's 0 in preorder.

    Inner nodes have no prediction and leaves nothing else: what a reader or another engine needs to score a row."""
    rows: list[tuple] = []

    def add(tree: int, node, at: int) -> int:
        if not node.subtreeDepth():
            rows.append((tree, at, None, None, None, None, node.prediction()))
            return at + 1
        right = add(tree, node.leftChild(), at + 1)
        after = add(tree, node.rightChild(), right)
        split = node.split()
        rows.append((tree, at, features[split.featureIndex()], split.threshold(), at + 1, right, None))
        return after

    for number, tree in enumerate(model.trees):
        add(number, tree._java_obj.rootNode(), 0)
    return sorted(rows)


NODES = "tree int, node int, feature string, threshold double, left int, right int, prediction double"


def nodes(df: DataFrame, model: GBTClassificationModel, features: list[str]) -> DataFrame:
    """The node table as a frame, so that a model can be stored, compared and read without the library that fitted it."""
    return df.sparkSession.createDataFrame(node_table(model, features), NODES)


def with_probability(df: DataFrame, model: GBTClassificationModel, features: list[str], name: str = "p") -> DataFrame:
    """The rows with the probability of class 1 as column ``name``. Missing features count as 0, as in training."""
    names = [f"`__x{i}`" for i in range(len(features))]
    trees = tree_expressions(model, names)
    parts = [f"__part{i}" for i in range(0, len(trees), TREES_TOGETHER)]
    filled = df.withColumns({
        n.strip("`"): F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)) for n, f in zip(names, features)})
    summed = filled.withColumns({
        part: F.expr(" + ".join(trees[i:i + TREES_TOGETHER]))
        for part, i in zip(parts, range(0, len(trees), TREES_TOGETHER))})
    # Dozens of trees in one generated method are past the size the JVM compiles (8 KB): 60 trees took five times as long
    # as 300, which Spark's own limit keeps out of whole-stage code. A zero from a lambda keeps this projection out at any
    # number of trees; its generated code is then cut into small methods.
    zero = F.transform(F.array(F.lit(0.0)), lambda x: x)[0]
    raw: Column = sum((F.col(p) for p in parts), zero)
    return summed.select(*[F.col(f"`{c}`") for c in df.columns], (1 / (1 + F.exp(-2 * raw))).alias(name))
