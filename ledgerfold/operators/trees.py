"""Why a tree model scores a row as it does: contributions along the paths of its trees.

A tree's score of a row is its root's mean plus, for each split on the row's path, the step from the
node's mean to the child's, which is credited to the split's feature. Summed over trees, the
contributions of a row add up to its margin minus the base, the sum of the roots. Node means are those
of the training rows that reached the node. The trees, a few thousand nodes at most, become column
expressions: one that finds the leaf for each tree, and one per feature that adds up its steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.operators.evaluate import worst_false_positives
from ledgerfold.operators.models import FEATURES, input_names, score
from ledgerfold.operators.stats import melt

NODES = "tree int, node int, parent int, weight double, feature string, threshold double, goes_left array<double>, value double"


@dataclass(frozen=True)
class Node:
    tree: int
    number: int
    parent: int | None
    weight: float
    feature: int | None  # None for a leaf
    threshold: float | None  # of a split by value
    goes_left: tuple | None  # categories that go left, of a split by category
    left: int | None
    right: int | None
    value: float


def nodes_of(model: PipelineModel) -> list[list[Node]]:
    """The nodes of each tree of the last stage, the root first. The value is a node's mean: of a
    boosted tree what it adds to the margin, of a forest its prediction or its share of class 1, divided by the
    number of trees."""
    last = model.stages[-1]
    if not hasattr(last, "trees"):
        raise ValueError("only tree models have paths")
    weights = [float(w) for w in last.treeWeights]
    averaged = type(last).__name__.startswith("RandomForest")
    classes = type(last).__name__ == "RandomForestClassificationModel"
    out = []
    for t, tree in enumerate(last.trees):
        weight = 1.0 / len(weights) if averaged else weights[t]
        found: list[Node] = []

        def visit(node, parent):
            number = len(found)
            found.append(None)
            if classes:
                stats = list(node.impurityStats().stats())
                value = stats[1] / sum(stats)
            else:
                value = float(node.prediction())
            feature = threshold = goes_left = left = right = None
            if node.subtreeDepth() > 0:
                split = node.split()
                feature = int(split.featureIndex())
                if split.getClass().getSimpleName() == "ContinuousSplit":
                    threshold = float(split.threshold())
                else:
                    goes_left = tuple(float(x) for x in split.leftCategories())
                left, right = visit(node.leftChild(), number), visit(node.rightChild(), number)
            found[number] = Node(t, number, parent, weight, feature, threshold, goes_left, left, right, value)
            return number

        visit(tree._java_obj.rootNode(), None)
        out.append(found)
    return out


def node_table(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """The nodes as a table, one row each."""
    names = input_names(model)
    rows = [(n.tree, n.number, n.parent, n.weight, None if n.feature is None else names[n.feature], n.threshold,
             None if n.goes_left is None else list(n.goes_left), n.value) for tree in nodes_of(model) for n in tree]
    return spark.createDataFrame(rows, NODES)


def leaf_text(tree: list[Node], at: int = 0) -> str:
    """SQL of the number of the leaf that the inputs ``_x`` reach. A NaN goes right."""
    n = tree[at]
    if n.feature is None:
        return str(n.number)
    x = f"_x[{n.feature}]"
    cond = f"{x} <= {n.threshold!r}D" if n.threshold is not None else \
        f"{x} IN ({', '.join(f'{c!r}D' for c in n.goes_left)})" if n.goes_left else "false"
    return f"IF({cond}, {leaf_text(tree, n.left)}, {leaf_text(tree, n.right)})"


def steps(tree: list[Node]) -> dict[int, dict[int, float]]:
    """feature -> leaf -> what the splits on the feature add on the way to the leaf."""
    out: dict[int, dict[int, float]] = {}
    for leaf in (n for n in tree if n.feature is None):
        node = leaf
        while node.parent is not None:
            above = tree[node.parent]
            mine = out.setdefault(above.feature, {})
            mine[leaf.number] = mine.get(leaf.number, 0.0) + node.weight * (node.value - above.value)
            node = above
    return out


def base_value(trees: list[list[Node]]) -> float:
    return sum(t[0].weight * t[0].value for t in trees)


def with_contributions(model: PipelineModel, df: DataFrame, keep=()) -> DataFrame:
    """(keep…, base, one column per input): row-local, nothing is shuffled. An input that no split
    uses contributes 0."""
    trees, names = nodes_of(model), input_names(model)
    inputs = df
    for stage in model.stages[:-1]:
        inputs = stage.transform(inputs)
    found = inputs.select(*keep, vector_to_array(FEATURES).alias("_x"))
    found = found.select(*keep, *[F.expr(leaf_text(t)).alias(f"_leaf{i}") for i, t in enumerate(trees)])
    by_tree = [steps(t) for t in trees]

    def total(feature: int) -> Column:
        terms = []
        for i, of in enumerate(by_tree):
            if feature in of:
                cases = " ".join(f"WHEN {leaf} THEN {value!r}D" for leaf, value in sorted(of[feature].items()))
                terms.append(f"CASE _leaf{i} {cases} ELSE 0D END")
        return F.expr(" + ".join(terms) or "0D")

    return found.select(*keep, F.lit(base_value(trees)).alias("base"), *[total(k).alias(n) for k, n in enumerate(names)])


def tree_contributions(model: PipelineModel, df: DataFrame, keep=()) -> DataFrame:
    """(keep…, feature, contribution)."""
    wide = with_contributions(model, df, keep)
    return melt(wide, input_names(model), keep, "double").withColumnRenamed("value", "contribution")


def global_tree_attribution(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, mean_abs): mean absolute contribution, combined in every task before the shuffle."""
    return tree_contributions(model, df).groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))


def local_tree_attribution(model: PipelineModel, df: DataFrame, id_col: str, actual: str, n: int = 10) -> DataFrame:
    """Contributions of the n most confident false positives."""
    scored = score(model, df).withColumn("is_error", (F.col("predicted") != F.col(actual)).cast("int"))
    bad = worst_false_positives(scored, actual, "probability_1", id_col, n).select(id_col)
    return tree_contributions(model, df.join(F.broadcast(bad), id_col, "left_semi"), [id_col])
