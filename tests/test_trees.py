"""Contributions along tree paths: they add up to the model's own margin, and equal a plain walk."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import models as MO
from ledgerfold.operators import trees as TR


@pytest.fixture(scope="module")
def rows(spark):
    x = F.col("id")
    return spark.range(800).select(
        "id", (x % 17).cast("double").alias("a"), (x * 7 % 23).cast("double").alias("b"),
        F.concat(F.lit("k"), (x % 5).cast("string")).alias("kind"), ((x % 17 > 8) != (x % 5 == 2)).cast("int").alias("flag"),
        (x % 17 + F.when(x % 5 == 2, 9).otherwise(0)).cast("double").alias("y")).cache()


def walked(trees, x):
    """A plain walk: base and step per feature."""
    out = {}
    for tree in trees:
        node = tree[0]
        while node.feature is not None:
            v = x[node.feature]
            left = v <= node.threshold if node.threshold is not None else v in node.goes_left
            child = tree[node.left if left else node.right]
            out[node.feature] = out.get(node.feature, 0.0) + node.weight * (child.value - node.value)
            node = child
    return out


@pytest.mark.parametrize("family, task, params", [
    ("gbt", "binary", {"maxIter": 5, "maxDepth": 3}), ("forest", "binary", {"numTrees": 4, "maxDepth": 4}), ("gbt", "regression", {"maxIter": 4, "maxDepth": 3}),
    ("forest", "regression", {"numTrees": 3, "maxDepth": 3})])
def test_contributions_add_up(spark, rows, family, task, params):
    label = "flag" if task == "binary" else "y"
    model = MO.train(rows, MO.ModelConfig(family=family, task=task, params=params, numeric=("a", "b"), categorical=("kind",), label=label))
    trees, names = TR.nodes_of(model), MO.input_names(model)
    got = {r["id"]: r for r in TR.with_contributions(model, rows, ["id"]).collect()}
    inputs = model.transform(rows).collect()
    for r in inputs:
        mine = got[r["id"]]
        total = mine["base"] + sum(mine[n] for n in names)
        if family == "gbt" and task == "binary":
            assert math.isclose(1 / (1 + math.exp(-2 * total)), r["probability"][1], abs_tol=1e-9)
        else:
            assert math.isclose(total, r["probability"][1] if task == "binary" else r["prediction"], abs_tol=1e-9)
        want = walked(trees, r[MO.FEATURES].toArray())
        assert all(math.isclose(mine[n], want.get(k, 0.0), abs_tol=1e-12) for k, n in enumerate(names))
    plan = TR.with_contributions(model, rows, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_summaries(spark, rows):
    model = MO.train(rows, MO.ModelConfig(params={"maxIter": 3, "maxDepth": 2}, numeric=("a", "b"), categorical=("kind",)))
    table = TR.node_table(model, spark)
    assert table.where("parent IS NULL").count() == 3 and table.where("feature IS NULL").count() > 3
    found = {r["feature"]: r["mean_abs"] for r in TR.global_tree_attribution(model, rows).collect()}
    assert set(found) == set(MO.input_names(model)) and found["a"] > found["b"]
    local = TR.local_tree_attribution(model, rows, "id", "flag", 4)
    assert local.select("id").distinct().count() <= 4
    with pytest.raises(ValueError):
        TR.nodes_of(MO.train(rows, MO.ModelConfig(family="logistic", numeric=("a",))))
    assert TR.tree_contributions(model, rows.limit(0), ["id"]).count() == 0
