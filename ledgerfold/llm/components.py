"""Connected components of a large sparse graph by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.sources.scratch import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    ``edges`` has columns a, b. Every node points to a smaller or equal node; a round lowers the
    pointer of a node, and of the node it points to, to the smallest grandparent among its
    neighbours, and halves its own path. Rounds grow with the logarithm of a component's width.
    Joins meet a table with one row per node, so a node with very many neighbours is a skewed join
    that adaptive execution splits; minima are combined before each shuffle. Each round is a written
    table: no lineage builds up and a lost executor costs one round at most.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "links")
    state = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")).select(F.col("a").alias("node"), "up"), "parents")
    while True:
        parent = state.select(F.col("node").alias("p"), F.col("up").alias("top"))
        grand = state.join(parent, state.up == parent.p).select("node", "up", "top")
        near = (both.join(grand.select(F.col("node").alias("b"), "top"), "b")
                .groupBy("a").agg(F.min("top").alias("low")))
        seen = grand.join(near, grand.node == near.a)
        moves = seen.select(F.explode(F.array(
            F.struct(F.col("node").alias("node"), F.least("low", "top").alias("to")),
            F.struct(F.col("up").alias("node"), F.col("low").alias("to")))).alias("m")).select("m.*")
        lowest = moves.groupBy("node").agg(F.min("to").alias("to"))
        after = written(
            state.join(lowest, "node", "left").select(
                "node", F.least("up", F.coalesce("to", "up")).alias("up"), F.col("up").alias("was")), "parents")
        if after.where("up <> was").isEmpty():
            return after.select("node", F.col("up").alias("component"))
        state = after.select("node", "up")
