"""Entities too large for one task.

An aggregate that lists an entity's rows does so inside one task. That is the cheapest plan as long
as no entity is huge, and wrong when one entity owns a third of the table. ``hot_keys`` measures
this with one sketch over the key column; only the entities it returns take the plan for hot ones,
and results are the same on both plans.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An entity below this many rows is sorted by one task without trouble.
HOT_ROWS = 1_000_000
# The sketch tracks TRACKED items; with more than MAX_HOT hot ones the list would be long, and all
# entities count as hot (ALL).
TRACKED = 16_384
MAX_HOT = 1_000


class _All(list):
    """Stands for every entity; true like a list that is not empty."""

    def __bool__(self):
        return True


ALL = _All()


class Hot(list):
    """Hot keys; ``rows`` is the number of rows they were sought in."""

    rows: int | None = None


# Rows that one task holds at once where a table is dealt out by a key that is nearly as long as itself.
PART_ROWS = 1_000_000
# Ordered work is cut into parts of about SEGMENT_ROWS rows, LEAST_SEGMENTS to SEGMENTS of them.
SEGMENT_ROWS = 1_000_000
LEAST_SEGMENTS = 16
SEGMENTS = 1024


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = None) -> list:
    """Keys that hold at least ``hot_rows`` rows, largest first; None, last, if null does. ``ALL``
    if there are more than MAX_HOT.

    The frequent-items sketch has a fixed size, combines map-side and needs no shuffle of keys.
    It underestimates counts by at most rows / (0.75 * TRACKED), which is far below the row
    limit of a key that matters on a table of any size: such a key is then less than 1/10 000 of
    the table, about one ordinary task.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    row = df.agg(F.expr(f"approx_top_k(`{key}`, {MAX_HOT + 1}, {TRACKED})").alias("top"), F.count_if(F.col(key).isNull()).alias("nulls"), F.count("*").alias("rows")).first()
    found = [r["item"] for r in row["top"] or [] if r["item"] is not None and r["count"] >= limit]
    if len(found) > MAX_HOT:
        return ALL
    hot = Hot([*found, None] if row["nulls"] >= limit else found)
    hot.rows = row["rows"]
    return hot


def dealt(df: DataFrame, rows: int | None, *keys: str) -> DataFrame:
    """Rows dealt out by the keys, about ``PART_ROWS`` to a task: with a number of its own the exchange
    is not coalesced by bytes, of which narrow rows have few on the wire and many in a hash table or a
    sort. Where nobody counted the rows, the session's settings hold."""
    if rows is None:
        return df.repartition(*keys)
    return df.repartition(parts_of(df, rows), *keys)


def parts_of(df: DataFrame, rows: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def grid_of_quantiles(column: str) -> Column:
    # as one text: a thousand literals built one by one would each cost a driver call
    shares = ", ".join(f"{i / SEGMENTS!r}D" for i in range(1, SEGMENTS))
    return F.expr(f"percentile_approx(double(`{column}`), array({shares}), {4 * SEGMENTS})")


def thinned(bounds: list[float] | None, rows: int, segments: int | None) -> list[float]:
    """Of SEGMENTS - 1 quantiles those that cut ``rows`` rows into parts of about SEGMENT_ROWS, or
    into ``segments`` parts; strictly increasing."""
    parts = min(SEGMENTS, segments or max(LEAST_SEGMENTS, -(-rows // SEGMENT_ROWS)))
    return sorted({bounds[i * SEGMENTS // parts - 1] for i in range(1, parts)}) if bounds else []


def quantile_bounds(df: DataFrame, column: str, segments: int | None = None) -> list[float]:
    """Strictly increasing inner bounds that cut the column into about equal parts; how many
    follows from the number of rows, which the same job counts.

    The bounds are collected (a fixed number of doubles) and become literals, so every use in a
    plan, and every retry of a task, sees the same cut.
    """
    found = df.agg(grid_of_quantiles(column), F.count("*")).first()
    return thinned(found[0], found[1], segments)


def with_segment(df: DataFrame, column: str, bounds: list[float], name: str = "_seg") -> DataFrame:
    """Number of the part of ``bounds`` that holds the column: order-preserving, row-local."""
    if not bounds:
        return df.withColumn(name, F.lit(0.0))
    splits = [float("-inf"), *bounds, float("inf")]
    tmp = f"{name}_x"
    cut = Bucketizer(splits=splits, inputCol=tmp, outputCol=name, handleInvalid="keep")
    return cut.transform(df.withColumn(tmp, F.col(column).cast("double"))).drop(tmp)


def split_hot(df: DataFrame, key: str, hot: list) -> tuple[DataFrame, DataFrame]:
    """(cold rows, hot rows); a null key is hot if None is in the list."""
    is_hot = F.coalesce(F.col(key).isin([k for k in hot if k is not None]), F.lit(None in hot))
    return df.where(~is_hot), df.where(is_hot)
