"""Rows in one global order, cut into segments of about equal size.

A range shuffle deals rows out by the order columns, however many rows a key has, and each task
writes its range as one bucket. Read again, a segment is one partition: windows and aggregates per
segment move nothing. What a segment needs of the ones before it (a border row, sums) is a table of one
row per segment. The number of segments is that of the session's shuffle partitions, as for any
shuffle, so it follows the cluster's setting for the data and has no limit here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfold.sources.scratch import new_path

FAN = 1024


def write_buckets(df: DataFrame, path: str, col: str, n: int, sort=()) -> None:
    """Files of a table bucketed by ``col``; ``df`` has the rows of a bucket in one partition."""
    name = f"buckets_{uuid.uuid4().hex}"
    out = df.write.bucketBy(n, col)
    (out.sortBy(*sort) if sort else out).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # external: the files stay


def read_buckets(spark, path: str, schema, col: str, n: int) -> DataFrame:
    """The table at a path of ``write_buckets``, under a fresh name in the session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    name = f"buckets_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{col}`) INTO {n} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def ranged(df: DataFrame, keys, segments: int | None = None, name: str = "_seg") -> DataFrame:
    """The rows with the number of their segment; segments are ranges of the keys, ascending, nulls
    first. Equal keys share a segment."""
    spark, n = df.sparkSession, segments_of(df, segments)
    cut = df.repartitionByRange(n, *keys).withColumn(name, F.spark_partition_id())
    path = new_path(spark, "ranged")
    write_buckets(cut, path, name, n)
    return read_buckets(spark, path, cut.schema, name, n)


def segments_of(df: DataFrame, segments: int | None = None) -> int:
    return segments or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def levels_of(segments: int, fan: int = FAN) -> int:
    """How often blocks of ``fan`` must be taken until one is left."""
    levels = 1
    while segments > fan ** levels:
        levels += 1
    return levels


def sums_before(totals: DataFrame, segment: str, sums, group_cols=(), levels: int = 1, fan: int = FAN) -> DataFrame:
    """``totals`` (one row per group and segment) with ``_e_<s>``, the sum over the group's earlier
    segments. Taken inside blocks of ``fan`` segments and shifted by the sums before the block, which
    come from the same function one level up: with ``levels_of`` their number, no window holds more than
    ``fan`` segments of a group, whatever that number."""
    group_cols = list(group_cols)
    block = F.floor(F.col(segment) / fan).cast("bigint") if levels > 1 else F.lit(0).cast("bigint")
    rows = totals.withColumn("_block", block)
    over = W.partitionBy(*group_cols, "_block").orderBy(segment).rowsBetween(W.unboundedPreceding, -1)
    inside = rows.select("*", *[F.coalesce(F.sum(s).over(over), F.lit(0)).alias("_e_" + s) for s in sums])
    if levels == 1:
        return inside.drop("_block")
    blocks = rows.groupBy(*group_cols, "_block").agg(*[F.sum(s).alias(s) for s in sums]).withColumnRenamed("_block", "_at")
    before = sums_before(blocks, "_at", sums, group_cols, levels - 1, fan)
    joined = inside.alias("i").join(before.alias("b"), same("i", "b", group_cols) & (F.col("i._block") == F.col("b._at")))
    return joined.select(*[F.col(f"i.{c}") for c in totals.columns], *[(F.col(f"i._e_{s}") + F.col(f"b._e_{s}")).alias("_e_" + s) for s in sums])


def same(left: str, right: str, cols) -> Column:
    """Equal in all columns, null being a value."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out
