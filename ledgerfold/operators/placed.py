"""A history whose rows lie by entity on disk, so that entity aggregates read it without an exchange.

Ordinary entities are a table bucketed by id: all rows of one are in one bucket, which one task
reads. A hot entity would make its bucket as large as itself, so hot entities lie in a table of
their own, in plain files that any number of tasks read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerfold.operators.ranged import read_buckets, write_buckets
from ledgerfold.operators.skew import ALL, dealt, hot_keys, parts_of, split_hot


@dataclass(frozen=True)
class PlacedHistory:
    """``cold`` is bucketed by id, ``hot_rows`` are those of the ids in ``hot``."""

    id_col: str
    cold: DataFrame
    hot_rows: DataFrame
    hot: list

    @property
    def columns(self) -> list[str]:
        return self.cold.columns

    def where(self, cond) -> PlacedHistory:
        return PlacedHistory(self.id_col, self.cold.where(cond), self.hot_rows.where(cond), self.hot)

    def rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot_rows)


def place_history(df: DataFrame, path: str, id_col: str, order_col: str | None = None, buckets: int | None = None,
                  hot: list | None = None) -> str:
    """Writes ``df`` for ``read_placed`` and returns the path. One shuffle by id deals the rows to
    their buckets, so a bucket is one file, sorted by id and order. The number of buckets follows
    from the rows, ``PART_ROWS`` each, since one task reads a bucket and sorts its wide rows. The files need no catalog: what was written is described in
    a small table beside them."""
    spark = df.sparkSession
    hot = hot_keys(df, id_col) if hot is None else hot
    if buckets is None:
        rows = getattr(hot, "rows", None)  # counted with the hot ids
        buckets = parts_of(df, df.count() if rows is None else rows)
    n = buckets
    cold, hot_rows = (df.limit(0), df) if hot is ALL else split_hot(df, id_col, hot)
    kind = df.schema[id_col].dataType.simpleString()
    write_buckets(cold.repartition(n, id_col), f"{path}/cold", id_col, n, [id_col, *([order_col] if order_col else [])])
    hot_rows.write.parquet(f"{path}/hot")
    spark.createDataFrame([] if hot is ALL else [(h,) for h in hot], f"hot {kind}").coalesce(1).write.parquet(f"{path}/hot_ids")
    layout = json.dumps({"id": id_col, "buckets": n, "all_hot": hot is ALL, "schema": df.schema.jsonValue()})
    spark.createDataFrame([(layout,)], "layout string").coalesce(1).write.parquet(f"{path}/layout")
    return path


def read_placed(spark: SparkSession, path: str) -> PlacedHistory:
    """The history at a path that ``place_history`` wrote. The bucketed files are registered under a
    fresh name in the session's catalog, which needs nothing else."""
    layout = json.loads(spark.read.parquet(f"{path}/layout").first()[0])
    schema = StructType.fromJson(layout["schema"])
    cold = read_buckets(spark, f"{path}/cold", schema, layout["id"], layout["buckets"])
    hot = ALL if layout["all_hot"] else [r[0] for r in spark.read.parquet(f"{path}/hot_ids").collect()]
    return PlacedHistory(layout["id"], cold, spark.read.schema(schema).parquet(f"{path}/hot"), hot)


def parted(df: DataFrame | PlacedHistory, id_col: str, hot: list) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary entities, each entity in one partition; rows of hot ones, None if there
    are none). A placed history is there already, other rows are dealt out by id. With more hot
    entities than a list may name, all rows take the hot plan, which suits any entity."""
    if isinstance(df, PlacedHistory):
        if df.id_col != id_col:
            raise ValueError(f"placed by {df.id_col}, asked by {id_col}")
        return df.cold, df.hot_rows if df.hot else None
    if hot is ALL:
        return df.limit(0), df
    rows = getattr(hot, "rows", None)
    if not hot:
        return dealt(df, rows, id_col), None
    cold, hot_rows = split_hot(df, id_col, hot)
    return dealt(cold, rows, id_col), hot_rows


def hot_of(df: DataFrame | PlacedHistory, id_col: str, hot: list | None = None) -> list:
    if isinstance(df, PlacedHistory):
        return df.hot
    return hot_keys(df, id_col) if hot is None else hot


def rows_of_history(df: DataFrame | PlacedHistory) -> DataFrame:
    return df.rows() if isinstance(df, PlacedHistory) else df

