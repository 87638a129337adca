"""Population statistics that grow with arriving files.

Value counts can be added up. The state holds a table of counts for each arrival and, written
after it, the list of files that arrival counted. A further arrival reads only files that no list
names; statistics come from the sum of all listed arrivals. An arrival that was cut short has no list, so
its counts are ignored and its files are counted again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.operators.stats import RARE_SHARE, stats_of_counts, value_counts

COUNTS = "feature string, value int, cnt bigint"
FILES = "file string"


def read_state(spark: SparkSession, state: str, part: str, schema: str) -> DataFrame:
    """One of the two tables of the state with its ``arrival``; empty before the first."""
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{state}/{part}/arrival=none")
    return spark.read.schema(f"{schema}, arrival string").option("basePath", f"{state}/{part}").parquet(f"{state}/{part}/arrival=*")


def count_arrival(spark: SparkSession, state: str, path: str, schema, cols, prepare: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Counts the Parquet files under ``path`` that the state has not counted yet; returns how many.
    ``prepare`` turns their rows into those with the columns ``cols`` (for instance, keeps training ids)."""
    there = spark.createDataFrame([(f,) for f in spark.read.schema(schema).parquet(path).inputFiles()], FILES)
    known = read_state(spark, state, "files", FILES).select("file")
    new = sorted(r.file for r in there.join(known, "file", "left_anti").collect())
    if not new:
        return 0
    rows = spark.read.schema(schema).parquet(*new)
    arrival = uuid.uuid4().hex
    value_counts(prepare(rows) if prepare else rows, cols, keep_null=True).write.parquet(f"{state}/counts/arrival={arrival}")
    spark.createDataFrame([(f,) for f in new], FILES).coalesce(1).write.parquet(f"{state}/files/arrival={arrival}")
    return len(new)


def arrived_counts(spark: SparkSession, state: str) -> DataFrame:
    """(feature, value, cnt) over all arrivals that were finished."""
    whole = read_state(spark, state, "files", FILES).select("arrival").distinct()
    parts = read_state(spark, state, "counts", COUNTS).join(whole, "arrival", "left_semi")
    return parts.groupBy("feature", "value").agg(F.sum("cnt").alias("cnt"))


def arrived_stats(spark: SparkSession, state: str, rare_share: float = RARE_SHARE) -> DataFrame:
    """The population statistics of all rows that have arrived."""
    return stats_of_counts(arrived_counts(spark, state), rare_share)
