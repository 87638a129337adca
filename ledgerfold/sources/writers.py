"""Sinks. Paths are on the cluster's shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_predictions(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Scored rows with their id."""
    if kind == "csv":
        df.write.mode("overwrite").csv(path, header=True)
    else:
        df.write.mode("overwrite").parquet(path)


def save_stats(stats: DataFrame, path: str) -> None:
    stats.coalesce(1).write.mode("overwrite").parquet(path)  # one row per feature


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("feature string, mode_value int, rare_bins array<int>").parquet(path)
