"""Scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType


def read_history(spark: SparkSession, path: str, id_col: str) -> DataFrame:
    """Parquet file or glob; rows without an id are dropped (pushed to the scan)."""
    return spark.read.parquet(path).where(F.col(id_col).isNotNull())


def read_target(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def sample_by_id(df: DataFrame, id_col: str, pct: float) -> DataFrame:
    """Keeps whole entities by id: remainder modulo 10000 up to and including pct * 10000."""
    if pct >= 1.0:
        return df
    return df.where(F.abs(F.col(id_col).cast("bigint")) % 10000 <= F.lit(round(pct * 10000)))


def unique_target(target: DataFrame, id_col: str) -> DataFrame:
    """One row per id, so joining it never multiplies rows; the largest label wins."""
    rest = [c for c in target.columns if c != id_col]
    return target.groupBy(id_col).agg(*[F.max(c).alias(c) for c in rest])


def join_target(df: DataFrame, target: DataFrame, id_col: str, unique: bool = False) -> DataFrame:
    """Left join of labels. No broadcast hint: the target grows with the entities, and Spark
    decides from its size. A hot id on the left is split by the adaptive skew join."""
    return df.join(target if unique else unique_target(target, id_col), id_col, "left")


def eda_slice(df: DataFrame, target: DataFrame, id_col: str, feature: str, dominant, unique: bool = False) -> DataFrame:
    """One feature without its dominant value (nulls stay) next to the label."""
    x = F.col(feature)
    return join_target(df.select(id_col, feature).where((x != F.lit(dominant)) | x.isNull()), target, id_col, unique)


def decimals_to_double(df: DataFrame) -> DataFrame:
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
        for f in df.schema.fields])


def ids_with_label(df: DataFrame, id_col: str, label: str, order_col: str) -> DataFrame:
    """Unique ids with the label of their last row."""
    return df.groupBy(id_col).agg(F.max_by(label, order_col).alias(label))
