"""Input contract of a model: the columns and types it was trained on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def feature_schema(df: DataFrame, exclude=()) -> str:
    """JSON of the schema without the excluded columns."""
    return StructType([f for f in df.schema.fields if f.name not in exclude]).json()


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(position, column, type) of a frame."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, feature string, type string")


def conform(df: DataFrame, schema_json: str) -> DataFrame:
    """Casts the contract's columns to their types and puts them in order; other columns are
    kept behind. A missing column is an error."""
    import json

    wanted = StructType.fromJson(json.loads(schema_json))
    missing = [f.name for f in wanted.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    names = set(wanted.names)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields],
                     *[c for c in df.columns if c not in names])
