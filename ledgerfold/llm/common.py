"""What the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one Arrow batch: texts of documents are a few kB each, so a batch stays at a few MB.
BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default of 10000 rows, unless the user has set a size."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def whole_text(col: str) -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_bytes(col: str) -> Column:
    """UTF-8 bytes of the text, as Python workers take them without decoding."""
    return whole_text(col).cast("binary")


def free_name(name: str, columns) -> str:
    """The name, with underscores before it until no column has it (upper and lower case being one)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
