"""Scoring of files as they land."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerfold.operators.models import score


def scored_stream(spark: SparkSession, model: PipelineModel, in_path: str, schema: StructType,
                  threshold: float | None = None, files_per_batch: int = 1000) -> DataFrame:
    """A stateless map over new files: no watermark, no state, memory independent of history."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(in_path)
    return score(model, source, threshold)


def incremental_score(spark: SparkSession, model: PipelineModel, in_path: str, schema: StructType, out_path: str,
                      checkpoint: str, threshold: float | None = None) -> StreamingQuery:
    """Scores every file that the checkpoint has not seen, writes it once, and stops."""
    return (scored_stream(spark, model, in_path, schema, threshold).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).option("path", out_path)
            .trigger(availableNow=True).start())
