"""Live counts of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerfold.operators.evaluate import CONFIDENCE_BUCKETS, prediction_monitor


def monitor_stream(spark: SparkSession, in_path: str, schema: StructType | str, out_path: str, checkpoint: str, predicted: str = "predicted",
                   confidence: str = "confidence", buckets=CONFIDENCE_BUCKETS, files_per_batch: int = 1000) -> StreamingQuery:
    """Adds every file of predictions that the checkpoint has not seen to the counts, and stops.

    The state is one row per predicted class, whatever has been seen. After each batch the whole
    table of counts is written to a folder with the batch's number; a batch that is run again after a failure
    overwrites its own folder, so nothing counts twice.
    """
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(in_path)

    def publish(counts: DataFrame, batch: int) -> None:
        counts.coalesce(1).write.mode("overwrite").parquet(f"{out_path}/batch={batch}")

    return (prediction_monitor(source, predicted, confidence, buckets).writeStream.outputMode("complete").foreachBatch(publish)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The counts after the last finished batch."""
    found = spark.read.parquet(out_path)
    return found.where(F.col("batch") == found.agg(F.max("batch")).scalar()).drop("batch")
