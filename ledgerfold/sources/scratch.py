"""Shared folder for checkpoints and written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A planned write wraps the adaptive plan, and then the clean-up does not find its shuffles.
PLANNED = "spark.sql.optimizer.plannedWrite.enabled"

_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Only a session on local[…] may leave
    that unset, as in tests: it then gets a temporary folder, removed when Python ends. On a
    cluster each executor would write to its own disk, so that is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="ledgerfold-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return _local[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there, and losing an executor
    costs a re-read instead of a recomputation. The shuffle files of the write are not needed any
    more and are removed with it, where the Spark version can do that."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = {key: spark.conf.get(key, None) for key in (CLEANUP, PLANNED)}
    able = None not in before.values()
    if able:
        spark.conf.set(CLEANUP, "true")
        spark.conf.set(PLANNED, "false")
    try:
        df.write.parquet(path)
    finally:
        if able:
            for key, value in before.items():
                spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)
