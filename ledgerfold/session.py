"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot never compiles a method above 8000 bytes of bytecode. The default limit of generated
# methods is 64 kB, so a wide projection would run interpreted; at 8000 Spark splits it instead.
COMPILED_METHOD_LIMIT = "8000"
DEFAULT_METHOD_LIMIT = "65535"


def tune(spark: SparkSession) -> SparkSession:
    """Sets what wide entity tables need and the user has not set. Partition counts, memory and
    join strategies stay with the cluster's settings and adaptive execution."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, DEFAULT_METHOD_LIMIT) == DEFAULT_METHOD_LIMIT:
        spark.conf.set(key, COMPILED_METHOD_LIMIT)
    return spark


def local_session(cores: str = "8", memory: str = "8g", name: str = "ledgerfold") -> SparkSession:
    """For tests and measurements on one machine."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(name)
             .config("spark.sql.shuffle.partitions", cores).config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", memory).config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
