"""Why a score is what it is: exact contributions of a linear model, permutation importance."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.operators.evaluate import worst_false_positives
from ledgerfold.operators.ordered import with_running_sums
from ledgerfold.operators.stats import melt
from ledgerfold.sources.scratch import written


def contributions(df: DataFrame, weights: dict[str, float], keep=()) -> DataFrame:
    """(keep…, feature, contribution) with contribution = weight * (x - mean of x); the means are
    one row, used as constants."""
    cols = list(weights)
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).select(F.struct("*")).scalar()
    wide = df.withColumn("_m", means).select(
        *keep, *[(F.lit(float(weights[c])) * (F.col(c) - F.col(f"_m.{c}"))).alias(c) for c in cols])
    return melt(wide, cols, keep, "double").withColumnRenamed("value", "contribution")


def global_attribution(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(feature, mean_abs): mean absolute contribution."""
    return contributions(df, weights).groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))


def local_attribution(df: DataFrame, weights: dict[str, float], id_col: str, actual: str, probability: str, n: int = 10) -> DataFrame:
    """Contributions of the n most confident false positives; means come from all rows."""
    cols = list(weights)
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).select(F.struct("*")).scalar()
    bad = worst_false_positives(df, actual, probability, id_col, n).withColumn("_m", means)
    wide = bad.select(id_col, *[(F.lit(float(weights[c])) * (F.col(c) - F.col(f"_m.{c}"))).alias(c) for c in cols])
    return melt(wide, cols, [id_col], "double").withColumnRenamed("value", "contribution")


def one_row(df: DataFrame, weights: dict[str, float], id_col: str, wanted) -> DataFrame:
    """Contributions of one entity."""
    return contributions(df, weights, [id_col]).where(F.col(id_col) == F.lit(wanted))


def ranked(df: DataFrame, key: str, name: str, seed: int) -> DataFrame:
    """Adds the position of each row in the order of a seeded digest of its key."""
    h = df.withColumn("_h", F.concat(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), F.lit("|"), F.col(key).cast("string")))
    run = with_running_sums(h.withColumn("_one", F.lit(1)), "_h", ["_one"])
    return run.withColumn(name, F.col("before__one")).select(*df.columns, name)


def with_shuffled(df: DataFrame, key: str, cols, seed: int) -> DataFrame:
    """The frame with ``_new_<c>`` for each column: the values of the row at another random rank.
    Two rankings and one join serve all columns."""
    cols = list(cols)
    values = ranked(df.select(key, *cols), key, "_rank", seed + 1).select("_rank", *[F.col(c).alias("_new_" + c) for c in cols])
    return ranked(df, key, "_rank", seed).join(values, "_rank").drop("_rank")


def shuffled(df: DataFrame, key: str, column: str, seed: int) -> DataFrame:
    """The frame with one column permuted."""
    return with_shuffled(df, key, [column], seed).withColumn(column, F.col("_new_" + column)).select(*df.columns)


def permutation_importance(model: PipelineModel, df: DataFrame, key: str, cols, evaluator, seed: int = 42) -> DataFrame:
    """(feature, importance): how much the metric worsens when a column is permuted. The table with
    all permuted columns is written once."""
    both = written(with_shuffled(df, key, cols, seed), "shuffled")
    base = evaluator.evaluate(model.transform(both.select(*df.columns)))
    sign = 1.0 if evaluator.isLargerBetter() else -1.0

    def without(c):
        return both.select(*[F.col("_new_" + c).alias(c) if n == c else F.col(n) for n in df.columns])

    rows = [(c, sign * (base - evaluator.evaluate(model.transform(without(c))))) for c in cols]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")
