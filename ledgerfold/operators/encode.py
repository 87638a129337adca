"""Category encoders fitted on training rows, and mutual information with the label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.operators.ordered import with_running_sums
from ledgerfold.operators.stats import melt, value_counts
from ledgerfold.sources.scratch import written

BROADCAST_ROWS = 100_000
SALTS = 16


def fit_categories(df: DataFrame, cols) -> DataFrame:
    """(feature, value, code): distinct values in sorted order, numbered from 0. Text columns may
    have very many values, so the order is taken inside ranges of them."""
    distinct = value_counts(df, cols, kind="string").select("feature", "value").withColumn("_one", F.lit(1))
    ranked = with_running_sums(distinct, "value", ["_one"], ["feature"])
    return ranked.select("feature", "value", F.col("before__one").cast("int").alias("code"))


def categories_of(fitted: DataFrame, cols, limit: int = 10_000) -> dict[str, list[str]]:
    """Fitted categories as lists, for encoders that make one column per category; more than
    ``limit`` columns are refused. ``ordinal_encode`` and ``freeze_categories`` have no limit."""
    rows = fitted.where(F.col("feature").isin(list(cols))).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories in {list(cols)}; collapse them first or use ordinal_encode")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in sorted(rows, key=lambda r: (r["feature"], r["code"])):
        out[r["feature"]].append(r["value"])
    return out


def _with_codes(df: DataFrame, cols, fitted: DataFrame) -> DataFrame:
    """Adds ``_code_<c>``. The fitted table is written once and met once per column: by broadcast
    up to BROADCAST_ROWS rows, counted first; beyond that by a join on value and one of SALTS salts,
    so that a value which many rows share is no hot key. Nulls join nothing and are spread."""
    table = written(fitted.select("feature", "value", "code"), "categories")
    small = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    out = df
    for c in cols:
        own = table.where(F.col("feature") == c).select(F.col("value").alias("_v"), F.col("code").alias(f"_code_{c}"))
        match = F.col(c).cast("string") == F.col("_v")
        if small:
            own = F.broadcast(own)
        else:
            own = own.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            out = out.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
            match = match & (F.col("_salt") == F.col("_s"))
        out = out.join(own, match, "left").drop("_v", "_s", "_salt")
    return out


def ordinal_encode(df: DataFrame, cols, fitted: DataFrame, unseen: int = -1) -> DataFrame:
    """Adds ``<c>_code``; a value not in the fitted table gives ``unseen``."""
    coded = _with_codes(df, cols, fitted)
    return coded.select(*df.columns, *[F.coalesce(f"_code_{c}", F.lit(unseen)).alias(f"{c}_code") for c in cols])


def one_hot_encode(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """0/1 column per fitted category; an unseen value gives zeros, a missing column gives 0."""
    new = {}
    for c, values in categories.items():
        for v in values:
            hit = (F.col(c).cast("string") == v) if c in df.columns else F.lit(False)
            new[f"{c}_{v}"] = F.coalesce(hit, F.lit(False)).cast("int")
    return df.select(*[c for c in df.columns if c not in categories], *[e.alias(n) for n, e in new.items()])


def freeze_categories(df: DataFrame, cols, fitted: DataFrame) -> DataFrame:
    """Values not in the fitted table become null; any number of categories."""
    coded = _with_codes(df, cols, fitted)
    frozen = set(cols)
    return coded.select(*[F.when(F.col(f"_code_{c}").isNotNull(), F.col(c)).alias(c) if c in frozen else F.col(c) for c in df.columns])


def mutual_information(df: DataFrame, cols, label: str) -> DataFrame:
    """(feature, mi) in nats between each discrete column and the label; nulls are a value.

    I = ln N + (sum n ln n over the joint counts - the same over both margins) / N. One shuffle of
    (feature, value, label) counts; the margins are sums of it, and nothing is joined."""
    joint = (melt(df.where(F.col(label).isNotNull()), cols, [label], "string")
             .withColumn("value", F.coalesce(F.concat(F.lit("v"), F.col("value")), F.lit("n")))
             .groupBy("feature", "value", label).agg(F.count("*").alias("n")))
    weight = F.sum(F.col("n") * F.log("n"))
    parts = [joint.groupBy("feature").agg(weight.alias("s"), F.sum("n").alias("n"))]
    for key in ("value", label):
        margin = joint.groupBy("feature", key).agg(F.sum("n").alias("n"))
        parts.append(margin.groupBy("feature").agg((-weight).alias("s"), F.lit(0).cast("bigint").alias("n")))
    n = F.sum("n")
    return parts[0].union(parts[1]).union(parts[2]).groupBy("feature").agg((F.log(n) + F.sum("s") / n).alias("mi"))
