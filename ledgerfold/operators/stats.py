"""Population statistics: value counts, modes, rare values, top values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfold.functions.scalar import MISSING_CODE
from ledgerfold.operators.blocks import listed_mode, listed_non_dominant, with_runs
from ledgerfold.operators.placed import parted
from ledgerfold.operators.skew import hot_keys

RARE_SHARE = 0.05


def melt(df: DataFrame, cols, keep=(), kind: str = "string") -> DataFrame:
    """(keep…, feature, value) rows, nulls kept. Narrow: it never shuffles."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("value")) for c in cols])
    return df.select(*keep, F.explode(cells).alias("_cell")).select(*keep, "_cell.feature", "_cell.value")


def value_counts(df: DataFrame, cols, kind: str = "int", keep_null: bool = False, keys=()) -> DataFrame:
    """(keys…, feature, value, cnt): counted map-side, so the shuffle carries distinct values."""
    long = melt(df, cols, keys, kind)
    if not keep_null:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy(*keys, "feature", "value").agg(F.count("*").alias("cnt"))


def with_total(counts: DataFrame) -> DataFrame:
    """Adds ``total_cnt`` per feature. The totals table has one row per feature (the number of
    melted columns), which bounds the broadcast; no feature is gathered in one task."""
    totals = counts.groupBy("feature").agg(F.sum("cnt").alias("total_cnt"))
    return counts.join(F.broadcast(totals), "feature")


def mode_of_counts(counts: DataFrame, keys=("feature",)) -> DataFrame:
    """Most frequent value; among equals the smallest."""
    best = F.min_by("value", F.struct((-F.col("cnt")).alias("c"), F.col("value").alias("v")))
    return counts.groupBy(*keys).agg(best.alias("mode_value"))


def global_modes(df: DataFrame, cols) -> DataFrame:
    """One row ``m_<c>``, from value counts: equal values are combined in every task and dealt out
    by value, so no task holds a map of all values. Columns of one type are counted together."""
    cols = list(cols)
    kinds: dict[str, list] = {}
    for c in cols:
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    found = [_modes_row(df, names, kind) for kind, names in kinds.items()]
    return reduce(lambda a, b: a.crossJoin(b), found).select(*["m_" + c for c in cols])  # one row each


def _modes_row(df: DataFrame, cols, kind: str) -> DataFrame:
    best = mode_of_counts(value_counts(df, cols, kind))
    return best.agg(*[F.max(F.when(F.col("feature") == c, F.col("mode_value"))).alias("m_" + c) for c in cols])


def folded_by_entity(df: DataFrame, id_col: str, cols, listed, fold, hot: list | None = None) -> DataFrame:
    """``listed(c)`` of ordinary entities' lists of values (``with_runs``): their narrow rows are dealt out
    by id once, and no table of (id, column, value) is held. ``fold`` of the value counts of hot
    entities, which are combined map-side first."""
    slim = df.select(id_col, *[F.col(c).cast("int").alias(c) for c in cols])
    hot = hot_keys(slim, id_col) if hot is None else hot
    cold_rows, hot_rows = parted(slim, id_col, hot)
    lists = cold_rows.groupBy(id_col).agg(*[F.collect_list(c).alias(f"_list_{c}") for c in cols])
    out = with_runs(lists, {c: f"`_list_{c}`" for c in cols}).select(id_col, *[e for c in cols for e in listed(c)])
    if hot_rows is None:
        return out
    return out.unionByName(fold(value_counts(hot_rows, cols, keys=[id_col], keep_null=True)))


def local_modes(df: DataFrame, id_col: str, cols, hot: list | None = None) -> DataFrame:
    """``lm_<c>`` per entity; null where an entity has no value."""
    return folded_by_entity(df, id_col, cols, lambda c: [listed_mode(c).alias("lm_" + c)],
                            lambda counts: _modes_of_entities(counts, id_col, cols), hot)


def _modes_of_entities(counts: DataFrame, id_col: str, cols) -> DataFrame:
    counts = counts.withColumn(
        "cnt", F.when(F.col("value").isNull(), 0).otherwise(F.col("cnt")))
    best = mode_of_counts(counts, (id_col, "feature"))
    return best.groupBy(id_col).agg(*[
        F.max(F.when(F.col("feature") == c, F.col("mode_value"))).alias("lm_" + c) for c in cols])


def local_non_dominant_counts(df: DataFrame, id_col: str, cols, hot: list | None = None) -> DataFrame:
    """Like the block of the same name, for codes of unknown range. An entity whose codes are all
    null has nulls."""
    return folded_by_entity(df, id_col, cols, lambda c: listed_non_dominant(c, c),
                            lambda counts: off_of_entities(counts, id_col, cols), hot)


def off_of_entities(counts: DataFrame, id_col: str, cols) -> DataFrame:
    per_value = counts.withColumn("cnt", F.when(F.col("value").isNotNull(), F.col("cnt")))
    per_feature = per_value.groupBy(id_col, "feature").agg(F.sum("cnt").alias("n"), F.max("cnt").alias("top"))
    out = []
    for c in cols:
        mine = F.col("feature") == c
        off, n = F.max(F.when(mine, F.col("n") - F.col("top"))), F.max(F.when(mine, F.col("n")))
        out += [off.alias(f"{c}_lnd_count"), (off / n).alias(f"{c}_lnd_share")]
    return per_feature.groupBy(id_col).agg(*out)


def rare_values(counts_with_total: DataFrame, modes: DataFrame, share: float = RARE_SHARE) -> DataFrame:
    """Sorted array of values with a share strictly below the bound, the mode left out. For binned
    columns: the array is as long as the number of rare bins."""
    rare = (F.col("cnt") / F.col("total_cnt") < share) & (F.col("value") != F.col("mode_value"))
    return (counts_with_total.join(F.broadcast(modes), "feature").groupBy("feature")
            .agg(F.sort_array(F.collect_list(F.when(rare, F.col("value")))).alias("rare_bins")))


def fit_population_stats(df: DataFrame, cols, train_ids: DataFrame | None = None, id_col: str | None = None,
                         rare_share: float = RARE_SHARE) -> DataFrame:
    """(feature, mode_value, rare_bins) for binned columns, on the rows of the train ids only.

    A feature without any value gets mode -999, one without rare values gets [-999]."""
    source = df if train_ids is None else df.join(train_ids.select(id_col), id_col, "left_semi")
    return stats_of(source, cols, rare_share)


def stats_of(df: DataFrame, cols, rare_share: float = RARE_SHARE) -> DataFrame:
    return stats_of_counts(value_counts(df, cols, keep_null=True), rare_share)


def stats_of_counts(counts: DataFrame, rare_share: float = RARE_SHARE) -> DataFrame:
    """(feature, mode_value, rare_bins) from (feature, value, cnt) with null cells counted too: they weigh
    nothing, but a column without values keeps its row. A feature's counts are gathered once, as many
    as it has different values, which for binned columns is the number of bins."""
    weighed = counts.withColumn("cnt", F.when(F.col("value").isNull(), F.lit(0)).otherwise(F.col("cnt")))
    found = weighed.groupBy("feature").agg(
        F.sum("cnt").alias("total"), F.collect_list(F.struct("value", "cnt")).alias("bins"),
        F.min_by("value", F.struct((-F.col("cnt")).alias("c"), F.col("value").alias("v"))).alias("mode"))
    rare = F.filter("bins", lambda b: (b["cnt"] > 0) & (b["cnt"] / F.col("total") < rare_share) & (b["value"] != F.col("mode")))
    lists = F.sort_array(F.transform(rare, lambda b: b["value"]))
    return found.select(
        "feature", F.coalesce("mode", F.lit(MISSING_CODE)).alias("mode_value"),
        F.when(F.size(rare) == 0, F.array(F.lit(MISSING_CODE))).otherwise(lists).alias("rare_bins"))


def inject_stats(df: DataFrame, stats: DataFrame, cols, name: str = "_stats") -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
    """Makes the fitted statistics available to every row as one scalar subquery: it is computed
    once, has one row, and acts as a constant in generated code.

    Returns (frame, modes by column, rare arrays by column)."""
    def of(c, what):
        return F.max(F.when(F.col("feature") == c, F.col(what)))

    one_row = stats.agg(
        *[F.coalesce(of(c, "mode_value"), F.lit(MISSING_CODE)).alias("m_" + c) for c in cols],
        *[F.coalesce(of(c, "rare_bins"), F.array(F.lit(MISSING_CODE))).alias("rare_" + c) for c in cols],
    ).select(F.struct("*"))
    return df.withColumn(name, one_row.scalar()), mode_columns(cols, name), rare_columns(cols, name)


def mode_columns(cols, name: str = "_modes") -> dict[str, Column]:
    return {c: F.col(f"{name}.m_{c}") for c in cols}


def rare_columns(cols, name: str = "_stats") -> dict[str, Column]:
    return {c: F.col(f"{name}.rare_{c}") for c in cols}


def inject_modes(df: DataFrame, modes: DataFrame, cols, name: str = "_modes") -> tuple[DataFrame, dict[str, Column]]:
    """The one row of ``global_modes`` as a constant on every row."""
    one = modes.select(F.struct(*["m_" + c for c in cols]))
    return df.withColumn(name, one.scalar()), mode_columns(cols, name)


def top_values(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent values per feature with their rank; equal counts by value. The rank
    filter is applied in every task before the shuffle, so one feature with very many values
    sends n rows per task."""
    win = W.partitionBy("feature").orderBy(F.col("cnt").desc(), F.col("value").asc())
    return counts.withColumn("rank", F.row_number().over(win)).where(F.col("rank") <= n)


def collapse_rare(df: DataFrame, cols, tops: DataFrame, other: str, keep_null: bool = False) -> DataFrame:
    """Values outside the top table become ``other``. The top table (n per column) is collected
    into literals, so the rewrite is a row-local expression."""
    rows = tops.where(F.col("feature").isin(list(cols))).select("feature", "value").collect()
    found: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        found[r["feature"]].append(r["value"])
    return df.withColumns({c: collapse_value(c, found[c], other, keep_null) for c in cols})


def collapse_value(c: str, top: list, other: str, keep_null: bool = False) -> Column:
    x = F.col(c)
    out = F.when(x.isin(top), x)
    if keep_null:
        out = out.when(x.isNull(), F.lit(None))
    return out.otherwise(F.lit(other))


def max_value_share(df: DataFrame, cols) -> DataFrame:
    """(feature, top_share): share of the most frequent value, a null being a value."""
    counts = value_counts(df, cols, kind="string", keep_null=True)
    return counts.groupBy("feature").agg((F.max("cnt") / F.sum("cnt")).alias("top_share"))


def missing_share(df: DataFrame, cols) -> DataFrame:
    """(feature, missing_share): one pass over all columns."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in cols])
    return melt(row, cols, kind="double").select("feature", F.col("value").alias("missing_share"))
