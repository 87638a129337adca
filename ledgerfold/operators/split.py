"""Train / validation / test by entity. The split depends on the entity key alone, so every job,
retry and later run puts an entity on the same side."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.scalar import null_fraction
from ledgerfold.operators.ordered import with_running_sums

SPLITS = ("train", "val", "test")


def filter_bad_rows(df: DataFrame, max_missing: float = 0.5, cols=None) -> DataFrame:
    """Keeps rows whose share of null cells is at most ``max_missing``."""
    return df.where(null_fraction(cols or df.columns) <= max_missing)


def split_hash(id_col: str, seed: int) -> Column:
    return F.substring(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}"))), 1, 8)


def hex_bound(share: float) -> str:
    """The 8-digit hex text below which the given share of hashes lies."""
    return format(min(int(share * 2**32), 2**32 - 1), "08x")


def check_sizes(df: DataFrame, id_col: str, test: float, val: float) -> None:
    if test < 0 or val < 0 or test + val >= 1.0:
        raise ValueError("test and val must be >= 0 and their sum below 1")
    if id_col not in df.columns:
        raise ValueError(f"no column {id_col!r} to split by")


def entity_split(df: DataFrame, id_col: str, test: float = 0.2, val: float = 0.1, seed: int = 42,
                 name: str = "split") -> DataFrame:
    """Adds the split of each row's entity: row-local, no shuffle."""
    check_sizes(df, id_col, test, val)
    h = split_hash(id_col, seed)
    out = F.when(F.lit(test > 0) & (h < hex_bound(test)), "test")
    out = out.when(F.lit(val > 0) & (h < hex_bound(test + val)), "val")
    return df.withColumn(name, out.otherwise("train"))


def stratified_entity_split(ids: DataFrame, id_col: str, label: str, test: float = 0.2, val: float = 0.1,
                            seed: int = 42, name: str = "split") -> DataFrame:
    """Split of unique ids with exact proportions per label: the share of ids of a label, in the
    order of their hash. Ids without a label are a stratum of their own. A label may hold nearly all
    ids, so the order is taken inside ranges and shifted by the counts of earlier ones. If a label has too few ids to be divided (one), the split falls
    back to ``entity_split`` for all, with a warning."""
    check_sizes(ids, id_col, test, val)
    if not ids.groupBy(label).agg(F.count("*").alias("n")).where("n < 2").isEmpty():
        warnings.warn(f"a value of {label!r} has a single id; splitting without strata", stacklevel=2)
        return entity_split(ids.select(id_col, label), id_col, test, val, seed, name)
    keyed = (ids.select(id_col, label)
             .withColumn("_h", F.concat(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}"))), F.lit("|"), F.col(id_col).cast("string")))
             .withColumn("_one", F.lit(1)))
    ranked = with_running_sums(keyed, "_h", ["_one"], [label])
    at, n = F.col("before__one"), F.col("total__one")
    out = F.when(at < F.round(n * F.lit(float(test))), "test")
    out = out.when(at < F.round(n * F.lit(float(test))) + F.round(n * F.lit(float(val))), "val")
    return ranked.select(id_col, label, out.otherwise("train").alias(name))


def ids_in_two_splits(df: DataFrame, id_col: str, split: str = "split") -> DataFrame:
    """Entities seen in more than one split (must be empty)."""
    return (df.groupBy(id_col).agg(F.min(split).alias("first_split"), F.max(split).alias("last_split"))
            .where(F.col("first_split") != F.col("last_split")))


def last_label_per_id(df: DataFrame, id_col: str, label: str, order_col: str) -> DataFrame:
    return df.groupBy(id_col).agg(F.max_by(label, order_col).alias(label))


def rows_of_split(df: DataFrame, splits: DataFrame, id_col: str, wanted: str) -> DataFrame:
    return df.join(splits.where(F.col("split") == wanted).select(id_col), id_col, "left_semi")
