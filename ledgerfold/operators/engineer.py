"""Derived columns of an entity table. Column names are parameters; an output whose inputs are
not there is not made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.naming import select_names
from ledgerfold.functions.scalar import any_above, at_least, bucket_label, code_text, concat_codes, row_mean

# Thresholds of the two payer flags.
PERFECT_SHARE = 0.95
CHRONIC_ANY_SHARE = 0.3
CHRONIC_SERIOUS_SHARE = 0.0


def typicalness(df: DataFrame, mode_suffix: str = "_share_global_mode", rare_suffix: str = "_share_rare_bins") -> DataFrame:
    new = {}
    for name, suffix in (("overall_typicalness_score", mode_suffix), ("overall_anomaly_score", rare_suffix)):
        cols = select_names(df.columns, suffixes=(suffix,))
        if cols:
            new[name] = row_mean(cols)
    return df.withColumns(new) if new else df


def payer_flags(df: DataFrame, good_share: str, any_share: str, serious_share: str) -> DataFrame:
    new = {}
    if good_share in df.columns:
        new["is_absolutely_perfect_payer"] = at_least(good_share, PERFECT_SHARE)
    if any_share in df.columns and serious_share in df.columns:
        new["is_chronic_defaulter"] = any_above([(any_share, CHRONIC_ANY_SHARE), (serious_share, CHRONIC_SERIOUS_SHARE)])
    return df.withColumns(new) if new else df


def code_transitions(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """output name -> (column, column)"""
    new = {n: concat_codes(a, b) for n, (a, b) in pairs.items() if a in df.columns and b in df.columns}
    return df.withColumns(new) if new else df


def util_and_history(df: DataFrame, code: str, share: str, name: str = "cat_util_and_history") -> DataFrame:
    if code not in df.columns or share not in df.columns:
        return df
    return df.withColumn(name, F.concat_ws("_", code_text(code), bucket_label(share)))


def diversity_profile(df: DataFrame, kinds: str, total: str, name: str = "cat_diversity_profile") -> DataFrame:
    if kinds not in df.columns or total not in df.columns:
        return df
    text = [F.coalesce(F.col(c).cast("bigint"), F.lit(0)).cast("string") for c in (kinds, total)]
    return df.withColumn(name, F.concat(text[0], F.lit("types_"), text[1], F.lit("loans")))


def engineer(df: DataFrame, *, good_share: str, any_share: str, serious_share: str, last_code: str,
             transitions: dict[str, tuple[str, str]], kinds: str, total: str) -> DataFrame:
    """All derived columns; one projection after optimisation."""
    out = payer_flags(typicalness(df), good_share, any_share, serious_share)
    out = util_and_history(code_transitions(out, transitions), last_code, any_share)
    return diversity_profile(out, kinds, total)
