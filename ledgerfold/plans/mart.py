"""Entity tables. All blocks of a mart are columns of one groupBy(id)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.operators import blocks as B
from ledgerfold.operators import grid as G
from ledgerfold.operators.ordered import aggregate_entities, ordered_text, with_previous
from ledgerfold.operators.placed import PlacedHistory, hot_of, parted, rows_of_history
from ledgerfold.operators.stats import (
    global_modes, inject_modes, inject_stats, mode_columns, off_of_entities, rare_columns, value_counts)
from ledgerfold.sources.readers import join_target


@dataclass(frozen=True)
class GridSpec:
    pattern: str
    special: tuple = ()
    n_codes: int | None = None
    normal: tuple = (0, 3)
    special_normal: tuple = (4, 1)
    worst: int = 3
    ever: int = 2
    shares: tuple = (0, 1, 3, 4)


@dataclass(frozen=True)
class HistorySpec:
    """Where the keys are. ``order`` is unique within an entity. ``n_bins`` declares that codes are
    0..n_bins-1; None takes any codes."""

    id: str = "id"
    rn: str = "rn"
    order: str = "rn"
    n_bins: int | None = None


@dataclass(frozen=True)
class SnapshotMart:
    """Columns of the first mart."""

    last: tuple
    first: tuple
    shares: tuple
    ever_off: dict
    coded: tuple
    local: tuple
    distinct: tuple
    sequences: tuple
    first_eq_last: tuple
    grid: GridSpec
    local_bins: int | None = None


@dataclass(frozen=True)
class LeakFreeMart:
    """Columns of the second mart. ``coded`` maps a column to the features it gets."""

    flags: tuple
    overdue: dict
    usage: dict
    usage_counted: tuple
    serious: tuple
    any: tuple
    mild: str
    coded: dict
    grid: GridSpec
    order_of_features: tuple = field(default=(
        "nunique", "first", "last", "change_count", "changed_ever", "share_global_mode", "share_rare_bins"))

    def having(self, feature: str) -> list[str]:
        return [c for c, fs in self.coded.items() if feature in fs]


def mart_v1(df: DataFrame | PlacedHistory, keys: HistorySpec, spec: SnapshotMart, target: DataFrame | None = None,
            hot: list | None = None) -> DataFrame:
    """Snapshots, flag shares, distance from population and own modes, diversity, code sequences
    and the month grid, one row per entity. The population mode is that of the rows given.

    Ordinary entities take one exchange and one aggregate (none and one over a placed history): what
    needs an entity's values together (ordered text, own modes, distinct codes, entropy of
    the grid) is folded from one list of its rows, in the row that the aggregate makes. Hot
    entities have no such list: their counts are combined in every task, their text is cut into
    segments, and the parts, one row per hot entity, are joined."""
    rows = df.where(F.col(keys.id).isNotNull())
    hot = hot_of(rows, keys.id, hot)
    population = global_modes(rows_of_history(rows), spec.coded)
    cold, hot_rows = parted(rows, keys.id, hot)
    out = folded_snapshots(inject_modes(cold, population, spec.coded)[0], keys, spec)
    if hot_rows is not None:
        out = out.unionByName(hot_snapshots(hot_rows, population, keys, spec))
    return join_target(out, target, keys.id) if target is not None else out


def snapshot_columns(columns, keys: HistorySpec, spec: SnapshotMart, distinct: bool) -> list:
    """What both kinds of entities aggregate alike."""
    g = spec.grid
    return [
        *B.history_counts(keys.rn),
        *B.edge_values(spec.last, spec.first, spec.first_eq_last, keys.order),
        *B.flag_shares(spec.shares, spec.ever_off),
        *B.global_non_dominant(mode_columns(spec.coded)),
        *(B.local_non_dominant(spec.local, spec.local_bins) if spec.local_bins else ()),
        *([*B.distinct_counts(spec.distinct, keys.n_bins), *B.ever_changed(spec.sequences, keys.n_bins)] if distinct else ()),
        *G.grid_regular(columns, g.pattern, g.special, g.normal, g.ever, g.n_codes),
        *G.grid_special(columns, g.pattern, g.special, g.special_normal, g.worst),
    ]


def folded_snapshots(rows: DataFrame, keys: HistorySpec, spec: SnapshotMart) -> DataFrame:
    g = spec.grid
    regular, _ = G.split_months(rows.columns, g.pattern, g.special)
    listed = list(dict.fromkeys([*spec.sequences, *(() if keys.n_bins else spec.distinct), *(() if spec.local_bins else spec.local)]))
    cells = [F.array(*regular).alias("_cells")] if g.n_codes is None and regular else []
    wide = rows.groupBy(keys.id).agg(
        *snapshot_columns(rows.columns, keys, spec, bool(keys.n_bins)),
        F.sort_array(F.collect_list(F.struct(F.col(keys.order).alias("_order"), *listed, *cells))).alias("_rows"))
    made = [B.listed_text(f"_rows.{c}").alias(f"{c}_bin_sequence") for c in spec.sequences]
    if not keys.n_bins:
        made += [B.listed_distinct(f"_rows.{c}").alias(f"distinct_{c}_count") for c in spec.distinct]
        made += [(B.listed_distinct(f"_rows.{c}") > 1).alias(f"{c}_ever_changed") for c in spec.sequences]
    runs = {} if spec.local_bins else {f"own_{c}": f"_rows.`{c}`" for c in spec.local}
    made += [e for c in spec.local if not spec.local_bins for e in B.listed_non_dominant(f"own_{c}", c)]
    if g.n_codes is None:
        runs |= {"cells": "flatten(_rows._cells)"} if cells else {}
        made.append((G.listed_entropy("cells") if cells else F.lit(None).cast("double")).alias("paym_regular_entropy"))
    return (B.with_runs(wide, runs) if runs else wide).select(*[c for c in wide.columns if c != "_rows"], *made)


def hot_snapshots(rows: DataFrame, population: DataFrame, keys: HistorySpec, spec: SnapshotMart) -> DataFrame:
    g = spec.grid
    out = inject_modes(rows, population, spec.coded)[0].groupBy(keys.id).agg(*snapshot_columns(rows.columns, keys, spec, True))
    out = out.join(ordered_text(rows, keys.id, keys.order, spec.sequences), keys.id, "left")
    if spec.local and not spec.local_bins:
        out = out.join(off_of_entities(value_counts(rows, spec.local, keys=[keys.id], keep_null=True), keys.id, spec.local), keys.id, "left")
    if g.n_codes is None:
        entropy = G.grid_entropy(rows, keys.id, g.pattern, g.special)
        out = out.join(entropy.select(keys.id, F.col("grid_entropy").alias("paym_regular_entropy")), keys.id, "left")
    return out


def mart_v2(df: DataFrame | PlacedHistory, keys: HistorySpec, spec: LeakFreeMart, stats: DataFrame, target: DataFrame | None = None,
            null_as_zero: bool = True, hot: list | None = None) -> DataFrame:
    """The leak-free mart: population statistics come from outside (training entities only). A
    placed history is aggregated without any exchange of its rows."""
    rows = df.where(F.col(keys.id).isNotNull())
    changing = list(dict.fromkeys(spec.having("change_count") + spec.having("changed_ever")))
    hot = hot_of(rows, keys.id, hot)
    modes, rare = mode_columns(spec.coded, "_stats"), rare_columns(spec.coded)
    g = spec.grid

    def in_order(part, hot_):
        # after the shuffle, so that it carries the columns as they are and no copy of the statistics
        part = inject_stats(part, stats, list(spec.coded))[0]
        part = part.select("*", *G.grid_row_stats(rows.columns, g.pattern, g.shares, g.n_codes))
        return with_previous(part, keys.id, keys.order, changing, hot_ or []) if changing else part

    out = aggregate_entities(rows, keys.id, [
        *B.base_counters(keys.rn, spec.flags),
        *B.zero_flags(spec.overdue, "has_overdue"),
        *B.zero_flags(spec.usage, "has_nonzero", spec.usage_counted),
        *B.composite_overdue(spec.serious, spec.any, spec.mild),
        *G.grid_entity_agg(g.shares),
        *coded_block(spec, keys, modes, rare, null_as_zero),
    ], hot, in_order)
    return join_target(out, target, keys.id) if target is not None else out


def coded_block(spec: LeakFreeMart, keys: HistorySpec, modes: dict, rare: dict, null_as_zero: bool) -> list:
    out = []
    for c, wanted in spec.coded.items():
        made = {
            "nunique": lambda: B.distinct_codes(c, keys.n_bins).alias(f"{c}_nunique"),
            "first": lambda: F.min_by(c, keys.order).alias(f"{c}_first"),
            "last": lambda: F.max_by(c, keys.order).alias(f"{c}_last"),
            "change_count": lambda: B.change_counts([c])[0],
            "changed_ever": lambda: B.changed_ever([c])[0],
            "share_global_mode": lambda: B.share_global_mode({c: modes[c]}, null_as_zero)[0],
            "share_rare_bins": lambda: B.share_rare_bins({c: rare[c]}, null_as_zero)[0],
        }
        out += [made[f]() for f in spec.order_of_features if f in wanted]
    return out
