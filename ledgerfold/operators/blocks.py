"""Aggregate blocks of the entity table. A block is a list of aggregate columns, so any number of
blocks share one groupBy(id): one shuffle, combined map-side, whatever the size of an entity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.scalar import (
    BITS_PER_WORD, any_flag_off, code_bit, flag_int, false_if_null, not_flag_int, safe_ratio)


def distinct_codes(c: str, n_bins: int | None = None) -> Column:
    """Exact COUNT(DISTINCT code) of any codes; the buffer holds an entity's different codes. Who
    knows the range can declare it: 0..n_bins-1 are counted in a bit set of fixed width, which stays
    a hash aggregate, and a code outside fails the job."""
    if n_bins is None:
        return F.size(F.collect_set(c)).cast("bigint")
    words = range((n_bins + BITS_PER_WORD - 1) // BITS_PER_WORD)
    parts = [F.bit_count(F.coalesce(F.bit_or(code_bit(c, w, n_bins)), F.lit(0).cast("bigint"))) for w in words]
    return reduce(lambda a, b: a + b, parts).cast("bigint")


def history_counts(rn: str) -> list[Column]:
    return [F.count("*").alias("loans_total_count"), F.max(rn).alias("loans_max_rn")]


def base_counters(rn: str, flags) -> list[Column]:
    out = [
        F.count("*").alias("num_credits"), F.max(rn).alias("max_rn"), F.min(rn).alias("min_rn"),
        (F.max(rn) - F.min(rn)).alias("rn_span"),
        (F.count("*") == 1).cast("int").alias("is_single_credit"),
        safe_ratio(F.count("*"), F.max(rn)).alias("rn_density"),
    ]
    for f in flags:
        out += [F.avg(flag_int(f)).alias(f"{f}_share"), F.max(flag_int(f)).alias(f"{f}_any")]
    return out


def snapshots(cols, order: str, which: str) -> list[Column]:
    pick = {"first": F.min_by, "last": F.max_by}[which]
    return [pick(c, order).alias(f"{which}_{c}") for c in cols]


def edge_values(last, first, equal, order: str) -> list[Column]:
    """``snapshots`` of both ends and ``first_eq_last``, from one first and one last row per entity, each
    kept as a struct: two aggregates, however many columns."""
    ends = {}
    for which, pick, cols in (("last", F.max_by, last), ("first", F.min_by, first)):
        if row := list(dict.fromkeys([*cols, *equal])):
            ends[which] = pick(F.struct(*row), order)
    return [*[ends["last"][c].alias(f"last_{c}") for c in last], *[ends["first"][c].alias(f"first_{c}") for c in first],
            *[(ends["first"][c] == ends["last"][c]).alias(f"{c}_first_eq_last") for c in equal]]


def flag_shares(shares, ever=None) -> list[Column]:
    """Mean of each flag; for ``ever`` (name -> flag) whether the flag was ever off."""
    out = [F.avg(flag_int(f)).alias(f"{f}_share") for f in shares]
    return out + [F.max(not_flag_int(f)).alias(name) for name, f in (ever or {}).items()]


def zero_flags(flags, off_name: str, counted=()) -> list[Column]:
    """Per zero-indicator (name -> flag): share of rows at zero, whether any row is off zero and,
    for names in ``counted``, how many."""
    out = []
    for name, f in flags.items():
        out += [F.avg(flag_int(f)).alias(f"{name}_zero_share"), F.max(not_flag_int(f)).alias(f"{name}_{off_name}")]
        if name in counted:
            out.append(F.sum(not_flag_int(f)).alias(f"{name}_nonzero_count"))
    return out


def composite_overdue(serious, any_, mild: str) -> list[Column]:
    out = []
    for name, flags in (("serious", serious), ("any", any_)):
        e = any_flag_off(flags)
        out += [F.max(e).alias(f"has_{name}_overdue"), F.sum(e).alias(f"count_{name}_overdue"),
                F.avg(e).alias(f"share_{name}_overdue")]
    return out + [safe_ratio(F.sum(any_flag_off(serious)), F.sum(not_flag_int(mild))).alias("serious_to_mild_ratio")]


def global_non_dominant(modes: dict[str, Column]) -> list[Column]:
    """Count and share of rows that differ from the population mode; null rows do not count."""
    out = []
    for c, m in modes.items():
        differs = (F.col(c) != m).cast("int")
        out += [F.sum(differs).alias(f"{c}_gnd_count"), F.avg(differs).alias(f"{c}_gnd_share")]
    return out


def local_non_dominant(cols, n_bins: int) -> list[Column]:
    """Count and share of rows that differ from the entity's own mode: present rows minus the
    largest value count. One counter per code of a small declared range; for any codes there is
    ``stats.local_non_dominant_counts``."""
    out = []
    for c in cols:
        x = F.col(c)
        hits = [F.count(F.when(x == v, 1)) for v in range(n_bins)]
        largest = F.greatest(*hits) if n_bins > 1 else hits[0]
        n = F.count(x)
        known = F.when(reduce(lambda a, b: a + b, hits) == n, n).otherwise(
            F.raise_error(F.lit(f"{c}: code outside 0..{n_bins - 1}")))
        out += [F.when(n > 0, known - largest).alias(f"{c}_lnd_count"),
                safe_ratio(known - largest, n).alias(f"{c}_lnd_share")]
    return out


def listed_text(values: str) -> Column:
    """The values of an ordered list as one text, nulls skipped; null if none."""
    return F.nullif(F.array_join(F.col(values).cast("array<string>"), ""), F.lit(""))


def listed_distinct(values: str) -> Column:
    return F.expr(f"cast(size(array_except({values}, array(null))) as bigint)")


def with_runs(df: DataFrame, lists: dict[str, str]) -> DataFrame:
    """Adds for each list (name -> expression) ``_sorted_<name>``, its values without nulls in order,
    ``_ends_<name>``, where the stretches of equal values end, and ``_runs_<name>``, how long they are.
    Columns of their own, one after another, since a lambda would make its lists anew for every element."""
    out = df.withColumns({f"_sorted_{n}": F.expr(f"sort_array(array_compact({e}))") for n, e in lists.items()})
    out = out.withColumns({f"_ends_{n}": F.expr(
        f"""IF(size(`_sorted_{n}`) = 0, cast(array() AS array<int>), filter(sequence(1, size(`_sorted_{n}`)),
            i -> NOT get(`_sorted_{n}`, i) <=> get(`_sorted_{n}`, i - 1)))""") for n in lists})
    return out.withColumns({f"_runs_{n}": F.expr(f"transform(`_ends_{n}`, (e, j) -> e - coalesce(get(`_ends_{n}`, j - 1), 0))") for n in lists})


def listed_mode(name: str) -> Column:
    """Most frequent value of a list of ``with_runs``, among equals the smallest; null if it has none."""
    return F.expr(f"get(`_sorted_{name}`, get(`_ends_{name}`, int(array_position(`_runs_{name}`, array_max(`_runs_{name}`))) - 1) - 1)")


def listed_non_dominant(name: str, c: str) -> list[Column]:
    """``local_non_dominant`` of column ``c`` from a list of ``with_runs``, of any codes."""
    n = F.size(f"_sorted_{name}").cast("bigint")
    off = n - F.array_max(f"_runs_{name}")
    return [F.when(n > 0, off).alias(f"{c}_lnd_count"), safe_ratio(off, n).alias(f"{c}_lnd_share")]


def distinct_counts(cols, n_bins: int | None = None) -> list[Column]:
    return [distinct_codes(c, n_bins).alias(f"distinct_{c}_count") for c in cols]


def ever_changed(cols, n_bins: int | None = None) -> list[Column]:
    return [(distinct_codes(c, n_bins) > 1).alias(f"{c}_ever_changed") for c in cols]


def first_eq_last(cols, order: str) -> list[Column]:
    return [(F.min_by(c, order) == F.max_by(c, order)).alias(f"{c}_first_eq_last") for c in cols]


def change_flag(c: str, prefix: str = "prev_") -> Column:
    return (F.col(c) != F.col(prefix + c)).cast("int")


def change_counts(cols, prefix: str = "prev_") -> list[Column]:
    """Rows whose code differs from the preceding row; null for a one-row entity.
    Needs the columns of ``with_previous``."""
    return [F.sum(change_flag(c, prefix)).alias(f"{c}_change_count") for c in cols]


def changed_ever(cols, prefix: str = "prev_") -> list[Column]:
    return [F.max(change_flag(c, prefix)).alias(f"{c}_changed_ever") for c in cols]


def share_global_mode(modes: dict[str, Column], null_as_zero: bool = True) -> list[Column]:
    return [F.avg(_hit(F.col(c) == m, null_as_zero)).alias(f"{c}_share_global_mode") for c, m in modes.items()]


def share_rare_bins(rare: dict[str, Column], null_as_zero: bool = True) -> list[Column]:
    return [F.avg(_hit(F.array_contains(r, F.col(c)), null_as_zero)).alias(f"{c}_share_rare_bins") for c, r in rare.items()]


def _hit(cond: Column, null_as_zero: bool) -> Column:
    return false_if_null(cond) if null_as_zero else cond.cast("int")


def nunique_first_last(cols, order: str, n_bins: int | None = None) -> list[Column]:
    out = []
    for c in cols:
        out += [distinct_codes(c, n_bins).alias(f"{c}_nunique"), F.min_by(c, order).alias(f"{c}_first"),
                F.max_by(c, order).alias(f"{c}_last")]
    return out
