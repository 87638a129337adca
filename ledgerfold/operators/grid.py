"""Wide month grids: one status column per month.

Per-row statistics and per-entity counts are written as plain column arithmetic over the month
columns. The long form (rows times months) is never shuffled; it exists only as an operator of
its own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.functions.naming import grid_columns, select_names
from ledgerfold.functions.scalar import count_equal, count_present, row_bits, safe_ratio, sum_of


def unpivot_grid(df: DataFrame, id_cols, pattern: str, name: str = "month", value: str = "status") -> DataFrame:
    """Long form (ids, month number, status); empty cells are dropped."""
    months = grid_columns(df.columns, pattern)
    cells = F.array(*[F.struct(F.lit(m).alias(name), F.col(c).alias(value)) for m, c in months])
    return (df.select(*id_cols, F.explode(cells).alias("_cell"))
            .select(*id_cols, f"_cell.{name}", f"_cell.{value}").where(F.col(value).isNotNull()))


def split_months(columns, pattern: str, special) -> tuple[list[str], list[str]]:
    """(regular, special) month columns."""
    months = grid_columns(columns, pattern)
    return [c for m, c in months if m not in special], [c for m, c in months if m in special]


def grid_row_stats(columns, pattern: str, codes, n_bins: int | None = None, prefix: str = "paym_row") -> list[Column]:
    """Row-local: distinct codes, changes between neighbouring non-empty months, first and last
    code, share of each wanted code. A row without any status gives nulls."""
    cols = [c for _, c in grid_columns(columns, pattern)]
    n = count_present(cols)
    changes = [f"coalesce(int(`{c}` <> coalesce({', '.join(f'`{p}`' for p in reversed(cols[:i]))})), 0)"
               for i, c in enumerate(cols) if i]
    change_total = sum_of(changes) if changes else F.lit(0)
    out = [
        F.when(n > 0, row_bits(cols, n_bins)).alias(f"{prefix}_nunique"),
        F.when(n > 1, change_total).alias(f"{prefix}_change_count"),
        F.coalesce(*cols).alias(f"{prefix}_first"),
        F.coalesce(*reversed(cols)).alias(f"{prefix}_last"),
    ]
    return out + [safe_ratio(count_equal(cols, v), n).alias(f"{prefix}_share_code_{v}") for v in codes]


def grid_entity_agg(codes, prefix: str = "paym_row") -> list[Column]:
    """Means and maxima per entity over the columns of ``grid_row_stats``."""
    out = []
    for s in ("nunique", "change_count"):
        out += [F.avg(f"{prefix}_{s}").alias(f"{prefix}_{s}_mean"), F.max(f"{prefix}_{s}").alias(f"{prefix}_{s}_max")]
    for s in ("first", "last"):
        out.append(F.avg(F.col(f"{prefix}_{s}").cast("double")).alias(f"{prefix}_{s}_mean"))
    return out + [F.avg(f"{prefix}_share_code_{v}").alias(f"{prefix}_share_code_{v}_mean") for v in codes]


def grid_regular(columns, pattern: str, special, normal, ever, n_codes: int | None = None, prefix: str = "paym_regular") -> list[Column]:
    """Over regular months: cells outside the normal codes (count and share), whether a code ever
    occurs. With a declared range 0..n_codes-1 also the entropy sum, from one counter per code (a
    code outside fails the job); for any codes that is ``grid_entropy``."""
    cols, _ = split_months(columns, pattern, special)
    n = F.sum(count_present(cols))
    inside = reduce(lambda a, b: a + b, [count_equal(cols, v) for v in normal])
    outside = F.sum(count_present(cols) - inside)
    entropy = []
    if n_codes is not None:
        per_code = [F.sum(count_equal(cols, v)) for v in range(n_codes)]
        checked = F.when(reduce(lambda a, b: a + b, per_code) == n, n).otherwise(
            F.raise_error(F.lit(f"grid status outside 0..{n_codes - 1}")))
        terms = [F.when(k > 0, k * (k / checked) * F.log(k / checked)).otherwise(0.0) for k in per_code]
        entropy = [F.when(n > 0, reduce(lambda a, b: a + b, terms)).alias(f"{prefix}_entropy")]
    return [
        *entropy,
        F.when(n > 0, outside).alias(f"{prefix}_outside_{'_'.join(map(str, normal))}_count"),
        safe_ratio(outside, n).alias(f"{prefix}_outside_{'_'.join(map(str, normal))}_share"),
        F.when(n > 0, F.max((count_equal(cols, ever) > 0).cast("int"))).alias(f"{prefix}_ever_bin{ever}"),
    ]


def grid_special(columns, pattern: str, special, normal, worst, prefix: str = "paym_special") -> list[Column]:
    """Over special months: cells outside the normal codes, whether the worst code occurs. An
    entity without any cell in the whole grid gives null, without a special one 0."""
    regular, cols = split_months(columns, pattern, special)
    n = F.sum(count_present(regular + cols))
    inside = reduce(lambda a, b: a + b, [count_equal(cols, v) for v in normal])
    return [
        F.when(n > 0, F.sum(count_present(cols) - inside)).alias(f"{prefix}_outside_{'_'.join(map(str, normal))}_count"),
        F.when(n > 0, F.max((count_equal(cols, worst) > 0).cast("int"))).alias(f"{prefix}_ever_worst_bin{worst}"),
    ]


def grid_entropy(df: DataFrame, id_col: str, pattern: str, special=()) -> DataFrame:
    """Entropy of statuses per entity for any set of codes, from counts per (entity, status).

    ``grid_entropy`` weighs each term with its number of cells (sum of n p ln p, never positive);
    ``grid_shannon`` is the usual entropy."""
    long = unpivot_grid(df, [id_col], pattern).where(~F.col("month").isin(list(special)))
    counts = long.groupBy(id_col, "status").agg(F.count("*").alias("n"))
    # sum n p ln p = (sum n^2 ln n - ln N sum n^2) / N: one pass over the counts
    n, big = F.col("n").cast("double"), F.sum("n").cast("double")
    weighted = (F.sum(n * n * F.log(n)) - F.log(big) * F.sum(n * n)) / big
    shannon = F.log(big) - F.sum(n * F.log(n)) / big
    return counts.groupBy(id_col).agg(weighted.alias("grid_entropy"), shannon.alias("grid_shannon"))


def listed_entropy(name: str) -> Column:
    """``grid_entropy`` from the list ``name`` of an entity's cells (``blocks.with_runs``), of any codes."""
    runs, n = f"`_runs_{name}`", f"double(size(`_sorted_{name}`))"
    squares = f"aggregate({runs}, 0D, (a, k) -> a + double(k) * k)"
    logs = f"aggregate({runs}, 0D, (a, k) -> a + double(k) * k * ln(k))"
    return F.expr(f"IF({n} > 0, ({logs} - ln({n}) * {squares}) / {n}, NULL)")


def grid_names(df: DataFrame, pattern: str) -> list[str]:
    return select_names(df.columns, pattern)
