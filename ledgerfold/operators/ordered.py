"""Order-dependent operators: previous row, first/last row, ordered sequence, running sums,
ranks and exact quantiles. None of them puts an unbounded group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfold.operators.placed import PlacedHistory, parted
from ledgerfold.operators.ranged import FAN, levels_of, ranged, same, segments_of, sums_before
from ledgerfold.operators.skew import grid_of_quantiles, thinned, with_segment


def with_previous(df: DataFrame, id_col: str, order_col: str, cols, hot: list | None = None,
                  prefix: str = "prev_", segments: int | None = None) -> DataFrame:
    """Adds ``prev_<c>``: the value in the entity's preceding row. ``order_col`` is unique within an
    entity.

    Rows are cut into ranges of (id, order), so the size of an entity does not matter. Inside a
    range this is one window; the first row of a range looks at the last row of the ranges before it,
    a table of one row per range. A caller that knows that no entity is large says ``hot=[]``: then
    it is one window per entity, whose partitioning a following groupBy(id) uses again.
    """
    cols = list(cols)
    if hot is not None and not hot:
        window = W.partitionBy(id_col).orderBy(order_col)
        return df.select("*", *[F.lag(c).over(window).alias(prefix + c) for c in cols])
    cut = ranged(df, [id_col, order_col], segments)
    seen = F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    ends = cut.groupBy("_seg").agg(F.max_by(seen, F.struct(id_col, order_col)).alias("_last"))
    border = ends.select(F.col("_seg").alias("_at"), F.lag("_last").over(W.partitionBy(F.lit(0)).orderBy("_seg")).alias("_border"))
    inside = W.partitionBy("_seg").orderBy(id_col, order_col)
    lagged = cut.select("*", F.lag(seen).over(inside).alias("_in"), F.row_number().over(inside).alias("_pos"))
    # one row per segment
    met = lagged.join(F.broadcast(border), F.col("_seg") == F.col("_at")).withColumn("_p", F.when(F.col("_pos") == 1, F.col("_border")).otherwise(F.col("_in")))
    mine = F.col("_p").isNotNull() & F.col("_p.id").eqNullSafe(F.col(id_col))
    return met.select(*df.columns, *[F.when(mine, F.col(f"_p.c{i}")).alias(prefix + c) for i, c in enumerate(cols)])


def aggregate_entities(df: DataFrame | PlacedHistory, id_col: str, aggs, hot: list, prepare=None) -> DataFrame:
    """groupBy(id) for wide aggregates. A placed history is not moved at all.

    Ordinary entities have few rows per task, so combining before the shuffle saves nothing and
    would move wide aggregation buffers; their narrow rows are moved instead, once, and folded
    where they arrive. Hot entities are combined in every task first and send one row per task.
    ``prepare(rows, hot)`` may add columns that need the rows of an entity in order.
    """
    made = prepare or (lambda rows, hot_: rows)
    cold_rows, hot_rows = parted(df, id_col, hot)
    folded = made(cold_rows, []).groupBy(id_col).agg(*aggs)
    return folded if hot_rows is None else folded.unionByName(made(hot_rows, hot).groupBy(id_col).agg(*aggs))


def ordered_text(df: DataFrame, id_col: str, order_col: str, cols, hot: list | None = None,
                 suffix: str = "_bin_sequence", segments: int | None = None) -> DataFrame:
    """One row per id: the codes of each column joined in order, nulls skipped, null if none.

    Rows are cut into ranges of (id, order); an entity's text is joined in each range it touches,
    where its rows lie, and the parts are joined by range. ``hot=[]`` says that no entity is large.
    """
    slim = df.select(id_col, order_col, *cols)
    if hot is not None and not hot:
        return joined_text(slim, [id_col], order_col, cols, suffix)
    parts = joined_text(ranged(slim, [id_col, order_col], segments), [id_col, "_seg"], order_col, cols, "")
    return joined_text(parts, [id_col], "_seg", cols, suffix)


def joined_text(df: DataFrame, keys, order_col: str, cols, suffix: str) -> DataFrame:
    """All columns share one sorted list per group."""
    rows = F.sort_array(F.collect_list(F.struct(order_col, *[F.col(c).cast("string").alias(c) for c in cols])))
    return df.groupBy(*keys).agg(rows.alias("_rows")).select(
        *keys, *[F.nullif(F.array_join(F.col(f"_rows.{c}"), ""), F.lit("")).alias(c + suffix) for c in cols])


def first_row(df: DataFrame, id_col: str, order_col: str, cols, prefix: str = "first_") -> DataFrame:
    return _edge_row(df, id_col, order_col, cols, prefix, F.min_by)


def last_row(df: DataFrame, id_col: str, order_col: str, cols, prefix: str = "last_") -> DataFrame:
    return _edge_row(df, id_col, order_col, cols, prefix, F.max_by)


def _edge_row(df, id_col, order_col, cols, prefix, pick):
    return df.groupBy(id_col).agg(*[pick(c, order_col).alias(prefix + c) for c in cols])


def first_rows_by_rank(df: DataFrame, id_col: str, order_col: str, descending: bool = False) -> DataFrame:
    """The whole first (or last) row of each entity. The filter on row_number becomes a limit
    per entity before the shuffle, so a hot entity sends one row per task."""
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    return (df.withColumn("_n", F.row_number().over(W.partitionBy(id_col).orderBy(order)))
            .where(F.col("_n") == 1).drop("_n"))


def with_group_values(df: DataFrame, keys, aggs, hot: list | None = None, segments: int | None = None) -> DataFrame:
    """Group aggregates repeated on every row of the group (a window without order).

    Rows are cut into ranges of (keys, a hash of the row), so a group of any size is spread. The
    groups' aggregates are combined in every task first, and come back to a range as one row for
    each group in it. ``hot=[]`` says that no group is large: then this is one window.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if hot is not None and not hot:
        win = W.partitionBy(*keys)
        return df.select("*", *[a.over(win).alias(n) for n, a in aggs.items()])
    cut = ranged(df.withColumn("_mix", F.xxhash64(*df.columns)), [*keys, "_mix"], segments)
    totals = cut.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    # which groups a range holds: no two ranges share more than the group at their border
    places = cut.groupBy("_seg", *keys).agg(F.lit(1).alias("_one"))
    found = places.alias("p").join(totals.alias("t"), same("p", "t", keys)).select("p._seg", *["p." + k for k in keys], *["t." + n for n in aggs])
    met = cut.alias("r").join(found.alias("f"), (F.col("r._seg") == F.col("f._seg")) & same("r", "f", keys))
    return met.select(*["r." + c for c in df.columns], *["f." + n for n in aggs])


def with_running_sums(df: DataFrame, order_col: str, sums, group_cols=(), segments: int | None = None, levels: int | None = None,
                      fan: int = FAN) -> DataFrame:
    """Adds ``before_<s>`` and ``total_<s>`` for each summed column: the sum over all rows of the
    group that come before this one, and over the whole group. ``order_col`` is unique in a group.

    Rows are cut into ranges of (group, order); a running sum is taken inside a range and shifted by
    the group's sums over earlier ranges (``sums_before``), so neither a group nor the number of
    ranges has a limit. A null group is a group.
    """
    group_cols, sums = list(group_cols), list(sums)
    cut = ranged(df, [*group_cols, order_col], segments)
    parts = cut.groupBy(*group_cols, "_seg").agg(*[F.sum(s).alias(s) for s in sums])
    before = sums_before(parts, "_seg", sums, group_cols, levels or levels_of(segments_of(df, segments), fan), fan)
    totals = parts.groupBy(*group_cols).agg(*[F.sum(s).alias("total_" + s) for s in sums])
    if group_cols:
        shifts = before.alias("b").join(totals.alias("t"), same("b", "t", group_cols)).select("b.*", *["t.total_" + s for s in sums])
    else:
        shifts = before.withColumn("_t", totals.select(F.struct("*")).scalar()).select("*", "_t.*")
    inside = W.partitionBy("_seg", *group_cols).orderBy(order_col).rowsBetween(W.unboundedPreceding, -1)
    local = cut.select("*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias("_l_" + s) for s in sums])
    met = local.alias("l").join(shifts.alias("s"), (F.col("l._seg") == F.col("s._seg")) & same("l", "s", group_cols))
    return met.select(
        *["l." + c for c in df.columns],
        *[(F.col("_l_" + s) + F.col("_e_" + s)).alias("before_" + s) for s in sums], *["s.total_" + s for s in sums])


def exact_quantiles(df: DataFrame, value_cols, probs, group_cols=(), segments: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per (group, feature), columns q0, q1, …;
    null values are left out, a null group is a group.

    The built-in exact percentile keeps every distinct value of a group in one task. Here values
    are cut into segments by order, as many as the rows ask for, and counted; the counts say which
    segments hold the wanted ranks, and only the values of those few segments are shuffled (equal
    values combined first) and sorted. The plan is the same at every size.
    """
    group_cols, value_cols, probs = list(group_cols), list(value_cols), list(probs)
    found = df.agg(*[grid_of_quantiles(c).alias(c) for c in value_cols], F.count("*").alias("_rows")).first()
    cut = df
    for i, c in enumerate(value_cols):
        cut = with_segment(cut, c, thinned(found[c], found["_rows"], segments), f"_seg{i}")
    items = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"), F.col(f"_seg{i}").alias("seg"))
        for i, c in enumerate(value_cols)])
    # groups travel as one struct, which is never null itself
    group = F.struct(*group_cols) if group_cols else F.struct(F.lit(0).alias("_all"))
    long = cut.select(group.alias("_g"), F.explode(items).alias("i")).select("_g", "i.*").where(F.col("value").isNotNull())
    keys = ["_g", "feature"]
    over = W.partitionBy(*keys)
    ranges = long.groupBy(*keys, "seg").agg(F.count("*").alias("n")).select(
        *keys, "seg", "n",
        (F.sum("n").over(over.orderBy("seg")) - F.col("n")).alias("before"),
        F.sum("n").over(over).alias("total"))
    ranks = F.array(*[
        F.struct(F.lit(i).alias("p"), F.lit(up).alias("up"),
                 (F.ceil if up else F.floor)(F.lit(float(p)) * (F.col("total") - 1)).alias("k"))
        for i, p in enumerate(probs) for up in (0, 1)])
    wanted = (ranges.select(*keys, "seg", "before", "total", "n", F.explode(ranks).alias("r"))
              .where((F.col("r.k") >= F.col("before")) & (F.col("r.k") < F.col("before") + F.col("n")))
              .groupBy(*keys, "seg", "before", "total").agg(F.collect_list("r").alias("ranks")))
    def met(left, right, how):
        same = (F.col("l._g").eqNullSafe(F.col("r._g")) & (F.col("l.feature") == F.col("r.feature")) & (F.col("l.seg") == F.col("r.seg")))
        return left.alias("l").join(right.alias("r"), same, how)

    counts = (met(long, wanted.select(*keys, "seg"), "left_semi")
              .groupBy(*keys, "seg", "value").agg(F.count("*").alias("n")))
    inside = W.partitionBy(*keys, "seg").orderBy("value")
    placed = counts.select(*keys, "seg", "value", "n", (F.sum("n").over(inside) - F.col("n")).alias("at"))
    hits = (met(placed, wanted, "inner").select("l._g", "l.feature", "value", "at", "n", "before", "total", F.explode("ranks").alias("r"))
            .where((F.col("r.k") >= F.col("before") + F.col("at")) & (F.col("r.k") < F.col("before") + F.col("at") + F.col("n"))))

    def pick(i, up):
        return F.max(F.when((F.col("r.p") == i) & (F.col("r.up") == up), F.col("value")))

    def quantile(i, p):
        lo, hi = pick(i, 0), pick(i, 1)
        pos = F.lit(float(p)) * (F.max("total") - 1)
        return lo + (hi - lo) * (pos - F.floor(pos))

    out = hits.groupBy(*keys).agg(*[quantile(i, p).alias(f"q{i}") for i, p in enumerate(probs)])
    return out.select(*[F.col(f"_g.{g}").alias(g) for g in group_cols], "feature", *[f"q{i}" for i in range(len(probs))])
