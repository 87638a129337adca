"""Registered queries, one per operator: each takes (session, folder of tables)."""

from __future__ import annotations


from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ledgerfold.functions import scalar as X
from ledgerfold.functions.naming import select_names
from ledgerfold.operators import (
    arrivals as AR, attribution as AT, blocks as B, encode as EN, engineer as EG, evaluate as EV, grid as G, models as MO, ordered as O,
    preprocess as PR, split as SP, stats as ST, trees as TR)
from ledgerfold.plans import mart as M
from ledgerfold.plans import views as V
from ledgerfold.operators.placed import place_history, read_placed
from ledgerfold.plans.workflow import SplitConfig, train_stats
from ledgerfold.sources import contract as C
from ledgerfold.sources import readers as RD
from ledgerfold.sources import writers as WR
from ledgerfold.sources.scratch import new_path, written
from ledgerfold.streaming.monitor import latest_counts, monitor_stream
from ledgerfold.streaming.score import incremental_score

DIGITS = 6
ROW = ("id", "seq")
STAT_COLS = list(V.MART_V2.coded)
CLEAN = PR.TableConfig(
    target_col="flag", drop_cols=("id",), exact_excludes=("flag",), prefix_excludes=(), suffix_excludes=("_num",),
    top_n=3, max_cardinality=100, outlier_method="iqr", outlier_threshold=1.5)
WEIGHTS = {"x1": 0.7, "x2": -0.02}
SEARCH_SEED = 4  # draws the depths 0, 1, 0


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to a fixed number of digits, since the order of a sum is not fixed; no minus zero.
    NaN, infinities and numbers too large for such digits stay as they are."""
    def cut(c):
        whole = f"floor(abs(double(`{c}`)) * 1e{DIGITS}D + 0.5D)"
        plain = f"isnan(`{c}`) OR abs(double(`{c}`)) >= 1e9D"
        return F.expr(f"CASE WHEN {plain} THEN double(`{c}`) ELSE IF(`{c}` < 0, -{whole}, {whole}) / 1e{DIGITS}D + 0D END")

    return df.select([cut(f.name).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                      for f in df.schema.fields])


def by_id(make):
    """A query that aggregates the history per id. The block is made when the query runs: columns
    need a session."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(V.history(spark, sf).groupBy("id").agg(*make()))
    return run


def by_row(make):
    """A query that adds columns (name -> expression) to each history row."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(V.history(spark, sf).select(*ROW, *[e.alias(n) for n, e in make().items()]))
    return run


def stats_text(stats: DataFrame) -> DataFrame:
    return stats.select("feature", "mode_value", F.array_join("rare_bins", ",").alias("rare_text"))


def with_empty(df: DataFrame) -> DataFrame:
    return df.withColumn("pre_none", F.lit(None).cast("int"))


def train_history(spark, sf):
    return SP.entity_split(V.history(spark, sf), "id").where(F.col("split") == "train").drop("split")


# --- sources and sinks -------------------------------------------------------------------------

def scan_parquet_glob(spark, sf):
    return RD.read_history(spark, f"{sf}/lineitem*.parquet", "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def scan_csv_target(spark, sf):
    path = new_path(spark, "target-csv")
    V.target(spark, sf).write.csv(path, header=True)
    return RD.read_target(spark, path, "id bigint, flag int")


def sample_by_id(spark, sf):
    return RD.sample_by_id(V.history(spark, sf), "id", 0.2).select("id", "seq", "pre_disc")


def baseline_join_target(spark, sf):
    return RD.join_target(V.history(spark, sf).drop("seq"), V.target(spark, sf), "id", unique=True)


def eda_slice(spark, sf):
    return RD.eda_slice(V.history(spark, sf), V.target(spark, sf), "id", "pre_part", 1)


def write_predictions(spark, sf):
    path = new_path(spark, "predictions")
    WR.write_predictions(V.scored(spark, sf).select("id", "predicted", "p"), path, "csv")
    return spark.read.csv(path, header=True, schema="id bigint, predicted int, p double")


def save_load_stats(spark, sf):
    path = new_path(spark, "stats")
    WR.save_stats(ST.fit_population_stats(V.history(spark, sf), STAT_COLS), path)
    return stats_text(WR.load_stats(spark, path))


def feature_schema(spark, sf):
    wanted = V.history(spark, sf).select("id", "seq", "rn", "pre_disc", "is_zero_a", "pre_part")
    text = C.feature_schema(wanted)
    loose = wanted.select(*[F.col(c).cast("string").alias(c) for c in reversed(wanted.columns)])
    return C.conform(loose, text)


def decimal_to_double(spark, sf):
    d = V.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(14,2)").alias("price"), (F.col("o_orderkey") * F.lit(1.5).cast("decimal(4,1)")).alias("half"))
    return RD.decimals_to_double(d)


def split_ids_scan(spark, sf):
    return RD.ids_with_label(V.history(spark, sf), "id", "enc_ret", "seq")


# --- projections and predicates ----------------------------------------------------------------

def holey_orders(spark, sf):
    k = F.col("o_orderkey")
    return V.table(spark, sf, "orders").select(
        k.alias("id"), F.when(k % 2 != 0, k).alias("a"), F.when(k % 3 != 0, F.col("o_totalprice")).alias("b"),
        F.when(k % 5 != 0, F.col("o_orderpriority")).alias("c"))


def filter_bad_rows(spark, sf):
    return SP.filter_bad_rows(holey_orders(spark, sf), 0.5)


def select_by_pattern(spark, sf):
    h = V.history(spark, sf)
    return h.select(*select_names(h.columns, "^grid_[0-9]+$", exact=("id", "seq"), prefixes=("is_zero_",)))


def select_except(spark, sf):
    return V.history(spark, sf).select("seq", "rn", *V.CODES).drop("rn")


def regexp_month(spark, sf):
    h = V.history(spark, sf)
    names = G.grid_names(h, V.GRID.pattern)
    return ST.melt(h, names, ROW, "int").select(*ROW, X.month_of("feature").alias("month"), "value")


# --- joins -------------------------------------------------------------------------------------

def join_mart_blocks(spark, sf):
    return rounded(V.history(spark, sf).groupBy("id").agg(
        *B.history_counts("rn"), *B.snapshots(["pre_disc"], "seq", "last"), *B.flag_shares(["is_zero_a"]), *B.distinct_counts(["pre_part"])))


def join_target_left(spark, sf):
    counts = V.history(spark, sf).groupBy("id").agg(*B.history_counts("rn"))
    return RD.join_target(counts, V.target(spark, sf), "id")


def join_train_ids_semi(spark, sf):
    h = V.history(spark, sf)
    ids = SP.entity_split(V.target(spark, sf), "id").where(F.col("split") == "train")
    return h.join(ids, "id", "left_semi").select(*ROW, "pre_disc")


def cross_join_global(spark, sf):
    h = V.history(spark, sf)
    frame, m = ST.inject_modes(h, ST.global_modes(h, ["pre_disc", "pre_part"]), ["pre_disc", "pre_part"])
    return frame.select(*ROW, m["pre_disc"].alias("m_pre_disc"), (F.col("pre_part") != m["pre_part"]).alias("off_part"))


def join_local_modes(spark, sf):
    h = V.history(spark, sf)
    modes = ST.local_modes(h, "id", ["pre_disc", "pre_part"])
    return h.select(*ROW, "pre_disc", "pre_part").join(modes, "id").select(
        *ROW, "lm_pre_disc", (F.col("pre_part") != F.col("lm_pre_part")).alias("off_part"))


def isin_split(spark, sf):
    return SP.rows_of_split(V.history(spark, sf), SP.entity_split(V.target(spark, sf), "id"), "id", "val").select(*ROW)


# --- first mart --------------------------------------------------------------------------------

def global_mode(spark, sf):
    return ST.global_modes(V.history(spark, sf), V.CODES)


def local_mode(spark, sf):
    return ST.local_modes(V.history(spark, sf), "id", ["pre_disc", "pre_part", "enc_ret"])


def global_non_dominant(spark, sf):
    h, cols = V.history(spark, sf), ["pre_disc", "pre_part", "enc_stat"]
    frame, m = ST.inject_modes(h, ST.global_modes(h, cols), cols)
    return rounded(frame.groupBy("id").agg(*B.global_non_dominant(m)))


def local_non_dominant(spark, sf):
    return rounded(ST.local_non_dominant_counts(V.history(spark, sf), "id", V.MART_V1.local))


def bin_sequence(spark, sf):
    return O.ordered_text(V.history(spark, sf), "id", "seq", ["pre_disc", "pre_part", "enc_ret"])


def mart_v1(spark, sf):
    return rounded(M.mart_v1(V.history(spark, sf), V.KEYS, V.MART_V1, V.target(spark, sf)))


# --- population statistics and second mart ------------------------------------------------------

def value_counts(spark, sf):
    return ST.with_total(ST.value_counts(V.history(spark, sf), STAT_COLS))


def mode_per_feature(spark, sf):
    return ST.mode_of_counts(ST.value_counts(V.history(spark, sf), STAT_COLS))


def rare_bins(spark, sf):
    counts = ST.value_counts(V.history(spark, sf), STAT_COLS)
    return ST.rare_values(ST.with_total(counts), ST.mode_of_counts(counts)).select(
        "feature", F.array_join("rare_bins", ",").alias("rare_text"))


def fit_population_stats(spark, sf):
    ids = SP.entity_split(V.target(spark, sf), "id").where(F.col("split") == "train")
    return stats_text(ST.fit_population_stats(with_empty(V.history(spark, sf)), [*STAT_COLS, "pre_none"], ids, "id"))


def incremental_stats(spark, sf):
    """Statistics after two arrivals: the lines with odd, then those with even numbers."""
    h, path, state = V.history(spark, sf), new_path(spark, "arrivals"), new_path(spark, "counts")
    for odd in (1, 0):
        h.where(F.col("rn") % 2 == odd).write.mode("append").parquet(path)
        AR.count_arrival(spark, state, path, h.schema, STAT_COLS)
    return stats_text(AR.arrived_stats(spark, state))


def inject_stats(spark, sf):
    h = V.history(spark, sf)
    frame, m, r = ST.inject_stats(h, ST.stats_of(train_history(spark, sf), STAT_COLS), STAT_COLS)
    return frame.select(*ROW, m["pre_disc"].alias("m_pre_disc"), X.false_if_null(F.array_contains(r["pre_qty"], F.col("pre_qty"))).alias("rare_qty"))


def _with_stats(spark, sf):
    return ST.inject_stats(V.history(spark, sf), ST.stats_of(train_history(spark, sf), STAT_COLS), STAT_COLS)


def share_global_mode(spark, sf):
    frame, m, _ = _with_stats(spark, sf)
    cols = {c: m[c] for c in ("pre_disc", "pre_part")}
    known = B.share_global_mode({"pre_part": m["pre_part"]}, null_as_zero=False)[0].alias("pre_part_share_of_known")
    return rounded(frame.groupBy("id").agg(*B.share_global_mode(cols), known))


def share_rare_bins(spark, sf):
    frame, _, r = _with_stats(spark, sf)
    return rounded(frame.groupBy("id").agg(*B.share_rare_bins({c: r[c] for c in ("pre_disc", "pre_qty", "pre_part")})))


def _with_prev(spark, sf, cols):
    return O.with_previous(V.history(spark, sf).select(*ROW, *cols), "id", "seq", cols)


def change_count(spark, sf):
    cols = ["pre_disc", "pre_part", "enc_ret"]
    return _with_prev(spark, sf, cols).groupBy("id").agg(*B.change_counts(cols))


def changed_ever(spark, sf):
    cols = ["pre_tax", "pre_part"]
    return _with_prev(spark, sf, cols).groupBy("id").agg(*B.changed_ever(cols))


def mart_v2(spark, sf):
    stats = train_stats(V.history(spark, sf), V.KEYS, V.MART_V2, SplitConfig())
    return rounded(M.mart_v2(V.history(spark, sf), V.KEYS, V.MART_V2, stats, V.target(spark, sf)))


def placed(spark, sf):
    """The history written by entity and read again."""
    return read_placed(spark, place_history(V.history(spark, sf), new_path(spark, "placed"), "id", "seq"))


def mart_v1_placed(spark, sf):
    return rounded(M.mart_v1(placed(spark, sf), V.KEYS, V.MART_V1, V.target(spark, sf)))


def mart_v2_placed(spark, sf):
    stats = train_stats(V.history(spark, sf), V.KEYS, V.MART_V2, SplitConfig())
    return rounded(M.mart_v2(placed(spark, sf), V.KEYS, V.MART_V2, stats, V.target(spark, sf)))


# --- month grid --------------------------------------------------------------------------------

def unpivot_grid(spark, sf):
    return G.unpivot_grid(V.history(spark, sf), ROW, V.GRID.pattern)


def grid_entropy(spark, sf):
    return rounded(G.grid_entropy(V.history(spark, sf), "id", V.GRID.pattern, V.GRID.special))


def _regular(names):
    def run(spark, sf):
        h, g = V.history(spark, sf), V.GRID
        made = h.groupBy("id").agg(*G.grid_regular(h.columns, g.pattern, g.special, g.normal, g.ever, g.n_codes))
        entropy = G.grid_entropy(h, "id", g.pattern, g.special).select("id", F.col("grid_entropy").alias("paym_regular_entropy"))
        made = made.join(entropy, "id", "left") if "paym_regular_entropy" in names else made
        return rounded(made.select("id", *names))
    return run


def grid_special_months(spark, sf):
    h, g = V.history(spark, sf), V.GRID
    return h.groupBy("id").agg(*G.grid_special(h.columns, g.pattern, g.special, g.special_normal, g.worst))


def _row_stats(spark, sf):
    h, g = V.history(spark, sf), V.GRID
    return h.select(*ROW, *G.grid_row_stats(h.columns, g.pattern, g.shares, g.n_codes))


def grid_row_stats(spark, sf):
    return rounded(_row_stats(spark, sf))


def grid_entity_agg(spark, sf):
    return rounded(_row_stats(spark, sf).groupBy("id").agg(*G.grid_entity_agg(V.GRID.shares)))


# --- windows -----------------------------------------------------------------------------------

def row_number_dedup(spark, sf):
    h = V.history(spark, sf).select(*ROW, "pre_disc", "pre_part")
    last = O.first_rows_by_rank(h, "id", "seq", descending=True).withColumn("which", F.lit("last"))
    return last.unionByName(O.first_rows_by_rank(h, "id", "seq").withColumn("which", F.lit("first")))


def lag_by_entity(spark, sf):
    return _with_prev(spark, sf, ["pre_disc", "pre_part"]).select(*ROW, "prev_pre_disc", "prev_pre_part")


def lag_by_entity_row(spark, sf):
    long = G.unpivot_grid(V.history(spark, sf), ROW, V.GRID.pattern)
    # one row's months are the group, so no group exceeds the number of months
    return long.withColumn("prev_status", F.lag("status").over(W.partitionBy(*ROW).orderBy("month")))


def count_over_partition(spark, sf):
    h = V.history(spark, sf).select(*ROW, "pre_disc")
    both = O.with_group_values(h, "id", {"n": F.count("*")})
    return O.with_group_values(both, ["id", "pre_disc"], {"n_same": F.count("*")}).drop("pre_disc")


def sum_over_partition(spark, sf):
    return O.with_group_values(V.history(spark, sf).select(*ROW, "pre_disc"), "id", {"disc_sum": F.sum("pre_disc")})


def max_by_over_partition(spark, sf):
    counts = ST.value_counts(V.history(spark, sf), STAT_COLS)
    return counts.alias("c").join(F.broadcast(ST.mode_of_counts(counts)), "feature").select("feature", "value", "cnt", "mode_value")


# --- top-n and sets ----------------------------------------------------------------------------

def _texts(spark, sf):
    return V.table(spark, sf, "part").select("p_partkey", "p_brand", F.when(F.col("p_partkey") % 11 != 0, F.col("p_type")).alias("p_type"), F.col("p_size").cast("string").alias("p_size"))


def top_n_categories(spark, sf):
    return ST.top_values(ST.value_counts(_texts(spark, sf), ["p_brand", "p_type", "p_size"], kind="string"), 4).select("feature", "value", "cnt", "rank")


def collapse_rare(spark, sf):
    t = _texts(spark, sf)
    tops = ST.top_values(ST.value_counts(t, ["p_brand", "p_type"], kind="string"), 3)
    return ST.collapse_rare(t, ["p_brand", "p_type"], tops, "other").select("p_partkey", "p_brand", "p_type")


def _errors(spark, sf):
    return EV.error_frame(V.scored(spark, sf), "actual", "predicted", "p")


def worst_false_positives(spark, sf):
    return EV.worst_false_positives(_errors(spark, sf), "actual", "p", "id").select("id", "p", "kind")


def worst_false_negatives(spark, sf):
    return EV.worst_false_negatives(_errors(spark, sf), "actual", "p", "id").select("id", "p", "kind")


def worst_predictions(spark, sf):
    return EV.worst_predictions(_errors(spark, sf), "actual", "p", "id").select("id", "p", "kind", "confidence_mistake").transform(rounded)


def _residuals(spark, sf):
    guess = F.floor(F.col("o_totalprice") / 1000) * 1000.0 + F.col("o_orderkey") % 300
    return EV.residual_frame(V.table(spark, sf, "orders").withColumn("guess", guess), "o_totalprice", "guess")


def worst_residuals(spark, sf):
    return rounded(EV.worst_residuals(_residuals(spark, sf), "o_orderkey").select("o_orderkey", "abs_error", "kind"))


def importance_ranking(spark, sf):
    imp = AT.global_attribution(_linear(spark, sf), {**WEIGHTS, "x3": 0.1}).withColumnRenamed("mean_abs", "importance")
    return rounded(MO.importance_ranking(imp, 2))


def split_disjoint_check(spark, sf):
    parts = SP.entity_split(V.history(spark, sf), "id").withColumn(
        "split", F.when((F.col("id") % 100 == 0) & (F.col("rn") == 1), "test").otherwise(F.col("split")))
    return SP.ids_in_two_splits(parts, "id")


def distinct_ids(spark, sf):
    return V.history(spark, sf).select("id").distinct()


def last_label_per_id(spark, sf):
    return SP.last_label_per_id(V.history(spark, sf), "id", "enc_stat", "seq")


# --- splitting ---------------------------------------------------------------------------------

def entity_split(spark, sf):
    return SP.entity_split(V.history(spark, sf).select(*ROW), "id")


def stratified_entity_split(spark, sf):
    return SP.stratified_entity_split(V.target(spark, sf), "id", "flag")


# --- cleaning ----------------------------------------------------------------------------------

NUMBERS = ["price_num", "bal_num", "none_num"]
CLEAN_COLS = ["brand", "prio", "cust", "price_num", "bal_num", "none_num", "const", "few"]


def cleaning_table(spark, sf):
    k = F.col("o_orderkey")
    return V.table(spark, sf, "orders").select(
        k.alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("flag"),
        F.when(k % 7 != 0, F.concat(F.lit("b"), (F.col("o_custkey") % 9).cast("string"))).alias("brand"),
        F.col("o_orderpriority").alias("prio"), F.col("o_custkey").alias("cust"),
        F.when(k % 4 != 0, F.col("o_totalprice")).alias("price_num"),
        (F.col("o_totalprice") * F.when(k % 50 == 0, 20.0).otherwise(1.0) - 1000.0).alias("bal_num"),
        F.when(k % 20 == 0, F.col("o_totalprice")).alias("none_num"),
        F.lit("same").alias("const"), (F.col("o_custkey") % 12).cast("int").alias("few"))


def cardinality_guard(spark, sf):
    return PR.guard_table(cleaning_table(spark, sf), ["brand", "prio", "cust", "few"], 100)


def missing_fraction(spark, sf):
    return rounded(ST.missing_share(cleaning_table(spark, sf), CLEAN_COLS))


def constant_fraction(spark, sf):
    return rounded(ST.max_value_share(cleaning_table(spark, sf), CLEAN_COLS))


def fit_numeric_fill(spark, sf):
    t = cleaning_table(spark, sf).withColumn("void_num", F.lit(None).cast("double"))
    med = PR.numeric_fills(t, ["price_num", "bal_num", "void_num"], "median").withColumn("kind", F.lit("median"))
    mean = PR.numeric_fills(t, ["price_num", "bal_num", "void_num"], "mean").withColumn("kind", F.lit("mean"))
    return rounded(med.unionByName(mean))


def fit_category_fill(spark, sf):
    t = cleaning_table(spark, sf)
    return (PR.category_fills(t, ["brand", "prio"], "mode").withColumn("kind", F.lit("mode"))
            .unionByName(PR.category_fills(t, ["brand", "prio"], PR.UNKNOWN).withColumn("kind", F.lit("word"))))


def outlier_zscore(spark, sf):
    return rounded(PR.zscore_bounds(cleaning_table(spark, sf), ["price_num", "bal_num"], 3.0))


def outlier_iqr(spark, sf):
    return rounded(PR.iqr_bounds(cleaning_table(spark, sf), ["price_num", "bal_num", "cust"], 1.5))


def _cleaned(spark, sf, cfg=CLEAN):
    t = cleaning_table(spark, sf)
    model = PR.TablePreprocessor(cfg).fit(SP.entity_split(t, "id").where(F.col("split") == "train").drop("split"))
    return t, model


def transform_table(spark, sf):
    t, model = _cleaned(spark, sf)
    return rounded(model.transform(t.withColumn("key", F.col("id"))))


def fit_transform_table(spark, sf):
    t, model = _cleaned(spark, sf)
    clean = SP.entity_split(model.transform(t.withColumn("key", F.col("id"))), "key")
    return rounded(clean.groupBy("split", "brand").agg(
        F.count("*").alias("n"), F.avg("price_num").alias("price_mean"), F.max("bal_num").alias("bal_max"), F.sum("flag").alias("flags")))


def skip_imputation(spark, sf):
    t, model = _cleaned(spark, sf, PR.TableConfig(**{**CLEAN.__dict__, "skip_imputation": ("price_num",), "outlier_method": "none"}))
    return rounded(model.transform(t.withColumn("key", F.col("id"))).select("key", "price_num", "bal_num"))


def output_feature_names(spark, sf):
    _, model = _cleaned(spark, sf)
    return spark.createDataFrame([(c,) for c in model.output_columns()], "feature string")


# --- derived columns and encoders --------------------------------------------------------------

def small_mart(spark, sf):
    """The entity table that derived columns are tested on."""
    h = V.history(spark, sf)
    frame, m, r = ST.inject_stats(h, ST.stats_of(train_history(spark, sf), STAT_COLS), STAT_COLS)
    g = V.GRID
    frame = frame.select("*", *G.grid_row_stats(h.columns, g.pattern, (0,), g.n_codes))
    return frame.groupBy("id").agg(
        *B.share_global_mode({c: m[c] for c in ("pre_disc", "pre_part")}), *B.share_rare_bins({"pre_qty": r["pre_qty"], "pre_disc": r["pre_disc"]}),
        *B.composite_overdue(["is_zero_a", "is_zero_b"], ["is_zero_a", "is_zero_b", "is_zero_c"], "is_zero_a"),
        *B.nunique_first_last(["pre_part", "enc_ret", "pre_disc"], "seq"), F.count("*").alias("num_credits"),
        F.avg("paym_row_share_code_0").alias("paym_row_share_code_0_mean"))


def typicalness_score(spark, sf):
    return rounded(EG.typicalness(small_mart(spark, sf)).select("id", "overall_typicalness_score", "overall_anomaly_score"))


def payer_flags(spark, sf):
    out = EG.payer_flags(small_mart(spark, sf), "paym_row_share_code_0_mean", "share_any_overdue", "share_serious_overdue")
    return out.select("id", "is_absolutely_perfect_payer", "is_chronic_defaulter")


def code_transitions(spark, sf):
    pairs = {"cat_part": ("pre_part_first", "pre_part_last"), "cat_ret": ("enc_ret_first", "enc_ret_last"),
             "cat_mix": ("pre_part_last", "pre_disc_last"), "cat_absent": ("nothing", "pre_disc_last")}
    return EG.code_transitions(small_mart(spark, sf), pairs).select("id", "cat_part", "cat_ret", "cat_mix")


def util_and_history(spark, sf):
    return EG.util_and_history(small_mart(spark, sf), "pre_part_last", "share_any_overdue").select("id", "cat_util_and_history")


def diversity_profile(spark, sf):
    return EG.diversity_profile(small_mart(spark, sf), "enc_ret_nunique", "num_credits").select("id", "cat_diversity_profile")


def mutual_information(spark, sf):
    h = V.history(spark, sf).join(V.target(spark, sf), "id")
    return rounded(EN.mutual_information(h, ["pre_disc", "pre_part", "enc_ret"], "flag"))


def _cat_split(spark, sf):
    """Parts with a brand-and-size category, some of which only held-out parts have; fitted on the
    train side of the split."""
    t = _texts(spark, sf).select(F.col("p_partkey").alias("id"), F.concat_ws("|", "p_brand", "p_size").alias("p_brand"), "p_type")
    return t, SP.entity_split(t, "id").where(F.col("split") == "train")


def ordinal_encode(spark, sf):
    t, train = _cat_split(spark, sf)
    return EN.ordinal_encode(t, ["p_brand", "p_type"], EN.fit_categories(train, ["p_brand", "p_type"]), -1).select("id", "p_brand_code", "p_type_code")


def one_hot_encode(spark, sf):
    """One line per part over all 0/1 columns, since their names depend on the data: how many there
    are, how many are set, and the category of the one that is."""
    t, train = _cat_split(spark, sf)
    cats = EN.categories_of(EN.fit_categories(train, ["p_brand"]), ["p_brand"])
    wide = EN.one_hot_encode(t.select("id", "p_brand"), {**cats, "gone": ["x"]})
    names = [c for c in wide.columns if c not in ("id", "gone_x")]
    bits = F.array(*[F.col(f"`{c}`") for c in names])
    labels = F.array(*[F.lit(c.removeprefix("p_brand_")) for c in names])
    return wide.select("id", "gone_x", bits.alias("_bits")).select(
        "id", "gone_x", F.size("_bits").alias("n_columns"), F.aggregate("_bits", F.lit(0), lambda x, y: x + y).alias("n_hot"),
        F.get(labels, (F.array_position("_bits", 1) - 1).cast("int")).alias("hot"))


def freeze_categories(spark, sf):
    t, train = _cat_split(spark, sf)
    return EN.freeze_categories(t, ["p_brand", "p_type"], EN.fit_categories(train, ["p_brand", "p_type"])).select("id", "p_brand", "p_type")


# --- models ------------------------------------------------------------------------------------

MODEL_NUM = ("loans_total_count", "loans_max_rn", "is_zero_a_share", "is_zero_b_share", "is_zero_c_share",
             "distinct_pre_disc_count", "distinct_pre_part_count")
MODEL_CAT = ("last_pre_disc", "last_enc_ret")


def model_rows(spark, sf) -> DataFrame:
    """Entity table with label, written once: a training job reads it many times."""
    wide = V.history(spark, sf).groupBy("id").agg(
        *B.history_counts("rn"), *B.flag_shares(["is_zero_a", "is_zero_b", "is_zero_c"]), *B.distinct_counts(["pre_disc", "pre_part"]),
        *B.snapshots(["pre_disc", "enc_ret"], "seq", "last"))
    rows = RD.join_target(wide, V.target(spark, sf), "id").withColumns({c: F.col(c).cast("string") for c in MODEL_CAT})
    return SP.entity_split(written(rows, "model-rows"), "id")


def learnable(rows: DataFrame) -> DataFrame:
    """Labels that are exact functions of a feature, so that the right prediction is known."""
    n = F.col("loans_total_count")
    return rows.withColumns({"many": (n > 3).cast("int"), "kind": F.when(n <= 2, 0.0).when(n <= 5, 1.0).otherwise(2.0)})


def config(family: str, label: str = "many", **params) -> MO.ModelConfig:
    return MO.ModelConfig(family=family, params=params, numeric=MODEL_NUM, categorical=MODEL_CAT, label=label)


def _fit_and_score(family, **params):
    def run(spark, sf):
        rows = learnable(model_rows(spark, sf))
        use = rows.where(F.col("split") != "test").withColumn("_valid", F.col("split") == "val")
        model = MO.train(use, config(family, **params), "_valid")
        return MO.score(model, rows.where(F.col("split") == "test")).select("id", "predicted", (F.col("probability_1") > 0.5).alias("likely"))
    return run


def _quick(spark, sf, **params):
    rows = learnable(model_rows(spark, sf))
    return rows, MO.train(rows.where(F.col("split") == "train"), config("gbt", **(params or {"maxIter": 3, "maxDepth": 2})))


def class_weights(spark, sf):
    return rounded(MO.class_weights(V.target(spark, sf), "flag"))


def multiclass_ovr(spark, sf):
    rows = learnable(model_rows(spark, sf))
    cfg = MO.ModelConfig(family="gbt", task="multiclass", params={"maxIter": 3, "maxDepth": 2}, numeric=MODEL_NUM, label="kind", n_classes=3)
    out = MO.score(MO.train(rows.where(F.col("split") == "train"), cfg), rows.where(F.col("split") == "test"))
    best = F.array_position("probabilities", F.array_max("probabilities")).cast("int") - 1
    total = F.aggregate("probabilities", F.lit(0.0), lambda x, y: x + y)
    return rounded(out.select("id", "predicted", best.alias("most_likely"), total.alias("total")))


def save_load_model(spark, sf):
    rows, model = _quick(spark, sf)
    path = new_path(spark, "model")
    MO.save_model(model, path)
    again = MO.score(MO.load_model(path), rows).select("id", F.col("probability_1").alias("p_loaded"), F.col("predicted").alias("loaded"))
    both = MO.score(model, rows).select("id", "probability_1").join(again, "id")
    return both.select("id", "loaded", (F.abs(F.col("probability_1") - F.col("p_loaded")) < 1e-12).alias("same"))


def batch_score(spark, sf):
    rows, model = _quick(spark, sf)
    path = new_path(spark, "scores")
    WR.write_predictions(MO.score(model, rows, 0.5).select("id", "predicted", "probability_1", "confidence"), path)
    out, p = spark.read.parquet(path), F.col("probability_1")
    return out.select("id", "predicted", (p.between(0, 1) & (F.abs(F.col("confidence") - F.greatest(p, 1 - p)) < 1e-9)).alias("consistent"))


def run_incremental_score(spark, sf):
    """Two arrivals of files, one run each; the files of the first run are not scored again."""
    rows, model = _quick(spark, sf)
    landing, out, ckpt = new_path(spark, "landing"), new_path(spark, "scored"), new_path(spark, "stream")
    features = rows.drop("flag", "split", "many", "kind")
    for early in (True, False):
        features.where((F.col("loans_max_rn") > 3) == early).write.mode("append").parquet(landing)
        incremental_score(spark, model, landing, features.schema, out, ckpt).awaitTermination()
    return spark.read.parquet(out).groupBy("id").agg(
        F.count("*").alias("times"), F.max((F.col("probability_1") > 0.5).cast("int")).alias("predicted"))


def random_search(spark, sf):
    """Trials with fixed draws, of which exactly one allows a split and can win; then the best setting
    fitted again and scored on the test side."""
    rows = learnable(model_rows(spark, sf))
    cfg = config("gbt", maxIter=2)
    train, valid, test = (rows.where(F.col("split") == s) for s in SP.SPLITS)
    best, trials = MO.random_search(train, valid, cfg, {"maxDepth": {"type": "int", "bounds": [0, 1]}}, 3, seed=SEARCH_SEED)
    out = MO.score(MO.refit(train, cfg, best), test).agg(F.avg((F.col("predicted") == F.col("many")).cast("double")).alias("metric"))
    return rounded(trials.select("trial", "metric", "error").unionByName(out.select(F.lit(-1).alias("trial"), "metric", F.lit(None).cast("string").alias("error"))))


def feature_importance(spark, sf):
    _, model = _quick(spark, sf, maxIter=1, maxDepth=1)
    return rounded(MO.feature_importance(model, spark))


def permutation_importance(spark, sf):
    """The deciding feature loses, the others do not matter to a model that does not use them."""
    rows, model = _quick(spark, sf, maxIter=1, maxDepth=1)
    found = AT.permutation_importance(model, rows.where(F.col("split") == "val"), "id", ["loans_total_count", "is_zero_a_share"],
                                      BinaryClassificationEvaluator(labelCol="many"))
    return found.select("feature", F.signum("importance").cast("int").alias("sign"))


def tree_attribution(spark, sf):
    """Contributions of every entity of the validation side to a stump that decides by one feature."""
    rows, model = _quick(spark, sf, maxIter=1, maxDepth=1)
    return rounded(TR.tree_contributions(model, rows.where(F.col("split") == "val"), ["id"]))


def score_contract_checks(spark, sf):
    rows, model = _quick(spark, sf)
    s = MO.score(model, rows).withColumns({"p1": F.col("probability_1"), "p0": F.get("probabilities", F.lit(0))})
    single = EV.single_row_differences(lambda part: MO.score(model, part), rows, "id", "probability_1")
    return EV.score_contract(s, ["p0", "p1"], rows).withColumn("_single", single.select(F.struct("*")).scalar()).select("*", "_single.*").drop("_single")


# --- metrics, errors, monitoring ---------------------------------------------------------------

def confusion_matrix(spark, sf):
    return EV.confusion_matrix(V.scored(spark, sf), "actual", "predicted")


def classification_metrics(spark, sf):
    return rounded(EV.classification_metrics(V.scored(spark, sf), "actual", "predicted"))


def class_report(spark, sf):
    return rounded(EV.class_report(V.scored(spark, sf), "actual", "predicted").drop("tp"))


def roc_auc(spark, sf):
    return rounded(EV.roc_auc(V.scored(spark, sf), "actual", "p"))


def roc_curve(spark, sf):
    return rounded(EV.roc_curve(V.scored(spark, sf), "actual", "p"))


def roc_auc_ovr(spark, sf):
    k = F.col("id")
    s = V.scored(spark, sf).withColumns({f"p_{c}": ((k * m + F.floor("o_totalprice").cast("bigint")) % 997) / F.lit(997.0) for c, m in (("F", 31), ("O", 57), ("P", 83))})
    return rounded(EV.roc_auc_ovr(s, "o_orderstatus", {c: f"p_{c}" for c in ("F", "O", "P")}))


def regression_metrics(spark, sf):
    return rounded(EV.regression_metrics(_residuals(spark, sf), "o_totalprice", "guess"))


def error_frame(spark, sf):
    return rounded(_errors(spark, sf).select("id", "is_error", "confidence_mistake"))


def error_trends(spark, sf):
    e = _errors(spark, sf).withColumn("cust_group", F.when(F.col("o_custkey") % 13 != 0, (F.col("o_custkey") % 37).cast("string")))
    return rounded(EV.error_trends(e, ["o_orderpriority", "cust_group"], top_k=15))


def residual_trends(spark, sf):
    r = _residuals(spark, sf).withColumn("cust_group", (F.col("o_custkey") % 37).cast("string"))
    return rounded(EV.residual_trends(r, ["o_orderpriority", "cust_group"], top_k=5))


def error_probability_histogram(spark, sf):
    return EV.error_probability_histogram(_errors(spark, sf), "actual", "p")


def target_rate_by_bin(spark, sf):
    return rounded(EV.target_rate_by_bin(V.history(spark, sf).join(V.target(spark, sf), "id", "left"), "pre_part", "flag"))


def dataset_profile(spark, sf):
    h = V.history(spark, sf).join(V.target(spark, sf), "id", "left").select("id", "rn", "pre_part", "enc_ret", "grid_5", "flag")
    return rounded(EV.dataset_profile(h, "id", "rn", "flag", ["pre_part", "enc_ret", "grid_5"]))


def _linear(spark, sf):
    return _errors(spark, sf).withColumns({"x1": F.col("o_totalprice") / 100000.0, "x2": (F.col("o_custkey") % 100).cast("double"),
                                           "x3": (F.col("id") % 10).cast("double")})


def global_attribution(spark, sf):
    return rounded(AT.global_attribution(_linear(spark, sf), WEIGHTS))


def local_attribution(spark, sf):
    return rounded(AT.local_attribution(_linear(spark, sf), WEIGHTS, "id", "actual", "p", 10))


def prediction_monitor(spark, sf):
    conf = F.when(F.col("p") > 0.5, F.col("p")).otherwise(1 - F.col("p"))
    return rounded(EV.prediction_monitor(V.scored(spark, sf).withColumn("confidence", F.round(conf, 3)), "predicted", "confidence"))


def streaming_monitor(spark, sf):
    """The monitor's counts after two arrivals, the stream stopped and started again between them."""
    conf = F.when(F.col("p") > 0.5, F.col("p")).otherwise(1 - F.col("p"))
    rows = V.scored(spark, sf).select("id", "predicted", F.round(conf, 3).alias("confidence"))
    path, out, checkpoint = (new_path(spark, n) for n in ("predictions", "monitor", "checkpoint"))
    for odd in (1, 0):
        rows.where(F.col("id") % 2 == odd).write.mode("append").parquet(path)
        monitor_stream(spark, path, rows.schema, out, checkpoint).awaitTermination()
    return rounded(latest_counts(spark, out))


C_ = F.col
QUERIES = {
    "scan_parquet_glob": scan_parquet_glob, "scan_csv_target": scan_csv_target, "sample_by_id": sample_by_id,
    "baseline_join_target": baseline_join_target, "eda_slice": eda_slice, "write_predictions": write_predictions,
    "save_load_stats": save_load_stats, "feature_schema": feature_schema, "decimal_to_double": decimal_to_double,
    "split_ids_scan": split_ids_scan, "filter_bad_rows": filter_bad_rows, "select_by_pattern": select_by_pattern,
    "select_except": select_except,
    "bool_to_int": by_row(lambda: dict(a=X.flag_int("is_zero_a"), not_b=X.not_flag_int("is_zero_b"))),
    "case_when_flags": by_row(lambda: dict(any_off=X.any_flag_off(["is_zero_a", "is_zero_b", "is_zero_c"]))),
    "safe_ratio": by_row(lambda: dict(ratio=X.safe_ratio("pre_disc", "pre_tax"))),
    "regexp_month": regexp_month,
    "in_list": by_row(lambda: dict(is_in=X.in_values("pre_part", [1, 2]), not_in=~X.in_values("pre_part", [1, 2]), in_array=X.in_values("pre_part", F.array(F.lit(0), F.lit(5))))),
    "coalesce_false": by_row(lambda: dict(hit=X.false_if_null(C_("pre_part") == 3))),
    "log_entropy_term": by_row(lambda: dict(term=X.entropy_term((C_("pre_disc") + 1) / F.lit(11.0)))),
    "concat_codes": by_row(lambda: dict(pair=X.concat_codes("pre_part", "pre_disc"))),
    "bucket_label": by_row(lambda: dict(bucket=X.bucket_label(X.safe_ratio("pre_disc", C_("pre_qty") * 4)))),
    "row_mean": by_row(lambda: dict(mean=X.row_mean(["pre_part", "grid_3", "grid_5"]))),
    "threshold_flag": by_row(lambda: dict(high=X.at_least(C_("pre_part") / F.lit(6.0), 0.95), any_above=X.any_above([("pre_part", 4), ("grid_5", 3)]))),
    "clip": by_row(lambda: dict(clipped=X.clip("pre_part", 1, 5))),
    "cast_to_category": by_row(lambda: dict(category=X.to_category("pre_part"))),
    "join_mart_blocks": join_mart_blocks, "join_target_left": join_target_left, "join_train_ids_semi": join_train_ids_semi,
    "cross_join_global": cross_join_global, "join_local_modes": join_local_modes, "isin_split": isin_split,
    "loan_counts": by_id(lambda: B.history_counts("rn")),
    "last_snapshot": by_id(lambda: B.snapshots(V.MART_V1.last, "seq", "last")),
    "first_snapshot": by_id(lambda: B.snapshots(V.MART_V1.first, "seq", "first")),
    "flag_shares": by_id(lambda: B.flag_shares(V.MART_V1.shares, V.MART_V1.ever_off)),
    "global_mode": global_mode, "local_mode": local_mode, "global_non_dominant": global_non_dominant,
    "local_non_dominant": local_non_dominant,
    "distinct_counts": by_id(lambda: B.distinct_counts(V.CODES)),
    "bin_sequence": bin_sequence,
    "ever_changed": by_id(lambda: B.ever_changed(V.MART_V1.sequences)),
    "first_eq_last": by_id(lambda: B.first_eq_last(V.MART_V1.first_eq_last, "seq")),
    "mart_v1": mart_v1,
    "value_counts": value_counts, "mode_per_feature": mode_per_feature, "rare_bins": rare_bins,
    "fit_population_stats": fit_population_stats, "incremental_stats": incremental_stats, "inject_stats": inject_stats,
    "base_counters": by_id(lambda: B.base_counters("rn", V.MART_V2.flags)),
    "overdue_util": by_id(lambda: [*B.zero_flags(V.MART_V2.overdue, "has_overdue"), *B.zero_flags(V.MART_V2.usage, "has_nonzero", ("c",))]),
    "composite_overdue": by_id(lambda: B.composite_overdue(V.MART_V2.serious, V.MART_V2.any, V.MART_V2.mild)),
    "change_count": change_count, "changed_ever": changed_ever, "share_global_mode": share_global_mode,
    "share_rare_bins": share_rare_bins,
    "cat_nunique_first_last": by_id(lambda: B.nunique_first_last(["pre_disc", "pre_part"], "seq")),
    "mart_v2": mart_v2, "mart_v1_placed": mart_v1_placed, "mart_v2_placed": mart_v2_placed,
    "unpivot_grid": unpivot_grid, "grid_entropy": grid_entropy,
    "grid_outside_normal": _regular(["paym_regular_entropy", "paym_regular_outside_0_3_count", "paym_regular_outside_0_3_share"]),
    "grid_ever_code": _regular(["paym_regular_ever_bin2"]),
    "grid_special_months": grid_special_months, "grid_row_stats": grid_row_stats, "grid_entity_agg": grid_entity_agg,
    "row_number_dedup": row_number_dedup, "lag_by_entity": lag_by_entity, "lag_by_entity_row": lag_by_entity_row,
    "count_over_partition": count_over_partition, "sum_over_partition": sum_over_partition,
    "max_by_over_partition": max_by_over_partition,
    "top_n_categories": top_n_categories, "collapse_rare": collapse_rare,
    "worst_false_positives": worst_false_positives, "worst_false_negatives": worst_false_negatives,
    "worst_predictions": worst_predictions, "worst_residuals": worst_residuals, "importance_ranking": importance_ranking,
    "split_disjoint_check": split_disjoint_check, "distinct_ids": distinct_ids, "last_label_per_id": last_label_per_id,
    "entity_split": entity_split, "stratified_entity_split": stratified_entity_split,
    "cardinality_guard": cardinality_guard, "missing_fraction": missing_fraction, "constant_fraction": constant_fraction,
    "fit_numeric_fill": fit_numeric_fill, "fit_category_fill": fit_category_fill, "outlier_zscore": outlier_zscore,
    "outlier_iqr": outlier_iqr, "transform_table": transform_table, "fit_transform_table": fit_transform_table,
    "skip_imputation": skip_imputation, "output_feature_names": output_feature_names,
    "typicalness_score": typicalness_score, "payer_flags": payer_flags, "code_transitions": code_transitions,
    "util_and_history": util_and_history, "diversity_profile": diversity_profile, "mutual_information": mutual_information,
    "ordinal_encode": ordinal_encode, "one_hot_encode": one_hot_encode, "freeze_categories": freeze_categories,
    "train_gbt": _fit_and_score("gbt", maxIter=3, maxDepth=3),
    "train_random_forest": _fit_and_score("forest", numTrees=10, maxDepth=5, featureSubsetStrategy="all"),
    "train_logistic": _fit_and_score("logistic", maxIter=200),
    "train_mlp": _fit_and_score("mlp", maxIter=200, hidden=[4]),
    "class_weights": class_weights, "multiclass_ovr": multiclass_ovr, "save_load_model": save_load_model,
    "batch_score": batch_score, "incremental_score": run_incremental_score, "random_search": random_search,
    "confusion_matrix": confusion_matrix, "classification_metrics": classification_metrics, "class_report": class_report,
    "roc_auc": roc_auc, "roc_curve": roc_curve, "roc_auc_ovr": roc_auc_ovr, "regression_metrics": regression_metrics,
    "error_frame": error_frame, "error_trends": error_trends, "residual_trends": residual_trends,
    "error_probability_histogram": error_probability_histogram, "target_rate_by_bin": target_rate_by_bin,
    "dataset_profile": dataset_profile, "feature_importance": feature_importance,
    "permutation_importance": permutation_importance, "tree_attribution": tree_attribution, "global_attribution": global_attribution,
    "local_attribution": local_attribution, "prediction_monitor": prediction_monitor,
    "streaming_monitor": streaming_monitor, "score_contract_checks": score_contract_checks,
}
