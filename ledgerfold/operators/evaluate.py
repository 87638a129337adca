"""Metrics, error analysis and monitoring tables over a scored frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.operators.ordered import aggregate_entities, exact_quantiles, with_running_sums
from ledgerfold.operators.placed import parted
from ledgerfold.operators.skew import ALL, dealt, hot_keys
from ledgerfold.operators.stats import collapse_rare, top_values, value_counts, melt
from ledgerfold.sources.scratch import written

# Label of collapsed categories, confidence buckets of the monitor.
OTHER_CATEGORY = "... OTHER ..."
CONFIDENCE_BUCKETS = (0.1, 0.3, 0.5, 0.7, 0.9, 1.0)


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(label, precision, recall, f1, support); 0/0 is 0. Works on the small confusion matrix."""
    cm = confusion_matrix(df, actual, predicted)
    sides = cm.select(F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("a"), F.lit(0).cast("bigint").alias("p"), F.lit(0).cast("bigint").alias("t")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("a"), F.col("n").alias("p"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("t")))).alias("s")).select("s.*")
    per = sides.groupBy("label").agg(F.sum("a").alias("support"), F.sum("p").alias("claimed"), F.sum("t").alias("tp"))
    precision = F.when(F.col("claimed") > 0, F.col("tp") / F.col("claimed")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(F.col("claimed") + F.col("support") > 0, 2 * F.col("tp") / (F.col("claimed") + F.col("support"))).otherwise(0.0)
    return per.select("label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "tp")


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: accuracy, f1_weighted, n."""
    r = class_report(df, actual, predicted)
    n = F.sum("support")
    return r.agg((F.sum("tp") / n).alias("accuracy"), (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"), n.alias("n"))


def score_counts(df: DataFrame, actual: str, score: str, positive=1, group_cols=()) -> DataFrame:
    """(score, pos, neg): rows with equal scores become one row before anything is ordered."""
    is_pos = F.when(F.col(actual) == F.lit(positive), 1).otherwise(0)
    return (df.where(F.col(score).isNotNull() & F.col(actual).isNotNull())
            .groupBy(*group_cols, F.col(score).alias("score"))
            .agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg")))


def roc_auc(df: DataFrame, actual: str, score: str, positive=1, group_cols=()) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting one half; null when one
    class is missing."""
    run = with_running_sums(score_counts(df, actual, score, positive, group_cols), "score", ["pos", "neg"], group_cols)
    area = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2))
    value = area / F.nullif((F.max("total_pos").cast("double") * F.max("total_neg")), F.lit(0.0))
    return run.groupBy(*group_cols).agg(value.alias("roc_auc"))


def roc_curve(df: DataFrame, actual: str, score: str, positive=1) -> DataFrame:
    """(threshold, fpr, tpr) for each distinct score: rows at or above it are called positive."""
    run = with_running_sums(score_counts(df, actual, score, positive), "score", ["pos", "neg"])

    def above(s):
        return (F.col("total_" + s) - F.col("before_" + s)) / F.nullif(F.col("total_" + s), F.lit(0))

    return run.select(F.col("score").alias("threshold"), above("neg").alias("fpr"), above("pos").alias("tpr"))


def roc_auc_ovr(df: DataFrame, actual: str, scores: dict) -> DataFrame:
    """Macro mean of one-vs-rest areas; ``scores`` maps a class to the column of its probability."""
    cells = F.array(*[F.struct(F.lit(k).alias("class"), F.col(c).alias("score"),
                               (F.col(actual) == F.lit(k)).cast("int").alias("hit")) for k, c in scores.items()])
    long = df.where(F.col(actual).isNotNull()).select(F.explode(cells).alias("c")).select("c.*")
    return roc_auc(long, "hit", "score", 1, ["class"]).agg(F.avg("roc_auc").alias("roc_auc_ovr"))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: rmse, mae, r2. The spread is taken around the mean, not from raw squares."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = p - a
    ok = df.where(a.isNotNull() & p.isNotNull())
    return ok.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                  (1 - F.sum(e * e) / F.nullif(F.var_pop(a) * F.count("*"), F.lit(0.0))).alias("r2"))


def error_frame(df: DataFrame, actual: str, predicted: str, probability: str | None = None) -> DataFrame:
    new = {"is_error": (F.col(actual) != F.col(predicted)).cast("int")}
    if probability:
        p = F.col(probability)
        new["confidence_mistake"] = F.when(F.col(actual) == 1, 1 - p).otherwise(p)
    return df.withColumns(new)


def residual_frame(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    e = F.col(predicted) - F.col(actual)
    return df.withColumns({"error": e, "abs_error": F.abs(e)})


def _categories(df: DataFrame, cols, keep, top_k: int) -> DataFrame:
    text = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in cols])
    tops = top_values(value_counts(text, cols, kind="string"), top_k)
    return melt(collapse_rare(text, cols, tops, OTHER_CATEGORY), cols, keep, "string").withColumnRenamed("value", "category")


def error_trends(df: DataFrame, cols, is_error: str = "is_error", top_n: int | None = None, top_k: int = 15) -> DataFrame:
    """Error rate per category of the columns given (of the first ``top_n`` if that is set);
    categories outside the top are one."""
    long = _categories(df, list(cols)[:top_n], [is_error], top_k)
    return long.groupBy("feature", "category").agg(
        F.count("*").alias("n"), F.sum(is_error).alias("errors"), F.avg(is_error).alias("error_rate"))


def residual_trends(df: DataFrame, cols, error: str = "error", top_n: int | None = None, top_k: int = 15) -> DataFrame:
    """Exact residual quartiles per category of the columns given (of the first ``top_n`` if set)."""
    long = _categories(df, list(cols)[:top_n], [error], top_k).withColumnRenamed("feature", "by")
    q = exact_quantiles(long, [error], [0.25, 0.5, 0.75], ["by", "category"])
    return q.select(F.col("by").alias("feature"), "category", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"))


def worst(df: DataFrame, by: Column, n: int, tie: str, kind: str) -> DataFrame:
    """The n first rows by an order, ties by id: a top-n per task, merged."""
    return df.orderBy(by, F.col(tie).asc()).limit(n).withColumn("kind", F.lit(kind))


def worst_false_positives(df: DataFrame, actual: str, probability: str, tie: str, n: int = 5) -> DataFrame:
    return worst(df.where((F.col(actual) == 0) & (F.col("is_error") == 1)), F.col(probability).desc(), n, tie, "false_positive")


def worst_false_negatives(df: DataFrame, actual: str, probability: str, tie: str, n: int = 5) -> DataFrame:
    return worst(df.where((F.col(actual) == 1) & (F.col("is_error") == 1)), F.col(probability).asc(), n, tie, "false_negative")


def worst_predictions(df: DataFrame, actual: str, probability: str, tie: str, n: int = 5) -> DataFrame:
    return worst_false_positives(df, actual, probability, tie, n).unionByName(worst_false_negatives(df, actual, probability, tie, n))


def worst_residuals(df: DataFrame, tie: str, n: int = 10) -> DataFrame:
    return worst(df, F.col("abs_error").desc(), n, tie, "residual")


def error_probability_histogram(df: DataFrame, actual: str, probability: str, bins: int = 20) -> DataFrame:
    """Wrong rows by probability bin and actual label. The range is that of the wrong rows; the
    last bin is closed."""
    wrong = df.where(F.col("is_error") == 1)
    span = wrong.agg(F.struct(F.min(probability).alias("lo"), F.max(probability).alias("hi"))).scalar()
    p, lo, hi = F.col(probability), F.col("_r.lo"), F.col("_r.hi")
    at = F.least(F.floor((p - lo) * bins / F.nullif(hi - lo, F.lit(0.0))), F.lit(bins - 1))
    return (wrong.withColumn("_r", span).select(F.col(actual).alias("actual"), F.coalesce(at, F.lit(0)).cast("int").alias("bin"))
            .groupBy("actual", "bin").agg(F.count("*").alias("n")))


def target_rate_by_bin(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Per value: rows, target sum and mean, percent of all rows; a last line ``ALL``. Rows with a
    null value count in the denominator only."""
    per = df.groupBy(F.col(feature).cast("string").alias("category")).agg(
        F.count("*").alias("n"), F.sum(target).alias("target_sum"), F.count(target).alias("_known"))
    # the last line and the denominator are sums of the groups: the input is aggregated once
    everything = per.agg(F.sum("n").alias("n"), F.sum("target_sum").alias("target_sum"), F.sum("_known").alias("_known"))
    total = everything.select("n").scalar()
    lines = per.where(F.col("category").isNotNull()).unionByName(everything.select(F.lit("ALL").alias("category"), "n", "target_sum", "_known"))
    return lines.select("category", "n", "target_sum", (F.col("target_sum") / F.nullif(F.col("_known"), F.lit(0))).alias("target_mean"),
                        (F.col("n") * 100.0 / total).alias("percent"))


def dataset_profile(df: DataFrame, id_col: str, rn: str, label: str, cols) -> DataFrame:
    """(metric, value): rows, ids, duplicate rows, missing percent and distinct values per column,
    class share, mean over ids of the mean position, largest label count per id.

    Rows are dealt out by id, ``PART_ROWS`` to a task, and that serves the ids and the duplicate rows
    of ordinary ids; those of hot ids are dealt out by all columns."""
    df = written(df, "profile")  # read by five jobs
    hot = hot_keys(df, id_col)
    per_id = aggregate_entities(df, id_col, [F.avg(rn).alias("mean_rn"), F.min(label).alias("lo"), F.max(label).alias("hi")], hot)
    ids = per_id.agg(F.count("*").alias("ids"), F.avg("mean_rn").alias("mean_of_mean_rn"),
                     F.sum((F.col("lo") != F.col("hi")).cast("int")).alias("ids_with_two_labels"))
    rows = df.agg(F.count("*").alias("rows"), F.avg(F.col(label).cast("double")).alias("label_share"),
                  *[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(f"missing_pct_{c}") for c in cols])
    cold_rows, hot_rows = parted(df, id_col, hot)
    equal = cold_rows.groupBy(*df.columns).agg(F.count("*").alias("k"))
    if hot_rows is not None:
        equal = equal.unionByName(dealt(hot_rows, df.count() if hot is ALL else hot.rows, *df.columns).groupBy(*df.columns).agg(F.count("*").alias("k")))
    unique = equal.agg(F.sum(F.col("k") - 1).alias("duplicate_rows"))
    distinct = value_counts(df, cols, kind="string").groupBy("feature").agg(F.count("*").cast("double").alias("value"))
    parts = [_as_metrics(x) for x in (ids, rows, unique)]
    named = distinct.select(F.concat(F.lit("distinct_"), "feature").alias("metric"), "value")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(named)


def _as_metrics(row: DataFrame) -> DataFrame:
    return melt(row, row.columns, kind="double").withColumnRenamed("feature", "metric")


def prediction_monitor(df: DataFrame, predicted: str, confidence: str, buckets=CONFIDENCE_BUCKETS) -> DataFrame:
    """Per predicted class: rows, confidence sum and cumulative ``le`` bucket counts."""
    c = F.col(confidence)
    return df.groupBy(F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n"), F.sum(c).alias("confidence_sum"),
        *[F.sum((c <= b).cast("int")).alias("le_" + str(b).replace(".", "_")) for b in buckets])


def score_contract(df: DataFrame, probabilities, expected_rows: DataFrame) -> DataFrame:
    """One row of checks: probabilities within [0, 1], rows summing to 1, no row lost."""
    ps = [F.col(c) for c in probabilities]
    total = sum(ps[1:], ps[0])
    bad = F.lit(False)
    for p in ps:
        bad = bad | p.isNull() | (p < 0) | (p > 1)
    n_in = expected_rows.agg(F.count("*").alias("n")).scalar()
    return df.agg(
        F.sum(bad.cast("int")).alias("out_of_range"),
        F.sum((F.abs(total - 1) > 1e-6).cast("int")).alias("bad_sum"),
        F.count("*").alias("n_scored")).withColumn("n_input", n_in)


def single_row_differences(scored, df: DataFrame, id_col: str, probability: str, n: int = 5, tolerance: float = 1e-12) -> DataFrame:
    """One row: of ``n`` entities (those of smallest hash of the id) how many were scored alone, and how
    many then got another probability than in the batch. ``scored`` scores a frame."""
    ids = [r[0] for r in df.select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(n).collect()]
    if not ids:
        return df.agg(F.lit(0).cast("bigint").alias("n_single"), F.lit(0).cast("bigint").alias("single_differs"))
    alone = [scored(df.where(F.col(id_col).eqNullSafe(F.lit(i)))).select(F.col(id_col).alias("_id"), F.col(probability).alias("_p")) for i in ids]
    batch = scored(df).select(id_col, probability)
    met = reduce(lambda a, b: a.unionByName(b), alone).join(batch, F.col("_id").eqNullSafe(F.col(id_col)))
    differs = (F.abs(F.col("_p") - F.col(probability)) > tolerance) | (F.col("_p").isNull() != F.col(probability).isNull())
    return met.agg(F.count("*").alias("n_single"), F.coalesce(F.sum(differs.cast("bigint")), F.lit(0)).alias("single_differs"))
