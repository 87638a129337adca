"""Mart semantics that bite, plan shape, and the credit-history layout."""

import itertools
import math
import random

from pyspark.sql import functions as F

from ledgerfold.operators import blocks as B
from ledgerfold.operators import grid as G
from ledgerfold.operators.ordered import with_previous
from ledgerfold.operators.stats import fit_population_stats
from ledgerfold.plans import mart as M
from ledgerfold.plans import presets as P
from ledgerfold.plans import views as V


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_row_entity_has_null_changes(spark):
    df = spark.createDataFrame([(1, 1, 5), (2, 1, 5), (2, 2, 6)], "id int, rn int, x int")
    got = {r["id"]: r["x_change_count"] for r in with_previous(df, "id", "rn", ["x"], []).groupBy("id").agg(*B.change_counts(["x"])).collect()}
    assert got == {1: None, 2: 1}


def test_first_of_null_is_null(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 6)], "id int, rn int, x int")
    r = df.groupBy("id").agg(*B.nunique_first_last(["x"], "rn"), *B.first_eq_last(["x"], "rn")).first()
    assert (r["x_nunique"], r["x_first"], r["x_last"], r["x_first_eq_last"]) == (1, None, 6, None)


def test_null_in_mode_share(spark):
    df = spark.createDataFrame([(1, 5), (1, None)], "id int, x int")
    r = df.groupBy("id").agg(B.share_global_mode({"x": F.lit(5)})[0].alias("a"), B.share_global_mode({"x": F.lit(5)}, False)[0].alias("b")).first()
    assert (r["a"], r["b"]) == (0.5, 1.0)


def test_grid_rows_against_plain_python(spark):
    rng = random.Random(3)
    data = [tuple([i] + [rng.choice([None, 0, 1, 3, 4]) for _ in range(12)]) for i in range(300)] + [tuple([999] + [None] * 12)]
    names = [f"enc_paym_{m}" for m in range(12)]
    df = spark.createDataFrame(data, "id int, " + ", ".join(f"{n} int" for n in names))
    got = {r["id"]: r for r in df.select("id", *G.grid_row_stats(df.columns, "^enc_paym_[0-9]+$", (0, 1))).collect()}
    for row in data:
        v = [x for x in row[1:] if x is not None]
        r = got[row[0]]
        assert r["paym_row_nunique"] == (len(set(v)) if v else None)
        assert r["paym_row_change_count"] == (sum(a != b for a, b in itertools.pairwise(v)) if len(v) > 1 else None)
        assert r["paym_row_first"] == (v[0] if v else None) and r["paym_row_last"] == (v[-1] if v else None)
        assert r["paym_row_share_code_0"] == (v.count(0) / len(v) if v else None)


def exchanges_of_history(df):
    """Output lists of the exchanges by id that carry rows of the history."""
    text = df._jdf.queryExecution().executedPlan().toString()
    formatted = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Exchange" in text
    out = []
    for block in formatted.split("\n\n"):
        if "Exchange" in block.split("\n")[0] and "REPARTITION_BY_COL" in block:
            out.append(block)
    return out


def test_statistics_do_not_travel(spark, sf):
    """One exchange of the history by id for the wide block, without statistics in its rows; the
    same for hot entities, whose rows are not dealt out at all."""
    h = V.history(spark, sf)
    stats = spark.createDataFrame([(c, 1, [2]) for c in V.MART_V2.coded], "feature string, mode_value int, rare_bins array<int>").coalesce(1)
    for hot in ([], [5]):
        for made in (M.mart_v2(h, V.KEYS, V.MART_V2, stats, hot=hot), M.mart_v1(h, V.KEYS, V.MART_V1, hot=hot)):
            found = exchanges_of_history(made)
            assert len(found) == 1 and "_stats" not in found[0] and "_modes" not in found[0]
            plan = plan_of(made)
            assert "Expand" not in plan and "CartesianProduct" not in plan


def test_any_codes(spark):
    """Codes far outside the usual ranges, negative ones too, count like any others."""
    h = credit_history(spark, 30)
    odd = h.withColumns({c: F.when(F.col("rn") == 2, F.lit(1000)).when(F.col("rn") == 3, F.lit(-7)).otherwise(F.col(c))
                         for c in ("pre_loans_credit_limit", "pre_util", "pre_loans5", "enc_paym_2")})
    one = {r["id"]: r for r in M.mart_v1(odd, P.CREDIT_KEYS, P.CREDIT_V1).collect()}
    two = {r["id"]: r for r in M.mart_v2(odd, P.CREDIT_KEYS, P.CREDIT_V2, fit_population_stats(odd, list(P.CREDIT_V2.coded))).collect()}
    by = {}
    for r in odd.collect():
        by.setdefault(r["id"], []).append(r)
    for i, rows in by.items():
        values = [r["pre_loans5"] for r in rows if r["pre_loans5"] is not None]
        assert one[i]["distinct_pre_loans5_count"] == len(set(values))
        top = max((values.count(v) for v in values), default=None)
        assert one[i]["pre_loans5_lnd_count"] == (len(values) - top if values else None)
        assert two[i]["pre_util_nunique"] == len({r["pre_util"] for r in rows} - {None})
        cells = [r[f"enc_paym_{m}"] for r in rows for m in range(25) if m not in (11, 24) and r[f"enc_paym_{m}"] is not None]
        want = sum(cells.count(v) ** 2 / len(cells) * math.log(cells.count(v) / len(cells)) for v in set(cells)) if cells else None
        assert math.isclose(one[i]["paym_regular_entropy"], want, abs_tol=1e-9)


def test_scan_reads_only_needed_columns(spark, sf):
    plan = plan_of(V.history(spark, sf).groupBy("id").agg(*B.history_counts("rn")))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def credit_history(spark, ids=40):
    rng = random.Random(1)
    codes = sorted(set(P.CREDIT_V1.coded))
    flags = [*P.ZERO_DELAYS, *P.ZERO_USAGE, *P.CLOSED]
    rows = []
    for i in range(ids):
        for rn in range(1, rng.randrange(2, 8)):
            rows.append([i, rn, *[rng.choice([None, 0, 1, 2, 15]) for _ in codes], *[rng.choice([0, 1]) for _ in flags],
                         *[rng.choice([None, 0, 1, 2, 3, 4]) for _ in range(25)]])
    cols = ["id bigint", "rn int", *[f"{c} int" for c in codes], *[f"{f} int" for f in flags], *[f"enc_paym_{m} int" for m in range(25)]]
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(cols))


def test_credit_layout_has_all_features(spark):
    h = credit_history(spark)
    target = h.select("id").distinct().withColumn("flag", (F.col("id") % 4 == 0).cast("int"))
    one = M.mart_v1(h, P.CREDIT_KEYS, P.CREDIT_V1, target)
    stats = fit_population_stats(h, list(P.CREDIT_V2.coded))
    two = M.mart_v2(h, P.CREDIT_KEYS, P.CREDIT_V2, stats, target)
    assert len(set(one.columns)) == len(one.columns) == 130 + 2
    assert len(set(two.columns)) == len(two.columns) == 81 + 2
    assert one.count() == two.count() == 40
    assert one.where(F.col("paym_regular_entropy") > 0).count() == 0


def test_plans_have_no_cross_joins_or_python(spark, sf):
    import __spark_entry__ as entry

    for name in ("mart_v1", "inject_stats", "roc_auc", "target_rate_by_bin", "stratified_entity_split", "error_trends", "dataset_profile"):
        plan = plan_of(entry.queries()[name](spark, sf))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "Python", "Arrow"):
            assert word not in plan, (name, word)


def test_top_n_is_limited_before_the_shuffle(spark, sf):
    import __spark_entry__ as entry

    for name in ("top_n_categories", "row_number_dedup"):
        assert "WindowGroupLimit" in plan_of(entry.queries()[name](spark, sf))
