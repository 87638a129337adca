"""The plan for hot entities gives the same rows as the plan for ordinary ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import blocks as B
from ledgerfold.operators import ordered as O
from ledgerfold.operators.attribution import shuffled
from ledgerfold.operators.skew import ALL, hot_keys
from ledgerfold.operators.split import stratified_entity_split
from ledgerfold.plans import mart as M
from ledgerfold.plans import views as V
from ledgerfold.operators.stats import fit_population_stats
from tests.conftest import rows_of


def test_hot_keys_found_and_bounded(skewed):
    assert hot_keys(skewed, "id", 500) == [7]
    assert hot_keys(skewed, "id") == []


def test_previous(skewed):
    plain = O.with_previous(skewed, "id", "rn", ["a", "b"], [])
    assert rows_of(plain) == rows_of(O.with_previous(skewed, "id", "rn", ["a", "b"], [7]))
    last, expect = {}, []
    for r in sorted(skewed.collect(), key=lambda r: (r["id"], r["rn"])):
        expect.append((r["id"], r["rn"], last.get(r["id"])))
        last[r["id"]] = r["a"]
    got = [(r["id"], r["rn"], r["prev_a"]) for r in plain.select("id", "rn", "prev_a").collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr)


def test_text(skewed):
    plain = rows_of(O.ordered_text(skewed, "id", "rn", ["a", "b"], []))
    assert plain == rows_of(O.ordered_text(skewed, "id", "rn", ["a", "b"], [7]))
    mine = "".join(str(r["a"]) for r in sorted(skewed.where("id = 7").collect(), key=lambda r: r["rn"]) if r["a"] is not None)
    assert {r["id"]: r["a_bin_sequence"] for r in O.ordered_text(skewed, "id", "rn", ["a"], [7]).collect()}[7] == mine


def test_group_values(skewed):
    agg = {"n": F.count("*"), "s": F.sum("b")}
    assert rows_of(O.with_group_values(skewed, "id", agg, [])) == rows_of(O.with_group_values(skewed, "id", agg, [7]))
    two = {"n": F.count("*")}
    assert rows_of(O.with_group_values(skewed, ["id", "a"], two, [])) == rows_of(O.with_group_values(skewed, ["id", "a"], two, [7]))


def test_aggregate_entities(skewed):
    aggs = [F.count("*").alias("n"), *B.change_counts(["a"]), *B.distinct_counts(["b"]), *B.snapshots(["a"], "rn", "last")]

    def prepare(rows, hot):
        return O.with_previous(rows, "id", "rn", ["a"], hot)

    assert rows_of(O.aggregate_entities(skewed, "id", aggs, [], prepare)) == rows_of(O.aggregate_entities(skewed, "id", aggs, [7], prepare))


def test_marts_with_hot_orders(spark, sf):
    h = V.history(spark, sf).withColumn("id", F.when(F.col("rn") <= 2, F.lit(5).cast("bigint")).otherwise(F.col("id")))
    stats = fit_population_stats(h, list(V.MART_V2.coded))
    round_all = lambda df: df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes])
    for made in (lambda hot: M.mart_v1(h, V.KEYS, V.MART_V1, hot=hot), lambda hot: M.mart_v2(h, V.KEYS, V.MART_V2, stats, hot=hot)):
        assert rows_of(round_all(made([]))) == rows_of(round_all(made([5])))


def test_quantiles_of_segments(spark, skewed):
    df = skewed.withColumn("x", F.when(F.col("rn") % 3 == 0, 11.0).otherwise(F.col("rn") * 0.5)).withColumn("y", F.col("a").cast("double"))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    cut = {r["feature"]: r for r in O.exact_quantiles(df, ["x", "y"], probs, segments=64).collect()}
    small = {r["feature"]: r for r in O.exact_quantiles(df, ["x", "y"], probs).collect()}
    for c in ("x", "y"):
        values = np.array([r[c] for r in df.select(c).collect() if r[c] is not None])
        want = np.quantile(values, probs)
        assert np.allclose([cut[c][f"q{i}"] for i in range(5)], want)
        assert np.allclose([small[c][f"q{i}"] for i in range(5)], want)
    for segments in (None, 64):
        by = O.exact_quantiles(df, ["x"], [0.5], ["a"], segments=segments).collect()
        assert {r["a"] for r in by} == {None, 0, 1, 2}
        for r in by:
            values = [v["x"] for v in df.where(F.col("a").eqNullSafe(F.lit(r["a"]))).select("x").collect()]
            assert np.isclose(r["q0"], np.median(values))


def test_strata_without_label_and_with_one_id(spark):
    ids = spark.range(100).withColumn("y", F.when(F.col("id") % 2 == 0, (F.col("id") % 4).cast("int")))
    got = stratified_entity_split(ids, "id", "y").groupBy("y", "split").count().collect()
    assert {(r["y"], r["split"]): r["count"] for r in got if r["y"] is None} == {(None, "test"): 10, (None, "val"): 5, (None, "train"): 35}
    assert sum(r["count"] for r in got) == 100
    with pytest.warns(UserWarning):
        assert stratified_entity_split(ids.withColumn("y", F.when(F.col("id") == 3, 9).otherwise(F.col("y"))), "id", "y").count() == 100


def test_hot_null_and_narrow_orders(spark):
    rows = ([(None, i, i % 5) for i in range(400)] + [(1, i, i % 3) for i in range(300)] + [(2, 10_000_000 + i, i % 7) for i in range(300)]
            + [(3 + i % 50, 5_000 + i, 1) for i in range(200)])
    df = spark.createDataFrame(rows, "id bigint, rn int, a int").repartition(5)
    assert set(hot_keys(df, "id", 200)) == {None, 1, 2}
    plain = rows_of(O.with_previous(df, "id", "rn", ["a"], []))
    assert plain == rows_of(O.with_previous(df, "id", "rn", ["a"], [None, 1, 2]))
    agg = {"n": F.count("*"), "s": F.sum("a")}
    assert rows_of(O.with_group_values(df, "id", agg, [])) == rows_of(O.with_group_values(df, "id", agg, [None, 1, 2]))
    for segments in (1, 7, 200):  # many of 200 ranges are empty
        assert plain == rows_of(O.with_previous(df, "id", "rn", ["a"], segments=segments))
        assert rows_of(O.ordered_text(df, "id", "rn", ["a"], [])) == rows_of(O.ordered_text(df, "id", "rn", ["a"], segments=segments))


@pytest.mark.parametrize("segments, levels, fan", [(1, None, 1024), (16, None, 1024), (16, 2, 8), (16, 3, 3), (40, None, 3), (40, 5, 2)])
def test_running_sums(skewed, segments, levels, fan):
    df = skewed.groupBy("rn").agg(F.sum("b").alias("b"), (F.max("rn") % 3).alias("g"))
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = {r["rn"]: (r["before_b"], r["total_b"]) for r in O.with_running_sums(df, "rn", ["b"], (), segments, levels, fan).collect()}
    by = {r["rn"]: (r["before_b"], r["total_b"]) for r in O.with_running_sums(df, "rn", ["b"], ["g"], segments, levels, fan).collect()}
    rows = df.orderBy("rn").collect()
    seen, total = {None: 0, 1: 0, 2: 0}, {None: 0, 1: 0, 2: 0}
    for r in rows:
        total[r["g"]] += r["b"]
    for r in rows:
        assert got[r["rn"]] == (sum(seen.values()), sum(total.values()))
        assert by[r["rn"]] == (seen[r["g"]], total[r["g"]])
        seen[r["g"]] += r["b"]


def test_two_thousand_large_entities(spark, monkeypatch):
    """More large entities than any list names: previous row, text and group values have no list, and
    the marts' plan for hot entities takes all rows."""
    from ledgerfold.operators import skew

    df = spark.range(2000 * 20).select((F.col("id") % 2000).alias("id"), F.col("id").alias("rn"), (F.hash("id") % 5).alias("a"))
    monkeypatch.setattr(skew, "HOT_ROWS", 15)
    assert hot_keys(df, "id") is ALL
    assert rows_of(O.with_previous(df, "id", "rn", ["a"], [])) == rows_of(O.with_previous(df, "id", "rn", ["a"]))
    assert rows_of(O.ordered_text(df, "id", "rn", ["a"], [])) == rows_of(O.ordered_text(df, "id", "rn", ["a"]))
    agg = {"n": F.count("*"), "s": F.sum("a")}
    assert rows_of(O.with_group_values(df, "id", agg, [])) == rows_of(O.with_group_values(df, "id", agg))
    aggs = [F.count("*").alias("n"), *B.change_counts(["a"])]

    def prepare(rows, hot):
        return O.with_previous(rows, "id", "rn", ["a"], hot)

    assert rows_of(O.aggregate_entities(df, "id", aggs, [], prepare)) == rows_of(O.aggregate_entities(df, "id", aggs, ALL, prepare))
    from ledgerfold.operators.stats import local_modes

    assert rows_of(local_modes(df, "id", ["a"], [])) == rows_of(local_modes(df, "id", ["a"]))


def test_no_list_and_no_scan_before(spark, skewed, monkeypatch):
    """Plans are made without looking at the keys."""
    from ledgerfold.operators import skew

    monkeypatch.setattr(skew, "hot_keys", None)
    O.with_previous(skewed, "id", "rn", ["a"])
    O.ordered_text(skewed, "id", "rn", ["a"])
    O.with_group_values(skewed, "id", {"n": F.count("*")})


def test_permutation_keeps_all_values(spark, skewed):
    df = skewed.withColumn("k", F.col("rn")).dropDuplicates(["k"])
    out = shuffled(df, "k", "b", 3)
    assert out.count() == df.count()
    assert sorted(r["b"] for r in out.collect()) == sorted(r["b"] for r in df.collect())
    assert rows_of(out.drop("b")) == rows_of(df.drop("b"))
    assert rows_of(out) != rows_of(df)


def test_text_codes_across_ranges(spark):
    from ledgerfold.operators.encode import fit_categories

    df = spark.range(6000).select(F.md5(F.col("id").cast("string")).alias("t"))
    codes = {r["value"]: r["code"] for r in fit_categories(df, ["t"]).collect()}
    assert codes == {t: i for i, t in enumerate(sorted(codes))} and len(codes) == 6000


def test_entity_counts_take_one_exchange(spark, skewed):
    from ledgerfold.operators.stats import local_modes, local_non_dominant_counts

    for made in (local_modes, local_non_dominant_counts):
        assert rows_of(made(skewed, "id", ["a", "b"], [])) == rows_of(made(skewed, "id", ["a", "b"], [7]))
        assert made(skewed, "id", ["a", "b"], [])._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
