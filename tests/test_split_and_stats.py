import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import split as SP
from ledgerfold.operators import stats as ST
from ledgerfold.sources import readers as RD


def grouped(spark):
    rows = [(f"c{i // 3}", f"s{i}", float(i), i % 2) for i in range(300)]
    return spark.createDataFrame(rows, "client_id string, session_id string, feature_1 double, label int")


def test_bad_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, None, 1.0), (1.0, None, None), (None, None, None)], "a double, b double, c double")
    assert SP.filter_bad_rows(df, 0.5).count() == 2


def test_split_is_disjoint_and_complete(spark):
    df = SP.entity_split(grouped(spark), "client_id", 0.2, 0.1)
    assert df.count() == 300
    assert SP.ids_in_two_splits(df, "client_id").count() == 0
    assert {r["split"] for r in df.select("split").distinct().collect()} == set(SP.SPLITS)


def test_split_sizes_and_empty_parts(spark):
    assert {r[0] for r in SP.entity_split(grouped(spark), "client_id", 0, 0).select("split").distinct().collect()} == {"train"}
    with pytest.raises(ValueError):
        SP.entity_split(grouped(spark), "client_id", 0.6, 0.4)
    with pytest.raises(ValueError):
        SP.entity_split(grouped(spark), "nobody")


def test_split_repeats(spark):
    one = SP.entity_split(grouped(spark), "client_id", seed=1).collect()
    assert one == SP.entity_split(grouped(spark), "client_id", seed=1).collect()
    assert one != SP.entity_split(grouped(spark), "client_id", seed=2).collect()


def test_stratified_proportions(spark):
    ids = spark.range(1000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    got = {(r["label"], r["split"]): r["count"] for r in SP.stratified_entity_split(ids, "id", "label", 0.2, 0.1).groupBy("label", "split").count().collect()}
    assert got == {(0, "test"): 180, (0, "val"): 90, (0, "train"): 630, (1, "test"): 20, (1, "val"): 10, (1, "train"): 70}


def test_sample_bound(spark):
    assert RD.sample_by_id(spark.range(10000), "id", 0.2).count() == 2001
    assert RD.sample_by_id(spark.range(100), "id", 1.0).count() == 100


def test_target_does_not_multiply_rows(spark):
    t = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "id bigint, flag int")
    out = RD.join_target(spark.range(4), t, "id")
    assert {(r["id"], r["flag"]) for r in out.collect()} == {(0, None), (1, 1), (2, 0), (3, None)}


def test_mode_tie_takes_smallest_and_missing_column(spark):
    df = spark.createDataFrame([(3, None), (3, None), (1, None), (1, None), (2, None)], "x int, y int")
    got = {r["feature"]: (r["mode_value"], r["rare_bins"]) for r in ST.fit_population_stats(df, ["x", "y"]).collect()}
    assert got == {"x": (1, [-999]), "y": (-999, [-999])}


def test_rare_is_strict(spark):
    df = spark.range(100).select(F.when(F.col("id") < 5, 1).when(F.col("id") < 9, 2).otherwise(0).alias("x"))
    assert ST.fit_population_stats(df, ["x"]).first()["rare_bins"] == [2]


def test_stats_use_train_ids_only(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 9), (2, 9), (2, 9)], "id bigint, x int")
    ids = spark.createDataFrame([(1,), (1,)], "id bigint")
    assert ST.fit_population_stats(df, ["x"], ids, "id").first()["mode_value"] == 5
