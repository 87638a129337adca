"""Rules that small tables do not show: scratch folders, numbers that rounding must not hide, columns
that no default may drop, encoders on both sides of the broadcast bound."""

import math
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import encode as EN
from ledgerfold.operators import evaluate as EV
from ledgerfold.operators import models as MO
from ledgerfold.plans.catalog import rounded
from ledgerfold.sources.scratch import shared_dir
from tests.conftest import rows_of


def session(master, folder=None):
    get = lambda key, default=None: folder if key == "spark.checkpoint.dir" and folder else default
    conf = SimpleNamespace(get=get)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))


def test_no_machine_local_folder_on_a_cluster():
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            shared_dir(session(master))
        assert shared_dir(session(master, "hdfs://x/y")) == "hdfs://x/y"
    assert shared_dir(session("local[4]"))


def test_rounding_hides_nothing(spark):
    values = [math.nan, math.inf, -math.inf, 1e14, -2e13, 1.23456789, -0.0000001, None]
    got = [r[0] for r in rounded(spark.createDataFrame([(v,) for v in values], "x double")).collect()]
    assert math.isnan(got[0]) and got[1:5] == values[1:5] and got[5:] == [1.234568, 0.0, None]


def test_all_trend_columns_are_kept(spark):
    df = spark.range(40).select(*[(F.col("id") % (k + 2)).cast("string").alias(f"c{k}") for k in range(8)],
                                (F.col("id") % 2).cast("int").alias("is_error"), F.col("id").cast("double").alias("error"))
    cols = [f"c{k}" for k in range(8)]
    assert {r["feature"] for r in EV.error_trends(df, cols).collect()} == set(cols)
    assert {r["feature"] for r in EV.residual_trends(df, cols).collect()} == set(cols)
    assert {r["feature"] for r in EV.error_trends(df, cols, top_n=2).collect()} == {"c0", "c1"}


def test_encoders_beyond_the_broadcast_bound(spark, monkeypatch):
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")
    df = spark.createDataFrame([("b", 1), ("z", 2), (None, 3), ("a", 4), ("b", 1)], "c string, n int")
    fitted = EN.fit_categories(train, ["c"])
    small = rows_of(EN.ordinal_encode(df, ["c"], fitted)), rows_of(EN.freeze_categories(df, ["c"], fitted))
    monkeypatch.setattr(EN, "BROADCAST_ROWS", 0)
    assert small == (rows_of(EN.ordinal_encode(df, ["c"], fitted)), rows_of(EN.freeze_categories(df, ["c"], fitted)))
    codes = {(r["c"], r["c_code"]) for r in EN.ordinal_encode(df, ["c"], fitted).collect()}
    assert codes == {("a", 0), ("b", 1), ("z", -1), (None, -1)} and len(small[0]) == 5


def test_codes_are_no_quantities(spark):
    """The middle category decides: a linear model on the codes themselves could not learn it."""
    df = spark.range(300).select(F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("kind"), F.lit(1.0).alias("x"),
                                 (F.col("id") % 3 == 1).cast("int").alias("flag"))
    for family, params in (("logistic", {"maxIter": 50}), ("mlp", {"maxIter": 100, "hidden": [4]})):
        model = MO.train(df, MO.ModelConfig(family=family, params=params, numeric=("x",), categorical=("kind",)))
        assert MO.score(model, df).where("predicted <> flag").count() == 0
        names = [r["feature"] for r in MO.feature_importance(model, spark).collect()]
        assert {"kind_k0", "kind_k1", "kind_k2"} <= set(names)
    with pytest.raises(ValueError):
        MO.train(df, MO.ModelConfig(family="logistic", task="regression", numeric=("x",)))
    line = MO.train(df.withColumn("y", F.col("flag") * 2.0), MO.ModelConfig(family="linear", task="regression", numeric=("x",), categorical=("kind",), label="y"))
    assert MO.score(line, df).where(F.abs(F.col("predicted") - F.col("flag") * 2) > 1e-3).count() == 0
