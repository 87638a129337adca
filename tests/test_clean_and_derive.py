import pytest
from pyspark.sql import functions as F

from ledgerfold.functions import scalar as X
from ledgerfold.operators import encode as EN
from ledgerfold.operators import engineer as EG
from ledgerfold.operators import preprocess as PR


def frame(spark, n=200):
    df = spark.range(n)
    return df.select(
        F.concat(F.lit("s"), "id").alias("session_id"),
        F.when(F.col("id") % 20 != 0, F.concat(F.lit("brand"), (F.col("id") % 3).cast("string"))).alias("brand"),
        F.when(F.col("id") % 10 != 0, F.col("id") * 1.5).alias("area"), (F.col("id") * F.when(F.col("id") == 7, 500).otherwise(1)).cast("double").alias("hits"),
        F.lit(1.0).alias("constant_col"), F.when(F.col("id") == 3, 1.0).alias("mostly_null"), (F.col("id") % 2).cast("int").alias("flag"))


CFG = PR.TableConfig(target_col="flag", drop_cols=("session_id",), top_n=2, outlier_method="zscore", outlier_threshold=2.0)


def test_not_fitted(spark):
    with pytest.raises(ValueError):
        PR.TablePreprocessorModel(CFG, None).transform(frame(spark))


def test_clean(spark):
    df = frame(spark)
    model = PR.TablePreprocessor(CFG).fit(df)
    out = model.transform(df)
    assert out.count() == 200
    assert {"constant_col", "mostly_null", "session_id"}.isdisjoint(out.columns)
    assert out.columns == model.output_columns()
    assert out.dropna().count() == 200
    assert {r[0] for r in out.select("brand").distinct().collect()} == {"other_collapsed", "brand1", "brand2"} or \
        len({r[0] for r in out.select("brand").distinct().collect()}) == 3
    lo, hi = model.state.bounds["hits"]
    assert out.agg(F.max("hits")).first()[0] == pytest.approx(hi)
    assert out.agg(F.min("hits")).first()[0] >= lo


def test_learns_from_train_only(spark):
    train, other = frame(spark).where("hits < 100"), frame(spark).where("hits >= 100")
    model = PR.TablePreprocessor(PR.TableConfig(target_col="flag", drop_cols=("session_id",), exact_excludes=("area",))).fit(train)
    med = train.agg(F.percentile("area", F.lit(0.5))).first()[0]
    assert model.state.fills["area"] == med
    filled = model.transform(other.withColumn("area", F.lit(None).cast("double")))
    assert {r[0] for r in filled.select("area").collect()} == {med}


def test_guard_near_the_limit(spark):
    df = spark.range(5000).select((F.col("id") % 100).alias("c100"), (F.col("id") % 101).alias("c101"))
    model = PR.TablePreprocessor(PR.TableConfig()).fit(df)
    assert model.state.categorical == ["c100"] and model.state.numeric == ["c101"]


def test_keep_null_and_mode(spark):
    cfg = PR.TableConfig(target_col="flag", drop_cols=("session_id",), cat_fill="mode", keep_null=True)
    model = PR.TablePreprocessor(cfg).fit(frame(spark))
    row = model.transform(frame(spark).where("hits = 0")).first()
    assert row["brand"] == model.state.tops["brand"][0]


def test_save_and_load(spark, tmp_path):
    model = PR.TablePreprocessor(CFG).fit(frame(spark))
    model.save(spark, str(tmp_path / "m"))
    again = PR.TablePreprocessorModel.load(spark, str(tmp_path / "m"))
    assert again.transform(frame(spark)).collect() == model.transform(frame(spark)).collect()


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0,), (9,)], "x int").select(X.clip("x", 1, 5).alias("y"))
    assert [r[0] for r in df.collect()] == [None, 1, 5]


def test_code_outside_range_fails(spark):
    with pytest.raises(Exception, match="code outside"):
        spark.createDataFrame([(70,)], "x int").agg(F.bit_or(X.code_bit("x"))).collect()
    wide = spark.createDataFrame([(70,), (3,), (70,), (None,)], "x int")
    from ledgerfold.operators.blocks import distinct_codes
    assert wide.agg(distinct_codes("x", 128)).first()[0] == 2


def test_derived_columns(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 0.99), (0.5, 0.2, 2.0, 0.1), (0.1, 0.0, None, 0.5)],
                               "share_any_overdue double, share_serious_overdue double, pre_util_last double, good double")
    out = EG.engineer(df, good_share="good", any_share="share_any_overdue", serious_share="share_serious_overdue", last_code="pre_util_last",
                      transitions={"absent": ("no", "pre_util_last")}, kinds="no", total="no").collect()
    assert [r["is_absolutely_perfect_payer"] for r in out] == [1, 0, 0]
    assert [r["is_chronic_defaulter"] for r in out] == [0, 1, 0]
    assert [r["cat_util_and_history"] for r in out] == ["1_Clean", "2_Frequent", "-999_Mild"]
    assert "absent" not in out[0].asDict()


def test_one_hot_unseen_and_missing(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    cats = EN.categories_of(EN.fit_categories(train, ["c"]), ["c"])
    out = EN.one_hot_encode(spark.createDataFrame([("a",), ("z",), (None,)], "c string"), {**cats, "gone": ["x"]})
    assert [tuple(r) for r in out.collect()] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_too_many_categories_to_collect(spark):
    fitted = EN.fit_categories(spark.range(30).select(F.col("id").cast("string").alias("c")), ["c"])
    with pytest.raises(ValueError):
        EN.categories_of(fitted, ["c"], limit=20)
