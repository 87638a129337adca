import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerfold.operators import attribution as AT
from ledgerfold.operators import evaluate as EV
from ledgerfold.operators import models as MO
from ledgerfold.plans import presets as P
from ledgerfold.plans.workflow import SplitConfig, score_history, train_from_history
from ledgerfold.sources import contract as C
from ledgerfold.streaming.score import incremental_score
from tests.test_marts import credit_history


@pytest.fixture(scope="module")
def rows(spark):
    h = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 4), 16, 10).cast("double") / 65536
    return (spark.range(600).withColumn("x", h).withColumn("z", (F.col("id") % 7).cast("double"))
            .withColumn("kind", F.concat(F.lit("k"), (F.col("id") % 3).cast("string")))
            .withColumn("flag", (F.col("x") > 0.7).cast("int")).cache())


CFG = MO.ModelConfig(family="logistic", params={"maxIter": 20}, numeric=("x", "z"), categorical=("kind",))


@pytest.mark.parametrize("family,params", [("gbt", {"maxIter": 4, "maxDepth": 2}), ("forest", {"numTrees": 5}), ("logistic", {"maxIter": 20}), ("mlp", {"maxIter": 40, "hidden": [4]})])
def test_families_learn(rows, family, params):
    cfg = MO.ModelConfig(family=family, params=params, numeric=("x", "z"), categorical=("kind",))
    model = MO.train(rows.withColumn("_valid", F.col("id") % 5 == 0), cfg, "_valid")
    out = MO.score(model, rows)
    assert EV.roc_auc(out, "flag", "probability_1").first()[0] > 0.9
    bad = EV.score_contract(out.withColumns({"p0": F.get("probabilities", F.lit(0)), "p1": F.col("probability_1")}), ["p0", "p1"], rows).first()
    assert (bad["out_of_range"], bad["bad_sum"], bad["n_scored"]) == (0, 0, 600) and bad["n_input"] == 600


def test_reload_and_unseen_category_and_null(spark, rows, tmp_path):
    model = MO.train(rows, CFG)
    MO.save_model(model, str(tmp_path / "m"))
    again = MO.load_model(str(tmp_path / "m"))
    odd = rows.limit(3).withColumn("kind", F.lit("never"))
    a, b = (MO.score(m, odd).select("probability_1").collect() for m in (model, again))
    assert a == b and len(a) == 3


def test_search_survives_a_bad_trial(rows):
    space = {"regParam": {"type": "float", "bounds": [-0.2, 0.2]}, "scale_pos_weight": {"type": "float", "bounds": [1.0, 3.0]}}
    best, trials = MO.random_search(rows, rows, CFG, space, 4, seed=3)
    found = trials.collect()
    assert len(found) == 4 and any(t["error"] for t in found) and best["regParam"] >= 0
    assert MO.draw_params(space, 4, 3) == MO.draw_params(space, 4, 3)


def test_importance_and_permutation(spark, rows):
    model = MO.train(rows, CFG)
    top = MO.importance_ranking(MO.feature_importance(model, spark), 1).where("kind = 'top'").first()
    assert top["feature"] == "x"
    perm = {r["feature"]: r["importance"] for r in AT.permutation_importance(model, rows, "id", ["x", "z"], BinaryClassificationEvaluator(labelCol="flag")).collect()}
    assert perm["x"] > perm["z"]


def test_stream_scores_each_file_once(spark, rows, tmp_path):
    model = MO.train(rows, CFG)
    features, land, out, ckpt = rows.drop("flag"), *[str(tmp_path / n) for n in ("in", "out", "ckpt")]
    for part in (0, 1):
        features.where(F.col("id") % 2 == part).write.mode("append").parquet(land)
        incremental_score(spark, model, land, features.schema, out, ckpt).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 600 and got.select("id").distinct().count() == 600


def test_contract(spark, rows):
    text = C.feature_schema(rows, exclude=("flag",))
    loose = rows.select(F.col("kind"), F.col("z").cast("string").alias("z"), "x", "id", "flag")
    assert C.conform(loose, text).dtypes[:4] == [("id", "bigint"), ("x", "double"), ("z", "double"), ("kind", "string")]
    with pytest.raises(ValueError):
        C.conform(loose.drop("x"), text)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.6)], "y int, p double")
    assert EV.roc_auc(df, "y", "p").first()[0] is None


def test_history_to_scores(spark):
    h = credit_history(spark, 150)
    target = h.select("id").distinct().withColumn("flag", (F.col("id") % 3 == 0).cast("int"))
    got = train_from_history(h, target, P.CREDIT_KEYS, P.CREDIT_V2, P.CREDIT_TABLE,
                             MO.ModelConfig(family="gbt", params={"maxIter": 2, "maxDepth": 2}), SplitConfig(0.2, 0.2, 1))
    assert set(got.metrics.columns) == {"accuracy", "f1_weighted", "n", "roc_auc"}
    assert got.metrics.first()["n"] > 0
    scored = score_history(h, got, P.CREDIT_KEYS, P.CREDIT_V2)
    assert scored.count() == 150 and scored.where("probability_1 is null").count() == 0
    # an entity whose history is empty but for its keys, and one with codes at their limits
    blank = h.limit(1).select(*[F.col(c) if c in ("id", "rn") else F.lit(None).cast(t).alias(c) for c, t in h.dtypes])
    edge = h.limit(1).select(*[F.lit(63).alias(c) if c.startswith(("pre_", "enc_loans")) else F.col(c) for c in h.columns])
    for odd in (blank, edge):
        one = score_history(odd, got, P.CREDIT_KEYS, P.CREDIT_V2).collect()
        assert len(one) == 1 and 0.0 <= one[0]["probability_1"] <= 1.0
    # a row's score does not depend on the other rows
    some = [r["id"] for r in h.select("id").distinct().orderBy("id").limit(3).collect()]
    alone = score_history(h.where(F.col("id").isin(some)), got, P.CREDIT_KEYS, P.CREDIT_V2)
    assert {r["id"]: r["probability_1"] for r in alone.collect()} == {r["id"]: r["probability_1"] for r in scored.where(F.col("id").isin(some)).collect()}
