"""Model families behind one contract: train -> PipelineModel, score, importance, save, load.
Training is Spark's own distributed training; trees, forests, linear models and a network."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier, OneVsRest, OneVsRestModel, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.sources.scratch import written

FEATURES = "_features"
RAW = "_inputs"
WEIGHT = "_weight"
TREES = ("gbt", "forest")


@dataclass(frozen=True)
class ModelConfig:
    family: str = "gbt"
    task: str = "binary"  # binary, multiclass, regression
    params: dict = field(default_factory=dict)
    numeric: tuple = ()
    categorical: tuple = ()
    label: str = "flag"
    weighting: str | float | None = "balanced"
    seed: int = 42
    n_classes: int = 2


def with_class_weight(df: DataFrame, label: str, weighting: str | float | None, name: str = WEIGHT) -> DataFrame:
    """Balanced: largest class count / count of the row's class. A number weighs class 1."""
    if weighting is None:
        return df.withColumn(name, F.lit(1.0))
    if weighting != "balanced":
        return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(weighting))).otherwise(1.0))
    return df.join(F.broadcast(class_weights(df, label).select(label, F.col("weight").alias(name))), label, "left")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): one row per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    largest = counts.agg(F.max("n")).scalar()
    return counts.withColumn("weight", largest / F.col("n"))


def preparation(cfg: ModelConfig) -> list:
    """Indexers (unseen categories share one extra index) and the vector column. Trees split indexes
    as they are; linear models and the network get one 0/1 input per category, the network scaled."""
    cats = [f"{c}_idx" for c in cfg.categorical]
    stages = []
    if cats:
        stages.append(StringIndexer(inputCols=list(cfg.categorical), outputCols=cats, handleInvalid="keep", stringOrderType="alphabetAsc"))
    if cats and cfg.family not in TREES:
        hot = [f"{c}_hot" for c in cfg.categorical]
        stages.append(OneHotEncoder(inputCols=cats, outputCols=hot, handleInvalid="keep", dropLast=False))
        cats = hot
    scaled = cfg.family == "mlp"
    stages.append(VectorAssembler(inputCols=[*cfg.numeric, *cats], outputCol=RAW if scaled else FEATURES, handleInvalid="keep"))
    if scaled:
        stages.append(StandardScaler(inputCol=RAW, outputCol=FEATURES, withMean=True))
    return stages


def estimator(cfg: ModelConfig, valid_col: str | None = None, n_inputs: int | None = None):
    common = {"featuresCol": FEATURES, "labelCol": cfg.label}
    p = dict(cfg.params)
    if cfg.task == "regression":
        if cfg.family == "linear":
            return LinearRegression(**common, **p)
        if cfg.family not in TREES:
            raise ValueError(f"no regression with family {cfg.family!r}; use gbt, forest or linear")
        made = {"gbt": GBTRegressor, "forest": RandomForestRegressor}[cfg.family](**common, seed=cfg.seed, **p)
        return made.setValidationIndicatorCol(valid_col) if valid_col and cfg.family == "gbt" else made
    if cfg.family == "gbt":
        if cfg.task == "multiclass":
            return OneVsRest(classifier=GBTClassifier(**common, seed=cfg.seed, **p), weightCol=WEIGHT, **common)
        made = GBTClassifier(**common, seed=cfg.seed, weightCol=WEIGHT, **p)
        return made.setValidationIndicatorCol(valid_col) if valid_col else made
    if cfg.family == "forest":
        return RandomForestClassifier(**common, seed=cfg.seed, weightCol=WEIGHT, **p)
    if cfg.family == "logistic":
        return LogisticRegression(**common, weightCol=WEIGHT, **p)
    if cfg.family == "mlp":
        if n_inputs is None:
            raise ValueError("the network needs the number of its inputs")
        layers = [n_inputs, *p.pop("hidden", [64]), cfg.n_classes]
        return MultilayerPerceptronClassifier(**common, layers=layers, seed=cfg.seed, **p)
    raise ValueError(f"unknown model family {cfg.family!r}")


def train(df: DataFrame, cfg: ModelConfig, valid_col: str | None = None) -> PipelineModel:
    """Fits preparation and model. ``valid_col`` marks validation rows: boosting stops early on
    them, the other families leave them out. The network has no weights: its rows are repeated by
    weight instead."""
    rows = df.where(F.col(cfg.label).isNotNull())
    stages = preparation(cfg)
    fit_rows = rows if valid_col is None else rows.where(~F.col(valid_col))
    if cfg.task != "regression":
        weights = class_weights(fit_rows, cfg.label) if cfg.weighting == "balanced" else None
        rows = (rows.join(F.broadcast(weights.select(cfg.label, F.col("weight").alias(WEIGHT))), cfg.label, "left")
                .fillna(1.0, [WEIGHT]) if weights is not None else with_class_weight(rows, cfg.label, cfg.weighting))
    early = cfg.family == "gbt" and cfg.task != "multiclass" and valid_col is not None
    if valid_col is not None and not early:
        rows = rows.where(~F.col(valid_col))
    if cfg.family != "mlp":
        return Pipeline(stages=[*stages, estimator(cfg, valid_col if early else None)]).fit(rows)
    prepared = Pipeline(stages=stages).fit(rows)
    if cfg.weighting is not None:
        rows = repeated_by_weight(rows, cfg.seed)
    inputs = prepared.transform(rows)
    first = inputs.select(FEATURES).first()
    if first is None:
        raise ValueError("no rows to train on")
    network = estimator(cfg, n_inputs=first[0].size).fit(inputs)
    return PipelineModel(stages=[*prepared.stages, network])


def repeated_by_weight(df: DataFrame, seed: int) -> DataFrame:
    """Each row as many times as its weight says; a fraction is the share of rows that get one more,
    decided by a hash of the row."""
    names = [c for c in df.columns if c != WEIGHT]
    chance = F.pmod(F.xxhash64(F.lit(seed), *names), F.lit(1 << 20)) / float(1 << 20)
    times = (F.floor(WEIGHT) + (chance < F.col(WEIGHT) - F.floor(WEIGHT)).cast("int")).cast("int")
    counted = df.withColumn("_times", times).where("_times > 0")
    return counted.withColumn("_times", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def score(model: PipelineModel, df: DataFrame, threshold: float | None = None, classes: bool = True) -> DataFrame:
    """Adds ``predicted``, ``probability_1`` (class 1) and ``confidence`` (largest class)."""
    inner = {FEATURES, RAW, "rawPrediction", "probability", "prediction"}
    last = model.stages[-1]
    keep = [c for c in df.columns if c not in inner]
    if classes and isinstance(last, OneVsRestModel):
        return _score_one_vs_rest(model, df, keep)
    out = model.transform(df)
    if not classes or "probability" not in out.columns:
        return out.select(*keep, F.col("prediction").alias("predicted"))
    probs = vector_to_array("probability")
    p1 = F.get(probs, F.lit(1))
    predicted = F.col("prediction") if threshold is None else (p1 > threshold).cast("double")
    return out.select(*keep, predicted.cast("int").alias("predicted"), p1.alias("probability_1"),
                      F.array_max(probs).alias("confidence"), probs.alias("probabilities"))


def _score_one_vs_rest(model: PipelineModel, df: DataFrame, keep) -> DataFrame:
    """Each class's own probability against the rest, divided by their sum."""
    out = df
    for stage in model.stages[:-1]:
        out = stage.transform(out)
    names = []
    for i, one in enumerate(model.stages[-1].models):
        names.append(f"_p{i}")
        out = one.transform(out).withColumn(names[-1], F.get(vector_to_array("probability"), F.lit(1))).drop("rawPrediction", "probability", "prediction")
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    out = out.withColumn("probabilities", F.array(*[F.col(n) / total for n in names]))
    top = F.array_max("probabilities")
    return out.select(*keep, (F.array_position("probabilities", top) - 1).cast("int").alias("predicted"),
                      F.get("probabilities", F.lit(1)).alias("probability_1"), top.alias("confidence"), "probabilities")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(feature, importance): tree importances, absolute coefficients of a linear model, or for each
    input of a network the mean absolute weight of its first layer. The 0/1 inputs of a category
    are named after it and its value."""
    last = model.stages[-1]
    names = input_names(model)
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        values = abs(last.coefficients.toArray())
    elif isinstance(last, MultilayerPerceptronClassificationModel):
        n, hidden = list(last.getLayers())[:2]
        # the weights of a layer lie input by input, one per output; biases follow
        values = abs(last.weights.toArray()[: n * hidden].reshape(n, hidden)).mean(axis=1)
    else:
        raise ValueError("this model family has no importance")
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")


def input_names(model: PipelineModel) -> list[str]:
    labels = {o: list(v) for s in model.stages if isinstance(s, StringIndexerModel) for o, v in zip(s.getOutputCols(), s.labelsArray)}
    hot = {o: i for s in model.stages if isinstance(s, OneHotEncoderModel) for o, i in zip(s.getOutputCols(), s.getInputCols())}
    out = []
    for c in [s for s in model.stages if isinstance(s, VectorAssembler)][0].getInputCols():
        if c not in hot:
            out.append(c)
            continue
        size = [s for s in model.stages if isinstance(s, OneHotEncoderModel)][0].categorySizes[list(hot).index(c)]
        values = [*labels[hot[c]], "unseen"][:size]
        out += [f"{c.removesuffix('_hot')}_{v}" for v in values] + [f"{c.removesuffix('_hot')}_other{k}" for k in range(size + 1 - len(values))]
    return out


def importance_ranking(importance: DataFrame, k: int = 15) -> DataFrame:
    """Best k and worst k features."""
    best = importance.orderBy(F.col("importance").desc(), "feature").limit(k).withColumn("kind", F.lit("top"))
    worst = importance.orderBy(F.col("importance").asc(), "feature").limit(k).withColumn("kind", F.lit("worst"))
    return best.unionByName(worst)


def evaluator(cfg: ModelConfig, metric: str | None = None):
    if cfg.task == "binary":
        return BinaryClassificationEvaluator(labelCol=cfg.label, metricName=metric or "areaUnderROC")
    if cfg.task == "multiclass":
        return MulticlassClassificationEvaluator(labelCol=cfg.label, metricName=metric or "f1")
    return RegressionEvaluator(labelCol=cfg.label, metricName=metric or "rmse")


def draw_params(space: dict, n: int, seed: int) -> list[dict]:
    """n settings from ranges {name: {"type": int|float, "bounds": [lo, hi], "log": bool}}."""
    rng = random.Random(seed)

    def one(s):
        lo, hi = s["bounds"]
        if s.get("type", "float") == "int":
            return rng.randint(int(lo), int(hi))
        if s.get("log"):
            import math
            return math.exp(rng.uniform(math.log(lo), math.log(hi)))
        return rng.uniform(lo, hi)

    return [{name: one(s) for name, s in space.items()} for _ in range(n)]


def random_search(train_df: DataFrame, valid_df: DataFrame, cfg: ModelConfig, space: dict, n: int, seed: int = 42, parallelism: int = 4):
    """Trains each drawn setting and measures it on validation rows, ``parallelism`` trials at a time over
    one written copy of both tables. A failed trial is recorded and the search goes on. Returns (best
    setting, table of trials); of equal metrics the earlier trial is best. ``scale_pos_weight`` in the space is the
    weight of class 1; other names are parameters of the family."""
    spark = train_df.sparkSession
    measure = evaluator(cfg)
    train_rows, valid_rows = written(train_df, "search-train"), written(valid_df, "search-valid")

    def tried(drawn: dict):
        try:
            return float(measure.evaluate(refit(train_rows, cfg, drawn).transform(valid_rows))), None
        except Exception as e:  # noqa: BLE001 - one bad setting must not end the search
            return None, type(e).__name__

    settings = draw_params(space, n, seed)
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(tried), settings))
    done = [(value, drawn) for (value, _), drawn in zip(found, settings) if value is not None]
    if not done:
        raise RuntimeError("every trial failed")
    pick = max if measure.isLargerBetter() else min
    best = pick(done, key=lambda t: t[0])[1]
    rows = [(i, {k: float(v) for k, v in d.items()}, value, error) for i, (d, (value, error)) in enumerate(zip(settings, found))]
    return best, spark.createDataFrame(rows, "trial int, params map<string,double>, metric double, error string")


def refit(df: DataFrame, cfg: ModelConfig, best: dict, valid_col: str | None = None) -> PipelineModel:
    own = dict(best)
    weighting = own.pop("scale_pos_weight", cfg.weighting)
    return train(df, ModelConfig(**{**cfg.__dict__, "params": {**cfg.params, **own}, "weighting": weighting}), valid_col)
