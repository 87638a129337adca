"""Train, evaluate and score from raw history: the operators put together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.operators.evaluate import classification_metrics, roc_auc
from ledgerfold.operators.models import ModelConfig, feature_importance, score, train
from ledgerfold.operators.preprocess import TableConfig, TablePreprocessor, TablePreprocessorModel
from ledgerfold.operators.split import entity_split, filter_bad_rows
from ledgerfold.operators.stats import fit_population_stats
from ledgerfold.plans.mart import HistorySpec, LeakFreeMart, mart_v2
from ledgerfold.sources.scratch import written


@dataclass(frozen=True)
class SplitConfig:
    test: float = 0.2
    val: float = 0.1
    seed: int = 42


@dataclass
class Trained:
    stats: DataFrame
    cleaner: TablePreprocessorModel
    model: PipelineModel
    importance: DataFrame
    metrics: DataFrame


def train_stats(history: DataFrame, keys: HistorySpec, mart: LeakFreeMart, split: SplitConfig) -> DataFrame:
    """Population statistics of training entities. The split is a function of the id, so this is
    a filter of the scan, not a join."""
    marked = entity_split(history, keys.id, split.test, split.val, split.seed)
    return fit_population_stats(marked.where(F.col("split") == "train"), list(mart.coded))


def split_mart(history: DataFrame, target: DataFrame, keys: HistorySpec, mart: LeakFreeMart, stats: DataFrame,
               split: SplitConfig, max_missing: float = 0.5) -> DataFrame:
    """Mart with labels and a ``split`` column; rows that are mostly empty are dropped."""
    wide = mart_v2(history, keys, mart, stats, target)
    return entity_split(filter_bad_rows(wide, max_missing), keys.id, split.test, split.val, split.seed)


def train_from_history(history: DataFrame, target: DataFrame, keys: HistorySpec, mart: LeakFreeMart, table: TableConfig,
                       model: ModelConfig, split: SplitConfig = SplitConfig()) -> Trained:
    spark = history.sparkSession
    stats = written(train_stats(history, keys, mart, split), "stats")
    # every estimator reads the mart, so it is written once to the shared folder
    rows = written(split_mart(history, target, keys, mart, stats, split), "mart")
    cleaner = TablePreprocessor(table).fit(rows.where(F.col("split") == "train").drop("split"))
    features = cleaner.output_columns([c for c in rows.columns if c not in ("split", model.label)])
    clean = cleaner.transform(rows.drop("split").withColumn("_id", F.col(keys.id)))
    clean = entity_split(clean.withColumnRenamed("_id", keys.id) if keys.id not in clean.columns else clean,
                         keys.id, split.test, split.val, split.seed)
    cats = [c for c in features if c in cleaner.state.categorical]
    nums = [c for c in features if c not in cats and c != keys.id]
    cfg = ModelConfig(**{**model.__dict__, "numeric": tuple(nums), "categorical": tuple(cats)})
    usable = clean.where(F.col("split") != "test").withColumn("_valid", F.col("split") == "val")
    fitted = train(usable, cfg, "_valid")
    scored = score(fitted, clean.where(F.col("split") == "val"))
    area = roc_auc(scored, cfg.label, "probability_1").scalar()
    metrics = classification_metrics(scored, cfg.label, "predicted").withColumn("roc_auc", area)
    return Trained(stats, cleaner, fitted, feature_importance(fitted, spark), metrics)


def score_history(history: DataFrame, trained: Trained, keys: HistorySpec, mart: LeakFreeMart, threshold: float | None = None) -> DataFrame:
    """New history to (id, predicted, probabilities), with the statistics of training time."""
    wide = mart_v2(history, keys, mart, trained.stats)
    clean = trained.cleaner.transform(wide.withColumn("_id", F.col(keys.id)))
    return score(trained.model, clean, threshold).withColumnRenamed("_id", keys.id).select(
        keys.id, "predicted", "probability_1", "confidence")
