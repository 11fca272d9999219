"""Boosted trees on a panel: time-ordered split, class weights, and the gates that a model has to pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.operators import stats


@dataclass(frozen=True)
class TreeParameters:
    """Rounds, learning rate, depth and share of rows a tree."""

    rounds: int = 30
    step: float = 0.05
    depth: int = 6
    subsample: float = 0.8
    seed: int = 7


def eval_split(panel: DataFrame, date: str = "date", share: float = 0.8, least_dates: int = 5) -> DataFrame:
    """``panel`` with ``is_eval``, true on the last dates: those from the ``share`` quantile of the distinct dates on. ValueError under
    ``least_dates`` dates. Dates are few; they are ranked by themselves and joined back."""
    dates = panel.select(date).distinct()
    if dates.count() < least_dates:
        raise ValueError(f"fewer than {least_dates} dates")
    ranked = dates.withColumn("__share", F.percent_rank().over(Window.partitionBy(F.lit(0)).orderBy(date)))
    return panel.join(ranked.select(date, (F.col("__share") >= share).alias("is_eval")), date)


def class_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """``train`` with ``weight``, by which both classes weigh alike."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("t"), F.count(F.lit(1)).alias("k")).first()
    return train.join(counts, label).withColumn("weight", F.lit(float(total["t"] or 0)) / (F.lit(float(total["k"] or 1)) * F.col("__n"))).drop("__n")


def train_trees(panel: DataFrame, features: list[str], label: str = "label", parameters: TreeParameters = TreeParameters()):
    """A fitted pipeline from the rows of ``panel`` that are not ``is_eval`` and have a label; missing features are a value of their own.
    None if those rows have one class only."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    train = class_weights(panel.where(~F.col("is_eval") & F.col(label).isNotNull()).fillna(-999.0, features), label)
    if train.select(label).distinct().count() < 2:
        return None
    trees = GBTClassifier(labelCol=label, weightCol="weight", maxIter=parameters.rounds, stepSize=parameters.step, maxDepth=parameters.depth, subsamplingRate=parameters.subsample, seed=parameters.seed)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), trees]).fit(train)


def predict(model, panel: DataFrame, features: list[str]) -> DataFrame:
    """``panel`` with ``prob_up``."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(panel.fillna(-999.0, features))
    return scored.withColumn("prob_up", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def gates(scored: DataFrame, outcome: str, label: str = "label", least_auc: float = 0.52, least_rank_ic: float = 0.05) -> DataFrame:
    """One row: auc over all rows, mean of the daily rank_ic against ``outcome``, and whether both reach their least value."""
    auc = stats.auc_by(scored.withColumn("__all", F.lit(0)), "__all", "prob_up", label).select("auc")
    ic = stats.information_coefficients(scored, "prob_up", outcome).agg(F.avg("rank_ic").alias("rank_ic"))
    row = auc.withColumn("__k", F.lit(0)).join(ic.withColumn("__k", F.lit(0)), "__k").drop("__k")
    passed = F.coalesce((F.col("auc") >= least_auc) & (F.col("rank_ic") >= least_rank_ic), F.lit(False))
    return row.withColumn("passed", passed)
