"""Deterministic scores from features, as column expressions; a missing input counts as its neutral value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _or(name: str, default: float) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def clip(c: Column, low: float, high: float) -> Column:
    """Between bounds; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def sigmoid(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def base_score(rsi: str = "rsi_14") -> Column:
    """5-row return, half the 20-row one, RSI near its middle, distance to the 20-row mean, less deviation."""
    middle = (50 - F.abs(_or(rsi, 50.0) - 50)) / 100
    return _or("return_5d", 0.0) + 0.5 * _or("return_20d", 0.0) + middle + 0.3 * _or("close_to_ma20", 0.0) - 0.01 * _or("std_20d", 0.0)


def rich_score() -> Column:
    """The base score with valuation and quality: a moderate positive pe and pb, and return on equity."""
    cheap = F.when((F.col("pe") > 0) & (F.col("pe") < 30), 0.5 / (F.greatest(F.col("pe"), F.lit(1.0)) + 1)).otherwise(0.0)
    low = F.when((F.col("pb") > 0) & (F.col("pb") < 5), 0.3 / (F.greatest(F.col("pb"), F.lit(0.5)) + 1)).otherwise(0.0)
    return base_score() + cheap + low + F.coalesce(0.5 * clip(F.col("roe"), -30.0, 30.0) / 100, F.lit(0.0))


def remaining_days(most: float = 5.0) -> Column:
    """Days worth holding, 0 to ``most``, from drawdowns, expansion of volatility, overheating and trend."""
    risk = (
        -4 * F.coalesce(clip(F.col("drawdown_from_high_20d"), -1.0, 0.0), F.lit(0.0))
        - 2 * F.coalesce(clip(F.col("drawdown_from_high_60d"), -1.0, 0.0), F.lit(0.0))
        + 1.5 * F.greatest(_or("vol_expansion", 1.0) - 1, F.lit(0.0))
        + (_or("rsi_streak", 0) > 5).cast("double")
        + 0.5 * (_or("return_5d", 0.0) < -0.05).cast("double")
        + 0.4 * (_or("rsi_14", 50.0) > 80).cast("double")
    )
    hold = F.coalesce(clip(F.col("return_20d"), -0.5, 0.5), F.lit(0.0)) + 0.3 * F.coalesce(clip(F.col("dist_to_ma60"), -1.0, 1.0), F.lit(0.0))
    return most * (1 - sigmoid(risk - hold))


def sell_chance(days: Column, threshold: float = 1.0, sharpness: float = 1.5) -> Column:
    """Chance of selling from days worth holding."""
    return sigmoid(-sharpness * (days - threshold))


def with_scores(features: DataFrame, risk: DataFrame) -> DataFrame:
    """(code, date, base, days, chance) of features and their sell-risk features."""
    joined = features.join(risk, ["code", "date"])
    return joined.select("code", "date", base_score().alias("base"), remaining_days().alias("days")).withColumn("chance", sell_chance(F.col("days")))
