"""Labels for learning from bars: forward returns, cross-section classes, drawdowns ahead."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.windows import ratio


def forward_returns(bars: DataFrame, horizons: list[int]) -> DataFrame:
    """(code, date, forward_<h>d, exec_<h>d): log returns of the close over the next h rows, and from the next open to that h rows on."""
    w = Window.partitionBy("code").orderBy("date")
    out = []
    for h in horizons:
        close, first, last = F.lead("close", h).over(w), F.lead("open", 1).over(w), F.lead("open", h + 1).over(w)
        out += [
            F.when((close > 0) & (F.col("close") > 0), F.ln(close) - F.ln("close")).alias(f"forward_{h}d"),
            F.when((first > 0) & (last > 0), F.ln(last) - F.ln(first)).alias(f"exec_{h}d"),
        ]
    return bars.select("code", "date", *out)


def cross_section_class(values: DataFrame, value: str, top: float = 0.3, bottom: float = 0.3, least: int = 10) -> DataFrame:
    """(code, date, value, label): 1 for the top and 0 for the bottom share of each date by interpolated quantiles, null between.

    Dates of fewer than ``least`` values have no labels. A value at both bounds is 0. The bounds, a row a date, are joined back.
    """
    bounds = values.groupBy("date").agg(
        F.percentile(value, 1 - top).alias("__hi"), F.percentile(value, bottom).alias("__lo"), F.count(value).alias("__n")
    ).where(F.col("__n") >= least)
    label = F.when(F.col(value) <= F.col("__lo"), 0).when(F.col(value) >= F.col("__hi"), 1)
    return values.join(bounds, "date", "left").select("code", "date", value, label.cast("int").alias("label"))


def drawdown_ahead(bars: DataFrame, forward: int = 5, threshold: float = -0.05) -> DataFrame:
    """(code, date, worst, label): least change of the close over the next rows, and 1 if it is at most ``threshold``; null for the last row."""
    w = Window.partitionBy("code").orderBy("date").rowsBetween(1, forward)
    worst = ratio(F.min("close").over(w), F.col("close")) - 1
    return bars.select("code", "date", worst.alias("worst")).withColumn("label", (F.col("worst") <= threshold).cast("int"))


def approximate_class(values: DataFrame, value: str, top: int = 70, bottom: int = 30, accuracy: int = 10_000) -> DataFrame:
    """(code, date, value, label): as :func:`cross_section_class`, but the bounds are of a date's hundred approximate quantiles, which merge
    over tasks in bounded memory, the top counts where a value is at both, and small dates have labels, too. Nulls are left out."""
    ok = values.where(F.col(value).isNotNull())
    bounds = ok.groupBy("date").agg(F.percentile_approx(value, [top / 100, bottom / 100], accuracy).alias("__q"))
    label = F.when(F.col(value) >= F.col("__q")[0], 1).when(F.col(value) <= F.col("__q")[1], 0)
    return ok.join(bounds, "date").select("code", "date", value, label.cast("int").alias("label"))
