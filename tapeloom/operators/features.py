"""Technical features of bars, one entity's rows in date order; every division is null-safe and all frames are counted in rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.operators.events import event_features, event_ratios
from tapeloom.operators.temporal import interval_join, next_date
from tapeloom.functions.windows import back, log_return, ratio, rolling, streak_groups


def daily_features(bars: DataFrame) -> DataFrame:
    """Returns, moving averages and their ratios, volatility, RSI and MACD of simple averages, position in the 20-row range.

    All frames share one partitioning by code and one sort by date, so the plan has a single exchange and a single sort for them. The
    first row has no change and takes no part in RSI, and an average loss of zero gives a null RSI. Partial windows at an entity's start
    count as they are.
    """
    w = Window.partitionBy("code").orderBy("date")
    c = F.col("close")
    df = bars.withColumns({f"return_{n}d": log_return(c, w, n) for n in (1, 5, 10, 20)} | {"__delta": c - F.lag("close", 1).over(w)})
    df = df.withColumns(
        {f"ma_{n}": F.avg(c).over(back(w, n)) for n in (5, 10, 12, 20, 26, 60)}
        | {f"volume_ma{n}_ratio": ratio(F.col("volume"), F.avg("volume").over(back(w, n))) for n in (5, 20)}
        | {f"amount_ma{n}_ratio": ratio(F.col("amount"), F.avg("amount").over(back(w, n))) for n in (5, 20)}
        | {f"std_{n}d": F.stddev_samp(c).over(back(w, n)) for n in (5, 20)}
        | {
            "volatility_20": F.stddev_samp("return_1d").over(back(w, 20)),
            "__gain": F.avg(F.when(F.col("__delta").isNotNull(), F.greatest(F.col("__delta"), F.lit(0.0)))).over(back(w, 14)),
            "__loss": F.avg(F.when(F.col("__delta").isNotNull(), F.greatest(-F.col("__delta"), F.lit(0.0)))).over(back(w, 14)),
            "__high": F.max("high").over(back(w, 20)),
            "__low": F.min("low").over(back(w, 20)),
        }
    )
    df = df.withColumns(
        {
            "std_ratio": ratio(F.col("std_5d"), F.col("std_20d")),
            "rsi_14": 100 - 100 / (1 + ratio(F.col("__gain"), F.col("__loss"))),
            "macd_diff": F.col("ma_12") - F.col("ma_26"),
            "close_to_high_20d": ratio(c - F.col("__low"), F.col("__high") - F.col("__low")),
            "close_to_ma5": ratio(c, F.col("ma_5")) - 1,
            "close_to_ma20": ratio(c, F.col("ma_20")) - 1,
        }
    )
    df = df.withColumn("macd_signal", F.avg("macd_diff").over(back(w, 9))).withColumn("macd_hist", F.col("macd_diff") - F.col("macd_signal"))
    return df.drop("__delta", "__gain", "__loss", "__high", "__low", "ma_12", "ma_26")


def asset_returns(bars: DataFrame, asset_type: str) -> DataFrame:
    """(asset_type, asset_code, date, partition_month, close, return_1d, return_5d, return_20d, volatility_20) of bars of one kind of asset."""
    w = Window.partitionBy("code").orderBy("date")
    df = bars.select("code", "date", "close", *[log_return(F.col("close"), w, n).alias(f"return_{n}d") for n in (1, 5, 20)])
    month = (F.year("date") * 100 + F.month("date")).cast("bigint").alias("partition_month")
    return df.select(
        F.lit(asset_type).alias("asset_type"), F.col("code").alias("asset_code"), "date", month, "close", "return_1d", "return_5d", "return_20d",
        F.stddev_samp("return_1d").over(back(w, 20)).alias("volatility_20"),
    )


def sell_risk(features: DataFrame) -> DataFrame:
    """Drawdown from the 20- and 60-row high, expansion of volatility, days in a row with RSI over 70, distance from the 60-row mean."""
    w = Window.partitionBy("code").orderBy("date")
    hot = F.col("rsi_14") > 70
    df = features.withColumn("__g", streak_groups(hot, w))
    in_group = Window.partitionBy("code", "__g").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "code", "date",
        *[ratio(F.col("close") - F.max("high").over(back(w, n)), F.max("high").over(back(w, n))).alias(f"drawdown_from_high_{n}d") for n in (20, 60)],
        ratio(F.stddev_samp("close").over(back(w, 5)), F.stddev_samp("close").over(back(w, 60))).alias("vol_expansion"),
        F.sum(F.coalesce(hot, F.lit(False)).cast("bigint")).over(in_group).alias("rsi_streak"),
        ratio(F.col("close") - F.col("ma_60"), F.col("ma_60")).alias("dist_to_ma60"),
    )


def held_positions(bars: DataFrame, days: list[int]) -> DataFrame:
    """(code, date, held, gain, from_peak): each row as if held for each number of rows: against the open of entry and the high since."""
    w = Window.partitionBy("code").orderBy("date")
    held = [F.struct(F.lit(h).alias("held"), F.lag("open", h).over(w).alias("entry"), F.max("high").over(back(w, h + 1)).alias("peak")) for h in days]
    rows = bars.select("code", "date", "close", F.array(*held).alias("hs")).select("code", "date", "close", F.explode("hs").alias("h")).select("code", "date", "close", "h.*").where("entry > 0 AND peak > 0")
    return rows.select("code", "date", "held", (F.col("close") / F.col("entry") - 1).alias("gain"), (F.col("close") / F.col("peak") - 1).alias("from_peak"))


def rich_wide(daily: DataFrame, statements: DataFrame, money: DataFrame, seats: DataFrame, boards: DataFrame, calendar: DataFrame) -> DataFrame:
    """``daily`` (equity_code, date, close, amount, ...) with all that was known on each date, a row for each of its rows.

    Statements (equity_code, ann, until, ...) count from the day after they were announced, and a row whose latest one is of its own day
    has none. Money flow and seats are of the day. Board events come out after the close, so they count on the next date of ``calendar``.
    """
    later = next_date(boards, calendar).where("available_date IS NOT NULL").drop("date").withColumnRenamed("available_date", "date")
    flows = event_features(money, seats, later).drop("partition_month")
    known = interval_join(daily, statements, "equity_code", "date", "ann", "left", same_day=False)
    return known.join(flows, ["equity_code", "date"], "left").withColumns(event_ratios())


def ema_macd(bars: DataFrame) -> DataFrame:
    """MACD of exponential averages (spans 12, 26, 9, unadjusted): (code, date, macd_diff, macd_signal, macd_hist).

    The recursion has no window form; it runs in Arrow batches, one entity at a time, over two narrow columns. An entity is bounded by
    its calendar, as bars have one row a date.
    """

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        close = pdf["close"].astype(float)
        diff = close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean()
        signal = diff.ewm(span=9, adjust=False).mean()
        return pd.DataFrame({"code": pdf["code"], "date": pdf["date"], "macd_diff": diff, "macd_signal": signal, "macd_hist": diff - signal})

    return bars.select("code", "date", "close").groupBy("code").applyInPandas(work, "code string, date date, macd_diff double, macd_signal double, macd_hist double")


def optimal_remaining_days(bars: DataFrame, forward: int = 5, floor: float = -0.10) -> DataFrame:
    """(code, date, label): the number of further rows, 0 to ``forward``, after which selling at the open pays most.

    The rows after each one are looked at in order; the first whose low is under the next open by more than ``floor`` ends the search.
    The earliest of equal best exits counts; null opens are passed over; null if there is no next open. The bounded horizon is unrolled
    into window leads and folded, so nothing leaves the JVM.
    """
    w = Window.partitionBy("code").orderBy("date")
    entry = F.lead("open", 1).over(w)
    steps = F.array(*[F.struct(F.lit(k).alias("k"), F.lead("open", k + 1).over(w).alias("exit"), F.lead("low", k).over(w).alias("low") if k else F.lit(None).cast("double").alias("low")) for k in range(forward + 1)])
    df = bars.withColumn("__entry", entry).withColumn("__steps", steps)
    start = F.struct(F.lit(None).cast("int").alias("best"), F.lit(None).cast("double").alias("gain"), F.lit(False).alias("stop"))

    def fold(state, x):
        broken = state["stop"] | F.coalesce(x["low"] / F.col("__entry") - 1 < floor, F.lit(False))
        gain = x["exit"] / F.col("__entry") - 1
        better = ~broken & gain.isNotNull() & F.coalesce(gain > state["gain"], F.lit(True))
        return F.struct(F.when(better, x["k"]).otherwise(state["best"]).alias("best"), F.when(better, gain).otherwise(state["gain"]).alias("gain"), broken.alias("stop"))

    folded = F.aggregate("__steps", start, fold)
    return df.select("code", "date", F.when(F.col("__entry") > 0, folded["best"]).alias("label"))


def regime_score(index: DataFrame) -> DataFrame:
    """(date, score, regime) of an index series (date, close): trend, momentum, drawdown and volatility points with bear overrides.

    Comparisons with a missing value give no points. The first 200 rows are neutral. The bound on volatility is the 80 % quantile of the
    values so far, of at least 60. One series is one window partition, as it has one row a date.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("date")
    c = F.col("close")
    df = index.withColumns(
        {f"ma{n}": rolling(F.avg(c), c, w, n) for n in (60, 120, 200)}
        | {f"ret{n}": ratio(c, F.lag("close", n).over(w)) - 1 for n in (1, 5, 20, 60)}
        | {f"dd{n}": ratio(c, F.max(c).over(back(w, n))) - 1 for n in (20, 60)}
        | {"no": F.row_number().over(w)}
    )
    df = df.withColumns({"slope": F.col("ma60") - F.lag("ma60", 20).over(w)} | {f"vol{n}": rolling(F.stddev_samp("ret1"), F.col("ret1"), w, n, 2) for n in (20, 60)})
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("q80", F.when(F.count("vol20").over(so_far) >= 60, F.percentile("vol20", 0.8).over(so_far)))
    points = [
        (8, c > F.col("ma60")), (10, c > F.col("ma120")), (12, c > F.col("ma200")), (5, F.col("slope") > 0), (10, F.col("ret20") > 0), (10, F.col("ret60") > 0),
        (10, F.col("dd20") > -0.05), (10, F.col("dd60") > -0.10), (5, F.col("ret5") > -0.03), (12, F.col("vol20") <= F.col("q80")), (8, F.col("vol20") <= 1.2 * F.col("vol60")),
    ]
    score = sum((F.when(cond, n).otherwise(0) for n, cond in points), F.lit(0))
    yes = lambda x: F.coalesce(x, F.lit(False))
    weak = yes(c <= F.col("ma200")) & (yes(F.col("slope") <= 0) | yes(F.col("ret20") <= 0))
    bear = yes(F.col("dd20") <= -0.08) | yes(F.col("ret5") <= -0.05) | weak | (F.col("score") < 40)
    return df.withColumn("score", score.cast("bigint")).select(
        "date", "score", F.when(F.col("no") <= 200, "neutral").when(bear, "bear").when(F.col("score") >= 70, "bull").otherwise("neutral").alias("regime")
    )


def breadth(features: DataFrame) -> DataFrame:
    """Market breadth by date: shares above the 20-row mean, with a positive 20-row return and with a 5-row return under -3 %, median return."""
    flag = lambda x: F.avg(x.cast("double"))
    return features.groupBy("date").agg(
        flag(F.col("close_to_ma20") > 0).alias("above_ma20"), flag(F.col("return_20d") > 0).alias("positive_20d"),
        F.median("return_20d").alias("median_20d"), flag(F.col("return_5d") < -0.03).alias("falling_5d"), F.count(F.lit(1)).alias("n"),
    )


def half_life(series: np.ndarray) -> float:
    """Half-life of mean reversion of a spread; infinite under 10 points or without reversion."""
    x = np.asarray(series, float)
    x = x[np.isfinite(x)]
    if len(x) < 10:
        return float("inf")
    before, step = x[:-1], np.diff(x)
    spread = before - before.mean()
    denominator = float(spread @ spread)
    slope = float(spread @ (step - step.mean())) / denominator if denominator else 0.0
    return float(-np.log(2) / slope) if slope < 0 else float("inf")
