"""Reductions of the delivered kline rows that several operators start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.codes import equity_code
from tapeloom.functions.windows import fill_both, ratio


def lineage(*extra: str) -> Column:
    """The project's lineage order as a struct to be taken at its greatest: source_file, source_entry (null last) and source_hash, all
    descending. Spark compares text by its UTF-8 bytes and takes null for the least value, so the greatest struct is the first row."""
    return F.struct("source_file", "source_entry", "source_hash", *extra)


def daily_amount(kline: DataFrame, adjust_type: str = "none") -> DataFrame:
    """(equity_code, date, amount): the largest non-null amount of each code and date; null if the date has rows but no amount.

    Aggregated on the map side first, so a code with any number of deliveries is reduced before the shuffle. Rows without code or date
    are left out.
    """
    return (
        kline.where(F.col("adjust_type") == adjust_type)
        .select(equity_code(F.col("equity_code")).alias("equity_code"), "date", "amount")
        .where(F.col("equity_code").isNotNull() & F.col("date").isNotNull())
        .groupBy("equity_code", "date")
        .agg(F.max("amount").alias("amount"))
    )


BAR = ["open", "high", "low", "close", "volume", "amount"]


def latest_by_lineage(df: DataFrame, key: list[str], values: list[str], order: list[str] | None = None) -> DataFrame:
    """One row for each key: the one that comes first in lineage order (each of ``order`` descending, null last).

    An aggregate with map-side combining rather than a window, so a key with any number of deliveries is reduced before the shuffle. Null
    key parts are equal to each other; rows equal in the whole order are told apart by their values, the greatest first.
    """
    columns = order or ["source_file", "source_entry", "source_hash"]
    best = F.max(F.struct(*columns, F.struct(*values).alias("__values"))).alias("__best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col("__best.__values").getField(v).alias(v) for v in values])


def bars(kline: DataFrame, adjust_type: str) -> DataFrame:
    """(code, date, open .. amount): one bar for each normalised code and date of an adjust type, by lineage, with a positive close."""
    rows = kline.where(F.col("adjust_type") == adjust_type).withColumn("code", equity_code(F.col("equity_code"))).where("code IS NOT NULL AND date IS NOT NULL")
    return latest_by_lineage(rows, ["code", "date"], BAR).where("close > 0")


def resample(df: DataFrame, keys: list[str], order: list[str], price: str, volume: str) -> DataFrame:
    """Bars of the rows of each key: open and close are the prices of the first and last row in ``order``, then high, low, volume, n."""
    at = F.struct(*order)
    return df.groupBy(*keys).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"),
        F.sum(volume).alias("volume"), F.count(F.lit(1)).alias("n"),
    )


def resample_bars(daily: DataFrame, period: str) -> DataFrame:
    """Weekly or monthly bars (``week`` or ``month``) of daily ones, dated by the period's first calendar day; open is the first not null."""
    start = F.date_trunc(period, F.col("date")).cast("date").alias("period_start")
    return daily.groupBy("code", start).agg(
        F.min_by("open", F.when(F.col("open").isNotNull(), F.col("date"))).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "date").alias("close"),
        F.sum("volume").alias("volume"), F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("days"),
    )


def apply_factors(raw: DataFrame, factors: DataFrame, mode: str, digits: int = 4) -> DataFrame:
    """Prices adjusted by factors (code, date, factor): a day without factor takes the last one before it, or the first after it.

    ``qfq``: price x factor / the code's last factor; ``hfq``: price x factor; a code without any factor keeps its prices.
    """
    w = Window.partitionBy("code").orderBy("date")
    whole = Window.partitionBy("code")
    joined = raw.join(factors.select("code", "date", "factor"), ["code", "date"], "left").withColumn("factor", fill_both(F.col("factor"), w))
    if mode == "qfq":
        joined = joined.withColumn("factor", ratio(F.col("factor"), F.max_by("factor", "date").over(whole)))
    by = F.coalesce("factor", F.lit(1.0))
    return joined.select("code", "date", *[F.round(F.col(c) * by, digits).alias(c) for c in ("open", "high", "low", "close")], "volume", "amount", F.round("factor", 8).alias("factor"))
