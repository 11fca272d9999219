"""Totals and averages over trailing calendar days, by prefix and suffix sums inside window-length blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def every_day(daily: DataFrame, entity: str, day: str) -> DataFrame:
    """One row for each entity and calendar day from its first to its last row; days without a row have nulls in the other columns.

    ``daily`` has one row per entity and day. Each row is repeated over the days up to the next one, so no calendar is joined. An entity
    gives as many rows as its first and last day are apart: a wrong date of year 1 makes some 740,000 of them, which is the most for dates
    of years 1 to 2030.
    """
    rest = [c for c in daily.columns if c not in (entity, day)]
    by_entity = Window.partitionBy(entity).orderBy(day)
    until = F.coalesce(F.date_sub(F.lead(day).over(by_entity), 1), F.col(day))
    spread = daily.withColumn("__until", until).select("*", F.explode(F.sequence(F.col(day), F.col("__until"))).alias("__day"))
    return spread.select(entity, F.col("__day").alias(day), *[F.when(F.col("__day") == F.col(day), F.col(c)).alias(c) for c in rest])


def trailing_totals(daily: DataFrame, entity: str, day: str, measures: list[str], spans: list[int]) -> DataFrame:
    """For each entity and calendar day, totals and counts of each measure over the trailing ``spans`` days, the day itself included.

    Adds ``<measure>_sum_<span>d`` and ``<measure>_n_<span>d``, the number of days with a value, and ``days_<span>d``, the calendar days
    of the span since the entity's first day. A span of W days is cut from blocks of W calendar days: the sum from a block's start to
    each day (prefix) and from each day to its block's end (suffix) are taken once, and the total of the W days ending at a day is the
    prefix at that day plus the suffix W - 1 days before, which lies in the block before; at a block's last day the prefix is the total.
    Nothing is ever subtracted, so totals of zeros are exactly zero, and the work doesn't depend on W.

    ``daily`` must have one row per entity and day (aggregate first: that bounds an entity to its calendar, however many rows it had).
    Rows without entity or day are left out. A null measure counts as zero in totals and not at all in counts; days between rows are
    filled. Empty input gives no rows. Columns other than those named are dropped, so none can clash.
    """
    dense = every_day(daily.where(F.col(entity).isNotNull() & F.col(day).isNotNull()).select(entity, day, *measures), entity, day)
    number = F.unix_date(F.col(day))
    values = {m: F.coalesce(F.col(m).cast("double"), F.lit(0.0)) for m in measures}
    counts = {m: F.col(m).isNotNull().cast("bigint") for m in measures}
    out = dense.withColumn("__no", number)
    for span in spans:
        out = out.withColumn(f"__b{span}", F.floor(F.col("__no") / span))
    ordered = Window.partitionBy(entity).orderBy(day)
    parts: dict[str, Column] = {}
    for span in spans:
        block = Window.partitionBy(entity, f"__b{span}").orderBy(day)
        prefix = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        suffix = block.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        for m in measures:
            for kind, v in (("sum", values[m]), ("n", counts[m])):
                parts[f"__p_{m}_{kind}_{span}"] = F.sum(v).over(prefix)
                parts[f"__s_{m}_{kind}_{span}"] = F.sum(v).over(suffix)
    out = out.withColumns(parts).withColumn("__first", F.first("__no").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    lagged: dict[str, Column] = {}
    for span in spans:
        whole = F.pmod(F.col("__no"), F.lit(span)) == span - 1  # a block's last day
        # Days before the entity's first: the first day's suffix covers all of its block, and older blocks are empty.
        started = F.col("__no") - F.col("__first") >= span - 1
        same_block = F.floor(F.col("__first") / span) == F.col(f"__b{span}")
        for m in measures:
            for kind, zero in (("sum", F.lit(0.0)), ("n", F.lit(0).cast("bigint"))):
                p, s = F.col(f"__p_{m}_{kind}_{span}"), f"__s_{m}_{kind}_{span}"
                back = F.lag(s, span - 1).over(ordered) if span > 1 else F.col(s)
                early = F.first(s).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                lagged[f"{m}_{kind}_{span}d"] = p + F.when(whole, zero).when(started, back).when(same_block, zero).otherwise(early)
        lagged[f"days_{span}d"] = F.least(F.col("__no") - F.col("__first") + 1, F.lit(span)).cast("bigint")
    names = [n for span in spans for n in (*[f"{m}_{k}_{span}d" for m in measures for k in ("sum", "n")], f"days_{span}d")]
    return out.withColumns(lagged).select(entity, day, *measures, *names)
