"""Attributes as they were known at the time of each event, by version numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.names import col, prefix, renamed

#: Width in days of the time blocks over which changes are counted first.
BLOCK_DAYS = 512


def known_at(events: DataFrame, attributes: DataFrame, entity: str, event_date: str, known_date: str, latest: Column, block_days: int = BLOCK_DAYS, how: str = "inner") -> DataFrame:
    """Each event with the attributes of its entity that had become known last on or before the event's date.

    Every attribute row becomes a version of its entity: the rows of one entity and ``known_date`` are first reduced to the one with the
    greatest ``latest``, and those are numbered by date. An event's version number is the count of its entity's changes up to its date.
    The count is taken over narrow rows (entity, date, change), distinct events only, and in two steps: changes per time block of
    ``block_days`` days with their running total over the blocks, then a running count inside each block. A window so never holds more
    than the distinct dates of one entity and block, whatever part of all rows an entity has. Wide attributes and full events then meet
    in an equi-join on entity and number, which adaptive execution splits where an entity is skewed.

    ``how``: ``inner``, or ``left`` to keep events that have no version, with nulls.

    Nulls: attribute rows without entity or ``known_date`` are ignored; events without entity or date, and events before their entity's
    first version, are not in an inner result. Ties in ``latest`` take the row with the greater values in the other columns. Repeated events
    come out as often as they came in. Empty inputs give no rows. Columns of ``attributes`` that are called as columns of ``events``
    come out with the suffix ``_known``.
    """
    wide = [c for c in attributes.columns if c != entity]
    names = renamed(wide, events.columns, "_known")
    e, t, x = (f"{prefix('__known', events.columns, attributes.columns)}_{n}" for n in ("entity", "date", "row"))
    key, at, since = col(entity), col(event_date), col(known_date)
    versions = (
        attributes.where(key.isNotNull() & since.isNotNull())
        .groupBy(key.alias("__e"), since.alias("__t"))
        .agg(F.max(F.struct(latest.alias("__latest"), *[col(c) for c in wide])).alias("__row"))
    )
    narrow = versions.select("__e", "__t", F.lit(1).alias("__change")).unionByName(
        events.where(key.isNotNull() & at.isNotNull()).select(key.alias("__e"), at.alias("__t"), F.lit(0).alias("__change")).distinct()
    )
    numbers = _versions_so_far(narrow, block_days)
    numbered = versions.join(numbers.where("__change = 1").select("__e", "__t", "__v"), ["__e", "__t"]).select("__e", "__v", "__row")
    # events of one entity and date share a number; those before the first version have number 0 and drop out of the join
    moments = numbers.where("__change = 0 AND __v > 0").select("__e", "__t", "__v")
    dated = moments.join(numbered, ["__e", "__v"]).select(F.col("__e").alias(e), F.col("__t").alias(t), F.col("__row").alias(x))
    joined = events.join(dated, (key == F.col(e)) & (at == F.col(t)), how)
    return joined.select(*[col(c) for c in events.columns], *[F.col(x).getField(c).alias(names.get(c, c)) for c in wide])


def _versions_so_far(narrow: DataFrame, block_days: int) -> DataFrame:
    """``narrow`` with ``__v``, the number of changes of its entity up to and including each row's date."""
    blocked = narrow.withColumn("__b", F.floor(F.unix_date(F.to_date("__t")) / F.lit(block_days)))
    totals = blocked.groupBy("__e", "__b").agg(F.sum("__change").alias("__n"))
    before = Window.partitionBy("__e").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__e", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__e", "__b").orderBy("__t", F.col("__change").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        blocked.withColumn("__inside", F.sum("__change").over(inside))
        .join(offsets, ["__e", "__b"])
        .select("__e", "__t", "__change", (F.col("__inside") + F.col("__offset")).alias("__v"))
    )
