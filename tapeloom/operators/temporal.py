"""Joins over time: statement intervals, strict as-of lookup, next available date, calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.operators.known_at import known_at


def intervals(statements: DataFrame, entity: str, since: str, period: str, values: list[str]) -> DataFrame:
    """(entity, since, until, period, values): each statement with the half-open interval in which it is the latest one.

    Statements of one entity and day are reduced to that of the greatest period first, so the interval ends at the next other day.
    """
    one = statements.where(F.col(entity).isNotNull() & F.col(since).isNotNull()).groupBy(entity, since).agg(F.max(F.struct(period, *values)).alias("r"))
    ordered = Window.partitionBy(entity).orderBy(since)
    return one.withColumn("until", F.lead(since).over(ordered)).select(entity, since, "until", *[F.col(f"r.{c}").alias(c) for c in (period, *values)])


def interval_join(events: DataFrame, spans: DataFrame, entity: str, at: str, since: str, how: str = "inner", same_day: bool = True) -> DataFrame:
    """Events with the interval that holds their date, by :func:`known_at`: linear in events and intervals, and split in time blocks, so an
    entity may have any number of either.

    ``same_day``: a statement counts from its own day; otherwise an event whose statement is of the same day is left without one (inner:
    left out), and does not fall back on the one before.
    """
    own = [c for c in spans.columns if c != entity]
    joined = known_at(events, spans, entity, at, since, F.col(since), how=how)
    if same_day:
        return joined
    begun = F.col(at) > F.col(since)
    return joined.where(begun) if how == "inner" else joined.select(*events.columns, *[F.when(begun, F.col(c)).alias(c) for c in own])


def last_before(events: DataFrame, known: DataFrame, entity: str, at: str, since: str, value: str, strict: bool = True) -> DataFrame:
    """Events with the last ``value`` of their entity before their date (or on it, unless ``strict``), by :func:`known_at`.

    Null where there is none. Rows of ``known`` of one date take the greatest value. ``since`` must be a date.
    """
    one = known.select(entity, since, value).withColumn("__from", F.date_add(since, 1 if strict else 0))
    return known_at(events, one, entity, at, "__from", F.col(value), how="left").drop("__from")


def next_date(facts: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Facts with ``available_date``, the first calendar date after their own; null after the calendar's end and for a null date.

    Worked out once for each distinct date of facts and calendar, which are few, and joined back on the date.
    """
    marks = facts.select(F.col(date).alias("__d"), F.lit(None).cast("date").alias("__c")).unionByName(calendar.select(F.col(date).alias("__d"), F.col(date).cast("date").alias("__c")))
    days = marks.where("__d IS NOT NULL").groupBy("__d").agg(F.max("__c").alias("__c"))
    after = Window.partitionBy(F.lit(0)).orderBy("__d").rowsBetween(1, Window.unboundedFollowing)
    return facts.join(days.select("__d", F.first("__c", ignorenulls=True).over(after).alias("available_date")), F.col(date) == F.col("__d"), "left").drop("__d")


def business_days(df: DataFrame, start: str, end: str, holidays: DataFrame | None = None) -> DataFrame:
    """(date, ordinal): the weekdays from the earliest ``start`` to the latest ``end``, without the dates of ``holidays``, numbered from 1."""
    span = df.agg(F.min(start).alias("lo"), F.max(end).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date")).where(F.weekday("date") < 5)
    if holidays is not None:
        days = days.join(holidays.select("date").distinct(), "date", "left_anti")
    return days.withColumn("ordinal", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("date")).cast("bigint"))


def month_ends(df: DataFrame, date: str) -> DataFrame:
    """(month, last_date): the last date of each month that has rows."""
    return df.where(F.col(date).isNotNull()).groupBy((F.year(date) * 100 + F.month(date)).cast("bigint").alias("month")).agg(F.max(date).alias("last_date"))
