"""Window expressions over one entity's ordered rows; all frames are counted in rows."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def back(w: WindowSpec, n: int) -> WindowSpec:
    """The current row and the n - 1 before it; fewer at the start."""
    return w.rowsBetween(-(n - 1), Window.currentRow)


def so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def rolling(agg: Column, value: Column, w: WindowSpec, n: int, least: int = 1) -> Column:
    """``agg`` over the last n rows, null where fewer than ``least`` of them have a value."""
    frame = back(w, n)
    return F.when(F.count(value).over(frame) >= least, agg.over(frame)) if least > 1 else agg.over(frame)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero or null."""
    return F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0)))


def log_return(value: Column, w: WindowSpec, n: int) -> Column:
    before = F.lag(value, n).over(w)
    return F.when((value > 0) & (before > 0), F.ln(value) - F.ln(before))


def fill_forward(value: Column, w: WindowSpec) -> Column:
    return F.last(value, ignorenulls=True).over(so_far(w))


def fill_both(value: Column, w: WindowSpec) -> Column:
    """Forward, and backward before the first value."""
    return F.coalesce(fill_forward(value, w), F.first(value, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing)))


def streak_groups(condition: Column, w: WindowSpec) -> Column:
    """A number that stays the same over rows in a row that meet the condition; each other row opens a new one."""
    return F.sum(F.when(F.coalesce(condition, F.lit(False)), 0).otherwise(1)).over(so_far(w))


def drawdown(value: Column, w: WindowSpec) -> Column:
    """Share lost since the greatest value so far."""
    peak = F.max(value).over(so_far(w))
    return ratio(value - peak, peak)


def average_rank(value: Column, *partition: str) -> Column:
    """Rank from 1 in ascending order, ties at the mean of their ranks; null for null."""
    ordered = Window.partitionBy(*partition).orderBy(value.asc_nulls_last())
    peers = F.count(F.lit(1)).over(Window.partitionBy(*partition, value))
    return F.when(value.isNotNull(), F.rank().over(ordered) + (peers - 1) / 2.0)


def share_rank(value: Column, *partition: str) -> Column:
    """Average rank as a share of the values that are not null."""
    return ratio(average_rank(value, *partition), F.count(value).over(Window.partitionBy(*partition)))
