"""Set operations on keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """``target`` with the rows of ``source`` in place of those of the same key: an anti-join and a union.

    The columns are the target's; those that the source lacks keep the target's value where the key was there and are null otherwise.
    ``source`` must have each key once; null key parts match nothing.
    """
    shared = [c for c in target.columns if c in source.columns]
    kept = [c for c in target.columns if c not in shared]
    fresh = source.select(*shared)
    if kept:
        fresh = fresh.join(target.select(*key, *kept), key, "left")
    return target.join(source.select(*key), key, "left_anti").unionByName(fresh.select(*target.columns))


def keep_last(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of both, of equal keys those of ``new``; rows of one side that share a key are reduced to the one with the greatest values."""
    rest = [c for c in old.columns if c not in key]
    both = old.select("*", F.lit(0).alias("__age")).unionByName(new.select(*old.columns, F.lit(1).alias("__age")))
    return both.groupBy(*key).agg(F.max(F.struct("__age", *rest)).alias("r")).select(*key, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*old.columns)


def schema_difference(df: DataFrame, required: dict[str, str]) -> list[tuple[str, str, str | None]]:
    """(column, wanted type, type found or none) of the columns that ``df`` lacks or has otherwise; reads no rows."""
    have = dict(df.dtypes)
    return [(c, t, have.get(c)) for c, t in required.items() if have.get(c) != t]
