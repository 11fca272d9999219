"""The N best items of every group, by a split into heavy and light groups."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.names import col, prefix, renamed
from tapeloom.session import materialize, small

_ORDERABLE_NOT = ("map", "variant", "void")
#: A group is heavy if it has more rows than this part of a task's fair share of all rows.
FAIR_PART = 16


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, place: str = "place", hot_rows: int | None = None) -> DataFrame:
    """The first ``n`` rows of every group in ``order``, with their place from 1.

    Exact row counts per group part the input. A group of more than ``hot_rows`` rows is heavy; by default that is a FAIR_PART-th of the
    rows that each shuffle partition would get of all, so the line moves with the data and the cluster, and there are at most FAIR_PART
    times as many heavy groups as partitions, however many groups there are. Heavy groups are sorted by range over group and order into
    as many ranges as their share of the rows asks for, the range number being the salt; each range keeps its own first ``n`` of a group,
    and only those meet in one last window. All other groups take ordinary windows. Both ways are exact, so the line changes no result.
    ``df`` is read three times; pass a materialized one if it is costly.

    Ties: rows equal in ``order`` are ordered by all other columns of ``df``, ascending with nulls first, in the order of their names;
    whole copies of a row are told apart by nothing and each take a place. Nulls: a null group key is a group like any other; nulls in
    ``order`` stand where the given sort puts them. An empty input gives no rows; ``n`` under 1 gives no rows. Other columns are carried
    along; one that is called as ``place`` comes out with the suffix ``_in``. Columns that cannot be sorted break no ties.
    """
    spark, kinds = df.sparkSession, dict(df.dtypes)
    p = prefix("__topn", df.columns, [place])
    ties = [col(c).asc_nulls_first() for c in sorted(df.columns) if c not in group and not any(k in kinds[c] for k in _ORDERABLE_NOT)]
    keys = [col(g) for g in group]
    total_order = [*order, *ties]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = materialize(df.groupBy(*[k.alias(f"{p}_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias(f"{p}_n")), "topn-counts")
    total = counts.agg(F.sum(f"{p}_n")).first()[0] or 0
    line = hot_rows if hot_rows is not None else total / (FAIR_PART * tasks)
    heavy_keys = counts.where(col(f"{p}_n") > F.lit(line))
    hot = heavy_keys.agg(F.sum(f"{p}_n")).first()[0] or 0
    if hot:
        same = [k.eqNullSafe(col(f"{p}_k{i}")) for i, k in enumerate(keys)]
        side = small(heavy_keys.drop(f"{p}_n"))
        ranges = max(2, math.ceil(hot / max(1.0, min(line, total / tasks) if hot_rows is not None else total / tasks)))
        salted = df.join(side, same, "left_semi").repartitionByRange(ranges, *keys, *total_order).withColumn(f"{p}_salt", F.spark_partition_id())
        kept = _window(salted, [*keys, col(f"{p}_salt")], total_order, n, f"{p}_local").drop(f"{p}_local", f"{p}_salt")
        ranked = _window(kept, keys, total_order, n, f"{p}_place")
        if hot < total:
            ranked = ranked.unionByName(_window(df.join(side, same, "left_anti"), keys, total_order, n, f"{p}_place"))
    else:
        ranked = _window(df, keys, total_order, n, f"{p}_place")
    names = renamed(df.columns, [place])
    return ranked.select(*[col(c).alias(names.get(c, c)) for c in df.columns], col(f"{p}_place").alias(place))


def _window(df: DataFrame, keys: list[Column], order: list[Column], n: int, place: str) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(place, number.cast("bigint")).where(col(place) <= n)
