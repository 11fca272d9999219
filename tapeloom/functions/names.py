"""Column names that keep clear of each other; Spark takes names without regard to case."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def prefix(base: str, *columns: Iterable[str]) -> str:
    """``base``, made longer until none of the columns begins with it."""
    taken = [c.lower() for group in columns for c in group]
    while any(c.startswith(base) for c in taken):
        base = "_" + base
    return base


def renamed(columns: Iterable[str], taken: Iterable[str], suffix: str = "_in") -> dict[str, str]:
    """New names of those ``columns`` that are ``taken``: with ``suffix``, as often as it needs."""
    columns, used = list(columns), {c.lower() for c in taken}
    everything = used | {c.lower() for c in columns}
    out = {}
    for c in columns:
        if c.lower() in used:
            new = c + suffix
            while new.lower() in everything:
                new += suffix
            everything.add(new.lower())
            out[c] = new
    return out


def keep_clear(df: DataFrame, taken: Iterable[str], suffix: str = "_in") -> DataFrame:
    """``df`` with its columns that are called as one of ``taken`` renamed by a suffix."""
    names = renamed(df.columns, taken, suffix)
    return df.select(*[col(c).alias(names.get(c, c)) for c in df.columns]) if names else df
