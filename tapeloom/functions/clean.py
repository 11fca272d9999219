"""Cleaners of raw text columns: numbers, truth values, dates, lineage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeloom.functions.codes import blank_to_null, strip

# Words for true and false in the raw files.
TRUE_WORDS, FALSE_WORDS = ("true", "1", "yes", "y", "是", "最新"), ("false", "0", "no", "n", "否")


def number(c: Column, kind: str = "decimal(38,9)") -> Column:
    """A number from text; null from blanks and from anything that is none."""
    return blank_to_null(c).try_cast(kind)


def truth(c: Column) -> Column:
    """A truth value from the words in use; null from anything else."""
    text = F.lower(strip(c.cast("string")))
    return F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False)


def date(c: Column) -> Column:
    """A date from YYYY-MM-DD, YYYY/MM/DD or YYYYMMDD, with or without a time after it; null from anything else."""
    text = blank_to_null(c)
    day = F.regexp_extract(text, r"^(\d{4})[-/]?(\d{2})[-/]?(\d{2})(?:$|[ T].*)", 0)
    plain = F.regexp_replace(F.substring(day, 1, 10), "[-/]|[ T].*", "")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}($|[ T])|^\d{4}/\d{2}/\d{2}($|[ T])|^\d{8}($|[ T])"), F.try_to_timestamp(plain, F.lit("yyyyMMdd")).cast("date"))


def loose_date(c: Column) -> Column:
    """A date as in :func:`date` and besides from a number written with .0, from YYYYMM (its first day) and YYYY (its last day)."""
    text = F.regexp_replace(blank_to_null(c), r"^(\d+)\.0$", "$1")
    return (
        F.when(text.rlike(r"^\d{4}$"), F.try_to_timestamp(F.concat(text, F.lit("1231")), F.lit("yyyyMMdd")).cast("date"))
        .when(text.rlike(r"^\d{6}$"), F.try_to_timestamp(F.concat(text, F.lit("01")), F.lit("yyyyMMdd")).cast("date"))
        .otherwise(date(text))
    )


def month_number(d: Column) -> Column:
    """YYYYMM of a date as a number, the partition value of the layered tables."""
    return (F.year(d) * 100 + F.month(d)).cast("bigint")


def payload(*columns: str) -> Column:
    """The given columns as JSON text, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def payload_hash(*columns: str) -> Column:
    """SHA-256 of :func:`payload`."""
    return F.sha2(payload(*columns), 256)


def streak_count(c: Column) -> Column:
    """Number of days in a row from a text: 首板 (first board) is 1, else the first digits in it, else null."""
    text = blank_to_null(c)
    return F.when(text.contains("首板"), 1).otherwise(F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).try_cast("int"))


def finite(c: Column) -> Column:
    """A double without NaN and infinities."""
    d = c.try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), None).otherwise(d)


def first_existing(columns: list[str], candidates: list[str], ordinal: int | None = None) -> str | None:
    """The first of ``candidates`` among ``columns``, else the column at the one-based ``ordinal``, else none."""
    for name in candidates:
        if name in columns:
            return name
    return columns[ordinal - 1] if ordinal and 0 < ordinal <= len(columns) else None
