"""Normal forms of instrument codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code prefixes by exchange.
BJ_PREFIXES = ("43", "83", "87", "88", "92")
SH_PREFIXES = ("5", "6", "9")
SZ_INDEX_PREFIX = "399"
SH_INDEX_PREFIXES = ("000", "930", "932", "950")

NORMAL_FORM = r"^[0-9]{6}\.(SH|SZ|BJ)$"
#: White space at either end, as Unicode has it.
OUTER_BLANKS = r"^[\s\p{Z}\u0085]+|[\s\p{Z}\u0085]+$"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, OUTER_BLANKS, "")


def blank_to_null(c: Column) -> Column:
    """Stripped text; null if nothing is left."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def _canonical(c: Column) -> Column:
    return F.upper(F.replace(strip(c.cast("string")), F.lit("_"), F.lit(".")))


def _any_prefix(c: Column, prefixes: tuple[str, ...]) -> Column:
    return c.rlike("^(" + "|".join(prefixes) + ")")


def equity_code(c: Column) -> Column:
    """``NNNNNN.EX`` from bare, dotted, prefixed, underscored or lower-case codes; null from null or blank; other text upper-cased.

    Codes that are in normal form already, nearly all of them, take a short way.
    """
    text = _canonical(c)
    bare = (
        F.when(_any_prefix(text, BJ_PREFIXES), F.concat(text, F.lit(".BJ")))
        .when(_any_prefix(text, SH_PREFIXES), F.concat(text, F.lit(".SH")))
        .otherwise(F.concat(text, F.lit(".SZ")))
    )
    return (
        F.when(c.cast("string").rlike(NORMAL_FORM), c.cast("string"))
        .when(text == "", None)
        .when(text.rlike("^[0-9]{6}$"), bare)
        .when(text.rlike("^(SH|SZ|BJ)[0-9]{6}$"), F.concat(F.substring(text, 3, 6), F.lit("."), F.substring(text, 1, 2)))
        .otherwise(text)
    )


def strict_code(c: Column, fail: bool = False) -> Column:
    """:func:`equity_code` of what is a code at all, also one read as a number (600000.0); null, or an error if ``fail``, of anything else."""
    code = equity_code(F.regexp_replace(c.cast("string"), r"\.0\s*$", ""))
    wrong = F.raise_error(F.concat(F.lit("no code: "), F.coalesce(c.cast("string"), F.lit("null")))).cast("string") if fail else F.lit(None).cast("string")
    return F.when(code.rlike(NORMAL_FORM), code).otherwise(wrong)


def index_code(c: Column) -> Column:
    """As :func:`equity_code`, for indexes: 399ddd belongs to SZ and 000/930/932/950ddd to SH even where the suffix says otherwise."""
    text = _canonical(c)
    six, known = F.substring(text, 1, 6), r"[0-9]{3}(\.(SH|SZ|BJ))?$"
    return (
        F.when(text == "", None)
        .when(text.rlike("^" + SZ_INDEX_PREFIX + known), F.concat(six, F.lit(".SZ")))
        .when(text.rlike("^(" + "|".join(SH_INDEX_PREFIXES) + ")" + known), F.concat(six, F.lit(".SH")))
        .when(text.rlike("^39[0-9]{4}$"), F.concat(text, F.lit(".SZ")))
        .when(text.rlike("^[0-9]{6}$"), F.concat(text, F.lit(".SH")))
        .when(text.rlike("^(SH|SZ|BJ)[0-9]{6}$"), F.concat(F.substring(text, 3, 6), F.lit("."), F.substring(text, 1, 2)))
        .otherwise(text)
    )


def yyyymmdd(c: Column) -> Column:
    """A date as the text YYYYMMDD."""
    return F.date_format(c, "yyyyMMdd")


def sql_strip(expr: str) -> str:
    """DuckDB text of :func:`strip`."""
    return rf"regexp_replace({expr}, '^[\s\p{{Z}}\x{{0085}}]+|[\s\p{{Z}}\x{{0085}}]+$', '', 'g')"


def sql_equity_code(expr: str) -> str:
    """DuckDB text of :func:`equity_code`."""
    t = f"upper(replace({sql_strip(expr)}, '_', '.'))"
    return (
        f"CASE WHEN {t} = '' THEN NULL"
        f" WHEN regexp_full_match({t}, '[0-9]{{6}}') THEN {t} || CASE WHEN left({t}, 2) IN ('43','83','87','88','92') THEN '.BJ'"
        f" WHEN left({t}, 1) IN ('5','6','9') THEN '.SH' ELSE '.SZ' END"
        f" WHEN regexp_full_match({t}, '(SH|SZ|BJ)[0-9]{{6}}') THEN substr({t}, 3) || '.' || substr({t}, 1, 2)"
        f" ELSE {t} END"
    )
