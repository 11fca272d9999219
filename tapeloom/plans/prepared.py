"""Queries of the general data-preparation operators, with the SQL they are held against where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.codes import blank_to_null, equity_code, sql_equity_code, sql_strip, yyyymmdd
from tapeloom.operators.archive import PART_ROWS, SMALL_BYTES, index, pack, plan_blocks, record_files, records, small_files, unpack
from tapeloom.operators.bars import daily_amount, lineage
from tapeloom.operators.drift import edit_scripts, unify
from tapeloom.operators.known_at import known_at
from tapeloom.operators.spikes import Limits, flag_readings
from tapeloom.operators.trailing import trailing_totals
from tapeloom.session import materialize, small, table

Query = Callable[[SparkSession, str], DataFrame]
KLINE, FACTOR, INDICATOR = "dwd_fact_equity_kline_1d", "dwd_fact_adjust_factor", "dwd_fact_financial_indicator"


#: Physical limits of the readings, and runs of equal ones that no trading gives.
KLINE_LIMITS = {"close": Limits(stuck=7, active="volume"), "volume": Limits(zero=True, most=1e13, stuck=5)}
FACTOR_LIMITS = {"adjust_factor": Limits()}


def _incredible(spark: SparkSession, d: str, name: str, limits: dict[str, Limits]) -> DataFrame:
    code = equity_code(F.col("equity_code")).alias("equity_code")
    rows = table(spark, d, name).select(code, "adjust_type", "date", *limits, "source_hash")
    flagged = materialize(flag_readings(rows, ["equity_code", "adjust_type"], "date", limits), "p3-flagged")
    readings = rows.select(
        "equity_code", "adjust_type", "date", "source_hash",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in limits])).alias("r"),
    ).select("equity_code", "adjust_type", "date", "source_hash", "r.field", "r.value")
    keys = ["equity_code", "adjust_type", "date", "field", "value"]
    held = readings.join(small(flagged.select(*keys)), keys)
    return held.select(F.lit(name).alias("table_name"), "source_hash", F.col("field").alias("field_name")).distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _incredible(spark, d, KLINE, KLINE_LIMITS).unionByName(_incredible(spark, d, FACTOR, FACTOR_LIMITS))


def p3_scores(spark: SparkSession, d: str) -> DataFrame:
    """The readings that are not credible with their isolation score and the reasons."""
    out = None
    for name, limits in ((KLINE, KLINE_LIMITS), (FACTOR, FACTOR_LIMITS)):
        rows = table(spark, d, name).withColumn("equity_code", equity_code(F.col("equity_code")))
        flagged = flag_readings(rows, ["equity_code", "adjust_type"], "date", limits).withColumn("table_name", F.lit(name))
        out = flagged if out is None else out.unionByName(flagged)
    return out.withColumn("score", F.round("score", 6))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    code = equity_code(F.col("equity_code")).alias("equity_code")
    days = table(spark, d, KLINE).where("adjust_type = 'none' AND date IS NOT NULL").select(code, "date").distinct()
    indicators = (
        table(spark, d, INDICATOR)
        .select(code, "announcement_date", blank_to_null(F.col("report_period")).alias("report_period"))
        .where("report_period IS NOT NULL")
    )
    days = materialize(days, "p4-days")  # read by several branches of the plan
    known = known_at(days, indicators, "equity_code", "date", "announcement_date", F.col("report_period"))
    return known.select("equity_code", yyyymmdd(F.col("date")).alias("date"), yyyymmdd(F.col("announcement_date")).alias("announcement_date"), "report_period")


P4_SQL = f"""
WITH days AS (
  SELECT DISTINCT {sql_equity_code('equity_code')} AS code, date FROM {KLINE} WHERE adjust_type = 'none' AND date IS NOT NULL),
known AS (
  SELECT {sql_equity_code('equity_code')} AS code, announcement_date AS ann, max({sql_strip('report_period')}) AS period
  FROM {INDICATOR} WHERE announcement_date IS NOT NULL AND {sql_strip('report_period')} <> '' GROUP BY 1, 2)
SELECT days.code AS equity_code, strftime(days.date, '%Y%m%d') AS date, strftime(ann, '%Y%m%d') AS announcement_date, period AS report_period
FROM days ASOF JOIN known ON days.code = known.code AND days.date >= known.ann
"""


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    daily = daily_amount(table(spark, d, KLINE))
    totals = trailing_totals(daily, "equity_code", "date", ["amount"], [7, 30])
    return totals.where("amount_sum_7d = 0 AND amount_sum_30d > 0").select("equity_code", yyyymmdd(F.col("date")).alias("date"))


_P7_DENSE = f"""
WITH daily AS (
  SELECT {sql_equity_code('equity_code')} AS code, date, max(amount) AS amount,
    arg_max(close, (source_file, coalesce(source_entry, ''), source_hash)) FILTER (WHERE close IS NOT NULL) AS close
  FROM {KLINE} WHERE adjust_type = 'none' AND date IS NOT NULL GROUP BY 1, 2),
span AS (SELECT code, min(date) AS lo, max(date) AS hi FROM daily WHERE code IS NOT NULL GROUP BY 1),
dense AS (
  SELECT s.code, g.date, s.lo, d.amount, d.close
  FROM (SELECT code, lo, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS date FROM span) g
  JOIN span s USING (code) LEFT JOIN daily d ON d.code = g.code AND d.date = g.date)
"""
P7_SQL = f"""{_P7_DENSE}
SELECT code AS equity_code, strftime(date, '%Y%m%d') AS date FROM dense
QUALIFY sum(coalesce(amount, 0)) OVER (PARTITION BY code ORDER BY date ROWS 6 PRECEDING) = 0
  AND sum(coalesce(amount, 0)) OVER (PARTITION BY code ORDER BY date ROWS 29 PRECEDING) > 0
"""


def p7_totals(spark: SparkSession, d: str) -> DataFrame:
    """Total and average of amount (over calendar days) and average of close (over days with one), trailing 7 and 30 days."""
    kline = (
        table(spark, d, KLINE)
        .where("adjust_type = 'none' AND date IS NOT NULL")
        .select(equity_code(F.col("equity_code")).alias("equity_code"), "date", "amount", "close", "source_file", "source_entry", "source_hash")
    )
    daily = kline.groupBy("equity_code", "date").agg(
        F.max("amount").alias("amount"), F.max_by("close", F.when(F.col("close").isNotNull(), lineage())).alias("close")
    )
    totals = trailing_totals(daily, "equity_code", "date", ["amount", "close"], [7, 30])
    out = [F.col("equity_code"), yyyymmdd(F.col("date")).alias("date")]
    for span in (7, 30):
        out += [
            F.round(f"amount_sum_{span}d", 4).alias(f"amount_total_{span}d"),
            F.round(F.col(f"amount_sum_{span}d") / F.col(f"days_{span}d"), 4).alias(f"amount_avg_{span}d"),
            F.round(F.try_divide(F.col(f"close_sum_{span}d"), F.col(f"close_n_{span}d").cast("double")), 8).alias(f"close_avg_{span}d"),
        ]
    return totals.select(*out)


P7_TOTALS_SQL = f"""{_P7_DENSE}
SELECT code AS equity_code, strftime(date, '%Y%m%d') AS date,
""" + ",\n".join(
    f"""  round(sum(coalesce(amount, 0)) OVER w{s}, 4) AS amount_total_{s}d,
  round(sum(coalesce(amount, 0)) OVER w{s} / least({s}, date_diff('day', lo, date) + 1), 4) AS amount_avg_{s}d,
  round(avg(close) OVER w{s}, 8) AS close_avg_{s}d"""
    for s in (7, 30)
) + """
FROM dense WINDOW w7 AS (PARTITION BY code ORDER BY date ROWS 6 PRECEDING), w30 AS (PARTITION BY code ORDER BY date ROWS 29 PRECEDING)
"""


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    small = small_files(table(spark, d, "ods_gcs_load_manifest"), table(spark, d, "parquet_manifest"))
    # written with block and offset, as a selection of paths alone would have the plan pruned away
    planned = materialize(plan_blocks(materialize(small, "p5-small")), "p5-plan")
    return planned.select(F.col("path").alias("gcs_uri"))


P5_SQL = f"""
WITH newest AS (
  SELECT gcs_uri, arg_max(struct_pack(s := status, z := object_size), try_cast(object_generation AS HUGEINT)) AS r
  FROM ods_gcs_load_manifest WHERE gcs_uri IS NOT NULL GROUP BY 1),
listed AS (SELECT gcs_uri, max(size) AS size FROM parquet_manifest GROUP BY 1)
SELECT gcs_uri FROM newest LEFT JOIN listed USING (gcs_uri)
WHERE lower({sql_strip('r.s')}) IS DISTINCT FROM 'invalid' AND coalesce(r.z, size) < {SMALL_BYTES}
"""


def _archive(spark: SparkSession, d: str) -> DataFrame:
    return materialize(pack(materialize(record_files(table(spark, d, "file_raw_row")), "p5-files")), "p5-blocks")


def p5_index(spark: SparkSession, d: str) -> DataFrame:
    """The index of the archive that holds all record files: where each one's bytes are, and their checksum."""
    return index(_archive(spark, d))


P5_CHECKSUMS_SQL = f"""
WITH parts AS (
  SELECT gcs_uri AS path, CAST(floor(coalesce(row_no, 0) / {PART_ROWS}) AS BIGINT) AS part,
    string_agg('{{"row_no":' || row_no || ',"payload":' || to_json(payload) || '}}', chr(10) ORDER BY row_no) AS text FROM file_raw_row GROUP BY 1, 2)
SELECT path, part, CAST(strlen(text) AS BIGINT) AS length, sha256(text) AS sha256 FROM parts"""


def p5_checksums(spark: SparkSession, d: str) -> DataFrame:
    """Length and checksum of every entry of the archive, as its index has them."""
    return index(_archive(spark, d)).select("path", "part", "length", "sha256")


def p5_rows(spark: SparkSession, d: str) -> DataFrame:
    """All records, read back out of the archive blocks."""
    return records(unpack(_archive(spark, d)))


P5_ROWS_SQL = "SELECT gcs_uri, row_no, payload FROM file_raw_row"


def _scripts(spark: SparkSession, d: str) -> DataFrame:
    return edit_scripts(table(spark, d, "file_footer"), table(spark, d, "file_raw_row"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    changes = _scripts(spark, d).where("kind IN ('added', 'removed', 'renamed', 'retyped')")
    name = F.when(F.col("kind") == "removed", F.col("old")).otherwise(F.col("new"))
    return changes.select("gcs_uri", name.alias("column_name"), F.col("kind").alias("change_kind"))


def p6_unified(spark: SparkSession, d: str) -> DataFrame:
    """All records of all files as one table in one schema."""
    return unify(table(spark, d, "file_footer"), table(spark, d, "file_raw_row"), materialize(_scripts(spark, d), "p6-scripts"))


def queries() -> dict[str, Query]:
    return {"p3_found": p3_found, "p3_scores": p3_scores, "p5_found": p5_found, "p5_index": p5_index, "p5_checksums": p5_checksums, "p5_rows": p5_rows, "p6_found": p6_found, "p6_unified": p6_unified, "p4_found": p4_found, "p7_found": p7_found, "p7_totals": p7_totals}


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5_SQL, "p5_rows": P5_ROWS_SQL, "p5_checksums": P5_CHECKSUMS_SQL, "p4_found": P4_SQL, "p7_found": P7_SQL, "p7_totals": P7_TOTALS_SQL}
