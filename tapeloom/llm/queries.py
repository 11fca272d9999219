"""The queries of this package and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.codes import equity_code, sql_equity_code, sql_strip, yyyymmdd
from tapeloom.llm.encode import encode
from tapeloom.llm.mix import mix
from tapeloom.llm.split import source_key, split_texts
from tapeloom.llm.survivors import Quality, first_in_order, judge_values, survivors
from tapeloom.llm.topn import top_n
from tapeloom.operators.bars import daily_amount, lineage
from tapeloom.session import materialize, small, table

Query = Callable[[SparkSession, str], DataFrame]

#: Places asked for: codes a date by amount, dates a code and week by amount, codes a date by score_rank.
TOP_AMOUNT, TOP_WEEK, TOP_SIGNAL = 10, 2, 5


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    daily = materialize(daily_amount(table(spark, d, "dwd_fact_equity_kline_1d")).where(F.col("amount").isNotNull()), "p1-daily")
    signal = materialize(
        table(spark, d, "ads_signal_ml_stock_picker_bqml_1d")
        .select(equity_code(F.col("equity_code")).alias("equity_code"), "date", "score_rank")
        .where(F.col("equity_code").isNotNull() & F.col("date").isNotNull() & F.col("score_rank").isNotNull())
        .groupBy("equity_code", "date")
        .agg(F.min("score_rank").alias("score_rank")),
        "p1-signal",
    )
    code, amount = F.col("equity_code").asc(), F.col("amount").desc()
    weekly = daily.withColumn("week", F.date_trunc("week", "date").cast("date"))
    ranked = {
        "amount": top_n(daily, ["date"], [amount, code], TOP_AMOUNT),
        "week": top_n(weekly, ["equity_code", "week"], [amount, F.col("date").asc()], TOP_WEEK),
        "signal": top_n(signal, ["date"], [F.col("score_rank").asc(), code], TOP_SIGNAL),
    }
    parts = [df.select(F.lit(name).alias("ranking"), yyyymmdd(F.col("date")).alias("date"), "place", "equity_code") for name, df in ranked.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


P1_SQL = f"""
WITH daily AS (
  SELECT {sql_equity_code('equity_code')} AS code, date, max(amount) AS amount
  FROM dwd_fact_equity_kline_1d WHERE adjust_type = 'none' AND amount IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2),
signal AS (
  SELECT {sql_equity_code('equity_code')} AS code, date, min(score_rank) AS score_rank
  FROM ads_signal_ml_stock_picker_bqml_1d WHERE score_rank IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2)
SELECT 'amount' AS ranking, strftime(date, '%Y%m%d') AS date, row_number() OVER (PARTITION BY date ORDER BY amount DESC, code) AS place, code AS equity_code
FROM daily WHERE code IS NOT NULL QUALIFY place <= {TOP_AMOUNT}
UNION ALL
SELECT 'week', strftime(date, '%Y%m%d'), row_number() OVER (PARTITION BY code, date_trunc('week', date) ORDER BY amount DESC, date) AS place, code
FROM daily WHERE code IS NOT NULL QUALIFY place <= {TOP_WEEK}
UNION ALL
SELECT 'signal', strftime(date, '%Y%m%d'), row_number() OVER (PARTITION BY date ORDER BY score_rank, code) AS place, code
FROM signal WHERE code IS NOT NULL QUALIFY place <= {TOP_SIGNAL}
"""


KEY = ["equity_code", "date", "adjust_type"]
MEASURES = ["open", "high", "low", "close", "volume", "amount"]


ORDER = ["source_file", "source_entry", "source_hash"]


def _kline(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dwd_fact_equity_kline_1d").withColumn("equity_code", equity_code(F.col("equity_code")))


def _judged(spark: SparkSession, d: str) -> tuple[DataFrame, Quality]:
    channel = F.split_part(F.col("source_file"), F.lit("/"), F.lit(1))
    return judge_values(_kline(spark, d), KEY, MEASURES, channel, "source_file", ORDER)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The surviving row of each measure of a repeated key. These cases are defined by lineage order, so no model takes part."""
    first = first_in_order(_kline(spark, d), KEY, MEASURES, ORDER)
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("field_name"), F.col(m).alias("first")) for m in MEASURES]))
    return first.select(*KEY, each.alias("e")).where("e.first IS NOT NULL").select("equity_code", yyyymmdd(F.col("date")).alias("date"), "adjust_type", "e.field_name", "e.first.best.source_hash")


P2_ROWS = f"""
WITH rows AS (
  SELECT {sql_equity_code('equity_code')} AS equity_code, date, adjust_type, source_file, source_entry, source_hash,
    open, high, low, close, volume, amount FROM dwd_fact_equity_kline_1d),
repeated AS (SELECT *, count(*) OVER (PARTITION BY equity_code, date, adjust_type) AS n FROM rows)"""
P2_SQL = f"""{P2_ROWS},
long AS (UNPIVOT (SELECT * FROM repeated WHERE n > 1) ON open, high, low, close, volume, amount INTO NAME field_name VALUE v)
SELECT equity_code, strftime(date, '%Y%m%d') AS date, adjust_type, field_name, source_hash FROM long
QUALIFY row_number() OVER (PARTITION BY equity_code, date, adjust_type, field_name
  ORDER BY source_file DESC NULLS LAST, source_entry DESC NULLS LAST, source_hash DESC NULLS LAST) = 1
"""


def p2_survivors(spark: SparkSession, d: str) -> DataFrame:
    """One row for each repeated key with a measure, each measure from the first delivery in lineage order that has it."""
    first = first_in_order(_kline(spark, d), KEY, MEASURES, ORDER).where(F.coalesce(*MEASURES).isNotNull())
    return first.select("equity_code", yyyymmdd(F.col("date")).alias("date"), "adjust_type", *[F.col(m).getField("value").alias(m) for m in MEASURES])


P2_SURVIVORS_SQL = f"""{P2_ROWS}
SELECT equity_code, strftime(date, '%Y%m%d') AS date, adjust_type, """ + ", ".join(
    f"first({m} ORDER BY source_file DESC NULLS LAST, source_entry DESC NULLS LAST, source_hash DESC NULLS LAST) FILTER (WHERE {m} IS NOT NULL) AS {m}" for m in MEASURES
) + """
FROM repeated WHERE n > 1 GROUP BY ALL
HAVING coalesce(max(open), max(high), max(low), max(close), max(volume), max(amount)) IS NOT NULL
"""


def p2_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row for every key, those of one delivery and of nulls alone too, each measure from the delivery first in lineage order that has it."""
    best = [F.max(F.when(F.col(m).isNotNull(), lineage(m))).getField(m).alias(m) for m in MEASURES]
    return _kline(spark, d).groupBy(*KEY).agg(*best).withColumn("date", yyyymmdd(F.col("date")))


P2_ROWS_SQL = P2_SURVIVORS_SQL.replace("WHERE n > 1 ", "").partition("HAVING")[0]


def p2_truth(spark: SparkSession, d: str) -> DataFrame:
    """Every value of a repeated key's measures that the model of source quality judges true."""
    values = _judged(spark, d)[0].where("posterior >= 0.5")
    return values.select(*KEY, "field", "value", F.round("posterior", 6).alias("posterior"), "deliveries").withColumn("date", yyyymmdd(F.col("date")))


def p2_trusted(spark: SparkSession, d: str) -> DataFrame:
    """One row for each repeated key as the model alone has it: each measure the first in lineage order of the values that it judges true."""
    chosen = survivors(_judged(spark, d)[0], KEY)
    one = chosen.groupBy(*KEY).agg(*[F.max(F.when(F.col("field") == m, F.col("value"))).alias(m) for m in MEASURES], F.round(F.min("posterior"), 6).alias("least_posterior"))
    return one.withColumn("date", yyyymmdd(F.col("date")))


def p2_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sensitivity and specificity of each source of kline rows."""
    return _judged(spark, d)[1].sources.select("source", F.round("sensitivity", 6).alias("sensitivity"), F.round("specificity", 6).alias("specificity"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode(table(spark, d, "documents").select("doc_id", "text"), "text")


def _mixed(spark: SparkSession, d: str):
    return mix(table(spark, d, "documents"), table(spark, d, "mix_target"), "doc_id", "text", "source")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its tokens, rate and copies drawn."""
    return _mixed(spark, d).documents.withColumnRenamed("id", "doc_id")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares of all drawn tokens that the sources reach."""
    return _mixed(spark, d).shares


#: How far the share of a target may be off for the target to count as reached, where that is more than one document.
REACHED = 0.01


def p9_reached(spark: SparkSession, d: str) -> DataFrame:
    """Whether each target holds its weight of the target total, to REACHED or one document, and none is drawn more often than allowed."""
    shares = _mixed(spark, d).shares.where("target_weight IS NOT NULL")
    off = F.abs(F.col("share_of_target_total") - F.col("target_weight"))
    one = F.col("largest") * F.try_divide(F.col("share_of_target_total"), F.col("drawn"))
    reached = off <= F.greatest(F.lit(REACHED), F.coalesce(one, F.lit(0.0)))
    return shares.select("source", "target_weight", reached.alias("reached"), (F.col("most_copies") <= F.col("max_repeats")).alias("within_cap"))


def _sql_source_key(column: str) -> str:
    return f"replace(lower({sql_strip(column)}), '-', '_')"


P9_REACHED_SQL = f"""
SELECT {_sql_source_key('t.source')} AS source, target_weight, TRUE AS within_cap,
  EXISTS (SELECT 1 FROM documents d WHERE d.n_chars > 0 AND {_sql_source_key('d.source')} = {_sql_source_key('t.source')}) AS reached
FROM mix_target t"""


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    limits = table(spark, d, "split_limit").select(source_key(F.col("source")).alias("source"), "max_tokens", "overlap_tokens")
    docs = table(spark, d, "documents").select("doc_id", source_key(F.col("source")).alias("source"), "text")
    return split_texts(docs.join(small(limits), "source", "left"), "text", "max_tokens", "overlap_tokens")


def queries() -> dict[str, Query]:
    return {"p1_found": p1_found, "p2_found": p2_found, "p2_survivors": p2_survivors, "p2_rows": p2_rows, "p2_truth": p2_truth, "p2_trusted": p2_trusted, "p2_sources": p2_sources, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_reached": p9_reached, "p10_pieces": p10_pieces}


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_SQL, "p2_found": P2_SQL, "p2_survivors": P2_SURVIVORS_SQL, "p2_rows": P2_ROWS_SQL, "p9_reached": P9_REACHED_SQL}
