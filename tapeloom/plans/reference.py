"""Queries of the layered warehouse: cleaning, features, statements as known, signals, labels, metrics; with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions import clean
from tapeloom.functions.codes import equity_code, index_code, sql_equity_code, sql_strip
from tapeloom.functions.windows import log_return, ratio
from tapeloom.operators import events as ev
from tapeloom.operators import features as ft
from tapeloom.operators import stats, temporal
from tapeloom.operators.bars import apply_factors, bars, latest_by_lineage, resample, resample_bars
from tapeloom.sources.store import in_range
from tapeloom.session import materialize, scratch_path, table
from tapeloom.streaming import bars as stream

Query = Callable[[SparkSession, str], DataFrame]
KLINE, FACTOR, INDICATOR, SIGNAL, SECURITY = (
    "dwd_fact_equity_kline_1d", "dwd_fact_adjust_factor", "dwd_fact_financial_indicator", "ads_signal_ml_stock_picker_bqml_1d", "dwd_dim_security",
)
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL it is held against."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def r(c, digits: int = 6):
    """Rounded, as sums of doubles differ in their last bits between engines."""
    return F.round(c, digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def qfq(spark: SparkSession, d: str) -> DataFrame:
    return bars(table(spark, d, KLINE), "qfq")


def unadjusted(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Unadjusted bars, written once: joins by version numbers read their events in more than one branch."""
    return materialize(bars(table(spark, d, KLINE), "none").select("code", "date", *columns), "bars")


LINEAGE = "source_file DESC NULLS LAST, source_entry DESC NULLS LAST, source_hash DESC NULLS LAST"


def sql_bars(kind: str, name: str = "bars") -> str:
    return f"""{name} AS (
  SELECT code, date, open, high, low, close, volume, amount FROM (
    SELECT *, row_number() OVER (PARTITION BY code, date ORDER BY {LINEAGE}) AS rn
    FROM (SELECT *, {sql_equity_code('equity_code')} AS code FROM {KLINE} WHERE adjust_type = '{kind}' AND date IS NOT NULL) WHERE code IS NOT NULL)
  WHERE rn = 1 AND close > 0)"""


# ---- cleaning ----------------------------------------------------------------------------------------------------------------------


@query(f"""
SELECT {sql_equity_code('equity_code')} AS code, date, adjust_type, arg_max(struct_pack(o := open, c := close, v := volume),
  (coalesce(source_file, ''), coalesce(source_entry, ''), coalesce(source_hash, ''))).o AS open,
  arg_max(struct_pack(o := open, c := close, v := volume), (coalesce(source_file, ''), coalesce(source_entry, ''), coalesce(source_hash, ''))).c AS close,
  arg_max(struct_pack(o := open, c := close, v := volume), (coalesce(source_file, ''), coalesce(source_entry, ''), coalesce(source_hash, ''))).v AS volume
FROM {KLINE} GROUP BY 1, 2, 3""")
def dedup_latest_lineage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, KLINE).withColumn("code", equity_code(F.col("equity_code")))
    return latest_by_lineage(rows, ["code", "date", "adjust_type"], ["open", "close", "volume"])


@query(f"""SELECT equity_code AS raw, {sql_equity_code('equity_code')} AS code, count(*) AS n FROM {KLINE} GROUP BY 1""")
def code_normalize_equity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, KLINE).groupBy(F.col("equity_code").alias("raw")).agg(F.count(F.lit(1)).alias("n")).select("raw", equity_code(F.col("raw")).alias("code"), "n")


_INDEX = f"upper(replace({sql_strip('raw')}, '_', '.'))"


@query(f"""
WITH given AS (SELECT DISTINCT unnest([substr(security_code, 1, 6), '399' || substr(security_code, 4, 6), 'sh' || substr(security_code, 1, 6), '000' || substr(security_code, 4, 6) , '39' || substr(security_code, 3, 4), ' 932' || substr(security_code, 4, 3) || '_SZ ', '']) AS raw FROM {SECURITY})
SELECT raw, CASE WHEN {_INDEX} = '' THEN NULL
  WHEN regexp_full_match({_INDEX}, '399[0-9]{{3}}(\\.(SH|SZ|BJ))?') THEN substr({_INDEX}, 1, 6) || '.SZ'
  WHEN regexp_full_match({_INDEX}, '(000|930|932|950)[0-9]{{3}}(\\.(SH|SZ|BJ))?') THEN substr({_INDEX}, 1, 6) || '.SH'
  WHEN regexp_full_match({_INDEX}, '39[0-9]{{4}}') THEN {_INDEX} || '.SZ'
  WHEN regexp_full_match({_INDEX}, '[0-9]{{6}}') THEN {_INDEX} || '.SH'
  WHEN regexp_full_match({_INDEX}, '(SH|SZ|BJ)[0-9]{{6}}') THEN substr({_INDEX}, 3) || '.' || substr({_INDEX}, 1, 2)
  ELSE {_INDEX} END AS code FROM given WHERE raw IS NOT NULL""")
def code_normalize_index(spark: SparkSession, d: str) -> DataFrame:
    c, sub = F.col("security_code"), F.substring
    made = F.array(sub(c, 1, 6), F.concat(F.lit("399"), sub(c, 4, 6)), F.concat(F.lit("sh"), sub(c, 1, 6)), F.concat(F.lit("000"), sub(c, 4, 6)), F.concat(F.lit("39"), sub(c, 3, 4)), F.concat(F.lit(" 932"), sub(c, 4, 3), F.lit("_SZ ")), F.lit(""))
    raw = table(spark, d, SECURITY).select(F.explode(made).alias("raw")).where("raw IS NOT NULL").distinct()
    return raw.select("raw", index_code(F.col("raw")).alias("code"))


@query("""
WITH forms AS (SELECT o_orderkey, unnest([strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y/%m/%d'), strftime(o_orderdate, '%Y%m%d'), ' ' || strftime(o_orderdate, '%Y%m%d') || ' ', '-', '']) AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN regexp_full_match(trim(raw), '[0-9]{8}') THEN strptime(trim(raw), '%Y%m%d')::DATE
  WHEN regexp_full_match(trim(raw), '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN strptime(trim(raw), '%Y-%m-%d')::DATE
  WHEN regexp_full_match(trim(raw), '[0-9]{4}/[0-9]{2}/[0-9]{2}') THEN strptime(trim(raw), '%Y/%m/%d')::DATE END AS parsed,
  CASE WHEN regexp_full_match(trim(raw), '[0-9].*') THEN CAST(regexp_replace(substr(trim(raw), 1, 7), '[-/]', '') [1:6] AS BIGINT) END AS month FROM forms""")
def date_parse_multi(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate")
    forms = F.array(F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy/MM/dd"), F.date_format(day, "yyyyMMdd"), F.concat(F.lit(" "), F.date_format(day, "yyyyMMdd"), F.lit(" ")), F.lit("-"), F.lit(""))
    raw = table(spark, d, "orders").select("o_orderkey", F.explode(forms).alias("raw"))
    return raw.select("o_orderkey", "raw", clean.date(F.col("raw")).alias("parsed")).withColumn("month", clean.month_number(F.col("parsed")))


@query(f"""SELECT {sql_equity_code('equity_code')} AS code, date, count(*) AS n, max(close) AS close FROM {KLINE}
WHERE date BETWEEN DATE '2025-10-20' AND DATE '2025-11-14' AND (partition_month IN (202510, 202511) OR partition_month IS NULL) GROUP BY 1, 2""")
def month_partition_filter(spark: SparkSession, d: str) -> DataFrame:
    """A date range with the predicate on its months beside it; both reach the scan, and a table laid out by month is pruned by it."""
    rows = in_range(table(spark, d, KLINE), "20251020", "20251114")
    return rows.groupBy(equity_code(F.col("equity_code")).alias("code"), "date").agg(F.count(F.lit(1)).alias("n"), F.max("close").alias("close"))


# ---- bars --------------------------------------------------------------------------------------------------------------------------


@query("""
SELECT p_brand AS code, CAST(l_shipdate AS DATE) AS date, round(arg_min(l_extendedprice / l_quantity, row(l_orderkey, l_linenumber, l_partkey, l_suppkey)), 9) AS open,
  round(max(l_extendedprice / l_quantity), 9) AS high, round(min(l_extendedprice / l_quantity), 9) AS low,
  round(arg_max(l_extendedprice / l_quantity, row(l_orderkey, l_linenumber, l_partkey, l_suppkey)), 9) AS close, sum(l_quantity) AS volume, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def bar_resample_daily(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    rows = lines.select(F.col("p_brand").alias("code"), F.col("l_shipdate").cast("date").alias("date"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), "l_quantity")
    return rounded(resample(rows, ["code", "date"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "price", "l_quantity"), 9)


@query("""
SELECT user_id, time_bucket(INTERVAL 5 MINUTES, ts) AS bar, arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, row(ts, event_id)) AS close,
  round(sum(value), 6) AS volume, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2""")
def bar_resample_minute(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").where("value IS NOT NULL").withColumn("bar", F.window("ts", "5 minutes").start)
    return resample(rows, ["user_id", "bar"], ["ts", "event_id"], "value", "value").withColumn("volume", r("volume"))


@query("""
SELECT user_id, time_bucket(INTERVAL 5 MINUTES, ts) AS start, arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, row(ts, event_id)) AS close,
  round(sum(value), 6) AS volume, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2
HAVING start + INTERVAL 5 MINUTES <= (SELECT max(ts) - INTERVAL 10 MINUTES FROM events WHERE value IS NOT NULL)""")
def stream_ohlcv(spark: SparkSession, d: str) -> DataFrame:
    """Five-minute bars by Structured Streaming over all files that are there; windows that the watermark has passed are given out."""
    folder = scratch_path(spark, "stream")
    source = stream.read_ticks(spark, f"{d}/events.parque[t]", table(spark, d, "events").schema, files_per_trigger=1_000_000)
    bars_ = stream.stream_bars(source.where("value IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", "value", "event_id")
    stream.write_available(bars_, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema(bars_.schema).parquet(f"{folder}/out").withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("volume", r("volume"))


@query(f"""WITH {sql_bars('qfq')}
SELECT code, CAST(date_trunc('week', date) AS DATE) AS period_start, arg_min(open, date) FILTER (WHERE open IS NOT NULL) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close,
  sum(volume) AS volume, sum(amount) AS amount, count(*) AS days FROM bars GROUP BY 1, 2""")
def bar_resample_weekly(spark: SparkSession, d: str) -> DataFrame:
    return resample_bars(qfq(spark, d), "week")


_FACTORS = f"""factors AS (
  SELECT code, date, factor FROM (SELECT {sql_equity_code('equity_code')} AS code, date, adjust_factor AS factor,
    row_number() OVER (PARTITION BY {sql_equity_code('equity_code')}, date ORDER BY {LINEAGE}) AS rn
    FROM {FACTOR} WHERE adjust_type = 'hfq' AND adjust_factor > 0 AND date IS NOT NULL) WHERE rn = 1 AND code IS NOT NULL)"""


def _adjusted_sql(mode: str) -> str:
    scaled = "f / arg_max(f, date) OVER (PARTITION BY code)" if mode == "qfq" else "f"
    prices = ", ".join(f"round({c} * coalesce(k, 1), 8) AS {c}" for c in ("open", "high", "low", "close"))
    return f"""WITH {sql_bars('none')}, {_FACTORS},
joined AS (SELECT b.*, coalesce(last_value(factor IGNORE NULLS) OVER (PARTITION BY b.code ORDER BY b.date ROWS UNBOUNDED PRECEDING),
    first_value(factor IGNORE NULLS) OVER (PARTITION BY b.code ORDER BY b.date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS f
  FROM bars b LEFT JOIN factors USING (code, date)),
scaled AS (SELECT *, {scaled} AS k FROM joined)
SELECT code, date, {prices}, volume, amount, round(k, 8) AS factor FROM scaled"""


def _adjusted(spark: SparkSession, d: str, mode: str) -> DataFrame:
    rows = table(spark, d, FACTOR).where("adjust_type = 'hfq' AND adjust_factor > 0 AND date IS NOT NULL").withColumn("code", equity_code(F.col("equity_code"))).where("code IS NOT NULL")
    factors = latest_by_lineage(rows, ["code", "date"], ["adjust_factor"]).withColumnRenamed("adjust_factor", "factor")
    return apply_factors(bars(table(spark, d, KLINE), "none"), factors, mode, 8)


@query(_adjusted_sql("qfq"))
def adjust_factor_apply_qfq(spark: SparkSession, d: str) -> DataFrame:
    return _adjusted(spark, d, "qfq")


@query(_adjusted_sql("hfq"))
def adjust_factor_apply_hfq(spark: SparkSession, d: str) -> DataFrame:
    return _adjusted(spark, d, "hfq")


# ---- features ----------------------------------------------------------------------------------------------------------------------

W_SQL = "PARTITION BY code ORDER BY date"


def frame(n: int) -> str:
    return f"OVER ({W_SQL} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


FEATURES_SQL = f"""{sql_bars('qfq')},
f1 AS (SELECT *, close - lag(close) OVER (w) AS delta, """ + ", ".join(
    f"CASE WHEN lag(close, {n}) OVER (w) > 0 THEN ln(close) - ln(lag(close, {n}) OVER (w)) END AS return_{n}d" for n in (1, 5, 10, 20)
) + f""" FROM bars WINDOW w AS ({W_SQL})),
f2 AS (SELECT *, """ + ", ".join(f"avg(close) {frame(n)} AS ma_{n}" for n in (5, 10, 12, 20, 26, 60)) + ", " + ", ".join(
    f"{c} / nullif(avg({c}) {frame(n)}, 0) AS {c}_ma{n}_ratio" for c in ("volume", "amount") for n in (5, 20)
) + f""", stddev_samp(close) {frame(5)} AS std_5d, stddev_samp(close) {frame(20)} AS std_20d, stddev_samp(return_1d) {frame(20)} AS volatility_20,
  avg(CASE WHEN delta IS NOT NULL THEN greatest(delta, 0) END) {frame(14)} AS gain, avg(CASE WHEN delta IS NOT NULL THEN greatest(-delta, 0) END) {frame(14)} AS loss,
  max(high) {frame(20)} AS hi, min(low) {frame(20)} AS lo FROM f1),
f3 AS (SELECT *, std_5d / nullif(std_20d, 0) AS std_ratio, 100 - 100 / (1 + gain / nullif(loss, 0)) AS rsi_14, ma_12 - ma_26 AS macd_diff,
  (close - lo) / nullif(hi - lo, 0) AS close_to_high_20d, close / nullif(ma_5, 0) - 1 AS close_to_ma5, close / nullif(ma_20, 0) - 1 AS close_to_ma20 FROM f2),
features AS (SELECT *, avg(macd_diff) {frame(9)} AS macd_signal, macd_diff - avg(macd_diff) {frame(9)} AS macd_hist FROM f3)"""
FEATURE_COLUMNS = [
    "return_1d", "return_5d", "return_10d", "return_20d", "ma_5", "ma_10", "ma_20", "ma_60", "volume_ma5_ratio", "volume_ma20_ratio", "amount_ma5_ratio", "amount_ma20_ratio",
    "std_5d", "std_20d", "std_ratio", "volatility_20", "rsi_14", "macd_diff", "macd_signal", "macd_hist", "close_to_high_20d", "close_to_ma5", "close_to_ma20",
]


def _digits(c: str) -> int:
    return 9 if c.startswith("ma_") else 6


@query(f"WITH {FEATURES_SQL} SELECT code, date, close, " + ", ".join(f"round({c}, {_digits(c)}) AS {c}" for c in FEATURE_COLUMNS) + " FROM features")
def daily_features_technical(spark: SparkSession, d: str) -> DataFrame:
    return ft.daily_features(qfq(spark, d)).select("code", "date", "close", *[F.round(c, _digits(c)).alias(c) for c in FEATURE_COLUMNS])


@query(f"""WITH {FEATURES_SQL},
g AS (SELECT *, sum(CASE WHEN rsi_14 > 70 THEN 0 ELSE 1 END) OVER ({W_SQL} ROWS UNBOUNDED PRECEDING) AS grp FROM features)
SELECT code, date, round((close - max(high) {frame(20)}) / nullif(max(high) {frame(20)}, 0), 6) AS drawdown_from_high_20d, round((close - max(high) {frame(60)}) / nullif(max(high) {frame(60)}, 0), 6) AS drawdown_from_high_60d,
  round(stddev_samp(close) {frame(5)} / nullif(stddev_samp(close) {frame(60)}, 0), 6) AS vol_expansion,
  CAST(sum(CASE WHEN rsi_14 > 70 THEN 1 ELSE 0 END) OVER (PARTITION BY code, grp ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS rsi_streak,
  round((close - ma_60) / nullif(ma_60, 0), 6) AS dist_to_ma60 FROM g""")
def sell_risk_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ft.sell_risk(ft.daily_features(qfq(spark, d))))


@query(f"""WITH RECURSIVE {sql_bars('qfq')},
numbered AS (SELECT code, date, close, row_number() OVER ({W_SQL}) AS n FROM bars),
ema AS (SELECT code, date, n, close AS a, close AS b, CAST(0 AS DOUBLE) AS s FROM numbered WHERE n = 1
  UNION ALL SELECT x.code, x.date, x.n, x.close * 2 / 13.0 + e.a * 11 / 13.0, x.close * 2 / 27.0 + e.b * 25 / 27.0,
    ((x.close * 2 / 13.0 + e.a * 11 / 13.0) - (x.close * 2 / 27.0 + e.b * 25 / 27.0)) * 0.2 + e.s * 0.8 FROM ema e JOIN numbered x ON x.code = e.code AND x.n = e.n + 1)
SELECT code, date, round(a - b, 6) AS macd_diff, round(s, 6) AS macd_signal, round(a - b - s, 6) AS macd_hist FROM ema""")
def ema_macd(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ft.ema_macd(qfq(spark, d)))


def _fund_bars(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars of part types, which stand for funds; price is what a line costs a piece."""
    lines = table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", F.col("l_shipdate").cast("date").alias("date"))
    priced = lines.join(table(spark, d, "part").select("p_partkey", F.col("p_type").alias("code")), F.col("l_partkey") == F.col("p_partkey")).withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))
    return resample(priced, ["code", "date"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "price", "l_quantity").select("code", "date", "close")


def _index_bars(spark: SparkSession, d: str) -> DataFrame:
    """One market-wide series of the mean order, which stands for an index."""
    return table(spark, d, "orders").groupBy(F.lit("market").alias("code"), F.col("o_orderdate").cast("date").alias("date")).agg(F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)), 7).alias("close"))


def _sql_returns(asset_type: str, bars_: str) -> str:
    lag = lambda n: f"CASE WHEN close > 0 AND lag(close, {n}) OVER w > 0 THEN ln(close) - ln(lag(close, {n}) OVER w) END AS return_{n}d"
    return f"""SELECT '{asset_type}' AS asset_type, code AS asset_code, date, year(date) * 100 + month(date) AS partition_month, close, return_1d, return_5d, return_20d,
    stddev_samp(return_1d) {frame(20)} AS volatility_20 FROM (SELECT code, date, close, {lag(1)}, {lag(5)}, {lag(20)} FROM {bars_} WINDOW w AS ({W_SQL}))"""


_ASSETS = f"""{sql_bars('qfq')},
funds AS (SELECT p_type AS code, CAST(l_shipdate AS DATE) AS date, arg_max(l_extendedprice / l_quantity, row(l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS close FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
indexes AS (SELECT 'market' AS code, CAST(o_orderdate AS DATE) AS date, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 7) AS close FROM orders GROUP BY 2),
assets AS ({_sql_returns('equity', 'bars')} UNION ALL {_sql_returns('fund', 'funds')} UNION ALL {_sql_returns('index', 'indexes')})"""


def _assets(spark: SparkSession, d: str) -> DataFrame:
    kinds = {"equity": qfq(spark, d).select("code", "date", "close"), "fund": _fund_bars(spark, d), "index": _index_bars(spark, d)}
    parts = [ft.asset_returns(df, kind) for kind, df in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""WITH {_ASSETS} SELECT asset_type, asset_code, date, partition_month, round(close, 7) AS close, round(return_1d, 6) AS return_1d, round(return_5d, 6) AS return_5d,
  round(return_20d, 6) AS return_20d, round(volatility_20, 6) AS volatility_20 FROM assets""")
def portfolio_asset_returns_union(spark: SparkSession, d: str) -> DataFrame:
    """Equities, funds and indexes in one table of returns."""
    return _assets(spark, d).withColumns({"close": r("close", 7)} | {c: r(c) for c in ("return_1d", "return_5d", "return_20d", "volatility_20")})


@query(f"""SELECT {sql_equity_code('security_code')} AS code, arg_max(security_name, (source_file, coalesce(source_entry, ''), source_hash)) FILTER (WHERE security_name IS NOT NULL) AS name,
  max(list_date) AS list_date, count(*) AS n FROM {SECURITY} WHERE list_date IS NULL OR list_date <= DATE '2025-11-28' GROUP BY 1""")
def security_list_as_of(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, SECURITY).where("list_date IS NULL OR list_date <= DATE '2025-11-28'").withColumn("code", equity_code(F.col("security_code")))
    named = F.when(F.col("security_name").isNotNull(), F.struct("source_file", F.coalesce("source_entry", F.lit("")).alias("e"), "source_hash"))
    return rows.groupBy("code").agg(F.max_by("security_name", named).alias("name"), F.max("list_date").alias("list_date"), F.count(F.lit(1)).alias("n"))


@query(f"""SELECT code, date, rank, prob FROM (SELECT {sql_equity_code('equity_code')} AS code, date, min(score_rank) AS rank, max(prob_up) AS prob FROM {SIGNAL} GROUP BY 1, 2)
WHERE date = (SELECT max(date) FROM {SIGNAL})""")
def component_latest(spark: SparkSession, d: str) -> DataFrame:
    """Members at the latest date: an uncorrelated scalar subquery, which Spark also uses to prune the scan."""
    signal = table(spark, d, SIGNAL)
    signal.createOrReplaceTempView("tapeloom_signal")
    latest = spark.sql("SELECT * FROM tapeloom_signal WHERE date = (SELECT max(date) FROM tapeloom_signal)")
    return latest.groupBy(equity_code(F.col("equity_code")).alias("code"), "date").agg(F.min("score_rank").alias("rank"), F.max("prob_up").alias("prob"))


# ---- statements as known -----------------------------------------------------------------------------------------------------------

STATEMENT = ["eps_basic", "bps", "roe"]
INTERVALS_SQL = f"""statements AS (
  SELECT code, ann, period, eps_basic, bps, roe, lead(ann) OVER (PARTITION BY code ORDER BY ann) AS until FROM (
    SELECT {sql_equity_code('equity_code')} AS code, announcement_date AS ann, report_period AS period, eps_basic, bps, roe,
      row_number() OVER (PARTITION BY {sql_equity_code('equity_code')}, announcement_date ORDER BY report_period DESC NULLS LAST, eps_basic DESC NULLS LAST, bps DESC NULLS LAST, roe DESC NULLS LAST) AS rn
    FROM {INDICATOR} WHERE announcement_date IS NOT NULL) WHERE rn = 1 AND code IS NOT NULL)"""


def statements(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, INDICATOR).withColumn("code", equity_code(F.col("equity_code"))).withColumnsRenamed({"announcement_date": "ann", "report_period": "period"})
    return temporal.intervals(rows, "code", "ann", "period", STATEMENT)


@query(f"""WITH {sql_bars('none')}, {INTERVALS_SQL}
SELECT b.code, b.date, s.ann, s.period, round(b.close / nullif(s.eps_basic, 0), 6) AS pe, round(b.close / nullif(s.bps, 0), 6) AS pb
FROM bars b JOIN statements s ON b.code = s.code AND b.date >= s.ann AND (s.until IS NULL OR b.date < s.until)""")
def asof_valuation_inner(spark: SparkSession, d: str) -> DataFrame:
    joined = temporal.interval_join(unadjusted(spark, d, "close"), statements(spark, d), "code", "date", "ann")
    return joined.select("code", "date", "ann", "period", r(ratio(F.col("close"), F.col("eps_basic"))).alias("pe"), r(ratio(F.col("close"), F.col("bps"))).alias("pb"))


@query(f"""WITH {sql_bars('none')}, {INTERVALS_SQL}
SELECT b.code, b.date, s.ann, round(s.roe, 6) AS roe FROM bars b LEFT JOIN statements s ON b.code = s.code AND b.date > s.ann AND (s.until IS NULL OR b.date < s.until)""")
def asof_fundamental_left_strict(spark: SparkSession, d: str) -> DataFrame:
    joined = temporal.interval_join(unadjusted(spark, d), statements(spark, d), "code", "date", "ann", "left", same_day=False)
    return joined.select("code", "date", "ann", r("roe").alias("roe"))


@query(f"""WITH {sql_bars('none')}, s AS (SELECT {sql_equity_code('equity_code')} AS code, announcement_date AS ann, max(roe) AS roe FROM {INDICATOR} WHERE announcement_date IS NOT NULL GROUP BY 1, 2)
SELECT b.code, b.date, s.ann, round(s.roe, 6) AS roe FROM bars b ASOF LEFT JOIN s ON b.code = s.code AND b.date > s.ann""")
def asof_last_before(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, INDICATOR).select(equity_code(F.col("equity_code")).alias("code"), F.col("announcement_date").alias("ann"), "roe")
    return temporal.last_before(unadjusted(spark, d), known, "code", "date", "ann", "roe").withColumn("roe", r("roe"))


@query(f"""WITH cal AS (SELECT DISTINCT date FROM {KLINE} WHERE date IS NOT NULL), facts AS (SELECT DISTINCT {sql_equity_code('equity_code')} AS code, announcement_date AS date FROM {INDICATOR} WHERE announcement_date IS NOT NULL)
SELECT code, date, (SELECT min(c.date) FROM cal c WHERE c.date > facts.date) AS available_date FROM facts""")
def next_available_event_date(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, INDICATOR).where("announcement_date IS NOT NULL").select(equity_code(F.col("equity_code")).alias("code"), F.col("announcement_date").alias("date")).distinct()
    return temporal.next_date(facts, table(spark, d, KLINE).where("date IS NOT NULL").select("date").distinct())


_EVENT_FACTS = """
e AS (SELECT 'u' || user_id AS equity_code, CAST(ts AS DATE) AS date, event_type, value, props, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
money AS (SELECT equity_code, date, sum(CASE WHEN event_type = 'purchase' THEN value ELSE -value END) AS net, sum(value) FILTER (WHERE event_type = 'purchase') AS main, sum(value) FILTER (WHERE value >= 100) AS large
  FROM e WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2),
seats AS (SELECT equity_code, date, sum(value) FILTER (WHERE event_type = 'view') AS buy, sum(value) FILTER (WHERE event_type = 'click') AS sell, sum(CASE WHEN event_type = 'view' THEN value ELSE -value END) AS net, count(*) AS n, count(DISTINCT props) AS departments
  FROM e WHERE event_type IN ('click', 'view') GROUP BY 1, 2),
boards AS (SELECT equity_code, date, max(k) AS streak, sum(value) AS main_net, min(props) AS reason FROM e WHERE event_type = 'error' GROUP BY 1, 2),
spine AS (SELECT equity_code, date FROM money UNION SELECT equity_code, date FROM seats UNION SELECT equity_code, date FROM boards),
flows AS (SELECT equity_code, date, year(date) * 100 + month(date) AS partition_month, money.net AS net_inflow_amount, main AS main_net_inflow_amount, large AS extra_large_net_inflow_amount, buy AS dragon_tiger_buy_amount,
  sell AS dragon_tiger_sell_amount, seats.net AS dragon_tiger_net_amount, n AS dragon_tiger_row_count, departments AS dragon_tiger_department_count, boards.date IS NOT NULL AS is_kpl_event, streak AS limit_up_streak, main_net AS kpl_main_net_amount, reason AS limit_up_reason
  FROM spine LEFT JOIN money USING (equity_code, date) LEFT JOIN seats USING (equity_code, date) LEFT JOIN boards USING (equity_code, date))"""


def event_facts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The events as money flow (purchases and signups), seats (views buy, clicks sell) and boards (errors); codes are users."""
    e = table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id")).alias("equity_code"), F.col("ts").cast("date").alias("date"), "event_type", "value", "props", F.get_json_object("props", "$.k").try_cast("double").alias("k"))
    of = lambda *kinds: e.where(F.col("event_type").isin(*kinds))
    only = lambda c: F.when(c, F.col("value"))
    kind, value = F.col("event_type"), F.col("value")
    money = of("purchase", "signup").select("equity_code", "date", F.when(kind == "purchase", value).otherwise(-value).alias("net_inflow_amount"), only(kind == "purchase").alias("main_net_inflow_amount"), only(value >= 100).alias("extra_large_net_inflow_amount"))
    seats = of("click", "view").select("equity_code", "date", only(kind == "view").alias("buy_amount"), only(kind == "click").alias("sell_amount"), F.when(kind == "view", value).otherwise(-value).alias("net_amount"), F.col("props").alias("department_name"))
    boards = of("error").select("equity_code", "date", F.col("k").alias("limit_up_streak"), value.alias("main_net_amount"), F.col("props").alias("limit_up_reason"), F.lit(None).cast("string").alias("tags"), F.lit(None).cast("string").alias("board_names"))
    return money, seats, boards


_FLOW_AMOUNTS = ["net_inflow_amount", "main_net_inflow_amount", "extra_large_net_inflow_amount", "dragon_tiger_buy_amount", "dragon_tiger_sell_amount", "dragon_tiger_net_amount", "kpl_main_net_amount"]
_FLOW_OTHERS = ["equity_code", "date", "partition_month", "dragon_tiger_row_count", "dragon_tiger_department_count", "is_kpl_event", "limit_up_streak", "limit_up_reason"]


@query(f"WITH {_EVENT_FACTS} SELECT " + ", ".join([*_FLOW_OTHERS, *[f"round({c}, 6) AS {c}" for c in _FLOW_AMOUNTS]]) + " FROM flows")
def event_flow_features(spark: SparkSession, d: str) -> DataFrame:
    """Three facts, each reduced to the key first, joined full; the key spine is the union of their keys."""
    return ev.event_features(*event_facts(spark, d)).select(*_FLOW_OTHERS, *[r(c).alias(c) for c in _FLOW_AMOUNTS])


@query(f"""WITH {_EVENT_FACTS},
scored AS (SELECT equity_code, date, round(coalesce(net_inflow_amount, 0) + 0.5 * coalesce(main_net_inflow_amount, 0) + 0.5 * coalesce(extra_large_net_inflow_amount, 0) + coalesce(dragon_tiger_net_amount, 0) / 10000.0
  + 1000.0 * coalesce(limit_up_streak, 0) + CASE WHEN is_kpl_event THEN 500.0 ELSE 0.0 END, 6) AS score_proxy FROM flows)
SELECT *, CAST(100 AS BIGINT) AS top_n, score_rank <= 100 AS is_selected, CAST(CASE WHEN score_rank <= 100 THEN 1 ELSE 0 END AS INTEGER) AS signal
FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY score_proxy DESC, equity_code) AS score_rank FROM scored)""")
def signal_event_flow(spark: SparkSession, d: str) -> DataFrame:
    return ev.event_signal(ev.event_features(*event_facts(spark, d))).select("equity_code", "date", "score_proxy", "score_rank", "top_n", "is_selected", "signal")


# ---- pairs, universe ---------------------------------------------------------------------------------------------------------------

#: Codes that stand for the configured universe of pairs, and the dates in common that a pair needs: the tests' calendar is shorter than 120.
UNIVERSE_CODES, PAIR_DATES = 40, 30

_UNIVERSE = f"""{sql_bars('qfq')},
universe AS (SELECT code FROM bars GROUP BY code HAVING count(*) >= 5 ORDER BY avg(coalesce(amount, 0)) DESC, code LIMIT {UNIVERSE_CODES}),
u AS (SELECT code, date, close, CASE WHEN lag(close) OVER w > 0 THEN ln(close) - ln(lag(close) OVER w) END AS r FROM bars JOIN universe USING (code) WINDOW w AS (PARTITION BY code ORDER BY date))"""


@query(f"""WITH {sql_bars('qfq')} SELECT code, round(avg(coalesce(amount, 0)), 2) AS avg_amount, count(*) AS days FROM bars GROUP BY code HAVING count(*) >= 5 ORDER BY avg(coalesce(amount, 0)) DESC, code LIMIT 500""")
def liquidity_top_n(spark: SparkSession, d: str) -> DataFrame:
    return stats.liquid_codes(qfq(spark, d), 500).withColumn("avg_amount", F.round("avg_amount", 2))


_AS_OF = "DATE '2025-11-28'"


@query(f"""WITH {sql_bars('none')}, listed AS (SELECT DISTINCT {sql_equity_code('security_code')} AS code FROM {SECURITY}
  WHERE (list_date IS NULL OR list_date <= {_AS_OF}) AND (delist_date IS NULL OR delist_date > {_AS_OF}) AND security_type = (SELECT min(security_type) FROM {SECURITY}))
SELECT code, round(avg(coalesce(amount, 0)), 2) AS avg_amount, count(*) AS days FROM bars SEMI JOIN listed USING (code) WHERE date < {_AS_OF} AND date >= {_AS_OF} - 120
GROUP BY code HAVING count(*) >= 5 ORDER BY avg(coalesce(amount, 0)) DESC, code LIMIT 500""")
def universe_at_date(spark: SparkSession, d: str) -> DataFrame:
    """The most liquid codes strictly before an as-of date, over twice the look-back of 60 days, of those listed then."""
    day, dim = F.lit("2025-11-28").cast("date"), table(spark, d, SECURITY)
    kind = dim.agg(F.min("security_type")).scalar()
    listed = dim.where((F.col("list_date").isNull() | (F.col("list_date") <= day)) & (F.col("delist_date").isNull() | (F.col("delist_date") > day)) & (F.col("security_type") == kind))
    daily = bars(table(spark, d, KLINE), "none").where((F.col("date") < day) & (F.col("date") >= F.date_sub(day, 120)))
    inside = daily.join(listed.select(equity_code(F.col("security_code")).alias("code")), "code", "left_semi")
    return stats.liquid_codes(inside, 500).withColumn("avg_amount", F.round("avg_amount", 2))


def _universe(spark: SparkSession, d: str) -> DataFrame:
    daily = materialize(qfq(spark, d), "bars")
    inside = daily.join(F.broadcast(stats.liquid_codes(daily, UNIVERSE_CODES).select("code")), "code", "left_semi")  # UNIVERSE_CODES rows
    return inside.withColumn("return_1d", log_return(F.col("close"), Window.partitionBy("code").orderBy("date"), 1))


@query(f"""WITH {_UNIVERSE}, b AS (SELECT * FROM u WHERE r IS NOT NULL AND date >= (SELECT max(date) FROM u) - 756)
SELECT x.code AS code_x, y.code AS code_y, count(*) AS observation_count, round(CASE WHEN isfinite(corr(x.r, y.r)) THEN corr(x.r, y.r) END, 6) AS return_corr, round(covar_samp(x.r, y.r) / nullif(var_samp(y.r), 0), 6) AS beta_xy,
  round(avg(ln(x.close) - ln(y.close)), 6) AS avg_log_spread, round(stddev_samp(ln(x.close) - ln(y.close)), 6) AS std_log_spread, max(x.date) AS latest_date
FROM b x JOIN b y ON x.date = y.date AND x.code < y.code GROUP BY 1, 2 HAVING count(*) >= {PAIR_DATES}""")
def pair_candidate_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.pair_stats(_universe(spark, d), least=PAIR_DATES))


@query()
def pair_kernels(spark: SparkSession, d: str) -> DataFrame:
    """Cointegration statistic, half-life and recursive hedge ratio of each two of the most liquid codes."""
    u = _universe(spark, d).select("date", "code", "close")
    x, y = u.select("date", F.col("code").alias("code_x"), F.col("close").alias("x")), u.select("date", F.col("code").alias("code_y"), F.col("close").alias("y"))
    return stats.pair_kernels(x.join(y, (x["date"] == y["date"]) & (F.col("code_x") < F.col("code_y"))).select("code_x", "code_y", x["date"], "x", "y"))


@query()
def risk_parity_weights(spark: SparkSession, d: str) -> DataFrame:
    """Risk parity, least variance and most diversified weights of the most liquid codes; the covariance matrix is 40 x 40."""
    import numpy as np

    returns = _universe(spark, d).select("code", "date", F.col("return_1d").alias("r"))
    cov = stats.covariance(returns).toPandas().pivot(index="code_x", columns="code_y", values="cov")
    codes, m = list(cov.index), np.nan_to_num(cov.to_numpy(float))
    weights = [f(m, 0.0, 0.2) for f in (stats.risk_parity, stats.min_variance, stats.max_diversification)]
    return spark.createDataFrame([(c, *(float(w[i]) for w in weights)) for i, c in enumerate(codes)], "code STRING, risk_parity DOUBLE, min_variance DOUBLE, max_diversification DOUBLE")


# ---- signals -----------------------------------------------------------------------------------------------------------------------


def _features(spark: SparkSession, d: str) -> DataFrame:
    return ft.daily_features(qfq(spark, d))


@query(f"WITH {FEATURES_SQL} SELECT code, date, CASE WHEN ma_5 > ma_20 THEN 'long' ELSE 'flat' END AS signal, CASE WHEN ma_5 > ma_20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM features")
def signal_double_ma(spark: SparkSession, d: str) -> DataFrame:
    up = F.col("ma_5") > F.col("ma_20")
    return _features(spark, d).select("code", "date", F.when(up, "long").otherwise("flat").alias("signal"), F.when(up, 1.0).otherwise(0.0).alias("weight"))


_PROXY = "0.35 * return_20d + 0.20 * coalesce(return_5d, 0) + 0.15 * (volume_ma20_ratio - 1) - 0.20 * std_ratio + 0.10 * coalesce(close_to_ma20, 0)"


@query(f"""WITH {FEATURES_SQL}, scored AS (SELECT code, date, round({_PROXY}, 6) AS score FROM features WHERE return_20d IS NOT NULL AND volume_ma20_ratio IS NOT NULL AND std_ratio IS NOT NULL)
SELECT code, date, score, row_number() OVER (PARTITION BY date ORDER BY score DESC, code) AS score_rank FROM scored QUALIFY score_rank <= 50""")
def signal_stock_picker_rank(spark: SparkSession, d: str) -> DataFrame:
    ok = _features(spark, d).where("return_20d IS NOT NULL AND volume_ma20_ratio IS NOT NULL AND std_ratio IS NOT NULL")
    scored = ok.select("code", "date", F.round(F.expr(_PROXY), 6).alias("score"))
    return scored.withColumn("score_rank", F.row_number().over(Window.partitionBy("date").orderBy(F.desc("score"), "code")).cast("bigint")).where("score_rank <= 50")


_VOL_SQL = f"""{FEATURES_SQL}, v AS (SELECT code, date, round(volatility_20, 9) AS vol, round(return_20d, 9) AS r20 FROM features WHERE return_20d IS NOT NULL AND volatility_20 IS NOT NULL),
va AS (SELECT *, round(avg(vol) {frame(252)}, 9) AS mean FROM v)"""


def _vol(spark: SparkSession, d: str) -> DataFrame:
    v = _features(spark, d).where("return_20d IS NOT NULL AND volatility_20 IS NOT NULL").select("code", "date", r("volatility_20", 9).alias("vol"), r("return_20d", 9).alias("r20"))
    return v.withColumn("mean", r(F.avg("vol").over(Window.partitionBy("code").orderBy("date").rowsBetween(-251, 0)), 9))


@query(f"WITH {_VOL_SQL} SELECT code, date, CASE WHEN vol > 1.25 * mean THEN 'high_volatility' WHEN r20 > 0 THEN 'risk_on' ELSE 'risk_off' END AS state, CASE WHEN vol > 1.25 * mean THEN 0.5::DOUBLE WHEN r20 > 0 THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END AS weight FROM va")
def signal_vol_timing(spark: SparkSession, d: str) -> DataFrame:
    high, on = F.col("vol") > 1.25 * F.col("mean"), F.col("r20") > 0
    return _vol(spark, d).select("code", "date", F.when(high, "high_volatility").when(on, "risk_on").otherwise("risk_off").alias("state"), F.when(high, 0.5).when(on, 1.0).otherwise(0.3).alias("weight"))


@query(f"WITH {_VOL_SQL} SELECT code, date, CASE WHEN r20 > 0 AND vol <= mean THEN 'bull' WHEN r20 < 0 AND vol > mean THEN 'bear' ELSE 'sideways' END AS regime FROM va")
def signal_regime(spark: SparkSession, d: str) -> DataFrame:
    up, down = (F.col("r20") > 0) & (F.col("vol") <= F.col("mean")), (F.col("r20") < 0) & (F.col("vol") > F.col("mean"))
    return _vol(spark, d).select("code", "date", F.when(up, "bull").when(down, "bear").otherwise("sideways").alias("regime"))


@query(f"""WITH {_ASSETS} SELECT date, partition_month, asset_type, count(DISTINCT asset_code) AS asset_count, round(avg(return_1d), 6) AS avg_return_1d, round(avg(return_20d), 6) AS avg_return_20d,
  round(avg(volatility_20), 6) AS avg_volatility_20, count(*) FILTER (WHERE round(volatility_20, 9) > 0.05) AS high_vol_asset_count FROM assets WHERE return_1d IS NOT NULL GROUP BY 1, 2, 3""")
def risk_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Mean returns and volatility of each kind of asset by date."""
    ok = _assets(spark, d).where("return_1d IS NOT NULL")
    return ok.groupBy("date", "partition_month", "asset_type").agg(
        F.count_distinct("asset_code").alias("asset_count"), *[r(F.avg(c)).alias(f"avg_{c}") for c in ("return_1d", "return_20d", "volatility_20")],
        F.count_if(F.round("volatility_20", 9) > 0.05).alias("high_vol_asset_count"),
    )


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
