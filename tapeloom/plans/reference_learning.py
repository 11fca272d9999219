"""Queries for learning and evaluation: labels, scores, regimes, performance, trades, costs, audits; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


from tapeloom.functions.codes import equity_code, sql_equity_code
from tapeloom.functions.windows import log_return, ratio
from tapeloom.operators import features as ft
from tapeloom.operators import labels, metrics, scores, stats, training, upsert
from tapeloom.operators.temporal import business_days, interval_join, intervals, month_ends
from tapeloom.operators.volatility import garch_scale, hidden_regimes, regime_observations
from tapeloom.plans.reference import FEATURES_SQL, INDICATOR, INTERVALS_SQL, KLINE, SIGNAL, W_SQL, frame, qfq, r, rounded, sql_bars, statements, unadjusted
from tapeloom.session import materialize, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


# ---- labels ------------------------------------------------------------------------------------------------------------------------

_FORWARD = f"""{sql_bars('qfq')},
fwd AS (SELECT code, date, open, low, close, """ + ", ".join(
    f"CASE WHEN lead(close, {h}) OVER w > 0 THEN ln(lead(close, {h}) OVER w) - ln(close) END AS forward_{h}d, "
    f"CASE WHEN lead(open, 1) OVER w > 0 AND lead(open, {h + 1}) OVER w > 0 THEN ln(lead(open, {h + 1}) OVER w) - ln(lead(open, 1) OVER w) END AS exec_{h}d"
    for h in (1, 5)
) + f" FROM bars WINDOW w AS ({W_SQL}))"


@query(f"WITH {_FORWARD} SELECT code, date, round(forward_1d, 6) AS forward_1d, round(forward_5d, 6) AS forward_5d, round(exec_1d, 6) AS exec_1d, round(exec_5d, 6) AS exec_5d FROM fwd")
def label_forward_return(spark: SparkSession, d: str) -> DataFrame:
    return rounded(labels.forward_returns(qfq(spark, d), [1, 5]))


@query(f"""WITH {_FORWARD}, v AS (SELECT code, date, round(forward_5d, 9) AS v FROM fwd),
b AS (SELECT date, quantile_cont(v, 0.7) AS hi, quantile_cont(v, 0.3) AS lo FROM v GROUP BY date HAVING count(v) >= 10)
SELECT code, date, CAST(CASE WHEN v <= lo THEN 0 WHEN v >= hi THEN 1 END AS INTEGER) AS label FROM v LEFT JOIN b USING (date)""")
def label_cross_section_class(spark: SparkSession, d: str) -> DataFrame:
    values = labels.forward_returns(qfq(spark, d), [5]).select("code", "date", r("forward_5d", 9).alias("v"))
    return labels.cross_section_class(values, "v").select("code", "date", "label")


@query(f"""WITH {sql_bars('qfq')}, w AS (SELECT code, date, min(close) OVER ({W_SQL} ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) / close - 1 AS worst FROM bars)
SELECT code, date, round(worst, 6) AS worst, CAST(CASE WHEN worst IS NOT NULL THEN round(worst, 9) <= -0.05 END AS INTEGER) AS label FROM w""")
def label_sell_drawdown(spark: SparkSession, d: str) -> DataFrame:
    out = labels.drawdown_ahead(qfq(spark, d))
    return out.select("code", "date", r("worst").alias("worst"), (F.round("worst", 9) <= -0.05).cast("int").alias("label"))


@query(f"""WITH {sql_bars('qfq')}, s AS (SELECT code, date, lead(open, 1) OVER w AS entry, unnest([0, 1, 2, 3, 4, 5]) AS k, unnest([lead(open, 1) OVER w, lead(open, 2) OVER w, lead(open, 3) OVER w, lead(open, 4) OVER w, lead(open, 5) OVER w, lead(open, 6) OVER w]) AS exit,
  unnest([NULL, lead(low, 1) OVER w, lead(low, 2) OVER w, lead(low, 3) OVER w, lead(low, 4) OVER w, lead(low, 5) OVER w]) AS low FROM bars WINDOW w AS ({W_SQL})),
t AS (SELECT *, coalesce(bool_or(coalesce(low / entry - 1 < -0.10, false)) OVER (PARTITION BY code, date ORDER BY k ROWS UNBOUNDED PRECEDING), false) AS stop FROM s)
SELECT code, date, CAST(arg_min(k, (-(exit / entry - 1), k)) FILTER (WHERE NOT stop AND exit IS NOT NULL AND entry > 0) AS INTEGER) AS label FROM t GROUP BY code, date""")
def label_optimal_remaining_days(spark: SparkSession, d: str) -> DataFrame:
    return ft.optimal_remaining_days(qfq(spark, d))


# ---- scores, regime ----------------------------------------------------------------------------------------------------------------

# Weights of the rank blend, of ascending and of descending ranks.
BLEND = {
    "return_20d": 0.18, "return_5d": 0.12, "macd_hist": 0.10, "volume_ma20_ratio": 0.08, "roe": 0.08, "gross_margin": 0.06, "net_margin": 0.05, "net_inflow_to_amount": 0.07,
    "main_net_inflow_to_amount": 0.05, "dragon_tiger_net_to_amount": 0.04, "limit_up_streak": 0.03, "is_kpl_event": 0.02,
}
BLEND_DOWN = {"std_ratio": 0.06, "pb": 0.04, "debt_to_assets": 0.02}
_QUALITY = ["roe", "gross_margin", "net_margin", "debt_to_assets"]
_ABSENT = ["net_inflow_to_amount", "main_net_inflow_to_amount", "dragon_tiger_net_to_amount", "limit_up_streak", "is_kpl_event"]


def _sql_rank(c: str, down: bool) -> str:
    ties, n = f"(count(*) OVER (PARTITION BY date, {c}) - 1) / 2.0", f"count({c}) OVER (PARTITION BY date)"
    rank = f"rank() OVER (PARTITION BY date ORDER BY {c} {'DESC' if down else 'ASC'} NULLS LAST)"
    return f"CASE WHEN {c} IS NULL OR {n} <= 1 THEN 0.5 ELSE ({rank} + {ties}) / {n} END"


@query(f"""WITH {FEATURES_SQL}, {sql_bars('none', 'raw')},
said AS (SELECT code, ann, bps, {', '.join(_QUALITY)}, lead(ann) OVER (PARTITION BY code ORDER BY ann) AS until FROM (
  SELECT {sql_equity_code('equity_code')} AS code, announcement_date AS ann, bps, {', '.join(_QUALITY)}, row_number() OVER (PARTITION BY {sql_equity_code('equity_code')}, announcement_date
    ORDER BY report_period DESC NULLS LAST, bps DESC NULLS LAST, {', '.join(f'{c} DESC NULLS LAST' for c in _QUALITY)}) AS rn FROM {INDICATOR} WHERE announcement_date IS NOT NULL) WHERE rn = 1 AND code IS NOT NULL),
v AS (SELECT b.code, b.date, round(b.close / nullif(s.bps, 0), 9) AS pb, {', '.join('s.' + c for c in _QUALITY)} FROM raw b JOIN said s ON b.code = s.code AND b.date >= s.ann AND (s.until IS NULL OR b.date < s.until)),
q AS (SELECT code, date, {', '.join(f'round({c}, 9) AS {c}' for c in ('return_20d', 'return_5d', 'macd_hist', 'volume_ma20_ratio', 'std_ratio'))}, pb, {', '.join(_QUALITY)} FROM features LEFT JOIN v USING (code, date))
SELECT code, date, round(""" + " + ".join([f"{w} * {'0.5' if c in _ABSENT else _sql_rank(c, c in BLEND_DOWN)}" for c, w in (BLEND | BLEND_DOWN).items()]) + ", 6) AS score FROM q")
def score_rank_blend(spark: SparkSession, d: str) -> DataFrame:
    """All fifteen terms; the five of events, which these tables have for no stock, count in the middle as missing columns do."""
    rows = table(spark, d, INDICATOR).withColumn("code", equity_code(F.col("equity_code"))).withColumnsRenamed({"announcement_date": "ann", "report_period": "period"})
    said = intervals(rows, "code", "ann", "period", ["bps", *_QUALITY])
    value = interval_join(unadjusted(spark, d, "close"), said, "code", "date", "ann").select("code", "date", r(ratio(F.col("close"), F.col("bps")), 9).alias("pb"), *_QUALITY)
    q = ft.daily_features(qfq(spark, d)).select("code", "date", *[r(c, 9).alias(c) for c in ("return_20d", "return_5d", "macd_hist", "volume_ma20_ratio", "std_ratio")])
    return stats.rank_blend(q.join(value, ["code", "date"], "left"), BLEND, BLEND_DOWN).withColumn("score", r("score"))


_MARKET = "SELECT CAST(o_orderdate AS DATE) AS date, round(avg(o_totalprice), 8) AS close FROM orders GROUP BY 1"


def _market(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.round(F.avg("o_totalprice"), 8).alias("close"))


def _f(n: int) -> str:
    return f"OVER (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


@query(f"""WITH i AS ({_MARKET}),
a AS (SELECT date, close, row_number() OVER (ORDER BY date) AS no, avg(close) {_f(60)} AS ma60, avg(close) {_f(120)} AS ma120, avg(close) {_f(200)} AS ma200,
  close / lag(close) OVER (ORDER BY date) - 1 AS ret1, close / lag(close, 5) OVER (ORDER BY date) - 1 AS ret5, close / lag(close, 20) OVER (ORDER BY date) - 1 AS ret20, close / lag(close, 60) OVER (ORDER BY date) - 1 AS ret60,
  close / max(close) {_f(20)} - 1 AS dd20, close / max(close) {_f(60)} - 1 AS dd60 FROM i),
b AS (SELECT *, ma60 - lag(ma60, 20) OVER (ORDER BY date) AS slope, stddev_samp(ret1) {_f(20)} AS vol20, stddev_samp(ret1) {_f(60)} AS vol60 FROM a),
c AS (SELECT *, CASE WHEN count(vol20) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) >= 60 THEN quantile_cont(vol20, 0.8) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) END AS q80 FROM b),
s AS (SELECT *, CAST(CASE WHEN close > ma60 THEN 8 ELSE 0 END + CASE WHEN close > ma120 THEN 10 ELSE 0 END + CASE WHEN close > ma200 THEN 12 ELSE 0 END + CASE WHEN slope > 0 THEN 5 ELSE 0 END
  + CASE WHEN ret20 > 0 THEN 10 ELSE 0 END + CASE WHEN ret60 > 0 THEN 10 ELSE 0 END + CASE WHEN dd20 > -0.05 THEN 10 ELSE 0 END + CASE WHEN dd60 > -0.10 THEN 10 ELSE 0 END
  + CASE WHEN ret5 > -0.03 THEN 5 ELSE 0 END + CASE WHEN vol20 <= q80 THEN 12 ELSE 0 END + CASE WHEN vol20 <= 1.2 * vol60 THEN 8 ELSE 0 END AS BIGINT) AS score FROM c)
SELECT date, score, CASE WHEN no <= 200 THEN 'neutral' WHEN dd20 <= -0.08 OR ret5 <= -0.05 OR (close <= ma200 AND (slope <= 0 OR ret20 <= 0)) OR score < 40 THEN 'bear' WHEN score >= 70 THEN 'bull' ELSE 'neutral' END AS regime FROM s""")
def index_regime_score(spark: SparkSession, d: str) -> DataFrame:
    return ft.regime_score(_market(spark, d))


_BREADTH = f"""{FEATURES_SQL}, breadth AS (SELECT date, avg(CAST(CASE WHEN close_to_ma20 IS NOT NULL THEN close_to_ma20 > 0 END AS INT)) AS above_ma20, avg(CAST(return_20d > 0 AS INT)) AS positive_20d,
  median(return_20d) AS median_20d, avg(CAST(return_5d < -0.03 AS INT)) AS falling_5d, count(*) AS n FROM features GROUP BY date)"""


@query(f"WITH {_BREADTH} SELECT date, round(above_ma20, 6) AS above_ma20, round(positive_20d, 6) AS positive_20d, round(median_20d, 6) AS median_20d, round(falling_5d, 6) AS falling_5d, n FROM breadth")
def market_breadth(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ft.breadth(ft.daily_features(qfq(spark, d))))


@query(f"WITH {_BREADTH} SELECT date, coalesce(above_ma20 <= 0.20 OR positive_20d <= 0.20 OR falling_5d >= 0.75, false) AS crisis FROM breadth")
def crisis_flag(spark: SparkSession, d: str) -> DataFrame:
    b = ft.breadth(ft.daily_features(qfq(spark, d)))
    return b.select("date", F.coalesce((F.col("above_ma20") <= 0.20) | (F.col("positive_20d") <= 0.20) | (F.col("falling_5d") >= 0.75), F.lit(False)).alias("crisis"))


_BASE = "(coalesce(return_5d, 0) + 0.5 * coalesce(return_20d, 0) + (50 - abs(coalesce(rsi_14, 50) - 50)) / 100 + 0.3 * coalesce(close_to_ma20, 0) - 0.01 * coalesce(std_20d, 0))"
_RISK = f"""{FEATURES_SQL},
g AS (SELECT *, sum(CASE WHEN rsi_14 > 70 THEN 0 ELSE 1 END) OVER ({W_SQL} ROWS UNBOUNDED PRECEDING) AS grp FROM features),
k AS (SELECT *, (close - max(high) {frame(20)}) / nullif(max(high) {frame(20)}, 0) AS dd20, (close - max(high) {frame(60)}) / nullif(max(high) {frame(60)}, 0) AS dd60,
  stddev_samp(close) {frame(5)} / nullif(stddev_samp(close) {frame(60)}, 0) AS volx, sum(CASE WHEN rsi_14 > 70 THEN 1 ELSE 0 END) OVER (PARTITION BY code, grp ORDER BY date ROWS UNBOUNDED PRECEDING) AS streak,
  (close - ma_60) / nullif(ma_60, 0) AS dist60 FROM g)"""


@query(f"""WITH {_RISK}, d AS (SELECT code, date, {_BASE} AS base, 5 * (1 - 1 / (1 + exp(-(
    -4 * coalesce(greatest(-1, least(0, dd20)), 0) * CAST(dd20 IS NOT NULL AS INT) - 2 * coalesce(greatest(-1, least(0, dd60)), 0) * CAST(dd60 IS NOT NULL AS INT) + 1.5 * greatest(coalesce(volx, 1) - 1, 0)
    + CAST(coalesce(streak, 0) > 5 AS INT) + 0.5 * CAST(coalesce(return_5d, 0) < -0.05 AS INT) + 0.4 * CAST(coalesce(rsi_14, 50) > 80 AS INT)
    - CASE WHEN return_20d IS NULL THEN 0 ELSE greatest(-0.5, least(0.5, return_20d)) END - 0.3 * CASE WHEN dist60 IS NULL THEN 0 ELSE greatest(-1, least(1, dist60)) END)))) AS days FROM k)
SELECT code, date, round(base, 6) AS base, round(days, 6) AS days, round(1 / (1 + exp(1.5 * (days - 1))), 6) AS chance FROM d""")
def remaining_days_bridge(spark: SparkSession, d: str) -> DataFrame:
    f = ft.daily_features(qfq(spark, d))
    return rounded(scores.with_scores(f, ft.sell_risk(f)))


@query(f"""WITH {FEATURES_SQL}, {sql_bars('none', 'raw')}, {INTERVALS_SQL},
v AS (SELECT b.code, b.date, b.close / nullif(s.eps_basic, 0) AS pe, b.close / nullif(s.bps, 0) AS pb, s.roe FROM raw b JOIN statements s ON b.code = s.code AND b.date >= s.ann AND (s.until IS NULL OR b.date < s.until))
SELECT code, date, round({_BASE} + CASE WHEN pe > 0 AND pe < 30 THEN 0.5 / (greatest(pe, 1) + 1) ELSE 0 END + CASE WHEN pb > 0 AND pb < 5 THEN 0.3 / (greatest(pb, 0.5) + 1) ELSE 0 END
  + CASE WHEN roe IS NULL THEN 0 ELSE 0.5 * greatest(-30, least(30, roe)) / 100 END, 9) AS score FROM features LEFT JOIN v USING (code, date)""")
def score_rich(spark: SparkSession, d: str) -> DataFrame:
    """Technical and fundamental score; statements count from their own day."""
    joined = interval_join(unadjusted(spark, d, "close"), statements(spark, d), "code", "date", "ann")
    value = joined.select("code", "date", ratio(F.col("close"), F.col("eps_basic")).alias("pe"), ratio(F.col("close"), F.col("bps")).alias("pb"), "roe")
    return ft.daily_features(qfq(spark, d)).join(value, ["code", "date"], "left").select("code", "date", r(scores.rich_score(), 9).alias("score"))


@query()
def garch_vol_scale(spark: SparkSession, d: str) -> DataFrame:
    """Conditional volatility and the position it allows, for every code with returns enough to fit."""
    returns = qfq(spark, d).select("code", "date", log_return(F.col("close"), Window.partitionBy("code").orderBy("date"), 1).alias("r"))
    return rounded(garch_scale(returns))


@query()
def hidden_regime_states(spark: SparkSession, d: str) -> DataFrame:
    """States of a hidden Markov model of momentum, volatility and volume of the market series."""
    m = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.avg("o_totalprice").alias("close"), F.sum("o_totalprice").alias("amount"))
    return hidden_regimes(regime_observations(m.withColumn("code", F.lit("market"))), ["momentum", "volatility", "volume_ratio"])


# ---- performance, trades -----------------------------------------------------------------------------------------------------------

_SERIES = f"""i AS ({_MARKET}), s AS (SELECT date, close AS nav, close / lag(close) OVER (ORDER BY date) - 1 AS returns, close / first_value(close) OVER (ORDER BY date) - 1 AS cumulative,
  close / max(close) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS drawdown FROM i)"""


def _series(spark: SparkSession, d: str) -> DataFrame:
    return metrics.value_series(_market(spark, d).withColumnRenamed("close", "nav"))


@query(f"WITH {_SERIES} SELECT date, round(nav, 6) AS nav, round(returns, 6) AS returns, round(cumulative, 6) AS cumulative, round(drawdown, 6) AS drawdown FROM s")
def drawdown_curve(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_series(spark, d))


@query(f"""WITH {_SERIES}, m AS (SELECT count(returns) AS n, arg_max(cumulative, date) AS total_return, stddev_samp(returns) AS std, avg(returns) AS mean, stddev_samp(returns) FILTER (WHERE returns < 0) AS down, min(drawdown) AS mdd FROM s)
SELECT n, round(total_return, 6) AS total_return, round(pow(1 + total_return, 252.0 / n) - 1, 6) AS annual_return, round(std * sqrt(252), 6) AS volatility, round((mean - 0.02 / 252) * 252 / nullif(std * sqrt(252), 0), 6) AS sharpe,
  round(mean * 252 / nullif(down * sqrt(252), 0), 6) AS sortino, round(mdd, 6) AS max_drawdown FROM m""")
def nav_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.performance(_series(spark, d)))


@query(f"""WITH {_SERIES}, m AS (SELECT year(date) AS y, month(date) AS m, exp(sum(ln(1 + returns))) - 1 AS x FROM s WHERE returns IS NOT NULL GROUP BY 1, 2)
SELECT CAST(y AS BIGINT) AS year, """ + ", ".join(f"round(max(x) FILTER (WHERE m = {i}), 6) AS m{i:02d}" for i in range(1, 13)) + " FROM m GROUP BY y")
def monthly_return_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.monthly_returns(_series(spark, d)))


_TRADES = """trades AS (SELECT user_id AS code, ts, event_id, CASE WHEN event_type IN ('purchase', 'view', 'signup') THEN 'buy' ELSE 'sell' END AS side, CAST(1 + floor(value) AS DOUBLE) AS qty, round(10 + value / 7, 4) AS price, round((1 + event_id % 5) / 1000.0, 4) AS fee FROM events WHERE value IS NOT NULL AND value >= 0)"""


@query(f"""WITH RECURSIVE {_TRADES},
n AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY ts, event_id) AS i FROM trades),
walk AS (SELECT code, i, side, price, CASE WHEN side = 'buy' THEN qty ELSE 0 END AS q, CASE WHEN side = 'buy' THEN qty ELSE 0 END AS held FROM n WHERE i = 1
  UNION ALL SELECT n.code, n.i, n.side, n.price, CASE WHEN n.side = 'buy' THEN n.qty ELSE least(n.qty, w.held) END, CASE WHEN n.side = 'buy' THEN w.held + n.qty ELSE w.held - least(n.qty, w.held) END FROM walk w JOIN n ON n.code = w.code AND n.i = w.i + 1),
spans AS (SELECT *, sum(q) OVER (PARTITION BY code, side ORDER BY i) - q AS lo, sum(q) OVER (PARTITION BY code, side ORDER BY i) AS hi FROM walk WHERE q > 0)
SELECT b.code, least(b.hi, s.hi) - greatest(b.lo, s.lo) AS matched, b.price AS buy_price, s.price AS sell_price, round((least(b.hi, s.hi) - greatest(b.lo, s.lo)) * (s.price - b.price), 6) AS profit
FROM spans b JOIN spans s ON b.code = s.code AND b.side = 'buy' AND s.side = 'sell' AND b.lo < s.hi AND s.lo < b.hi""")
def fifo_trade_pairs(spark: SparkSession, d: str) -> DataFrame:
    pairs = metrics.fifo_pairs(trades(spark, d), "code", ["ts", "event_id"], "side", "qty", "price")
    return pairs.select("code", "matched", "buy_price", "sell_price", r("profit").alias("profit"))


def trades(spark: SparkSession, d: str) -> DataFrame:
    """The events as trades: (code, ts, event_id, side, qty, price, fee a piece)."""
    e = table(spark, d, "events").where("value IS NOT NULL AND value >= 0")
    side = F.when(F.col("event_type").isin("purchase", "view", "signup"), "buy").otherwise("sell")
    fee = F.round((1 + F.col("event_id") % 5) / 1000.0, 4)
    return e.select(F.col("user_id").alias("code"), "ts", "event_id", side.alias("side"), (1 + F.floor("value")).cast("double").alias("qty"), F.round(10 + F.col("value") / 7, 4).alias("price"), fee.alias("fee"))


_IC = f"""{FEATURES_SQL}, s AS (SELECT code, date, round(macd_hist, 9) AS s, round(ln(lead(close, 5) OVER ({W_SQL})) - ln(close), 9) AS o FROM features)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    f = ft.daily_features(qfq(spark, d))
    ahead = F.lead("close", 5).over(Window.partitionBy("code").orderBy("date"))
    return f.select("code", "date", r("macd_hist", 9).alias("s"), r(F.ln(ahead) - F.ln("close"), 9).alias("o"))


@query(f"""WITH {_IC}, b AS (SELECT date, s, o FROM s WHERE s IS NOT NULL AND o IS NOT NULL),
k AS (SELECT *, rank() OVER (PARTITION BY date ORDER BY s) + (count(*) OVER (PARTITION BY date, s) - 1) / 2.0 AS rs, rank() OVER (PARTITION BY date ORDER BY o) + (count(*) OVER (PARTITION BY date, o) - 1) / 2.0 AS ro FROM b),
m AS (SELECT date, count(*) AS n, corr(s, o) AS ic, corr(rs, ro) AS rank_ic FROM k GROUP BY date HAVING count(*) >= 5)
SELECT date, n, round(CASE WHEN isfinite(ic) THEN ic END, 6) AS ic, round(CASE WHEN isfinite(rank_ic) THEN rank_ic END, 6) AS rank_ic FROM m""")
def daily_ic_rank_ic(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.information_coefficients(_scored(spark, d), "s", "o"))


@query(f"""WITH {_IC}, b AS (SELECT date, s, CAST(o > 0 AS INT) AS y FROM s WHERE s IS NOT NULL AND o IS NOT NULL),
k AS (SELECT *, rank() OVER (PARTITION BY date ORDER BY s) + (count(*) OVER (PARTITION BY date, s) - 1) / 2.0 AS r FROM b),
m AS (SELECT date, CAST(sum(y) AS BIGINT) AS positives, CAST(sum(1 - y) AS BIGINT) AS negatives, sum(r) FILTER (WHERE y = 1) AS r FROM k GROUP BY date)
SELECT date, positives, negatives, round(CASE WHEN positives > 0 AND negatives > 0 THEN (r - positives * (positives + 1) / 2.0) / (positives * negatives) END, 6) AS auc FROM m""")
def auc_by_rank(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.auc_by(_scored(spark, d).withColumn("y", (F.col("o") > 0).cast("int")), "date", "s", "y"))


# ---- nested costs ------------------------------------------------------------------------------------------------------------------

_COSTS = """costs AS (SELECT l_orderkey AS id, any_value(CAST(l_shipdate AS DATE)) AS x, min(CAST(l_shipdate AS DATE)) AS day, min(l_returnflag) AS service, sum(l_extendedprice) AS cost, sum(l_extendedprice * l_discount) AS credit FROM lineitem GROUP BY 1)"""


def _costs(spark: SparkSession, d: str) -> DataFrame:
    """Rows with nested credits, as in a billing export: cost, service STRUCT, credits ARRAY of STRUCT."""
    lines = table(spark, d, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.min(F.col("l_shipdate").cast("date")).alias("day"), F.struct(F.min("l_returnflag").alias("description")).alias("service"), F.sum("l_extendedprice").alias("cost"),
        F.collect_list(F.struct((-F.col("l_extendedprice") * F.col("l_discount")).alias("amount"))).alias("credits"),
    )


def _net():
    credit = F.aggregate("credits", F.lit(0.0), lambda a, x: a + F.coalesce(x["amount"], F.lit(0.0)))
    return F.round(F.sum("cost") + F.sum(F.coalesce(credit, F.lit(0.0))), 5).alias("net_cost")


@query(f"WITH {_COSTS} SELECT CAST(date_trunc('month', day) AS DATE) AS month, service, round(sum(cost) - sum(credit), 5) AS net_cost FROM costs GROUP BY 1, 2")
def cost_by_service(spark: SparkSession, d: str) -> DataFrame:
    return _costs(spark, d).groupBy(F.date_trunc("month", "day").cast("date").alias("month"), F.col("service.description").alias("service")).agg(_net())


@query(f"WITH {_COSTS} SELECT id, service, round(sum(cost) - sum(credit), 5) AS net_cost FROM costs GROUP BY 1, 2 ORDER BY net_cost DESC, id LIMIT 50")
def cost_by_resource_top_n(spark: SparkSession, d: str) -> DataFrame:
    return _costs(spark, d).groupBy("id", F.col("service.description").alias("service")).agg(_net()).orderBy(F.desc("net_cost"), "id").limit(50)


@query(f"WITH {_COSTS} SELECT day, round(sum(cost) - sum(credit), 5) AS net_cost, count(*) AS n FROM costs GROUP BY 1")
def cost_daily_trend(spark: SparkSession, d: str) -> DataFrame:
    return _costs(spark, d).groupBy("day").agg(_net(), F.count(F.lit(1)).alias("n"))


# ---- upserts, audits, calendars ----------------------------------------------------------------------------------------------------


@query("""WITH src AS (SELECT o_orderkey, max(o_totalprice) * 2 AS o_totalprice, 'X' AS o_orderstatus FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1 UNION ALL SELECT -1 - n_nationkey, 1.5, 'N' FROM nation)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
UNION ALL SELECT s.o_orderkey, t.o_custkey, s.o_orderstatus, s.o_totalprice FROM src s LEFT JOIN orders t USING (o_orderkey)""")
def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    src = orders.where("o_orderpriority LIKE '1%'").groupBy("o_orderkey").agg((F.max("o_totalprice") * 2).alias("o_totalprice")).withColumn("o_orderstatus", F.lit("X"))
    new = table(spark, d, "nation").select((-1 - F.col("n_nationkey")).cast("bigint").alias("o_orderkey"), F.lit(1.5).alias("o_totalprice"), F.lit("N").alias("o_orderstatus"))
    return upsert.merge(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), src.unionByName(new), ["o_orderkey"])


_AUDITED = ["eps_basic", "eps_diluted", "revenue_per_share", "bps", "roe", "debt_to_assets"]


@query("SELECT partition_month, count(*) AS n, " + ", ".join(f"count({c}) AS {c}" for c in _AUDITED) + f", count(DISTINCT equity_code) AS codes, min(announcement_date) AS first_date, max(announcement_date) AS last_date FROM {INDICATOR} GROUP BY 1")
def schema_coverage_audit(spark: SparkSession, d: str) -> DataFrame:
    """Rows, non-null values by column, codes and dates of each month; a wrong schema raises before anything is read."""
    t = table(spark, d, INDICATOR)
    if wrong := upsert.schema_difference(t, {c: "double" for c in _AUDITED}):
        raise ValueError(f"schema differs: {wrong}")
    return t.groupBy("partition_month").agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in _AUDITED], F.count_distinct("equity_code").alias("codes"), F.min("announcement_date").alias("first_date"), F.max("announcement_date").alias("last_date"))


@query(f"WITH s AS (SELECT date, top_n, count(*) FILTER (WHERE is_selected) OVER (PARTITION BY date) AS chosen FROM {SIGNAL}) SELECT date, max(chosen) AS max_selected, max(top_n) AS top_n, max(chosen) <= max(top_n) AS holds FROM s GROUP BY date")
def top_n_invariant(spark: SparkSession, d: str) -> DataFrame:
    by_date = table(spark, d, SIGNAL).groupBy("date").agg(F.count_if("is_selected").alias("max_selected"), F.max("top_n").alias("top_n"))
    return by_date.withColumn("holds", F.col("max_selected") <= F.col("top_n"))


@query(f"""WITH span AS (SELECT min(date) AS lo, max(date) AS hi FROM {KLINE}), days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span)
SELECT date, row_number() OVER (ORDER BY date) AS ordinal FROM days WHERE isodow(date) <= 5""")
def trading_calendar(spark: SparkSession, d: str) -> DataFrame:
    return business_days(table(spark, d, KLINE), "date", "date")


@query(f"SELECT year(date) * 100 + month(date) AS month, max(date) AS last_date FROM {KLINE} WHERE date IS NOT NULL GROUP BY 1")
def walk_forward_month_ends(spark: SparkSession, d: str) -> DataFrame:
    return month_ends(table(spark, d, KLINE), "date")


@query(f"""WITH {sql_bars('qfq')}, ends AS (SELECT max(date) AS train_end FROM bars GROUP BY year(date) * 100 + month(date))
SELECT train_end, count(*) AS train_rows, count(*) FILTER (WHERE date > train_end - 10) AS valid_rows, count(DISTINCT code) AS codes FROM bars JOIN ends ON date <= train_end AND date > train_end - 60 GROUP BY 1""")
def walk_forward_windows(spark: SparkSession, d: str) -> DataFrame:
    """Training windows of 60 days up to each month's end: the few ends are joined by range to the panel, reduced to a row a code and date."""
    daily = qfq(spark, d).select("code", "date")
    ends = month_ends(daily, "date").select(F.col("last_date").alias("train_end"))
    inside = (F.col("date") <= F.col("train_end")) & (F.col("date") > F.date_sub("train_end", 60))
    by_date = daily.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    # ends and dates are a row a month and a day: each date is given its ends, then the panel joins on the date
    dated = by_date.join(F.broadcast(ends), inside).select("date", "train_end")
    valid = F.count_if(F.col("date") > F.date_sub("train_end", 10))
    return daily.join(dated, "date").groupBy("train_end").agg(F.count(F.lit(1)).alias("train_rows"), valid.alias("valid_rows"), F.count_distinct("code").alias("codes"))


TREE_FEATURES = ["return_1d", "return_5d", "volume_ma5_ratio", "std_ratio", "rsi_14", "macd_hist", "close_to_high_20d", "close_to_ma20"]


def _panel(spark: SparkSession, d: str) -> DataFrame:
    daily = materialize(qfq(spark, d), "bars")
    values = labels.forward_returns(daily, [5]).select("code", "date", F.col("forward_5d").alias("v"))
    classes = labels.cross_section_class(values, "v").select("code", "date", "v", F.col("label").cast("double").alias("label"))
    return materialize(training.eval_split(ft.daily_features(daily).select("code", "date", *TREE_FEATURES).join(classes, ["code", "date"])), "panel")


@query()
def gbt_train_predict(spark: SparkSession, d: str) -> DataFrame:
    """Boosted trees on technical features for the class of the next 5 rows, split by date; (split, positives, negatives, auc)."""
    panel = _panel(spark, d)
    model = training.train_trees(panel, TREE_FEATURES)
    if model is None:
        return spark.createDataFrame([], "split STRING, positives BIGINT, negatives BIGINT, auc DOUBLE")
    scored = training.predict(model, panel.where("label IS NOT NULL"), TREE_FEATURES).withColumn("split", F.when(F.col("is_eval"), "valid").otherwise("train"))
    return rounded(stats.auc_by(scored.withColumn("label", F.col("label").cast("int")), "split", "prob_up", "label"))


@query()
def gbt_quality_gates(spark: SparkSession, d: str) -> DataFrame:
    """Whether the trees pass the gates on the later dates: (auc, rank_ic, passed)."""
    panel = _panel(spark, d)
    model = training.train_trees(panel, TREE_FEATURES, parameters=training.TreeParameters(rounds=10))
    if model is None:
        return spark.createDataFrame([], "auc DOUBLE, rank_ic DOUBLE, passed BOOLEAN")
    late = training.predict(model, panel.where("is_eval"), TREE_FEATURES).withColumn("label", F.col("label").cast("int"))
    return rounded(training.gates(late, "v"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
