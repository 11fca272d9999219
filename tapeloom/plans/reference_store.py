"""Queries of the store, of normalisers and audits, and of training frames; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.codes import equity_code, sql_equity_code, strict_code
from tapeloom.functions.windows import ratio
from tapeloom.operators import features as ft
from tapeloom.operators import labels, metrics, stats, temporal
from tapeloom.operators.fundamental import known_statements
from tapeloom.plans.reference import _EVENT_FACTS, FEATURES_SQL, INDICATOR, INTERVALS_SQL, KLINE, LINEAGE, SECURITY, SIGNAL, event_facts, pair_candidate_stats, pair_kernels, qfq, r, rounded, sql_bars, statements, unadjusted
from tapeloom.plans.reference_learning import _MARKET, _market, _TRADES, trades
from tapeloom.session import table
from tapeloom.sources.ingest import adjust_type, classify_path
from tapeloom.sources.store import Store, asset_kind, labelled

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


# ---- store -------------------------------------------------------------------------------------------------------------------------

_IN_CODES = "(SELECT code FROM (SELECT code FROM bars GROUP BY code ORDER BY code LIMIT 25))"


def _some_codes(spark: SparkSession, d: str) -> DataFrame:
    """The first codes in order, as a caller's list; a DataFrame side is semi-joined."""
    return qfq(spark, d).select("code").distinct().orderBy("code").limit(25)


@query(f"""WITH {sql_bars('qfq')} SELECT code, date, open, high, low, close, volume, amount FROM bars
WHERE date BETWEEN DATE '2025-10-20' AND DATE '2025-11-14' AND code IN {_IN_CODES}""")
def store_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars by codes, range and adjust type. Rows of the range without a month are there, too."""
    return Store(spark, d).bars(_some_codes(spark, d), "20251020", "20251114")


_STORE_WEEK = f"""WITH {sql_bars('hfq')}, q AS (SELECT DISTINCT code FROM (SELECT {sql_equity_code('equity_code')} AS code, close, date, row_number() OVER (PARTITION BY {sql_equity_code('equity_code')}, date ORDER BY {LINEAGE}) AS rn FROM {KLINE} WHERE adjust_type = 'qfq' AND date IS NOT NULL) WHERE rn = 1 AND close > 0 AND code IS NOT NULL ORDER BY code LIMIT 25)
SELECT code, CAST(date_trunc('week', date) AS DATE) AS date, arg_min(open, date) FILTER (WHERE open IS NOT NULL) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close, sum(volume) AS volume, sum(amount) AS amount, count(*) AS days
FROM bars WHERE date BETWEEN DATE '2025-10-20' AND DATE '2025-11-14' AND code IN (SELECT code FROM q) GROUP BY 1, 2"""


@query(_STORE_WEEK)
def store_bars_weekly(spark: SparkSession, d: str) -> DataFrame:
    return Store(spark, d).bars(_some_codes(spark, d), "20251020", "20251114", adjust="hfq", period="week")


@query(f"""SELECT code, CASE WHEN (split_part(code, '.', 2) IN ('SH', 'CSI') AND left(code, 3) IN ('000', '930', '932', '950')) OR (split_part(code, '.', 2) = 'SZ' AND left(code, 3) = '399') THEN 'index'
  WHEN (split_part(code, '.', 2) = 'SH' AND left(code, 2) IN ('51', '56', '58', '11')) OR (split_part(code, '.', 2) = 'SZ' AND left(code, 2) IN ('15', '16')) THEN 'fund' ELSE 'equity' END AS kind
FROM (SELECT DISTINCT unnest([{sql_equity_code('security_code')}, '000' || substr(security_code, 4, 3) || '.SH', '399' || substr(security_code, 4, 3) || '.SZ', '15' || substr(security_code, 3, 4) || '.SZ', '51' || substr(security_code, 3, 4) || '.SH', '930' || substr(security_code, 4, 3) || '.CSI']) AS code FROM {SECURITY}) WHERE code IS NOT NULL""")
def store_asset_kind(spark: SparkSession, d: str) -> DataFrame:
    c, sub = F.col("security_code"), F.substring
    forms = F.array(equity_code(c), F.concat(F.lit("000"), sub(c, 4, 3), F.lit(".SH")), F.concat(F.lit("399"), sub(c, 4, 3), F.lit(".SZ")), F.concat(F.lit("15"), sub(c, 3, 4), F.lit(".SZ")), F.concat(F.lit("51"), sub(c, 3, 4), F.lit(".SH")), F.concat(F.lit("930"), sub(c, 4, 3), F.lit(".CSI")))
    codes = table(spark, d, SECURITY).select(F.explode(forms).alias("code")).where("code IS NOT NULL").distinct()
    return codes.select("code", asset_kind(F.col("code")).alias("kind"))


_DIM = f"""dim AS (SELECT * FROM (SELECT {sql_equity_code('security_code')} AS code, security_name AS name, list_date, delist_date, is_active, row_number() OVER (PARTITION BY {sql_equity_code('security_code')} ORDER BY {LINEAGE}) AS rn FROM {SECURITY}) WHERE rn = 1)"""


@query(f"""WITH {_DIM} SELECT code, name, list_date, delist_date FROM dim WHERE (list_date IS NULL OR list_date <= DATE '2025-10-31') AND (delist_date IS NULL OR delist_date > DATE '2025-10-31')""")
def store_stock_list(spark: SparkSession, d: str) -> DataFrame:
    return Store(spark, d).stock_list("20251031")


@query(f"SELECT DISTINCT {sql_equity_code('security_code')} AS code, security_name AS name FROM {SECURITY}")
def store_names(spark: SparkSession, d: str) -> DataFrame:
    return Store(spark, d).names()


@query(f"""WITH s AS (SELECT DISTINCT {sql_equity_code('security_code')} AS code FROM {SECURITY} WHERE security_name IS NOT NULL)
SELECT strftime(date, '%Y%m%d') AS date, {sql_equity_code('equity_code')} AS equity_code, prob_up, score_rank FROM {SIGNAL} a WHERE is_selected AND score_rank <= 10
AND date BETWEEN DATE '2025-10-01' AND DATE '2025-12-31' AND {sql_equity_code('equity_code')} IN (SELECT code FROM s)""")
def store_candidates(spark: SparkSession, d: str) -> DataFrame:
    return Store(spark, d).candidates("2025-10-01", "2025-12-31", pool=10)


_FUND = f"""fund AS (SELECT b.code, b.date, b.close / nullif(s.eps_basic, 0) AS pe_basic, b.close / nullif(s.bps, 0) AS pb, s.roe FROM raw b JOIN statements s ON b.code = s.code AND b.date >= s.ann AND (s.until IS NULL OR b.date < s.until))"""


def _fundamental(spark: SparkSession, d: str) -> DataFrame:
    joined = temporal.interval_join(unadjusted(spark, d, "close"), statements(spark, d), "code", "date", "ann")
    return joined.select("code", "date", ratio(F.col("close"), F.col("eps_basic")).alias("pe_basic"), ratio(F.col("close"), F.col("bps")).alias("pb"), "roe")


_HISTORY = ["return_1d", "return_20d", "volume_ma20_ratio", "rsi_14", "macd_hist", "close_to_ma20"]


@query(f"""WITH {FEATURES_SQL}, {sql_bars('none', 'raw')}, {INTERVALS_SQL}, {_FUND},
f AS (SELECT features.*, pe_basic, pb, roe FROM features LEFT JOIN fund USING (code, date) WHERE date >= DATE '2025-10-01' AND date <= DATE '2025-11-14' + 40 AND close > 0),
l AS (SELECT *, ln(lead(close, 5) OVER (PARTITION BY code ORDER BY date)) - ln(close) AS label_return FROM f)
SELECT code, date, """ + ", ".join(f"round({c}, 6) AS {c}" for c in (*_HISTORY, "pe_basic", "pb", "roe", "label_return")) + " FROM l WHERE date <= DATE '2025-11-14'")
def store_feature_history(spark: SparkSession, d: str) -> DataFrame:
    """The enhanced features of a range with the label of the next 5 rows."""
    rows = Store(spark, d).features(None, ft.daily_features(qfq(spark, d)), _fundamental(spark, d))
    return rounded(labelled(rows, "20251001", "20251114").select("code", "date", *_HISTORY, "pe_basic", "pb", "roe", "label_return"))


_KINDS = {"income": ("eps_basic", ["eps_basic", "net_margin"]), "balance": ("bps", ["bps", "current_ratio"]), "indicator": ("roe", ["roe", "gross_margin"])}


def _sql_kind(kind: str, has: str, values: list[str]) -> str:
    names, order = ", ".join(values), ", ".join(f"{v} DESC NULLS LAST" for v in values)
    return f"""{kind} AS (SELECT code, ann, {names}, lead(ann) OVER (PARTITION BY code ORDER BY ann) AS until FROM (SELECT {sql_equity_code('equity_code')} AS code, announcement_date AS ann, {names},
  row_number() OVER (PARTITION BY {sql_equity_code('equity_code')}, announcement_date ORDER BY report_period DESC NULLS LAST, {order}) AS rn FROM {INDICATOR} WHERE announcement_date IS NOT NULL AND {has} IS NOT NULL) WHERE rn = 1 AND code IS NOT NULL)"""


@query(f"""WITH {sql_bars('none')}, """ + ", ".join(_sql_kind(k, *v) for k, v in _KINDS.items()) + """
SELECT b.code, b.date, """ + ", ".join(f"{k}.ann AS {k}_date" for k in _KINDS) + """, round(b.close / nullif(eps_basic, 0), 6) AS pe_basic, round(b.close / nullif(bps, 0), 6) AS pb, round(roe, 6) AS roe, round(current_ratio, 6) AS current_ratio
FROM bars b """ + " ".join(f"LEFT JOIN {k} ON b.code = {k}.code AND b.date >= {k}.ann AND ({k}.until IS NULL OR b.date < {k}.until)" for k in _KINDS) + """
WHERE income.ann IS NOT NULL OR balance.ann IS NOT NULL OR indicator.ann IS NOT NULL""")
def fundamental_three_way(spark: SparkSession, d: str) -> DataFrame:
    """Prices with income, balance and indicator statements, each the latest known; the three are views of one table here."""
    rows = table(spark, d, INDICATOR).select(equity_code(F.col("equity_code")).alias("code"), "announcement_date", "report_period", *dict.fromkeys(c for _, values in _KINDS.values() for c in values))
    kinds = {k: (rows.where(F.col(has).isNotNull()), values) for k, (has, values) in _KINDS.items()}
    known = known_statements(unadjusted(spark, d, "close"), kinds, "code", "date", "announcement_date", "report_period")
    out = known.select("code", "date", *[f"{k}_date" for k in _KINDS], ratio(F.col("close"), F.col("eps_basic")).alias("pe_basic"), ratio(F.col("close"), F.col("bps")).alias("pb"), "roe", "current_ratio")
    return rounded(out)


@query()
def pair_selection(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that move together and come back: correlation of 0.8, a unit-root statistic under its 5 % bound, a half-life of 3 to 20 rows;
    those nearest to a half-life of 10 first."""
    return stats.select_pairs(pair_candidate_stats(spark, d), pair_kernels(spark, d))


# ---- cleaning ----------------------------------------------------------------------------------------------------------------------


@query(f"""SELECT source_file, source_entry, CASE WHEN regexp_matches(lower(coalesce(source_file, '') || '/' || coalesce(source_entry, '')), '前复权|qfq') THEN 'qfq'
  WHEN regexp_matches(lower(coalesce(source_file, '') || '/' || coalesce(source_entry, '')), '后复权|hfq') THEN 'hfq' ELSE 'none' END AS inferred, count(*) AS n FROM {KLINE} GROUP BY ALL""")
def adjust_type_inferred(spark: SparkSession, d: str) -> DataFrame:
    """The adjust type that a row's lineage tells."""
    kept = table(spark, d, KLINE).groupBy("source_file", "source_entry").agg(F.count(F.lit(1)).alias("n"))
    return kept.select("source_file", "source_entry", adjust_type().alias("inferred"), "n")


_PLAIN = "regexp_replace(raw, '\\.0\\s*$', '')"


@query(f"""SELECT raw, CASE WHEN regexp_full_match({sql_equity_code(_PLAIN)}, '[0-9]{{6}}\\.(SH|SZ|BJ)') THEN {sql_equity_code(_PLAIN)} END AS code
FROM (SELECT DISTINCT unnest([equity_code, left(equity_code, 6) || '.0', 'sz' || substr(equity_code, 1, 6), 'x' || equity_code, 'SH_' || substr(equity_code, 1, 6), '']) AS raw FROM {KLINE}) WHERE raw IS NOT NULL""")
def code_normalize_strict(spark: SparkSession, d: str) -> DataFrame:
    """Codes by the strict rule: null for all that is none."""
    c, six = F.col("equity_code"), F.substring("equity_code", 1, 6)
    forms = F.array(c, F.concat(six, F.lit(".0")), F.concat(F.lit("sz"), six), F.concat(F.lit("x"), c), F.concat(F.lit("SH_"), six), F.lit(""))
    raw = table(spark, d, KLINE).select("equity_code").distinct().select(F.explode(forms).alias("raw")).where("raw IS NOT NULL").distinct()
    return raw.select("raw", strict_code(F.col("raw")).alias("code"))


# ---- labels and training frames ----------------------------------------------------------------------------------------------------


@query(f"""WITH {sql_bars('qfq')}, v AS (SELECT code, date, round(ln(lead(close, 5) OVER w) - ln(close), 9) AS v FROM bars WINDOW w AS (PARTITION BY code ORDER BY date)),
t AS (SELECT date, quantile_disc(v, 0.7) AS hi, quantile_disc(v, 0.3) AS lo, count(v) AS n FROM v WHERE v IS NOT NULL GROUP BY date)
SELECT code, date, CAST(CASE WHEN v >= hi THEN 1 WHEN v <= lo THEN 0 END AS INTEGER) AS label FROM v JOIN t USING (date) WHERE v IS NOT NULL""")
def label_by_approximate_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Classes by the 30th and 70th of a date's hundred approximate quantiles; at both bounds the top counts."""
    values = labels.forward_returns(qfq(spark, d), [5]).select("code", "date", r("forward_5d", 9).alias("v")).where("v IS NOT NULL")
    return labels.approximate_class(values, "v").select("code", "date", "label")


@query(f"""WITH {sql_bars('qfq')}, h AS (SELECT b.code, b.date, b.close, s.h, lag(b.open, s.h) OVER w AS entry, max(b.high) OVER (PARTITION BY b.code, s.h ORDER BY b.date ROWS BETWEEN s.h PRECEDING AND CURRENT ROW) AS peak
  FROM bars b, (VALUES (3), (5)) s(h) WINDOW w AS (PARTITION BY b.code, s.h ORDER BY b.date))
SELECT code, date, CAST(h AS INTEGER) AS held, round(close / entry - 1, 6) AS gain, round(close / peak - 1, 6) AS from_peak FROM h WHERE entry > 0 AND peak > 0""".replace("lag(b.open, s.h) OVER w", "CASE WHEN s.h = 3 THEN lag(b.open, 3) OVER w ELSE lag(b.open, 5) OVER w END").replace("max(b.high) OVER (PARTITION BY b.code, s.h ORDER BY b.date ROWS BETWEEN s.h PRECEDING AND CURRENT ROW)", "CASE WHEN s.h = 3 THEN max(b.high) OVER (PARTITION BY b.code, s.h ORDER BY b.date ROWS 3 PRECEDING) ELSE max(b.high) OVER (PARTITION BY b.code, s.h ORDER BY b.date ROWS 5 PRECEDING) END"))
def held_positions(spark: SparkSession, d: str) -> DataFrame:
    """Each row as if held for 3 and 5 rows: gain since the open of entry, distance from the high since."""
    return rounded(ft.held_positions(qfq(spark, d), [3, 5]))


# The panel of the events: users are codes, a day's values are its prices, signups are statements.
_PANEL = f"""{_EVENT_FACTS},
daily AS (SELECT equity_code, date, arg_max(value, row(ts, event_id)) AS close, sum(value) AS amount FROM (SELECT 'u' || user_id AS equity_code, CAST(ts AS DATE) AS date, ts, event_id, value FROM events WHERE value IS NOT NULL) GROUP BY 1, 2),
said AS (SELECT equity_code, date AS ann, max(value) AS roe FROM e WHERE event_type = 'signup' GROUP BY 1, 2),
spans AS (SELECT *, lead(ann) OVER (PARTITION BY equity_code ORDER BY ann) AS until FROM said),
cal AS (SELECT DISTINCT date FROM daily),
next_boards AS (SELECT equity_code, available AS date, max(streak) AS streak FROM (SELECT equity_code, streak, (SELECT min(c.date) FROM cal c WHERE c.date > boards.date) AS available FROM boards) WHERE available IS NOT NULL GROUP BY 1, 2)"""


@query(f"""WITH {_PANEL}
SELECT d.equity_code, d.date, round(d.close, 6) AS close, round(s.roe, 6) AS roe, round(m.net / nullif(d.amount, 0), 6) AS net_inflow_to_amount, round(m.main / nullif(d.amount, 0), 6) AS main_net_inflow_to_amount,
  round(t.net / nullif(d.amount, 0), 6) AS dragon_tiger_net_to_amount, CAST(t.departments AS DOUBLE) AS dragon_tiger_department_count, coalesce(k.streak, 0) AS limit_up_streak, CASE WHEN k.date IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_kpl_event
FROM daily d LEFT JOIN spans s ON s.equity_code = d.equity_code AND d.date > s.ann AND (s.until IS NULL OR d.date < s.until) LEFT JOIN money m ON m.equity_code = d.equity_code AND m.date = d.date LEFT JOIN seats t ON t.equity_code = d.equity_code AND t.date = d.date LEFT JOIN next_boards k ON k.equity_code = d.equity_code AND k.date = d.date""")
def rich_feature_wide(spark: SparkSession, d: str) -> DataFrame:
    """Daily rows with statements announced before them, the day's money flow and seats, and board events from the next trading day on."""
    money, seats, boards = event_facts(spark, d)
    e = table(spark, d, "events").where("value IS NOT NULL").select(F.concat(F.lit("u"), F.col("user_id")).alias("equity_code"), F.col("ts").cast("date").alias("date"), "ts", "event_id", "event_type", "value")
    daily = e.groupBy("equity_code", "date").agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"), F.sum("value").alias("amount"))
    said = table(spark, d, "events").where("event_type = 'signup'").groupBy(F.concat(F.lit("u"), F.col("user_id")).alias("equity_code"), F.col("ts").cast("date").alias("ann")).agg(F.max("value").alias("roe"))
    spans = temporal.intervals(said.withColumn("period", F.lit(1)), "equity_code", "ann", "period", ["roe"])
    wide = ft.rich_wide(daily, spans, money, seats, boards, daily.select("date").distinct())
    cols = ["net_inflow_to_amount", "main_net_inflow_to_amount", "dragon_tiger_net_to_amount", "dragon_tiger_department_count", "limit_up_streak", "is_kpl_event"]
    return rounded(wide.select("equity_code", "date", "close", "roe", *cols))


# ---- performance -------------------------------------------------------------------------------------------------------------------

_BENCH = "SELECT CAST(l_shipdate AS DATE) AS date, round(avg(l_extendedprice), 8) AS close FROM lineitem GROUP BY 1"


def _bench(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(F.round(F.avg("l_extendedprice"), 8).alias("close"))


@query(f"""WITH n AS ({_MARKET}), b AS ({_BENCH}),
s AS (SELECT date, close AS nav, close / lag(close) OVER (ORDER BY date) - 1 AS x FROM n), t AS (SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS y FROM b),
p AS (SELECT date, x, y FROM s JOIN t USING (date) WHERE x IS NOT NULL AND y IS NOT NULL),
tot AS (SELECT arg_max(nav, date) / arg_min(nav, date) - 1 AS total, count(x) AS k FROM s), bt AS (SELECT arg_max(close, date) / arg_min(close, date) - 1 AS bench FROM b),
dd AS (SELECT date, nav, nav / max(nav) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS d FROM s),
worst AS (SELECT min(date) AS low FROM dd WHERE d = (SELECT min(d) FROM dd)),
peak AS (SELECT low, (SELECT arg_max(date, (nav, -epoch(date))) FROM dd WHERE date <= low) AS top FROM worst),
dur AS (SELECT date_diff('day', top, coalesce((SELECT min(date) FROM dd WHERE date >= low AND nav >= (SELECT nav FROM dd WHERE date = top)), (SELECT max(date) FROM dd))) AS days FROM peak),
m AS (SELECT count(*) AS n, covar_samp(x, y) / var_samp(y) AS beta, stddev_samp(x - y) * sqrt(252) AS te FROM p)
SELECT n AS aligned, round(bench, 6) AS benchmark_return, round(pow(1 + total, 252.0 / k) - 1 - bench, 6) AS excess_return, days AS max_drawdown_duration, round(beta, 6) AS beta,
  round(pow(1 + total, 252.0 / k) - 1 - (0.02 + beta * (bench - 0.02)), 6) AS alpha, round((pow(1 + total, 252.0 / k) - 1 - bench) / te, 6) AS information_ratio FROM m, tot, bt, dur""")
def nav_against_benchmark(spark: SparkSession, d: str) -> DataFrame:
    """Beta, alpha and information ratio of a value series against a benchmark, aligned by date, and how long its worst drawdown took."""
    nav = metrics.value_series(_market(spark, d).withColumnRenamed("close", "nav"))
    return rounded(metrics.against_benchmark(nav, _bench(spark, d)))


@query(f"""WITH b AS ({_BENCH}) SELECT date, round(close / first_value(close) OVER (ORDER BY date) - 1, 6) AS benchmark_return,
  round(min(dd) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING), 6) AS max_drawdown FROM (SELECT *, close / max(close) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS dd FROM b)""")
def benchmark_to_date(spark: SparkSession, d: str) -> DataFrame:
    """Return and worst drawdown of the benchmark up to each date."""
    return rounded(metrics.to_date(_bench(spark, d)))


_PROFITS = f"""{_TRADES},
n AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY ts, event_id) AS i FROM trades),
walk AS (SELECT code, i, side, price, fee, CASE WHEN side = 'buy' THEN qty ELSE 0 END AS q, CASE WHEN side = 'buy' THEN qty ELSE 0 END AS held FROM n WHERE i = 1
  UNION ALL SELECT n.code, n.i, n.side, n.price, n.fee, CASE WHEN n.side = 'buy' THEN n.qty ELSE least(n.qty, w.held) END, CASE WHEN n.side = 'buy' THEN w.held + n.qty ELSE w.held - least(n.qty, w.held) END FROM walk w JOIN n ON n.code = w.code AND n.i = w.i + 1),
spans AS (SELECT *, sum(q) OVER (PARTITION BY code, side ORDER BY i) - q AS lo, sum(q) OVER (PARTITION BY code, side ORDER BY i) AS hi FROM walk WHERE q > 0),
pairs AS (SELECT b.code, round((least(b.hi, s.hi) - greatest(b.lo, s.lo)) * (s.price - b.price - b.fee - s.fee), 6) AS profit
  FROM spans b JOIN spans s ON b.code = s.code AND b.side = 'buy' AND s.side = 'sell' AND b.lo < s.hi AND s.lo < b.hi)"""


@query(f"""WITH RECURSIVE {_PROFITS}
SELECT count(*) AS total_trades, round(count(*) FILTER (WHERE profit > 0) / count(*), 6) AS win_rate, round(sum(profit) FILTER (WHERE profit > 0) / nullif(abs(sum(profit) FILTER (WHERE profit < 0)), 0), 6) AS profit_loss_ratio FROM pairs""")
def trade_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Share of matches that won, and what they won over what the others lost."""
    pairs = metrics.fifo_pairs(trades(spark, d), "code", ["ts", "event_id"], "side", "qty", "price", "fee").withColumn("profit", r("profit"))
    return rounded(metrics.trade_statistics(pairs))


# ---- audits ------------------------------------------------------------------------------------------------------------------------


@query(f"""SELECT 'kline' AS name, count(*) AS n, count(*) = 0 AS is_empty, min(date) AS first_date, max(date) AS last_date FROM {KLINE}
UNION ALL SELECT 'signal', count(*), count(*) = 0, min(date), max(date) FROM {SIGNAL} UNION ALL SELECT 'indicator', count(*), count(*) = 0, min(announcement_date), max(announcement_date) FROM {INDICATOR}""")
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    """Rows and dates of each table, one row a table, as a report that is appended to."""
    out = None
    for name, source, date in (("kline", KLINE, "date"), ("signal", SIGNAL, "date"), ("indicator", INDICATOR, "announcement_date")):
        one = table(spark, d, source).agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) == 0).alias("is_empty"), F.min(date).alias("first_date"), F.max(date).alias("last_date")).select(F.lit(name).alias("name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""SELECT gcs_uri, CASE WHEN gcs_uri LIKE '%kline%' OR gcs_uri LIKE '%daily%' OR gcs_uri LIKE '%复权%' THEN 'kline' WHEN gcs_uri LIKE '%factor%' OR gcs_uri LIKE '%复权因子%' THEN 'adjust_factor'
  WHEN gcs_uri LIKE '%money_flow%' OR gcs_uri LIKE '%资金流%' THEN 'money_flow' ELSE 'unknown' END AS kind FROM (SELECT DISTINCT gcs_uri FROM ods_gcs_load_manifest WHERE gcs_uri IS NOT NULL)""")
def path_kind(spark: SparkSession, d: str) -> DataFrame:
    """The kind of table that a path tells, by an ordered list of words."""
    rules = {"kline": ["kline", "daily", "复权"], "adjust_factor": ["factor", "复权因子"], "money_flow": ["money_flow", "资金流"]}
    return table(spark, d, "ods_gcs_load_manifest").where("gcs_uri IS NOT NULL").select("gcs_uri").distinct().withColumn("kind", classify_path(F.col("gcs_uri"), rules))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
