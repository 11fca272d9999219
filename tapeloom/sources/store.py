"""Reading the layered tables by code, range, adjust type and date: one source for bars, lists, features and candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions.codes import equity_code, yyyymmdd
from tapeloom.operators.bars import bars, latest_by_lineage, resample_bars
from tapeloom.operators.events import event_ratios
from tapeloom.operators.upsert import keep_last
from tapeloom.session import table

# Code prefixes of the asset kinds, and the daily table of each kind.
INDEX_PREFIXES = {("SH", "CSI"): ("000", "930", "932", "950"), ("SZ",): ("399",)}
FUND_PREFIXES = {("SH",): ("51", "56", "58", "11"), ("SZ",): ("15", "16")}
DAILY_TABLES = {"index": "dwd_fact_index_kline_1d", "fund": "dwd_fact_fund_kline_1d", "equity": "dwd_fact_equity_kline_1d"}
TECHNICAL = [
    "return_1d", "return_5d", "return_10d", "return_20d", "volume_ma5_ratio", "volume_ma20_ratio", "amount_ma5_ratio", "std_5d", "std_20d", "std_ratio", "rsi_14",
    "macd_diff", "macd_signal", "macd_hist", "close_to_high_20d", "close_to_ma5", "close_to_ma20",
]
FUNDAMENTAL = ["pe_basic", "pb", "roe", "gross_margin", "net_margin", "debt_to_assets", "current_ratio", "asset_turnover"]


def months_between(start: str, end: str) -> list[int]:
    """The months YYYYMM from one date YYYYMMDD to another; none if they are in reverse order. Shorter texts raise ValueError."""
    if min(len(start), len(end)) < 6:
        raise ValueError(f"dates must be YYYYMMDD: {start}, {end}")
    first, last = (int(x[:4]) * 12 + int(x[4:6]) - 1 for x in (start, end))
    return [m // 12 * 100 + m % 12 + 1 for m in range(first, last + 1)]


def _day(text: str) -> Column:
    digits = text.replace("-", "").replace("/", "")
    return F.lit(f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}").cast("date")


def in_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """The rows of a date range. The months of the range are a predicate of their own beside it, so a table that is laid out by
    ``partition_month`` reads those months only; rows without a month are kept to their date."""
    months = F.col("partition_month").isin(months_between(start.replace("-", ""), end.replace("-", ""))) | F.col("partition_month").isNull()
    return df.where(F.col("date").between(_day(start), _day(end)) & months)


def asset_kind(code: Column) -> Column:
    """``index``, ``fund`` or ``equity`` of a normalised code, by its prefix and exchange."""
    def of(table: dict) -> Column:
        hit = F.lit(False)
        for exchanges, prefixes in table.items():
            hit = hit | (F.split_part(code, F.lit("."), F.lit(2)).isin(list(exchanges)) & code.rlike("^(" + "|".join(prefixes) + ")"))
        return hit

    return F.when(of(INDEX_PREFIXES), "index").when(of(FUND_PREFIXES), "fund").otherwise("equity")


class Store:
    """The tables of one folder. All results are lazy; ``codes`` of a few hundred become a list in the plan, a DataFrame a semi-join."""

    def __init__(self, spark: SparkSession, folder: str, tables: dict[str, str] | None = None):
        self.spark, self.folder, self.tables = spark, folder, {**DAILY_TABLES, **(tables or {})}

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, self.tables.get(name, name))

    def _of(self, df: DataFrame, codes: list[str] | DataFrame | None, column: str = "code") -> DataFrame:
        if codes is None:
            return df
        if isinstance(codes, DataFrame):
            return df.join(codes.select(equity_code(F.col(codes.columns[0])).alias(column)), column, "left_semi")
        return df.where(F.col(column).isin(list(dict.fromkeys(codes))))

    def bars(self, codes: list[str] | DataFrame | None, start: str, end: str, adjust: str = "qfq", period: str = "day", kind: str = "equity") -> DataFrame:
        """(code, date, open .. amount) of codes in a range, by code and date; ``adjust`` is qfq, hfq or none, ``period`` day, week or
        month. Codes without bars are left out. Codes are in normal form."""
        rows = in_range(self.table(kind), start, end)
        daily = self._of(bars(rows, adjust), codes)
        if period == "day":
            return daily.orderBy("code", "date")
        return resample_bars(daily, period).withColumnRenamed("period_start", "date").orderBy("code", "date")

    def stock_list(self, as_of: str | None = None, inactive: bool = False) -> DataFrame:
        """(code, name, list_date, delist_date) listed on a date: listed by then or of unknown listing, not delisted by then; without a
        date the active ones. ``inactive`` keeps all. Repeated rows take the first in lineage order."""
        dim = latest_by_lineage(self.table("dwd_dim_security").withColumn("code", equity_code(F.col("security_code"))), ["code"], ["security_name", "list_date", "delist_date", "is_active"])
        if not inactive:
            day = _day(as_of) if as_of else None
            dim = dim.where("is_active") if day is None else dim.where((F.col("list_date").isNull() | (F.col("list_date") <= day)) & (F.col("delist_date").isNull() | (F.col("delist_date") > day)))
        return dim.select("code", F.col("security_name").alias("name"), "list_date", "delist_date").orderBy("code")

    def names(self) -> DataFrame:
        """The distinct (code, name) of the securities."""
        return self.table("dwd_dim_security").select(equity_code(F.col("security_code")).alias("code"), F.col("security_name").alias("name")).distinct()

    def features(self, codes: list[str] | DataFrame | None, daily: DataFrame, fundamental: DataFrame | None = None, events: DataFrame | None = None) -> DataFrame:
        """Technical features (code, date, ...) of codes, and the enhanced set where statements and events by code and date are given."""
        out = self._of(daily, codes)
        if fundamental is not None:
            have = [c for c in FUNDAMENTAL if c in fundamental.columns]
            cap = [F.ln(F.greatest(F.coalesce(F.col("market_cap"), F.lit(0.0)), F.lit(1.0))).alias("market_cap_log")] if "market_cap" in fundamental.columns else []
            out = out.join(fundamental.select("code", "date", *have, *cap), ["code", "date"], "left")
        if events is not None:
            out = out.join(events.withColumnRenamed("equity_code", "code").drop("partition_month"), ["code", "date"], "left").withColumns(event_ratios())
        kept = ["code", "date", "close", *[c for c in (*TECHNICAL, *FUNDAMENTAL, "market_cap_log", *event_ratios()) if c in out.columns]]
        return out.select(*kept)

    def candidates(self, start: str = "", end: str = "", pool: int = 10, name: str = "ads_signal_ml_stock_picker_bqml_1d", known: bool = True) -> DataFrame:
        """(date, equity_code, prob_up, score_rank) of the selected rows of rank ``pool`` or better, by date and rank. ``known`` keeps those
        whose code has a name among the securities; the outer join to them then is an inner one, as the optimizer sees."""
        a = self.table(name).where(F.col("is_selected") & (F.col("score_rank") <= max(int(pool), 1)))
        if start:
            a = a.where(F.col("date") >= _day(start))
        if end:
            a = a.where(F.col("date") <= _day(end))
        a = a.withColumn("equity_code", equity_code(F.col("equity_code")))
        if known:
            s = self.table("dwd_dim_security").where("security_name IS NOT NULL").select(equity_code(F.col("security_code")).alias("equity_code")).distinct()
            a = a.join(s, "equity_code", "left_semi")
        return a.select(yyyymmdd(F.col("date")).alias("date"), "equity_code", "prob_up", "score_rank").orderBy("date", "score_rank", "equity_code")


def labelled(features: DataFrame, start: str, end: str, horizon: int = 5) -> DataFrame:
    """``features`` (code, date, close, ...) of a range with label_return, the log return ``horizon`` rows on: counted over the rows with a
    positive close, up to max(4 x horizon + 20, 30) days after the range, before it is cut to the range."""
    last = F.date_add(_day(end), max(4 * horizon + 20, 30))
    ok = features.where(F.col("date").between(_day(start), last) & (F.col("close") > 0))
    ahead = F.lead("close", horizon).over(Window.partitionBy("code").orderBy("date"))
    return ok.withColumn("label_return", F.ln(ahead) - F.ln("close")).where(F.col("date") <= _day(end))


def remember(spark: SparkSession, folder: str, name: str, fresh: DataFrame) -> DataFrame:
    """Keep bars (code, date, ...) under a name in a folder: what is there and ``fresh`` together, of equal code and date the fresh ones."""
    path = f"{folder}/{name}"
    try:
        old = spark.read.parquet(path)
    except Exception:  # noqa: BLE001 - nothing kept yet
        old = None
    both = fresh if old is None else keep_last(old, fresh, ["code", "date"])
    both.write.mode("overwrite").parquet(f"{path}.new")
    spark.read.parquet(f"{path}.new").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def covers(kept: DataFrame, start: str, end: str) -> bool:
    """Whether kept bars reach from the first to the last date asked for."""
    lo, hi = kept.agg(F.min("date") <= _day(start), F.max("date") >= _day(end)).first()
    return bool(lo and hi)


def intraday(daily: DataFrame, minutes: int = 5) -> DataFrame:
    """(code, time, open, high, low, close, volume, amount): made-up bars within each day of 4 hours (9:30 to 11:30, 13:00 to 15:00).

    A walk by hashed noise from the day's open to its close, kept between its low and high; volume and amount in equal parts. The noise
    comes from code, date and place, so that the same bars come out on every run.
    """
    n = 240 // minutes
    noise = F.pmod(F.xxhash64("code", "date", F.col("k")), F.lit(10_001)) / 10_000.0 - 0.5
    steps = daily.where("open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n))))
    straight = F.col("open") + (F.col("close") - F.col("open")) * F.col("k") / n
    swing = F.when(F.col("k") < n, noise * (F.col("high") - F.col("low"))).otherwise(0.0)
    priced = steps.withColumn("price", F.greatest(F.col("low"), F.least(F.col("high"), straight + swing)))
    before = F.lag("price").over(Window.partitionBy("code", "date").orderBy("k"))
    minute = F.when(F.col("k") * minutes <= 120, 570 + F.col("k") * minutes).otherwise(780 + F.col("k") * minutes - 120)
    opened = F.coalesce(before, F.col("open"))
    at = F.timestamp_seconds(F.unix_date("date").cast("bigint") * 86400 + minute * 60).cast("timestamp_ntz")
    return priced.select("code", at.alias("time"), opened.alias("open"), F.greatest(opened, "price").alias("high"), F.least(opened, "price").alias("low"), F.col("price").alias("close"), (F.col("volume") / n).alias("volume"), (F.col("amount") / n).alias("amount"))
