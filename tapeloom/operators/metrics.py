"""Value series and trades: returns, drawdowns, monthly matrix, first-in first-out pairing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.windows import drawdown, ratio
from tapeloom.session import materialize


def value_series(nav: DataFrame) -> DataFrame:
    """(date, nav, returns, cumulative, drawdown) of a series (date, nav); one series is one window partition, a row a date."""
    w = Window.partitionBy(F.lit(0)).orderBy("date")
    first = F.first("nav").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return nav.select("date", "nav", (ratio(F.col("nav"), F.lag("nav").over(w)) - 1).alias("returns"), (ratio(F.col("nav"), first) - 1).alias("cumulative"), drawdown(F.col("nav"), w).alias("drawdown"))


def performance(series: DataFrame, per_year: int = 252, free: float = 0.02) -> DataFrame:
    """One row: days, total and annual return, volatility, Sharpe and Sortino ratio, greatest drawdown of a :func:`value_series`."""
    r, daily_free = F.col("returns"), free / per_year
    total = F.max_by("cumulative", "date")
    agg = series.agg(
        F.count(r).alias("n"), total.alias("total_return"), F.stddev_samp(r).alias("std"), F.avg(r).alias("mean"), F.stddev_samp(F.when(r < 0, r)).alias("down"), F.min("drawdown").alias("max_drawdown")
    )
    annual = F.when((F.col("n") > 0) & (F.col("total_return") > -1), F.pow(1 + F.col("total_return"), F.lit(float(per_year)) / F.col("n")) - 1)
    root = F.sqrt(F.lit(float(per_year)))
    return agg.select(
        "n", "total_return", annual.alias("annual_return"), (F.col("std") * root).alias("volatility"),
        ratio((F.col("mean") - daily_free) * per_year, F.col("std") * root).alias("sharpe"), ratio(F.col("mean") * per_year, F.col("down") * root).alias("sortino"), "max_drawdown",
    )


def monthly_returns(series: DataFrame) -> DataFrame:
    """(year, m01 .. m12): compounded return of each month."""
    month = F.lpad(F.month("date").cast("string"), 2, "0")
    monthly = series.where("returns IS NOT NULL").groupBy(F.year("date").cast("bigint").alias("year"), F.concat(F.lit("m"), month).alias("month")).agg((F.exp(F.sum(F.log1p("returns"))) - 1).alias("r"))
    return monthly.groupBy("year").pivot("month", [f"m{m:02d}" for m in range(1, 13)]).agg(F.first("r"))


def against_benchmark(series: DataFrame, benchmark: DataFrame, per_year: int = 252, free: float = 0.02, least: int = 20) -> DataFrame:
    """One row: aligned dates, benchmark and excess return, days from the peak before the worst drawdown to its recovery (or the end),
    beta, alpha and information ratio of a :func:`value_series` against a benchmark (date, close).

    Returns are aligned by date; under ``least`` aligned dates beta, alpha and information ratio are null. The excess is the annual return
    less the benchmark's whole return, as the definitions of alpha and information ratio here have it.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("date")
    other = benchmark.select("date", (ratio(F.col("close"), F.lag("close").over(w)) - 1).alias("__y"))
    both = series.select("date", F.col("returns").alias("__x")).join(other, "date").where("__x IS NOT NULL AND __y IS NOT NULL")
    pair = both.agg(F.count(F.lit(1)).alias("aligned"), F.covar_samp("__x", "__y").alias("cov"), F.var_samp("__y").alias("var"), F.stddev_samp(F.col("__x") - F.col("__y")).alias("te"))
    bench = (benchmark.agg(ratio(F.max_by("close", "date"), F.min_by("close", "date")) - 1)).scalar()
    own = performance(series, per_year, free).select("annual_return").scalar()
    low = series.agg(F.min_by("date", F.struct("drawdown", "date"))).scalar()
    until = series.where(F.col("date") <= low)
    top = until.agg(F.max_by("date", F.struct(F.col("nav"), -F.unix_date("date")))).scalar()
    back = series.where((F.col("date") >= low) & (F.col("nav") >= until.agg(F.max("nav")).scalar())).agg(F.min("date")).scalar()
    duration = F.date_diff(F.coalesce(back, series.agg(F.max("date")).scalar()), top).cast("bigint")
    enough = lambda c: F.when(F.col("aligned") >= least, c)
    named = pair.select("aligned", "cov", "var", "te", bench.alias("benchmark_return"), (own - bench).alias("excess_return"), own.alias("own"), duration.alias("max_drawdown_duration"))
    beta = enough(ratio(F.col("cov"), F.col("var")))
    return named.select(
        "aligned", "benchmark_return", "excess_return", "max_drawdown_duration", beta.alias("beta"), (F.col("own") - (free + beta * (F.col("benchmark_return") - free))).alias("alpha"),
        enough(ratio(F.col("excess_return"), F.col("te") * F.sqrt(F.lit(float(per_year))))).alias("information_ratio"),
    )


def to_date(benchmark: DataFrame) -> DataFrame:
    """(date, benchmark_return, max_drawdown): return since the start and worst drawdown up to each date of (date, close)."""
    w = Window.partitionBy(F.lit(0)).orderBy("date")
    far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = benchmark.select("date", (ratio(F.col("close"), F.first("close").over(far)) - 1).alias("benchmark_return"), drawdown(F.col("close"), w).alias("__d"))
    return df.select("date", "benchmark_return", F.min("__d").over(far).alias("max_drawdown"))


def trade_statistics(pairs: DataFrame) -> DataFrame:
    """One row: matches, share of those with a profit, and profits over losses: infinite without losses, 0 without either."""
    won, lost = F.coalesce(F.sum(F.when(F.col("profit") > 0, F.col("profit"))), F.lit(0.0)), F.coalesce(-F.sum(F.when(F.col("profit") < 0, F.col("profit"))), F.lit(0.0))
    agg = pairs.agg(F.count(F.lit(1)).alias("total_trades"), F.count_if(F.col("profit") > 0).alias("__w"), won.alias("__won"), lost.alias("__lost"))
    share = F.when(F.col("__lost") > 0, F.col("__won") / F.col("__lost")).when(F.col("__won") > 0, float("inf")).otherwise(0.0)
    return agg.select("total_trades", F.coalesce(F.try_divide(F.col("__w").cast("double"), F.col("total_trades").cast("double")), F.lit(0.0)).alias("win_rate"), share.alias("profit_loss_ratio"))


def verdict(row: DataFrame) -> DataFrame:
    """``row`` with a one-word ``verdict`` from total_return, sharpe and max_drawdown."""
    good = (F.col("total_return") > 0) & (F.col("sharpe") >= 1) & (F.col("max_drawdown") > -0.2)
    return row.withColumn("verdict", F.when(good, "good").when(F.col("total_return") > 0, "fair").otherwise("poor"))


#: Rows of trades, or marks, in one block of a group.
BLOCK_ROWS = 1_000_000


def _blocks(df: DataFrame, order: list[str], block_rows: int) -> tuple[DataFrame, bool]:
    """``df`` with ``__block``, in the order of ``order`` (whose first column is the group), and whether there is more than one block.

    Blocks are ranges of the whole order, so a group with any share of all rows is cut into as many as it needs. The blocks are written
    before they are numbered for good, as they are read more than once.
    """
    parts = -(-df.count() // block_rows)
    if parts <= 1:
        return df.withColumn("__block", F.lit(0)), False
    return materialize(df.repartitionByRange(parts, *order).withColumn("__block", F.spark_partition_id()), "fifo-blocks"), True


def _carried(df: DataFrame, cut: bool, totals: dict, carry: dict, empty: dict) -> DataFrame:
    """``df`` (__g, __block) with what the other blocks of its group give: ``totals`` are aggregates of a block, ``carry`` columns over the
    blocks of a group in order; ``empty`` are their values where a group has one block only."""
    if not cut:
        return df.withColumns(empty)
    blocks = df.groupBy("__g", "__block").agg(*[c.alias(n) for n, c in totals.items()])
    side = blocks.select(F.col("__g").alias("__of"), F.col("__block").alias("__at"), *[c.alias(n) for n, c in carry.items()])
    return df.join(side, F.col("__g").eqNullSafe(F.col("__of")) & (F.col("__block") == F.col("__at")), "left").drop("__of", "__at").withColumns({n: F.coalesce(F.col(n), empty[n]) for n in carry})


def fifo_pairs(trades: DataFrame, group: str, order: list[str], side: str, quantity: str, price: str, fee: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(group, matched, buy_price, sell_price, profit): quantities bought and sold paired first in, first out, a row for each match.

    ``side`` is ``buy`` or ``sell``; what is sold beyond what is held at the time matches nothing; ``fee`` is a cost a piece, of both sides
    of a match. Bought and sold quantities are laid on one axis by their running totals, as decimals, so that fractions add up exactly;
    between two marks next to each other lies one bought and one sold lot, so matches come from sorts and windows, without pairing lots
    with each other. Windows never hold more than a block of ``block_rows`` trades or marks: running totals, lows and the next prices are
    carried from block to block over one row a block. Rows of no or negative quantity, of other sides and of null quantities are left out.
    """
    exact, zero = "decimal(28,9)", F.lit(0).cast("decimal(38,9)")
    cost = F.coalesce(F.col(fee).cast("double"), F.lit(0.0)) if fee else F.lit(0.0)
    rows = trades.where((F.col(quantity) > 0) & F.col(side).isin("buy", "sell")).select(
        F.col(group).alias("__g"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], (F.col(side) == "buy").alias("__buy"), F.col(quantity).cast(exact).alias("__n"), F.col(price).alias("__p"), cost.alias("__f")
    )
    sorted_by = [f"__o{i}" for i in range(len(order))]
    rows, cut = _blocks(rows, ["__g", *sorted_by], block_rows)
    w = Window.partitionBy("__g", "__block").orderBy(*sorted_by)
    far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = Window.partitionBy("__g").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    # what is held, and the lowest it ever was: below zero it is what was sold without being held
    signed = F.when(F.col("__buy"), F.col("__n")).otherwise(-F.col("__n"))
    rows = rows.withColumn("__run", F.sum(signed).over(far).cast("decimal(38,9)"))
    rows = _carried(rows, cut, {"__sum": F.sum(signed)}, {"__from": F.sum("__sum").over(over).cast("decimal(38,9)")}, {"__from": zero})
    rows = _carried(rows, cut, {"__low": F.min(F.col("__from") + F.col("__run"))}, {"__least": F.least(zero, F.min("__low").over(over))}, {"__least": zero})
    short = F.greatest(zero, -F.least(F.col("__least"), F.col("__from") + F.min("__run").over(far)))
    rows = rows.withColumn("__short", short.cast("decimal(38,9)"))
    lost = F.col("__short") - F.coalesce(F.lag("__short").over(w), F.greatest(zero, -F.col("__least")))
    rows = rows.withColumn("__q", F.when(F.col("__buy"), F.col("__n")).otherwise(F.col("__n") - lost).cast("decimal(38,9)")).where(F.col("__q") > 0).drop("__from", "__least", "__short", "__run")
    # where each lot ends on the axis of its side
    own = Window.partitionBy("__g", "__block", "__buy").orderBy(*sorted_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bought, sold = F.when(F.col("__buy"), F.col("__q")).otherwise(zero), F.when(F.col("__buy"), zero).otherwise(F.col("__q"))
    sums = {n: F.sum(F.col(t)).over(over).cast("decimal(38,9)") for n, t in (("__b0", "__bs"), ("__s0", "__ss"))}
    rows = _carried(rows, cut, {"__bs": F.sum(bought), "__ss": F.sum(sold)}, sums, {"__b0": zero, "__s0": zero})
    ended = (F.sum("__q").over(own) + F.when(F.col("__buy"), F.col("__b0")).otherwise(F.col("__s0"))).cast("decimal(38,9)")
    lot = lambda buy: F.max(F.when(F.col("__buy") == buy, F.struct("__p", "__f")))
    marks = rows.withColumn("__end", ended).groupBy("__g", "__end").agg(lot(True).alias("__b"), lot(False).alias("__s"))
    marks, cut = _blocks(marks, ["__g", "__end"], block_rows)
    axis = Window.partitionBy("__g", "__block").orderBy("__end")
    ahead = axis.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    after = Window.partitionBy("__g").orderBy("__block").rowsBetween(1, Window.unboundedFollowing)
    none = F.lit(None).cast(marks.schema["__b"].dataType)
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__end")))
    marks = _carried(
        marks, cut, {"__top": F.max("__end"), "__fb": first("__b"), "__fs": first("__s")},
        {"__e0": F.max("__top").over(over), "__nb": F.first("__fb", ignorenulls=True).over(after), "__ns": F.first("__fs", ignorenulls=True).over(after)}, {"__e0": zero, "__nb": none, "__ns": none},
    )
    lots = marks.select(
        F.col("__g").alias(group), (F.col("__end") - F.coalesce(F.lag("__end").over(axis), F.col("__e0"))).cast("double").alias("matched"),
        F.coalesce(F.first("__b", ignorenulls=True).over(ahead), F.col("__nb")).alias("b"), F.coalesce(F.first("__s", ignorenulls=True).over(ahead), F.col("__ns")).alias("s"),
    ).where("b IS NOT NULL AND s IS NOT NULL")
    profit = F.col("matched") * (F.col("s.__p") - F.col("b.__p") - F.col("b.__f") - F.col("s.__f"))
    return lots.select(group, "matched", F.col("b.__p").alias("buy_price"), F.col("s.__p").alias("sell_price"), profit.alias("profit"))
