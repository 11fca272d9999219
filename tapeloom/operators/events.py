"""Money-flow, seat and board events reduced to a row a code and date, and the score that ranks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.windows import ratio

KEY = ["equity_code", "date"]


def _by_key(facts: DataFrame):
    return facts.where("equity_code IS NOT NULL AND date IS NOT NULL").groupBy(*KEY)


def event_features(money: DataFrame, seats: DataFrame, boards: DataFrame) -> DataFrame:
    """One row for each code and date that any of the three has.

    ``money``: net_inflow_amount, main_net_inflow_amount, extra_large_net_inflow_amount; ``seats``: buy_amount, sell_amount, net_amount,
    department_name; ``boards``: limit_up_streak, main_net_amount, limit_up_reason, tags, board_names. Each is aggregated by key on the map
    side before the three meet in full joins on the key, so the spine of keys is their union. Of texts the least one is kept.
    """
    total = lambda c: F.sum(F.col(c).cast("double"))
    m = _by_key(money).agg(*[total(c).alias(c) for c in ("net_inflow_amount", "main_net_inflow_amount", "extra_large_net_inflow_amount")])
    s = _by_key(seats).agg(
        *[total(f"{c}_amount").alias(f"dragon_tiger_{c}_amount") for c in ("buy", "sell", "net")],
        F.count(F.lit(1)).alias("dragon_tiger_row_count"), F.count_distinct("department_name").alias("dragon_tiger_department_count"),
    )
    b = _by_key(boards).agg(
        F.lit(True).alias("is_kpl_event"), F.max(F.col("limit_up_streak").cast("double")).alias("limit_up_streak"), total("main_net_amount").alias("kpl_main_net_amount"),
        *[F.min(c).alias(c) for c in ("limit_up_reason", "tags", "board_names")],
    )
    month = (F.year("date") * 100 + F.month("date")).cast("bigint")
    joined = m.join(s, KEY, "full").join(b, KEY, "full")
    return joined.withColumn("is_kpl_event", F.coalesce("is_kpl_event", F.lit(False))).withColumn("partition_month", month)


def event_score() -> Column:
    """Net, main and extra-large inflow, seats' net amount, days in a row at the limit, and a board event at all; missing parts count 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    flow = zero("net_inflow_amount") + 0.5 * zero("main_net_inflow_amount") + 0.5 * zero("extra_large_net_inflow_amount")
    return flow + zero("dragon_tiger_net_amount") / 10000.0 + 1000.0 * zero("limit_up_streak") + F.when(F.col("is_kpl_event"), 500.0).otherwise(0.0)


def event_signal(features: DataFrame, top_n: int = 100, digits: int = 6) -> DataFrame:
    """Every row with score_proxy, its score_rank on the date (ties by code), top_n, is_selected and signal."""
    scored = features.withColumn("score_proxy", F.round(event_score(), digits))
    rank = F.row_number().over(Window.partitionBy("date").orderBy(F.desc("score_proxy"), "equity_code")).cast("bigint")
    ranked = scored.withColumn("score_rank", rank).withColumn("top_n", F.lit(top_n).cast("bigint"))
    return ranked.withColumn("is_selected", F.col("score_rank") <= F.col("top_n")).withColumn("signal", F.col("is_selected").cast("int"))


def event_ratios() -> dict[str, Column]:
    """Flows of an event row as shares of the day's ``amount``, and the flags of its board event, missing ones as 0."""
    return {
        "net_inflow_to_amount": ratio(F.col("net_inflow_amount"), F.col("amount")),
        "main_net_inflow_to_amount": ratio(F.col("main_net_inflow_amount"), F.col("amount")),
        "dragon_tiger_net_to_amount": ratio(F.col("dragon_tiger_net_amount"), F.col("amount")),
        "dragon_tiger_department_count": F.col("dragon_tiger_department_count").cast("double"),
        "limit_up_streak": F.coalesce(F.col("limit_up_streak"), F.lit(0.0)),
        "is_kpl_event": F.when(F.col("is_kpl_event"), 1.0).otherwise(0.0),
    }
