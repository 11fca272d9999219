"""Ratios of statements, and prices joined to several kinds of statements as they were known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.windows import ratio
from tapeloom.operators.known_at import known_at
from tapeloom.session import materialize


def statement_ratios() -> dict[str, Column]:
    """Valuation and quality from a close and the columns of income and balance statements; null where a part is missing or zero."""
    c = F.col
    return {
        "pe_basic": ratio(c("close"), c("eps_basic")),
        "pb": ratio(c("close"), c("bps")),
        "market_cap": c("close") * c("total_share"),
        "gross_margin_from_income": ratio(c("total_revenue") - c("operating_cost"), c("total_revenue")),
        "net_margin_from_income": ratio(c("parent_net_profit"), c("total_revenue")),
        "debt_to_assets_from_balance": ratio(c("total_liabilities"), c("total_assets")),
        "current_ratio_from_balance": ratio(c("current_assets"), c("current_liabilities")),
        "asset_turnover_from_income_balance": ratio(c("total_revenue"), c("total_assets")),
    }


def known_statements(prices: DataFrame, kinds: dict[str, tuple[DataFrame, list[str]]], entity: str, date: str, since: str, period: str) -> DataFrame:
    """``prices`` with the values of every kind of statement that was the latest known on each date, and ``<kind>_date``, its day.

    ``kinds``: a table (entity, since, period, values) and its value columns for each kind. Version numbers are worked out for the distinct
    moments of ``prices``, which are written once, and each kind meets the prices in an equi-join; rows for which no kind had anything are
    left out. Of one day the statement of the greatest period counts. Value columns must have names of their own.
    """
    moments = materialize(prices.select(entity, date).distinct(), "moments")
    out = prices
    for kind, (table, values) in kinds.items():
        narrow = table.select(entity, F.col(since).alias(f"{kind}_date"), F.col(period).alias(f"__{kind}"), *values)
        known = known_at(moments, narrow, entity, date, f"{kind}_date", F.col(f"__{kind}")).drop(f"__{kind}")
        out = out.join(known, [entity, date], "left")
    return out.where(" OR ".join(f"`{k}_date` IS NOT NULL" for k in kinds))
