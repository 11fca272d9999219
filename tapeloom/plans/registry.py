"""All queries of the library, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeloom.plans import prepared, reference, reference_learning, reference_store

_MODULES = (prepared, reference, reference_learning, reference_store)
FLAGSHIP = "daily_features_technical"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in _MODULES for name, query in module.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.oracle_sql().items()}
