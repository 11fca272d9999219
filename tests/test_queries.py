"""Every query of the core against its SQL on the smallest tables; those without SQL must run."""

import pytest

from tapeloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(name, compare):
    compare(QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, data):
    df = QUERIES[name](spark, data)
    assert len(df.columns) == len(set(df.columns))
    df.collect()


def test_sql_names_queries():
    assert set(SQL) <= set(QUERIES)
