import datetime as dt
import random

import pytest

from tapeloom.operators.trailing import trailing_totals

D0 = dt.date(2020, 1, 1)
SCHEMA = "code string, date date, x double"


@pytest.mark.parametrize("span", [1, 2, 7, 30])
def test_against_brute_force(spark, span):
    rnd = random.Random(span)
    rows = [(c, D0 + dt.timedelta(days=k), rnd.choice([None, 0.0, 1.5, -2.0])) for c in "abc" for k in sorted(rnd.sample(range(100), rnd.choice([1, 5, 40])))]
    got = {(r[0], r[1]): r for r in trailing_totals(spark.createDataFrame(rows, SCHEMA), "code", "date", ["x"], [span]).collect()}
    have = {(c, day): x for c, day, x in rows}
    want = {}
    for c in "abc":
        days = [day for k, day in have if k == c]
        day = min(days)
        while day <= max(days):
            window = [have.get((c, day - dt.timedelta(days=k))) for k in range(span)]
            want[c, day] = (sum(x or 0 for x in window), sum(x is not None for x in window), min(span, (day - min(days)).days + 1))
            day += dt.timedelta(days=1)
    assert {k: (r[f"x_sum_{span}d"], r[f"x_n_{span}d"], r[f"days_{span}d"]) for k, r in got.items()} == want


def test_nulls_and_empty(spark):
    rows = [(None, D0, 1.0), ("a", None, 1.0)]
    assert trailing_totals(spark.createDataFrame(rows, SCHEMA), "code", "date", ["x"], [7]).collect() == []
    assert trailing_totals(spark.createDataFrame([], SCHEMA), "code", "date", ["x"], [7]).collect() == []


def test_extra_columns_are_not_read(spark):
    df = spark.createDataFrame([("a", D0, 1.0, 5, "z")], "code string, date date, x double, x_sum_7d int, __no string")
    out = trailing_totals(df, "code", "date", ["x"], [7])
    assert out.columns == ["code", "date", "x", "x_sum_7d", "x_n_7d", "days_7d"] and out.first()["x_sum_7d"] == 1.0
