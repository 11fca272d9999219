import random

import pytest
from pyspark.sql import functions as F

from tapeloom.llm.topn import top_n

SCHEMA = "g string, score double, id int, payload map<string,int>"


def brute(rows, n):
    out = []
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is not None, r[2] or 0))
        out += [(*r[:3], i) for i, r in enumerate(own[:n], 1)]
    return sorted(out, key=repr)


def run(spark, rows, n, **kw):
    df = top_n(spark.createDataFrame(rows, SCHEMA), ["g"], [F.col("score").desc_nulls_last()], n, **kw)
    return sorted(((r["g"], r["score"], r["id"], r["place"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("hot", [5, 100, 10**6])
@pytest.mark.parametrize("n", [1, 3, 40])
def test_same_at_every_threshold(spark, hot, n):
    rnd = random.Random(n)
    rows = [(rnd.choice(["hot"] * 8 + ["a", "b", None]), rnd.choice([None, 1.0, 2.0, 3.0, -1.0]), rnd.choice([None, *range(30)]), None) for _ in range(400)]
    assert run(spark, rows, n, hot_rows=hot) == brute(rows, n)


def test_line_follows_from_the_data(spark):
    rows = [("hot", float(i % 7), i, None) for i in range(300)] + [(f"g{i}", float(i % 3), i, None) for i in range(400)]
    assert run(spark, rows, 4) == brute(rows, 4)
    plan = top_n(spark.createDataFrame(rows, SCHEMA), ["g"], [F.col("score").desc()], 4)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "LeftAnti" in plan and "LeftSemi" in plan
    even = spark.createDataFrame([(f"g{i}", 1.0, i, None) for i in range(1000)], SCHEMA)
    assert "rangepartitioning" not in top_n(even, ["g"], [F.col("score").desc()], 4)._jdf.queryExecution().executedPlan().toString()


def test_empty_copies_and_small_n(spark):
    assert run(spark, [], 3) == []
    assert run(spark, [("a", 1.0, 1, None)] * 3, 2) == [("a", 1.0, 1, 1), ("a", 1.0, 1, 2)]
    assert run(spark, [("a", 1.0, 1, None)], 0) == []


def test_clashing_names(spark):
    df = spark.createDataFrame([("a", 1.0, 7, 8), ("a", 2.0, 9, 6)], "g string, score double, place int, __topn_n int")
    out = top_n(df, ["g"], [F.col("place").desc()], 1, hot_rows=1)
    assert out.columns == ["g", "score", "place_in", "__topn_n", "place"] and [tuple(r) for r in out.collect()] == [("a", 2.0, 9, 6, 1)]


def test_heavy_groups_are_salted(spark):
    df = spark.createDataFrame([("a", float(i), i, None) for i in range(1000)], SCHEMA)
    plan = top_n(df, ["g"], [F.col("score").desc()], 2, hot_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "WindowGroupLimit" in plan
