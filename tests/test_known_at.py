import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapeloom.operators.known_at import known_at

D0 = dt.date(2020, 1, 1)
EVENTS, ATTRS = "code string, date date, note string", "code string, ann date, period string, v double"


def brute(events, attrs):
    out = []
    for e in events:
        rows = [a for a in attrs if a[0] is not None and a[1] is not None and a[0] == e[0] and e[1] is not None and a[1] <= e[1]]
        if rows:
            day = max(a[1] for a in rows)
            best = max((a for a in rows if a[1] == day), key=lambda a: (a[2] is not None, a[2] or "", a[3] is not None, a[3] or 0))
            out.append((*e, *best[1:]))
    return sorted(out, key=repr)


def run(spark, events, attrs, **kw):
    df = known_at(spark.createDataFrame(events, EVENTS), spark.createDataFrame(attrs, ATTRS), "code", "date", "ann", F.col("period"), **kw)
    assert df.columns == ["code", "date", "note", "ann", "period", "v"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 7, 512])
def test_against_brute_force(spark, block):
    rnd = random.Random(block)
    day = lambda: rnd.choice([None, *[D0 + dt.timedelta(days=rnd.randrange(60)) for _ in range(9)]])
    code = lambda: rnd.choice(["a", "a", "a", "b", None])
    events = [(code(), day(), rnd.choice(["x", None])) for _ in range(200)]
    attrs = [(code(), day(), rnd.choice(["1", "2", None]), rnd.choice([1.0, None])) for _ in range(60)]
    assert run(spark, events, attrs, block_days=block) == brute(events, attrs)


def test_same_day_and_repeats(spark):
    events = [("a", D0, "x"), ("a", D0, "x"), ("a", D0 - dt.timedelta(days=1), "y")]
    assert run(spark, events, [("a", D0, "1", 1.0), ("a", D0, "2", None)]) == [("a", D0, "x", D0, "2", None)] * 2


def test_empty(spark):
    assert run(spark, [], [("a", D0, "1", 1.0)]) == []
    assert run(spark, [("a", D0, "x")], []) == []


def test_clashing_names(spark):
    events = spark.createDataFrame([("a", D0, 1, 2)], "code string, date date, v int, __known_row int")
    attrs = spark.createDataFrame([("a", D0, 3.0, "n")], "code string, ann date, v double, date string")
    df = known_at(events, attrs, "code", "date", "ann", F.col("v"))
    assert df.columns == ["code", "date", "v", "__known_row", "ann", "v_known", "date_known"]
    assert [tuple(r) for r in df.collect()] == [("a", D0, 1, 2, D0, 3.0, "n")]
