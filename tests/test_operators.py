"""Operators against plain Python: trade pairing, time joins, windows, upserts, labels, statistics."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeloom.functions import windows
from tapeloom.functions.codes import equity_code, index_code
from tapeloom.operators import features, labels, metrics, stats, temporal, upsert
from tapeloom.operators.bars import apply_factors, latest_by_lineage

D0 = dt.date(2024, 1, 1)
QUIET = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def fifo(trades):
    queue, out = [], []
    for side, q, p in trades:
        if side == "buy":
            queue.append([q, p])
            continue
        while q > 0 and queue:
            m = min(q, queue[0][0])
            out.append((m, queue[0][1], p))
            queue[0][0] -= m
            q -= m
            if not queue[0][0]:
                queue.pop(0)
    return sorted(out)


@QUIET
@given(st.lists(st.tuples(st.sampled_from(["buy", "sell"]), st.integers(1, 9), st.integers(1, 50)), min_size=1, max_size=40))
def test_fifo_equals_a_queue(spark, trades):
    rows = [("a", i, s, float(q), float(p)) for i, (s, q, p) in enumerate(trades)] + [("b", 0, "sell", 5.0, 1.0), ("c", 0, "buy", 5.0, 1.0), ("a", 99, "hold", 5.0, 1.0), ("a", 100, "buy", 0.0, 1.0)]
    df = metrics.fifo_pairs(spark.createDataFrame(rows, "code string, i int, side string, q double, p double"), "code", ["i"], "side", "q", "p")
    assert sorted((r["matched"], r["buy_price"], r["sell_price"]) for r in df.collect()) == fifo([(s, float(q), float(p)) for s, q, p in trades])


def test_last_before(spark):
    rnd = random.Random(4)
    day = lambda: D0 + dt.timedelta(days=rnd.randrange(20))
    events, known = [(rnd.choice("ab"), day()) for _ in range(40)], [(rnd.choice("ab"), day(), float(i)) for i in range(15)]
    for strict in (True, False):
        df = temporal.last_before(spark.createDataFrame(events, "e string, t date"), spark.createDataFrame(known, "e string, s date, v double"), "e", "t", "s", "v", strict)
        want = []
        for e, t in events:
            own = [(s, v) for k, s, v in known if k == e and (s < t or (s == t and not strict))]
            want.append((e, t, *(max(own) if own else (None, None))))
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_intervals_and_visibility(spark):
    st_ = spark.createDataFrame([("a", D0, "1", 1.0), ("a", D0, "2", 2.0), ("a", D0 + dt.timedelta(days=5), "3", 3.0), (None, D0, "1", 9.0)], "e string, s date, p string, v double")
    spans = temporal.intervals(st_, "e", "s", "p", ["v"])
    events = spark.createDataFrame([("a", D0 + dt.timedelta(days=k)) for k in (-1, 0, 4, 5, 9)], "e string, t date")
    got = lambda how, same: [r["v"] for r in temporal.interval_join(events, spans, "e", "t", "s", how, same).orderBy("t").collect()]
    assert got("left", True) == [None, 2.0, 2.0, 3.0, 3.0] and got("inner", True) == [2.0, 2.0, 3.0, 3.0]
    assert got("left", False) == [None, None, 2.0, None, 3.0] and got("inner", False) == [2.0, 3.0]


def test_next_date(spark):
    cal = spark.createDataFrame([(D0,), (D0 + dt.timedelta(days=3),), (D0 + dt.timedelta(days=3),)], "date date")
    facts = spark.createDataFrame([(D0 + dt.timedelta(days=k),) for k in (-2, 0, 1, 3, 8)] + [(None,)], "date date")
    got = {r["date"]: r["available_date"] for r in temporal.next_date(facts, cal).collect()}
    assert got == {D0 + dt.timedelta(days=k): (None if v is None else D0 + dt.timedelta(days=v)) for k, v in ((-2, 0), (0, 3), (1, 3), (3, None), (8, None))} | {None: None}


def test_merge_and_keep_last(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (None, "n", 7)], "k int, v string, w int")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, upsert.merge(old, new, ["k"]).collect()), key=repr) == sorted([(1, "a", 5), (2, "B", 6), (3, "c", None), (None, "n", 7)], key=repr)
    again = upsert.keep_last(old, new.withColumn("w", F.lit(0)), ["k"])
    assert sorted(map(tuple, again.collect()), key=repr) == sorted([(1, "a", 5), (2, "B", 0), (3, "c", 0), (None, "n", 7)], key=repr)
    assert upsert.schema_difference(old, {"k": "int", "v": "int", "z": "date"}) == [("v", "int", "string"), ("z", "date", None)]


def test_lineage_prefers_greatest_and_null_last(spark):
    rows = [("a", "f1", None, "z", 1), ("a", "f2", None, "a", 2), ("a", "f2", "e", "0", 3), ("b", "ä", None, "h", 4), ("b", "z", None, "h", 5), (None, "f", None, "h", 6)]
    df = spark.createDataFrame(rows, "k string, source_file string, source_entry string, source_hash string, v int")
    assert {r["k"]: r["v"] for r in latest_by_lineage(df, ["k"], ["v"]).collect()} == {"a": 3, "b": 4, None: 6}


def test_codes(spark):
    cases = {"510300": "510300.SH", "900901": "900901.SH", "000001": "000001.SZ", "430139": "430139.BJ", "830799": "830799.BJ", "870299": "870299.BJ", "880139": "880139.BJ", "920002": "920002.BJ", "sh600000": "600000.SH", " 600000_sh　": "600000.SH", "": None, " ": None, "abc": "ABC", "60000": "60000"}
    df = spark.createDataFrame(list(cases.items()), "raw string, want string").select("want", equity_code(F.col("raw")).alias("got"))
    assert all(r["want"] == r["got"] for r in df.collect()) and spark.range(1).select(equity_code(F.lit(None).cast("string")).alias("x")).first()["x"] is None
    index = {"399001": "399001.SZ", "399001.SH": "399001.SZ", "000300.SZ": "000300.SH", "930050": "930050.SH", "391234": "391234.SZ", "888888": "888888.SH", "": None}
    df = spark.createDataFrame(list(index.items()), "raw string, want string").select("want", index_code(F.col("raw")).alias("got"))
    assert all(r["want"] == r["got"] for r in df.collect())


def test_factors_fill_both_ways(spark):
    day = lambda k: D0 + dt.timedelta(days=k)
    raw = spark.createDataFrame([("a", day(k), 10.0, 10.0, 10.0, 10.0, 1.0, 1.0) for k in range(4)] + [("b", day(0), 10.0, 10.0, 10.0, 10.0, 1.0, 1.0)], "code string, date date, open double, high double, low double, close double, volume double, amount double")
    factors = spark.createDataFrame([("a", day(1), 2.0), ("a", day(3), 4.0)], "code string, date date, factor double")
    got = lambda mode: [r["close"] for r in apply_factors(raw, factors, mode).orderBy("code", "date").collect()]
    assert got("hfq") == [20.0, 20.0, 20.0, 40.0, 10.0] and got("qfq") == [5.0, 5.0, 5.0, 10.0, 10.0]


def test_streak_rank_and_rolling(spark):
    w = Window.partitionBy("k").orderBy("i")
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate([50.0, 75.0, 75.0, 80.0, 60.0, 75.0, None])], "k string, i int, x double")
    grouped = df.withColumn("g", windows.streak_groups(F.col("x") > 70, w))
    inside = Window.partitionBy("k", "g").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    assert [r["s"] for r in grouped.withColumn("s", F.sum(F.coalesce(F.col("x") > 70, F.lit(False)).cast("int")).over(inside)).orderBy("i").collect()] == [0, 1, 2, 3, 0, 1, 0]
    ranks = df.withColumn("r", windows.share_rank(F.col("x"), "k")).orderBy("i").collect()
    assert [r["r"] for r in ranks] == [1 / 6, 4 / 6, 4 / 6, 1.0, 2 / 6, 4 / 6, None]
    rolled = df.withColumn("m", windows.rolling(F.avg("x"), F.col("x"), w, 3, least=3)).orderBy("i").collect()
    assert [r["m"] for r in rolled] == [None, None, 200 / 3, 230 / 3, 215 / 3, 215 / 3, None]


def bar_frame(spark, opens, lows):
    rows = [("a", D0 + dt.timedelta(days=i), o, o, l, o, 1.0, 1.0) for i, (o, l) in enumerate((float(o), float(l)) for o, l in zip(opens, lows))]
    return spark.createDataFrame(rows, "code string, date date, open double, high double, low double, close double, volume double, amount double")


def remaining(spark, opens, lows):
    return [r["label"] for r in features.optimal_remaining_days(bar_frame(spark, opens, lows)).orderBy("date").collect()]


def test_optimal_remaining_days(spark):
    up, down = [10 + 0.5 * i for i in range(15)], [20 - 0.5 * i for i in range(15)]
    assert remaining(spark, [10.0] * 8, [9.95] * 8)[0] == 0
    assert remaining(spark, up, [x - 0.1 for x in up])[0] == 5 and remaining(spark, down, [x - 0.1 for x in down])[0] == 0
    assert remaining(spark, [9.5, 10, 11, 12, 8, 13, 14], [9.0, 9.8, 10.5, 11.5, 7.8, 12.8, 13.7])[0] == 2
    assert remaining(spark, [10.0], [9.0]) == [None]


def test_cross_section_ties_and_small_dates(spark):
    rows = [("d1", f"c{i}", 1.0) for i in range(12)] + [("d2", f"c{i}", float(i)) for i in range(9)] + [("d3", f"c{i}", float(i)) for i in range(11)] + [("d3", "n", None)]
    got = labels.cross_section_class(spark.createDataFrame(rows, "date string, code string, v double"), "v").collect()
    by = lambda d: [r["label"] for r in sorted((r for r in got if r["date"] == d), key=lambda r: (r["v"] is None, r["v"]))]
    assert set(by("d1")) == {0} and set(by("d2")) == {None} and by("d3") == [0] * 4 + [None] * 3 + [1] * 4 + [None]


def test_regime_of_a_rise_and_fall(spark):
    closes = [50 + 0.5 * i for i in range(101)] + [100 - i / 3 for i in range(150)]
    df = spark.createDataFrame([(D0 + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)], "date date, close double")
    got = [r["regime"] for r in features.regime_score(df).orderBy("date").collect()]
    assert got[-1] == "bear" and set(got[:200]) == {"neutral"}


def test_empty_frames(spark):
    empty = bar_frame(spark, [], [])
    for f in (features.daily_features, features.ema_macd, features.optimal_remaining_days, labels.drawdown_ahead, lambda x: labels.forward_returns(x, [1])):
        assert f(empty).collect() == []
    assert features.sell_risk(features.daily_features(empty)).collect() == []


def test_kernels():
    rng = np.random.default_rng(42)
    x = rng.normal(0, 1, 2000)
    y = 2.0 * x + 1.0 + 0.1 * rng.normal(size=2000)
    assert stats.kalman_hedge(x, y)[-1] == pytest.approx([2.0, 1.0], abs=0.15)
    ar, walk = np.zeros(800), np.cumsum(rng.normal(0, 0.5, 800))
    for i in range(1, 800):
        ar[i] = 0.9 * ar[i - 1] + 0.5 * rng.normal()
    assert 3 < features.half_life(ar) < 15 < features.half_life(walk) and features.half_life(ar[:5]) == float("inf")
    t, critical = stats.adf_statistic(ar)
    assert t < critical[1] < critical[5] < critical[10] and stats.adf_statistic(walk)[0] > critical[1]
    for solve in (stats.risk_parity, stats.min_variance, stats.max_diversification):
        assert solve(0.04 * np.eye(4)) == pytest.approx([0.25] * 4, abs=1e-4)
        w = solve(np.diag([0.04, 0.09, 0.16]), 0.0, 0.6)
        assert w.sum() == pytest.approx(1) and w.max() <= 0.6 + 1e-9
    cov = np.diag([0.04, 0.09, 0.16])
    w = stats.risk_parity(cov)
    assert np.ptp(w * (cov @ w)) < 0.1 * (w @ cov @ w)


def test_auc_and_rank_correlation_with_ties(spark):
    rows = [("d", 1.0, 0, 1.0), ("d", 1.0, 1, 2.0), ("d", 2.0, 1, 3.0), ("d", 0.0, 0, 0.0), ("d", None, 1, 1.0), ("e", 1.0, 1, 1.0)]
    df = spark.createDataFrame(rows, "date string, s double, y int, o double")
    assert {r["date"]: r["auc"] for r in stats.auc_by(df, "date", "s", "y").collect()} == {"d": 0.875, "e": None}
    ic = stats.information_coefficients(df, "s", "o", least=2).collect()
    assert len(ic) == 1 and ic[0]["rank_ic"] == pytest.approx(np.corrcoef([2.5, 2.5, 4, 1], [2, 3, 4, 1])[0, 1])
