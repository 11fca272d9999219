"""Operators of the layered tables against plain Python: blocks and hot entities, ranks, positions, measures, trees."""

import datetime as dt
import math
import random
from collections import deque
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeloom.operators import features, metrics, stats, temporal, training, volatility

D = dt.date
TRADE = "code string, t int, side string, qty double, price double, fee double"


def queue(rows):
    """First in, first out by a queue, in exact fractions; what is sold beyond what is held is dropped."""
    held, out = {}, []
    for code, _, side, qty, price, fee in sorted(rows, key=lambda r: (r[0], r[1])):
        q, lots = Fraction(str(qty)), held.setdefault(code, deque())
        if side == "buy":
            lots.append([q, price, fee])
            continue
        while q > 0 and lots:
            m = min(q, lots[0][0])
            out.append((code, float(m), lots[0][1], price, round(float(m) * (price - lots[0][1] - lots[0][2] - fee), 6)))
            q -= m
            lots[0][0] -= m
            if not lots[0][0]:
                lots.popleft()
    return sorted(out)


@pytest.mark.parametrize("block", [7, 60, 10_000])
def test_fifo_in_blocks_with_a_hot_code_and_fractions(spark, block):
    rnd = random.Random(block)
    rows = [(rnd.choice(["hot"] * 9 + ["a", "b"]), i, rnd.choice(["buy", "buy", "sell", "sell"]), rnd.choice([0.1, 0.2, 0.3, 1.0, 2.5, 7.0]), float(rnd.randrange(10, 20)), rnd.choice([0.0, 0.01])) for i in range(400)]
    df = spark.createDataFrame(rows + [("a", 9_000, "buy", 0.0, 1.0, 0.0), ("a", 9_001, "none", 1.0, 1.0, 0.0), ("b", 9_002, "sell", None, 1.0, 0.0)], TRADE)
    got = metrics.fifo_pairs(df, "code", ["t"], "side", "qty", "price", "fee", block_rows=block)
    assert sorted((r["code"], round(r["matched"], 9), r["buy_price"], r["sell_price"], round(r["profit"], 6)) for r in got.collect()) == queue(rows)
    assert metrics.fifo_pairs(df.limit(0), "code", ["t"], "side", "qty", "price").collect() == []


def test_fifo_costs_and_statistics(spark):
    rows = [("a", 1, "buy", 100.0, 10.0, 0.05), ("a", 2, "sell", 100.0, 12.0, 0.056), ("a", 3, "buy", 50.0, 10.0, 0.0), ("a", 4, "sell", 20.0, 9.0, 0.0), ("b", 1, "sell", 5.0, 1.0, 0.0)]
    pairs = metrics.fifo_pairs(spark.createDataFrame(rows, TRADE), "code", ["t"], "side", "qty", "price", "fee")
    assert sorted(round(r["profit"], 6) for r in pairs.collect()) == [-20.0, 189.4]
    one = metrics.trade_statistics(pairs).first()
    assert (one["total_trades"], one["win_rate"]) == (2, 0.5) and one["profit_loss_ratio"] == pytest.approx(9.47)
    assert metrics.trade_statistics(pairs.where("profit > 0")).first()["profit_loss_ratio"] == math.inf
    assert tuple(metrics.trade_statistics(pairs.limit(0)).first()) == (0, 0.0, 0.0)


@pytest.mark.parametrize("strict", [True, False])
def test_last_before_with_a_hot_entity(spark, strict):
    rnd = random.Random(4)
    days = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(1500)]
    who = lambda: rnd.choice(["hot"] * 9 + ["a", "b", None])
    known = [(who(), rnd.choice(days + [None]), rnd.choice([1.0, 2.0, 3.0])) for _ in range(300)]
    events = [(who(), rnd.choice(days), i) for i in range(600)]
    got = temporal.last_before(spark.createDataFrame(events, "code string, date date, i int"), spark.createDataFrame(known, "code string, ann date, v double"), "code", "date", "ann", "v", strict)

    def brute(code, date):
        have = [(a, v) for c, a, v in known if c is not None and c == code and a is not None and (a < date if strict else a <= date)]
        return max(have) if have else (None, None)

    assert sorted(((r["i"], r["ann"], r["v"]) for r in got.collect()), key=repr) == sorted(((i, *brute(c, d)) for c, d, i in events), key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("same_day", [True, False])
def test_interval_join(spark, how, same_day):
    rnd = random.Random(6)
    days = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    said = [(rnd.choice(["hot"] * 8 + ["a"]), rnd.choice(days), rnd.randrange(5), float(rnd.randrange(9))) for _ in range(40)]
    events = [(rnd.choice(["hot", "a", "z", None]), rnd.choice(days), i) for i in range(200)]
    spans = temporal.intervals(spark.createDataFrame(said, "code string, ann date, period int, x double"), "code", "ann", "period", ["x"])
    got = temporal.interval_join(spark.createDataFrame(events, "code string, date date, i int"), spans, "code", "date", "ann", how, same_day)
    want = []
    for c, d, i in events:
        have = [s[1:] for s in said if s[0] == c and s[1] <= d]
        best = max(have) if have else None
        if best and not same_day and best[0] == d:
            best = None
        if best or how == "left":
            want.append((i, best[0] if best else None, best[2] if best else None))
    assert sorted(((r["i"], r["ann"], r["x"]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_rank_blend(spark):
    pd = pytest.importorskip("pandas")
    rnd = random.Random(1)
    rows = [(f"c{i}", D(2024, 1, 1 + i % 3), rnd.choice([None, 1.0, 2.0, 3.0]), rnd.choice([5.0, 6.0, 7.0]), 1.0 if i == 0 else None) for i in range(40)]
    up, down = {"x": 0.5, "lonely": 0.2, "absent": 0.1}, {"y": 0.3}
    got = {(r["code"], r["date"]): r["score"] for r in stats.rank_blend(spark.createDataFrame(rows, "code string, date date, x double, y double, lonely double"), up, down).collect()}
    df = pd.DataFrame(rows, columns=["code", "date", "x", "y", "lonely"])
    for date, g in df.groupby("date"):
        score = 0.5 * g["x"].rank(pct=True).fillna(0.5) + 0.2 * 0.5 + 0.1 * 0.5 + 0.3 * g["y"].rank(pct=True, ascending=False).fillna(0.5)
        for code, s in zip(g["code"], score):
            assert got[code, date] == pytest.approx(s, abs=1e-12)


def test_pair_statistics_are_of_returns(spark):
    rng = np.random.default_rng(2)
    a = np.cumsum(rng.normal(0, 0.02, 200))
    series = {"A": np.exp(a), "B": np.exp(2 * a + rng.normal(0, 0.001, 200)), "C": np.exp(np.cumsum(rng.normal(0, 0.02, 200)))}
    rows = [(c, D(2023, 1, 1) + dt.timedelta(days=i), float(v[i]), float(np.log(v[i] / v[i - 1])) if i else None) for c, v in series.items() for i in range(200)]
    got = {(r["code_x"], r["code_y"]): r for r in stats.pair_stats(spark.createDataFrame(rows, "code string, date date, close double, return_1d double")).collect()}
    assert set(got) == {("A", "B"), ("A", "C"), ("B", "C")} and all(r["observation_count"] == 199 for r in got.values())
    ra, rb = np.diff(np.log(series["A"])), np.diff(np.log(series["B"]))
    assert got["A", "B"]["return_corr"] == pytest.approx(np.corrcoef(ra, rb)[0, 1]) and got["A", "B"]["beta_xy"] == pytest.approx(np.cov(ra, rb)[0, 1] / np.var(rb, ddof=1))
    assert got["A", "B"]["avg_log_spread"] == pytest.approx(np.mean(np.log(series["A"][1:]) - np.log(series["B"][1:]))) and abs(got["A", "C"]["return_corr"]) < 0.3
    assert stats.pair_stats(spark.createDataFrame(rows[:100], "code string, date date, close double, return_1d double")).collect() == []


@pytest.mark.parametrize("n", [1, 2, 5, 30])
def test_equal_risk_contributions(n):
    rng = np.random.default_rng(n)
    m = rng.normal(0, 1, (n, 3 * n + 2))
    cov = m @ m.T / m.shape[1]
    w = stats.risk_parity(cov)
    risk = w * (stats.shrink(cov) @ w)
    assert w.sum() == pytest.approx(1) and (w > 0).all() and np.allclose(risk, risk.mean(), rtol=1e-6)
    assert np.allclose(stats.risk_parity(0.04 * np.eye(n)), 1 / n)
    bounded = stats.risk_parity(cov, 0.0, max(0.4, 1 / n))
    assert bounded.sum() == pytest.approx(1) and bounded.max() <= max(0.4, 1 / n) + 1e-9


def test_covariance_imputes_means(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (12, 3))
    x[2, 0] = x[5, 1] = np.nan
    rows = [(c, D(2024, 1, 1 + i), None if np.isnan(x[i, k]) else float(x[i, k])) for k, c in enumerate("abc") for i in range(12) if not (k == 2 and i == 7)]
    x[7, 2] = np.nan
    filled = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    want = np.cov(filled.T)
    for r in stats.covariance(spark.createDataFrame(rows, "code string, date date, r double")).collect():
        assert r["cov"] == pytest.approx(want["abc".index(r["code_x"]), "abc".index(r["code_y"])])


def test_position_scale():
    past = np.linspace(0.01, 0.03, 101)
    scale = volatility.position_scale
    assert scale(0.05, past) == 0.5 and scale(0.001, past) == 1.0 and scale(0.02, past) == pytest.approx(0.75)
    assert scale(0.02, np.full(10, 0.02)) == 1.0 and scale(0.03, np.full(10, 0.02)) == 0.5


def test_regime_observations(spark):
    pd = pytest.importorskip("pandas")
    rng = np.random.default_rng(1)
    f = pd.DataFrame({"close": np.exp(np.cumsum(rng.normal(0, 0.01, 40))), "amount": rng.uniform(1, 2, 40)})
    rows = [("m", D(2024, 1, 1) + dt.timedelta(days=i), float(f["close"][i]), float(f["amount"][i])) for i in range(40)]
    got = [r for r in volatility.regime_observations(spark.createDataFrame(rows, "code string, date date, close double, amount double"), 20).orderBy("date").collect()]
    r = f["close"].pct_change().dropna()
    assert [x["momentum"] is None for x in got] == [i < 20 for i in range(40)]
    for i in range(20, len(r) + 1):  # the window of returns that ends at row i, and the amounts of the rows before it
        window, amount = r.iloc[i - 20 : i], f["amount"].iloc[i - 20 : i]
        assert got[i]["momentum"] == pytest.approx(window.mean()) and got[i]["volatility"] == pytest.approx(window.std()) and got[i]["volume_ratio"] == pytest.approx(amount.iloc[-1] / (amount.mean() + 1e-8))


def test_against_benchmark(spark):
    rng = np.random.default_rng(3)
    b = rng.normal(0.0005, 0.01, 300)
    s = 0.5 * b + rng.normal(0.0002, 0.002, 300)
    day = [D(2023, 1, 1) + dt.timedelta(days=i) for i in range(300)]
    nav, bench = np.cumprod(1 + s), np.cumprod(1 + b)
    series = metrics.value_series(spark.createDataFrame([(d, float(v)) for d, v in zip(day, nav)], "date date, nav double"))
    row = metrics.against_benchmark(series, spark.createDataFrame([(d, float(v)) for d, v in zip(day, bench)], "date date, close double")).first()
    x, y = nav[1:] / nav[:-1] - 1, bench[1:] / bench[:-1] - 1
    annual, whole = (nav[-1] / nav[0]) ** (252 / 299) - 1, bench[-1] / bench[0] - 1
    beta = np.cov(x, y)[0, 1] / np.var(y, ddof=1)
    assert row["aligned"] == 299 and row["beta"] == pytest.approx(beta) and row["alpha"] == pytest.approx(annual - (0.02 + beta * (whole - 0.02)))
    assert row["information_ratio"] == pytest.approx((annual - whole) / (np.std(x - y, ddof=1) * np.sqrt(252)))
    dd = nav / np.maximum.accumulate(nav) - 1
    low = int(dd.argmin())
    top = int(nav[: low + 1].argmax())
    after = [i for i in range(low, 300) if nav[i] >= nav[top]]
    assert row["max_drawdown_duration"] == (after[0] if after else 299) - top
    short = metrics.against_benchmark(series.limit(10), spark.createDataFrame([(d, float(v)) for d, v in zip(day, bench)], "date date, close double")).first()
    assert short["beta"] is None and short["information_ratio"] is None


def test_verdict(spark):
    rows = [(0.3, 1.5, -0.1), (0.3, 0.5, -0.1), (-0.1, 0.0, -0.3), (None, None, None)]
    assert [r["verdict"] for r in metrics.verdict(spark.createDataFrame(rows, "total_return double, sharpe double, max_drawdown double")).collect()] == ["good", "fair", "poor", "poor"]


def test_board_events_count_from_the_next_day(spark):
    day = lambda n: D(2024, 1, n)
    daily = spark.createDataFrame([("a", day(n), 10.0, 100.0) for n in (1, 2, 5, 8)], "equity_code string, date date, close double, amount double")
    said = spark.createDataFrame([("a", day(2), 1, 7.0), ("a", day(5), 1, 8.0)], "equity_code string, ann date, period int, roe double")
    money = spark.createDataFrame([("a", day(2), 5.0, 4.0, 3.0)], "equity_code string, date date, net_inflow_amount double, main_net_inflow_amount double, extra_large_net_inflow_amount double")
    seats = spark.createDataFrame([("a", day(5), 3.0, 1.0, 2.0, "x"), ("a", day(5), 1.0, 1.0, 0.0, "y")], "equity_code string, date date, buy_amount double, sell_amount double, net_amount double, department_name string")
    boards = spark.createDataFrame([("a", day(2), 2.0, 1.0, "r", "t", "b"), ("a", day(3), 4.0, 1.0, "r", "t", "b"), ("a", day(8), 9.0, 1.0, "r", "t", "b")], "equity_code string, date date, limit_up_streak double, main_net_amount double, limit_up_reason string, tags string, board_names string")
    wide = features.rich_wide(daily, temporal.intervals(said, "equity_code", "ann", "period", ["roe"]), money, seats, boards, daily.select("date"))
    got = {r["date"].day: (r["roe"], r["net_inflow_to_amount"], r["dragon_tiger_net_to_amount"], r["limit_up_streak"], r["is_kpl_event"]) for r in wide.collect()}
    assert got == {1: (None, None, None, 0.0, 0.0), 2: (None, 0.05, None, 0.0, 0.0), 5: (None, None, 0.02, 4.0, 1.0), 8: (8.0, None, None, 0.0, 0.0)}


def test_trees_and_gates(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(30):
        x = rng.normal(0, 1, 12)
        rows += [(f"c{k}", D(2024, 1, 1) + dt.timedelta(days=i), float(x[k]), float(x[k] + rng.normal(0, 0.5)), float(x[k] > 0.3) if k % 4 else None) for k in range(12)]
    panel = training.eval_split(spark.createDataFrame(rows, "code string, date date, x double, v double, label double")).cache()
    assert panel.where("is_eval").select("date").distinct().count() == 6 and panel.where("is_eval").agg(F.min("date")).first()[0] > panel.where("NOT is_eval").agg(F.max("date")).first()[0]
    weighted = training.class_weights(panel.where("label IS NOT NULL")).groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert weighted[0]["w"] == pytest.approx(weighted[1]["w"])
    model = training.train_trees(panel, ["x"], parameters=training.TreeParameters(rounds=3, depth=2))
    row = training.gates(training.predict(model, panel.where("is_eval"), ["x"]).withColumn("label", F.col("label").cast("int")), "v").first()
    assert row["auc"] > 0.9 and row["rank_ic"] > 0.3 and row["passed"]
    assert training.train_trees(panel.withColumn("label", F.lit(1.0)), ["x"]) is None
    with pytest.raises(ValueError):
        training.eval_split(panel.drop("is_eval").where("date < '2024-01-04'"))


def test_statement_ratios_and_three_ways(spark):
    from tapeloom.operators.fundamental import known_statements, statement_ratios

    cols = {"close": 10.0, "eps_basic": 0.5, "bps": 4.0, "total_share": 100.0, "total_revenue": 200.0, "operating_cost": 150.0, "parent_net_profit": 20.0, "total_liabilities": 30.0, "total_assets": 120.0, "current_assets": 9.0, "current_liabilities": 0.0}
    row = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} double" for c in cols)).select(*[c.alias(n) for n, c in statement_ratios().items()]).first()
    assert tuple(row) == (20.0, 2.5, 1000.0, 0.25, 0.1, 0.25, None, pytest.approx(200 / 120))
    day = lambda n: D(2024, 1, n)
    prices = spark.createDataFrame([("a", day(n), 1.0) for n in (1, 3, 5)] + [("b", day(3), 1.0)], "code string, date date, close double")
    income = spark.createDataFrame([("a", day(3), "2", 7.0), ("a", day(3), "1", 6.0), ("a", None, "3", 9.0)], "code string, ann date, period string, x double")
    balance = spark.createDataFrame([("a", day(5), "1", 4.0)], "code string, ann date, period string, y double")
    got = known_statements(prices, {"income": (income, ["x"]), "balance": (balance, ["y"])}, "code", "date", "ann", "period")
    assert sorted((r["date"].day, r["income_date"], r["x"], r["balance_date"], r["y"]) for r in got.collect()) == [(3, day(3), 7.0, None, None), (5, day(3), 7.0, day(5), 4.0)]


def test_pairs_are_selected_in_order(spark):
    pairs = spark.createDataFrame([("a", "b", 0.9), ("a", "c", 0.85), ("a", "d", 0.5), ("b", "c", 0.95), ("b", "d", 0.9)], "code_x string, code_y string, return_corr double")
    kernels = spark.createDataFrame([("a", "b", -4.0, -3.4, 18.0), ("a", "c", -4.0, -3.4, 9.0), ("a", "d", -5.0, -3.4, 10.0), ("b", "c", -3.0, -3.4, 10.0), ("b", "d", -4.0, -3.4, 30.0)], "code_x string, code_y string, adf double, adf_5pct double, half_life double")
    assert [(r["code_x"], r["code_y"]) for r in stats.select_pairs(pairs, kernels).collect()] == [("a", "c"), ("a", "b")]
