import numpy as np

from tapeloom.operators.volatility import garch_fit, garch_scale, hidden_regimes, hidden_states


def test_garch_finds_clusters():
    rng = np.random.default_rng(0)
    r, v = [], 1e-4
    for _ in range(3000):
        r.append(rng.normal(0, np.sqrt(v)))
        v = 1e-5 + 0.1 * r[-1] ** 2 + 0.8 * v
    a, b, var = garch_fit(np.array(r))
    assert 0.05 < a < 0.2 and 0.65 < b < 0.92 and (var > 0).all()


def test_hidden_states_of_two_levels():
    rng = np.random.default_rng(1)
    truth = np.repeat([0, 1, 0, 1], 100)
    path, mean, move = hidden_states(np.column_stack([rng.normal(3 * truth, 1), rng.normal(0, 1, 400)]), 2)
    assert (path == truth).mean() > 0.95 and mean[0, 0] < mean[1, 0] and np.allclose(move.sum(axis=1), 1)


def test_short_and_constant_series(spark):
    import datetime as dt

    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    rows = [("short", day(i), 0.1 * i) for i in range(5)] + [("flat", day(i), 0.0) for i in range(50)] + [("ok", day(i), float((i * 7) % 5 - 2) / 100) for i in range(50)] + [("ok", day(50), None)]
    df = spark.createDataFrame(rows, "code string, date date, r double")
    assert [(r["code"], r["n"]) for r in garch_scale(df).collect()] == [("ok", 50)]
    assert {r["code"] for r in hidden_regimes(df, ["r"]).collect()} == {"flat", "ok"} and hidden_regimes(df.limit(0), ["r"]).collect() == []


def test_query_fits_every_code(spark, tmp_path):
    import datetime as dt

    from tapeloom.plans.reference_learning import garch_vol_scale

    rng = np.random.default_rng(2)
    rows = []
    for i in range(61):  # the last one has too few returns
        close = 10 * np.exp(np.cumsum(rng.normal(0, 0.02, 31 if i < 60 else 30)))
        rows += [(f"{600000 + i}.SH", dt.date(2024, 1, 1) + dt.timedelta(days=k), "qfq", *[float(c)] * 4, 1.0, float(i), "f", "e", str(k)) for k, c in enumerate(close)]
    schema = "equity_code string, date date, adjust_type string, open double, high double, low double, close double, volume double, amount double, source_file string, source_entry string, source_hash string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/dwd_fact_equity_kline_1d.parquet")
    got = {r["code"]: r["n"] for r in garch_vol_scale(spark, str(tmp_path)).collect()}
    assert len(got) == 60 and set(got.values()) == {30}
