import datetime as dt
import math

import numpy as np
import pytest

from tapeloom.operators import spikes
from tapeloom.operators.spikes import Limits, flag_readings, forest

D0 = dt.date(2020, 1, 6)
LIMITS = {"close": Limits(stuck=7, active="volume"), "volume": Limits(zero=True, most=1e13, stuck=5)}
SCHEMA = "code string, date date, close double, volume double"


def series(code="a", n=50, seed=1, start=0):
    rng = np.random.default_rng(seed)
    close = 10 * np.exp(np.cumsum(rng.normal(0, 0.015, n)))
    volume = np.exp(rng.normal(12, 0.5, n))
    return [[code, D0 + dt.timedelta(days=start + k), round(float(c), 2), round(float(v))] for k, (c, v) in enumerate(zip(close, volume))]


def flags(spark, rows):
    rows = [tuple(None if x is None else float(x) if i > 1 else x for i, x in enumerate(r)) for r in rows]
    df = flag_readings(spark.createDataFrame(rows, SCHEMA), ["code"], "date", LIMITS)
    return {(r["code"], (r["date"] - D0).days, r["field"]): "".join(k[0] for k in ("impossible", "spike", "stuck") if r[k]) for r in df.collect()}


def test_quiet_series_has_none(spark):
    assert flags(spark, [r for c in "abcdef" for r in series(c, seed=ord(c))]) == {}


def test_spikes_level_changes_and_limits(spark):
    rows = series()
    rows[10][2] *= 10  # spike
    rows[20][2] *= 0.45
    rows[21][2] *= 0.5  # two days
    rows[30][2] = -1.0
    rows[35][2] = 9999.0
    rows[15][3] *= 1000
    rows[25][3] = -5.0
    rows[40][3] *= 12  # a busy day
    rows[5][3] = 0.0  # a pause
    for r in rows[42:]:
        r[2] = round(r[2] * 2, 2)  # lasting
    assert flags(spark, rows) == {("a", 10, "close"): "s", ("a", 20, "close"): "s", ("a", 21, "close"): "s", ("a", 30, "close"): "i", ("a", 35, "close"): "s", ("a", 15, "volume"): "s", ("a", 25, "volume"): "i"}


def test_the_forest_decides(monkeypatch):
    """Far off by its source's usual moves is not enough: a reading must be isolated among its source's readings, too."""
    rng = np.random.default_rng(9)
    n, sources = 60, 40
    v = np.concatenate([10 * np.exp(np.cumsum(rng.normal(0, 0.01, n))) for _ in range(sources)])
    for k in (6, 15, 24, 40, 52):  # days that jump and come back, as this source's do now and then
        v[k::n] *= 1.12
    v[30::n] *= 8  # one spike each
    ids, d = np.repeat(np.arange(sources), n), np.tile(np.arange(n), sources)

    def judged(level):
        monkeypatch.setattr(spikes, "ISOLATED", level)
        return set(np.flatnonzero(spikes.judge(ids, np.zeros(n * sources, np.int8), d, v, np.ones(n * sources, int), [Limits()], ["close"])[1]).tolist())

    planted, with_forest, without = set(range(30, n * sources, n)), judged(0.28), judged(-1.0)
    assert planted <= with_forest < without and len(without - planted) > 2 * len(with_forest - planted)


def test_later_deliveries_and_copies(spark):
    rows = series()
    good = list(rows[10])
    rows[10][2] *= 10
    assert flags(spark, [*rows, *rows, good]) == {("a", 10, "close"): "s"}


def test_the_value_most_often_delivered_is_the_usual_one(spark):
    rows, bad = series(), []
    for r in rows[5:45]:
        bad.append([*r[:2], round(r[2] / 10, 3), r[3]])
    got = flags(spark, [*rows, *rows, *bad])
    assert got == {("a", k, "close"): "s" for k in range(5, 45)}


def test_wrong_values_on_every_date_do_not_hide_one_another():
    """A code that is delivered again and again: a few of its many rows a date hold the same wrong multiples, on every date."""
    rng = np.random.default_rng(2)
    n, wrong, found = 57, (0.01, 0.1, 10.0, 100.0), []
    for source in range(6):
        good = 6 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        v = np.sort(np.outer(good, [*wrong, 1.0]), axis=1)
        copies = np.where(v == good[:, None], 800, 2).ravel()
        d = np.repeat(np.arange(n), len(wrong) + 1)
        flags = spikes.judge(np.full(len(d), source), np.zeros(len(d), np.int8), d, v.ravel(), copies, [Limits()], ["close"])[1]
        found.append(((flags > 0) & (copies == 2)).sum())
        assert not flags[copies == 800].any()
    assert found == [n * len(wrong)] * 6


def test_a_source_that_moves_much_has_spikes_too(spark):
    """Volumes that vary by a factor of 3 from date to date: a hundredfold one is none of them, nor is a ten-thousandfold one on the last date."""
    rng = np.random.default_rng(4)
    rows = series(n=57)
    for r, x in zip(rows, rng.normal(12, 1.0, 57)):
        r[3] = float(round(math.exp(x)))
    rows[20][3] = round(math.exp(12) * 150)
    rows[56][3] = round(math.exp(12) * 10_000)
    assert flags(spark, rows) == {("a", 20, "volume"): "s", ("a", 56, "volume"): "s"}


def test_a_change_on_the_last_date_is_none(spark):
    """A calm price that changes by 20 % on its last date may as well have changed for good."""
    rows = series(n=40)
    for k, r in enumerate(rows):
        r[2] = round(10 * (1 + 0.004 * (k % 3)), 2)
    rows[-1][2] = 12.1
    assert flags(spark, rows) == {}


def test_two_wrong_dates_at_the_beginning(spark):
    rows = series(n=40)
    rows[0][2], rows[1][2] = rows[0][2] * 10, rows[1][2] * 10
    assert flags(spark, rows) == {("a", 0, "close"): "s", ("a", 1, "close"): "s"}


def test_frozen_runs_need_activity(spark):
    rows = series()
    for r in rows[10:20]:
        r[2] = rows[10][2]
    assert flags(spark, rows) == {("a", k, "close"): "s" for k in range(11, 20)}
    for r in rows[11:20]:
        r[3] = 0.0
    assert flags(spark, rows) == {}
    for r in rows[11:15]:
        r[3] = None
    assert flags(spark, rows) == {}


def test_frozen_runs_go_on_over_a_missing_volume(spark):
    """One date without a volume, or with an impossible one, amid a frozen run is part of it; a pause or a date after the run is not."""
    rows = series()
    for r in rows[10:24]:
        r[2] = rows[10][2]
    rows[13][3], rows[17][3] = None, -5.0
    frozen = {("a", k, "close"): "s" for k in range(11, 24)} | {("a", 17, "volume"): "i"}
    assert flags(spark, rows) == frozen
    rows[21][3], rows[22][3], rows[23][3] = None, None, None
    assert flags(spark, rows) == {k: v for k, v in frozen.items() if k[1] < 21}
    rows[15][3] = 0.0
    assert flags(spark, rows) == {k: v for k, v in frozen.items() if k[1] < 21 and k[1] != 15}


def test_nulls_nan_empty_and_single(spark):
    rows = series()
    rows[3][2], rows[4][3], rows[5][1] = None, None, None
    rows[6][0] = None
    rows[7][2], rows[8][3] = math.nan, math.inf
    assert flags(spark, rows) == {("a", 7, "close"): "i", ("a", 8, "volume"): "i"}
    assert flags(spark, []) == {}
    assert flags(spark, [["a", D0, 1.0, 1.0]]) == {}
    assert flags(spark, [["a", D0, 0.0, 0.0]]) == {("a", 0, "close"): "i"}


def test_extra_columns(spark):
    rows = series()
    rows[10][2] *= 10
    df = spark.createDataFrame([(*r, 1, "x") for r in [[r[0], r[1], float(r[2]), float(r[3])] for r in rows]], SCHEMA + ", score int, d string")
    assert flag_readings(df, ["code"], "date", LIMITS).count() == 1


def test_block_borders_and_partitions_do_not_matter(spark, monkeypatch):
    rows = [r for c in "abcd" for r in series(c, seed=ord(c), n=120)]
    for r in rows[::37]:
        r[2] *= 5
    whole = flags(spark, rows)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert flags(spark, rows) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert set(whole.values()) == {"s"} and len(whole) >= 10


def test_chunks_keep_sources_whole():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n, k = 40, 60
    ids = np.repeat(np.arange(k), n)
    d = np.tile(np.arange(n), k)
    v = np.exp(rng.normal(0, 0.01, n * k))
    v[::97] *= 20
    table = pa.table({"id": ids, "f": np.zeros(n * k, np.int8), "d": d.astype(np.int32), "v": v, "n": np.ones(n * k, int), "halo": np.zeros(n * k, np.int8), "s0": [str(i) for i in ids]})
    limits, names = [Limits()], ["x"]

    def run(size):
        return sorted((r["s0"], r["d"]) for b in spikes._work(iter(table.to_batches(max_chunksize=size)), limits, names) for r in b.to_pylist())

    whole = run(10_000)
    old, spikes.CHUNK_ROWS = spikes.CHUNK_ROWS, 100
    try:
        assert run(33) == whole and len(whole) > 15
    finally:
        spikes.CHUNK_ROWS = old


@pytest.mark.parametrize("n", [1, 2, 5, 64, 1000])
def test_forest_isolates_the_odd_one(n):
    rng = np.random.default_rng(n)
    x = rng.normal(0, 1, (n, 4))
    x[0] = 30
    score = forest(x, np.array([0]), np.array([7], np.uint64))
    assert np.isfinite(score).all() and (n < 5 or score.argmax() == 0)
    if n == 1000:
        assert score[0] > 0.7 > np.quantile(score, 0.9)
