"""Readings that are not credible for their source: an isolation forest for each source, with explicit limits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a source that are judged together, and days on either side that are looked at besides. Bounds a source to its calendar.
BLOCK_DAYS, HALO_DAYS = 512, 48
#: Readings before and after a date that say what is usual around it.
AROUND = 5
TREES, SUBSAMPLE, LEVELS = 24, 64, 8
#: What the forest says counts in full for a reading whose score is so much above the median score of its own source's usual readings; a
#: reading that it isolates less has to be farther off in proportion, one that it isolates more less far.
ISOLATED = 0.28
#: A reading is suspect if it differs by so many usual moves of its source from the readings around it: no other one is compared with it.
SUSPECT, SUSPECT_ONE_SIDE = 4.0, 10.0
#: A reading is far off if it differs by FAR usual moves of its source, times what the forest says, from the nearest readings before and after
#: it that are not suspect, and by FAR_AROUND from the readings around it; the factors given are enough for any source, however much it moves.
FAR_AROUND, FAR_AROUND_AT_MOST = 6.0, np.log(40.0)
FAR, FAR_AT_MOST = 11.5, np.log(100.0)
#: Where there are such readings on one side only, a lasting change of level looks the same, so a reading has to differ by more than those
#: do (a factor of 3) and by so many usual moves, times what the forest says; the factor of 400 is enough for any source.
FAR_ONE_SIDE, ONE_SIDE_AT_LEAST, ONE_SIDE_AT_MOST = 20.0, np.log(3.0), np.log(400.0)
#: A source's usual move is the greatest of three robust estimates: quantiles of its steps and the 90 % quantile of its difference feature,
#: each over what it is for normal steps of 1 (that of the feature by simulation of a random walk).
USUAL_STEP, USUAL_TURN = ((0.5, 0.6745), (0.8, 1.2816)), 1.1
#: Usual moves count as this at least, in log ratio, as readings are rounded.
SMALLEST_MOVE = 1e-3
#: Distinct readings that are worked on at once, whole sources only.
CHUNK_ROWS = 1 << 17

IMPOSSIBLE, SPIKE, STUCK = 1, 2, 4


@dataclass(frozen=True)
class Limits:
    """What a field allows: physical limits and frozen runs, the only explicit rules.

    ``zero``: zero is a possible reading. ``most``: greater readings are impossible. ``stuck``: equal readings on so many dates in a row
    are frozen; none: constant readings are usual. ``active``: the field of which a positive reading marks a date as active; frozen
    readings are sought on active dates only.
    """

    zero: bool = False
    most: float = np.inf
    stuck: int | None = None
    active: str | None = None


def flag_readings(rows: DataFrame, source: list[str], day: str, limits: dict[str, Limits]) -> DataFrame:
    """(source columns, day, field, value, score, impossible, spike, stuck): the distinct readings that are not credible.

    ``rows`` has a column for each field of ``limits``, of which copies and later deliveries may hold several readings for one date. Rows
    are reduced to distinct (source, date, field, value) before the shuffle, so a source with any share of all rows is bounded by its
    distinct readings, and those are judged in blocks of BLOCK_DAYS days with HALO_DAYS days on either side. Every reading gets four
    features: its level against the source's median, its difference from the readings around it, its level against the same weekday's
    and the length of the run of equal readings it is in. An isolation forest per source (TREES trees of at most SUBSAMPLE readings,
    random numbers from a hash of the source, so that results don't depend on partitions) scores all readings; it is grown on one reading a
    date, so that wrong ones which are delivered on every date cannot hide one another. A spike is a reading that is FAR usual moves of the
    source, less if the forest isolates it more than ISOLATED above the median score of its own source's usual readings and more if less, off
    the nearest readings before and after it that are not suspect themselves, and FAR_AROUND off those around it; no number is set by field.
    A lasting change of level is near the readings after it and so is none. Readings outside of the limits are impossible, and all but the
    first of a long run are stuck. A source that spans more than one block has a forest for each block.

    Null readings, and rows with a null date or source column, are passed over; NaN and infinite readings are impossible. Empty input
    gives no rows. Other columns of ``rows`` are not read.
    """
    names = list(limits)
    keys = [F.col(f"`{c}`").alias(f"s{i}") for i, c in enumerate(source)]
    measured = F.explode(F.array(*[F.struct(F.lit(i).cast("tinyint").alias("f"), F.col(f"`{n}`").cast("double").alias("v")) for i, n in enumerate(names)]))
    readings = (
        rows.where(F.col(day).isNotNull())
        .select(*keys, F.unix_date(F.col(day)).alias("d"), measured.alias("r"))
        .select(*[f"s{i}" for i in range(len(source))], "d", "r.f", "r.v")
        .where(F.col("v").isNotNull())
        .na.drop(subset=[f"s{i}" for i in range(len(source))])
        .groupBy(*[f"s{i}" for i in range(len(source))], "d", "f", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    blocked = _blocks(readings)
    by = [*[f"s{i}" for i in range(len(source))], "b"]
    ready = blocked.withColumn("id", F.xxhash64(*by)).repartition(*by).sortWithinPartitions("id", "f", "d", "v").select("id", "f", "d", "v", "n", "halo", *[f"s{i}" for i in range(len(source))])
    kinds = dict(readings.dtypes)
    out = ", ".join(f"s{i} {kinds[f's{i}']}" for i in range(len(source))) + ", d INT, f TINYINT, v DOUBLE, score DOUBLE, flags INT"
    flagged = ready.mapInArrow(partial(_work, limits=list(limits.values()), names=names), out)
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("f") + 1)
    bit = lambda b: F.col("flags").bitwiseAND(b) > 0
    return flagged.select(
        *[F.col(f"s{i}").alias(c) for i, c in enumerate(source)], F.date_from_unix_date("d").alias(day), name.alias("field"), F.col("v").alias("value"), "score",
        bit(IMPOSSIBLE).alias("impossible"), bit(SPIKE).alias("spike"), bit(STUCK).alias("stuck"),
    )


def _blocks(readings: DataFrame) -> DataFrame:
    block, at = F.floor(F.col("d") / BLOCK_DAYS), F.pmod(F.col("d"), F.lit(BLOCK_DAYS))
    place = lambda b, halo: F.struct(b.alias("b"), F.lit(halo).alias("halo"))
    near: Column = (
        F.when(at < HALO_DAYS, F.array(place(block, False), place(block - 1, True)))
        .when(at >= BLOCK_DAYS - HALO_DAYS, F.array(place(block, False), place(block + 1, True)))
        .otherwise(F.array(place(block, False)))
    )
    return readings.select("*", F.explode(near).alias("p")).select(*readings.columns, "p.b", "p.halo")


def _work(batches: Iterator[pa.RecordBatch], limits: list[Limits], names: list[str]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_ROWS:
            whole = pa.Table.from_batches(held).combine_chunks()
            ids = whole["id"].to_numpy()
            cut = int(np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])[-1])  # the last source may go on in the next batch
            if cut:
                yield from _judge(whole.slice(0, cut), limits, names)
            held, rows = whole.slice(cut).to_batches(), whole.num_rows - cut
    if rows:
        yield from _judge(pa.Table.from_batches(held).combine_chunks(), limits, names)


def _judge(t: pa.Table, limits: list[Limits], names: list[str]) -> Iterator[pa.RecordBatch]:
    ids, f, d, v, n, halo = (t[c].to_numpy() for c in ("id", "f", "d", "v", "n", "halo"))
    score, flags = judge(ids, f, d.astype(np.int64), v, n, limits, names)
    hit = np.flatnonzero((flags > 0) & ~halo.astype(bool))
    if len(hit):
        kept = t.take(pa.array(hit))
        columns = [kept[c].combine_chunks() for c in t.column_names if c.startswith("s")] + [kept[c].combine_chunks() for c in ("d", "f", "v")]
        fields = [c for c in t.column_names if c.startswith("s")] + ["d", "f", "v"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(score[hit]), pa.array(flags[hit].astype(np.int32))], [*fields, "score", "flags"])


def _starts(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _spread(starts: np.ndarray, n: int) -> np.ndarray:
    """The number of the segment that each of n places is in."""
    out = np.zeros(n, np.int64)
    out[starts[1:]] = 1
    return np.cumsum(out)


def _row_median(m: np.ndarray) -> np.ndarray:
    """Median of each row without its NaNs; NaN if it has no others."""
    m = np.sort(m, axis=1)
    n = m.shape[1] - np.isnan(m).sum(axis=1)
    i = np.arange(len(m))
    with np.errstate(invalid="ignore"):
        return np.where(n > 0, (m[i, np.maximum((n - 1) // 2, 0)] + m[i, np.minimum(n // 2, m.shape[1] - 1)]) / 2, np.nan)


def _segment_quantile(x: np.ndarray, seg: np.ndarray, count: int, q: float = 0.5) -> np.ndarray:
    """Lower quantile of x in each of ``count`` segments, NaNs left out; NaN for a segment without values."""
    ok = ~np.isnan(x)
    x, seg = x[ok], seg[ok]
    order = np.lexsort((x, seg))
    size = np.bincount(seg, minlength=count)
    first = np.cumsum(size) - size
    out = np.full(count, np.nan)
    has = size > 0
    out[has] = x[order][first[has] + ((size[has] - 1) * q).astype(np.int64)]
    return out


def judge(ids: np.ndarray, f: np.ndarray, d: np.ndarray, v: np.ndarray, copies: np.ndarray, limits: list[Limits], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Score and flags of readings sorted by source, field, date and value; ``copies`` is the number of rows that hold each."""
    n = len(v)
    series_at = _starts(ids, f)
    series = _spread(series_at, n)
    kind = f[series_at]
    per = lambda pick: np.array([pick(x) for x in limits], float)[f]
    finite = np.isfinite(v)
    with np.errstate(divide="ignore", invalid="ignore"):
        log = np.where(finite & (v > 0), np.log(np.where(v > 0, v, 1)), np.nan)

    # one value for each date: of several the one most often delivered, then the one nearest to the dates around
    dates_at = _starts(ids, f, d)
    date = _spread(dates_at, n)
    g = len(dates_at)
    gs = series[dates_at]
    often = np.where(np.isnan(log), 0, copies)
    most = np.flatnonzero(often == np.maximum.reduceat(often, dates_at)[date]) if g else np.zeros(0, int)
    first = log[most[_starts(date[most])]] if g else log
    for _ in range(2):
        middle = _row_median(_around(first, gs, [*range(-AROUND, 0), *range(1, AROUND + 1)]))
        off = np.abs(log - middle[date])
        off[np.isnan(off)] = 1e9
        least = np.minimum.reduceat(off, dates_at) if g else off
        at = np.flatnonzero(off == least[date])
        chosen = at[_starts(date[at])] if len(at) else at
        first = log[chosen]
    before = _row_median(_around(first, gs, range(-AROUND, 0)))[date]
    after = _row_median(_around(first, gs, range(1, AROUND + 1)))[date]
    d_before, d_after, away, one = _differences(log, before, after)
    both = ~np.isnan(d_before) & ~np.isnan(d_after)

    # how the source usually moves from date to date, and its level
    s = len(series_at)
    step = np.abs(first - _around(first, gs, [-1])[:, 0])
    turning = np.where(np.isnan(first), np.nan, away[chosen]) if len(chosen) else first
    steps = [_segment_quantile(step, gs, s, q) / normal for q, normal in USUAL_STEP]
    usual = np.nan_to_num(np.max([*steps, _segment_quantile(turning, gs, s, 0.9) / USUAL_TURN], axis=0))[series]
    level = log - _segment_quantile(first, gs, s)[series]
    weekday = gs * 7 + d[dates_at] % 7
    seasonal = log - _segment_quantile(first, weekday, s * 7)[weekday][date]

    run, later = _runs(ids, f, d, v, series, limits, names)

    features = np.stack([level, np.where(both, np.where(np.abs(d_before) < np.abs(d_after), d_before, d_after), 0.0), seasonal, np.log1p(run)], axis=1)
    features = np.nan_to_num(features, nan=-30.0)  # no logarithm: not a positive number
    features[~finite] = 60.0
    points = (log != log) & finite & (v == 0) & per(lambda x: x.zero).astype(bool)
    features[points] = 0.0  # zeros that the field allows say nothing about level
    impossible = ~finite | (v < 0) | ((v == 0) & (per(lambda x: x.zero) == 0)) | (v > per(lambda x: x.most))
    # A source's forest is grown on what it usually reads, the value chosen for each date. The other deliveries only widen the ranges that
    # cuts are drawn from, so values which are wrong on every date are isolated however many there are.
    usual_row = np.zeros(n, bool)
    usual_row[chosen] = True
    keep = np.where(usual_row & ~impossible, np.minimum(1.0, SUBSAMPLE / np.bincount(gs, minlength=s))[series], 0.0)
    score = forest(features, series_at, ids[series_at].astype(np.uint64) * np.uint64(31) + kind.astype(np.uint64), keep, ~impossible)

    isolation = score - _segment_quantile(score[chosen], gs, s)[series]
    moved = np.maximum(usual, SMALLEST_MOVE)
    suspect = (away >= SUSPECT * moved) | (one >= SUSPECT_ONE_SIDE * moved)
    for _ in range(2):  # of two wrong dates at the end of a source the inner one is seen first
        sound = np.where(suspect[chosen], np.nan, first) if g else first
        near_before, near_after, near, near_one = _differences(log, _nearest(sound, gs)[date], _nearest(sound[::-1], gs[::-1])[::-1][date])
        far = (away >= np.minimum(FAR_AROUND * moved, FAR_AROUND_AT_MOST)) & (near * isolation >= ISOLATED * np.minimum(FAR * moved, FAR_AT_MOST))
        alone = np.where(both & (np.isnan(near_before) | np.isnan(near_after)), near_one, one)  # nothing but suspect readings on one side
        far_one = np.minimum(alone, near_one) * isolation >= ISOLATED * np.clip(FAR_ONE_SIDE * moved, ONE_SIDE_AT_LEAST, ONE_SIDE_AT_MOST)
        spike = (far | far_one) & ~impossible
        suspect |= spike
    stuck = later & (run >= per(lambda x: np.inf if x.stuck is None else x.stuck)) & ~impossible
    return score, IMPOSSIBLE * impossible + SPIKE * spike + STUCK * stuck


def _around(x: np.ndarray, series: np.ndarray, steps) -> np.ndarray:
    """x at the given numbers of places before or after each place, NaN beyond its series."""
    out = np.full((len(x), len(steps)), np.nan)
    i = np.arange(len(x))
    for k, step in enumerate(steps):
        j = i + step
        ok = (j >= 0) & (j < len(x))
        ok[ok] = series[j[ok]] == series[i[ok]]
        out[ok, k] = x[j[ok]]
    return out


def _differences(log: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Differences from the readings before and after; the lesser one, where both are on one side of the reading, else 0; the only one, where
    there are readings on one side only, else 0."""
    with np.errstate(invalid="ignore"):
        d_before, d_after = log - before, log - after
        both = ~np.isnan(d_before) & ~np.isnan(d_after)
        away = np.where(both & (np.sign(d_before) == np.sign(d_after)), np.minimum(np.abs(d_before), np.abs(d_after)), 0.0)
        one = np.where(both, 0.0, np.nan_to_num(np.where(np.isnan(d_before), np.abs(d_after), np.abs(d_before))))
    return d_before, d_after, away, one


def _nearest(x: np.ndarray, series: np.ndarray) -> np.ndarray:
    """The last x before each place that is not NaN; NaN if its series has none there."""
    if not len(x):
        return x
    at = np.r_[-1, np.maximum.accumulate(np.where(np.isnan(x), -1, np.arange(len(x))))[:-1]]
    return np.where((at >= 0) & (series[at] == series), x[at], np.nan)


def _runs(ids, f, d, v, series, limits: list[Limits], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Length of the run of equal readings each one is in, over the active dates of its series, and whether it is not the run's first.
    A date on which some delivery repeats the value goes on with the run, whatever other deliveries say. A single date between two of a run
    is in it, too, if it repeats the value and nothing is known of its activity."""
    n = len(v)
    run, later = np.ones(n), np.zeros(n, bool)
    stamp = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + d.astype(np.uint64)
    ok, unknown = np.isfinite(v) & (v > 0), np.zeros(n, bool)
    for i, x in enumerate(limits):
        if x.stuck is not None and x.active in names and names.index(x.active) != i:
            other = f == names.index(x.active)
            unknown |= ok & (f == i) & ~np.isin(stamp, stamp[other & (v >= 0)])
            ok &= (f != i) | np.isin(stamp, stamp[other & (v > 0)])
    ok &= np.array([x.stuck is not None for x in limits])[f]
    at = np.flatnonzero(ok)
    if not len(at):
        return run, later
    place = _spread(_starts(series[at], d[at]), len(at))  # counts up over the dates, series after series
    order = np.lexsort((place, v[at], series[at]))
    a = at[order]
    new = np.ones(len(a), bool)
    new[1:] = (series[a[1:]] != series[a[:-1]]) | (v[a[1:]] != v[a[:-1]]) | (np.diff(place[order]) != 1)
    starts = np.flatnonzero(new)
    length, number = np.diff(np.r_[starts, len(a)]), np.full(n, -1)
    number[a] = _spread(starts, len(a))
    run[a], later[a] = length[number[a]], ~new
    b = np.flatnonzero(unknown | (number >= 0))
    b = b[np.lexsort((d[b], v[b], series[b]))]
    between = np.flatnonzero((number[b[1:-1]] < 0) & (number[b[:-2]] >= 0) & (number[b[:-2]] == number[b[2:]])) + 1
    run[b[between]], later[b[between]] = run[b[between - 1]], True
    return run, later


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(float) / 2.0**53


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    n = np.maximum(n.astype(float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


def forest(features: np.ndarray, series_at: np.ndarray, seeds: np.ndarray, keep: np.ndarray | None = None, seen: np.ndarray | None = None, trees: int = TREES, subsample: int = SUBSAMPLE, levels: int = LEVELS) -> np.ndarray:
    """Isolation scores: a forest for each series (the rows from one of ``series_at`` to the next), all of them grown together.

    A tree is grown on at most about ``subsample`` rows of its series, or each row with the chance in ``keep``, and all rows fall through
    it. Cuts are drawn from the range of the rows it is grown on and of those in ``seen``, but only the former count for the depth, so rows
    that are only seen cannot hide one another. Nodes are kept as ranges of a permutation, so that a level takes a few passes over all rows.
    Random numbers come from the series' seed, the tree and the node.
    """
    n, s = len(features), len(series_at)
    if not n:
        return np.zeros(0)
    size = np.diff(np.r_[series_at, n])
    series = _spread(series_at, n)
    share = np.minimum(1.0, subsample / size)[series] if keep is None else keep
    place = (np.arange(n) - series_at[series]).astype(np.uint64)
    norm = _mean_path(np.maximum(np.add.reduceat(share, series_at), 2))
    total = np.zeros(n)
    columns = np.ascontiguousarray(features.T)
    with np.errstate(over="ignore"):
        for tree in range(trees):
            salt = _mix(seeds + np.uint64(tree + 1) * np.uint64(0x9E3779B97F4A7C15))
            member = np.ones(n, bool) if (share == 1).all() else (share == 1) | (_unit(_mix(salt[series] + place)) < share)
            order, starts, keys, depth = np.arange(n), series_at.copy(), salt, np.zeros(s)
            for level in range(levels + 1):
                node = _spread(starts, n)
                count = np.add.reduceat(member[order].astype(np.int64), starts)
                if level == levels:
                    break
                which = (_mix(keys) % np.uint64(len(columns))).astype(np.int64)
                x = columns[which[node], order]
                ranged = (member if seen is None else member | seen)[order]
                low = np.minimum.reduceat(np.where(ranged, x, np.inf), starts)
                high = np.maximum.reduceat(np.where(ranged, x, -np.inf), starts)
                splits = (count > (1 if seen is None else 0)) & (high > low)
                cut = np.where(splits, low + _unit(_mix(keys ^ np.uint64(0xD1B54A32D192ED03))) * (high - low), -np.inf)
                cut = np.where(splits & (cut <= low), high, cut)
                right = (x >= cut[node]) & splits[node]
                total_right = np.cumsum(right)
                before = np.r_[0, total_right[starts[1:] - 1]] if len(starts) else np.zeros(0, int)
                rights = np.add.reduceat(right.astype(np.int64), starts)
                lengths = np.diff(np.r_[starts, n])
                local = np.arange(n) - starts[node]
                r_no = total_right - before[node]
                target = np.where(right, starts[node] + (lengths - rights)[node] + r_no - 1, starts[node] + local - r_no)
                new_order = np.empty_like(order)
                new_order[target] = order
                parts = np.repeat(np.arange(len(starts)), 1 + ((rights > 0) & (rights < lengths)))
                second = np.zeros(len(parts), bool)
                second[1:] = parts[1:] == parts[:-1]
                starts = starts[parts] + np.where(second, (lengths - rights)[parts], 0)
                depth = depth[parts] + splits[parts]
                keys = _mix(keys[parts] * np.uint64(2) + second.astype(np.uint64) + np.uint64(level + 1))
                order = new_order
            total[order] += (depth + _mean_path(count))[node]
    return 2.0 ** (-total / trees / np.maximum(norm, 1e-9)[series])
