"""Statistics of pairs, ranks and portfolios."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.windows import average_rank, ratio


def correlation(x: str, y: str) -> Column:
    """Sample correlation; null where one side doesn't vary, which the built-in answers with an error."""
    return ratio(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def pair_stats(features: DataFrame, days: int = 756, least: int = 120) -> DataFrame:
    """Statistics of each two codes (code_x < code_y) of ``features`` (code, date, close, return_1d) on their common dates of the last
    ``days`` calendar days: correlation and beta of the daily returns, mean and deviation of the spread of log closes. Rows without a
    close or a return take no part; pairs of fewer than ``least`` common dates are left out.

    A self-join on the date: it is meant for a universe that has been narrowed down (:func:`liquid_codes`), as its output has a row for
    each pair of codes by definition. The first day of the span is a scalar subquery of the same plan.
    """
    since = features.agg(F.date_sub(F.max("date"), days)).scalar()
    recent = features.where((F.col("date") >= since) & F.col("close").isNotNull() & F.col("return_1d").isNotNull()).select("date", "code", "close", "return_1d")
    side = lambda n: recent.select("date", F.col("code").alias(f"code_{n}"), F.col("close").alias(f"c{n}"), F.col("return_1d").alias(f"r{n}"))
    spread = F.ln("cx") - F.ln("cy")
    pairs = side("x").join(side("y"), "date").where("code_x < code_y").groupBy("code_x", "code_y")
    return pairs.agg(
        F.count(F.lit(1)).alias("observation_count"), correlation("rx", "ry").alias("return_corr"), ratio(F.covar_samp("rx", "ry"), F.var_samp("ry")).alias("beta_xy"),
        F.avg(spread).alias("avg_log_spread"), F.stddev_samp(spread).alias("std_log_spread"), F.max("date").alias("latest_date"),
    ).where(F.col("observation_count") >= least)


def liquid_codes(bars: DataFrame, n: int, least_days: int = 5) -> DataFrame:
    """(code, avg_amount, days): the n codes of the greatest mean amount, null amounts as zero, ties by code."""
    means = bars.groupBy("code").agg(F.avg(F.coalesce("amount", F.lit(0.0))).alias("avg_amount"), F.count(F.lit(1)).alias("days"))
    return means.where(F.col("days") >= least_days).orderBy(F.desc("avg_amount"), "code").limit(n)


def rank_blend(df: DataFrame, up: dict[str, float], down: dict[str, float], by: str = "date") -> DataFrame:
    """(code, by, score): the weighted sum of percentile ranks within each ``by``, those of ``down`` from the greatest value.

    Ties have the mean of their ranks. A null counts as 0.5, as does every value of a column that is missing or has one value or none on
    that date. All columns are laid under each other, so one sort by (date, column, value) ranks them all and a date is spread over as
    many tasks as it has columns.
    """
    weights = {**up, **{c: -w for c, w in down.items()}}
    have = [c for c in weights if c in df.columns]
    missing = 0.5 * sum(abs(w) for c, w in weights.items() if c not in have)
    if not have:
        return df.select("code", by, F.lit(missing).alias("score"))
    entry = lambda c: F.struct(F.lit(c).alias("c"), F.lit(abs(weights[c])).alias("w"), F.lit(weights[c] < 0).alias("down"), F.col(c).cast("double").alias("v"))
    long = df.select("code", by, F.explode(F.array(*[entry(c) for c in have])).alias("e")).select("code", by, "e.*")
    whole = Window.partitionBy(by, "c")
    n = F.count("v").over(whole)
    rank = F.rank().over(whole.orderBy(F.col("v").asc_nulls_last())) + (F.count(F.lit(1)).over(Window.partitionBy(by, "c", "v")) - 1) / 2.0
    share = F.when(F.col("v").isNull() | (n <= 1), 0.5).otherwise(F.when(F.col("down"), n + 1 - rank).otherwise(rank) / n)
    return long.select("code", by, (F.col("w") * share).alias("part")).groupBy("code", by).agg((F.sum("part") + F.lit(missing)).alias("score"))


def information_coefficients(df: DataFrame, score: str, outcome: str, least: int = 5) -> DataFrame:
    """(date, n, ic, rank_ic): correlation of score and outcome, and of their average ranks, on each date of ``least`` pairs or more."""
    both = df.where(F.col(score).isNotNull() & F.col(outcome).isNotNull()).select("date", F.col(score).cast("double").alias("s"), F.col(outcome).cast("double").alias("o"))
    ranked = both.withColumn("rs", average_rank(F.col("s"), "date")).withColumn("ro", average_rank(F.col("o"), "date"))
    return ranked.groupBy("date").agg(F.count(F.lit(1)).alias("n"), correlation("s", "o").alias("ic"), correlation("rs", "ro").alias("rank_ic")).where(F.col("n") >= least)


def auc_by(df: DataFrame, group: str, score: str, label: str) -> DataFrame:
    """(group, positives, negatives, auc): area under the curve by average ranks, so ties count half; null without both classes."""
    ok = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).withColumn("r", average_rank(F.col(score), group))
    n1, n0 = F.sum((F.col(label) == 1).cast("bigint")), F.sum((F.col(label) == 0).cast("bigint"))
    ranks = F.sum(F.when(F.col(label) == 1, F.col("r")))
    return ok.groupBy(group).agg(n1.alias("positives"), n0.alias("negatives"), ranks.alias("r")).select(
        group, "positives", "negatives", F.when((F.col("positives") > 0) & (F.col("negatives") > 0), (F.col("r") - F.col("positives") * (F.col("positives") + 1) / 2.0) / (F.col("positives") * F.col("negatives"))).alias("auc")
    )


# Response surface of the Dickey-Fuller tau statistic with constant and trend, 1, 5 and 10 % (MacKinnon 2010).
ADF_TREND = {1: (-3.95877, -9.0531, -28.428, -134.155), 5: (-3.41049, -4.3904, -9.036, -45.374), 10: (-3.12705, -2.5856, -3.925, -22.380)}


def adf_statistic(series: np.ndarray, lags: int = 1) -> tuple[float, dict[int, float]]:
    """Augmented Dickey-Fuller t statistic with constant and trend, and the critical values for the sample's size."""
    y = np.asarray(series, float)
    dy = np.diff(y)
    n = len(dy) - lags
    if n < lags + 5:
        return float("nan"), {}
    columns = [y[lags:-1], np.ones(n), np.arange(1, n + 1)] + [dy[lags - k : len(dy) - k] for k in range(1, lags + 1)]
    x, z = np.column_stack(columns), dy[lags:]
    inverse = np.linalg.pinv(x.T @ x)
    beta = inverse @ x.T @ z
    residual = z - x @ beta
    variance = float(residual @ residual) / max(n - x.shape[1], 1)
    error = float(np.sqrt(max(variance * inverse[0, 0], 0.0)))
    return (float(beta[0]) / error if error else float("nan")), {k: b[0] + b[1] / n + b[2] / n**2 + b[3] / n**3 for k, b in ADF_TREND.items()}


def kalman_hedge(x: np.ndarray, y: np.ndarray, drift: float = 1e-4, noise: float = 1e-3) -> np.ndarray:
    """Recursive hedge ratio and intercept of y on x: an array of (beta, alpha) after each observation."""
    theta, p, out = np.zeros(2), np.eye(2), np.zeros((len(x), 2))
    for t, (a, b) in enumerate(zip(x, y)):
        p = p + drift * np.eye(2)
        h = np.array([a, 1.0])
        gain = p @ h / (h @ p @ h + noise)
        theta = theta + gain * (b - h @ theta)
        p = p - np.outer(gain, h) @ p
        out[t] = theta
    return out


def pair_kernels(pairs: DataFrame) -> DataFrame:
    """(code_x, code_y, n, slope, half_life, adf, adf_5pct, kalman_beta) of pair rows (code_x, code_y, date, x, y).

    The recursive kernels run in Arrow batches, one pair at a time; a pair is bounded by its common dates.
    """
    from tapeloom.operators.features import half_life

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        x, y = pdf["x"].to_numpy(float), pdf["y"].to_numpy(float)
        slope = float(np.cov(x, y)[0, 1] / np.var(x, ddof=1)) if len(x) > 1 and np.var(x) > 0 else 0.0
        spread = y - slope * x
        t, critical = adf_statistic(spread)
        beta = float(kalman_hedge(x, y)[-1, 0]) if len(x) else float("nan")
        return pd.DataFrame([(pdf["code_x"].iloc[0], pdf["code_y"].iloc[0], len(x), slope, half_life(spread), t, critical.get(5, float("nan")), beta)], columns=["code_x", "code_y", "n", "slope", "half_life", "adf", "adf_5pct", "kalman_beta"])

    return pairs.groupBy("code_x", "code_y").applyInPandas(work, "code_x string, code_y string, n long, slope double, half_life double, adf double, adf_5pct double, kalman_beta double")


def select_pairs(pairs: DataFrame, kernels: DataFrame, least_corr: float = 0.8, half_lives: tuple[float, float] = (3.0, 20.0), best: float = 10.0) -> DataFrame:
    """(code_x, code_y, return_corr, adf, half_life) of :func:`pair_stats` and :func:`pair_kernels` rows that pass all bounds, those of a
    half-life nearest to ``best`` first, ties by code."""
    both = pairs.select("code_x", "code_y", "return_corr").join(kernels.select("code_x", "code_y", "adf", "adf_5pct", "half_life"), ["code_x", "code_y"])
    ok = both.where((F.col("return_corr") >= least_corr) & (F.col("adf") <= F.col("adf_5pct")) & F.col("half_life").between(*half_lives))
    return ok.orderBy(F.abs(F.col("half_life") - best), "code_x", "code_y").select("code_x", "code_y", "return_corr", "adf", "half_life")


def covariance(returns: DataFrame) -> DataFrame:
    """(code_x, code_y, cov): sample covariance of returns (code, date, r) of a narrowed universe over all its dates, both halves.

    A code's missing returns count as its mean, as do those of dates it has no row for; codes without any return are left out.
    """
    ok = returns.where("r IS NOT NULL").select("code", "date", "r")
    means = ok.groupBy("code").agg(F.avg("r").alias("mean"))
    dates = returns.select("date").distinct().count()
    centred = ok.join(means, "code").select("code", "date", (F.col("r") - F.col("mean")).alias("d"))  # an imputed mean is a deviation of 0
    side = lambda n: centred.select("date", F.col("code").alias(f"code_{n}"), F.col("d").alias(f"d{n}"))
    sums = side("x").join(side("y"), "date").groupBy("code_x", "code_y").agg(F.sum(F.col("dx") * F.col("dy")).alias("s"))
    return sums.select("code_x", "code_y", (F.col("s") / F.lit(float(max(dates - 1, 1)))).alias("cov"))


def shrink(cov: np.ndarray, share: float = 0.1) -> np.ndarray:
    return (1 - share) * cov + share * np.diag(np.diag(cov))


def risk_parity(cov: np.ndarray, least: float = 0.0, most: float = 1.0, rounds: int = 200) -> np.ndarray:
    """Weights of equal risk contributions, by cyclical coordinate descent on the logarithmic barrier form.

    The minimum of x'Cx / 2 - sum(log x) / n has x_i (Cx)_i = 1/n for every i. Along one coordinate that is a quadratic equation with one
    positive root. Scaled to sum 1, and brought between the bounds by the nearest weights that sum to 1.
    """
    c = shrink(np.asarray(cov, float))
    n = len(c)
    own = np.maximum(np.diag(c), 1e-18)
    x = 1 / np.sqrt(own * n)
    for _ in range(rounds):
        before = x.copy()
        for i in range(n):
            others = float(c[i] @ x) - own[i] * x[i]
            x[i] = (np.sqrt(others * others + 4 * own[i] / n) - others) / (2 * own[i])
        if np.abs(x - before).max() <= 1e-12 * x.max():
            break
    return _simplex(x / x.sum(), least, most)


def min_variance(cov: np.ndarray, least: float = 0.0, most: float = 1.0, rounds: int = 2000) -> np.ndarray:
    """Weights of least variance between bounds that sum to 1, by projected gradient."""
    cov, n = shrink(cov), len(cov)
    w, step = np.full(n, 1.0 / n), 0.5 / max(float(np.linalg.eigvalsh(cov)[-1]), 1e-12)
    for _ in range(rounds):
        new = _simplex(w - step * 2 * cov @ w, least, most)
        if np.abs(new - w).max() < 1e-12:
            break
        w = new
    return w


def max_diversification(cov: np.ndarray, least: float = 0.0, most: float = 1.0) -> np.ndarray:
    """Weights of the greatest ratio of mean volatility to portfolio volatility: least variance in units of volatility."""
    sigma = np.sqrt(np.diag(cov))
    w = min_variance(cov / np.outer(sigma, sigma), 0.0, 1.0) / sigma
    return _simplex(w / w.sum(), least, most)


def _simplex(v: np.ndarray, least: float, most: float) -> np.ndarray:
    """Nearest weights between bounds that sum to 1, by bisection on the shift."""
    lo, hi = float((v - most).min()) - 1, float((v - least).max()) + 1
    for _ in range(100):
        mid = (lo + hi) / 2
        if np.clip(v - mid, least, most).sum() > 1:
            lo = mid
        else:
            hi = mid
    return np.clip(v - (lo + hi) / 2, least, most)
