"""Volatility and regime models of one series, fitted by likelihood in numpy; run in Arrow batches, one entity at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.windows import back, ratio


def garch_variance(r: np.ndarray, alpha: float, beta: float) -> np.ndarray:
    """Conditional variances of GARCH(1,1) with the long-run variance at the sample's."""
    long = float(np.var(r)) or 1e-12
    out, v = np.empty(len(r)), long
    for t, x in enumerate(r):
        out[t] = v
        v = long * (1 - alpha - beta) + alpha * x * x + beta * v
    return out


def garch_fit(r: np.ndarray) -> tuple[float, float, np.ndarray]:
    """(alpha, beta, variances) of the greatest likelihood on a grid that is refined twice around its best point."""
    r = np.asarray(r, float) - np.mean(r)

    def loss(a: float, b: float) -> float:
        v = np.maximum(garch_variance(r, a, b), 1e-12)
        return float(np.sum(np.log(v) + r * r / v))

    best, step = (0.05, 0.9), 0.1
    grid = [(a, b) for a in np.arange(0.0, 0.41, 0.1) for b in np.arange(0.3, 0.96, 0.1) if a + b < 0.999]
    for _ in range(3):
        best = min(grid, key=lambda p: loss(*p))
        step /= 3
        grid = [(a, b) for a in best[0] + step * np.arange(-2, 3) for b in best[1] + step * np.arange(-2, 3) if a >= 0 and b >= 0 and a + b < 0.999]
    best = min([best, *grid], key=lambda p: loss(*p))
    return float(best[0]), float(best[1]), garch_variance(r, *best)


def position_scale(forecast: float, history: np.ndarray, low: float = 0.2, high: float = 0.8, at_low: float = 1.0, at_high: float = 0.5) -> float:
    """Position for a forecast volatility: ``at_low`` under the ``low`` percentile of the history, ``at_high`` over the ``high`` one, and on
    the straight line between."""
    bounds = np.percentile(history, [100 * low, 100 * high])
    if forecast > bounds[1]:
        return at_high
    if forecast < bounds[0] or bounds[1] == bounds[0]:
        return at_low
    return float(np.interp(forecast, bounds, [at_low, at_high]))


def garch_scale(returns: DataFrame, least: int = 30, window: int = 60, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """(code, n, alpha, beta, volatility, scale) of returns (code, date, r): the volatility that the model forecasts for the next row, and
    the position it allows by :func:`position_scale` against the deviations of 5 rows, the last ``window`` of them; 1 where there are
    fewer. Codes of under ``least`` returns are left out."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.sort_values("date")["r"].dropna().to_numpy(float)
        if len(r) < least or not np.var(r):
            return pdf.iloc[:0].assign(n=0, alpha=0.0, beta=0.0, volatility=0.0, scale=0.0)[["code", "n", "alpha", "beta", "volatility", "scale"]]
        a, b, v = garch_fit(r)
        last = float(r[-1] - r.mean())
        ahead = float(np.sqrt(float(np.var(r)) * (1 - a - b) + a * last * last + b * v[-1]))
        past = pd.Series(r).rolling(5).std().dropna().to_numpy()
        scale = position_scale(ahead, past[-window:], low, high) if len(past) >= window else 1.0
        return pd.DataFrame([(pdf["code"].iloc[0], len(r), a, b, ahead, scale)], columns=["code", "n", "alpha", "beta", "volatility", "scale"])

    return returns.select("code", "date", "r").groupBy("code").applyInPandas(work, "code string, n long, alpha double, beta double, volatility double, scale double")


def regime_observations(series: DataFrame, window: int = 20) -> DataFrame:
    """(code, date, momentum, volatility, volume_ratio) of series (code, date, close, amount): mean and deviation of the last ``window``
    changes of the close, and the amount of the row before over the mean of the ``window`` up to it; null until there are as many."""
    w = Window.partitionBy("code").orderBy("date")
    change = ratio(F.col("close"), F.lag("close", 1).over(w)) - 1
    df = series.select("code", "date", "amount", change.alias("__r")).withColumn("__n", F.count("__r").over(back(w, window)))
    whole = lambda c: F.when(F.col("__n") >= window, c)
    before = F.avg("amount").over(w.rowsBetween(-window, -1))
    return df.select("code", "date", whole(F.avg("__r").over(back(w, window))).alias("momentum"), whole(F.stddev_samp("__r").over(back(w, window))).alias("volatility"), whole(F.lag("amount", 1).over(w) / (before + 1e-8)).alias("volume_ratio"))


def hidden_states(x: np.ndarray, states: int = 3, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(most likely path, means, transitions) of a Gaussian hidden Markov model with diagonal covariances, by Baum-Welch from quantile starts.

    States are in the order of the mean of the first column. Rows with missing values must be left out before.
    """
    x = np.asarray(x, float)
    x = (x - x.mean(axis=0)) / np.maximum(x.std(axis=0), 1e-9)
    n, d = x.shape
    cut = np.quantile(x[:, 0], np.linspace(0, 1, states + 1))
    group = np.clip(np.searchsorted(cut, x[:, 0], side="right") - 1, 0, states - 1)
    mean = np.array([x[group == k].mean(axis=0) if (group == k).any() else x.mean(axis=0) for k in range(states)])
    var = np.ones((states, d))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9)
    start = np.full(states, 1.0 / states)

    def density() -> np.ndarray:
        z = -0.5 * (((x[:, None, :] - mean) ** 2 / var).sum(axis=2) + np.log(var).sum(axis=1))
        return np.exp(z - z.max(axis=1, keepdims=True)) + 1e-300

    for _ in range(rounds):
        e = density()
        a, scale = np.empty((n, states)), np.empty(n)
        for t in range(n):
            a[t] = e[t] * (start if t == 0 else a[t - 1] @ move)
            scale[t] = a[t].sum()
            a[t] /= scale[t]
        b = np.ones((n, states))
        for t in range(n - 2, -1, -1):
            b[t] = move @ (e[t + 1] * b[t + 1]) / scale[t + 1]
        g = a * b
        g /= g.sum(axis=1, keepdims=True)
        pairs = (a[:-1, :, None] * move * (e[1:] * b[1:])[:, None, :] / scale[1:, None, None]).sum(axis=0)
        move = (pairs + 1e-6) / (pairs + 1e-6).sum(axis=1, keepdims=True)
        start = g[0]
        weight = g.sum(axis=0)[:, None] + 1e-9
        mean = (g.T @ x) / weight
        var = np.maximum((g.T @ x**2) / weight - mean**2, 1e-3)
    order = np.argsort(mean[:, 0], kind="stable")
    mean, var, move, start = mean[order], var[order], move[np.ix_(order, order)], start[order]
    e, log_move = np.log(density()), np.log(move)
    score, back = np.log(start + 1e-300) + e[0], np.zeros((n, states), int)
    for t in range(1, n):
        all_ = score[:, None] + log_move
        back[t], score = all_.argmax(axis=0), all_.max(axis=0) + e[t]
    path = np.empty(n, int)
    path[-1] = score.argmax()
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path, mean, move


def hidden_regimes(observations: DataFrame, columns: list[str], states: int = 3) -> DataFrame:
    """(code, date, state): the most likely state of each row, 0 the lowest mean of the first column. Rows with nulls are left out, and
    codes of under 10 rows for each state."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna().sort_values("date")
        if len(pdf) < 10 * states:
            return pdf.iloc[:0].assign(state=0)[["code", "date", "state"]]
        path, _, _ = hidden_states(pdf[columns].to_numpy(float), states)
        return pd.DataFrame({"code": pdf["code"], "date": pdf["date"], "state": path})

    return observations.select("code", "date", *columns).groupBy("code").applyInPandas(work, "code string, date date, state long")
