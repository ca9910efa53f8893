"""Rolling backtests, grid search and an autoregressive moving-average forecaster.

Spark makes the windows and the (window, config) rows; the forecaster takes all windows of a batch
that are alike in order and length together, as one stack of least-squares problems.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONFIG = "struct<id:int,p:int,d:int,q:int,sp:int,sd:int,sq:int,m:int,trend:string>"

# 5 percent points of the unit-root t statistic (with constant) by sample size.
UNIT_ROOT_5_PERCENT = {25: -3.00, 50: -2.93, 100: -2.89, 250: -2.88, 500: -2.87}
UNIT_ROOT_5_PERCENT_LARGE = -2.86


def configs(
    p: list[int], d: list[int], q: list[int], sp: list[int] = [0], sd: list[int] = [0],
    sq: list[int] = [0], m: list[int] = [0], trend: list[str] = ["n"],
) -> list[tuple]:
    """All orders as (id, p, d, q, P, D, Q, m, trend); seasonal parts need a period."""
    from itertools import product

    kept = [c for c in product(p, d, q, sp, sd, sq, m, trend) if c[6] > 0 or not any(c[3:6])]
    return [(i, *c) for i, c in enumerate(kept)]


def config_array(grid: list[tuple]) -> Column:
    names = ["id", "p", "d", "q", "sp", "sd", "sq", "m", "trend"]
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, c)]) for c in grid])


def with_configs(windows: DataFrame, grid: list[tuple]) -> DataFrame:
    """Each row once per config."""
    return windows.withColumn("config", F.explode(config_array(grid)))


def _lags(order: int, seasonal: int, period: int) -> list[int]:
    return sorted(set(range(1, order + 1)) | {period * j for j in range(1, seasonal + 1)})


def _back(series: np.ndarray, lags: list[int], start: int) -> list[np.ndarray]:
    """Lagged columns of all series (rows) from ``start`` on."""
    return [series[:, start - lag : series.shape[1] - lag] for lag in lags]


def _solve(columns: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Least squares of every row, from one stacked decomposition; NaN where it is singular."""
    n, length = target.shape
    if not columns:
        return np.zeros((n, 0))
    if length < len(columns):
        return np.full((n, len(columns)), np.nan)
    u, s, vt = np.linalg.svd(np.stack(columns, axis=2), full_matrices=False)
    least = s[:, :1] * max(length, len(columns)) * np.finfo(float).eps
    with np.errstate(divide="ignore", invalid="ignore"):
        turned = np.einsum("nlk,nl->nk", u, target) / s
    beta = np.einsum("nkj,nk->nj", vt, turned)
    beta[(s <= least).any(axis=1)] = np.nan
    return beta


def _filtered(series: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    """Each row (last axis: time) run through the difference filter, where all its past is there."""
    length = series.shape[-1] - len(filter_) + 1
    out = np.zeros((*series.shape[:-1], length))
    for i, weight in enumerate(filter_):
        if weight:
            out += weight * series[..., len(filter_) - 1 - i : len(filter_) - 1 - i + length]
    return out


def fit_forecasts(
    y: np.ndarray, c, horizon: int, x: np.ndarray | None = None, x_next: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Two-step least squares (Hannan and Rissanen) of many windows (rows) at once: forecasts and fitted values.

    ``x`` and ``x_next`` are windows x times x columns. NaN throughout a row whose window is too
    short, holds a NaN or makes the regression singular.
    """
    p, d, q, sp, sd, sq, m, trend = c
    n, size = y.shape
    out, fitted = np.full((n, horizon), np.nan), np.full((n, size), np.nan)
    filter_ = np.array([1.0])
    for _ in range(d):
        filter_ = np.convolve(filter_, [1.0, -1.0])
    for _ in range(sd):
        filter_ = np.convolve(filter_, np.r_[1.0, np.zeros(m - 1), -1.0])
    lost = len(filter_) - 1
    good = np.flatnonzero(~np.isnan(y).any(axis=1))
    if size <= lost + 2 or not len(good):
        return out, fitted
    y = y[good]
    w = _filtered(y, filter_)
    length = w.shape[1]
    both = None
    if x is not None:
        path = np.concatenate([x, x_next], axis=1)[good]
        both = np.moveaxis(_filtered(np.moveaxis(path, 1, 2), filter_), 2, 1)
    ar, ma = _lags(p, sp, m), _lags(q, sq, m)
    e = np.zeros_like(w)
    order = 0
    if ma:  # innovations from a long autoregression
        order = min(max(ar + ma) + 1, length // 3)
        long = _back(w, list(range(1, order + 1)), order) + ([np.ones((len(good), length - order))] if trend == "c" else [])
        beta = _solve(long, w[:, order:])
        e[:, order:] = w[:, order:] - (np.einsum("nlk,nk->nl", np.stack(long, axis=2), beta) if long else 0.0)
    start = max([order + max(ma) if ma else 0, *ar, *ma])
    if start >= length:
        return out, fitted
    columns = _back(w, ar, start) + _back(e, ma, start)
    if both is not None:
        columns += [both[:, start:length, k] for k in range(both.shape[2])]
    if trend == "c":
        columns.append(np.ones((len(good), length - start)))
    failed = np.isnan(e).any(axis=1)  # the long autoregression was singular
    beta = _solve([np.where(failed[:, None], 0.0, col) for col in columns], w[:, start:])
    beta[failed] = np.nan
    ahead = np.einsum("nlk,nk->nl", np.stack(columns, axis=2), beta) if columns else np.zeros((len(good), length - start))
    carried = y[:, lost:] - w  # what differencing took away, known one step ahead
    inside = np.full((len(good), size), np.nan)
    inside[:, lost + start :] = ahead + carried[:, start:]
    nothing = np.zeros((len(good), horizon))
    values, ww, ee = (np.concatenate([part, nothing], axis=1) for part in (y, w, e))
    for h in range(horizon):
        row = [ww[:, length + h - lag] for lag in ar] + [ee[:, length + h - lag] for lag in ma]
        if both is not None:
            row += [both[:, length + h, k] for k in range(both.shape[2])]
        if trend == "c":
            row.append(np.ones(len(good)))
        step = (np.stack(row, axis=1) * beta).sum(axis=1) if row else np.zeros(len(good))
        values[:, size + h] = step - sum(filter_[i] * values[:, size + h - i] for i in range(1, lost + 1))
        ww[:, length + h] = step
    out[good], fitted[good] = values[:, size:], inside
    return out, fitted


def fit_forecast(
    y: np.ndarray, c, horizon: int, x: np.ndarray | None = None, x_next: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """``fit_forecasts`` of one window."""
    more = (None, None) if x is None else (np.asarray(x, float)[None], np.asarray(x_next, float)[None])
    out, fitted = fit_forecasts(np.asarray(y, float)[None], c, horizon, *more)
    return out[0], fitted[0]


def _order(config) -> tuple:
    names = ("p", "d", "q", "sp", "sd", "sq", "m", "trend")
    return tuple(config[n] for n in names)


def _listed(values: np.ndarray) -> list:
    return [None if np.isnan(v) else float(v) for v in values]


#: Numbers of the stacked problems of one decomposition.
STACK = 1_000_000


def _batched(past: pd.Series, config: pd.DataFrame, pick: int, horizon: int, x: pd.Series | None = None,
             x_next: pd.Series | None = None) -> pd.Series:
    """Forecasts (0) or fitted values (1) of all rows; rows of the same order and lengths go together."""
    out: list = [None] * len(past)
    alike: dict[tuple, list[int]] = {}
    ahead = [horizon] * len(past) if x_next is None else [len(b) for b in x_next]
    for i, (y, c) in enumerate(zip(past, config.to_dict("records"))):
        alike.setdefault((_order(c), len(y), ahead[i]), []).append(i)
    for (order, size, steps), rows in alike.items():
        some = max(1, STACK // max(1, size * 8))
        for at in (rows[k : k + some] for k in range(0, len(rows), some)):
            y = np.array([past[i] for i in at], dtype=float).reshape(len(at), size)
            more = () if x is None else (
                np.array([np.stack(x[i]) for i in at], dtype=float), np.array([np.stack(x_next[i]) for i in at], dtype=float))
            for i, values in zip(at, fit_forecasts(y, order, steps, *more)[pick]):
                out[i] = _listed(values)
    return pd.Series(out, dtype=object)


def forecasts(windows: DataFrame, horizon: int, exogenous: bool = False) -> DataFrame:
    """Add ``predicted``: the forecast path of each (window, config) row."""

    @F.pandas_udf("array<double>")
    def plain(past: pd.Series, config: pd.DataFrame) -> pd.Series:
        return _batched(past, config, 0, horizon)

    @F.pandas_udf("array<double>")
    def with_x(past: pd.Series, x: pd.Series, x_next: pd.Series, config: pd.DataFrame) -> pd.Series:
        return _batched(past, config, 0, horizon, x, x_next)

    made = with_x("past", "x_past", "x_future", "config") if exogenous else plain("past", "config")
    return windows.withColumn("predicted", made)


def fitted_values(series: DataFrame) -> DataFrame:
    """Add ``fitted`` to rows of (past, config): one-step fits over the whole series."""

    @F.pandas_udf("array<double>")
    def fits(past: pd.Series, config: pd.DataFrame) -> pd.Series:
        return _batched(past, config, 1, 1)

    return series.withColumn("fitted", fits("past", "config"))


def mean_of_last(windows: DataFrame, widths: list[int]) -> DataFrame:
    """A benchmark forecaster: the mean of the last w values, one row per width."""
    return windows.withColumn("config", F.explode(F.array(*[F.lit(w) for w in widths]))).withColumn(
        "_last", F.slice("past", F.size("past") - F.col("config") + 1, F.col("config"))
    ).withColumn(
        "_mean", F.aggregate("_last", F.lit(0.0), lambda a, v: a + v) / F.col("config")
    ).withColumn("predicted", F.transform("future", lambda _: F.col("_mean"))).drop("_last", "_mean")


def forecast_rows(predicted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, origin, step, target, label, prediction) rows of the paths."""
    zipped = F.arrays_zip(
        F.col("times").alias("target"), F.col("future").alias("label"), F.col("predicted").alias("prediction"))
    steps = predicted.select(*keys, "origin", F.posexplode(zipped).alias("step", "_s"))
    return steps.filter(F.col("_s.target").isNotNull()).select(
        *keys, "origin", (F.col("step") + 1).alias("step"), F.col("_s.target").alias("target"),
        F.col("_s.label").alias("label"), F.col("_s.prediction").alias("prediction"))


def window_scores(predicted: DataFrame, keys: list[str]) -> DataFrame:
    """Mean squared error of each window (null without a forecast)."""
    gaps = F.zip_with("future", "predicted", lambda y, p: (y - p) * (y - p))
    total = F.aggregate(gaps, F.lit(0.0), lambda a, v: a + v)
    return predicted.select(*keys, "origin", (total / F.size("future")).alias("mse"))


def grid_search(scores: DataFrame, series: list[str], config: str, score: str = "mse") -> DataFrame:
    """Config with the lowest mean score per series; the lowest config wins a tie."""
    means = scores.groupBy(*series, config).agg(F.avg(score).alias(score)).filter(F.col(score).isNotNull())
    best = F.min(F.struct(F.col(score), F.col(config)))
    return means.groupBy(*series).agg(best.alias("b")).select(
        *series, F.col(f"b.{config}").alias(config), F.col(f"b.{score}").alias(score))


def unit_root(df: DataFrame, keys: list[str], time: str, value: str, lags: int = 0) -> DataFrame:
    """t statistic of the lagged level in the regression of the change, beside its 5% point.

    The sums of products come from one aggregation; each series then solves a tiny system.
    """
    from pyspark.sql import Window

    from tallyloom.operators.leastsq import gram, solve_groups

    w = Window.partitionBy(*keys).orderBy(time)
    rows = df.withColumn("_dy", F.col(value) - F.lag(value).over(w)).withColumn("_level", F.lag(value).over(w))
    rows = rows.withColumns(
        {"_const": F.lit(1.0), **{f"_dy{i}": F.lag("_dy", i).over(w) for i in range(1, lags + 1)}})
    names = ["_level", "_const", *[f"_dy{i}" for i in range(1, lags + 1)]]
    sums = gram(rows.dropna(subset=["_dy", *names]), names, "_dy", keys)
    solved = solve_groups(sums, names, keys).filter(F.col("term") == "_level")
    critical = F.lit(UNIT_ROOT_5_PERCENT_LARGE)
    for size, point in sorted(UNIT_ROOT_5_PERCENT.items(), reverse=True):
        critical = F.when(F.col("n") <= size, F.lit(point)).otherwise(critical)
    return solved.select(
        *keys, "n", (F.col("beta") / F.col("se")).alias("t"), critical.alias("critical")
    ).withColumn("stationary", F.col("t") < F.col("critical"))
