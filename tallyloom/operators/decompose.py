"""Seasonal decomposition and autocorrelation of many series at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.scalar import ratio


def additive(df: DataFrame, keys: list[str], time: str, value: str, period: int = 12) -> DataFrame:
    """Centred moving average trend, centred seasonal means, remainder.

    The trend of an even period averages ``period`` rows with half weights at both ends.
    """
    half = period // 2
    w = Window.partitionBy(*keys).orderBy(time)
    inner = w.rowsBetween(-(half - 1), half - 1) if period % 2 == 0 else w.rowsBetween(-half, half)
    total = F.sum(value).over(inner)
    if period % 2 == 0:
        total = total + (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2
    full = F.lag(value, half).over(w).isNotNull() & F.lead(value, half).over(w).isNotNull()
    detrended = df.withColumns({
        "trend": F.when(full, total / period),
        "_phase": (F.row_number().over(w) - 1) % period,
    }).withColumn("_rest", F.col(value) - F.col("trend"))
    phases = detrended.groupBy(*keys, "_phase").agg(F.avg("_rest").alias("_mean"))
    centre = F.avg("_mean").over(Window.partitionBy(*keys))
    seasonal = phases.select(*keys, "_phase", (F.col("_mean") - centre).alias("seasonal"))
    joined = detrended.join(seasonal, [*keys, "_phase"])
    return joined.select(
        *df.columns, "trend", "seasonal",
        (F.col(value) - F.col("trend") - F.col("seasonal")).alias("residual"))


def _loess(x: np.ndarray, y: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Local line with tricube weights over the ``span`` nearest points."""
    n = len(x)
    distance = np.abs(at[:, None] - x[None, :])
    reach = np.sort(distance, axis=1)[:, min(span, n) - 1] + max(0, (span - n) // 2)
    reach = np.maximum(reach, 1e-12)[:, None]
    weight = np.clip(1 - (distance / reach) ** 3, 0, None) ** 3
    weight /= weight.sum(axis=1, keepdims=True)
    mx = weight @ x
    spread = (weight * (x[None, :] - mx[:, None]) ** 2).sum(axis=1)
    tilt = (weight * (x[None, :] - mx[:, None])) @ y
    slope = np.where(spread > 1e-12, tilt / np.maximum(spread, 1e-12), 0.0)
    return weight @ y + slope * (at - mx)


def _stl(y: np.ndarray, period: int, seasonal_span: int, rounds: int = 5):
    """Trend and season by alternating local regressions."""
    n = len(y)
    t = np.arange(n, dtype=float)
    trend_span = int(np.ceil(1.5 * period / (1 - 1.5 / seasonal_span)))
    trend_span += trend_span % 2 == 0
    low_span = period + (period % 2 == 0)
    trend, season = np.zeros(n), np.zeros(n)
    for _ in range(rounds):
        cycle = np.empty(n + 2 * period)
        for phase in range(period):
            part = (y - trend)[phase::period]
            where = np.arange(len(part), dtype=float)
            wide = np.arange(-1, len(part) + 1, dtype=float)
            cycle[phase::period][: len(wide)] = _loess(where, part, wide, seasonal_span)
        smooth = cycle
        for width in (period, period, 3):
            smooth = np.convolve(smooth, np.ones(width) / width, "valid")
        season = cycle[period : period + n] - _loess(t, smooth, t, low_span)
        trend = _loess(t, y - season, t, trend_span)
    return trend, season


def stl(df: DataFrame, keys: list[str], time: str, value: str, period: int = 12,
        seasonal_span: int = 7) -> DataFrame:
    """Trend, seasonal and residual by local regression, one series per group."""

    def parts(series: pd.DataFrame) -> pd.DataFrame:
        ordered = series.sort_values(time)
        y = ordered[value].to_numpy(dtype=float)
        if len(y) < 2 * period or np.isnan(y).any():
            return ordered.assign(trend=np.nan, seasonal=np.nan, residual=np.nan)
        trend, season = _stl(y, period, seasonal_span)
        return ordered.assign(trend=trend, seasonal=season, residual=y - trend - season)

    # the grouping uses this partitioning, so a series is moved once
    narrow = df.select(*keys, time, value).repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields)
    out = narrow.groupBy(*keys).applyInPandas(
        parts, f"{schema}, trend double, seasonal double, residual double")
    return out.withColumns({c: F.nanvl(c, F.lit(None)) for c in ("trend", "seasonal", "residual")})


def autocorrelation(df: DataFrame, keys: list[str], time: str, value: str, lags: int = 10) -> DataFrame:
    """Autocorrelation for lags 0..lags around the mean of the whole series."""
    w = Window.partitionBy(*keys).orderBy(time)
    centred = df.withColumn("_x", F.col(value) - F.avg(value).over(Window.partitionBy(*keys)))
    products = centred.select(
        *keys, *[(F.col("_x") * F.lag("_x", k).over(w)).alias(f"_{k}") for k in range(lags + 1)])
    sums = products.groupBy(*keys).agg(
        F.array(*[ratio(F.coalesce(F.sum(f"_{k}"), F.lit(0.0)), F.sum("_0")) for k in range(lags + 1)]).alias("_r"))
    return sums.select(*keys, F.posexplode("_r").alias("lag", "acf"))


def partial_autocorrelation(acf: DataFrame, keys: list[str]) -> DataFrame:
    """Durbin-Levinson recursion on the few autocorrelations of each series."""

    def recursion(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("lag")
        r = ordered["acf"].to_numpy(dtype=float)
        out, phi = [1.0], np.zeros(0)
        for k in range(1, len(r)):
            rest = 1 - phi @ r[1:k]
            last = (r[k] - phi @ r[1:k][::-1]) / rest if abs(rest) > 1e-12 else np.nan
            phi = np.append(phi - last * phi[::-1], last)
            out.append(last)
        return ordered.assign(pacf=out)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in acf.schema.fields)
    return acf.groupBy(*keys).applyInPandas(recursion, f"{schema}, pacf double")
