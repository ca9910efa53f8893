"""Least squares from sums of products: one aggregation, then a k x k solve."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalar import above, below_cubed


def gram(df: DataFrame, xs: list[str], y: str, keys: list[str] | None = None) -> DataFrame:
    """One row per key: n, sums x_i*x_j (i <= j), x_i*y and y*y, reduced map-side."""
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.col(y) * F.col(y)).alias("yy")]
    sums += [F.sum(F.col(x) * F.col(y)).alias(f"xy_{i}") for i, x in enumerate(xs)]
    sums += [
        F.sum(F.col(xs[i]) * F.col(xs[j])).alias(f"xx_{i}_{j}")
        for i, j in combinations_with_replacement(range(len(xs)), 2)
    ]
    return df.groupBy(*keys).agg(*sums) if keys else df.agg(*sums)


def unpack(row, k: int) -> tuple[np.ndarray, np.ndarray, float, int]:
    """X'X, X'y, y'y and n of one row of ``gram``."""
    xx = np.zeros((k, k))
    for i, j in combinations_with_replacement(range(k), 2):
        xx[i, j] = xx[j, i] = row[f"xx_{i}_{j}"] or 0.0
    xy = np.array([row[f"xy_{i}"] or 0.0 for i in range(k)])
    return xx, xy, float(row["yy"] or 0.0), int(row["n"])


def solve(row, k: int, penalty: np.ndarray | None = None) -> np.ndarray:
    xx, xy, _, _ = unpack(row, k)
    return np.linalg.lstsq(xx if penalty is None else xx + penalty, xy, rcond=None)[0]


def fit(df: DataFrame, xs: list[str], y: str, penalty: np.ndarray | None = None) -> np.ndarray:
    """Coefficients; only the k x k sums reach the driver."""
    return solve(gram(df, xs, y).first(), len(xs), penalty)


def solve_groups(sums: DataFrame, xs: list[str], keys: list[str]) -> DataFrame:
    """(keys, n, term, beta, se) from the rows of a grouped ``gram``."""
    k = len(xs)
    key_schema = ", ".join(f"{c} {sums.schema[c].dataType.simpleString()}" for c in keys)

    def each(batches):
        for batch in batches:
            rows = []
            for row in batch.to_dict("records"):
                xx, xy, yy, n = unpack(row, k)
                beta, _, rank, _ = np.linalg.lstsq(xx, xy, rcond=None)
                if rank == k and n > k:
                    s2 = max(yy - beta @ xy, 0.0) / (n - k)
                    se = np.sqrt(np.maximum(np.diag(np.linalg.inv(xx)) * s2, 0))
                else:
                    beta, se = np.full(k, np.nan), np.full(k, np.nan)
                rows += [(*[row[c] for c in keys], n, xs[i], beta[i], se[i]) for i in range(k)]
            yield pd.DataFrame(rows, columns=[*keys, "n", "term", "beta", "se"])

    out = sums.mapInPandas(each, f"{key_schema}, n bigint, term string, beta double, se double")
    return out.withColumns({c: F.nanvl(c, F.lit(None)) for c in ("beta", "se")})


def linear_basis(x: str, knots: list[float]) -> dict[str, Column]:
    """1, x and a hinge at each knot."""
    return {"b0": F.lit(1.0), "b1": F.col(x), **{f"b{i + 2}": above(x, k) for i, k in enumerate(knots)}}


def cubic_basis(x: str, knot: float) -> dict[str, Column]:
    """1, x, x^2, x^3 and the cubed part below the knot."""
    c = F.col(x)
    return {"b0": F.lit(1.0), "b1": c, "b2": c * c, "b3": c * c * c, "b4": below_cubed(x, knot)}


def linear_then_cubic_basis(x: str, knot: float) -> dict[str, Column]:
    """Straight above the knot, cubic below it."""
    return {"b0": F.lit(1.0), "b1": F.col(x), "b2": below_cubed(x, knot)}


def fit_basis(df: DataFrame, basis: dict[str, Column], y: str,
              penalty: np.ndarray | None = None) -> tuple[np.ndarray, DataFrame]:
    """Coefficients of a spline basis and the rows with ``fitted``."""
    expanded = df.withColumns(basis)
    beta = fit(expanded, list(basis), y, penalty)
    value = sum((F.lit(float(b)) * F.col(c) for b, c in zip(beta, basis)), F.lit(0.0))
    return beta, expanded.withColumn("fitted", value).drop(*basis)


def smoothing_penalty(knots: list[float], lam: float, n: int) -> np.ndarray:
    """Penalty on the changes of slope at the knots of ``linear_basis``."""
    return np.diag([0.0, 0.0, *[lam * n] * len(knots)])


def additive_model(df: DataFrame, xs: list[str], y: str, knots: dict[str, list[float]],
                   lam: float = 1e-3) -> tuple[float, DataFrame]:
    """y = c + g1(x1) + g2(x2) + ...: centred spline parts, c the mean of y.

    The basis columns are centred with one aggregation, so each part has mean zero.
    """
    columns: dict[str, Column] = {}
    part_of: dict[str, str] = {}
    for x in xs:
        for name, c in list(linear_basis(x, knots[x]).items())[1:]:
            columns[f"{x}_{name}"] = c
            part_of[f"{x}_{name}"] = x
    raw = df.withColumns(columns)
    centre = raw.agg(*[F.avg(c).alias(c) for c in columns], F.avg(y).alias("_y")).first()
    centred = raw.withColumns(
        {**{c: F.col(c) - F.lit(centre[c]) for c in columns}, "_y": F.col(y) - F.lit(centre["_y"])})
    sums = gram(centred, list(columns), "_y").first()
    scale = np.array([sums[f"xx_{i}_{i}"] or 1.0 for i in range(len(columns))])
    beta = solve(sums, len(columns), np.diag(lam * scale))
    parts = {
        f"g_{x}": sum((F.lit(float(b)) * F.col(c) for b, c in zip(beta, columns) if part_of[c] == x), F.lit(0.0))
        for x in xs
    }
    return float(centre["_y"]), centred.withColumns(parts).drop(*columns, "_y")
