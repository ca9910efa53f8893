"""Stacked fits against one least-squares problem at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import forecast as fc


def alone(y, c, horizon):
    """One window by hand, with numpy's own solver (no differencing, no exogenous columns)."""
    p, _, q, sp, _, sq, m, trend = c
    ar = sorted(set(range(1, p + 1)) | {m * j for j in range(1, sp + 1)})
    ma = sorted(set(range(1, q + 1)) | {m * j for j in range(1, sq + 1)})
    e, order = np.zeros(len(y)), 0
    const = [1.0] if trend == "c" else []
    if ma:
        order = min(max(ar + ma) + 1, len(y) // 3)
        rows = np.array([[y[t - k] for k in range(1, order + 1)] + const for t in range(order, len(y))])
        e[order:] = y[order:] - rows @ np.linalg.lstsq(rows, y[order:], rcond=None)[0]
    start = max([order + max(ma) if ma else 0, *ar, *ma])
    rows = np.array([[y[t - k] for k in ar] + [e[t - k] for k in ma] + const for t in range(start, len(y))])
    beta = np.linalg.lstsq(rows, y[start:], rcond=None)[0]
    values, ee = list(y), list(e)
    for _ in range(horizon):
        values.append(float(np.dot([values[-k] for k in ar] + [ee[-k] for k in ma] + const, beta)))
        ee.append(0.0)
    return values[len(y):]


ORDERS = [(1, 0, 0, 0, 0, 0, 0, "c"), (2, 0, 1, 0, 0, 0, 0, "c"), (0, 0, 2, 0, 0, 0, 0, "c"), (1, 0, 0, 1, 0, 0, 4, "n"), (1, 0, 1, 0, 0, 1, 4, "n")]


@pytest.mark.parametrize("order", ORDERS)
def test_stack_equals_one_by_one(order):
    y = np.cumsum(np.random.default_rng(1).normal(size=(40, 36)), axis=1) * 0.3 + 5
    got, fitted = fc.fit_forecasts(y, order, 5)
    assert got == pytest.approx(np.array([alone(v, order, 5) for v in y]), rel=1e-6, abs=1e-8)
    assert fitted.shape == y.shape


def test_bad_windows_leave_the_others_alone():
    rng = np.random.default_rng(2)
    y = rng.normal(size=(6, 30))
    order = (1, 0, 1, 0, 0, 0, 0, "c")
    clean, _ = fc.fit_forecasts(y, order, 3)
    spoiled = y.copy()
    spoiled[1, 7] = np.nan
    spoiled[4] = 2.0  # constant: singular
    got, fitted = fc.fit_forecasts(spoiled, order, 3)
    assert np.isnan(got[[1, 4]]).all() and np.isnan(fitted[[1, 4]]).all()
    keep = [0, 2, 3, 5]
    assert (got[keep] == clean[keep]).all()


def test_differences_and_columns_in_a_stack():
    t = np.arange(30.0)
    y = np.stack([3 + 2 * t, 1 - t, 0.5 * t**2])
    line, _ = fc.fit_forecasts(y, (0, 2, 0, 0, 0, 0, 0, "c"), 4)
    assert line == pytest.approx(np.stack([3 + 2 * np.arange(30, 34.0), 1 - np.arange(30, 34.0), 0.5 * np.arange(30, 34.0) ** 2]))
    x = np.random.default_rng(3).normal(size=(3, 34, 2))
    path = x @ np.array([2.0, -1.0]) + 4
    got, _ = fc.fit_forecasts(path[:, :30], (0, 0, 0, 0, 0, 0, 0, "c"), 4, x[:, :30], x[:, 30:])
    assert got == pytest.approx(path[:, 30:])


def test_mixed_rows_of_a_batch(spark):
    """Windows of several lengths and orders, nulls and an empty window, in one table."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=n).tolist()) for i, n in enumerate([24, 30, 24, 12, 2, 0])] + [(6, None), (7, [1.0, None] * 12)]
    df = spark.createDataFrame(rows, "id int, past array<double>").filter("past is not null")
    grid = fc.configs([1, 2], [0], [0, 1], trend=["c"])
    got = fc.forecasts(fc.with_configs(df, grid), 4).select("id", F.col("config.id").alias("c"), "predicted").collect()
    assert len(got) == 7 * len(grid)
    held = dict(rows)
    for r in got:
        if len(held[r["id"]]) < 12 or None in held[r["id"]]:
            assert r["predicted"] == [None] * 4
        else:
            assert r["predicted"] == pytest.approx(alone(np.array(held[r["id"]]), grid[r["c"]][1:], 4), rel=1e-6, abs=1e-8)
