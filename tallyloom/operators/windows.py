"""Row-count windows over the months of a series: splits, supervised windows, lags.

A series has one row per month, so every window here is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_index(df: DataFrame, keys: list[str], time: str, name: str = "index") -> DataFrame:
    """0-based row number inside each series."""
    w = Window.partitionBy(*keys).orderBy(time)
    return df.withColumn(name, (F.row_number().over(w) - 1).cast("int"))


def chronological_split(
    df: DataFrame, keys: list[str], time: str, train_end: float | int = 0.7,
    val_end: float | int = 0.9, connect: bool = False, window: int = 1,
) -> DataFrame:
    """Add ``split``: train, then val, then test by time, bounds as counts or fractions.

    With ``connect`` val and test start window - 1 rows earlier, so that the first forecast
    of each exists; such rows appear in two splits.
    """
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))

    def bound(b: float | int) -> Column:
        return F.lit(b) if isinstance(b, int) else F.floor(size * F.lit(b)).cast("int")

    back = window - 1 if connect else 0
    i = F.col("index")
    train, val = F.col("_train"), F.col("_val")
    numbered = with_index(df, keys, time).withColumns({"_train": bound(train_end), "_val": bound(val_end)})
    parts = F.array_compact(F.array(
        F.when(i < train, F.lit("train")),
        F.when((i >= train - back) & (i < val), F.lit("val")),
        F.when(i >= val - back, F.lit("test")),
    ))
    return numbered.withColumn("split", F.explode(parts)).drop("index", "_train", "_val")


def split_at(df: DataFrame, time: str, end_train: str, start_test: str) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(time) <= end_train), df.filter(F.col(time) >= start_test)


def input_columns(columns: list[str], labels: list[str]) -> list[str]:
    """Inputs without the label columns."""
    return [c for c in columns if c not in labels]


def supervised_windows(
    df: DataFrame, keys: list[str], time: str, inputs: list[str], labels: list[str],
    input_width: int, label_width: int, shift: int,
) -> DataFrame:
    """n - total + 1 windows per series, total = input_width + shift, stride 1.

    ``inputs`` holds the first input_width rows, ``labels`` the last label_width rows.
    """
    total = input_width + shift
    ahead = Window.partitionBy(*keys).orderBy(time).rowsBetween(0, total - 1)
    columns = list(dict.fromkeys([time, *inputs, *labels]))
    rows = F.collect_list(F.struct(*columns)).over(ahead)
    full = df.withColumn("_rows", rows).filter(F.size("_rows") == total)
    return full.select(
        *keys, F.col(time).alias("start"),
        F.transform(F.slice("_rows", 1, input_width),
                    lambda r: F.struct(*[r[c].alias(c) for c in [time, *inputs]])).alias("inputs"),
        F.transform(F.slice("_rows", total - label_width + 1, label_width),
                    lambda r: F.struct(*[r[c].alias(c) for c in [time, *labels]])).alias("labels"),
    )


def window_rows(windows: DataFrame, keys: list[str], roles: list[str]) -> DataFrame:
    """One row per step of each role (``inputs``, ``labels``) of each window, in one pass.

    The roles must hold the same columns.
    """
    steps = [
        F.transform(role, lambda x, i: F.struct(
            F.lit(role).alias("role"), (i + 1).alias("step"), x.alias("_r")))
        for role in roles
    ]
    rows = windows.select(*keys, "start", F.inline(F.concat(*steps)))
    return rows.select(*keys, "start", "role", "step", "_r.*")


def sequences(df: DataFrame, keys: list[str], time: str, columns: list[str], n: int,
              drop_last: bool = False) -> DataFrame:
    """Runs of ``n`` rows; the univariate form leaves out the run that ends on the last row."""
    w = Window.partitionBy(*keys).orderBy(time)
    rows = F.collect_list(F.struct(*columns)).over(w.rowsBetween(0, n - 1))
    need = n + 1 if drop_last else n
    left = F.count(F.lit(1)).over(w.rowsBetween(0, need - 1))
    return (
        df.withColumns({"_rows": rows, "_left": left})
        .filter(F.col("_left") == need)
        .select(*keys, F.col(time).alias("start"), F.col("_rows").alias("rows"))
    )


def lagged(df: DataFrame, keys: list[str], time: str, value: str, lags: int) -> DataFrame:
    """Design of an autoregression: constant and the value 1..lags rows back."""
    w = Window.partitionBy(*keys).orderBy(time)
    return df.withColumns(
        {"const": F.lit(1.0), **{f"{value}_lag{i}": F.lag(value, i).over(w) for i in range(1, lags + 1)}}
    )


def origins(
    df: DataFrame, keys: list[str], time: str, value: str, history: int, horizon: int,
    stride: int = 1, partial: bool = False, exogenous: list[str] | None = None,
) -> DataFrame:
    """One row per forecast origin: ``history`` values before it, ``horizon`` values from it.

    stride 1 is the rolling backtest; stride = horizon with ``partial`` is the moving window
    whose last block may be shorter. Windows with a null or with too few rows are left out.
    """
    w = Window.partitionBy(*keys).orderBy(time)
    before, after = w.rowsBetween(-history, -1), w.rowsBetween(0, horizon - 1)
    made = {
        "past": F.collect_list(value).over(before),
        "future": F.collect_list(value).over(after),
        "times": F.collect_list(time).over(after),
        "_index": F.row_number().over(w) - 1,
    }
    if exogenous:
        x = F.array(*[F.col(c).cast("double") for c in exogenous])
        made |= {"x_past": F.collect_list(x).over(before), "x_future": F.collect_list(x).over(after)}
    rows = df.withColumns(made)
    whole = F.size("future") == (F.size("times") if partial else F.lit(horizon))
    on_stride = (F.col("_index") - history) % stride == 0
    wanted = ["past", "future", "times"] + (["x_past", "x_future"] if exogenous else [])
    return rows.filter((F.size("past") == history) & whole & (F.col("_index") >= history) & on_stride).select(
        *keys, F.col(time).alias("origin"), *wanted)


def rolling_apply(
    df: DataFrame, keys: list[str], time: str, value: str, width: int,
    metric: Callable[[Column], Column],
) -> DataFrame:
    """Apply a column function to the array of each run of ``width`` values; null until the run is full.

    A Python function over the values goes in as ``python_metric(function)``.
    """
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(-(width - 1), 0)
    runs = df.withColumn("_run", F.collect_list(value).over(w))
    score = metric(F.when(F.size("_run") == width, F.col("_run")))
    return runs.withColumn("score", F.nanvl(score, F.lit(None))).drop("_run")


def python_metric(function: Callable[[np.ndarray], float]) -> Callable[[Column], Column]:
    """A Python function of one run as a column function, called once per full run."""

    @F.pandas_udf("double")
    def score(runs: pd.Series) -> pd.Series:
        return runs.map(lambda run: float(function(run)), na_action="ignore").astype("float64")

    return score


def ith_step(forecasts: DataFrame, labels: DataFrame, keys: list[str], step: int, time: str,
             value: str) -> DataFrame:
    """The forecasts made ``step`` rows ahead from all origins, beside the true values."""
    chosen = forecasts.filter(F.col("step") == step)
    truth = labels.select(*keys, F.col(time).alias("target"), F.col(value).alias("label"))
    return chosen.join(truth, [*keys, "target"])


def weights_by_partner(weights: DataFrame, partner: str, feature: str, weight: str,
                       features: list[str]) -> DataFrame:
    """(feature, partner, weight) rows to one row per partner."""
    return weights.groupBy(partner).agg(
        *[F.max(F.when(F.col(feature) == f, F.col(weight))).alias(f) for f in features])


def chosen_features(weights: DataFrame, feature: str, weight: str, labels: list[str],
                    k: int | None = None) -> DataFrame:
    """Features with the k highest mean weights (or at least the mean weight), plus the labels."""
    means = weights.groupBy(feature).agg(F.avg(weight).alias("mean"))
    # one row per feature
    rank = F.row_number().over(Window.orderBy(F.col("mean").desc(), F.col(feature)))
    overall = F.avg("mean").over(Window.partitionBy())
    keep = (rank <= k) if k is not None else (F.col("mean") >= overall)
    return means.withColumn("_keep", keep).filter(F.col("_keep") | F.col(feature).isin(labels)).drop("_keep")
