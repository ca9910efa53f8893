"""Outlier masks and reversible scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalar import log_base, pow_base, ratio


def mask_outliers(df: DataFrame, columns: list[str], limit: float = 3.0) -> DataFrame:
    """Null where a value lies more than ``limit`` sample deviations from the pooled mean."""
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_samp(c).alias(f"{c}_std") for c in columns],
        ).alias("m")
    ).scalar()
    masked = {
        c: F.when(
            F.coalesce(ratio(F.abs(F.col(c) - moments[f"{c}_mean"]), moments[f"{c}_std"]), F.lit(0.0))
            <= limit,
            F.col(c),
        )
        for c in columns
    }
    return df.withColumns(masked)


def fit_standard(
    df: DataFrame, columns: list[str], keys: list[str] | None = None, population: bool = False
) -> DataFrame:
    """Centre and spread per column (and key); a zero spread counts as 1."""
    spread = F.stddev_pop if population else F.stddev_samp
    aggregates = [F.avg(c).alias(f"{c}_centre") for c in columns] + [
        F.coalesce(F.nullif(spread(c), F.lit(0.0)), F.lit(1.0)).alias(f"{c}_spread")
        for c in columns
    ]
    return df.groupBy(*keys).agg(*aggregates) if keys else df.agg(*aggregates)


def fit_minmax(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Minimum and range, in the same shape as ``fit_standard``."""
    aggregates = [F.min(c).alias(f"{c}_centre") for c in columns] + [
        F.nullif(F.max(c) - F.min(c), F.lit(0.0)).alias(f"{c}_spread") for c in columns
    ]
    return df.groupBy(*keys).agg(*aggregates) if keys else df.agg(*aggregates)


def _with_fit(df: DataFrame, fitted: DataFrame, columns: list[str], keys: list[str] | None, make):
    if keys:
        joined = df.join(fitted, keys, "left")
        new = {c: make(F.col(c), F.col(f"{c}_centre"), F.col(f"{c}_spread")) for c in columns}
        return joined.withColumns(new).select(*df.columns)
    one = fitted.select(F.struct(*fitted.columns).alias("m")).scalar()
    return df.withColumns(
        {c: make(F.col(c), one[f"{c}_centre"], one[f"{c}_spread"]) for c in columns}
    )


def apply_scale(
    df: DataFrame, fitted: DataFrame, columns: list[str], keys: list[str] | None = None
) -> DataFrame:
    return _with_fit(df, fitted, columns, keys, lambda x, c, s: ratio(x - c, s))


def undo_scale(
    df: DataFrame, fitted: DataFrame, columns: list[str], keys: list[str] | None = None
) -> DataFrame:
    return _with_fit(df, fitted, columns, keys, lambda x, c, s: x * s + c)


class Scaled:
    """Scaling step fitted on one table, usable on others."""

    def __init__(self, fitted: DataFrame, columns: list[str], keys: list[str] | None = None):
        self.fitted, self.columns, self.keys = fitted, columns, keys

    def __call__(self, df: DataFrame) -> DataFrame:
        return apply_scale(df, self.fitted, self.columns, self.keys)

    def reverse(self, df: DataFrame) -> DataFrame:
        return undo_scale(df, self.fitted, self.columns, self.keys)


class Logged:
    """Logarithm step on some columns; the inverse is the plain power."""

    def __init__(self, columns: list[str], base: float = 2.718281828459045):
        self.columns, self.base = columns, base

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: log_base(c, self.base) for c in self.columns})

    def reverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: pow_base(c, self.base) for c in self.columns})


class Kept:
    """Column choice step: forward keeps the columns, reverse drops them."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.select(*self.columns)

    def reverse(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.columns)


class Chain:
    """Steps applied in order and undone in the opposite order."""

    def __init__(self, *steps):
        self.steps = list(steps)

    def __call__(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = df.transform(step)
        return df

    def reverse(self, df: DataFrame) -> DataFrame:
        for step in reversed(self.steps):
            df = df.transform(step.reverse)
        return df


def moments(column: str) -> list[Column]:
    """Mean, sample and population deviation of a column; for the median see ``quantiles``."""
    return [
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.stddev_pop(column).alias("std_pop"),
    ]


def histogram(df: DataFrame, column: str, bins: int, keys: list[str] | None = None) -> DataFrame:
    """Rows per bin of equal width between the smallest and largest value of the column."""
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("e")).scalar()
    place = F.floor(ratio(F.col(column) - ends["lo"], ends["hi"] - ends["lo"]) * bins) + 1
    number = F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("int")
    return df.groupBy(*(keys or []), number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
