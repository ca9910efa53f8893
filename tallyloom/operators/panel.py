"""The (month x partner) panel: reshape, densify, enrich, price, choose partners."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.scalar import ratio, unit_price
from tallyloom.operators import fill
from tallyloom.operators.ordered import running, running_by
from tallyloom.session import stage


def pivot_indicators(
    records: DataFrame, keys: list[str], indicators: list[str],
    name: str = "indicator", value: str = "value",
) -> DataFrame:
    """Exact duplicates out, one column per indicator, rows with any null dropped.

    The indicator names are given, so no extra job looks for them. max() of one distinct
    value is that value, and exact duplicates fold into it map-side.
    """
    wide = records.groupBy(*keys).agg(
        *[F.max(F.when(F.col(name) == i, F.col(value))).alias(i) for i in indicators]
    )
    return wide.dropna(subset=indicators)


def price_by(df: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    """Sum value and quantity per key and divide the sums."""
    sums = df.groupBy(*keys).agg(F.sum("quantity").alias("quantity"), F.sum("value").alias("value"))
    return sums.withColumn(price, unit_price("value", "quantity"))


def densify(
    df: DataFrame, keys: list[str], month: str = "month", calendar: bool = False, staged: bool = True
) -> DataFrame:
    """One row per (key, month) for all keys and all months seen.

    The months are one array (bounded by the calendar) exploded under each distinct key,
    so no cross join is planned. ``calendar`` takes every month from first to last.
    The input is read three times (months, keys, cells), so it is staged first unless it is
    a stored table already.
    """
    if staged:
        df = stage(df, "cells")
    if calendar:
        ends = df.agg(F.struct(F.min(month).alias("a"), F.max(month).alias("b")).alias("e")).scalar()
        months = F.sequence(ends["a"], ends["b"], F.expr("interval 1 month"))
    else:
        months = df.agg(F.array_sort(F.collect_set(month))).scalar()
    grid = df.select(*keys).distinct().withColumn(month, F.explode(months))
    return grid.join(df, [*keys, month], "left").select(*df.columns)


def outer_fold(tables: list[DataFrame], on: list[str]) -> DataFrame:
    """Full outer join of many tables on one shared key."""
    return reduce(lambda a, b: a.join(b, on, "full"), tables)


def sum_parts(tables: list[DataFrame], on: list[str], values: list[str]) -> DataFrame:
    """Sum of several tables over one key: a union and one aggregation, no outer joins."""
    return (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
        .groupBy(*on)
        .agg(*[F.sum(v).alias(v) for v in values])
    )


def patch(left: DataFrame, right: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Left value where present, else the right one; keys of both sides stay."""
    other = right.select(*on, *[F.col(c).alias(f"_r_{c}") for c in columns])
    joined = left.join(other, on, "full")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_r_{c}")) for c in columns}
    ).drop(*[f"_r_{c}" for c in columns])


def scale_by_month(df: DataFrame, factors: DataFrame, value: str, factor: str, month: str = "month"):
    """Multiply each series by the factor of its month."""
    return df.join(factors.select(month, factor), month, "left").withColumn(
        value, F.col(value) * F.col(factor)
    ).drop(factor)


def share_weights(df: DataFrame, keys: list[str]) -> DataFrame:
    """Weight of a row inside its (month, product) and the weighted figures."""
    totals = df.groupBy(*keys).agg(F.sum("quantity").alias("total_quantity"))
    weighted = df.join(totals, keys).withColumn("weight", ratio("quantity", "total_quantity"))
    return weighted.withColumns(
        {
            "weighted_price": F.col("weight") * F.col("price"),
            "weighted_quantity": F.col("weight") * F.col("quantity"),
            "weighted_value": F.col("weight") * F.col("value"),
        }
    )


def fill_price_by_global(
    panel: DataFrame, partner: str = "partner", month: str = "month", price: str = "price",
    global_price: str = "globalprice",
) -> DataFrame:
    """Missing price = nearest known price of the partner x (1 + global change of the month).

    The global change is taken over the one row per month that the panel implies.
    """
    by_month = panel.groupBy(month).agg(F.max(global_price).alias("_g"))
    # one row per month
    change = by_month.select(
        month, (F.lit(1.0) + fill.percent_change("_g", [], month)).alias("_factor")
    )
    filled = panel.withColumn("_near", fill.forward_then_backward(price, [partner], month))
    return (
        filled.join(change, month, "left")
        .withColumn(price, F.coalesce(F.col(price), F.col("_near") * F.col("_factor")))
        .drop("_near", "_factor")
    )


def fill_price_by_partners(
    panel: DataFrame, references: list[str], partner: str = "partner", month: str = "month",
    price: str = "price",
) -> DataFrame:
    """As above, the change being the mean change over named reference partners."""
    named = panel.filter(F.col(partner).isin(references)).withColumn(
        "_c", fill.percent_change(price, [partner], month)
    )
    change = named.groupBy(month).agg((F.lit(1.0) + F.avg("_c")).alias("_factor"))
    filled = panel.withColumn("_near", fill.forward_then_backward(price, [partner], month))
    return (
        filled.join(change, month, "left")
        .withColumn(price, F.coalesce(F.col(price), F.col("_near") * F.col("_factor")))
        .drop("_near", "_factor")
    )


def cumulative_share(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Totals per key, largest first, with running sum, share and the share before the row."""
    totals = stage(df.groupBy(key).agg(F.sum(amount).alias(amount)), "totals")
    grand = totals.agg(F.sum(amount)).scalar()
    ranked = running(
        totals, amount, [key], {"cumulative": amount}, descending=True, staged=False)
    return ranked.withColumns({
        "share": ratio("cumulative", grand),
        "share_before": ratio(F.col("cumulative") - F.col(amount), grand),
    })


def top_partners(df: DataFrame, key: str, amount: str, cut: float = 0.8) -> DataFrame:
    """Smallest set of largest keys whose share reaches ``cut``; the crossing key stays."""
    return cumulative_share(df, key, amount).filter(F.col("share_before") < cut)


def tail_share(
    df: DataFrame, groups: list[str], key: str, amount: str, cut: float = 0.8
) -> DataFrame:
    """Keys of a group whose running share is already at or past ``cut``.

    One row per (group, key) is left before the running sums, and a group of any number of keys
    is cut into slices.
    """
    totals = df.groupBy(*groups, key).agg(F.sum(amount).alias(amount))
    ranked = running_by(totals, groups, amount, [key], {"_upto": amount}, {"_whole": amount}, descending=True, position=None)
    return ranked.withColumn("share", ratio("_upto", "_whole")).filter(F.col("share") >= cut).drop("_upto", "_whole")


def top_means(
    df: DataFrame, group: str, key: str, value: str, groups: list[str], n: int = 10,
    null_as_zero: bool = False,
) -> DataFrame:
    """The ``n`` keys with the highest mean per group, one column of keys per group."""
    x = F.coalesce(F.col(value), F.lit(0.0)) if null_as_zero else F.col(value)
    means = df.groupBy(group, key).agg(F.avg(x).alias("mean"))
    ranked = running_by(means, [group], "mean", [key], descending=True, position="rank").filter(F.col("rank") <= n)
    return ranked.withColumn("rank", F.col("rank").cast("int")).groupBy("rank").agg(
        *[F.max(F.when(F.col(group) == g, F.col(key))).alias(g) for g in groups]
    )


def names(df: DataFrame, column: str, most: int = 1000) -> list[str]:
    """The distinct values of a column in order, as columns are to be named after them; above ``most`` it is an error."""
    found = [row[0] for row in df.filter(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(found)


def daily_then_monthly(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Mean per (key, day) first, then the month: mean of avg, lowest low, highest high."""
    daily = df.groupBy(*keys, day).agg(
        F.avg("tmin").alias("tmin"), F.avg("tavg").alias("tavg"), F.avg("tmax").alias("tmax")
    )
    return daily.groupBy(*keys, F.trunc(day, "month").alias("month")).agg(
        F.avg("tavg").alias("avg_tavg"), F.min("tmin").alias("min_tmin"), F.max("tmax").alias("max_tmax")
    )


def to_long(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Wide features to (keys, feature, value) rows."""
    return df.unpivot(keys, features, "feature", "value")


def to_wide(df: DataFrame, month: str, partner: str, value: str, partners: list[str]) -> DataFrame:
    """Month rows x partner columns in sorted order, for the sink only."""
    return df.groupBy(month).agg(
        *[F.avg(F.when(F.col(partner) == p, F.col(value))).alias(p) for p in sorted(partners)]
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row per key in the given order, by a mergeable min of (order, row).

    No window: a hot key is reduced map-side.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.expr(o) if isinstance(o, str) else o for o in order], F.struct(*rest).alias("r"))
    return df.groupBy(*keys).agg(F.min(row)["r"].alias("r")).select(*keys, "r.*").select(*df.columns)


def nth_values(df: DataFrame, column: str, row: str, numbers: list[int] | None = None) -> DataFrame:
    """Number the distinct values of ``column`` in first-seen order (0-based), keep the wanted ones."""
    first = df.groupBy(column).agg(F.min(row).alias("_first"))
    numbered = running(first, "_first", [column]).select(column, (F.col("position") - 1).cast("int").alias(f"{column}_index"))
    if numbers is not None:
        numbered = numbered.filter(F.col(f"{column}_index").isin(numbers))
    return df.join(numbered, column)
