"""Gap filling and differences along one series (a partner, a country).

Every window is partitioned by the series; a series has one row per month, so its
length is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.scalar import ratio
from tallyloom.operators.ordered import running
from tallyloom.session import stage


def _series(keys: list[str], time: str):
    return Window.partitionBy(*keys).orderBy(time)


def percent_change(value: str, keys: list[str], time: str) -> Column:
    """x / previous x - 1; 0 on the first row and where it is undefined."""
    previous = F.lag(value).over(_series(keys, time))
    return F.coalesce(ratio(F.col(value), previous) - 1, F.lit(0.0))


def difference(value: str, keys: list[str], time: str) -> Column:
    """x - previous x, 0 on the first row."""
    w = _series(keys, time)
    return F.when(F.row_number().over(w) == 1, F.lit(0.0)).otherwise(
        F.col(value) - F.lag(value).over(w)
    )


def forward(value: str, keys: list[str], time: str) -> Column:
    w = _series(keys, time).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(w)


def backward(value: str, keys: list[str], time: str) -> Column:
    w = _series(keys, time).rowsBetween(0, Window.unboundedFollowing)
    return F.first(value, ignorenulls=True).over(w)


def forward_then_backward(value: str, keys: list[str], time: str) -> Column:
    return F.coalesce(forward(value, keys, time), backward(value, keys, time))


def interpolate(df: DataFrame, columns: list[str], keys: list[str], time: str) -> DataFrame:
    """Linear by row position: a leading gap stays, a trailing gap carries the last value."""
    w = _series(keys, time)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    onward = w.rowsBetween(0, Window.unboundedFollowing)
    numbered = df.withColumn("_row", F.row_number().over(w))
    known = {}
    for c in columns:
        point = F.when(F.col(c).isNotNull(), F.struct(F.col("_row").alias("r"), F.col(c).alias("v")))
        known[f"_p_{c}"] = F.last(point, ignorenulls=True).over(upto)
        known[f"_n_{c}"] = F.first(point, ignorenulls=True).over(onward)
    around = numbered.withColumns(known)
    filled = {}
    for c in columns:
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        step = (F.col("_row") - p["r"]) / (n["r"] - p["r"]).cast("double")
        between = p["v"] + (n["v"] - p["v"]) * step
        filled[c] = (
            F.when(F.col(c).isNotNull(), F.col(c)).when(n.isNull(), p["v"]).otherwise(between)
        )
    return around.withColumns(filled).select(*df.columns)


def year_to_months(
    df: DataFrame, columns: list[str], keys: list[str], year: str, month: str = "month"
) -> DataFrame:
    """Place each yearly value in January, add the other months and interpolate."""
    january = F.make_date(F.col(year), F.lit(1), F.lit(1))
    december = F.make_date(F.col(year), F.lit(12), F.lit(1))
    monthly = df.withColumn(
        month, F.explode(F.sequence(january, december, F.expr("interval 1 month")))
    ).withColumns({c: F.when(F.month(month) == 1, F.col(c).cast("double")) for c in columns})
    return interpolate(monthly.select(*keys, month, *columns), columns, keys, month)


def down_the_file(df: DataFrame, label: str, row: str) -> DataFrame:
    """Fill a label that stands only in the first row of its block, in file row order.

    The block number is a running count of labels over slices of the row number; the label
    of each block is then joined back, so a file of any length is never read in one task.
    """
    numbered = running(df, row, [], {"_block": F.col(label).isNotNull().cast("long")}, position=None)
    numbered = stage(numbered, "blocks")
    labels = numbered.filter(F.col(label).isNotNull()).select("_block", F.col(label).alias("_label"))
    filled = numbered.join(labels, "_block", "left").withColumn(label, F.col("_label"))
    return filled.select(*df.columns)
