"""Global positions, running sums and exact quantiles without sorting everything in one task.

An unpartitioned ``orderBy`` window sends all rows to one task. Here the rows are range
partitioned by the order column and the ties, each slice is numbered by itself and shifted by
the totals of the slices before it. The slices follow Spark's own order of any type, nulls and
NaN included, and their number follows the number of rows; a value that fills more than one
slice is cut along the ties.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stage

SLICE = "_slice"
#: Rows of a slice, on average.
SLICE_ROWS = 50_000


def with_slices(
    df: DataFrame, order: str, ties: list[str], descending: bool = False, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Store the rows with the number of their slice; slices ascend in the wanted order.

    The numbers come from a sample of the rows, so they are written down once and read from then on.
    """
    first = F.col(order).desc() if descending else F.col(order).asc()
    slices = max(1, math.ceil(df.count() / slice_rows))
    ranged = df.repartitionByRange(slices, first, *[F.col(t) for t in ties])
    return stage(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def running(
    df: DataFrame,
    order: str,
    ties: list[str],
    sums: dict[str, str | Column] | None = None,
    descending: bool = False,
    position: str | None = "position",
    slice_rows: int = SLICE_ROWS,
    staged: bool = True,
) -> DataFrame:
    """Add the 1-based global ``position`` and the running sums ``{new column: amount}``.

    Null order values come first, descending last; NaN is above all numbers. Null amounts add
    nothing. The input is read several times, so it is written to the shared folder first
    unless the caller says it is already a stored table.
    """
    if staged:
        df = stage(df, "ordered")
    amounts = {name: F.expr(a) if isinstance(a, str) else a for name, a in (sums or {}).items()}
    sliced = with_slices(df, order, ties, descending, slice_rows)
    totals = sliced.groupBy(SLICE).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(a).alias(f"_sum_{n}") for n, a in amounts.items()]
    )
    # one row per slice
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        SLICE,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_sum_{n}") for n in amounts],
    )
    first = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(SLICE).orderBy(first, *[F.col(t) for t in ties])
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    numbered = sliced.select(
        "*",
        F.row_number().over(inside).alias("_in_slice"),
        *[F.coalesce(F.sum(a).over(upto), F.lit(0)).alias(f"_in_{n}") for n, a in amounts.items()],
    ).join(starts, SLICE)
    made = [(F.col("_rows") + F.col("_in_slice")).cast("long").alias(position)] if position else []
    made += [(F.col(f"_sum_{n}") + F.col(f"_in_{n}")).alias(n) for n in amounts]
    return numbered.select(*df.columns, *made)


def running_by(
    df: DataFrame,
    groups: list[str],
    order: str,
    ties: list[str],
    sums: dict[str, str | Column] | None = None,
    totals: dict[str, str | Column] | None = None,
    descending: bool = False,
    position: str | None = "position",
    slice_rows: int = SLICE_ROWS,
    staged: bool = True,
) -> DataFrame:
    """The same inside every group: 1-based ``position``, running sums, and the ``totals`` of the group.

    Rows are range partitioned by group, order and ties, so a group of any size is cut into
    slices, and each slice meets at most two groups that go on beyond it. Only those get the
    totals of other slices, from a table of at most two rows a slice; what lies whole in one slice
    is worked out there. Nulls form a group and come first in the order, descending last; null
    amounts add nothing. The input is read several times, so it is written to the shared folder
    first unless the caller says it is already a stored table.
    """
    if staged:
        df = stage(df, "ordered")
    amounts = {n: F.expr(a) if isinstance(a, str) else a for n, a in (sums or {}).items()}
    wholes = {n: F.expr(a) if isinstance(a, str) else a for n, a in (totals or {}).items()}
    first = F.col(order).desc() if descending else F.col(order).asc()
    slices = max(1, math.ceil(df.count() / slice_rows))
    ranged = df.repartitionByRange(slices, *[F.col(g) for g in groups], first, *[F.col(t) for t in ties])
    sliced = stage(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")
    parts = sliced.groupBy(SLICE, *groups).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(a).alias(f"_sum_{n}") for n, a in amounts.items()],
        *[F.sum(a).alias(f"_all_{n}") for n, a in wholes.items()])
    group = Window.partitionBy(*groups)
    before = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # a group has a row per slice here
    spread = parts.select(
        F.col(SLICE).alias("_in"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.count(F.lit(1)).over(group).alias("_parts"), F.sum("_rows").over(before).alias("_rows"),
        *[F.sum(f"_sum_{n}").over(before).alias(f"_sum_{n}") for n in amounts],
        *[F.sum(f"_all_{n}").over(group).alias(f"_all_{n}") for n in wholes]).filter("_parts > 1")
    inside = Window.partitionBy(SLICE, *groups)
    ranked = inside.orderBy(first, *[F.col(t) for t in ties])
    upto = ranked.rowsBetween(Window.unboundedPreceding, 0)
    numbered = sliced.select(
        "*", F.row_number().over(ranked).alias("_in_slice"),
        *[F.sum(a).over(upto).alias(f"_in_{n}") for n, a in amounts.items()],
        *[F.sum(a).over(inside).alias(f"_own_{n}") for n, a in wholes.items()])
    rule = F.col(SLICE) == F.col("_in")
    for i, g in enumerate(groups):
        rule = rule & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = numbered.join(spread, rule, "left")

    def with_start(start: str, own: str) -> Column:
        return F.coalesce(F.col(start), F.lit(0)) + F.coalesce(F.col(own), F.lit(0))

    made = [with_start("_rows", "_in_slice").cast("long").alias(position)] if position else []
    made += [with_start(f"_sum_{n}", f"_in_{n}").alias(n) for n in amounts]
    made += [F.when(F.col("_parts") > 1, F.col(f"_all_{n}")).otherwise(F.col(f"_own_{n}")).alias(n) for n in wholes]
    return joined.select(*df.columns, *made)


def quantiles(df: DataFrame, column: str, wanted: dict[str, float], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row of exact quantiles (linear between neighbours) of a whole column.

    Equal values fold into one row with a count; the few rows around the wanted ranks are
    picked by their running count, so the values never meet in one task.
    """
    folded = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running(folded, column, [], {"_upto": "_n"}, position=None, slice_rows=slice_rows)
    total = ranked.agg(F.sum("_n")).scalar()
    at = ranked.withColumn("_total", total)
    picks, results = [], []
    for i, (name, p) in enumerate(wanted.items()):
        place = (F.col("_total") - 1) * F.lit(p)
        low, high = F.floor(place), F.ceil(place)

        def holds(rank: Column) -> Column:
            return (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))

        picks += [F.max(F.when(holds(low), F.col(column))).alias(f"_lo{i}"),
                  F.max(F.when(holds(high), F.col(column))).alias(f"_hi{i}"),
                  F.max(place - low).alias(f"_part{i}")]
        results.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")).alias(name))
    return at.agg(*picks).select(*results)
