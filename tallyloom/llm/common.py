"""Small helpers shared by the text operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stage

#: A word as the digests define it: everything between ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` worked out once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def worked_out(value: Column) -> Column:
    """``value`` as a generated column, which later steps read and never work out again."""
    return F.explode(F.array(value))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def sample_ids(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` distinct values of ``key``, the same on every run: those with the least hashes.

    The bound comes from the caller. A hash threshold keeps what the last sort sees near
    the bound, whatever the table holds.
    """
    ids = df.select(key).filter(F.col(key).isNotNull())
    total = ids.count()
    place = F.xxhash64(F.col(key), F.lit("sample"))
    if total > 2 * rows:
        share = 1.5 * rows / total
        ids = ids.filter(place < F.lit(int(-(2**63) + share * 2**64)))
    return ids.distinct().orderBy(place, key).limit(rows)


def numbered(df: DataFrame, column: str, label: str) -> DataFrame:
    """The rows, stored, with ``column`` = 0, 1, 2, ...: no sort and no shuffle of the rows.

    A task numbers its own rows; the totals of the tasks before it (one small row per task) are
    added. The numbers are written down once, so they stay what they are.
    """
    made = F.monotonically_increasing_id()
    parts = stage(df.withColumns({"_part": F.shiftright(made, 33), "_at": made.bitwiseAND(2**33 - 1)}), label)
    totals = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return stage(parts.join(starts, "_part").select(*df.columns, (F.col("_start") + F.col("_at")).alias(column)), label)


def finite_vector(column: str) -> Column:
    """Whether the vector is there and all its entries are finite numbers; an empty vector is not."""
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce(F.size(column) > 0, F.lit(False)) & ~F.coalesce(bad, F.lit(True))


def kept_by_worker(name: str, key: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in each Python worker and kept between tasks until ``key`` changes.

    The slot lies in a module of its own: this package travels with each task, so its own globals are new every time.
    """
    slots = vars(sys.modules.setdefault("tallyloom_worker_slots", types.ModuleType("tallyloom_worker_slots")))
    if name not in slots or slots[name][0] != key:
        slots[name] = (key, make())
    return slots[name][1]
