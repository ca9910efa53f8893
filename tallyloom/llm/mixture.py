"""Mixing sources to target weights by hash-random order, distributed prefix sums and exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD, text_or_empty
from tallyloom.session import stage

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix holds.
SHARE = 1.5
#: Most epochs of one source.
EPOCHS = 2
#: Rows that one slice of a source holds on average.
SLICE_ROWS = 4_000
#: Rows alike that one task turns back into rows at a time.
COPIES = 4_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sources: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add ``weight`` and ``target`` to (source, source_size): weighted shares, none above ``epochs`` times its size.

    What a full source cannot take is shared again by weight. That ends at one level L, where a
    source takes min(L * weight, its cap). Sorted by cap / weight, the level after the first k
    caps is (budget - their sum) / (weights left), and the first k whose level is below the next
    ratio holds. This table has one row per source, so its windows are short.
    """
    one = F.lit(1)
    by_code = Window.partitionBy(one).orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_code) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    table = sources.withColumn("weight", weight).withColumn("_cap", F.lit(epochs) * F.col("source_size"))
    order = Window.partitionBy(one).orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(one)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    table = table.select(
        "*", (F.lit(float(share)) * F.sum("source_size").over(every)).alias("_budget"),
        F.coalesce(F.sum("_cap").over(before), F.lit(0)).alias("_full"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("_left"))
    level = (F.col("_budget") - F.col("_full")) / F.col("_left")
    holds = level * F.col("weight") <= F.col("_cap")
    table = table.withColumn("_level", F.first(F.when(holds, level), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap").cast("double")), F.col("_cap").cast("double"))
    return table.select("source", "source_size", *[c for c in sources.columns if c not in ("source", "source_size")],
                        "weight", target.alias("target"))


def mix(docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, size, source, source_size, target, epochs, taken): one row per input row.

    Each row gets a hash-random place in its source. Whole epochs of a source come first; the
    rest of its target, rounded down to whole words, is cut from the front of the hash order, so
    the row on the cut is taken in part: ``taken`` words in all, ``epochs`` full repeats.

    Null and empty texts have size 0 and are taken 0 times. A null source is a source of its own.
    Repeated rows are rows of their own; equal keys are ordered by doc_id, then size. Rows alike
    in source, doc_id and size take the same place, so they are one row with a count until the
    cut is known: a place holds no more rows than there are sizes, however often one doc_id or
    none occurs. A mix without words takes nothing. Columns other than doc_id, text and source
    are not read.
    """
    sized = stage(docs.select("doc_id", "source", word_count(text_or_empty("text")).alias("size"), F.conv(
        F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long").alias("place")), "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    plan = targets(sources, share, epochs, weights).select(
        F.col("source").alias("_source"), "source_size", "target",
        F.greatest(F.ceil(F.col("_rows") / SLICE_ROWS), F.lit(1)).alias("_slices"))
    # Places are uniform in [0, 16^13), so equal ranges of them hold equal shares of any source.
    placed = sized.join(plan, sized["source"].eqNullSafe(plan["_source"])).drop("_source").withColumn(
        "_slice", F.floor(F.col("place") / F.lit(float(16**13)) * F.col("_slices")))
    # Stored: the slices are summed from it, and the rows alike are split again.
    folded = stage(placed.groupBy("source", "doc_id", "size", "place", "source_size", "target", "_slice").agg(
        F.count(F.lit(1)).alias("_copies")), "folded")
    totals = folded.groupBy("source", "_slice").agg(F.sum(F.col("size") * F.col("_copies")).alias("_sum"))
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("source").alias("_source"), F.col("_slice").alias("_in"),
                           F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source", "_slice").orderBy("place", F.col("doc_id").asc_nulls_last(), "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    ordered = folded.withColumn("_earlier", F.coalesce(F.sum(F.col("size") * F.col("_copies")).over(inside), F.lit(0)))
    at = ordered.join(starts, ordered["source"].eqNullSafe(starts["_source"]) & (F.col("_slice") == F.col("_in")))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target")) - full * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start") - F.col("_earlier") - F.col("_copy") * F.col("size")))
    return _unfolded(at).select("doc_id", "size", "source", "source_size", F.col("target").cast("double").alias("target"),
                     full.alias("epochs"), (full * F.col("size") + part).cast("long").alias("taken"))


def _unfolded(folded: DataFrame) -> DataFrame:
    """One row per copy, numbered in ``_copy`` from 0. More copies than ``COPIES`` go to as many tasks as they fill."""
    many = F.col("_copies") > COPIES
    few = folded.filter(~many).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    blocks = folded.filter(many).withColumn("_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPIES).cast("long"))))
    spread = blocks.repartition(int(folded.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source", "doc_id", "size", "_first")
    last = F.least(F.col("_first") + COPIES, F.col("_copies")) - 1
    return few.unionByName(spread.withColumn("_copy", F.explode(F.sequence("_first", last))).drop("_first"))


MIX_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 13))::bigint place
  from documents),
sources as (select source, sum(size)::bigint source_size from sized group by 1),
weighted as (
  select *, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] weight, 2 * source_size cap from sources),
levels as (
  select *, (1.5::double * (sum(source_size) over ())::bigint
             - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)::bigint)
            / (sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::bigint as level
  from weighted),
held as (select min_by(level, cap / weight) filter (where level * weight <= cap) as level from levels),
targets as (
  select source, source_size, least(coalesce(held.level * weight, cap::double), cap::double) target from weighted, held),
ordered as (
  select s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) over (partition by s.source order by s.place, s.doc_id nulls last, s.size
                                    rows between unbounded preceding and 1 preceding), 0)::bigint earlier,
         case when t.source_size > 0 then floor(t.target / t.source_size)::bigint else 0 end epochs
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::bigint - epochs * source_size - earlier)))::bigint taken
from ordered
"""
