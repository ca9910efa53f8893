"""Hard negatives by segment summaries: bounds first, exact scores for what the bounds leave.

A vector is cut into segments, and the mean and the deviation of each segment are stored beside it.
With segments of length L, an inner product is the sum of L mean mean' over the segments, plus or
minus at most the sum of deviation deviation'. Levels of 1, 4 and 16 segments are tried in turn;
what a level cannot decide goes to the next, and only what is left after the last is scored exactly.

Anchors are a stated query set. They meet all rows in blocks: one block of at most ``ANCHORS`` of
them is sent to all tasks, each task runs over its rows in batches and returns a few best rows an
anchor, and those are merged by Spark. Rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import numbered
from tallyloom.session import scratch_path, stage

LEVELS = (1, 4, 16)
#: Anchors of one block (with 64 numbers each: 8 MB), anchors and rows compared at a time.
ANCHORS, ANCHOR_STEP, ROW_STEP = 16_384, 512, 2048
NO_ID = np.iinfo(np.int64).max
#: Whole numbers up to here are exact as doubles.
EXACT = 2.0**52


def summaries(x: np.ndarray) -> np.ndarray:
    """Per row the means times the root of the segment length, then the deviations, level by level."""
    out = []
    for parts in LEVELS:
        length = -(-x.shape[1] // parts)
        wide = np.zeros((len(x), parts * length))
        wide[:, :x.shape[1]] = x  # filling up with zeros changes no product
        cut = wide.reshape(len(x), parts, length)
        mean = cut.mean(axis=2)
        out += [mean * np.sqrt(length), np.sqrt(((cut - mean[:, :, None]) ** 2).sum(axis=2))]
    return np.concatenate(out, axis=1)


def bounds(a: np.ndarray, b: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each row of ``a`` with each of ``b``, from the summaries of one level."""
    start, parts = 2 * sum(LEVELS[:level]), LEVELS[level]
    middle = a[:, start:start + parts] @ b[:, start:start + parts].T
    away = a[:, start + parts:start + 2 * parts] @ b[:, start + parts:start + 2 * parts].T
    slack = 1e-9 * (np.abs(middle) + away) + 1e-9 * np.abs(middle).max(initial=1.0)  # rounding
    return middle - away - slack, middle + away + slack


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; beyond what doubles hold exactly by Python's own numbers, as doubles."""
    most = np.sqrt((a**2).sum(axis=1).max(initial=0.0) * (b**2).sum(axis=1).max(initial=0.0))
    if most < EXACT:
        return a @ b.T
    return np.array([[float(sum(int(p) * int(q) for p, q in zip(u, v))) for v in b] for u in a])


@dataclass
class Batch:
    """Rows that are compared together, in the order of their ids (rows without an id last)."""

    number: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    summary: np.ndarray

    @staticmethod
    def read(batch: pa.RecordBatch, width: int) -> Batch:
        number = batch.column(0).to_numpy(zero_copy_only=False)
        ids = batch.column(1).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
        label = batch.column(2).to_numpy(zero_copy_only=False)
        lists = batch.column(3)
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        x = np.zeros((len(ids), width))
        x[np.repeat(np.arange(len(ids)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        parts = batch.column(4).flatten().to_numpy(zero_copy_only=False)
        order = np.lexsort((number, ids))
        return Batch(number[order], ids[order], label[order], x[order], parts.reshape(len(ids), 2 * sum(LEVELS))[order])

    def cut(self, rows) -> Batch:
        return Batch(self.number[rows], self.vec_id[rows], self.label[rows], self.x[rows], self.summary[rows])


class Best:
    """The ``size`` best rows so far of each of ``slots`` wishes: score falling, then id rising."""

    def __init__(self, slots: int, size: int):
        self.score = np.full((slots, size), -np.inf)
        self.vec_id = np.full((slots, size), NO_ID)
        self.number = np.full((slots, size), -1, dtype=np.int64)

    @property
    def least(self) -> np.ndarray:
        """Below this score nothing enters any more."""
        return self.score[:, -1]

    def add(self, slots: np.ndarray, scores: np.ndarray, rows: Batch) -> None:
        """Take in scores (slots x rows); minus infinity says no. Rows come in the order of their ids."""
        size = self.score.shape[1]
        scores = scores.copy()
        found_s, found_i, found_n = [self.score[slots]], [self.vec_id[slots]], [self.number[slots]]
        for _ in range(min(size, scores.shape[1])):
            at = scores.argmax(axis=1)  # the first of equal scores, so the least id
            best = scores[np.arange(len(slots)), at]
            there = best > -np.inf
            if not there.any():
                break
            found_s.append(best[:, None])
            found_i.append(np.where(there, rows.vec_id[at], NO_ID)[:, None])
            found_n.append(np.where(there, rows.number[at], -1)[:, None])
            scores[np.arange(len(slots)), at] = -np.inf
        s, i, n = (np.concatenate(p, axis=1) for p in (found_s, found_i, found_n))
        order = np.lexsort((n, i, -s), axis=1)[:, :size]
        take = np.arange(len(slots))[:, None], order
        self.score[slots], self.vec_id[slots], self.number[slots] = s[take], i[take], n[take]


@dataclass
class Block:
    """One block of anchors; ``wished`` are the scores of their positives, NaN where there is none."""

    number: np.ndarray
    label: np.ndarray
    x: np.ndarray
    summary: np.ndarray
    wished: np.ndarray

    def cut(self, rows) -> Block:
        return Block(self.number[rows], self.label[rows], self.x[rows], self.summary[rows], self.wished[rows])


def undecided(anchors: Block, rows: Batch, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, rows, open pairs among them) that the bounds of all levels leave between low and high (per anchor)."""
    some_a, some_r, left = np.arange(len(anchors.number)), np.arange(len(rows.number)), allowed
    for level in range(len(LEVELS)):
        keep_a, keep_r = left.any(axis=1), left.any(axis=0)
        some_a, some_r, left = some_a[keep_a], some_r[keep_r], left[np.ix_(keep_a, keep_r)]
        if not left.size:
            break
        lower, upper = bounds(anchors.summary[some_a], rows.summary[some_r], level)
        left = left & (upper >= low[some_a, None]) & (lower <= high[some_a, None])
    keep_a, keep_r = left.any(axis=1), left.any(axis=0)
    return some_a[keep_a], some_r[keep_r], left[np.ix_(keep_a, keep_r)]


def nearest(anchors: Block, batches: Iterator[Batch], size: int) -> Best:
    """The ``size`` best other rows of the same label for each anchor."""
    best, open_end = Best(len(anchors.number), size), np.full(len(anchors.number), np.inf)
    for rows in batches:
        for start in range(0, len(anchors.number), ANCHOR_STEP):
            at = np.arange(start, min(start + ANCHOR_STEP, len(anchors.number)))
            some = anchors.cut(at)
            allowed = (some.label[:, None] == rows.label) & (some.number[:, None] != rows.number)
            a, r, left = undecided(some, rows, allowed, best.least[at], open_end[at])
            if left.size:
                scores = np.where(left, exact(some.x[a], rows.x[r]), -np.inf)
                best.add(at[a], scores, rows.cut(r))
    return best


def hardest(anchors: Block, batches: Iterator[Batch], size: int, low: tuple[int, int], high: tuple[int, int]) -> Best:
    """For each anchor and positive (slot = anchor times positives + place) the ``size`` best rows of other labels
    whose score is from low[0] / low[1] to high[0] / high[1] of the positive's."""
    places = anchors.wished.shape[1]
    best = Best(len(anchors.number) * places, size)
    wished = np.where(np.isnan(anchors.wished), -np.inf, anchors.wished)
    for rows in batches:
        for start in range(0, len(anchors.number), ANCHOR_STEP):
            at = np.arange(start, min(start + ANCHOR_STEP, len(anchors.number)))
            some, wish = anchors.cut(at), wished[at]
            there = wish > -np.inf
            floor = np.maximum(wish * (low[0] / low[1]), best.least.reshape(-1, places)[at])
            floor = np.where(there, floor, np.inf).min(axis=1)
            roof = np.where(there, wish * (high[0] / high[1]), -np.inf).max(axis=1)
            slack = 1e-9 * np.abs(np.where(there, wish, 0.0)).max(axis=1)
            a, r, left = undecided(some, rows, some.label[:, None] != rows.label, floor - slack, roof + slack)
            if not left.size:
                continue
            scores, picked = exact(some.x[a], rows.x[r]), rows.cut(r)
            for place in range(places):
                p = wish[a, place][:, None]
                with np.errstate(invalid="ignore"):
                    fits = left & (low[0] * p <= low[1] * scores) & (high[1] * scores <= high[0] * p) & (p > -np.inf)
                some_slots = fits.any(axis=1)
                if some_slots.any():
                    best.add(at[a][some_slots] * places + place, np.where(fits, scores, -np.inf)[some_slots], picked)
    return best


def _passes(rows: DataFrame, anchors: DataFrame, width: int, search, schema: str, label: str) -> DataFrame:
    """Run ``search`` (Block, batches) over all rows for one block of anchors after the other; results are stored."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, label)
    blocks = anchors.agg(F.max("block")).first()[0]
    names = [f.split()[0] for f in schema.split(", ")]
    spark.createDataFrame([], schema).write.parquet(path)
    for block in range(0 if blocks is None else blocks + 1):
        got = anchors.filter(F.col("block") == block).select("number", "vec_id", "label", "x", "summary", "wished").toArrow().combine_chunks()
        if not got.num_rows:
            continue
        held = Batch.read(got.to_batches()[0], width)
        order = np.lexsort((held.number, held.vec_id))
        wished = np.array([w or [] for w in got.column("wished").to_pylist()], dtype=object)
        most = max((len(w) for w in wished), default=0)
        table = np.array([[*w, *[np.nan] * (most - len(w))] for w in wished], dtype=np.float64).reshape(got.num_rows, most)
        by_number = dict(zip(got.column("number").to_pylist(), range(got.num_rows)))
        table = table[[by_number[n] for n in held.number.tolist()]]
        sent = spark.sparkContext.broadcast(Block(held.number[order], held.label, held.x, held.summary, table))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def cut() -> Iterator[Batch]:
                for b in batches:
                    for start in range(0, b.num_rows, ROW_STEP):
                        yield Batch.read(b.slice(start, ROW_STEP), width)

            yield from search(sent.value, cut(), names)

        rows.select("number", "vec_id", "label", "x", "summary").mapInArrow(run, schema).write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(schema).parquet(path)


def _found(best: Best, names: list[str], keys: list[np.ndarray]) -> pa.RecordBatch:
    """One row per entry: the keys of its slot, then number, vec_id and score of the row."""
    slot, place = np.nonzero(best.number >= 0)
    ids = best.vec_id[slot, place]
    arrays = [pa.array(k[slot]) for k in keys]
    arrays += [pa.array(best.number[slot, place]), pa.array(ids, mask=ids == NO_ID), pa.array(best.score[slot, place].astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _first(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "number")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
    low: tuple[int, int] = (50, 100), high: tuple[int, int] = (95, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (vec_id long, label, x array<long>).

    Scores are inner products of whole numbers; higher ones first, ties by smaller vec_id, rows
    without a vec_id last. A positive is one of the first ``positives`` other rows of the anchor's
    label. Its negatives are the first ``negatives`` rows of other labels with a score from ``low``
    to ``high`` (fractions) of the positive's; a pair without any has no rows. Rows with a null
    label or vector take no part; a shorter vector is filled up with zeros. Every row is a row of
    its own, also when repeated: a repeated anchor gives its rows again, and a copy of an anchor is
    one of its positives. An empty table gives none. Other columns are not read. Scores above
    2**52 are rounded to doubles, and above the range of long they are not defined.
    """
    whole = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("x").cast("array<bigint>").alias("x"),
                        F.coalesce(is_anchor, F.lit(False)).alias("anchor")).filter("label is not null and x is not null")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = b.column(2)
            sizes = np.diff(held.offsets.to_numpy())
            flat = held.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.zeros((b.num_rows, width))
            x[np.repeat(np.arange(b.num_rows), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
            made = summaries(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, made.shape[1]), pa.int32()), pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, "summary"])

    given = stage(whole, "vectors")
    width = max(1, given.agg(F.max(F.size("x"))).first()[0] or 0)
    summary = given.mapInArrow(summed, "vec_id long, label long, x array<bigint>, anchor boolean, summary array<double>")
    stored = numbered(summary, "number", "summaries")
    anchors = numbered(stored.filter("anchor"), "place", "anchors").withColumn("block", F.floor(F.col("place") / ANCHORS).cast("long"))
    none = F.array().cast("array<double>")

    def positive_search(block: Block, batches, names):
        yield _found(nearest(block, batches, positives), names, [block.number])

    near = _first(
        _passes(stored, anchors.withColumn("wished", none), width, positive_search,
                "anchor long, number long, vec_id long, score long", "positives"), ["anchor"], positives)
    chosen = stage(near, "chosen")
    wishes = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("held"))
    wishing = stage(anchors.join(wishes.withColumnRenamed("anchor", "number"), "number").withColumn(
        "wished", F.transform("held", lambda h: h["score"].cast("double"))).drop("held"), "wishing")

    def negative_search(block: Block, batches, names):
        places = block.wished.shape[1]
        keys = [np.repeat(block.number, places), np.tile(np.arange(1, places + 1), len(block.number)).astype(np.int32)]
        yield _found(hardest(block, batches, negatives, low, high), names, keys)

    hard = _first(
        _passes(stored, wishing, width, negative_search,
                "anchor long, place int, number long, vec_id long, score long", "negatives"), ["anchor", "place"], negatives)
    named = chosen.join(anchors.select(F.col("number").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor", F.col("rank").alias("place"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return named.join(hard.select("anchor", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


MINE_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * c::double) for c in embedding] as x
  from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len([c for c in embedding if c is null or not isfinite(c)]) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         cast(list_dot_product(a.x, b.x) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
), positives as (
  select * from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.other_id as positive_id,
       cast(row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as integer) as rank,
       n.other_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n
  on n.anchor_id = p.anchor_id and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify rank <= 3
"""
