"""Exact counts of pairs that agree in any of many bands, without listing a pair.

Short bands have few cells, so nearly all pairs agree somewhere and no list of them is wanted.
Records alike fold into classes with a weight. Classes are dealt into tiles and every two tiles are
compared once: for each band and cell the members of one tile are a row of bits, so joining the
rows that a class of the other tile meets compares it with 64 classes per word. Weights are bit
planes as well, and only sums leave a task. The comparisons grow with the square of the number of
classes, as the question does; the rows moved grow with that square over the tile size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.linkage import planes, plane_count
from tallyloom.session import stage

#: Classes of a tile, and classes compared with a whole tile at a time.
TILE, STEP = 8192, 128


def all_signatures(df: DataFrame, keep: list[str], vector: str, cuts: list[tuple[int, int]], length: int, points: int) -> DataFrame:
    """(keep columns, run, hashes): the band hashes of every cut (bands, seed), numbered by ``run``, in one pass.

    The same numbers as ``linkage.signatures`` gives cut by cut.
    """
    count = plane_count(points)
    weights = 2 ** np.arange(count, dtype=np.int64)
    matrices = [planes(length // bands, count, seed).T.astype(float) for bands, seed in cuts]
    schema = df.select(*keep, F.lit(0).alias("run"), F.array(F.lit(0).cast("bigint")).alias("hashes")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(float)
            for number, ((bands, _), matrix) in enumerate(zip(cuts, matrices)):
                rows = length // bands
                found = ((whole[:, :bands * rows].reshape(-1, rows) @ matrix) >= 0) @ weights
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(found) + 1, bands), pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-1], pa.array(np.full(b.num_rows, number, dtype=np.int32)), lists], names=[*b.schema.names[:-1], "run", "hashes"])

    return df.select(*keep, vector).mapInArrow(run, schema)


def packed(members: np.ndarray) -> np.ndarray:
    """Rows of 0/1 as rows of 64-bit words."""
    padded = np.zeros((len(members), -(-members.shape[1] // 64) * 64), dtype=bool)
    padded[:, :members.shape[1]] = members
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


class Side:
    """One tile: cells by band, and truth and other as small numbers (-1: null, equal to nothing)."""

    def __init__(self, hashes: np.ndarray, truth: list, other: list, weight: np.ndarray):
        self.hashes, self.truth, self.other, self.weight = hashes, truth, other, weight


def _codes(a: list, b: list) -> tuple[np.ndarray, np.ndarray, int]:
    known = {v: k for k, v in enumerate(dict.fromkeys(x for x in [*a, *b] if x is not None))}
    return (*(np.array([-1 if v is None else known[v] for v in side], dtype=np.int64) for side in (a, b)), len(known))


def _members(codes: np.ndarray, count: int) -> np.ndarray:
    """Bit rows by code, and a last row without members, which the code -1 picks."""
    return packed(np.concatenate([codes == np.arange(count)[:, None], np.zeros((1, len(codes)), dtype=bool)]))


def compared(a: Side, b: Side, different: bool) -> tuple[int, int]:
    """Weighted numbers of ordered pairs (one of ``a``, one of ``b``) that share a cell, and of those with the same truth."""
    bands = a.hashes.shape[1]
    cells, rows_of = [], []
    for k in range(bands):
        values, at = np.unique(b.hashes[:, k], return_inverse=True)
        cells.append(_members(at, len(values)))
        place = np.searchsorted(values, a.hashes[:, k])
        place[place == len(values)] = 0
        rows_of.append(np.where(values[place] == a.hashes[:, k], place, len(values)))
    ta, tb, kinds = _codes(a.truth, b.truth)
    same_truth = _members(tb, kinds)
    if different:
        oa, ob, others = _codes(a.other, b.other)
        same_other, known = _members(ob, others), packed((ob >= 0)[None])
    levels = [packed((b.weight >> k & 1).astype(bool)[None]) for k in range(int(b.weight.max()).bit_length())]
    candidates = found = 0
    for start in range(0, len(a.weight), STEP):
        here = slice(start, start + STEP)
        meets = np.zeros((len(a.weight[here]), cells[0].shape[1]), dtype="<u8")
        for k in range(bands):
            meets |= cells[k][rows_of[k][here]]
        if different:  # both known, and not the same
            meets &= known & ~same_other[oa[here]]
            meets[oa[here] < 0] = 0
        true = meets & same_truth[ta[here]]
        for k, level in enumerate(levels):
            for is_true, bits in ((False, meets), (True, true)):
                ones = np.bitwise_count(bits & level).sum(axis=1, dtype=np.int64)
                total = sum(int(n) * int(w) for n, w in zip(ones, a.weight[here])) << k
                if is_true:
                    found += total
                else:
                    candidates += total
    return candidates, found


def any_band_totals(
    signed: DataFrame, truth: str, same: list[str] | None = None, different: str | None = None, tile: int = TILE,
) -> DataFrame:
    """(same columns, candidates, found): pairs of records of equal ``same`` that agree in any band, and those of
    equal ``truth``; the two of a pair differ in ``different``, where that is given.

    Null ``same``, ``different`` or ``truth`` values are equal to nothing. Copies count with their
    number. Groups of ``same`` without a pair of records have no row; without ``same`` there is one row.
    """
    same = same or []
    known = [F.col(c).isNotNull() for c in same]
    rows = signed.filter(known[0] if len(known) == 1 else F.array_min(F.array(*known)) if known else F.lit(True))
    other: Column = F.col(different).cast("string") if different else F.lit(None).cast("string")
    folded = stage(rows.groupBy(*same, F.col(truth).cast("string").alias("_truth"), other.alias("_other"), "hashes").agg(
        F.count(F.lit(1)).alias("_weight")), "classes")
    one = F.lit(0).alias("_all")
    groups = stage(folded.groupBy(*same, one).agg(F.count(F.lit(1)).alias("_n"), F.sum("_weight").alias("_records"))
                   .withColumn("_group", F.monotonically_increasing_id()), "groups")
    key = ["_all", *same]
    met = folded.withColumn("_all", F.lit(0)).join(groups.select(*key, "_n", "_group"), key).withColumn(
        "_tiles", F.ceil(F.col("_n") / F.lit(tile)).cast("int"))
    own = F.pmod(F.xxhash64("hashes", "_truth", "_other"), F.col("_tiles")).cast("int")
    every = met.withColumn("_own", own).withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    piece = ["_group", "_lo", "_hi"]
    pieces = every.select(
        "_group", F.least("_own", "_with").alias("_lo"), F.greatest("_own", "_with").alias("_hi"), "_own",
        "hashes", "_truth", "_other", "_weight")
    apart = different is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by piece; one piece of two tiles is held at a time."""
        def out(at: tuple, held: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            hashes = whole.column("hashes").chunk(0).flatten().to_numpy().reshape(whole.num_rows, -1)
            tiles, weight = whole.column("_own").to_numpy(), whole.column("_weight").to_numpy()
            truth_of, other_of = whole.column("_truth").to_pylist(), whole.column("_other").to_pylist()

            def side(tile_number: int) -> Side:
                pick = np.flatnonzero(tiles == tile_number)
                return Side(hashes[pick], [truth_of[i] for i in pick], [other_of[i] for i in pick], weight[pick])

            lo, hi = side(at[1]), side(at[2])
            found = compared(lo, hi, apart) if len(lo.weight) and len(hi.weight) else (0, 0)
            times = 1 if at[1] == at[2] else 2
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]]), *[pa.array([str(times * v)]) for v in found]], names=["_group", "candidates", "found"])

        last, held = None, []
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            starts = [0, *(np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1).tolist(), b.num_rows]
            for s, e in zip(starts, starts[1:]):
                here = tuple(keys[s].tolist())
                if here != last and held:
                    yield out(last, held)
                    held = []
                held.append(b.slice(s, e - s))
                last = here
        if held:
            yield out(last, held)

    counted = pieces.repartition(*piece).sortWithinPartitions(*piece).mapInArrow(run, "_group long, candidates string, found string")
    totals = counted.groupBy("_group").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("candidates", "found")])
    # every record also met itself, unless it had to differ from its partner
    alone = folded.withColumn("_all", F.lit(0)).groupBy(*key).agg(
        F.sum("_weight").alias("_self"), F.coalesce(F.sum(F.when(F.col("_truth").isNotNull(), F.col("_weight"))), F.lit(0)).alias("_self_true"))
    sums = groups.filter("_records > 1").join(totals, "_group").join(alone, key)
    wanted = [((F.col(c) - (F.lit(0) if apart else F.col(s))) / 2).cast("bigint").alias(c)
              for c, s in (("candidates", "_self"), ("found", "_self_true"))]
    if same:
        return sums.select(*same, *wanted)
    return sums.agg(*[F.coalesce(F.sum(w), F.lit(0)).alias(n) for w, n in zip(wanted, ("candidates", "found"))])
