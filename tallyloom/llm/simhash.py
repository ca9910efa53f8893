"""SimHash near-duplicates: fingerprints, bit-sliced comparison, connected components.

Two fingerprints within the radius agree on at least one of radius + 1 blocks of their bits, so
only fingerprints that share a block are compared. A block value shared by very many is cut into
tiles, and every pair of tiles is a piece of work of its own. Inside a piece the fingerprints lie
as bit planes: word j of plane b holds bit b of 64 fingerprints, so one operation works on 64
distances. What comes out of a piece is a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stage

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Fingerprints of one tile, and rows that are compared together at least.
TILE = 2048
QUERIES = 256


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the lower-cased (A-Z) three-word shingles, repeats included; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    counts, total = np.zeros(64, dtype=np.int64), max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, 65536):
        part = words[start:start + 65536 + SHINGLE - 1]
        grams = zip(*[part[k:] for k in range(SHINGLE)]) if len(words) >= SHINGLE else [words]
        h = np.fromiter((digest(b" ".join(g), SEED) for g in grams), dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print) of every row; null text: empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = pa.array([fingerprint(t) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), prints], names=["doc_id", "print"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, print long")


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 x words: bit b of fingerprint 64 j + i is bit i of planes[b, j]; the rest is filled with zeros."""
    padded = np.zeros(-(-len(prints) // 64) * 64, dtype="<u8")
    padded[:len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")


def within(queries: np.ndarray, planes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(rows of queries, 64-bit words) of the fingerprints at most ``radius`` bits away, for the rows that have any.

    Counters are bit planes too. They begin at 2**levels - 1 - radius, so the carry out of the
    top level says that the radius is passed. Two planes at a time go through a full adder with
    the lowest level, so the levels above see one carry for both. Every eight planes the queries
    for which all fingerprints are beyond the radius are dropped.
    """
    levels = max(1, (radius + 1).bit_length())
    start = 2**levels - 1 - radius
    rows, words = np.arange(len(queries)), planes.shape[1]
    full = np.uint64(2**64 - 1)
    counters = [np.full((len(rows), words), full if start >> k & 1 else np.uint64(0)) for k in range(levels)]
    over = np.zeros((len(rows), words), dtype=np.uint64)
    own = [np.where(queries >> np.uint64(b) & np.uint64(1), full, np.uint64(0)).astype(np.uint64) for b in range(64)]
    for b in range(0, 64, 2):
        x, y = planes[b] ^ own[b][rows, None], planes[b + 1] ^ own[b + 1][rows, None]
        half = counters[0] ^ x
        carry = (counters[0] & x) | (half & y)
        counters[0] = half ^ y
        for k in range(1, levels):
            carry, counters[k] = counters[k] & carry, counters[k] ^ carry
        over |= carry
        if b % 8 == 6:
            alive = (over != full).any(axis=1)
            if not alive.all():
                rows, over = rows[alive], over[alive]
                counters = [c[alive] for c in counters]
                if not len(rows):
                    break
    return rows, ~over


def forest(prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) that connect what lies within the radius, each fingerprint to the least of its part."""
    prints = np.unique(prints)
    root, planes = np.arange(len(prints)), bit_planes(prints)
    unsigned = prints.astype("<u8") if prints.dtype != np.uint64 else prints
    for start in range(0, len(prints), QUERIES):
        rows, near = within(unsigned[start:start + QUERIES], planes, radius)
        bits = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :len(prints)]
        lonely = bits.sum(axis=1, dtype=np.int64) <= 1
        for row, line in zip(rows[~lonely] + start, bits[~lonely]):
            parts = np.unique(root[line.astype(bool)])
            if len(parts) > 1:
                root[np.isin(root, parts)] = parts[0]
    moved = root != np.arange(len(prints))
    return prints[moved], prints[root[moved]]


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v), u != v: links between distinct fingerprints that connect all within the radius; ``prints`` is stored."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    blocks = F.array(*[
        F.struct(F.lit(k).alias("block"),
                 F.shiftrightunsigned("print", cuts[k]).bitwiseAND(2 ** (cuts[k + 1] - cuts[k]) - 1).alias("value"))
        for k in range(radius + 1)])
    rows = prints.select("print", F.explode(blocks).alias("b")).select("print", "b.block", "b.value")
    sizes = stage(rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "blocks")
    met = rows.join(sizes, ["block", "value"]).withColumn("tiles", F.ceil(F.col("n") / F.lit(tile)).cast("int"))
    own = F.pmod(F.xxhash64("print"), F.col("tiles")).cast("int")
    pieces = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "block", "value", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "print")
    key = ["block", "value", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole pieces are gathered until they are worth a comparison; any link among them is a true one."""
        names = ["u", "v"]

        def compared(parts: list[np.ndarray]) -> pa.RecordBatch:
            u, v = forest(np.concatenate(parts).view("<u8"), radius)
            return pa.RecordBatch.from_arrays([pa.array(u.view("<i8"), pa.int64()), pa.array(v.view("<i8"), pa.int64())], names=names)

        held, count, last = [], 0, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            values = b.column(4).to_numpy(zero_copy_only=False)
            change = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            starts = [0, *change.tolist(), len(values)]
            for s, e in zip(starts, starts[1:]):
                here = tuple(keys[s])
                if here != last and count >= tile:
                    yield compared(held)
                    held, count = [], 0
                held.append(values[s:e])
                count, last = count + e - s, here
        if held:
            yield compared(held)

    return pieces.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "u long, v long")


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node of the links (u, v) but the least of its component, with that least node.

    Large and small stars in turn (Kiveris et al. 2014): each round hangs the greater, then the
    smaller neighbours of every node onto its least one, until nothing moves. Every half round
    is stored in the shared folder. Each join meets two stored tables on one key, so a node
    with very many links is split over tasks.
    """
    def stars(both: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        both = stage(both, name)
        return both, stage(both.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")

    ordered = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "links")
    before = _digest(ordered)
    while before[0]:
        both, least = stars(ordered.unionAll(ordered.select(F.col("v").alias("u"), F.col("u").alias("v"))), "large")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        down, least = stars(large, "small")
        hung = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        ordered = stage(down.join(least, "u").select(F.explode(hung).alias("e")).select("e.u", "e.v").filter("u != v").distinct(), "links")
        after = _digest(ordered)
        if after == before:
            break
        before = after
    return ordered


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Fingerprints at most ``radius`` bits apart are linked; ``component_id`` is the smallest
    doc_id that links reach, itself included. Null and empty texts have fingerprint zero and are
    linked like any other. Equal fingerprints fold into one before anything is compared. Repeated
    rows stay. A null doc_id gets the component of its fingerprint and names none: where no row
    of a component has an id, component_id is null. Other columns are not read.
    """
    own = stage(fingerprints(docs), "fingerprints")
    folded = stage(own.groupBy("print").agg(F.min("doc_id").alias("first")), "folded")
    hung = components(links(folded.select("print"), radius)).withColumnRenamed("u", "print")
    linked = stage(folded.join(hung, "print", "left").select("print", "first", F.coalesce("v", "print").alias("part")), "parts")
    least = stage(linked.groupBy("part").agg(F.min("first").alias("component_id")), "least")
    named = stage(linked.join(least, "part").select("print", "component_id"), "named")
    return own.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def without_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All columns of the one row of each component whose doc_id is the component's.

    Of repeated rows with that id, the one whose text hash is least stays. A row without a doc_id
    is no copy that could be named, so it stays.
    """
    found = near_duplicates(docs, radius)
    keep = stage(found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("doc_id", "_id"), "kept")
    single, repeated = keep.filter("_n = 1"), keep.filter("_n > 1")
    # The list of kept documents grows with the input: a merge join at every size, no broadcast.
    once = docs.join(single.hint("merge"), docs["doc_id"] == single["_id"], "left_semi")
    often = docs.join(repeated, docs["doc_id"] == repeated["_id"], "left_semi")
    chosen = often.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(F.coalesce("text", F.lit("")))).alias("_row"))
    return once.unionAll(chosen.select("_row.*")).unionAll(docs.filter(F.col("doc_id").isNull()))
