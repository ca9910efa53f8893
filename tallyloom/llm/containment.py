"""Containment search by MinHash: short items inside documents of any length.

A document is thousands of times longer than an item, so the Jaccard similarity of the two
says nothing. Items are therefore partitioned by size, and each size class fixes the windows
that documents are cut into, which turns the containment bound into a Jaccard bound:

* An item with q shingles and containment of at least 0.8 misses at most q // 5 of them, so
  the rest holds an unbroken run of ``run`` shingles (``SizeClass.run``, by class of q).
* Windows of ``2 run - 1`` shingles, one every ``run``, contain each such run whole. Window
  and run then have a Jaccard similarity of at least run / (2 run - 1) > 1/2.
* Bands of one MinHash value each collide in at least one of ``bands`` with a probability of
  ``1 - (1 - run / (2 run - 1)) ** bands``: at least 0.9997 here, and 1 where run is 1.
  A longer passage has several runs and several windows, each with its own chance.

What collides is verified by exact containment of the item's shingles in the whole document,
so no false match comes out. Nothing is shuffled but the matches. All is native.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import let, text_or_empty, worked_out
from tallyloom.session import stage

SHINGLE = 5
THRESHOLD = 0.8
#: Most rows and most bytes of the item table that are sent to every task; a larger one is joined by a shuffle.
#: A row carries the shingles of its item, so long items reach the bytes first.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 64 * 2**20


@dataclass(frozen=True)
class SizeClass:
    number: int
    least: int  # shingles of an item
    most: int | None
    run: int
    bands: int

    @property
    def width(self) -> int:
        return 2 * self.run - 1

    @property
    def collision(self) -> float:
        return 1 - (1 - self.run / self.width) ** self.bands


#: The longest unbroken run is at least ceil((q - q // 5) / (q // 5 + 1)), as a test checks for every q.
CLASSES = (
    SizeClass(0, 1, 5, 1, 1),
    SizeClass(1, 6, 15, 3, 10),
    SizeClass(2, 16, None, 4, 10),
)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column) -> Column:
    """64-bit hashes of the five-word shingles in order; none for a text of fewer words."""
    def of(h: Column) -> Column:
        return F.when(F.size(h) >= SHINGLE, F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(h) - F.lit(SHINGLE - 1), F.lit(1))),
            lambda i: F.xxhash64(*[F.get(h, i + F.lit(k - 1)) for k in range(SHINGLE)]),
        )).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def _signatures(df: DataFrame, column: str, classes: Column, width: str, step: str) -> DataFrame:
    """Add ``value`` and ``size_class``: one row per window and band of each row's shingle array.

    ``classes`` is an array of size class structs. Windows of the field ``width`` start every
    ``step`` shingles; one that runs over the end repeats the last shingle, which leaves its
    minimum as it is. Generated rows stay inside one stage of compiled code. Class and band are
    hashed in, so values of two bands never meet.
    """
    last = F.size(column) - 1
    rows = df.withColumn("c", F.explode(classes)) \
        .withColumn("s", F.explode(F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.col(f"c.{step}"))))) \
        .withColumn("band", F.explode(F.sequence(F.lit(0), F.col("c.bands") - 1)))
    seed = F.col("c.number") * 100 + F.col("band")
    widest = max(c.width for c in CLASSES)
    value = F.least(*[
        F.xxhash64(F.get(F.col(column), F.least(F.col("s") + F.least(F.lit(k), F.col(f"c.{width}") - 1), last)), seed)
        for k in range(widest)])
    return rows.select(*df.columns, value.alias("value"), F.col("c.number").alias("size_class"))


def _as_array(classes: list[SizeClass]) -> Column:
    return F.array(*[
        F.struct(*[F.lit(v).cast("int").alias(n) for n, v in (
            ("number", c.number), ("least", c.least), ("most", c.most or 2**31 - 1), ("run", c.run),
            ("width", c.width), ("bands", c.bands), ("every", 1))]) for c in classes])


def item_table(items: DataFrame, item: str, text: str) -> DataFrame:
    """(value, item_id, item_shingles): MinHash values of every run of every item, by its size class."""
    own = items.select(F.col(item).alias("item_id"), worked_out(shingles(text_or_empty(text))).alias("ordered"))
    own = own.withColumn("item_shingles", F.array_distinct("ordered"))
    q = F.size("item_shingles")
    mine = F.filter(_as_array(list(CLASSES)), lambda c: (c["least"] <= q) & (q <= c["most"]))
    signed = _signatures(own, "ordered", mine, "run", "every")
    return signed.select("item_id", "item_shingles", "value", "size_class").distinct()


def search(
    docs: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str,
    threshold: float = THRESHOLD, broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, item_id, matched, n_shingles, containment) of every item contained in a document.

    Null texts count as empty. A text or an item of fewer than five words has no shingle and
    matches nothing. Repeated rows of one key or item give one row, with the largest match;
    a null key is a key like any other. Other columns are not read. Empty tables give none.
    """
    table = stage(item_table(items, item, item_text), "items")
    width = F.lit(64) + 8 * F.size("item_shingles") + F.coalesce(F.octet_length(F.col("item_id").cast("string")), F.lit(0))
    classes = {r["size_class"]: (r["rows"], r["bytes"]) for r in table.groupBy("size_class").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).collect()}  # at most 3
    rows, size = (sum(c[i] for c in classes.values()) for i in (0, 1))
    ready = docs.select(F.col(key).alias("doc_id"), worked_out(shingles(text_or_empty(text))).alias("own"))
    there = _as_array([c for c in CLASSES if c.number in classes] or [CLASSES[0]])
    found = _signatures(ready, "own", there, "width", "run").select("doc_id", "own", "value")
    wanted = table.select("value", "item_id", "item_shingles")
    if rows <= broadcast_rows and size <= broadcast_bytes:
        met = found.join(F.broadcast(wanted), "value")
    else:
        # Only 16 bytes a value travel; the texts are read again for the pairs that collide.
        pairs = found.select("value", F.col("doc_id").alias("_doc")).distinct().join(
            table.select("value", F.col("item_id").alias("_item")).distinct(), "value")
        pairs = stage(pairs.select("_doc", "_item").distinct(), "pairs")
        once = items.select(F.col(item).alias("item_id"), F.array_distinct(
            shingles(text_or_empty(item_text))).alias("item_shingles"))
        met = ready.join(pairs, F.col("doc_id").eqNullSafe(F.col("_doc"))) \
            .join(once, F.col("_item").eqNullSafe(F.col("item_id"))).select("doc_id", "own", "item_id", "item_shingles")
    scored = met.select(
        "doc_id", "item_id", F.size("item_shingles").alias("n_shingles"),
        F.size(F.array_intersect("item_shingles", "own")).alias("matched"))
    kept = scored.filter(F.col("matched") >= F.lit(threshold) * F.col("n_shingles"))
    best = kept.groupBy("doc_id", "item_id").agg(
        F.max(F.struct(F.col("matched") / F.col("n_shingles"), "matched", "n_shingles")).alias("best"))
    return best.select(
        "doc_id", "item_id", F.col("best.matched").cast("long").alias("matched"),
        F.col("best.n_shingles").cast("long").alias("n_shingles"),
        (F.col("best.matched") / F.col("best.n_shingles")).alias("containment"))


#: The same search by brute force, for DuckDB: {docs} (doc_id, text) and {items} (item_id, text) are table expressions.
SEARCH_SQL = r"""
with split_docs as (
  select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') w
  from {docs}),
split_items as (
  select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') w
  from {items}),
doc_shingles as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') s
  from (select doc_id, w, unnest(range(1, len(w) - 3)) i from split_docs)),
item_shingles as (
  select distinct item_id, array_to_string(w[i:i + 4], ' ') s
  from (select item_id, w, unnest(range(1, len(w) - 3)) i from split_items)),
sizes as (select item_id, count(*) n from item_shingles group by 1),
met as (select doc_id, item_id, count(*) matched from doc_shingles join item_shingles using (s) group by 1, 2)
select doc_id, item_id, matched, n as n_shingles, matched / n as containment
from met join sizes using (item_id) where matched >= 0.8 * n
"""
