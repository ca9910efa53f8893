"""Entity resolution: banded random hyperplanes, candidate pairs, labels, exact pair counts.

Records that are alike in all that matters fold into one class with a count. Candidate pairs are
pairs of classes, each standing for a known number of record pairs, and a class of several
copies also pairs with itself; so every pair of records is there, at any size, and copies are
never expanded. Truth is membership with group sizes, never a list of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tallyloom.operators import pairblocks as pb
from tallyloom.operators.ordered import running
from tallyloom.session import stage

MAX_COUNTED_BANDS = 8
#: Classes of a bucket above which it is cut into tiles; every pair of tiles is compared by itself.
TILE = 1000


def choose_bands(length: int, target: float) -> tuple[int, int, float]:
    """(bands, rows, threshold): of all ways to cut the signature, the one of the least threshold above ``target``.

    The threshold of a cut is (1 / bands) ** (1 / rows); where none is above, one band of all rows.
    """
    cuts = [(b, length // b) for b in range(1, length + 1) if length % b == 0]
    above = [((1.0 / b) ** (1.0 / r), b, r) for b, r in cuts if (1.0 / b) ** (1.0 / r) > target]
    if not above:
        return 1, length, 1.0
    threshold, bands, rows = min(above)
    return bands, rows, threshold


def plane_count(points: int) -> int:
    """Planes for 8 bins per point."""
    return math.ceil(math.log2(8 * points))


def planes(rows: int, count: int, seed: int) -> np.ndarray:
    """count x rows matrix of +1/-1; plane j does not depend on how many follow."""
    return np.stack([np.random.default_rng([seed, j]).choice([1, -1], size=rows) for j in range(count)])


def signatures(df: DataFrame, vector: str, bands: int, length: int, points: int, seed: int = 1) -> DataFrame:
    """Add ``hashes``: one integer per band, bit j set where the band's dot with plane j is >= 0.

    All bands share the planes. One matrix product per Arrow batch.
    """
    rows = length // bands
    matrix = planes(rows, plane_count(points), seed).T.astype(float)
    weights = 2 ** np.arange(matrix.shape[1], dtype=np.int64)

    @F.pandas_udf("array<bigint>")
    def band_hashes(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        v = np.stack(vectors.to_numpy()).astype(float)[:, : bands * rows].reshape(-1, rows)
        return pd.Series(list((((v @ matrix) >= 0) @ weights).reshape(-1, bands)))

    return df.withColumn("hashes", band_hashes(vector))


def bucket_rows(signed: DataFrame, keep: list[str]) -> DataFrame:
    """One row per (record, band): keep columns, ``band`` and ``hash``."""
    return signed.select(*keep, F.posexplode("hashes").alias("band", "hash"))


def bucket_sizes(buckets: DataFrame, keys: list[str], minimum: int = 2) -> DataFrame:
    """Size and smallest member of each bucket of at least ``minimum`` members."""
    sizes = buckets.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first_id"))
    return sizes.filter(F.col("size") >= minimum)


def distinct_bucket_contents(buckets: DataFrame, minimum: int = 2) -> DataFrame:
    """Each distinct set of members once, whatever band shows it.

    Sets are compared by size and two order-free sums of member hashes, so no member list
    is ever collected.
    """
    h = F.xxhash64("id")
    prints = buckets.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("size"), F.min("id").alias("first_id"),
        F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h, F.lit(7))).alias("y"))
    return prints.filter(F.col("size") >= minimum).select("size", "first_id", "x", "y").distinct()


def truth_groups(df: DataFrame, key: str, id: str = "id") -> DataFrame:
    """(key, id, size, pairs): membership of every group of two records or more, its size and its number of pairs.

    A null key is no group.
    """
    rows = stage(df.select(F.col(key), F.col(id)).filter(F.col(key).isNotNull()), "members")
    sizes = stage(rows.groupBy(key).agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes")
    return rows.join(sizes, key).withColumn("pairs", (F.col("size") * (F.col("size") - 1) / 2).cast("long"))


def classes(signed: DataFrame, id: str, alike: list[str]) -> DataFrame:
    """(id, copies, alike columns): records equal in ``hashes`` and ``alike`` as one row, with their smallest id."""
    return signed.groupBy("hashes", *alike).agg(F.min(id).alias("id"), F.count(F.lit(1)).alias("copies"))


def class_members(signed: DataFrame, id: str = "id", alike: list[str] | None = None) -> DataFrame:
    """(id, representative, copies) of every record: the smallest id and the size of its class.

    ``alike`` names what records of a class agree in besides ``hashes``: for the pairs of
    ``candidate_pairs``, its ``same``, ``different`` and ``alike``. Nulls are equal.
    """
    own = ["hashes", *(alike or [])]
    rows = stage(signed.select(F.col(id).alias("id"), *own), "signed")
    folded = classes(rows, "id", own[1:]).select(F.col("id").alias("representative"), "copies", *[F.col(c).alias(f"_{c}") for c in own])
    return rows.join(folded, [rows[c].eqNullSafe(folded[f"_{c}"]) for c in own]).select("id", "representative", "copies")


def _with_sides(pairs: DataFrame, records: DataFrame, id: str = "id") -> DataFrame:
    """Pairs joined with the columns c of ``records`` by either id, as c_a and c_b."""
    for x in "ab":
        pairs = pairs.join(records.select(*[F.col(c).alias(f"id_{x}" if c == id else f"{c}_{x}") for c in records.columns]), f"id_{x}")
    return pairs


def candidate_pairs(
    signed: DataFrame, id: str = "id", same: list[str] | None = None, different: str | None = None,
    alike: list[str] | None = None, tile: int = TILE, carried: DataFrame | None = None, features: bool = False,
) -> DataFrame:
    """(id_a, id_b, pairs, same columns): pairs of classes that share a bucket in any band.

    Records are of one class where they agree in ``hashes``, ``same``, ``different`` and
    ``alike``; the smallest id names the class. The two records of a pair agree in ``same`` and
    differ in ``different``. A pair of classes comes out once, in its first common band, and
    stands for ``pairs`` pairs of records; a class of several copies comes out as a pair with
    itself. Large buckets are cut into tiles, whose pairs are spread over tasks. Null ``same`` or
    ``different`` values pair with nothing.

    ``carried`` has the id and more columns c of the records, which come out as c_a and c_b, as if
    the pairs were joined with it by either id. They go with the classes to their buckets, so what
    is shuffled follows the classes, not the pairs. It is read several times, so it is a stored table.

    With ``features`` the four ``PAIR_FEATURES`` come out in place of the ``PAIR_SIDE`` of either side. They are worked
    out in blocks where the classes meet (``pairblocks``), so vectors and words leave no bucket.
    """
    same, other = same or [], [different] if different else []
    own = list(dict.fromkeys([*same, *other, *(alike or [])]))
    folded = stage(classes(signed, id, own), "classes")
    keys = ["band", "hash", *same]
    buckets = folded.select("id", "copies", "hashes", *same, *other, F.posexplode("hashes").alias("band", "hash"))
    sizes = stage(buckets.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "buckets")
    met = buckets.join(sizes, keys).withColumn("_tiles", F.ceil(F.col("_n") / F.lit(tile)).cast("int"))
    met = met.withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_tiles")).cast("int"))
    more = [] if carried is None else [c for c in carried.columns if c != id]
    if carried is not None:
        met = met.join(carried.withColumnRenamed(id, "id"), "id")
    # a class goes to each pair of tiles once; both sides of the join are the same rows, shuffled once
    tiles = met.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    tiles = tiles.withColumns({"_low": F.least("_own", "_other"), "_high": F.greatest("_own", "_other")}).drop("_other")
    if features:
        return _featured_pairs(tiles, [*keys, "_low", "_high"], same, different, [c for c in more if c not in PAIR_SIDE], folded, carried, id)
    a, b = tiles.alias("a"), tiles.alias("b")
    rule = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_low", "_high"]])
    rule = rule & (F.col("a.id") < F.col("b.id")) & ((F.col("a._own") != F.col("b._own")) | (F.col("a._low") == F.col("a._high")))
    if different:
        rule = rule & (F.col(f"a.{different}") != F.col(f"b.{different}"))
    agree = F.zip_with("a.hashes", "b.hashes", lambda x, y: x == y)
    first = F.array_position(agree, True) - 1 == F.col("a.band")
    pairs = a.join(b, rule).filter(first).select(
        F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"),
        (F.col("a.copies") * F.col("b.copies")).alias("pairs"), *[F.col(f"a.{c}").alias(c) for c in same],
        *[F.col(f"{x}.{c}").alias(f"{c}_{x}") for x in "ab" for c in more])
    if different:
        return pairs
    inside = _inside(folded, same)
    return pairs.unionByName(inside if carried is None else _with_sides(inside, carried, id))


def _inside(folded: DataFrame, same: list[str]) -> DataFrame:
    """Classes of several copies as pairs with themselves."""
    known = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in same], F.lit(True))
    return folded.filter((F.col("copies") > 1) & known).select(
        F.col("id").alias("id_a"), F.col("id").alias("id_b"),
        (F.col("copies") * (F.col("copies") - 1) / 2).cast("long").alias("pairs"), *same)


def _featured_pairs(
    tiles: DataFrame, group: list[str], same: list[str], different: str | None, more: list[str],
    folded: DataFrame, carried: DataFrame, id: str,
) -> DataFrame:
    """The pairs of ``candidate_pairs`` with their features: the rows of a bucket lie together, sorted by id.

    A task holds the rows of a few buckets or of two tiles, and a bounded number of their pairs.
    """
    kinds = {f.name: f.dataType for f in tiles.schema}
    schema = StructType(
        [StructField(f"id_{x}", kinds["id"]) for x in "ab"] + [StructField("pairs", LongType())]
        + [StructField(c, kinds[c]) for c in same]
        + [StructField(f"{c}_{x}", kinds[c]) for x in "ab" for c in more]
        + [StructField(c, DoubleType()) for c in PAIR_FEATURES])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in pb.whole_groups(batches, group):
            rows = pb.Rows(t, group, different)
            for a, b in rows.pairs():
                at = {"a": pa.array(a), "b": pa.array(b)}
                columns = [t.column("id").take(at[x]) for x in "ab"] + [pa.array(rows.copies[a] * rows.copies[b])]
                columns += [t.column(c).take(at["a"]) for c in same]
                columns += [t.column(c).take(at[x]) for x in "ab" for c in more]
                columns += [pa.array(x) for x in (
                    rows.vectors.cosine(a, b), rows.tokens.jaccard(a, b), rows.same_model(a, b), rows.length_gap(a, b))]
                yield from pa.table(columns, names=schema.names).combine_chunks().to_batches()

    kept = list(dict.fromkeys([*group, "_own", "id", "copies", "hashes", *([different] if different else []), *PAIR_SIDE, *more]))
    met = tiles.select(*kept).repartition(*group).sortWithinPartitions(*group, "id").mapInArrow(compared, schema)
    if different:
        return met
    inside = pair_features(_with_sides(_inside(folded, same), carried, id))
    return met.unionByName(inside.select(*schema.names))


def _twice_pairs(n: Column) -> Column:
    """n (n - 1), twice the pairs of a group, null for a single row.

    Decimal, so that no group is too large; sums are halved once at the end.
    """
    return F.when(n > 1, n.cast("decimal(19,0)") * (n - 1).cast("decimal(19,0)"))


def pair_totals(
    signed: DataFrame, bands: int, truth: str, same: list[str] | None = None,
    different: str | None = None,
) -> DataFrame:
    """Exact counts over all pairs: candidates, true duplicates found, true duplicates.

    A pair counts once however many bands it shares: inclusion and exclusion over the sets
    of bands, each term a sum of n(n-1)/2 over groups equal in those bands. Rows with the
    same keys are summed map-side, so copies and hot buckets cost nothing extra. The sets double
    with each band; above ``MAX_COUNTED_BANDS`` bands tiles of classes are compared instead.
    """
    same = same or []
    if bands > MAX_COUNTED_BANDS:
        from tallyloom.operators.bandcount import any_band_totals

        sums = any_band_totals(signed, truth, same, different)
        every = signed.groupBy(truth).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(_twice_pairs(F.col("n"))) / 2)
        return sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("candidates", "found")]).select(
            "candidates", "found", F.coalesce(every.scalar(), F.lit(0)).cast("bigint").alias("duplicates"))
    subsets = [c for k in range(1, bands + 1) for c in combinations(range(bands), k)]
    choices = F.array(*[
        F.struct(F.lit(i).alias("no"), F.lit(1 if len(s) % 2 else -1).alias("sign"),
                 F.array(*[F.lit(b) for b in s]).alias("bands"))
        for i, s in enumerate(subsets)
    ])
    other = F.col(different) if different else F.lit(0)
    # copies fold into one weighted row before every row is repeated per set of bands
    folded = signed.groupBy(*same, F.col(truth).alias("_truth"), other.alias("_other"), "hashes").agg(
        F.count(F.lit(1)).alias("n"))
    keyed = folded.select(*same, "_truth", "_other", "n", "hashes", F.explode(choices).alias("s")).select(
        "s.no", "s.sign", F.transform("s.bands", lambda b: F.get("hashes", b)).alias("key"),
        *same, "_truth", "_other", "n")
    group = ["no", "sign", "key", *same]
    cells = keyed.groupBy(*group, "_truth", "_other").agg(F.sum("n").alias("n"))

    # one shuffle by group serves every sum below; a hot group has few rows left by now
    spread = cells.repartition(*group)
    n, sign = F.col("n"), F.col("sign")

    def none(c: Column) -> Column:
        return F.coalesce(c, F.lit(0).cast("decimal(38,0)"))

    by_truth = spread.groupBy(*group, "_truth").agg(
        F.sum("n").alias("n"), F.sum(_twice_pairs(n)).alias("alike_both"))
    by_group = by_truth.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum(_twice_pairs(n)).alias("found"), F.sum("alike_both").alias("alike_both"))
    counted = [by_group.filter(n > 1).select(
        (sign * none(_twice_pairs(n))).alias("candidates"),
        (sign * (none(F.col("found")) - (none(F.col("alike_both")) if different else F.lit(0)))).alias("found"))]
    if different:  # take away the pairs that agree in it
        alike = spread.groupBy(*group, "_other").agg(F.sum("n").alias("n")).filter(n > 1)
        counted.append(alike.select((-sign * _twice_pairs(n)).alias("candidates"), F.lit(0).alias("found")))
    models = signed.groupBy(truth).agg(F.count(F.lit(1)).alias("n"))
    duplicates = models.agg(F.sum(_twice_pairs(n))).scalar()
    every = reduce(lambda a, b: a.unionByName(b), counted)
    return every.agg(*[
        (none(c) / 2).cast("bigint").alias(name)
        for name, c in (("candidates", F.sum("candidates")), ("found", F.sum("found")), ("duplicates", duplicates))
    ])


def label_pairs(pairs: DataFrame, records: DataFrame | None, truth: str, id: str = "id",
                keep: int | None = None) -> DataFrame:
    """Add ``label`` 1 where both records have the same truth value; keep 1s, 0s or both.

    Without ``records`` the pairs carry the truth of either side.
    """
    both = pairs
    if records is not None:
        side = records.select(F.col(id), F.col(truth).alias("_truth"))
        both = _with_sides(pairs, side, id)
    a, b = (f"{truth if records is None else '_truth'}_{x}" for x in "ab")
    labelled = both.withColumn("label", (F.col(a) == F.col(b)).cast("int")).drop(a, b)
    return labelled if keep is None else labelled.filter(F.col("label") == keep)


def balance(labelled: DataFrame, order: Column, ties: list[str]) -> DataFrame:
    """Repeat the smaller class until both have the same number of rows.

    Every small row appears floor(large / small) times and the first ``large mod small``
    rows by ``order`` (a hash) once more, so the result is exact and repeatable.
    """
    df = stage(labelled.withColumn("_order", order), "labelled")
    counts = {row["label"]: row["n"] for row in df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    if not positive or not negative:
        return df.drop("_order").withColumn("copy", F.lit(1))
    small, large = sorted([positive, negative])
    scarce = 1 if positive <= negative else 0
    few = df.filter(F.col("label") == scarce)
    ranked = running(few, "_order", ties, staged=False)
    times = F.lit(large // small) + (F.col("position") <= large % small).cast("int")
    copies = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1), times.cast("int"))))
    many = df.filter(F.col("label") != scarce).withColumn("copy", F.lit(1))
    return many.unionByName(copies.drop("position")).drop("_order")


def balance_weights(labelled: DataFrame) -> DataFrame:
    """Add ``weight``: ``pairs`` times a factor of the label, so that both labels weigh as much as the larger has record pairs.

    With one label only the weight is ``pairs``.
    """
    df = stage(labelled, "labelled")
    sums = {row["label"]: row["n"] for row in df.groupBy("label").agg(F.sum("pairs").alias("n")).collect()}
    if not sums.get(1) or not sums.get(0):
        return df.withColumn("weight", F.col("pairs").cast("double"))
    own = F.when(F.col("label") == 1, F.lit(sums[1])).otherwise(F.lit(sums[0]))
    return df.withColumn("weight", F.col("pairs") * F.lit(float(max(sums[0], sums[1]))) / own)


def bootstrap_split(df: DataFrame, id: str, draw: Column) -> DataFrame:
    """Add ``split``: n draws with replacement, drawn rows train, the others test.

    ``draw`` maps the draw number ``k`` and the row count ``n`` to a position 0..n-1.
    """
    indexed = running(df, id, [id])
    total = df.agg(F.count(F.lit(1))).scalar()
    drawn = (
        indexed.select(F.col("position").alias("k"), total.alias("n"))
        .select(draw.alias("drawn")).distinct()
    )
    found = indexed.join(drawn, F.col("position") - 1 == F.col("drawn"), "left")
    return found.withColumn(
        "split", F.when(F.col("drawn").isNotNull(), "train").otherwise("test")
    ).drop("position", "drawn")


def minhash(indices: Column, a: int, b: int, p: int, m: int) -> Column:
    """min over the set of ((a * i + b) mod p) mod m"""
    return F.array_min(F.transform(indices, lambda i: ((F.lit(a) * i + F.lit(b)) % F.lit(p)) % F.lit(m)))


def cosine(a: Column, b: Column) -> Column:
    def dot(x, y):
        products = F.zip_with(x, y, lambda s, t: s.cast("double") * t.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(common, F.size(a) + F.size(b) - common), F.lit(0.0))


PAIR_SIDE = ["vector", "tokens", "model_id", "length"]


def pair_features(pairs: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Cosine, token overlap, model id equality and length gap of each pair.

    ``records`` has id, vector, tokens, model_id and length. Without it the pairs carry these of
    either side (``candidate_pairs``), and nothing is joined, or they have the features from where they met.
    """
    if records is None and set(PAIR_FEATURES) <= set(pairs.columns):
        return pairs
    joined = pairs if records is None else _with_sides(pairs, records.select("id", *PAIR_SIDE))
    sides = {f"{c}_{x}" for c in PAIR_SIDE for x in "ab"}
    return joined.select(
        *[c for c in pairs.columns if c not in sides],
        cosine(F.col("vector_a"), F.col("vector_b")).alias("cosine"),
        jaccard(F.col("tokens_a"), F.col("tokens_b")).alias("overlap"),
        F.coalesce((F.col("model_id_a") == F.col("model_id_b")).cast("double"), F.lit(0.0)).alias("same_model"),
        F.coalesce(
            F.try_divide(F.abs(F.col("length_a") - F.col("length_b")), F.greatest("length_a", "length_b")),
            F.lit(0.0)).alias("length_gap"),
    )


PAIR_FEATURES = ["cosine", "overlap", "same_model", "length_gap"]


#: Newton step of the scaled coefficients that is a fit's last.
SETTLED = 1e-5


def fit_pair_classifier(features: DataFrame, iterations: int = 50, penalty: float = 1e-4):
    """Class-weighted logistic model of duplicate probability; a row with ``pairs`` counts as that many pairs.

    Newton steps on the objective of MLlib's ``LogisticRegression`` (mean weighted loss, ``penalty`` on the coefficients
    of features scaled by their deviation, free intercept). Each step reads the features once and gathers a row of sums
    a task; no copy of them is kept in memory. ``features`` is read some ten times, so it is a stored table.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.common import _py2java
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.wrapper import JavaParams

    pairs = F.col("pairs").cast("double") if "pairs" in features.columns else F.lit(1.0)
    rows = features.select(F.col("label").cast("double").alias("label"), pairs.alias("pairs"),
                           *[F.col(c).cast("double").alias(c) for c in PAIR_FEATURES])
    sums = {row["label"]: row for row in rows.groupBy("label").agg(  # two rows
        F.sum("pairs").alias("n"), F.sum(F.col("pairs") * F.col("pairs")).alias("squares"),
        F.array(*[F.sum(F.col("pairs") * F.col(c)) for c in PAIR_FEATURES]).alias("x"),
        F.array(*[F.sum(F.col("pairs") * F.col(c) * F.col(c)) for c in PAIR_FEATURES]).alias("xx")).collect()}
    if not sums or set(sums) - {0.0, 1.0}:
        raise ValueError(f"labels must be 0 or 1 and there must be pairs: {sorted(map(str, sums))}")
    if len(sums) == 1:  # as in MLlib: all pairs have the one label
        coefficients, intercept = np.zeros(len(PAIR_FEATURES)), math.inf if 1.0 in sums else -math.inf
    else:
        total = sum(r["n"] for r in sums.values())
        factor = {y: 0.5 * total / r["n"] for y, r in sums.items()}
        weight = sum(factor[y] * r["n"] for y, r in sums.items())
        mean, square = (sum(factor[y] * np.array(r[c]) for y, r in sums.items()) / weight for c in ("x", "xx"))
        unbiased = weight - sum(factor[y] ** 2 * r["squares"] for y, r in sums.items()) / weight
        spread = np.maximum(square - mean**2, 0.0) * weight / unbiased if unbiased > 0 else np.zeros(len(mean))
        spread = np.where(spread > 1e-14 * square, np.sqrt(spread), 0.0)
        coefficients, intercept = pb.newton(rows, PAIR_FEATURES, factor, weight, mean, spread, penalty, iterations, SETTLED)
    java = JavaParams._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", "pair_classifier",
        _py2java(features.sparkSession.sparkContext, Vectors.dense(coefficients)), float(intercept))
    return PipelineModel([VectorAssembler(inputCols=PAIR_FEATURES, outputCol="features"), LogisticRegressionModel(java)])


def duplicate_probability(model, features: DataFrame) -> DataFrame:
    """Add ``p`` of the fitted logistic model, as an expression on its features."""
    fitted = model.stages[-1]
    terms = [F.lit(float(c)) * F.col(x) for c, x in zip(fitted.coefficients, PAIR_FEATURES)]
    margin = reduce(lambda a, b: a + b, terms) + F.lit(float(fitted.intercept))
    return features.withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))


def _run_lengths(ids: Column) -> Column:
    """(term, count) of the equal values of a sorted array, in order; no pass over it is quadratic."""
    def of(a: Column) -> Column:
        n = F.size(a)
        starts = F.filter(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
                          lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)))
        ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n))
        # a filter keeps starts apart from their ends, so both are read by position
        return F.zip_with(starts, F.slice(ends, F.lit(1), F.size(starts)), lambda i, j: F.struct(
            F.get(a, i).alias("term"), (j - i).alias("count")))

    return F.transform(F.array(ids), of)[0]


def hashed_term(word: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(size)).cast("int")


def term_counts(df: DataFrame, text: str, size: int = 4096, term: Callable[[Column, int], Column] = hashed_term) -> DataFrame:
    """Add ``counts``, a (term, count) array sorted by term, of the words of the whole text.

    Words are the lower-case pieces between blanks; each goes to one of ``size`` terms. A null
    or empty text has no terms. Rows stay rows; nothing is shuffled.
    """
    # sort_array compares in place; array_sort would call a comparing expression for every two terms
    return df.withColumn("counts", _run_lengths(F.sort_array(_terms(text, size, term))))


def _terms(text: str, size: int, term: Callable[[Column, int], Column]) -> Column:
    """The term of every word of the whole text, in their order."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[ \n\r\t]+"), lambda w: w != "")
    return F.transform(words, lambda w: term(w, size))


def inverse_frequencies(held: DataFrame, size: int) -> list[float]:
    """log((rows + 1) / (rows with the term + 1)) for every term, from the distinct ``terms`` of each row.

    One aggregate of at most ``size`` + 1 rows.
    """
    held = held.select(F.explode(F.concat(F.array(F.lit(-1)), F.col("terms"))).alias("term"))
    seen = {row["term"]: row["count"] for row in held.groupBy("term").count().collect()}  # bounded by size
    rows = seen.get(-1, 0)
    return [math.log((rows + 1) / (seen.get(t, 0) + 1)) for t in range(size)]


def text_vectors(df: DataFrame, text: str, size: int = 4096, term: Callable[[Column, int], Column] = hashed_term) -> DataFrame:
    """Add ``vector``, a (term, weight) array sorted by term, for blocking where no embedding is given.

    A weight is the count of the term in the whole text times its inverse document frequency;
    a term of all rows weighs 0. Only the ``size`` frequencies reach the driver, and they
    travel as one array literal.
    """
    counted = term_counts(df, text, size, term)
    # what a row holds is asked without its counts: nothing is sorted for it
    weights = F.lit(inverse_frequencies(df.select(F.array_distinct(_terms(text, size, term)).alias("terms")), size))
    return counted.withColumn("vector", F.transform("counts", lambda c: F.struct(
        c["term"].alias("term"), (c["count"] * F.get(weights, c["term"])).alias("weight")))).drop("counts")
