"""Toxicity by a factorization machine over hashed terms.

Besides a weight, each term has a short vector; the product of two vectors says what the two
terms mean together, which a sum of weights cannot. Terms are words and their beginnings, so an
inflected form that no labelled row has still counts by its stem; a stem that several words of a
text share is a further term, as a chance word has it once. The machine is fitted on a bounded sample of labelled rows, on the terms that go with the label there, be it alone or only together with
another term; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import let, sample_ids, text_or_empty
from tallyloom.session import stage

#: Hashed terms; the last place is the constant term.
TERMS = 2**18
FACTORS = 8
#: Most labelled rows that the machine is fitted on.
SAMPLE_ROWS = 20_000
PREDICT_AT = 0.7
#: Lengths of the beginnings of words; how many standard errors a term must stand out alone, and a pair of terms.
STEMS = (4, 5, 6)
LEAST_Z, LEAST_PAIR_Z = 4.0, 6.0
#: Rows with both, one or the other of a pair that are needed to judge it.
LEAST_MET = 5
#: Pairs, counted in every row that has them, that one task looks through; most tasks that share them.
TASK_PAIRS, MOST_TASKS = 1_200_000_000, 64


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def terms(text: Column) -> Column:
    """Distinct terms of a whole text, after the constant term: hashes of its words, of their stems, and of each stem
    that two or more different words share. Words are lower-case runs of letters; a word shorter than a stem has none."""
    words = F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != ""))
    hashed = F.transform(words, lambda w: F.array(
        F.xxhash64(w), *[F.when(F.length(w) >= k, F.xxhash64(F.substring(w, 1, k), F.lit(k))) for k in STEMS]))

    def with_shared(h: Column) -> Column:
        shared = F.array_distinct(F.filter(h, lambda x, i: (i > 0) & (x == F.get(h, i - 1))))
        return F.concat(h, F.transform(shared, lambda x: F.xxhash64(x, F.lit(2))))

    every = let(F.sort_array(F.array_compact(F.flatten(hashed))), with_shared)
    places = F.transform(every, lambda h: F.pmod(h, F.lit(TERMS)).cast("int"))
    return F.concat(F.array(F.lit(TERMS)), F.array_distinct(places))


@dataclass
class Machine:
    """score = sigmoid(sum of weights + (|sum of vectors|^2 - sum of |vector|^2) / 2 / number of terms)."""

    weight: np.ndarray
    vector: np.ndarray
    used: np.ndarray

    def reduced(self, index: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms in use; the constant term is always among them, so no row is empty."""
        held = self.used[index]
        before = np.concatenate([[0], np.cumsum(held)])
        return index[held], before[starts]

    def logits(self, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
        counts = np.diff(np.append(starts, len(index)))
        v = self.vector[index]
        pairs = np.add.reduceat(v, starts) ** 2 - np.add.reduceat(v * v, starts)
        return np.add.reduceat(self.weight[index], starts) + 0.5 * pairs.sum(axis=1) / counts

    def score(self, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.logits(*self.reduced(index, starts)).astype(float), -60, 60)))


def telling(sample: DataFrame, least_z: float = LEAST_Z) -> list[int]:
    """Terms of (label, terms) rows whose shares of rows differ between the labels, or that stand out in a pair."""
    rows = sample.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_label"), F.lit(0.0)).alias("ones")).first()
    ones, zeros = float(rows["ones"]), float(rows["rows"] - rows["ones"])
    if not ones or not zeros:
        return []
    counts = sample.select("_label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("_label").alias("ones"), F.count(F.lit(1)).alias("n")).filter("n >= 3")
    share = (F.col("n") + 1) / (ones + zeros + 2)
    gap = F.abs(F.col("ones") / ones - (F.col("n") - F.col("ones")) / zeros)
    z = gap / F.sqrt(share * (1 - share) * (1 / ones + 1 / zeros))
    best = counts.withColumn("z", z).filter(F.col("z") >= least_z).select("term")
    return [r["term"] for r in best.unionAll(paired(sample)).distinct().orderBy("term").collect()]


def paired(sample: DataFrame, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(term): both terms of every pair that says more, or less, than its two terms add up to.

    All pairs of terms that enough rows have are looked at. As many tasks as the pairs ask for each read
    the stored, bounded sample, take the terms that can be in a pair as it comes, and count the pairs of
    their own share of those terms; no row is copied or shuffled.
    """
    spark = sample.sparkSession
    counts = sample.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    often = np.zeros(TERMS + 1, dtype=bool)
    often[[r["term"] for r in counts.filter(F.col("n") >= 2 * LEAST_MET).select("term").collect()]] = True  # at most TERMS + 1
    shared = spark.sparkContext.broadcast(often)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for b in batches:
            offsets, index = np.asarray(b.column(1).offsets), np.asarray(b.column(1).values)
            held = shared.value[index]
            yield b.column(0).to_numpy(), np.diff(np.concatenate([[0], np.cumsum(held)])[offsets]), index[held]

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lengths, _ in reduced(batches):
            yield pa.RecordBatch.from_pydict({"cost": pa.array([float((lengths.astype(float) ** 2).sum() / 2)])})

    rows = sample.select("_label", "terms")
    cost = rows.mapInArrow(costs, "cost double").agg(F.sum("cost")).first()[0] or 0.0
    tasks = int(min(MOST_TASKS, 1 + cost // task_pairs))

    def share(part: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = list(reduced(batches))
            if got:
                labels, lengths, index = (np.concatenate(column) for column in zip(*got))
                del got
                yield pa.RecordBatch.from_pydict({"term": pa.array(joint(index, lengths, labels, part, tasks), pa.int32())})

        return rows.coalesce(1).mapInArrow(run, "term int")

    return reduce(DataFrame.unionAll, map(share, range(tasks)))


def joint(index: np.ndarray, lengths: np.ndarray, labels: np.ndarray, part: int = 0, parts: int = 1,
          least_z: float = LEAST_PAIR_Z, least: int = LEAST_MET) -> np.ndarray:
    """Terms of the pairs that stand out, among the pairs whose rarer term is of ``part``.

    A pair is judged by the share of label 1 in the rows with both terms, one, the other and none. It
    stands out where the gap that one term makes depends on the other by ``least_z`` standard errors, and
    where each of the first three shares is as far from what the other shares add up to, by likelihood ratio.
    """
    n = np.bincount(index)
    order = np.argsort(-n, kind="stable").astype(np.int32)
    order = order[n[order] >= 2 * least]
    rank = np.full(len(n), -1, dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    # rows as lists of ranks, the most frequent term first; sorted by parts, for memory
    row, flat = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), rank[index]
    row, flat = row[flat >= 0], flat[flat >= 0]
    starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lengths)))])
    for lo in range(0, len(lengths), 500):
        of = slice(starts[lo], starts[min(lo + 500, len(lengths))])
        flat[of] = np.sort(row[of].astype(np.int64) * max(1, len(order)) + flat[of]) % max(1, len(order))
    positive = labels[row] == 1
    n, ones = n[order].astype(float), np.bincount(flat[positive], minlength=len(order)).astype(float)
    rows, total = float(len(labels)), float(labels.sum())
    share, found = total / rows, []
    places = np.flatnonzero(flat % parts == part)
    places = places[np.argsort(flat[places], kind="stable")]
    cuts = np.searchsorted(flat[places], np.arange(part, len(order) + parts, parts))
    for term, lo, hi in zip(range(part, len(order), parts), cuts, cuts[1:]):
        if not term:
            continue
        own = places[lo:hi]
        ends, with_one = own.tolist(), positive[own]
        begins = starts[row[own]].tolist()
        met = np.bincount(np.concatenate([flat[s:e] for s, e in zip(begins, ends)]), minlength=term)
        other = np.flatnonzero((met >= least) & (n[term] - met >= least) & (n[:term] - met >= least)
                               & (rows - n[term] - n[:term] + met >= least))
        if not len(other):
            continue
        toxic = [flat[s:e] for s, e, one in zip(begins, ends, with_one) if one]
        both = np.bincount(np.concatenate(toxic), minlength=term)[other].astype(float) if toxic else np.zeros(len(other))
        met = met[other].astype(float)
        sizes = [met, n[term] - met, n[other] - met, rows - n[term] - n[other] + met]
        held = [both, ones[term] - both, ones[other] - both, total - ones[term] - ones[other] + both]
        rates = [k / m for k, m in zip(held, sizes)]
        depends = rates[0] - rates[1] - rates[2] + rates[3]
        good = depends**2 >= least_z**2 * share * (1 - share) * sum(1 / m for m in sizes)
        for k, m, sign in zip(held[:3], sizes[:3], (1, -1, -1)):
            k, m = k[good], m[good]
            told = np.clip(k / m - sign * depends[good], 0.1 * share, 1 - 0.1 * (1 - share))
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = 2 * (np.where(k > 0, k * np.log(k / m / told), 0) + np.where(k < m, (m - k) * np.log((1 - k / m) / (1 - told)), 0))
            good[good] = ratio >= least_z**2
        if good.any():
            found += [order[[term]], order[other[good]]]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int32)


def train(index: np.ndarray, starts: np.ndarray, labels: np.ndarray, epochs: int = 10, batch: int = 256, rate: float = 0.15,
          ridge: float = 0.1, seed: int = 7, size: int = TERMS + 1) -> Machine:
    """Adagrad on the logistic loss, rare label weighted up; terms that the rows lack stay at zero and out of use."""
    random = np.random.default_rng(seed)
    positive = labels.sum()
    seen = np.union1d(index, [size - 1])
    machine = Machine(np.zeros(size, dtype=np.float32), np.zeros((size, FACTORS), dtype=np.float32), np.zeros(size, dtype=bool))
    machine.used[seen] = True
    if positive == 0 or positive == len(labels):
        machine.used[:size - 1] = False
        machine.weight[size - 1] = -6 if positive == 0 else 6
        return machine
    machine.vector[seen] = random.normal(0, 0.01, (len(seen), FACTORS))
    squares_w, squares_v = np.full(size, 1e-2, dtype=np.float32), np.full((size, FACTORS), 1e-2, dtype=np.float32)
    heavy = min(10.0, float((len(labels) - positive) / positive))
    ends = np.append(starts[1:], len(index))
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for at in range(0, len(order), batch):
            docs = order[at:at + batch]
            lengths = ends[docs] - starts[docs]
            own = np.concatenate([index[starts[d]:ends[d]] for d in docs])
            begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            truth = labels[docs]
            error = (machine.score(own, begin) - truth) * np.where(truth == 1, heavy, 1.0) * 64 / len(docs)
            of = np.repeat(np.arange(len(docs)), lengths)
            places, inverse = np.unique(own, return_inverse=True)
            grad_w = np.bincount(inverse, error[of], len(places)) + ridge * machine.weight[places]
            v = machine.vector[own]
            summed = np.add.reduceat(v, begin)
            each = (error / lengths)[of][:, None] * (summed[of] - v)
            grad_v = np.stack([np.bincount(inverse, each[:, k], len(places)) for k in range(FACTORS)], axis=1) \
                + ridge * machine.vector[places]
            squares_w[places] += grad_w**2
            squares_v[places] += grad_v**2
            machine.weight[places] -= rate * grad_w / np.sqrt(squares_w[places])
            machine.vector[places] -= rate / 3 * grad_v / np.sqrt(squares_v[places])
    return machine


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Machine:
    """Fitted on at most ``rows`` labelled documents that are not held out; null labels and ids do not count.

    A repeated id counts once, with its largest label and least terms.
    """
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.join(F.broadcast(sample_ids(known, "doc_id", rows)), "doc_id") \
        .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("double").alias("_label"))
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    sample = stage(met.select("_id", "_label", terms(text_or_empty("text")).alias("terms")).groupBy("_id", "_label").agg(
        F.min("terms").alias("terms")), "terms")
    # Only the terms in use reach the driver.
    used = np.zeros(TERMS + 1, dtype=bool)
    used[[TERMS, *telling(sample)]] = True
    shared = docs.sparkSession.sparkContext.broadcast(used)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            offsets, index = np.asarray(lists.offsets), np.asarray(lists.values)
            kept = shared.value[index]
            before = np.concatenate([[0], np.cumsum(kept)])[offsets].astype(np.int32)
            terms = pa.ListArray.from_arrays(pa.array(before), pa.array(index[kept]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), terms], names=["_id", "_label", "terms"])

    got = sample.select("_id", "_label", "terms").mapInArrow(held, sample.select("_id", "_label", "terms").schema).orderBy("_id").toArrow()
    lists = got.column("terms").combine_chunks()
    index = np.asarray(lists.flatten())
    starts = np.asarray(lists.offsets)[:-1] if len(lists) else np.zeros(0, dtype=int)
    return train(index, starts - (starts[0] if len(starts) else 0), got.column("_label").to_numpy())


def scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, predict_at: float = PREDICT_AT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of documents.

    Null and empty texts get the score of the constant term alone. Repeated rows stay. A null
    doc_id is not held out by its own right: it counts as the empty string. Only the text is an
    input of a score; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            offsets, index = np.asarray(lists.offsets), np.asarray(lists.values)
            got = np.zeros(len(lists))
            for at in range(0, len(lists), 256):
                part = offsets[at:min(at + 256, len(lists)) + 1]
                got[at:at + 256] = shared.value.score(index[part[0]:part[-1]], part[:-1] - part[0])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", terms(text_or_empty("text")).alias("terms")).mapInArrow(run, f"doc_id {kind}, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= predict_at).cast("int").alias("predicted"))
