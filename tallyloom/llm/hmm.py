"""Language-model scores from a hidden Markov model over words.

Every word belongs to one class: the most frequent words of the training rows are classes of their
own, all others share a bucket by their last letters. A state emits a class, and a class emits its
words by their exact training counts, so the chance of a text is the forward recursion over its
classes times what the words have inside their classes; unknown words have a share in each bucket.

Word counts cover all training rows and are shuffled by word. Counts of at most ``TABLE`` frequent
words are sent to all tasks; the counts of the words of the long tail meet the texts by a join.
Baum-Welch runs over all training rows: each task adds up expected counts, Spark sums them by
class, and only the bounded table of classes x states reaches the driver. The first rounds take turns
on shares of the training rows, so that together they read every row once; the last read all rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import text_or_empty
from tallyloom.session import stage

#: Hidden states; words with a class of their own; buckets for the others.
STATES, OWN, BUCKETS = 8, 32_768, 1024
#: Words in the table sent to all tasks, and the bytes of the longest: 5 MB as a rule, 20 MB at most.
TABLE, LONGEST = 262_144, 64
#: Least training rows of a share in the start on average, rounds of the start, and the rounds over all training rows.
START_ROWS, START_ROUNDS, ROUNDS = 1500, 10, 3
#: Least tasks of a round of the start.
START_TASKS = 8
#: A task's counts are passed on beyond so many words.
FLUSH = 200_000
#: Tokens whose recursions run side by side; places whose steps are summed at once.
SIDE_BY_SIDE, BLOCK = 262_144, 16_384
END = b""
#: Expected counts every state has beforehand, spread like the classes of all words.
PRIOR = 100.0


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased, then the end."""
    found = text.lower().split()
    found.append(END)
    return found


def bucket_of(word: bytes) -> int:
    return crc32(word[-3:]) % BUCKETS


def _bucket(word: Column) -> Column:
    return F.crc32(F.substring(word, -3, 3)) % BUCKETS


def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, c) of all rows of one binary column, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])

        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0):
                counts.update(words_of(text.as_py()))
                if len(counts) > FLUSH:
                    yield out()
                    counts = Counter()
        yield out()

    return stage(texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")


@dataclass
class Classes:
    """Words and classes: own classes first, then the buckets."""

    table: dict[bytes, tuple[int, int]]  # word -> (class, count) of the frequent words
    own: int
    total: int  # N
    distinct: int  # V
    bucket_mass: np.ndarray  # of each bucket: training tokens in it, and 0.5 for each word and the unknown
    class_share: np.ndarray  # share of each class of all tokens

    @property
    def size(self) -> int:
        return self.own + BUCKETS

    @property
    def base_mass(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)


def frequent(counts: DataFrame, table: int = TABLE) -> DataFrame:
    """At most ``table`` words, all those whose count is above one bound found from a small histogram of counts."""
    step = F.floor(F.log2("c") * 16).cast("int")
    short = counts.filter(F.octet_length("word") <= LONGEST).withColumn("step", step)
    sizes = sorted(((r["step"], r["n"]) for r in short.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, held = math.inf, 0
    for s, n in sizes:
        held += n
        if held > table:
            break
        least = s
    return short.filter(F.col("step") >= (2**31 - 1 if least == math.inf else least)).select("word", "c")


def classes(counts: DataFrame, table: int = TABLE, own: int = OWN) -> Classes:
    total, distinct = (v or 0 for v in counts.agg(F.sum("c"), F.count(F.lit(1))).first())
    held = frequent(counts, table).toArrow()
    pairs = sorted(zip(held.column("word").to_pylist(), held.column("c").to_pylist()), key=lambda p: (p[0] != END, -p[1], p[0]))
    tokens, distinct_in = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.groupBy(_bucket(F.col("word")).alias("b")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        tokens[r["b"]], distinct_in[r["b"]] = r["c"], r["n"]
    own = min(own, len(pairs))
    numbers = {}
    for at, (word, c) in enumerate(pairs):
        b = bucket_of(word)
        numbers[word] = (at if at < own else own + b, c)
        if at < own:
            tokens[b] -= c
            distinct_in[b] -= 1
    mass = tokens + 0.5 * (distinct_in + 1)
    share = np.concatenate([np.array([c for _, c in pairs[:own]], dtype=float), mass])
    return Classes(numbers, own, total, distinct, mass, share / share.sum())


def encoded(docs: DataFrame, known: Classes) -> DataFrame:
    """The rows as classes (two bytes each), stored, with what the table of frequent words says and the rest as words.

    (row, doc_id, held_out, n_tokens, n_known, base, inside, classes, rare): ``base`` sums log10(c + 0.5)
    over known words, ``inside`` the log10 shares of words inside their buckets without the counts of the rare.
    """
    names = list(known.table)
    sent = docs.sparkSession.sparkContext.broadcast((
        names, np.array([known.table[w][0] for w in names], dtype=np.uint16), np.array([known.table[w][1] for w in names], dtype=np.float64),
        known.own, np.log10(known.bucket_mass)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, number, count, own, log_mass = sent.value
        place = dict(zip(listed, range(len(listed)))).get
        logs = np.log10(count + 0.5)
        within = np.where(number >= own, logs - log_mass[np.maximum(number.astype(np.int64) - own, 0)], 0.0)
        for b in batches:
            lengths, known_n, base, inside, coded, rare_words, rare_n, ends = [], [], [], [], [], [], [], [0]
            for text in b.column(3):
                words = words_of(text.as_py())
                at = np.fromiter(map(place, words, repeat(-1)), dtype=np.int64, count=len(words))
                seen = at >= 0
                code = number[at] if len(number) else np.zeros(len(at), dtype=np.uint16)
                held = at[seen]
                kept, part = float(logs[held].sum()), float(within[held].sum())
                if len(held) < len(words):
                    missing = np.flatnonzero(~seen)
                    unlisted = [words[i] for i in missing]
                    buckets = np.array([bucket_of(w) for w in unlisted], dtype=np.int64)
                    code[missing] = buckets + own
                    part -= float(log_mass[buckets].sum())
                    counted = Counter(unlisted)
                    rare_words += counted
                    rare_n += counted.values()
                lengths.append(len(words))
                known_n.append(len(held))
                base.append(kept)
                inside.append(part)
                coded.append(code.tobytes())
                ends.append(len(rare_words))
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(rare_words, pa.binary()), pa.array(rare_n, pa.int64())], names=["word", "n"]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(lengths, pa.int64()), pa.array(known_n, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(inside, pa.float64()), pa.array(coded, pa.binary()), rare],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "inside", "classes", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, inside double, classes binary, "
             "rare array<struct<word binary, n long>>"), "encoded")


@dataclass
class Model:
    """First state, next state, and class by state."""

    first: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # classes x states


@dataclass
class Layout:
    """Sequences side by side: all first classes, then all second ones; the longest sequences come first."""

    codes: np.ndarray
    starts: np.ndarray  # where each time begins
    alive: np.ndarray  # sequences that reach each time
    owner: np.ndarray

    @staticmethod
    def of(rows: list[np.ndarray]) -> Layout:
        lengths = np.array([len(r) for r in rows])
        alive = len(rows) - np.cumsum(np.bincount(lengths, minlength=lengths[0] + 1))[:lengths[0]]
        starts = np.concatenate([[0], np.cumsum(alive)])
        owner = np.repeat(np.arange(len(rows)), lengths)
        time = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = starts[time] + owner
        codes, owners = np.empty(len(at), dtype=np.int64), np.empty(len(at), dtype=np.int64)
        codes[at], owners[at] = np.concatenate(rows), owner
        return Layout(codes, starts, alive, owners)


def side_by_side(rows: list[np.ndarray]) -> Iterator[tuple[list[int], Layout]]:
    """Row numbers with their layout, similar lengths together, about ``SIDE_BY_SIDE`` tokens each."""
    order, held, tokens = sorted(range(len(rows)), key=lambda i: -len(rows[i])), [], 0
    for i in order:
        held.append(i)
        tokens += len(rows[i])
        if tokens >= SIDE_BY_SIDE:
            yield held, Layout.of([rows[k] for k in held])
            held, tokens = [], 0
    if held:
        yield held, Layout.of([rows[k] for k in held])


def forward(model: Model, lay: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled chances of the states, the scales, and the emissions, a column for each place of the layout."""
    emitted = np.take(model.emit.T, lay.codes, axis=1)
    chance, scale, before, step = np.empty_like(emitted), np.empty(len(lay.codes)), None, model.step.T
    for at, n in zip(lay.starts.tolist(), lay.alive.tolist()):
        now, total = chance[:, at:at + n], scale[at:at + n]
        np.multiply(model.first[:, None] if before is None else step @ before[:, :n], emitted[:, at:at + n], out=now)
        np.add.reduce(now, axis=0, out=total)
        now /= total
        before = now
    return chance, scale, emitted


def log10_chances(model: Model, rows: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each sequence by the scaled forward recursion."""
    out = np.zeros(len(rows))
    for held, lay in side_by_side(rows):
        scale = forward(model, lay)[1]
        out[held] = np.bincount(lay.owner, weights=np.log10(scale), minlength=len(held))
    return out


class Expected:
    """Expected counts of starts, steps and emissions, added up over sequences."""

    def __init__(self, model: Model):
        self.model, self.log10 = model, 0.0
        self.first, self.step, self.emit = np.zeros_like(model.first), np.zeros_like(model.step), np.zeros_like(model.emit)

    def add(self, rows: list[np.ndarray]) -> None:
        for _, lay in side_by_side(rows):
            self._add(lay)

    def _add(self, lay: Layout) -> None:
        model = self.model
        chance, scale, emitted = forward(model, lay)
        emitted /= scale
        # backward, in place: each place's emissions get the factor of what comes after it
        spans = list(zip(lay.starts.tolist(), lay.alive.tolist()))
        for (earlier, _), (at, n) in zip(spans[-2::-1], spans[:0:-1]):
            emitted[:, earlier:earlier + n] *= model.step @ emitted[:, at:at + n]
        # then the chances of steps and states, from those of the place before
        steps, begun = np.zeros_like(model.step), int(lay.alive[0])
        place_before = np.arange(begun, len(scale)) - np.repeat(lay.alive[:-1], lay.alive[1:])
        for at in range(0, len(place_before), BLOCK):
            before = np.take(chance, place_before[at:at + BLOCK], axis=1)
            now = emitted[:, begun + at:begun + at + BLOCK]
            steps += before @ now.T
            now *= model.step.T @ before
        emitted[:, :begun] *= model.first[:, None]
        self.step += model.step * steps
        self.first += emitted[:, :begun].sum(axis=1)
        for k, of_state in enumerate(emitted):
            self.emit[:, k] += np.bincount(lay.codes, weights=of_state, minlength=len(self.emit))
        self.log10 += float(np.log10(scale).sum())


def improved(found: Expected, share: np.ndarray) -> Model:
    """The next model: expected counts with a small prior."""
    first, step = found.first + 1.0, found.step + 1.0
    emit = found.emit + PRIOR * share[:, None]
    return Model(first / first.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def first_model(share: np.ndarray, states: int) -> Model:
    """States that differ at random in what they emit and rather stay than change."""
    tilt = np.random.default_rng(5).gamma(1.0, size=(len(share), states)) + 0.1
    emit = share[:, None] * tilt
    step = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


def expected(texts: DataFrame, model: Model) -> Expected:
    """One round over all rows (classes binary): sums by class on Spark, then one bounded table to the driver."""
    sent = texts.sparkSession.sparkContext.broadcast(model)
    states = len(model.first)
    columns = [f"m{k}" for k in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Expected(sent.value)
        for b in batches:
            found.add([np.frombuffer(v.as_py(), dtype=np.uint16) for v in b.column(0)])
        met = np.flatnonzero(found.emit.any(axis=1))
        # below zero: the first states, the likelihood, then the steps from each state
        rest = np.concatenate([found.first[None], np.full((1, states), found.log10 / states), found.step])
        keys = np.concatenate([met, -1 - np.arange(len(rest))])
        table = np.concatenate([found.emit[met], rest])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *[pa.array(table[:, k]) for k in range(states)]], names=["class", *columns])

    kind = ", ".join(["class long", *[f"{c} double" for c in columns]])
    sums = texts.select("classes").mapInArrow(run, kind).groupBy("class").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    sent.destroy()
    out = Expected(model)
    keys = sums.column("class").to_numpy()
    table = np.stack([sums.column(c).to_numpy() for c in columns], axis=1)
    out.emit[keys[keys >= 0]] = table[keys >= 0]
    rest = np.zeros((2 + states, states))
    rest[-1 - keys[keys < 0]] = table[keys < 0]
    out.first, out.log10, out.step = rest[0], float(rest[1].sum()), rest[2:]
    return out


def trained(texts: DataFrame, share: np.ndarray, states: int = STATES, start_rows: int = START_ROWS,
            start_rounds: int = START_ROUNDS, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all rows of ``texts`` (doc_id, classes), a stored table.

    The rounds of the start take turns on disjoint shares of the rows, each of ``start_rows`` rows or more on average,
    at most one share a round: every row counts in the start, and the start as a whole reads the rows about once.
    """
    total, model = texts.count(), first_model(share, states)
    if not total:
        return model
    shares = max(1, min(start_rounds, total // max(1, start_rows)))
    place = F.pmod(F.xxhash64("doc_id", F.crc32("classes")), F.lit(shares))
    # every task gives a table of classes, so a share has tasks by its size
    tasks = max(START_TASKS, -(-texts.rdd.getNumPartitions() // shares)) if shares > 1 else None
    for i in range(start_rounds):
        part = texts.filter(place == i % shares)
        model = improved(expected(part.coalesce(tasks) if tasks else part, model), share)
    for _ in range(rounds):
        model = improved(expected(texts, model), share)
    return model


def scores(docs: DataFrame, states: int = STATES, table: int = TABLE, own: int = OWN) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row (doc_id, text).

    Rows whose crc32 of the doc_id as text leaves 1 modulo 5 are held out; the others, those with a
    null doc_id among them, train counts and model. Null and empty texts have the end as their one
    token. Texts of any length are scored whole. ``base_score`` is the smoothed unigram, ``score``
    the hidden Markov model, both log10. Repeated rows stay, each counted. Without training rows all
    words are unknown and the model is its random start. Other columns are not read.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    given = docs.select("doc_id", held_out.alias("held_out"), text_or_empty("text").cast("binary").alias("text"))
    counts = word_counts(given.filter(~F.col("held_out")).select("text"))
    known = classes(counts, table, own)
    coded = encoded(given, known)
    model = trained(coded.filter(~F.col("held_out")).select("doc_id", "classes"), known.class_share, states)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [np.frombuffer(v.as_py(), dtype=np.uint16) for v in b.column(7)]
            chances = pa.array(log10_chances(sent.value, rows), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns[:7], chances], names=[*b.schema.names[:7], "chance"])

    kind = coded.schema["doc_id"].dataType.simpleString()
    forwards = coded.drop("rare").mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, inside double, chance double")
    tail = coded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").join(counts, "word", "left")
    logs = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    rare = tail.groupBy("row").agg(F.sum(logs).alias("logs"), F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("met")).withColumnRenamed("row", "_row")
    out = forwards.join(rare, F.col("row") == F.col("_row"), "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(math.log10(known.base_mass))).alias("base_score"),
        (F.col("chance") + F.col("inside") + logs).alias("score"))
