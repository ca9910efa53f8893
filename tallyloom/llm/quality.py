"""Quality rules: document statistics judged by gradient-boosted trees with monotonic constraints.

The trees are grown on a bounded sample of labelled rows; every document's statistics come from
its whole text. For scoring, all trees lie in five flat arrays, and one step moves a whole batch
of rows one level down all trees.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import WORD, sample_ids

#: Most labelled rows that the trees are grown on.
SAMPLE_ROWS = 20_000
#: Documents below this estimated chance of good quality go.
KEEP_AT = 0.5
BLANKS = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
_WORD = re.compile(WORD)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features, and the sign that the chance of good quality must have in each (0: free).
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols_per_word": -1, "bars_per_word": -1, "exclamations_per_word": -1,
    "capitals_share": -1, "dup_line_share": -1, "repeat_share": -1, "distinct_share": 0, "digits_share": 0,
    "words_per_line": 0, "stops_per_word": 0,
}


def repeated_words(words: list[str]) -> int:
    """Words in three-word windows that occur at least twice in the text, the first included."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    often = {g for g, n in Counter(grams).items() if n > 1}
    inside = bytearray(len(words))
    for i, g in enumerate(grams):
        if g in often:
            inside[i:i + 3] = b"\1\1\1"
    return sum(inside)


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(base counts, features) of a whole text; null: empty."""
    text = text or ""
    words = _WORD.findall(text)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    n, chars = len(words), sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    dup_lines, repeats = len(lines) - len(set(lines)), repeated_words(words)
    per_word, per_line = max(n, 1), max(len(lines), 1)
    features = [
        float(np.log1p(n)), chars / per_word, symbols / per_word, text.count("|") / per_word, text.count("!") / per_word,
        sum(map(str.isupper, words)) / per_word, dup_lines / per_line, repeats / per_word, len(set(words)) / per_word,
        sum(map(text.count, "0123456789")) / max(chars, 1), n / per_line, text.count(".") / per_word,
    ]
    return [n, chars, symbols, dup_lines, repeats], features


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])


@dataclass
class Trees:
    """Flat nodes of all trees; a leaf points at itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Chance of label 1 per row."""
        total = np.full(len(rows), self.bias)
        for start in range(0, len(rows), 8192):
            part = rows[start:start + 8192]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            own = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                at = np.where(part[own, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total[start:start + 8192] += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def grow(rows: np.ndarray, labels: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2,
         bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Logistic boosting on binned features.

    A split of a feature with a sign must put its two values in that order, and the middle of the
    two bounds everything below it on either side, so each tree, and the sum, is monotonic.
    """
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []
    positive = min(max(float(labels.mean()) if len(labels) else 0.5, 1e-6), 1 - 1e-6)
    bias = float(np.log(positive / (1 - positive)))
    cuts = [np.unique(np.quantile(rows[:, j], np.arange(1, bins) / bins)) for j in range(rows.shape[1])] if len(rows) else []
    binned = [np.searchsorted(c, rows[:, j], side="left") for j, c in enumerate(cuts)]
    score = np.full(len(rows), bias)

    def leaf(value: float) -> int:
        nodes.append([0, 0.0, len(nodes), len(nodes), value])
        return len(nodes) - 1

    def split(members: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = grad[members], hess[members]
        total_g, total_h = g.sum(), h.sum()
        here = float(np.clip(total_g / (total_h + ridge), low, high))
        best = (1e-6, None)
        for j, c in enumerate(cuts if level < depth and total_h >= 2 * least else []):
            if not len(c):
                continue
            of = binned[j][members]
            left_g = np.cumsum(np.bincount(of, g, len(c) + 1))[:-1]
            left_h = np.cumsum(np.bincount(of, h, len(c) + 1))[:-1]
            right_g, right_h = total_g - left_g, total_h - left_h
            a, b = (np.clip(x / (y + ridge), low, high) for x, y in ((left_g, left_h), (right_g, right_h)))
            gain = 2 * (a * left_g + b * right_g - here * total_g) - (
                a * a * (left_h + ridge) + b * b * (right_h + ridge) - here * here * (total_h + ridge))
            allowed = (left_h >= least) & (right_h >= least) & (signs[j] * (b - a) >= 0)
            k = int(np.argmax(np.where(allowed, gain, -np.inf)))
            if allowed[k] and gain[k] > best[0]:
                best = (gain[k], (j, k, a[k], b[k]))
        if best[1] is None:
            score[members] += rate * here
            return leaf(rate * here)
        j, k, a, b = best[1]
        middle, number = (a + b) / 2, len(nodes)
        nodes.append([j, float(cuts[j][k]), 0, 0, 0.0])
        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[signs[j]]
        goes_left = binned[j][members] <= k
        nodes[number][2] = split(members[goes_left], level + 1, *bounds[0])
        nodes[number][3] = split(members[~goes_left], level + 1, *bounds[1])
        return number

    if len(labels) and 0 < labels.sum() < len(labels):
        for _ in range(trees):
            chance = 1 / (1 + np.exp(-score))
            grad, hess = labels - chance, np.maximum(chance * (1 - chance), 1e-9)
            roots.append(split(np.arange(len(rows)), 0, -np.inf, np.inf))
    else:
        roots.append(leaf(0.0))
    table = list(zip(*nodes))
    return Trees(np.array(table[0]), np.array(table[1], dtype=float), np.array(table[2]), np.array(table[3]),
                 np.array(table[4], dtype=float), np.array(roots), depth, bias)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees:
    """Trees grown on at most ``rows`` documents with a label; null labels and ids do not count.

    A repeated id counts once, with its largest label and least statistics. Without both labels
    in the sample the trees are empty, and only the base rules speak.
    """
    known = labels.filter(F.col("quality").isNotNull())
    chosen = known.join(F.broadcast(sample_ids(known, "doc_id", rows)), "doc_id") \
        .groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").cast("double").alias("_label"))
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("_id", "_label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([statistics(t)[1] for t in b.column(2).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), found], names=["_id", "_label", "x"])

    kind = met.schema["_id"].dataType.simpleString()
    sample = met.mapInArrow(run, f"_id {kind}, _label double, x array<double>").groupBy("_id", "_label").agg(F.min("x").alias("x"))
    got = sample.orderBy("_id").toPandas()
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), len(FEATURES))
    return grow(x, got["_label"].to_numpy(dtype=float), list(FEATURES.values()))


def _judge(texts: list[str | None], trees: Trees, keep_at: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found = [statistics(t) for t in texts]
    base = np.array([f[0] for f in found], dtype=np.int64).reshape(len(found), len(BASE))
    failed = base_failed(base)
    score = trees.score(np.array([f[1] for f in found], dtype=float).reshape(len(found), len(FEATURES)))
    return base, failed, score, ~failed & (score >= keep_at)


def assess(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, keep_at: float = KEEP_AT) -> DataFrame:
    """(doc_id, base counts, base_failed, score, kept) of every row of documents.

    Null and empty texts have no words and fail the base rules. Repeated rows stay, each judged by
    its own text; a null doc_id is kept as it is. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, failed, score, kept = _judge(b.column(1).to_pylist(), shared.value, keep_at)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(base[:, j]) for j in range(len(BASE))], pa.array(failed), pa.array(score), pa.array(kept)],
                names=["doc_id", *BASE, "base_failed", "score", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {', '.join(f'{c} long' for c in BASE)}, base_failed boolean, score double, kept boolean")


def kept_documents(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of documents, all columns, that ``assess`` keeps; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_judge(b.column(at).to_pylist(), shared.value, keep_at)[3]))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
