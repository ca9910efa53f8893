"""Elastic-net logits for a whole grid of settings and folds in shared steps.

All (setting, fold) models take a Newton step together: one pass over the stored rows gives the
loss, the gradient and the curvature of every model that is not done, summed on Spark, and the
small penalised quadratic problems are solved between the passes. Each model is standardised with
the mean and deviation of its own training rows; this is a change of basis of the sums, so the
rows are read as they are. A model is done when no sub-gradient is off by more than the tolerance.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.rates import class_measures
from tallyloom.session import stage

#: Rows of a task, rows worked on at a time, and numbers summed up in one piece.
TASK_ROWS, BATCH_ROWS, PIECE = 20_000, 1024, 65_536
TOLERANCE, PASSES, SWEEPS = 1e-6, 80, 400
#: The farthest one step moves a coefficient of standardised features.
LONGEST_STEP = 8.0


@dataclass
class Rows:
    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray

    @staticmethod
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(start, BATCH_ROWS)
                y, fold = (b.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (1, 2))
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                yield Rows(x, y, fold)


def summed(rows: DataFrame, of: Callable[[Iterator[Rows]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of what ``of`` gives for a task's rows: ``size`` numbers, added up in pieces on Spark."""
    pieces = -(-size // PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = of(Rows.read(batches))
        cut = [found[k * PIECE:(k + 1) * PIECE].tobytes() for k in range(pieces)]
        yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array(cut, pa.binary())], names=["piece", "numbers"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for piece, numbers in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(numbers.as_buffer(), dtype=np.float64)
                totals[piece] = totals[piece] + part if piece in totals else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["piece", "numbers"])

    kind = "piece int, numbers binary"
    parts = rows.select("features", "label", "fold").mapInArrow(run, kind).repartition(pieces, "piece").mapInArrow(added, kind).collect()
    out = np.zeros(size)
    for r in parts:
        numbers = np.frombuffer(r["numbers"], dtype=np.float64)
        out[r["piece"] * PIECE:r["piece"] * PIECE + len(numbers)] = numbers
    return out


def stored(folded: DataFrame) -> DataFrame:
    """(features array<double>, label double, fold int), written in tasks of about ``TASK_ROWS`` rows."""
    tasks = max(1, math.ceil(folded.count() / TASK_ROWS))
    return stage(folded.select(
        F.col("features").cast("array<double>").alias("features"), F.col("label").cast("double").alias("label"),
        F.col("fold").cast("int").alias("fold")).repartition(tasks), "elastic")


@dataclass
class Basis:
    """Mean and deviation of all rows, and for each fold the change to its own standardised features (intercept first)."""

    mean: np.ndarray
    deviation: np.ndarray
    n: np.ndarray
    ones: np.ndarray
    change: np.ndarray  # fold x (d + 1) x (d + 1): standardised = change @ (1, x)

    def wide(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones((len(x), 1)), (x - self.mean) / self.deviation], axis=1)


def basis(rows: DataFrame, folds: int) -> Basis:
    width = rows.select(F.max(F.size("features"))).first()[0]

    def sums(parts: Iterator[Rows]) -> np.ndarray:
        out = np.zeros(1 + width)
        for r in parts:
            out += np.concatenate([[len(r.x)], r.x.sum(axis=0)])
        return out

    total = summed(rows, sums, 1 + width)
    mean = total[1:] / total[0]

    def moments(parts: Iterator[Rows]) -> np.ndarray:
        out = np.zeros((folds + 1, 2 + 2 * width))
        for r in parts:
            away = r.x - mean
            each = np.concatenate([np.ones((len(away), 1)), r.y[:, None], away, away**2], axis=1)
            np.add.at(out, np.where(r.fold < 0, folds, r.fold).astype(int), each)
        return out.ravel()

    by_fold = summed(rows, moments, (folds + 1) * (2 + 2 * width)).reshape(folds + 1, -1)
    whole = by_fold.sum(axis=0)
    deviation = np.sqrt(np.maximum(whole[2 + width:] / whole[0], 0.0))
    deviation[deviation == 0] = 1.0
    train = whole - by_fold[:folds]
    n = train[:, 0]
    away = train[:, 2:2 + width] / n[:, None] / deviation
    spread = np.sqrt(np.maximum(train[:, 2 + width:] / n[:, None] / deviation**2 - away**2, 0.0))
    spread[spread < 1e-9] = 1.0  # a constant feature stays a constant
    change = np.zeros((folds, width + 1, width + 1))
    change[:, 0, 0] = 1.0
    at = np.arange(1, width + 1)
    change[:, at, at] = 1 / spread
    change[:, at, 0] = -away / spread
    return Basis(mean, deviation, n, train[:, 1], change)


@dataclass
class Fits:
    """One row per model, all settings of fold 0 first: coefficients (intercept first) and how far from optimal."""

    basis: Basis
    settings: list[tuple[float, float]]
    fold: np.ndarray
    theta: np.ndarray  # for standardised features
    gap: np.ndarray  # largest sub-gradient per training row
    passes: int

    @property
    def plain(self) -> np.ndarray:
        """Coefficients for (1, (x - mean) / deviation)."""
        return np.einsum("mji,mj->mi", self.basis.change[self.fold], self.theta)

    def raw(self, model: int) -> tuple[float, np.ndarray]:
        """Intercept and slopes of one model for features as they are."""
        slopes = self.plain[model, 1:] / self.basis.deviation
        return float(self.plain[model, 0] - slopes @ self.basis.mean), slopes


def optimality(theta: np.ndarray, gradient: np.ndarray, lasso: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """Per model the largest distance of a sub-gradient from zero."""
    w, g = theta[:, 1:], gradient[:, 1:] + ridge[:, None] * theta[:, 1:]
    off = np.where(w != 0, np.abs(g + lasso[:, None] * np.sign(w)), np.maximum(np.abs(g) - lasso[:, None], 0.0))
    return np.maximum(np.abs(gradient[:, 0]), off.max(axis=1, initial=0.0))


def quadratic(theta: np.ndarray, g: np.ndarray, h: np.ndarray, lasso: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """Minimum of each model's quadratic with its penalty: solved at once without lasso, else coordinate by coordinate."""
    width = theta.shape[1]
    h = h + 1e-9 * np.trace(h, axis1=1, axis2=2)[:, None, None] / width * np.eye(width)
    full = h + ridge[:, None, None] * np.diag([0.0] + [1.0] * (width - 1))
    new = theta.copy()
    smooth = lasso == 0
    if smooth.any():
        pull = g[smooth] + np.concatenate([np.zeros((smooth.sum(), 1)), ridge[smooth, None] * theta[smooth, 1:]], axis=1)
        new[smooth] = theta[smooth] - np.linalg.solve(full[smooth], pull[:, :, None])[:, :, 0]
    open_ = np.flatnonzero(~smooth)
    slope = g.copy()  # of the quadratic at ``new``, without penalties
    for _ in range(SWEEPS):
        if not len(open_):
            break
        h_open, s, w, l1, l2 = h[open_], slope[open_], new[open_], lasso[open_], ridge[open_]
        moved = np.zeros(len(open_))
        for j in range(width):
            curve = h_open[:, j, j]
            raw = curve * w[:, j] - s[:, j]
            target = raw / curve if j == 0 else np.sign(raw) * np.maximum(np.abs(raw) - l1, 0.0) / (curve + l2)
            step = target - w[:, j]
            s += h_open[:, :, j] * step[:, None]
            w[:, j] = target
            moved = np.maximum(moved, np.abs(step))
        slope[open_], new[open_] = s, w
        open_ = open_[moved > 1e-10]
    step = new - theta
    return theta + step * np.minimum(1.0, LONGEST_STEP / np.maximum(np.abs(step).max(axis=1), 1e-300))[:, None]


def fit(rows: DataFrame, settings: list[tuple[float, float]], folds: int, tolerance: float = TOLERANCE, passes: int = PASSES) -> Fits:
    """Fit every setting (inverse strength C, lasso share) on every fold's training rows, the rows of other folds.

    ``rows`` are (features, label 0/1, fold) as ``stored`` writes them; a fold below zero trains all
    models. The loss is the sum over rows plus (share |w| + (1 - share) w^2 / 2) / C, the intercept free.
    A fold whose training rows have one label only predicts that label. A step that makes a model
    worse is halved until it does not.
    """
    base = basis(rows, folds)
    width = base.change.shape[1]
    fold = np.repeat(np.arange(folds), len(settings))
    lasso = np.tile([share / c for c, share in settings], folds)
    ridge = np.tile([(1 - share) / c for c, share in settings], folds)
    theta = np.zeros((len(fold), width))
    share = np.clip(base.ones / np.maximum(base.n, 1), 1e-12, 1 - 1e-12)
    theta[:, 0] = np.log(share / (1 - share))[fold]
    fits = Fits(base, settings, fold, theta, np.full(len(fold), np.inf), 0)
    one_label = (base.ones == 0) | (base.ones == base.n)
    fits.gap[one_label[fold]] = 0.0
    trial, held, worth = theta.copy(), theta.copy(), np.full(len(fold), np.inf)
    i, j = np.triu_indices(width)
    for _ in range(passes):
        open_ = np.flatnonzero(fits.gap > tolerance)
        if not len(open_):
            break
        fits.passes += 1
        plain, own = np.einsum("mji,mj->im", base.change[fold[open_]], trial[open_]), fold[open_]

        def sums(parts: Iterator[Rows]) -> np.ndarray:
            loss, g, h = np.zeros(len(own)), np.zeros((width, len(own))), np.zeros((len(i), len(own)))
            for r in parts:
                x = base.wide(r.x)
                z = x @ plain
                trains = r.fold[:, None] != own
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                loss += ((np.logaddexp(0, z) - r.y[:, None] * z) * trains).sum(axis=0)
                g += x.T @ ((p - r.y[:, None]) * trains)
                h += (x[:, i] * x[:, j]).T @ (p * (1 - p) * trains)
            return np.concatenate([loss, g.ravel(), h.ravel()])

        m = len(own)
        found = summed(rows, sums, m * (1 + width + len(i)))
        loss, g_plain = found[:m], found[m:m * (1 + width)].reshape(width, m).T
        h_plain = np.zeros((m, width, width))
        h_plain[:, i, j] = h_plain[:, j, i] = found[m * (1 + width):].reshape(len(i), m).T
        t = trial[open_]
        value = loss + lasso[open_] * np.abs(t[:, 1:]).sum(axis=1) + ridge[open_] / 2 * (t[:, 1:] ** 2).sum(axis=1)
        better = value <= worth[open_] + 1e-9 * np.abs(value)
        change = base.change[own]
        g = np.einsum("mij,mj->mi", change, g_plain)
        h = change @ h_plain @ change.transpose(0, 2, 1)
        took = open_[better]
        held[took], worth[took] = trial[took], value[better]
        fits.gap[took] = optimality(t[better], g[better], lasso[took], ridge[took]) / base.n[fold[took]]
        trial[took] = quadratic(t[better], g[better], h[better], lasso[took], ridge[took])
        back = open_[~better]
        trial[back] = (held[back] + trial[back]) / 2
    fits.theta = held
    return fits


def confusion(rows: DataFrame, fits: Fits) -> np.ndarray:
    """Model x label x prediction: validation rows of each model's own fold."""
    plain, own, base = fits.plain.T, fits.fold, fits.basis

    def counts(parts: Iterator[Rows]) -> np.ndarray:
        out = np.zeros((len(own), 2, 2))
        for r in parts:
            mine = r.fold[:, None] == own
            guess = base.wide(r.x) @ plain > 0
            for label in (0, 1):
                for says in (0, 1):
                    out[:, label, says] += ((r.y[:, None] == label) & (guess == says) & mine).sum(axis=0)
        return out.ravel()

    return summed(rows, counts, 4 * len(own)).reshape(len(own), 2, 2)


def grid_scores(folded: DataFrame, settings: list[tuple[float, float]], folds: int, tolerance: float = TOLERANCE) -> DataFrame:
    """(config, accuracy, precision, recall, f1, gap, models_done): means over the folds, one row per setting.

    ``folded`` has features (array of doubles without nulls, the same length in every row), label
    (0 or 1) and fold. ``gap`` is the worst distance from optimality of the setting's models, per
    training row. An empty table gives no rows.
    """
    spark, rows = folded.sparkSession, stored(folded)
    kind = "config int, fold int, label double, prediction double, n double"
    done = "config int, gap double, models_done long"
    if rows.isEmpty():
        cells, quality = spark.createDataFrame([], kind), spark.createDataFrame([], done)
    else:
        fits = fit(rows, settings, folds, tolerance)
        table, k = confusion(rows, fits), len(settings)
        cells = spark.createDataFrame(
            [(m % k, m // k, float(a), float(b), float(table[m, a, b])) for m in range(len(table)) for a in (0, 1) for b in (0, 1) if table[m, a, b]], kind)
        gaps = fits.gap.reshape(folds, k)
        quality = spark.createDataFrame([(c, float(gaps[:, c].max()), int((gaps[:, c] <= tolerance).sum())) for c in range(k)], done)
    per_fold = class_measures(cells, "label", "prediction", ["config", "fold"], F.col("n"))
    means = per_fold.groupBy("config").agg(*[F.avg(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])
    return means.join(quality, "config")
