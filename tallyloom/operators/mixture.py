"""Gaussian mixtures by EM: densities are column expressions, each step of a fit one aggregation.

All restarts share the step's job. Only sums of size K x d x d reach the driver. Fits are
accelerated by squared extrapolation of the EM map (SQUAREM, Varadhan and Roland 2008).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Mixture:
    mu: np.ndarray  # K x d
    sigma: np.ndarray  # K x d x d
    pi: np.ndarray  # K

    def __post_init__(self):
        self.mu, self.sigma = np.asarray(self.mu, float), np.asarray(self.sigma, float)
        pi = np.asarray(self.pi, float)
        if len(pi) + 1 == len(self.mu):  # the last weight may be left out
            pi = np.append(pi, 1 - pi.sum())
        if len(pi) > len(self.mu):
            raise ValueError("more weights than segments")
        self.pi = pi / pi.sum()

    @property
    def size(self) -> int:
        return len(self.pi)

    @property
    def singular(self) -> bool:
        return any(np.linalg.det(s) <= 1e-12 for s in self.sigma) or not np.isfinite(self.mu).all()

    def parameters(self) -> int:
        k, d = self.mu.shape
        return k * d + k * d * (d + 1) // 2 + k - 1

    def first(self, index: int) -> Mixture:
        """Marginal of the first ``index`` columns."""
        return Mixture(self.mu[:, :index], self.sigma[:, :index, :index], self.pi)


def _packed(m: Mixture) -> list[float]:
    """Per segment: constant of the log density, mean, inverse covariance."""
    out: list[float] = []
    d = m.mu.shape[1]
    for mu, sigma, pi in zip(m.mu, m.sigma, m.pi):
        constant = math.log(max(pi, 1e-300)) - 0.5 * (d * math.log(2 * math.pi) + math.log(np.linalg.det(sigma)))
        out += [constant, *map(float, mu), *map(float, np.linalg.inv(sigma).ravel())]
    return out


def _shares(xs: list[str], k: int, value):
    """The step that adds responsibilities ``w_i`` and row log-likelihood ``ll``.

    ``value(i)`` is a packed number. Columns are built once and serve every step of a fit.
    """
    d = len(xs)
    width = 1 + d + d * d
    logs = {}
    for i in range(k):
        at = i * width
        gap = [F.col(x) - value(at + 1 + a) for a, x in enumerate(xs)]
        form = sum((value(at + 1 + d + a * d + b) * gap[a] * gap[b] for a in range(d) for b in range(d)), F.lit(0.0))
        logs[f"_l{i}"] = value(at) - F.lit(0.5) * form
    top = F.greatest(*logs) if k > 1 else F.col("_l0")
    total = F.col("_t") + F.log(sum((F.exp(F.col(c) - F.col("_t")) for c in logs), F.lit(0.0)))
    weights = {f"w_{i}": F.exp(F.col(f"_l{i}") - F.col("ll")) for i in range(k)}

    def add(df: DataFrame) -> DataFrame:
        return (
            df.withColumns(logs).withColumn("_t", top).withColumn("ll", total).withColumns(weights).drop(*logs, "_t")
        )

    return add


def with_shares(df: DataFrame, xs: list[str], m: Mixture) -> DataFrame:
    """Add responsibilities ``w_k`` and the row's log-likelihood ``ll``."""
    numbers = _packed(m)
    return df.transform(_shares(xs, m.size, lambda i: F.lit(numbers[i])))


def log_likelihood(df: DataFrame, xs: list[str], m: Mixture) -> DataFrame:
    """Sum over rows; a singular covariance gives minus infinity."""
    if m.singular:
        return df.agg(F.lit(float("-inf")).alias("loglik"))
    return with_shares(df, xs, m).agg(F.sum("ll").alias("loglik"))


def bic(df: DataFrame, xs: list[str], m: Mixture) -> DataFrame:
    """parameters x log n - 2 log-likelihood; a covariance has d(d+1)/2 parameters."""
    return with_shares(df, xs, m).agg(
        F.sum("ll").alias("loglik"),
        (F.lit(float(m.parameters())) * F.log(F.count(F.lit(1))) - 2 * F.sum("ll")).alias("bic"))


def _sums(x: np.ndarray, m: Mixture) -> np.ndarray:
    """Rows, log-likelihood, and per segment: weight, weighted gaps to the mean and their products."""
    gap = x[:, None, :] - m.mu
    d = x.shape[1]
    constant = np.log(np.maximum(m.pi, 1e-300)) - 0.5 * (d * math.log(2 * math.pi) + np.log(np.linalg.det(m.sigma)))
    logs = constant - 0.5 * np.einsum("nka,kab,nkb->nk", gap, np.linalg.inv(m.sigma), gap)
    top = logs.max(axis=1, keepdims=True)
    w = np.exp(logs - top)
    total = w.sum(axis=1, keepdims=True)
    w /= total
    weighted = w[:, :, None] * gap
    second = np.einsum("nka,nkb->kab", weighted, gap)
    parts = np.concatenate([w.sum(axis=0)[:, None], weighted.sum(axis=0), second.reshape(m.size, d * d)], axis=1)
    return np.concatenate([[len(x), float((top + np.log(total)).sum())], parts.ravel()])


def _updated(sums: np.ndarray, m: Mixture) -> Mixture:
    """New means, covariances (around the new means) and shares."""
    d = m.mu.shape[1]
    mu, sigma, pi = m.mu.copy(), m.sigma.copy(), np.zeros(m.size)
    for i, part in enumerate(sums[2:].reshape(m.size, 1 + d + d * d)):
        pi[i] = part[0] / sums[0]
        if part[0] <= 0:
            continue
        shift = part[1:1 + d] / part[0]
        mu[i] = m.mu[i] + shift
        sigma[i] = part[1 + d:].reshape(d, d) / part[0] - np.outer(shift, shift)
    return Mixture(mu, sigma, pi)


def stepper(xs: list[str]):
    """A function that makes one E and M step for several models of any sizes in one job.

    It returns, for each model, its log-likelihood and the moved model. A task adds up its
    batches with numpy and hands on one array per model; the arrays are summed by model.
    """
    def step(data: DataFrame, models: dict[int, Mixture]) -> dict[int, tuple[float, Mixture]]:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[int, np.ndarray] = {}
            for batch in batches:
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                for i, m in models.items() if len(x) else ():
                    totals[i] = totals.get(i, 0.0) + _sums(x, m)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array([t.tolist() for t in totals.values()], pa.list_(pa.float64()))],
                names=["start", "sums"])

        numbers = data.select(*[F.col(x).cast("double") for x in xs]).dropna()
        width = max(2 + m.size * (1 + len(xs) + len(xs) ** 2) for m in models.values())
        added = numbers.mapInArrow(sums, "start int, sums array<double>").groupBy("start").agg(
            *[F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(width)])
        out = {}
        for row in added.collect():  # one row per model
            m = models[row["start"]]
            found = np.array([v for v in row[1:] if v is not None], dtype=float)
            out[row["start"]] = (float(found[1]), _updated(found, m))
        return out

    return step


def _starts(df: DataFrame, id: str, xs: list[str], sizes: list[int], restarts: int, seed: int) -> list[tuple[int, Mixture]]:
    """(k, start): k data rows as means (smallest hashes of the id), unit covariances, Dirichlet weights.

    The rows of all starts come from one job that keeps the few least hashes of each partition.
    """
    most, every = max(sizes), None
    for r in range(restarts):
        place = F.xxhash64(F.lit(seed), F.lit(r), id)
        drawn = df.orderBy(place, id).limit(most).select(F.lit(r).alias("_r"), place.alias("_h"), id, *xs)
        every = drawn if every is None else every.unionAll(drawn)
    rows: dict[int, list] = {}
    for row in every.collect():  # restarts x most rows
        rows.setdefault(row["_r"], []).append((row["_h"], row[id], [row[x] for x in xs]))
    out = []
    for k in sizes:
        for r, drawn in sorted(rows.items()):
            weights = np.random.default_rng([seed, r]).dirichlet(np.ones(k))
            means = [x for *_, x in sorted(drawn, key=lambda d: d[:2])[:k]]
            out.append((k, Mixture(means, [np.eye(len(xs))] * k, weights)))
    return out


def _free(m: Mixture) -> np.ndarray:
    """The model as numbers without bounds: log weights, means, Cholesky factors with the log of their diagonals."""
    roots = np.linalg.cholesky(m.sigma)
    diagonal = np.arange(m.mu.shape[1])
    roots[:, diagonal, diagonal] = np.log(roots[:, diagonal, diagonal])
    return np.concatenate([np.log(np.maximum(m.pi, 1e-300)), m.mu.ravel(), roots.ravel()])


def _bound(numbers: np.ndarray, k: int, d: int) -> Mixture:
    """The model that ``_free`` gives these numbers for."""
    weights, mu, roots = numbers[:k], numbers[k:k + k * d].reshape(k, d), numbers[k + k * d:].reshape(k, d, d).copy()
    diagonal = np.arange(d)
    roots[:, diagonal, diagonal] = np.exp(roots[:, diagonal, diagonal])
    return Mixture(mu, roots @ roots.transpose(0, 2, 1), np.exp(weights - weights.max()))


def extrapolated(first: Mixture, second: Mixture, third: Mixture, longest: float) -> tuple[Mixture | None, float]:
    """The model that three successive steps of EM point to, and the step length used, from 1 to ``longest``.

    At length 1 that is the third model itself. None where a step has no finite extrapolation
    or leads to a singular covariance.
    """
    try:
        a, b, c = _free(first), _free(second), _free(third)
    except np.linalg.LinAlgError:
        return None, 1.0
    speed, turn = b - a, c - 2 * b + a
    length = float(np.linalg.norm(speed) / max(np.linalg.norm(turn), 1e-300))
    length = min(max(length, 1.0), longest)
    with np.errstate(over="ignore", invalid="ignore"):
        numbers = a + 2 * length * speed + length * length * turn
        if length == 1.0 or not np.isfinite(numbers).all():
            return None, length
        there = _bound(numbers, *first.mu.shape)
        fine = np.isfinite(there.sigma).all() and not there.singular
    return (there if fine else None), length


@dataclass
class Fit:
    model: Mixture
    value: float
    paths: list[list[float]]  # log-likelihood by step, per start
    converged: bool


@dataclass
class _Climb:
    """One start on its way: what the next step tries, and the models before it in this cycle."""

    tries: list[Mixture]  # the plain next model, then the extrapolated one
    trail: list[Mixture]
    longest: float = 4.0
    length: float = 1.0

    def taken(self, which: int, after: Mixture, accelerated: bool) -> None:
        """Go on from the model tried as ``which``, which EM moves to ``after``."""
        if len(self.tries) == 2 and which == 1 and self.length == self.longest:
            self.longest *= 4
        here = self.tries[which]
        self.tries = [after]
        if not self.trail:
            self.trail = [here]
        else:
            if accelerated:
                jump, self.length = extrapolated(self.trail[0], here, after, self.longest)
                self.tries += [jump] if jump is not None else []
            self.trail = []


def fit_sizes(
    df: DataFrame, id: str, xs: list[str], sizes: list[int], restarts: int = 10, tolerance: float = 1e-4,
    seed: int = 0, relative: bool = True, limit: int | None = None, accelerated: bool = True,
    starts: list[Mixture] | None = None,
) -> dict[int, Fit]:
    """Best of several starts for every number of segments; all starts of all sizes share one job per step.

    After every second step of EM the model that the last three point to is tried beside the
    plain next one, in the same job, and the likelier of the two goes on: a step never gains
    less than EM does and the likelihood never falls. A start ends at a small simple or relative
    gain of the likelihood, or in a singular covariance. With a ``limit`` of steps a fit may end
    before; its ``converged`` is false then. ``starts`` are used instead of drawn ones.
    """
    data = df.select(id, *xs).persist()
    step = stepper(xs)
    try:
        begun = [(m.size, m) for m in starts] if starts else _starts(data, id, xs, sizes, restarts, seed)
        of = {i: k for i, (k, _) in enumerate(begun)}
        climbs = {i: _Climb([m], []) for i, (_, m) in enumerate(begun)}
        paths: dict[int, list[float]] = {i: [] for i in climbs}
        best: dict[int, tuple[float, int, Mixture]] = {}
        ended: set[int] = set()
        while climbs and (limit is None or max(map(len, paths.values())) < limit):
            climbs = {i: c for i, c in climbs.items() if not c.tries[0].singular}
            tried = {2 * i + j: m for i, c in climbs.items() for j, m in enumerate(c.tries)}
            moved = step(data, tried) if tried else {}
            for i, climb in list(climbs.items()):
                found = [(moved[2 * i + j], j) for j in range(len(climb.tries)) if 2 * i + j in moved]
                found = [((value, after), j) for (value, after), j in found if np.isfinite(value)]
                if not found:
                    del climbs[i]
                    continue
                (value, after), which = max(found, key=lambda f: f[0][0])
                gain = math.inf
                if paths[i]:
                    gain = value - paths[i][-1]
                    if relative:
                        gain = abs(gain / paths[i][-1])
                paths[i].append(value)
                if of[i] not in best or value > best[of[i]][0]:
                    best[of[i]] = (value, i, climb.tries[which])
                if gain > tolerance:
                    climb.taken(which, after, accelerated)
                else:
                    ended.add(i)
                    del climbs[i]
        if missing := [k for k in sizes if k not in best]:
            raise ValueError(f"every start ended in a singular covariance for {missing} segments")
        return {k: Fit(m, value, [paths[j] for j in of if of[j] == k], i in ended) for k, (value, i, m) in best.items()}
    finally:
        data.unpersist()


def fit_em(df: DataFrame, id: str, xs: list[str], k: int, **options) -> tuple[Mixture, float, list[list[float]]]:
    """The model, its log-likelihood and the likelihood path of every start, for ``k`` segments."""
    fit = fit_sizes(df, id, xs, [k], **options)[k]
    return fit.model, fit.value, fit.paths


def conditional_mean(df: DataFrame, xs: list[str], m: Mixture, index: int = 1) -> DataFrame:
    """Expected later columns given the first ``index`` ones, mixed by their responsibilities."""
    given, wanted = xs[:index], xs[index:]
    kept = df.columns
    shared = with_shares(df, given, m.first(index))
    made = {}
    for j, x in enumerate(wanted):
        total = F.lit(0.0)
        for i in range(m.size):
            slope = m.sigma[i][index:, :index] @ np.linalg.inv(m.sigma[i][:index, :index])
            value = F.lit(float(m.mu[i][index + j]))
            for a, g in enumerate(given):
                value = value + F.lit(float(slope[j, a])) * (F.col(g) - F.lit(float(m.mu[i][a])))
            total = total + F.col(f"w_{i}") * value
        made[f"{x}_given"] = total
    return shared.withColumns(made).select(*kept, *made)
