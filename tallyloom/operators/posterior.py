"""Posterior draws of regressions per group, and summaries of draws.

Draws of one (group, param) are as many as the sampler was told to make, so windows and
exact quantiles over them are bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.scalar import ratio
from tallyloom.operators.leastsq import unpack

#: Numbers that the chains of one step through a batch hold at most.
MOST_NUMBERS = 4_000_000


def interval(draws: DataFrame, keys: list[str], value: str, alpha: float) -> DataFrame:
    """Quantiles alpha, one half and 1 - alpha of the draws per key."""
    return draws.groupBy(*keys).agg(
        F.percentile(value, F.lit(alpha)).alias("low"), F.percentile(value, F.lit(0.5)).alias("mid"),
        F.percentile(value, F.lit(1 - alpha)).alias("high"))


def order_statistic(draws: DataFrame, keys: list[str], value: str, p: float) -> DataFrame:
    """The value at rank round(p * n), halves to even."""
    w = Window.partitionBy(*keys)
    rank = F.row_number().over(w.orderBy(value))
    at = F.bround(F.count(F.lit(1)).over(w) * F.lit(p), 0).cast("int")
    return draws.select(*keys, value, rank.alias("_rank"), at.alias("_at")).filter(
        F.col("_rank") == F.col("_at")).drop("_rank", "_at")


def kept_draws(draws: DataFrame, burn_in: int, thin: int, iteration: str = "iter") -> DataFrame:
    """Drop the first ``burn_in`` draws and keep every ``thin``-th after them."""
    i = F.col(iteration)
    return draws.filter((i >= burn_in) & ((i - burn_in) % thin == 0))


def summary(draws: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Mean, deviation, median, 10 and 90 percent points and mean log of the draws."""
    return draws.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.median(value).alias("median"),
        F.percentile(value, F.lit(0.1)).alias("p10"), F.percentile(value, F.lit(0.9)).alias("p90"),
        F.avg(F.when(F.col(value) > 0, F.log(value))).alias("mean_log"))


def shortest_interval(draws: DataFrame, keys: list[str], value: str, p: float) -> DataFrame:
    """Shortest interval between order statistics i and n - outside + i, for i from 2 to outside.

    round((1 - p) n) draws lie outside; the first of equal widths is taken.
    """
    w = Window.partitionBy(*keys).orderBy(value)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    ranked = draws.select(
        *keys, F.col(value).alias("low"), F.row_number().over(w).alias("_rank"),
        F.bround(size * F.lit(1 - p), 0).cast("int").alias("_outside"), size.cast("int").alias("_n"))
    upper = ranked.select(*keys, F.col("low").alias("high"),
                          (F.col("_rank") - (F.col("_n") - F.col("_outside"))).alias("_rank"))
    widths = (
        ranked.filter((F.col("_rank") >= 2) & (F.col("_rank") <= F.col("_outside")) & (F.col("_outside") < F.col("_n") - 2))
        .join(upper, [*keys, "_rank"])
    )
    best = F.min(F.struct((F.col("high") - F.col("low")).alias("width"), "_rank", "low", "high"))
    return widths.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.low", "b.high")


def stationarity(draws: DataFrame, keys: list[str], iteration: str, value: str) -> DataFrame:
    """First tenth against last half: means, standard error and z."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(iteration))
    numbered = draws.select(*keys, value, rank.alias("_i"), size.alias("_n"))
    early = F.bround(F.col("_n") * 0.1, 0).cast("int")
    half = F.bround(F.col("_n") * 0.5, 0).cast("int")
    first = F.when(F.col("_i") <= early, F.col(value))
    second = F.when(F.col("_i") > half, F.col(value))
    return numbered.groupBy(*keys).agg(
        F.avg(first).alias("mean_first"), F.avg(second).alias("mean_second"),
        F.sqrt(ratio(F.var_pop(first), F.max(early)) + ratio(F.var_pop(second), F.max(half))).alias("se"),
    ).withColumn("z", ratio(F.col("mean_first") - F.col("mean_second"), "se"))


def lower_tail(z: Column) -> Column:
    """Normal probability below -|z|."""

    @F.pandas_udf("double")
    def tail(values: pd.Series) -> pd.Series:
        return values.map(lambda v: 0.5 * math.erfc(abs(v) / math.sqrt(2)), na_action="ignore")

    return tail(z)


def long_run_mean(draws: DataFrame, keys: list[str], params: list[str]) -> DataFrame:
    """b0 / (1 - sum of the other coefficients) per draw."""
    wide = draws.groupBy(*keys).agg(
        *[F.max(F.when(F.col("param") == p, F.col("value"))).alias(f"_{p}") for p in params])
    slope = sum((F.col(f"_{p}") for p in params[1:]), F.lit(0.0))
    return wide.select(*keys, ratio(F.col(f"_{params[0]}"), 1 - slope).alias("value"))


_GOLDEN, _MIX_A, _MIX_B = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def uniforms(keys: np.ndarray, counter: int) -> np.ndarray:
    """One number inside (0, 1) per key: the ``counter``-th of the stream that the key names (SplitMix64).

    Nothing is kept between calls, so a number depends on its key and counter alone, however
    the keys are spread over batches and tasks.
    """
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + _GOLDEN * np.uint64(counter + 1)
        z = (z ^ (z >> np.uint64(30))) * _MIX_A
        z = (z ^ (z >> np.uint64(27))) * _MIX_B
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(12)).astype(float) + 0.5) * 2.0**-52


class Streams:
    """Counter-based random numbers of many streams at once: each call moves all of them on."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.counter = np.asarray(keys).astype(np.uint64), 0

    def uniform(self, of=slice(None)) -> np.ndarray:
        self.counter += 1
        return uniforms(self.keys[of], self.counter)

    def normal(self, of=slice(None)) -> np.ndarray:
        """Box and Muller's, the cosine alone."""
        radius = np.sqrt(-2 * np.log(self.uniform(of)))
        return radius * np.cos(2 * np.pi * self.uniform(of))

    def _until(self, draw, shape: np.ndarray) -> np.ndarray:
        """``draw`` (rows -> numbers, accepted) for every row until accepted. A round costs each row the same
        count of numbers, so what a row gets does not depend on its neighbours."""
        start, out, open_ = self.counter, np.zeros(len(shape)), np.arange(len(shape))
        while len(open_):
            value, fine = draw(open_)
            out[open_[fine]] = value[fine]
            open_ = open_[~fine]
        # the next use begins at a place that no number of rounds reaches
        self.counter = start + 4096
        return out

    def chi_square(self, freedom: np.ndarray) -> np.ndarray:
        """Marsaglia and Tsang's gamma numbers, for one degree of freedom or more."""
        shape = np.asarray(freedom, float) / 2
        small = shape < 1
        d = np.where(small, shape + 1, shape) - 1 / 3
        c = 1 / np.sqrt(9 * d)
        lift = np.where(small, self.uniform() ** (1 / shape), 1.0)

        def draw(of):
            x, u = self.normal(of), self.uniform(of)
            v = (1 + c[of] * x) ** 3
            with np.errstate(invalid="ignore", divide="ignore"):
                fine = (v > 0) & (np.log(u) < 0.5 * x * x + d[of] * (1 - v + np.log(v)))
            return d[of] * v, fine

        return 2 * lift * self._until(draw, shape)

    def normal_above(self, least: np.ndarray) -> np.ndarray:
        """Standard normal numbers at or above ``least``, however far out: from the normal itself
        below zero, from a shifted exponential above (Robert 1995)."""
        least = np.asarray(least, float)
        far = least > 0
        rate = np.where(far, (least + np.sqrt(least * least + 4)) / 2, 1.0)

        def draw(of):
            plain, u, v = self.normal(of), self.uniform(of), self.uniform(of)
            tail = least[of] - np.log(u) / rate[of]
            value = np.where(far[of], tail, plain)
            fine = np.where(far[of], v <= np.exp(-0.5 * (tail - rate[of]) ** 2), plain >= least[of])
            return value, fine

        return self._until(draw, least)


def _chains(xx, xy, yy, n, draws, streams, bounded, bound):
    """Draws (draw, chain, coefficients and variance) of all chains of a batch in one recursion.

    Variance and coefficients alternate; only sums of products are needed.
    """
    chains, k = xy.shape
    free = [i for i in range(k) if i != bounded]
    beta = np.zeros((chains, k))
    if bounded is not None:
        beta[:, bounded] = bound + 0.5
    cov = np.linalg.inv(xx[:, free][:, :, free])
    root = np.linalg.cholesky(cov)
    out = np.empty((draws, chains, k + 1))
    for i in range(draws):
        rest = yy - 2 * (beta * xy).sum(axis=1) + np.einsum("ca,cab,cb->c", beta, xx, beta)
        sigma2 = np.maximum(rest, 1e-300) / streams.chi_square(n)
        target = xy[:, free]
        noise = np.zeros((chains, 0)) if not free else np.stack([streams.normal() for _ in free], axis=1)
        if bounded is not None:
            target = target - xx[:, free, bounded] * beta[:, [bounded]]
        beta[:, free] = np.einsum("cab,cb->ca", cov, target) + np.sqrt(sigma2)[:, None] * np.einsum("cab,cb->ca", root, noise)
        if bounded is not None:
            scale = xx[:, bounded, bounded]
            centre = (xy[:, bounded] - (xx[:, bounded, free] * beta[:, free]).sum(axis=1)) / scale
            spread = np.sqrt(sigma2 / scale)
            beta[:, bounded] = np.maximum(centre + spread * streams.normal_above((bound - centre) / spread), bound)
        out[i, :, :k], out[i, :, k] = beta, sigma2
    return out


def regression_draws(
    sums: DataFrame, xs: list[str], keys: list[str], draws: int, chains: int = 1, seed: int = 1,
    bounded: str | None = None, bound: float = 1.0,
) -> DataFrame:
    """(keys, chain, iter, param, value) from the one Gram row of each group.

    Flat prior; ``bounded`` names a coefficient kept at or above ``bound``. Each (group,
    chain) has its own stream of numbers that are found by counting, so all chains of a batch
    move together and draws depend neither on batches nor on the partitioning. A group of at
    most len(xs) rows, or with dependent columns, has no draws.
    """
    k = len(xs)
    limited = xs.index(bounded) if bounded else None
    key_schema = ", ".join(f"{c} {sums.schema[c].dataType.simpleString()}" for c in keys)
    tagged = sums.withColumn("_chain", F.explode(F.sequence(F.lit(0), F.lit(chains - 1)))) \
        .withColumn("_stream", F.xxhash64(F.lit(seed), *keys, "_chain"))
    # One small row per chain turns into thousands, so chains are spread by number, not by size.
    tagged = tagged.repartition(int(tagged.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_stream")
    names = [*xs, "sigma2"]

    def together(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        parts = [unpack(row, k) for row in rows.to_dict("records")]
        whole = [i for i, (xx, _, _, n) in enumerate(parts) if n > k and np.linalg.matrix_rank(xx) == k]
        if not whole:
            return
        rows = rows.iloc[whole]
        xx, xy, yy, n = (np.array([parts[i][j] for i in whole], dtype=float) for j in range(4))
        paths = _chains(xx, xy, yy, n, draws, Streams(rows["_stream"].to_numpy(dtype=np.int64)), limited, bound)
        for at in range(len(whole)):
            yield pd.DataFrame({
                **{c: [rows[c].iloc[at]] * (draws * (k + 1)) for c in keys},
                "chain": rows["_chain"].iloc[at],
                "iter": np.repeat(np.arange(draws), k + 1),
                "param": np.tile(names, draws),
                "value": paths[:, at].ravel(),
            })

    width = max(1, MOST_NUMBERS // (draws * (k + 1)))

    def each(batches):
        for batch in batches:
            for start in range(0, len(batch), width):
                yield from together(batch.iloc[start:start + width])

    return tagged.mapInPandas(each, f"{key_schema}, chain int, iter int, param string, value double")


def forecast_draws(
    draws: DataFrame, last: DataFrame, keys: list[str], lags: list[str], const: str, horizon: int,
    seed: int = 1,
) -> DataFrame:
    """h-step paths of an autoregression for every draw.

    ``last`` has the latest len(lags) values of each series as the array ``recent``, newest
    first. All paths of a batch take a step together; each has a stream of its own.
    """
    names = [const, *lags, "sigma2"]
    wide = draws.groupBy(*keys, "chain", "iter").agg(
        *[F.max(F.when(F.col("param") == p, F.col("value"))).alias(f"_{p}") for p in names])
    coefficient = F.array(*[F.col(f"_{p}") for p in names])
    ready = wide.join(last, keys).select(
        *keys, "chain", "iter", coefficient.alias("c"), "recent", F.xxhash64(F.lit(seed), *keys, "chain", "iter").alias("s"))

    @F.pandas_udf("array<double>")
    def path(c: pd.Series, recent: pd.Series, s: pd.Series) -> pd.Series:
        if not len(c):
            return pd.Series([], dtype=object)
        beta, values = np.stack(c.to_numpy()).astype(float), np.stack(recent.to_numpy()).astype(float)
        streams = Streams(s.to_numpy(dtype=np.int64))
        steps = []
        for _ in range(horizon):
            mean = beta[:, 0] + (beta[:, 1:-1] * values).sum(axis=1)
            steps.append(mean + np.sqrt(beta[:, -1]) * streams.normal())
            values = np.column_stack([steps[-1], values[:, :-1]])
        return pd.Series(list(np.stack(steps, axis=1)))

    return ready.select(*keys, "chain", "iter", F.posexplode(path("c", "recent", "s")).alias("step", "value"))
