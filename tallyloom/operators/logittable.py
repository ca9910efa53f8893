"""Conditional logits of any number of datasets, with the fits as a table.

The state of Newton's method, one row per dataset, is a stored table. Each step joins it to the
occasions, sums likelihood, gradient and information by dataset on Spark, and moves all datasets in
batches of small systems inside the tasks. Finished datasets leave the table. The driver only
learns how many are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.choice import (
    chi_square_tail, derivative_step, log_likelihood, partial_effects, scenario_effect, with_probabilities,
)
from tallyloom.session import scratch_path, stage

#: How far below the best likelihood, relatively, a step may end without being halved.
SLACK = 1e-9


def _matrix(column: pa.Array, *shape: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), *shape)


def _lists(values: np.ndarray) -> pa.ListArray:
    flat = values.reshape(len(values), -1)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, flat.shape[1]), pa.int32()), pa.array(flat.ravel()))


def fit_logit_table(
    rows: DataFrame, terms: list[str], key: str, steps: int = 100, tolerance: float = 1e-8
) -> DataFrame:
    """(key, theta, covariance, loglik, gradient, steps, converged), one row per dataset, stored.

    ``rows`` are occasions as ``choice.occasions`` makes them, with ``key``; rows without a key take
    no part. ``covariance`` holds k x k numbers row by row. A step that lowers the likelihood is
    halved; a fit still in work after ``steps`` steps is marked as not converged. A direction
    without information (an alternative never chosen apart) is left where it is.
    """
    k, spark = len(terms), rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    advance = derivative_step(k, [key])
    rows = stage(rows.select(key, "chosen", "w", "x").filter(F.col(key).isNotNull()), "occasions")
    zeros, none = F.array_repeat(F.lit(0.0), k), F.lit(None).cast("double")
    state = stage(rows.select(key).distinct().select(
        key, zeros.alias("theta"), zeros.alias("step"), zeros.alias("best"), none.alias("loglik"), zeros.alias("gradient"),
        F.array_repeat(F.lit(0.0), k * k).alias("information")), "state")
    columns = "theta array<double>, step array<double>, best array<double>, loglik double, gradient array<double>, information array<double>"
    moved_kind = f"{key} {kind}, {columns}, open boolean"
    held_kind = f"{moved_kind}, steps int"
    paths: list[str] = []

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            theta, step, best, kept_gradient = (_matrix(b.column(i), k) for i in (1, 2, 3, 5))
            held = b.column(4).to_numpy(zero_copy_only=False)  # NaN before the first step
            kept_information = _matrix(b.column(6), k, k)
            value = b.column(7).to_numpy(zero_copy_only=False)
            gradient, information = _matrix(b.column(8), k), _matrix(b.column(9), k, k)
            worse = value < held - SLACK * np.abs(held)
            took = ~worse[:, None]
            new_step = np.einsum("nij,nj->ni", np.linalg.pinv(information, hermitian=True), gradient)
            gain = (gradient * new_step).sum(axis=1)
            best = np.where(took, theta, best)
            step = np.where(took, new_step, step / 2)
            finished = np.where(worse, np.abs(step).max(axis=1) < 1e-12, gain < tolerance)
            theta = np.where(finished[:, None], best, best + step)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _lists(theta), _lists(step), _lists(best), pa.array(np.where(worse, held, value)),
                 _lists(np.where(took, gradient, kept_gradient)), _lists(np.where(took[:, :, None], information, kept_information)), pa.array(~finished)],
                names=[key, "theta", "step", "best", "loglik", "gradient", "information", "open"])

    gradients = F.array(*[F.col(f"g_{i}") for i in range(k)])
    informations = F.array(*[F.col(f"h_{min(i, j)}_{max(i, j)}") for i in range(k) for j in range(k)])
    for taken in range(1, steps + 1):
        live = rows.join(state.select(key, F.col("theta").alias("_theta")), key)
        sums = advance(live).select(key, F.col("loglik").alias("_value"), gradients.alias("_g"), informations.alias("_h"))
        paths.append(scratch_path(spark, "moved"))
        state.join(sums, key).mapInArrow(move, moved_kind).withColumn("steps", F.lit(taken)).write.parquet(paths[-1])
        state = spark.read.schema(held_kind).parquet(paths[-1]).filter("open").drop("open", "steps")
        if state.isEmpty():
            break

    def inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            information = _matrix(b.column(2), k, k)
            found = np.linalg.pinv(information, hermitian=True) if b.num_rows else information
            yield pa.RecordBatch.from_arrays([*b.columns[:2], _lists(found) if b.num_rows else b.column(2), *b.columns[3:]], names=[key, "theta", "covariance", "loglik", "gradient", "steps", "converged"])

    # a dataset is in the table of every step it took; what counts is the step it ended with
    fits = spark.read.schema(held_kind).parquet(*paths).filter((~F.col("open")) | (F.col("steps") == len(paths)))
    return stage(fits.withColumn("converged", ~F.col("open")).select(key, "best", "information", "loglik", "gradient", "steps", "converged").mapInArrow(
        inverted, f"{key} {kind}, theta array<double>, covariance array<double>, loglik double, gradient array<double>, steps int, converged boolean"), "logits")


def standard_errors(k: int):
    """Roots of the diagonal of a covariance stored row by row."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.sqrt(F.greatest(F.get("covariance", i * (k + 1)), F.lit(0.0))))


def coefficients(fits: DataFrame, terms: list[str], key: str) -> DataFrame:
    """(key, term, beta, se, loglik, gradient, steps): one row per dataset and term."""
    named = F.arrays_zip(F.array(*[F.lit(t) for t in terms]).alias("term"), F.col("theta").alias("beta"), standard_errors(len(terms)).alias("se"))
    steepest = F.array_max(F.transform("gradient", lambda g: F.abs(g)))
    return fits.select(key, F.inline(named), "loglik", steepest.alias("gradient"), "steps")


def independence_tests(full: DataFrame, full_terms: list[str], subset: DataFrame, subset_terms: list[str], key: str) -> DataFrame:
    """(key, statistic, degrees, p_value): Hausman-McFadden test of every dataset that has both fits."""
    shared = [t for t in subset_terms if t in full_terms]
    a, b = [subset_terms.index(t) for t in shared], [full_terms.index(t) for t in shared]
    k, m = len(full_terms), len(subset_terms)
    both = full.select(key, "theta", "covariance").join(
        subset.select(key, F.col("theta").alias("_theta"), F.col("covariance").alias("_covariance")), key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            gap = _matrix(batch.column(3), m)[:, a] - _matrix(batch.column(1), k)[:, b]
            spread = _matrix(batch.column(4), m, m)[:, a][:, :, a] - _matrix(batch.column(2), k, k)[:, b][:, :, b]
            value = np.einsum("ni,nij,nj->n", gap, np.linalg.pinv(spread, hermitian=True), gap)
            tail = [chi_square_tail(float(v), len(shared)) for v in value]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value), pa.array(np.full(len(value), len(shared), dtype=np.int32)), pa.array(tail, pa.float64())],
                names=[key, "statistic", "degrees", "p_value"])

    return both.mapInArrow(run, f"{key} {full.schema[key].dataType.simpleString()}, statistic double, degrees int, p_value double")


def answers(
    rows: DataFrame, key: str, full: DataFrame, full_terms: list[str], subset: DataFrame, subset_terms: list[str],
    alternatives: list[str], price: str, flag: str, flags: list[str], alternative: str,
) -> DataFrame:
    """One answer row per dataset: coefficients, errors, test, likelihood, effects, scenario.

    The coefficients meet the occasions by a join on the dataset, whatever their number.
    """
    known = full.select(key, F.col("theta").alias("beta"), standard_errors(len(full_terms)).alias("se")).join(
        independence_tests(full, full_terms, subset, subset_terms, key), key, "left")
    met = stage(rows.join(full.select(key, F.col("theta").alias("_beta")), key), "met")
    theta = F.col("_beta")
    slope = F.get("_beta", F.lit(full_terms.index(price)))
    # alternatives squared, and alternatives, rows per dataset
    effects = partial_effects(with_probabilities(met, theta), alternatives, slope, keys=[key]).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("share_of", "changed", "effect"))).alias("effects"))
    scenario = scenario_effect(
        met, theta, alternatives, full_terms.index(flag), [full_terms.index(f) for f in flags], alternatives.index(alternative), [key],
    ).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("alt", "effect"))).alias("scenario"))
    return known.join(log_likelihood(met, theta, [key]), key).join(effects, key).join(scenario, key)
