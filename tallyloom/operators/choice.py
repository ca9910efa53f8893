"""Discrete choice: wide and long occasions, conditional logit, effects and scenarios.

An occasion is one row holding an array with one attribute vector per alternative, so
softmax and derivatives stay inside the row and a Newton step is a single aggregation
without a shuffle of the data. Only sums of size k and k x k reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.scalar import ratio


def wide_to_long(df: DataFrame, id: str, choice: str, alternatives: list[str], attributes: list[str],
                 keep: list[str] | None = None) -> DataFrame:
    """Columns ATTRIBUTE_ALTERNATIVE to one row per (occasion, alternative), without a shuffle."""
    rows = F.array(*[
        F.struct(F.lit(a).alias("alt"), (F.col(choice) == a).alias("chosen"),
                 *[F.col(f"{x}_{a}").cast("double").alias(x) for x in attributes])
        for a in alternatives
    ])
    return df.select(id, *(keep or []), F.inline(rows))


def chosen_from_flags(flags: dict[str, str]) -> Column:
    """Name of the alternative whose 0/1 column is 1."""
    chosen = F.lit(None).cast("string")
    for alternative, column in reversed(flags.items()):
        chosen = F.when(F.col(column) == 1, F.lit(alternative)).otherwise(chosen)
    return chosen


def available_only(long: DataFrame, flag: str = "available") -> DataFrame:
    return long.filter(F.col(flag))


def split_by_flag(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """Estimation rows (flag 0) and holdout rows (flag 1)."""
    return df.filter(F.col(flag) == 0), df.filter(F.col(flag) == 1)


def occasions(df: DataFrame, choice: str, alternatives: list[str], attributes: list[str],
              keep: list[str] | None = None, fold_equal: bool = False,
              weight: str | None = None) -> DataFrame:
    """(keep, chosen, w, x): x is an array over alternatives of [constants..., attributes...].

    The first alternative is the base and has no constant. ``fold_equal`` sums occasions
    with the same attributes and choice into a weight before anything else is done; rows
    that stand for several occasions already name their ``weight`` column.
    """
    columns = [f"{x}_{a}" for a in alternatives for x in attributes]
    kept = keep or []
    if fold_equal:
        df = df.groupBy(*kept, choice, *columns).agg(F.count(F.lit(1)).cast("double").alias("w"))
    else:
        df = df.withColumn("w", F.col(weight).cast("double") if weight else F.lit(1.0))

    def vector(a: str) -> Column:
        constants = [F.lit(1.0 if a == b else 0.0) for b in alternatives[1:]]
        return F.array(*constants, *[F.col(f"{x}_{a}").cast("double") for x in attributes])

    chosen = F.array_position(F.array(*[F.lit(a) for a in alternatives]), F.col(choice)).cast("int") - 1
    return df.select(*kept, chosen.alias("chosen"), "w", F.array(*[vector(a) for a in alternatives]).alias("x"))


def names(alternatives: list[str], attributes: list[str]) -> list[str]:
    return [f"const_{a}" for a in alternatives[1:]] + list(attributes)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda s, t: s * t), F.lit(0.0), lambda acc, v: acc + v)


def literal(theta: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(t)) for t in theta])


def with_probabilities(rows: DataFrame, theta: Column, x: str = "x", p: str = "p",
                       log_p: str | None = None) -> DataFrame:
    """Add the choice probabilities (an array over alternatives) under ``theta``."""
    utility = F.transform(x, lambda v: _dot(v, theta))
    rows = rows.withColumn("_u", utility).withColumn("_top", F.array_max("_u"))
    rows = rows.withColumn("_e", F.transform("_u", lambda u: F.exp(u - F.col("_top"))))
    rows = rows.withColumn("_sum", F.aggregate("_e", F.lit(0.0), lambda a, v: a + v))
    made = {p: F.transform("_e", lambda e: e / F.col("_sum"))}
    if log_p:
        made[log_p] = F.get("_u", F.col("chosen")) - F.col("_top") - F.log("_sum")
    return rows.withColumns(made).drop("_u", "_top", "_e", "_sum")


def log_likelihood(rows: DataFrame, theta: Sequence[float] | Column, keys: list[str] | None = None) -> DataFrame:
    """Log-likelihood, its value with constants only, and McFadden's ratio, per key."""
    keys = keys or []
    scored = with_probabilities(rows, _vector(theta), log_p="lp")
    fitted = scored.groupBy(*keys).agg(F.sum(F.col("w") * F.col("lp")).alias("loglik"))
    counts = rows.groupBy(*keys, "chosen").agg(F.sum("w").alias("n"))
    # one row per alternative and key
    total = F.sum("n").over(Window.partitionBy(*keys))
    terms = counts.select(*keys, (F.col("n") * F.log(F.col("n") / total)).alias("t"))
    null = terms.groupBy(*keys).agg(F.sum("t").alias("loglik_null"))
    both = fitted.join(null, keys) if keys else fitted.withColumn("loglik_null", null.scalar())
    return both.select(*keys, "loglik", "loglik_null", (1 - F.col("loglik") / F.col("loglik_null")).alias("mcfadden"))


def _vector(theta: Sequence[float] | Column) -> Column:
    return theta if isinstance(theta, Column) else literal(theta)


def by_dataset(values: dict, key: str) -> Column:
    """The number or vector of each row's dataset, from one entry per dataset."""
    pairs = [
        F.lit(c) if not isinstance(c, np.ndarray) else F.lit(c.astype(float))
        for g in sorted(values) for c in (g, values[g])
    ]
    return F.try_element_at(F.create_map(*pairs), F.col(key))


def derivative_step(k: int, keys: list[str]):
    """Function from rows with ``_theta`` to one row per key: likelihood, gradient, information.

    Each occasion becomes one term per alternative, p_j x_j x_j', and one term for the mean,
    -xbar xbar'. They are summed map-side. The columns are built once for all steps.
    """
    mean = F.array(*[
        F.aggregate(F.zip_with("p", "x", lambda pj, v: pj * F.get(v, F.lit(i))), F.lit(0.0), lambda a, t: a + t)
        for i in range(k)
    ])
    terms = F.transform("x", lambda v, j: F.struct(
        v.alias("v"), F.when(j == F.col("chosen"), F.lit(1.0)).otherwise(0.0).alias("g"),
        F.get("p", j).alias("h"), F.lit(0.0).alias("l")))
    whole = F.array(F.struct(
        F.col("_mean").alias("v"), F.lit(-1.0).alias("g"), F.lit(-1.0).alias("h"), F.col("_lp").alias("l")))
    split = F.inline(F.concat(terms, whole))
    parts = [F.get("v", F.lit(i)).alias(f"v{i}") for i in range(k)]
    sums = [F.sum(F.col("w") * F.col("l")).alias("loglik")]
    sums += [F.sum(F.col("w") * F.col("g") * F.col(f"v{i}")).alias(f"g_{i}") for i in range(k)]
    sums += [
        F.sum(F.col("w") * F.col("h") * F.col(f"v{i}") * F.col(f"v{j}")).alias(f"h_{i}_{j}")
        for i, j in combinations_with_replacement(range(k), 2)
    ]
    theta = F.col("_theta")

    def step(rows: DataFrame) -> DataFrame:
        scored = with_probabilities(rows, theta, log_p="_lp").withColumn("_mean", mean)
        flat = scored.select(*keys, "w", split).select(*keys, "w", "g", "h", "l", *parts)
        return flat.groupBy(*keys).agg(*sums) if keys else flat.agg(*sums)

    return step


def derivatives(rows: DataFrame, theta: Sequence[float]) -> DataFrame:
    """Log-likelihood, gradient and information (upper triangle) at ``theta``, one row."""
    return derivative_step(len(theta), [])(rows.withColumn("_theta", literal(theta)))


def _unpack(row, k: int) -> tuple[float, np.ndarray, np.ndarray]:
    gradient = np.array([row[f"g_{i}"] for i in range(k)])
    information = np.zeros((k, k))
    for i, j in combinations_with_replacement(range(k), 2):
        information[i, j] = information[j, i] = row[f"h_{i}_{j}"]
    return row["loglik"], gradient, information


@dataclass
class LogitFit:
    names: list[str]
    theta: np.ndarray
    covariance: np.ndarray
    loglik: float
    gradient: np.ndarray
    steps: int
    converged: bool = True

    @property
    def errors(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.covariance), 0.0))


def _inverse(information: np.ndarray) -> np.ndarray:
    return np.linalg.pinv(information, hermitian=True)


def fit_logit_groups(
    rows: DataFrame, terms: list[str], key: str, steps: int = 100, tolerance: float = 1e-8
) -> dict[object, LogitFit]:
    """Newton's method for all datasets at once: one job per step, k x k sums per dataset.

    A step that lowers the likelihood is halved. A fit still in work after ``steps`` steps is
    marked as not converged. The occasions are cached for the loop; a
    lost block is computed again from its source.
    """
    k = len(terms)
    advance = derivative_step(k, [key])
    rows = rows.persist()
    try:
        keys = [r[0] for r in rows.select(key).distinct().collect()]  # one value per dataset
        theta = {g: np.zeros(k) for g in keys}
        step = {g: np.zeros(k) for g in keys}
        best: dict[object, tuple] = {}
        open_ = set(keys)
        taken = 0
        while open_ and taken < steps:
            # one short array per dataset still in work; others give null and leave
            now = by_dataset({g: theta[g] for g in open_}, key)
            live = rows.withColumn("_theta", now).filter(F.col("_theta").isNotNull())
            for row in advance(live).collect():
                g = row[key]
                value, gradient, information = _unpack(row, k)
                if g in best and value < best[g][0] - 1e-9 * abs(best[g][0]):
                    step[g] = step[g] / 2
                    theta[g] = best[g][3] + step[g]
                    if np.max(np.abs(step[g])) < 1e-12:
                        open_.discard(g)
                    continue
                best[g] = (value, gradient, information, theta[g].copy())
                step[g] = _inverse(information) @ gradient
                if gradient @ step[g] < tolerance:
                    open_.discard(g)
                else:
                    theta[g] = theta[g] + step[g]
            taken += 1
        return {
            g: LogitFit(terms, b[3], _inverse(b[2]), b[0], b[1], taken, g not in open_) for g, b in best.items()
        }
    finally:
        rows.unpersist()


def fit_logit(rows: DataFrame, terms: list[str], **options) -> LogitFit:
    one = rows.withColumn("_dataset", F.lit(0))
    return fit_logit_groups(one, terms, "_dataset", **options)[0]


def alternative_rows(scored: DataFrame, alternatives: list[str], keep: list[str]) -> DataFrame:
    """One row per (occasion, alternative) with its probability and the chosen flag."""
    labels = F.array(*[F.lit(a) for a in alternatives])
    return scored.select(*keep, "chosen", F.posexplode("p").alias("_j", "probability")).select(
        *keep, F.get(labels, F.col("_j")).alias("alt"), (F.col("_j") == F.col("chosen")).alias("chosen"),
        "probability")


def predicted_class(p: str, alternatives: list[str]) -> Column:
    """Alternative with the highest probability, the first of equals."""
    labels = F.array(*[F.lit(a) for a in alternatives])
    return F.element_at(labels, F.array_position(p, F.array_max(p)).cast("int"))


def partial_effects(
    scored: DataFrame, alternatives: list[str], beta: float | Column, p: str = "p", keys: list[str] | None = None,
) -> DataFrame:
    """Mean effect of alternative j's attribute on the share of i: beta p_i (1[i=j] - p_j)."""
    keys = keys or []
    labels = F.array(*[F.lit(a) for a in alternatives])
    slope = beta if isinstance(beta, Column) else F.lit(float(beta))
    one = scored.select(*keys, "w", p, slope.alias("_beta"), F.posexplode(p).alias("_i", "_pi"))
    two = one.select(*keys, "w", "_beta", "_i", "_pi", F.posexplode(p).alias("_j", "_pj"))
    effect = F.col("_beta") * F.col("_pi") * (F.when(F.col("_i") == F.col("_j"), 1.0).otherwise(0.0) - F.col("_pj"))
    return two.groupBy(
        *keys, F.get(labels, F.col("_i")).alias("share_of"), F.get(labels, F.col("_j")).alias("changed")
    ).agg((F.sum(F.col("w") * effect) / F.sum("w")).alias("effect"))


def effects_at_means(rows: DataFrame, theta: Sequence[float], alternatives: list[str], beta: float) -> DataFrame:
    """The same effects evaluated once, at the mean attributes."""
    k = len(theta)
    j = len(alternatives)
    means = rows.agg(F.array(*[
        F.array(*[F.sum(F.col("w") * F.get(F.get("x", F.lit(a)), F.lit(i))) / F.sum("w") for i in range(k)])
        for a in range(j)
    ]).alias("x")).withColumn("w", F.lit(1.0))
    return partial_effects(with_probabilities(means, literal(theta)), alternatives, beta)


def scenario_effect(
    rows: DataFrame, theta: Sequence[float] | Column, alternatives: list[str], attribute: int, cleared: list[int],
    alternative: int, keys: list[str] | None = None,
) -> DataFrame:
    """Mean change of every share when one alternative's flag goes 0 -> 1, all promotions cleared.

    ``attribute`` and ``cleared`` are positions in the attribute vector.
    """
    keys = keys or []

    def with_flag(on: float) -> Column:
        return F.transform("x", lambda v, j: F.transform(v, lambda value, i: F.when(
            (j == alternative) & (i == attribute), F.lit(on)).when(i.isin(cleared), F.lit(0.0)).otherwise(value)))

    beta = _vector(theta)
    both = rows.withColumns({"_x0": with_flag(0.0), "_x1": with_flag(1.0)})
    both = with_probabilities(with_probabilities(both, beta, "_x0", "_p0"), beta, "_x1", "_p1")
    labels = F.array(*[F.lit(a) for a in alternatives])
    gap = F.zip_with("_p1", "_p0", lambda a, b: a - b)
    return both.select(*keys, "w", F.posexplode(gap).alias("_j", "_gap")).groupBy(
        *keys, F.get(labels, F.col("_j")).alias("alt")
    ).agg((F.sum(F.col("w") * F.col("_gap")) / F.sum("w")).alias("effect"))


def probability_curve(rows: DataFrame, theta: Sequence[float], alternatives: list[str], attribute: int,
                      alternative: int, points: int = 21) -> DataFrame:
    """Probability and elasticity of one alternative over its attribute, others at their means.

    The curve runs from the smallest to the largest value seen; ``elasticity`` is
    beta x p (1 - p) and ``elasticity_textbook`` beta x (1 - p).
    """
    k, n = len(theta), len(alternatives)
    seen = F.get(F.get("x", F.lit(alternative)), F.lit(attribute))
    summary = rows.agg(
        F.min(seen).alias("lo"), F.max(seen).alias("hi"),
        F.array(*[
            F.array(*[F.sum(F.col("w") * F.get(F.get("x", F.lit(a)), F.lit(i))) / F.sum("w") for i in range(k)])
            for a in range(n)
        ]).alias("means"))
    steps = F.sequence(F.lit(0), F.lit(points - 1))
    grid = summary.select("means", F.explode(F.transform(
        steps, lambda s: F.col("lo") + (F.col("hi") - F.col("lo")) * s / (points - 1))).alias("value"))
    moved = grid.withColumn("x", F.transform("means", lambda v, j: F.transform(v, lambda m, i: F.when(
        (j == alternative) & (i == attribute), F.col("value")).otherwise(m))))
    scored = with_probabilities(moved, literal(theta)).withColumn("probability", F.get("p", F.lit(alternative)))
    beta = F.lit(float(theta[attribute]))
    return scored.select(
        "value", "probability",
        (beta * F.col("value") * F.col("probability") * (1 - F.col("probability"))).alias("elasticity"),
        (beta * F.col("value") * (1 - F.col("probability"))).alias("elasticity_textbook"))


def share_table(long: DataFrame, attributes: list[str], weight: str | None = None) -> DataFrame:
    """Choice share of each alternative and attribute means, overall and where chosen.

    ``weight`` counts the occasions a row stands for.
    """
    w = F.col(weight) if weight else F.lit(1)
    hit = F.when(F.col("chosen"), w).otherwise(0)

    def mean(a: str, share: Column) -> Column:
        return ratio(F.sum(share * F.col(a)), F.sum(share))

    per = long.groupBy("alt").agg(
        F.sum(hit).alias("n"), F.sum(w).alias("rows"),
        *[mean(a, w).alias(f"mean_{a}") for a in attributes],
        *[mean(a, hit).alias(f"chosen_{a}") for a in attributes])
    return per.withColumn("share", 100 * ratio("n", "rows")).drop("rows")


def realisation_table(scored: DataFrame, actual: str, predicted: str, weight: str = "w") -> DataFrame:
    """Share of every (actual, predicted) cell and the hit rate (sum of the diagonal)."""
    cells = scored.groupBy(actual, predicted).agg(F.sum(weight).alias("n"))
    # alternatives x alternatives rows
    total = F.sum("n").over(Window.partitionBy())
    hits = F.sum(F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(0.0)).over(Window.partitionBy())
    return cells.select(actual, predicted, (F.col("n") / total).alias("share"), (hits / total).alias("hit_rate"))


def _upper_gamma(s: float, x: float) -> float:
    """Regularised upper incomplete gamma by series or continued fraction."""
    if x <= 0:
        return 1.0
    if x < s + 1:
        term = total = 1.0 / s
        n = s
        for _ in range(1000):
            n += 1
            term *= x / n
            total += term
            if term < total * 1e-15:
                break
        return 1.0 - total * math.exp(-x + s * math.log(x) - math.lgamma(s))
    b = x + 1 - s
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 1000):
        a = -i * (i - s)
        b += 2
        d = 1 / (a * d + b)
        c = b + a / c
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return h * math.exp(-x + s * math.log(x) - math.lgamma(s))


def chi_square_tail(value: float, df: int) -> float:
    return _upper_gamma(df / 2.0, value / 2.0) if value > 0 else 1.0


def independence_test(full: LogitFit, subset: LogitFit) -> tuple[float, int, float]:
    """Hausman-McFadden statistic, degrees of freedom and p from two fits."""
    shared = [n for n in subset.names if n in full.names]
    a = [subset.names.index(n) for n in shared]
    b = [full.names.index(n) for n in shared]
    gap = subset.theta[a] - full.theta[b]
    spread = subset.covariance[np.ix_(a, a)] - full.covariance[np.ix_(b, b)]
    value = float(gap @ np.linalg.pinv(spread, hermitian=True) @ gap)
    return value, len(shared), chi_square_tail(value, len(shared))


def dataset_answers(
    rows: DataFrame, key: str, fits: dict[object, LogitFit], subset_fits: dict[object, LogitFit],
    alternatives: list[str], price: str, flag: str, flags: list[str], alternative: str,
) -> DataFrame:
    """One answer row per dataset: coefficients, errors, likelihood, effects, scenario, IIA test.

    All datasets are scored together; what is known per dataset is a short vector each.
    """
    terms = next(iter(fits.values())).names
    theta = by_dataset({g: f.theta for g, f in fits.items()}, key)
    tests = {g: independence_test(f, subset_fits[g]) for g, f in fits.items() if g in subset_fits}
    known = rows.sparkSession.createDataFrame(
        [(g, [float(t) for t in f.theta], [float(e) for e in f.errors],
          *(tests[g] if g in tests else (None, None, None))) for g, f in fits.items()],
        f"{key} {rows.schema[key].dataType.simpleString()}, beta array<double>, se array<double>, "
        "statistic double, degrees int, p_value double")
    scored = with_probabilities(rows, theta)
    slope = by_dataset({g: float(f.theta[terms.index(price)]) for g, f in fits.items()}, key)
    # alternatives squared, and alternatives, rows per dataset
    effects = partial_effects(scored, alternatives, slope, keys=[key]).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("share_of", "changed", "effect"))).alias("effects"))
    scenario = scenario_effect(
        rows, theta, alternatives, terms.index(flag), [terms.index(f) for f in flags], alternatives.index(alternative),
        [key],
    ).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("alt", "effect"))).alias("scenario"))
    return known.join(log_likelihood(rows, theta, [key]), key).join(effects, key).join(scenario, key)
