"""Error measures and hit rates as aggregate expressions; 0/0 counts as 0 in the rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalar import ratio


def rate(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def harmonic(a: Column, b: Column) -> Column:
    return rate(2 * a * b, a + b)


def squared_error(y: str, p: str) -> Column:
    return F.avg((F.col(p) - F.col(y)) * (F.col(p) - F.col(y)))


def absolute_error(y: str, p: str) -> Column:
    return F.avg(F.abs(F.col(p) - F.col(y)))


def relative_error(y: str, p: str) -> Column:
    return F.avg(F.abs(ratio(F.col(p) - F.col(y), F.col(y))))


def smape(y: str, p: str, exponent: float = 1.0) -> Column:
    """100 * mean(2|p - y| / (|y| + |p| + 1e-6)) ** exponent"""
    term = 2 * F.abs(F.col(p) - F.col(y)) / (F.abs(F.col(y)) + F.abs(F.col(p)) + F.lit(1e-6))
    return F.lit(100.0) * F.pow(F.avg(term), F.lit(float(exponent)))


def hit_flags(truth: Column, predicted: Column) -> dict[str, Column]:
    """tp, tn, fp, fn of a 0/1 truth and prediction."""
    return {
        "tp": (truth == 1) & (predicted == 1),
        "tn": (truth == 0) & (predicted == 0),
        "fp": (truth == 0) & (predicted == 1),
        "fn": (truth == 1) & (predicted == 0),
    }


def pair_measures(scored: DataFrame, truth: str, probability: str, all_duplicates: Column,
                  threshold: float = 0.7, weight: Column | None = None) -> DataFrame:
    """Precision, recall, F1, pair quality, completeness and their harmonic means.

    ``weight`` is the number of pairs a row stands for, one unless given.
    """
    weight = F.lit(1) if weight is None else weight
    flags = hit_flags(F.col(truth), (F.col(probability) > threshold).cast("int"))
    counts = scored.agg(
        *[F.coalesce(F.sum(F.when(c, weight)), F.lit(0)).cast("double").alias(n) for n, c in flags.items()],
        F.coalesce(F.sum(weight), F.lit(0)).cast("double").alias("pairs"),
    ).withColumn("duplicates", all_duplicates.cast("double"))
    f = counts.select(
        "*",
        rate("tp", F.col("tp") + F.col("fp")).alias("precision"),
        rate("tp", F.col("tp") + F.col("fn")).alias("recall"),
        rate("tp", "pairs").alias("pair_quality"),
        rate("tp", "duplicates").alias("pair_completeness"),
    )
    f = f.withColumns({
        "f1": harmonic(F.col("precision"), F.col("recall")),
        "f1_star": harmonic(F.col("pair_quality"), F.col("pair_completeness")),
    })
    return f.withColumn("f1_hat", harmonic(F.col("f1"), F.col("f1_star")))


def class_measures(scored: DataFrame, truth: str, predicted: str, keys: list[str] | None = None,
                   weight: Column | None = None) -> DataFrame:
    """Accuracy and macro precision, recall and F1 over the classes of truth or prediction.

    ``weight`` is the number of rows that a row stands for, one unless given.
    """
    keys = keys or []
    confusion = scored.groupBy(*keys, truth, predicted).agg(F.sum(F.lit(1) if weight is None else weight).cast("double").alias("n"))
    # classes x classes rows per key from here on
    hit = F.when(F.col(truth) == F.col(predicted), F.col("n")).otherwise(0.0)
    by_truth = confusion.groupBy(*keys, F.col(truth).alias("c")).agg(
        F.sum(hit).alias("tp"), F.sum("n").alias("actual"))
    by_guess = confusion.groupBy(*keys, F.col(predicted).alias("c")).agg(F.sum("n").alias("guessed"))
    both = by_truth.join(by_guess, [*keys, "c"], "full").fillna(0.0, ["tp", "actual", "guessed"])
    per_class = both.select(
        *keys, "tp", "actual", rate("tp", "guessed").alias("p"), rate("tp", "actual").alias("r"))
    measures = [
        rate(F.sum("tp"), F.sum("actual")).alias("accuracy"), F.avg("p").alias("precision"),
        F.avg("r").alias("recall"), F.avg(harmonic(F.col("p"), F.col("r"))).alias("f1")]
    return per_class.groupBy(*keys).agg(*measures) if keys else per_class.agg(*measures)
