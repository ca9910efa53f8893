"""Stratified folds, hyperparameter grids and cross-validated classifiers on MLlib."""

from __future__ import annotations

import math
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.rates import class_measures
from tallyloom.operators.ordered import running
from tallyloom.session import stage

# Feature subsets by name, and the forest chosen by the grid search.
SUBSETS = {"sqrt": "sqrt", "log2": "log2", None: "all"}
IMPURITY = {"gini": "gini", "entropy": "entropy", "log_loss": "entropy"}
CHOSEN_FOREST = {"n_estimators": 400, "criterion": "entropy", "max_features": None}
#: Rows of a part that a core is worth; rows from which on a table is cut finer than into one part a core.
PART_ROWS, MOST_ROWS = 2_000, 50_000


def grid(choices: dict[str, list]) -> list[dict]:
    """Every combination of the listed values."""
    return [dict(zip(choices, values)) for values in product(*choices.values())]


def stratified_folds(df: DataFrame, id: str, label: str, k: int, order: Column) -> DataFrame:
    """Add ``fold`` 0..k-1: inside each class, rows in the order of a hash take turns.

    The position inside a class is a running count over slices of the hash, which spread
    evenly, so a class with a third of the rows is not sorted in one task.
    """
    hashed = stage(df.withColumn("_h", order), "folds")
    classes = [row[0] for row in hashed.select(label).distinct().orderBy(label).collect()]  # one value per class
    counts = {f"_c{i}": (F.col(label) == F.lit(c)).cast("long") for i, c in enumerate(classes)}
    ranked = running(hashed, "_h", [id], counts, position=None, staged=False)
    own = F.coalesce(*[F.when(F.col(label) == F.lit(c), F.col(f"_c{i}")) for i, c in enumerate(classes)])
    return ranked.withColumn("fold", ((own - 1) % k).cast("int")).drop("_h", *counts)


def regularisation(c: float, rows: int) -> float:
    """Strength per row for an inverse strength ``c`` on the sum over rows."""
    return 1.0 / (c * max(rows, 1))


def classifier(kind: str, h: dict, features: int, classes: int, rows: int, seed: int = 54321) -> Estimator:
    """Estimator of one family: tree, forest, boost, logit or net."""
    common = {"featuresCol": "features", "labelCol": "label"}
    subset = SUBSETS[h.get("max_features", "sqrt")]
    impurity = IMPURITY[h.get("criterion", "gini")]
    if kind == "tree":
        if subset == "all":
            return DecisionTreeClassifier(impurity=impurity, maxDepth=h.get("depth", 10), seed=seed, **common)
        # a single tree on feature subsets is a forest of one unresampled tree
        return RandomForestClassifier(
            numTrees=1, bootstrap=False, impurity=impurity, featureSubsetStrategy=subset,
            maxDepth=h.get("depth", 10), seed=seed, **common)
    if kind == "forest":
        return RandomForestClassifier(
            numTrees=h.get("n_estimators", 100), impurity=impurity, featureSubsetStrategy=subset,
            maxDepth=h.get("depth", 10), seed=seed, **common)
    if kind == "boost":
        return GBTClassifier(
            maxIter=h.get("n_estimators", 100), featureSubsetStrategy=subset, maxDepth=h.get("depth", 3),
            seed=seed, **common)
    if kind == "logit":
        scaled = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
        model = LogisticRegression(
            featuresCol="scaled", labelCol="label", standardization=False,
            maxIter=h.get("iterations", 100), elasticNetParam=h.get("alpha", 0.0), regParam=regularisation(h.get("lambda_inverse", 1.0), rows))
        return Pipeline(stages=[scaled, model])
    if kind == "net":
        hidden = h.get("hidden", [128, 128, 128, 128])
        return MultilayerPerceptronClassifier(
            layers=[features, *hidden, classes], maxIter=h.get("iterations", 100), seed=seed, **common)
    raise ValueError(f"unknown classifier {kind}")


def training_parts(rows: int, cores: int) -> int:
    """Parts for a fit: one a core, fewer for few rows, more only where a part would hold over ``MOST_ROWS`` rows."""
    return max(1, min(cores, math.ceil(rows / PART_ROWS)), math.ceil(rows / MOST_ROWS))


def evenly(df: DataFrame, rows: int) -> DataFrame:
    """The rows dealt evenly to ``training_parts`` parts; what fits one part stays as it lies.

    A tree fit makes the sums of all its open nodes in every part, empty ones too, and each step runs a task a part. So
    the number of parts must follow the rows and the cores, not the setting for shuffles, and no part may hold most rows.
    """
    parts = training_parts(rows, df.sparkSession.sparkContext.defaultParallelism)
    return df if rows <= PART_ROWS else df.repartition(parts)


def cross_validate(
    folded: DataFrame, kind: str, configs: list[dict], k: int, features: int, classes: int, parallelism: int = 4,
) -> DataFrame:
    """Mean accuracy, macro precision, recall and F1 over the folds, one row per config.

    ``parallelism`` models are fitted at a time, as Spark's own cross-validator does; all
    predictions are scored together in one job. The rows are dealt evenly first (``evenly``).
    """
    data = evenly(folded, folded.count()).persist()
    try:
        sizes = {row["fold"]: row["n"] for row in data.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = sum(sizes.values())

        def fit_and_score(task: tuple[int, int]) -> DataFrame:
            i, fold = task
            train = data.filter(F.col("fold") != fold)
            model = classifier(kind, configs[i], features, classes, total - sizes.get(fold, 0)).fit(train)
            scored = model.transform(data.filter(F.col("fold") == fold))
            return scored.select(
                F.lit(i).alias("config"), F.lit(fold).alias("fold"), F.col("label").cast("double").alias("label"),
                "prediction")

        tasks = [(i, fold) for i in range(len(configs)) for fold in range(k)]
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            parts = pool.map(inheritable_thread_target(data.sparkSession)(fit_and_score), tasks)
        every = reduce(lambda a, b: a.unionByName(b), parts)
        per_fold = class_measures(every, "label", "prediction", ["config", "fold"])
        means = per_fold.groupBy("config").agg(
            *[F.avg(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])
        return stage(means, "scores")
    finally:
        data.unpersist()


def best_config(scores: DataFrame, configs: list[dict], score: str = "accuracy") -> tuple[dict, float]:
    """Config with the highest score, the first of equals."""
    row = scores.agg(F.max(F.struct(score, (-F.col("config")).alias("c"))).alias("b")).first()["b"]
    return configs[-row["c"]], row[score]


def fit_classifier(train: DataFrame, kind: str, h: dict, features: int, classes: int) -> PipelineModel:
    rows = train.count()
    return classifier(kind, h, features, classes, rows, seed=12345).fit(evenly(train, rows))


def predict(model, df: DataFrame, keep: list[str]) -> DataFrame:
    return model.transform(df).select(*keep, "prediction")


def word_shares(docs: DataFrame, id: str, text: str, width: int = 32) -> DataFrame:
    """(id, features): share of a text's words in each of ``width`` hash buckets, then the log of the number
    of words and the mean length of a word.

    Words are what lies between blanks, in lower case. A null or empty text has zeros only. Word
    counts are summed before the shuffle, so a long text moves at most ``width`` rows a task.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[ \\t-\\r]+"), lambda w: w != "")
    per_word = docs.select(F.col(id).alias(id), F.explode_outer(words).alias("_w"))
    buckets = per_word.groupBy(id, F.pmod(F.crc32(F.col("_w").cast("binary")), F.lit(width)).alias("_b")).agg(
        F.count("_w").alias("_n"), F.sum(F.length("_w")).alias("_c"))
    rows = buckets.groupBy(id).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("_b").isNotNull(), F.struct("_b", "_n")))).alias("_by"),
        F.sum("_n").alias("_words"), F.coalesce(F.sum("_c"), F.lit(0)).alias("_chars"))
    safe = F.greatest(F.col("_words"), F.lit(1))
    shares = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.coalesce(F.try_element_at("_by", k.cast("long")), F.lit(0)) / safe)
    return rows.select(id, F.concat(shares, F.array(F.log1p(F.col("_words").cast("double")), F.col("_chars") / safe)).alias("features"))
