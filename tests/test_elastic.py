"""Grids of elastic-net logits fitted together: optimal one by one, equal to single fits, odd inputs."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector

from tallyloom.operators import elastic
from tallyloom.operators import selection as sl

FOLDS = 3


def made(seed=1, n=240, d=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.array([1, 50, 0.01, 3])[:d] + np.array([0, 1000, 5, -2])[:d]
    z = (x[:, 0] + (x[:, 1] - 1000) / 50 - 0.3) * 1.5
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    return x, y, np.arange(n) % FOLDS


def frame(spark, x, y, fold):
    return spark.createDataFrame([(v.tolist(), int(b), int(f)) for v, b, f in zip(x, y, fold)], "features array<double>, label int, fold int")


def standardised(x):
    spread = x.std(axis=0)
    return (x - x.mean(axis=0)) / np.where(spread > 1e-12, spread, 1.0)


def worst_sub_gradient(x, y, theta, c, share):
    """From the definition, on one model's own training rows."""
    s = standardised(x)
    p = 1 / (1 + np.exp(-(theta[0] + s @ theta[1:])))
    g, l1, l2 = s.T @ (p - y), share / c, (1 - share) / c
    off = [abs((p - y).sum())]
    for w, v in zip(theta[1:], g):
        off.append(abs(v + l2 * w + l1 * np.sign(w)) if w else max(abs(v) - l1, 0.0))
    return max(off) / len(y)


SETTINGS = [(c, a) for c in (1e-3, 0.05, 1.0, 1e5) for a in (0.0, 0.5, 1.0)]


def test_every_model_is_optimal(spark):
    x, y, fold = made()
    fits = elastic.fit(elastic.stored(frame(spark, x, y, fold)), SETTINGS, FOLDS)
    assert (fits.gap <= elastic.TOLERANCE).all() and fits.passes < 30
    for m, theta in enumerate(fits.theta):
        train = fold != fits.fold[m]
        assert worst_sub_gradient(x[train], y[train], theta, *SETTINGS[m % len(SETTINGS)]) < 2e-6
    strongest = fits.theta[SETTINGS.index((1e-3, 1.0)), 1:]
    assert (strongest == 0).all()  # the lasso leaves nothing


def test_equals_single_fits(spark):
    x, y, _ = made(2)
    df = frame(spark, x, y, np.full(len(y), -1))
    settings = [(0.05, 0.5), (1.0, 1.0), (2.0, 0.0)]
    fits = elastic.fit(elastic.stored(df), settings, 1)
    scaled = standardised(x) * np.sqrt(len(y) / (len(y) - 1))
    single = frame(spark, standardised(x), y, np.zeros(len(y))).withColumn("features", array_to_vector("features"))
    assert scaled.shape == x.shape
    for m, (c, a) in enumerate(settings):
        model = LogisticRegression(standardization=False, elasticNetParam=a, regParam=1 / (c * len(y)), maxIter=500, tol=1e-12).fit(single)
        assert fits.theta[m, 1:] == pytest.approx(model.coefficients.toArray(), abs=2e-4)
        assert fits.theta[m, 0] == pytest.approx(model.intercept, abs=2e-4)
    intercept, slopes = fits.raw(0)
    assert intercept + x @ slopes == pytest.approx(fits.theta[0, 0] + standardised(x) @ fits.theta[0, 1:])


def test_scores_are_means_over_the_folds(spark):
    x, y, fold = made(3)
    settings = [(0.1, 0.5), (10.0, 0.0)]
    got = {r["config"]: r for r in elastic.grid_scores(frame(spark, x, y, fold), settings, FOLDS).collect()}
    fits = elastic.fit(elastic.stored(frame(spark, x, y, fold)), settings, FOLDS)
    for c in range(2):
        hits = []
        for f in range(FOLDS):
            intercept, slopes = fits.raw(f * 2 + c)
            mine = fold == f
            hits.append((((intercept + x[mine] @ slopes) > 0) == y[mine]).mean())
        assert got[c]["accuracy"] == pytest.approx(np.mean(hits)) and got[c]["models_done"] == FOLDS
        assert got[c]["accuracy"] > 0.7


def test_pieces_and_batches_change_nothing(spark, monkeypatch):
    x, y, fold = made(4)
    df = frame(spark, x, y, fold)
    plain = elastic.fit(elastic.stored(df), [(1.0, 0.3)], FOLDS).theta
    for name, value in (("TASK_ROWS", 50), ("BATCH_ROWS", 7), ("PIECE", 11)):
        monkeypatch.setattr(elastic, name, value)
    assert elastic.fit(elastic.stored(df), [(1.0, 0.3)], FOLDS).theta == pytest.approx(plain, abs=1e-5)


def test_odd_inputs(spark):
    x, y, fold = made(5)
    constant = np.concatenate([x, np.full((len(x), 1), 7.0)], axis=1)
    fits = elastic.fit(elastic.stored(frame(spark, constant, y, fold)), [(1.0, 0.5)], FOLDS)
    assert (fits.gap <= elastic.TOLERANCE).all() and (fits.theta[:, -1] == 0).all()
    one = elastic.grid_scores(frame(spark, x, np.ones(len(y)), fold), [(1.0, 0.5)], FOLDS).first()
    assert one["accuracy"] == 1.0 and one["models_done"] == FOLDS
    apart = (x[:, 0] > 0).astype(int)  # separable: weak penalties give long but finite coefficients
    far = elastic.fit(elastic.stored(frame(spark, x, apart, fold)), [(1e3, 0.5), (1e3, 0.0)], FOLDS)
    assert (far.gap <= elastic.TOLERANCE).all() and np.isfinite(far.theta).all()
    assert elastic.grid_scores(frame(spark, x[:0], y[:0], fold[:0]), SETTINGS, FOLDS).collect() == []


def test_word_shares(spark):
    docs = spark.createDataFrame([(1, "a b  A\tb c"), (2, None), (3, ""), (4, "word " * 5000)], "id long, text string")
    got = {r["id"]: r["features"] for r in sl.word_shares(docs, "id", "text", 8).collect()}
    assert sorted(got) == [1, 2, 3, 4] and all(len(v) == 10 for v in got.values())
    assert sum(got[1][:8]) == pytest.approx(1.0) and got[1][8:] == pytest.approx([np.log(6), 1.0])
    assert got[2] == got[3] == [0.0] * 10 and max(got[4][:8]) == 1.0
