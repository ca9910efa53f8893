import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import rates
from tallyloom.operators import choice as ch
from tallyloom.operators import decompose as dc
from tallyloom.operators import forecast as fc
from tallyloom.operators import kernel as kn
from tallyloom.operators import leastsq as ls
from tallyloom.operators import mixture as mx
from tallyloom.operators import posterior as po
from tallyloom.operators import selection as sl
from tallyloom.operators import windows as win


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


def dates(n):
    return [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(n)]


# ---- choice models

ALTS, ATTRS = ["a", "b", "c"], ["price", "dis"]


def choices(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    price, dis = rng.uniform(1, 3, (n, 3)), rng.integers(0, 2, (n, 3)).astype(float)
    u = np.array([0.0, 0.5, -0.5]) - 1.2 * price + 0.8 * dis + rng.gumbel(size=(n, 3))
    pdf = pd.DataFrame({f"price_{a}": price[:, j] for j, a in enumerate(ALTS)})
    for j, a in enumerate(ALTS):
        pdf[f"dis_{a}"] = dis[:, j]
    pdf["choice"] = np.array(ALTS)[u.argmax(axis=1)]
    pdf["id"] = np.arange(n)
    pdf["part"] = np.arange(n) % 2
    return spark.createDataFrame(pdf)


def test_logit_fit(spark):
    df = choices(spark)
    rows = ch.occasions(df, "choice", ALTS, ATTRS)
    f = ch.fit_logit(rows, ch.names(ALTS, ATTRS))
    assert np.abs(f.gradient).max() < 1e-3
    assert f.theta == pytest.approx([0.5, -0.5, -1.2, 0.8], abs=0.25)
    assert (f.errors > 0).all()
    scored = ch.with_probabilities(rows, ch.literal(f.theta))
    total = scored.select(F.aggregate("p", F.lit(0.0), lambda a, v: a + v).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert list(total) == pytest.approx([1.0, 1.0])
    row = ch.log_likelihood(rows, f.theta).first()
    assert row["loglik"] == pytest.approx(f.loglik) and 0 < row["mcfadden"] < 1
    effects = ch.partial_effects(scored, ALTS, f.theta[2]).toPandas()
    assert effects.groupby("changed")["effect"].sum().abs().max() < 1e-9
    change = ch.scenario_effect(rows, f.theta, ALTS, 3, [3], 1).toPandas().set_index("alt")["effect"]
    assert change["b"] > 0 and change.sum() == pytest.approx(0, abs=1e-9)


def test_logit_gradient_is_the_slope(spark):
    rows = ch.occasions(choices(spark, 200), "choice", ALTS, ATTRS).persist()
    theta = np.array([0.1, 0.2, -0.3, 0.4])
    row = ch.derivatives(rows, theta).first()
    for i in range(4):
        step = np.eye(4)[i] * 1e-5
        up, down = (ch.log_likelihood(rows, theta + s).first()["loglik"] for s in (step, -step))
        assert row[f"g_{i}"] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-4)


def test_logit_with_an_alternative_never_chosen(spark):
    df = choices(spark, 400).filter("choice <> 'c'")
    f = ch.fit_logit(ch.occasions(df, "choice", ALTS, ATTRS), ch.names(ALTS, ATTRS))
    assert np.isfinite(f.theta).all() and f.loglik < 0


def test_logit_by_dataset_and_folding(spark):
    df = choices(spark, 1000)
    names = ch.names(ALTS, ATTRS)
    both = ch.fit_logit_groups(ch.occasions(df, "choice", ALTS, ATTRS, ["part"]), names, "part")
    alone = ch.fit_logit(ch.occasions(df.filter("part = 1"), "choice", ALTS, ATTRS, fold_equal=True), names)
    assert set(both) == {0, 1} and both[1].theta == pytest.approx(alone.theta, abs=1e-6)


def test_answers_of_many_datasets_equal_single_ones(spark):
    df = choices(spark, 1500)
    names = ch.names(ALTS, ATTRS)
    rows = ch.occasions(df, "choice", ALTS, ATTRS, ["part"])
    fits = ch.fit_logit_groups(rows, names, "part")
    left = ch.occasions(df.filter("choice <> 'c'"), "choice", ALTS[:2], ATTRS, ["part"])
    subset = ch.fit_logit_groups(left, ch.names(ALTS[:2], ATTRS), "part")
    out = ch.dataset_answers(rows, "part", fits, subset, ALTS, "price", "dis", ["dis"], "b")
    row = out.filter("part = 1").first()
    alone = rows.filter("part = 1")
    f = fits[1]
    assert out.count() == 2 and row["beta"] == pytest.approx(list(f.theta))
    assert row["loglik"] == pytest.approx(f.loglik)
    effects = ch.partial_effects(ch.with_probabilities(alone, ch.literal(f.theta)), ALTS, f.theta[2]).collect()
    want = {(r["share_of"], r["changed"]): r["effect"] for r in effects}
    assert {(e["share_of"], e["changed"]): pytest.approx(e["effect"]) for e in row["effects"]} == want
    scenario = ch.scenario_effect(alone, f.theta, ALTS, 3, [3], 1).collect()
    assert [s["effect"] for s in row["scenario"]] == pytest.approx([r["effect"] for r in sorted(scenario)])
    assert row["statistic"] == pytest.approx(ch.independence_test(f, subset[1])[0])


def test_independence_test_and_chi_square(spark):
    df = choices(spark, 2000)
    full = ch.fit_logit(ch.occasions(df, "choice", ALTS, ATTRS), ch.names(ALTS, ATTRS))
    left = df.filter(F.col("choice") != "c")
    part = ch.fit_logit(ch.occasions(left, "choice", ALTS[:2], ATTRS), ch.names(ALTS[:2], ATTRS))
    value, degrees, p = ch.independence_test(full, part)
    assert degrees == 3 and 0 <= p <= 1
    assert ch.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert ch.chi_square_tail(16.278, 5) == pytest.approx(0.00609, abs=1e-5)


def test_wide_to_long(spark):
    long = ch.wide_to_long(choices(spark, 10), "id", "choice", ALTS, ATTRS)
    assert long.count() == 30 and long.filter("chosen").count() == 10


# ---- mixtures

def test_em_likelihood_never_falls(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal([0, 0], 1, (200, 2)), rng.normal([6, 6], 1, (300, 2))])
    df = frame(spark, id=np.arange(500), a=x[:, 0], b=x[:, 1])
    model, value, paths = mx.fit_em(df, "id", ["a", "b"], 2, restarts=2)
    for path in paths:
        assert all(b >= a - 1e-6 for a, b in zip(path, path[1:]))
    assert sorted(model.pi) == pytest.approx([0.4, 0.6], abs=0.02)
    assert value == pytest.approx(mx.log_likelihood(df, ["a", "b"], model).first()[0], rel=1e-9)


def test_singular_covariance_and_short_weights(spark):
    flat = mx.Mixture([[0, 0], [1, 1]], [np.eye(2), np.ones((2, 2))], [0.3])
    assert flat.pi.tolist() == pytest.approx([0.3, 0.7]) and flat.singular
    df = frame(spark, a=[0.0], b=[1.0])
    assert mx.log_likelihood(df, ["a", "b"], flat).first()[0] == -math.inf
    assert mx.Mixture(np.zeros((3, 2)), [np.eye(2)] * 3, [0.2, 0.3, 0.5]).parameters() == 17


def test_conditional_mean_of_one_segment_is_the_regression(spark):
    m = mx.Mixture([[1.0, 2.0]], [[[2.0, 1.0], [1.0, 3.0]]], [1.0])
    df = frame(spark, a=[1.0, 3.0], b=[0.0, 0.0])
    got = [r["b_given"] for r in mx.conditional_mean(df, ["a", "b"], m).orderBy("a").collect()]
    assert got == pytest.approx([2.0, 3.0])


def test_extrapolated_steps_reach_the_same_maximum_sooner(spark, monkeypatch):
    rng = np.random.default_rng(15)
    near = np.vstack([rng.normal([0, 0], 1, (250, 2)), rng.normal([2.2, 1.0], 1.3, (250, 2))])
    far = np.vstack([rng.normal([0, 0], 1, (250, 2)), rng.normal([4.0, 2.0], 1.3, (250, 2))])
    start = [mx.Mixture([[-1.0, 0.0], [1.0, 1.0]], [np.eye(2)] * 2, [0.5, 0.5])]
    df = frame(spark, id=np.arange(500), a=far[:, 0], b=far[:, 1])
    fit = mx.fit_sizes(df, "id", ["a", "b"], [2], tolerance=1e-8, starts=start)[2]
    assert fit.converged and len(fit.paths[0]) <= 20
    assert all(b >= a - 1e-9 for a, b in zip(fit.paths[0], fit.paths[0][1:]))
    # one more step from the fitted model moves nothing
    (value, after), = mx.stepper(["a", "b"])(df, {0: fit.model}).values()
    assert value == pytest.approx(fit.value) and after.mu == pytest.approx(fit.model.mu, abs=5e-3)

    # segments that overlap: hundreds of plain steps, made without a job each
    def in_numpy(xs):
        def step(data, models):
            found = {i: mx._sums(near, m) for i, m in models.items()}
            return {i: (float(sums[1]), mx._updated(sums, models[i])) for i, sums in found.items()}
        return step

    monkeypatch.setattr(mx, "stepper", in_numpy)
    sooner, plain = (mx.fit_sizes(df, "id", ["a", "b"], [2], tolerance=1e-8, starts=start, accelerated=a)[2]
                     for a in (True, False))
    assert 4 * len(sooner.paths[0]) <= len(plain.paths[0]) and sooner.value >= plain.value
    assert all(b >= a - 1e-9 for a, b in zip(sooner.paths[0], sooner.paths[0][1:]))


def test_extrapolation_keeps_models_valid():
    a = mx.Mixture([[0.0, 0.0], [3.0, 3.0]], [np.eye(2), 2 * np.eye(2)], [0.5, 0.5])
    b = mx.Mixture([[0.1, 0.0], [3.1, 3.0]], [0.9 * np.eye(2), 1.9 * np.eye(2)], [0.45, 0.55])
    c = mx.Mixture([[0.19, 0.0], [3.19, 3.0]], [0.82 * np.eye(2), 1.82 * np.eye(2)], [0.41, 0.59])
    there, length = mx.extrapolated(a, b, c, 16.0)
    assert 1 < length <= 16 and not there.singular and there.pi.sum() == pytest.approx(1)
    assert there.mu[0, 0] > 0.19 and there.pi[0] < 0.41
    assert mx._bound(mx._free(a), 2, 2).sigma == pytest.approx(a.sigma)
    assert mx.extrapolated(a, a, a, 16.0)[0] is None  # nothing moves
    flat = mx.Mixture([[0.0, 0.0], [3.0, 3.0]], [np.ones((2, 2)), np.eye(2)], [0.5, 0.5])
    assert mx.extrapolated(flat, b, c, 16.0)[0] is None


# ---- splines, kernels

def test_spline_normal_equations(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(0, 10, 400)
    y = np.where(x < 3, 6 * x, 18 - 3 * (x - 3)) + rng.normal(0, 0.1, 400)
    df = frame(spark, x=x, y=y)
    basis = ls.linear_basis("x", [3.0, 7.0])
    beta, fitted = ls.fit_basis(df, basis, "y")
    design = np.column_stack([np.ones(400), x, np.maximum(x - 3, 0), np.maximum(x - 7, 0)])
    assert beta == pytest.approx(np.linalg.lstsq(design, y, rcond=None)[0], rel=1e-6)
    rest = fitted.withColumns(basis).agg(*[F.sum((F.col("y") - F.col("fitted")) * F.col(b)) for b in basis]).first()
    assert np.abs(list(rest)).max() < 1e-5
    errors = [
        ls.fit_basis(df, ls.linear_basis("x", [2.0, 4.0, 6.0]), "y", ls.smoothing_penalty([2.0, 4.0, 6.0], lam, 400))[1]
        .agg(rates.squared_error("y", "fitted")).first()[0] for lam in (1e-7, 1e-1, 10.0)]
    assert errors == sorted(errors)


def test_additive_model(spark):
    rng = np.random.default_rng(4)
    a, b = rng.uniform(0, 4, 600), rng.uniform(0, 4, 600)
    y = 5.4 + np.maximum(a - 2, 0) * 3 - b
    df = frame(spark, a=a, b=b, y=y)
    constant, parts = ls.additive_model(df, ["a", "b"], "y", {"a": [1.0, 2.0, 3.0], "b": [2.0]}, 1e-9)
    assert constant == pytest.approx(y.mean())
    row = parts.agg(F.avg("g_a"), F.avg("g_b"), F.max(F.abs(F.col("y") - constant - F.col("g_a") - F.col("g_b")))).first()
    assert list(row) == pytest.approx([0, 0, 0], abs=1e-4)


def brute_knn(x, y, q, h, k, skip=None):
    d = np.abs(x - q)
    keep = np.ones(len(x), bool)
    if skip is not None:
        keep[skip] = False
    kth = np.sort(d[keep])[k - 1]
    use = keep & (d <= kth)
    w = np.exp(-0.5 * (d[use] / h) ** 2)
    return (w * y[use]).sum() / w.sum()


def test_nearest_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    x = np.r_[np.full(60, 2.0), np.round(rng.uniform(0, 5, 120), 1)]  # many ties, a third on one value
    y = rng.normal(size=180)
    df = frame(spark, x=x, y=y)
    q = np.array([-1.0, 0.33, 2.0, 4.97, 9.0])
    got = kn.knn_regression(df, frame(spark, x=q), 0.7, 5, block=16).orderBy("x").toPandas()["fitted"]
    assert got.tolist() == pytest.approx([brute_knn(x, y, v, 0.7, 5) for v in q])
    scores = kn.leave_one_out(df, [0.3, 1.0], [1, 7], block=16).toPandas()
    for _, row in scores.iterrows():
        h, k = row["bandwidth"], int(row["neighbours"])
        want = np.mean([(y[i] - brute_knn(x, y, x[i], h, k, i)) ** 2 for i in range(180)])
        assert row["score"] == pytest.approx(want)
    assert kn.best_score(kn.leave_one_out(df, [0.3, 1.0], [1, 7], block=16), ["bandwidth", "neighbours"]).count() == 1


def test_nearest_with_ties(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 2.0), (1, 2.0), (1, 3.0)], "q int, d double")
    assert kn.nearest_with_ties(df, "q", "d", 2).count() == 4


# ---- series

def test_windows(spark):
    df = frame(spark, partner=["A"] * 10, month=dates(10), x=np.arange(10.0))
    made = win.supervised_windows(df, ["partner"], "month", ["x"], ["x"], 4, 2, 3)
    assert made.count() == 10 - 7 + 1
    first = made.orderBy("start").first()
    assert [r["x"] for r in first["inputs"]] == [0, 1, 2, 3] and [r["x"] for r in first["labels"]] == [5, 6]
    assert win.supervised_windows(df, ["partner"], "month", ["x"], ["x"], 9, 1, 3).count() == 0
    assert win.sequences(df, ["partner"], "month", ["x"], 4).count() == 7
    assert win.sequences(df, ["partner"], "month", ["x"], 4, drop_last=True).count() == 6
    parts = win.chronological_split(df, ["partner"], "month", 0.5, 0.8, connect=True, window=3)
    counts = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert counts == {"train": 5, "val": 5, "test": 4}
    whole = win.chronological_split(df, ["partner"], "month", 6, 8).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in whole} == {"train": 6, "val": 2, "test": 2}
    blocks = win.origins(df, ["partner"], "month", "x", 4, 4, stride=4, partial=True).orderBy("origin").collect()
    assert [len(b["future"]) for b in blocks] == [4, 2]


def test_stl_and_additive_parts_sum(spark):
    t = np.arange(60)
    y = 10 + 0.1 * t + 3 * np.sin(2 * np.pi * t / 12)
    df = frame(spark, partner=["A"] * 60, month=dates(60), x=y)
    for parts in (dc.stl(df, ["partner"], "month", "x"), dc.additive(df, ["partner"], "month", "x").dropna()):
        gap = parts.agg(F.max(F.abs(F.col("x") - F.col("trend") - F.col("seasonal") - F.col("residual")))).first()[0]
        assert gap < 1e-9
        assert parts.agg(F.max(F.abs("residual"))).first()[0] < 0.2
    short = frame(spark, partner=["A"] * 5, month=dates(5), x=y[:5])
    assert dc.stl(short, ["partner"], "month", "x").filter("trend is not null").count() == 0


def test_autocorrelations(spark):
    rng = np.random.default_rng(8)
    e = rng.normal(size=400)
    y = np.zeros(400)
    for i in range(1, 400):
        y[i] = 0.7 * y[i - 1] + e[i]
    df = frame(spark, partner=["A"] * 400, month=list(range(400)), x=y)
    acf = dc.autocorrelation(df, ["partner"], "month", "x", 4)
    r = [row["acf"] for row in acf.orderBy("lag").collect()]
    d = y - y.mean()
    assert r == pytest.approx([1.0] + [(d[k:] * d[:-k]).sum() / (d * d).sum() for k in range(1, 5)])
    p = [row["pacf"] for row in dc.partial_autocorrelation(acf, ["partner"]).orderBy("lag").collect()]
    assert p[1] == pytest.approx(r[1]) and p[2] == pytest.approx((r[2] - r[1] ** 2) / (1 - r[1] ** 2))


def test_forecast_is_exact_on_noiseless_series():
    y = [1.0]
    for _ in range(29):
        y.append(0.5 + 0.8 * y[-1])
    out, fitted = fc.fit_forecast(np.array(y[:24]), (1, 0, 0, 0, 0, 0, 0, "c"), 6)
    assert out == pytest.approx(y[24:30]) and fitted[1:] == pytest.approx(y[1:24])
    t = np.arange(40.0)
    line, _ = fc.fit_forecast(3 + 2 * t, (0, 1, 0, 0, 0, 0, 0, "c"), 4)
    assert line == pytest.approx(3 + 2 * np.arange(40, 44))
    season = np.tile([1.0, 5.0, 2.0, 8.0], 10)
    again, _ = fc.fit_forecast(season, (0, 0, 0, 0, 1, 0, 4, "n"), 5)
    assert again == pytest.approx([1, 5, 2, 8, 1])
    x = np.sin(t)[:, None]
    path, _ = fc.fit_forecast(2 + 3 * x[:36, 0], (0, 0, 0, 0, 0, 0, 0, "c"), 4, x[:36], x[36:])
    assert path == pytest.approx(2 + 3 * x[36:, 0])


def test_forecast_guards():
    config = (2, 0, 1, 0, 0, 0, 0, "c")
    assert np.isnan(fc.fit_forecast(np.ones(24), config, 6)[0]).all()  # constant: singular
    assert np.isnan(fc.fit_forecast(np.arange(3.0), config, 6)[0]).all()
    assert np.isnan(fc.fit_forecast(np.array([1.0, np.nan] * 12), config, 6)[0]).all()


def test_grid_search_picks_the_lowest_config_of_equals(spark):
    scores = spark.createDataFrame(
        [("A", 1, 2.0), ("A", 2, 1.0), ("A", 3, 1.0), ("B", 1, None), ("B", 2, 5.0)], "s string, c int, mse double")
    assert sorted(tuple(r) for r in fc.grid_search(scores, ["s"], "c").collect()) == [("A", 2, 1.0), ("B", 2, 5.0)]
    assert len(fc.configs([0, 1], [0], [0, 1], [0, 1], [0], [0], [0, 12])) == 12


# ---- posterior

def regression(spark, n=400):
    rng = np.random.default_rng(9)
    x = rng.normal(size=n)
    y = 1.0 + 0.4 * x + rng.normal(0, 0.5, n)
    return frame(spark, g=["A"] * n, one=np.ones(n), x=x, y=y), x, y


def test_draws_centre_on_least_squares(spark):
    df, x, y = regression(spark)
    sums = ls.gram(df, ["one", "x"], "y", ["g"])
    draws = po.kept_draws(po.regression_draws(sums, ["one", "x"], ["g"], 3000, chains=2), 200, 2)
    means = {r["param"]: r["mean"] for r in po.summary(draws, ["param"]).collect()}
    ols = np.linalg.lstsq(np.column_stack([np.ones(400), x]), y, rcond=None)[0]
    assert [means["one"], means["x"]] == pytest.approx(list(ols), abs=0.01)
    again = po.regression_draws(sums.repartition(3), ["one", "x"], ["g"], 50).agg(F.sum("value")).first()[0]
    assert again == po.regression_draws(sums, ["one", "x"], ["g"], 50).agg(F.sum("value")).first()[0]


def test_bounded_draws_respect_the_bound(spark):
    df, _, _ = regression(spark)
    sums = ls.gram(df, ["one", "x"], "y", ["g"])
    draws = po.regression_draws(sums, ["one", "x"], ["g"], 500, bounded="x", bound=1.0)
    low = draws.filter("param = 'x'").agg(F.min("value"), F.max("value")).first()
    assert 1.0 <= low[0] < low[1] < 1.5  # the bound is far above the estimate of 0.4


def test_counted_numbers_follow_their_distributions_and_keys():
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 40000)
    u = po.Streams(keys).uniform()
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01
    z = po.Streams(keys).normal()
    assert abs(z.mean()) < 0.02 and abs(z.std() - 1) < 0.02 and abs((z > 1.96).mean() - 0.025) < 0.004
    for freedom in (1.0, 2.0, 7.0, 400.0):
        c = po.Streams(keys).chi_square(np.full(len(keys), freedom))
        assert abs(c.mean() / freedom - 1) < 0.03 and abs(c.var() / (2 * freedom) - 1) < 0.06
    for least in (-3.0, -0.5, 0.4, 2.0, 30.0):
        a = po.Streams(keys).normal_above(np.full(len(keys), least))
        density = math.exp(-0.5 * least * least) / math.sqrt(2 * math.pi)
        above = 0.5 * math.erfc(least / math.sqrt(2))
        assert a.min() >= least and a.mean() == pytest.approx(density / above, abs=0.02)
    # a stream does not see its neighbours, nor how often they are turned down
    some = po.Streams(keys[100:105])
    every = po.Streams(keys)
    for _ in range(3):
        assert every.chi_square(np.full(len(keys), 3.0))[100:105] == pytest.approx(some.chi_square(np.full(5, 3.0)))
        assert every.normal_above(np.full(len(keys), 1.0))[100:105] == pytest.approx(some.normal_above(np.full(5, 1.0)))


def test_chains_do_not_depend_on_what_moves_beside_them(spark, monkeypatch):
    df, _, _ = regression(spark)
    every = df.withColumn("g", F.explode(F.array(*map(F.lit, "ABCDE")))).withColumn("y", F.col("y") + F.ascii("g"))
    short = spark.createDataFrame([("S", 1.0, 2.0, 3.0)], "g string, one double, x double, y double")
    flat = spark.createDataFrame([("F", 1.0, 2.0, float(i)) for i in range(9)], "g string, one double, x double, y double")
    sums = ls.gram(every.unionByName(short).unionByName(flat), ["one", "x"], "y", ["g"])

    def drawn(sums):
        out = po.regression_draws(sums, ["one", "x"], ["g"], 40, chains=3, bounded="x", bound=0.3)
        return {tuple(r)[:4]: r["value"] for r in out.collect()}

    whole = drawn(sums)
    assert {g for g, *_ in whole} == set("ABCDE") and len(whole) == 5 * 3 * 40 * 3  # too few or dependent rows: no draws
    assert len({whole[g, c, 39, "x"] for g in "ABCDE" for c in range(3)}) == 15
    alone = drawn(sums.filter("g = 'C'"))
    assert all(whole[key] == pytest.approx(value) for key, value in alone.items())
    monkeypatch.setattr(po, "MOST_NUMBERS", 1)  # one chain after the other
    assert drawn(sums) == pytest.approx(whole)


def test_draw_summaries(spark):
    rng = np.random.default_rng(10)
    v = rng.normal(size=1000)
    df = frame(spark, p=["a"] * 1000, iter=np.arange(1000), value=v)
    s = np.sort(v)
    # every pair of order statistics with 950 steps between them that leaves at least one draw below
    widths = [(s[first + 950] - s[first], s[first], s[first + 950]) for first in range(1, 50)]
    row = po.shortest_interval(df, ["p"], "value", 0.95).first()
    assert (row["low"], row["high"]) == pytest.approx(min(widths)[1:])
    assert po.order_statistic(df, ["p"], "value", 0.25).first()["value"] == s[round(250) - 1]
    g = po.stationarity(df, ["p"], "iter", "value").withColumn("pv", po.lower_tail(F.col("z"))).first()
    z = (v[:100].mean() - v[500:].mean()) / np.sqrt(v[:100].var() / 100 + v[500:].var() / 500)
    assert g["z"] == pytest.approx(z) and g["pv"] == pytest.approx(0.5 * math.erfc(abs(z) / math.sqrt(2)))


def test_forecast_draws_follow_the_recursion(spark):
    draws = spark.createDataFrame(
        [("A", 0, 0, p, v) for p, v in (("c", 1.0), ("l1", 0.5), ("l2", 0.25), ("sigma2", 0.0))],
        "g string, chain int, iter int, param string, value double")
    last = spark.createDataFrame([("A", [4.0, 2.0])], "g string, recent array<double>")
    out = po.forecast_draws(draws, last, ["g"], ["l1", "l2"], "c", 2).orderBy("step").collect()
    assert [r["value"] for r in out] == pytest.approx([3.5, 1 + 0.5 * 3.5 + 0.25 * 4.0])


def test_very_many_queries_between_two_points(spark):
    """Queries that all fall into one gap are spread over parts and answered as by brute force."""
    points = spark.createDataFrame([(0.0, 1.0), (10.0, 5.0), (20.0, 2.0)], "x double, y double")
    xs = [4 + i / 1000 for i in range(3000)]
    queries = spark.createDataFrame([(x,) for x in xs], "x double")
    blocks = kn._blocks(points, queries, 2, 100).groupBy("block", "part").count().agg(F.max("count")).first()[0]
    assert blocks < 200
    got = {r["x"]: r["fitted"] for r in kn.knn_regression(points, queries, 5.0, 2, block=100).collect()}
    assert len(got) == 3000
    for x in xs[::97]:
        near = sorted([(abs(x - a), b) for a, b in ((0.0, 1.0), (10.0, 5.0), (20.0, 2.0))])[:2]
        w = [math.exp(-0.5 * (d / 5) ** 2) for d, _ in near]
        assert got[x] == pytest.approx(sum(a * y for a, (_, y) in zip(w, near)) / sum(w))


def test_rolling_python_metric(spark):
    from tallyloom.operators import windows as win

    df = spark.createDataFrame([("A", i, float(i * i)) for i in range(6)], "g string, t int, v double")
    got = win.rolling_apply(df, ["g"], "t", "v", 3, win.python_metric(max)).orderBy("t").collect()
    assert [r["score"] for r in got] == [None, None, 4.0, 9.0, 16.0, 25.0]


def test_mixture_fits_converge(spark):
    rng = np.random.default_rng(5)
    x = np.r_[rng.normal(-2, 0.5, (150, 2)), rng.normal(2, 0.7, (150, 2))]
    df = frame(spark, id=np.arange(300), a=x[:, 0], b=x[:, 1])
    fits = mx.fit_sizes(df, "id", ["a", "b"], [1, 2], restarts=3)
    assert all(f.converged for f in fits.values()) and fits[2].value > fits[1].value
    alone = mx.fit_em(df, "id", ["a", "b"], 2, restarts=3)
    assert alone[1] == pytest.approx(fits[2].value)
    assert not mx.fit_sizes(df, "id", ["a", "b"], [2], restarts=1, tolerance=0.0, limit=3)[2].converged


# ---- model selection

def test_folds_are_complete_and_balanced(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    folds = sl.stratified_folds(df, "id", "label", 10, F.xxhash64(F.lit(1), "id").cast("double"))
    counts = folds.groupBy("label", "fold").count().toPandas()
    assert folds.select("id").distinct().count() == 1000 and len(counts) == 20
    assert counts.groupby("label")["count"].agg(lambda c: c.max() - c.min()).max() <= 1


def test_classifiers_learn_a_simple_rule(spark):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 3))
    rows = [(i, Vectors.dense(v), int(v[0] + v[1] > 0)) for i, v in enumerate(x.tolist())]
    df = sl.stratified_folds(
        spark.createDataFrame(rows, ["id", "features", "label"]), "id", "label", 2, F.xxhash64("id").cast("double"))
    for kind, h in (("tree", {"max_features": None}), ("forest", {"n_estimators": 5}), ("boost", {"n_estimators": 3}),
                    ("logit", {"lambda_inverse": 10.0, "alpha": 0.5}), ("net", {"hidden": [8], "iterations": 30})):
        scores = sl.cross_validate(df, kind, [h], 2, 3, 2)
        best, accuracy = sl.best_config(scores, [h])
        assert best == h and accuracy > 0.7, kind
    assert len(sl.grid({"a": [1, 2], "b": [3, 4, 5]})) == 6


def test_class_measures_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, z int")
    row = rates.class_measures(df, "y", "z").first()
    assert row["accuracy"] == 0.5
    assert row["precision"] == pytest.approx((1 + 1 / 3 + 0) / 3) and row["recall"] == pytest.approx((0.5 + 1 + 0) / 3)


def test_rows_are_dealt_evenly_for_fits(spark):
    """Parts follow rows and cores, not the shuffle setting or the slices the rows came in; few rows stay as they lie."""
    cores = spark.sparkContext.defaultParallelism
    assert [sl.training_parts(n, 12) for n in (0, 1, 2_001, 100_000, 600_000, 6_000_000)] == [1, 1, 2, 12, 12, 120]
    rows = 10 * sl.PART_ROWS
    one = spark.range(rows).coalesce(1)
    sizes = sl.evenly(one, rows).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == min(cores, 10) and max(sizes) - min(sizes) <= 2
    assert sl.evenly(one, sl.PART_ROWS) is one
