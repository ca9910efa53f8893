"""Logit fits as a table: many datasets, closed forms, equal to single fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import choice as ch
from tallyloom.operators import logittable as lt

ALTS = ["a", "b", "c"]


def occasions(spark, rows, keep):
    return ch.occasions(spark.createDataFrame(rows, "part string, choice string, n double, x_a double, x_b double, x_c double"),
                        "choice", ALTS, keep, ["part"], weight="n")


def test_ten_thousand_datasets(spark):
    """One row per dataset and alternative; constants are logs of ratios."""
    counts = spark.range(10_000).select(
        F.col("id").cast("string").alias("part"), F.explode(F.array(*[F.lit(a) for a in ALTS])).alias("choice")).withColumn(
        "n", (F.pmod(F.xxhash64("part", "choice"), F.lit(50)) + 1).cast("double"))
    rows = ch.occasions(counts, "choice", ALTS, [], ["part"], weight="n")
    terms = ch.names(ALTS, [])
    fits = lt.fit_logit_table(rows, terms, "part", tolerance=1e-16)
    wide = counts.groupBy("part").pivot("choice", ALTS).agg(F.first("n"))
    both = fits.join(wide, "part").toPandas()
    assert len(both) == 10_000 and both["converged"].all() and both["steps"].max() < 20
    theta, cov = np.stack(both["theta"]), np.stack(both["covariance"]).reshape(-1, 2, 2)
    a, b, c = (both[x].to_numpy() for x in ALTS)
    assert theta == pytest.approx(np.stack([np.log(b / a), np.log(c / a)], axis=1), abs=1e-6)
    assert cov[:, 0, 0] == pytest.approx(1 / a + 1 / b, rel=1e-5) and cov[:, 0, 1] == pytest.approx(1 / a, rel=1e-5)
    total = a + b + c
    assert both["loglik"].to_numpy() == pytest.approx(sum(v * np.log(v / total) for v in (a, b, c)), rel=1e-9)


def made(n=600, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x = rng.normal(size=3)
        u = x * 1.2 + np.array([0.0, 0.4, -0.3]) + rng.gumbel(size=3)
        out.append((None if i % 50 == 0 else "ab"[i % 2], ALTS[int(u.argmax())], 1.0, *x.tolist()))
    return out


def test_equals_the_fits_of_few_datasets(spark):
    rows = occasions(spark, made(), ["x"])
    terms = ch.names(ALTS, ["x"])
    few = ch.fit_logit_groups(rows.filter("part is not null"), terms, "part")
    table = {r["part"]: r for r in lt.fit_logit_table(rows, terms, "part").collect()}
    assert set(table) == set(few) == {"a", "b"}  # rows without a key take no part
    for g, f in few.items():
        assert table[g]["theta"] == pytest.approx(list(f.theta), abs=1e-6)
        assert table[g]["covariance"] == pytest.approx(f.covariance.ravel().tolist(), rel=1e-5)
        assert table[g]["loglik"] == pytest.approx(f.loglik) and table[g]["converged"]
    lines = lt.coefficients(lt.fit_logit_table(rows, terms, "part"), terms, "part").filter("part = 'a'").collect()
    assert {r["term"]: r["se"] for r in lines} == pytest.approx(dict(zip(terms, few["a"].errors)), rel=1e-5)


def test_answers_and_tests_by_join(spark):
    rows = occasions(spark, made(), ["x"])
    terms, fewer = ch.names(ALTS, ["x"]), ch.names(ALTS[:2], ["x"])
    left = spark.createDataFrame([r for r in made() if r[1] != "c"], "part string, choice string, n double, x_a double, x_b double, x_c double")
    part = ch.occasions(left, "choice", ALTS[:2], ["x"], ["part"], weight="n")
    full, subset = lt.fit_logit_table(rows, terms, "part"), lt.fit_logit_table(part, fewer, "part")
    out = {r["part"]: r for r in lt.answers(rows, "part", full, terms, subset, fewer, ALTS, "x", "x", ["x"], "b").collect()}
    known = rows.filter("part is not null")
    fits = ch.fit_logit_groups(known, terms, "part")
    others = ch.fit_logit_groups(part.filter("part is not null"), fewer, "part")
    want = {r["part"]: r for r in ch.dataset_answers(known, "part", fits, others, ALTS, "x", "x", ["x"], "b").collect()}
    assert set(out) == {"a", "b"}
    for g in out:
        for name in ("beta", "se"):
            assert out[g][name] == pytest.approx(want[g][name], rel=1e-4, abs=1e-6)
        for name in ("statistic", "p_value", "loglik", "loglik_null", "mcfadden"):
            assert out[g][name] == pytest.approx(want[g][name], rel=1e-3)
        for name in ("effects", "scenario"):
            assert [e["effect"] for e in out[g][name]] == pytest.approx([e["effect"] for e in want[g][name]], abs=1e-6)


def test_few_steps_never_chosen_and_empty(spark):
    rows = occasions(spark, made(), ["x"])
    terms = ch.names(ALTS, ["x"])
    cut = lt.fit_logit_table(rows, terms, "part", steps=1).collect()
    assert [r["converged"] for r in cut] == [False, False] and {r["steps"] for r in cut} == {1}
    never = occasions(spark, [r for r in made() if r[1] != "c"], ["x"])
    fits = lt.fit_logit_table(never, terms, "part").collect()
    assert all(np.isfinite(r["theta"]).all() and r["loglik"] < 0 for r in fits)
    assert lt.fit_logit_table(rows.limit(0), terms, "part").collect() == []
