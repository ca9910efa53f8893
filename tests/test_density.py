"""Densities on a grid against sums over all rows."""

import numpy as np
import pytest

from tallyloom.operators import kernel as kn


def brute(x, y, g1, g2, bandwidth):
    inverse = np.linalg.inv(bandwidth)
    total = 0.0
    for a, b in zip(x, y):
        u = np.array([g1 - a, g2 - b]) @ inverse
        total += np.exp(-0.5 * (u @ u))
    return total / len(x) / (2 * np.pi * np.linalg.det(bandwidth))


@pytest.mark.parametrize("bandwidth", [np.diag([0.4, 1.5]), np.array([[0.6, 0.2], [0.1, 0.9]])])
def test_density_by_class(spark, monkeypatch, bandwidth):
    monkeypatch.setattr(kn, "DENSITY_ROWS", 16)
    monkeypatch.setattr(kn, "DENSITY_CLASSES", 1)
    rng = np.random.default_rng(1)
    rows = [("ab"[i % 2] if i % 7 else None, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)) * [1, 3])]
    extra = [("a", None, 1.0), ("b", 2.0, None)]
    df = spark.createDataFrame(rows + extra, "c string, x double, y double").repartition(5)
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows] + [1.0])
    got = kn.grid_density(df, "x", "y", bandwidth, 5, "c").collect()
    assert len(got) == 75 and {r["c"] for r in got} == {"a", "b", None}
    high_x = max(x.max(), 2.0)
    for r in got:
        assert r["g1"] == pytest.approx(x.min() + (high_x - x.min()) * r["i"] / 4)
        assert r["g2"] == pytest.approx(y.min() + (y.max() - y.min()) * r["j"] / 4)
        mine = [v for v in rows if v[0] == r["c"]]
        assert r["density"] == pytest.approx(brute([v[1] for v in mine], [v[2] for v in mine], r["g1"], r["g2"], bandwidth), rel=1e-9)


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    got = kn.grid_density(df, "x", "y", np.eye(2), 2).collect()
    assert [(r["g1"], r["g2"]) for r in got] == [(1.0, 2.0)] * 4
    assert all(r["density"] == pytest.approx(1 / (2 * np.pi)) for r in got)
    assert kn.grid_density(df.limit(0), "x", "y", np.eye(2), 2).collect() == []


def test_no_row_is_multiplied_by_the_nodes(spark):
    df = spark.range(100).selectExpr("cast(id as double) as x", "cast(id as double) as y")
    plan = kn.grid_density(df, "x", "y", np.eye(2), 10)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "RoundRobin" not in plan


def test_fifty_directions_in_one_plan(spark):
    """The plan does not grow with the directions, and each score is that of a search of its own."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 2)).round(2)
    y = np.sin(x[:, 0] + 0.5 * x[:, 1])
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")

    def size(directions):
        out = kn.single_index(df, "a", "b", "y", directions, 0.5, 5)
        return out, out._jdf.queryExecution().optimizedPlan().toString().count("\n")

    directions = [k / 10 for k in range(-25, 25)]
    (all_of_them, many), (_, one) = size(directions), size([0.5])
    scores = {r["direction"]: r["score"] for r in all_of_them.collect()}
    assert many == one and set(scores) == set(directions)
    for b in (-2.5, 0.0, 0.5, 1.3):
        line = df.selectExpr(f"a + {b}D * b as x", "y")
        assert scores[b] == pytest.approx(kn.leave_one_out(line, [0.5], [5]).first()["score"], rel=1e-9)
    assert min(scores, key=scores.get) == pytest.approx(0.5, abs=0.2)
