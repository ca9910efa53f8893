"""Counts of pairs that agree in any band, against all pairs written out."""

from itertools import combinations

import numpy as np
import pytest

from tallyloom.operators import bandcount as bc
from tallyloom.operators import linkage as lk

SCHEMA = "id long, g string, truth int, shop string, hashes array<bigint>"


def brute(rows, group=False, different=False):
    out = {}
    for a, b in combinations(rows, 2):
        if group and (a[1] is None or a[1] != b[1]):
            continue
        if different and (a[3] is None or b[3] is None or a[3] == b[3]):
            continue
        cell = out.setdefault(a[1] if group else None, [0, 0])
        if any(x == y for x, y in zip(a[4], b[4])):
            cell[0] += 1
            cell[1] += a[2] is not None and a[2] == b[2]
    return {k: tuple(v) for k, v in out.items()}


def made(seed, n=300, bands=16, cells=20):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        g, shop = (rng.choice(["a", "b", "c", None]) for _ in range(2))
        truth = None if rng.random() < 0.1 else int(rng.integers(0, 4))
        rows.append((i, g, truth, shop, rng.integers(0, cells, bands).tolist()))
    copies = [(1000 + k, *rows[k % 3][1:]) for k in range(120)]  # three rows with forty copies each
    return rows + copies


@pytest.mark.parametrize("tile", [bc.TILE, 37])
def test_against_all_pairs(spark, tile):
    rows = made(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    whole = bc.any_band_totals(df, "truth", tile=tile).first()
    assert (whole["candidates"], whole["found"]) == brute(rows)[None]
    by_group = {r["g"]: (r["candidates"], r["found"]) for r in bc.any_band_totals(df, "truth", ["g"], tile=tile).collect()}
    assert by_group == brute(rows, group=True)
    apart = bc.any_band_totals(df, "truth", different="shop", tile=tile).first()
    assert tuple(apart) == brute(rows, different=True)[None]
    both = {r["g"]: (r["candidates"], r["found"]) for r in bc.any_band_totals(df, "truth", ["g"], "shop", tile=tile).collect() if r["candidates"]}
    assert both == {k: v for k, v in brute(rows, group=True, different=True).items() if v[0]}


def test_few_rows(spark):
    assert tuple(bc.any_band_totals(spark.createDataFrame([], SCHEMA), "truth").first()) == (0, 0)
    one = spark.createDataFrame([(1, "a", 1, "x", [1, 2])], SCHEMA)
    assert tuple(bc.any_band_totals(one, "truth").first()) == (0, 0)
    assert bc.any_band_totals(one, "truth", ["g"]).collect() == []
    copies = spark.createDataFrame([(i, "a", 1, "x", [1, 2]) for i in range(1000)], SCHEMA)
    assert tuple(bc.any_band_totals(copies, "truth").first()) == (499500, 499500)


def test_same_as_inclusion_and_exclusion(spark):
    df = spark.createDataFrame(made(2, bands=6), SCHEMA).filter("truth is not null")
    want = lk.pair_totals(df, 6, "truth").first()
    got = bc.any_band_totals(df, "truth").first()
    assert (got["candidates"], got["found"]) == (want["candidates"], want["found"])


def test_signatures_in_one_pass(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 16)))], "id int, vector array<float>")
    cuts = [(16, 1), (8, 2), (4, 1), (1, 3)]
    every = {(r["id"], r["run"]): r["hashes"] for r in bc.all_signatures(df, ["id"], "vector", cuts, 16, 50).collect()}
    assert len(every) == 200
    for run, (bands, seed) in enumerate(cuts):
        for r in lk.signatures(df, "vector", bands, 16, 50, seed).collect():
            assert list(r["hashes"]) == every[r["id"], run]


def test_totals_of_many_bands(spark):
    rows = [r for r in made(4) if r[2] is not None]
    got = lk.pair_totals(spark.createDataFrame(rows, SCHEMA), 16, "truth", ["g"], "shop").first()
    by_group = brute(rows, group=True, different=True).values()
    same_truth = sum(a[2] == b[2] for a, b in combinations(rows, 2))
    assert tuple(got) == (sum(v[0] for v in by_group), sum(v[1] for v in by_group), same_truth)
