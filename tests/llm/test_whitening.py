"""Whitening against numpy; distinct vectors, odd rows, few directions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import whitening
from tallyloom.llm.queries import QUERIES


def collected(df):
    return [tuple(r) for r in df.orderBy("vec_id", "component").collect()]


def brute(x):
    distinct = np.unique(x, axis=0)
    mean = distinct.mean(axis=0)
    values, vectors = np.linalg.eigh((distinct - mean).T @ (distinct - mean) / len(distinct))
    values, vectors = values[::-1], vectors[:, ::-1]
    return len(distinct), values, (x - mean) @ vectors


def check(got, ids, x, components):
    n, values, projected = brute(x)
    sums = np.unique(x, axis=0).astype(int).sum(axis=0)
    assert len(got) == len(ids) * components
    for k, (vec, component, count, deviation, whitened, explained, error) in enumerate(got):
        row, c = divmod(k, components)
        assert (vec, component, count) == (ids[row], c + 1, n) and error < 1e-8
        assert deviation == sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[row], sums))
        assert abs(whitened) == pytest.approx(abs(projected[row, c]) / np.sqrt(values[c]), abs=1e-7)
        assert explained == pytest.approx(values[c] / values.sum(), rel=1e-8)
    for c in range(components):  # one sign for all rows
        signs = [np.sign(got[k][4] * projected[k // components, c]) for k in range(c, len(got), components) if abs(got[k][4]) > 1e-6]
        assert len(set(signs)) == 1


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([[np.floor(64 * np.float64(c)) + 1_000_000 for c in r["embedding"]] for r in rows])
    check(collected(QUERIES["op13_embedding_whitening"](spark, folder)), [r["vec_id"] for r in rows], x, 16)


def test_blocks_and_splits(spark, monkeypatch):
    """Several row blocks, column blocks and splits give the same."""
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 8)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    monkeypatch.setattr(whitening, "SPLIT_ROWS", 16)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1000, (70, 7)) * np.arange(1, 8)
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    check(collected(whitening.whiten(spark.createDataFrame(rows, "vec_id long, x array<bigint>").repartition(5), 4)), list(range(70)), x, 4)


def test_copies_count_once_in_the_fit(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 50, (30, 5))
    x = np.concatenate([base, np.repeat(base[:1], 40, axis=0)])
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    check(collected(whitening.whiten(spark.createDataFrame(rows, "vec_id long, x array<bigint>"), 3)), list(range(70)), x, 3)


def test_odd_rows(spark):
    vectors = [(1, [1, 0]), (1, [1, 0]), (None, [0, 1]), (2, [5, 5]), (3, None), (4, []), (5, [1, 2, 3])]
    df = spark.createDataFrame(vectors, "vec_id long, x array<bigint>")
    got = whitening.whiten(df).collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["1", "1", "1", "1", "2", "2", "None", "None"]
    clash = df.select("*", *[F.lit("x").alias(c) for c in ("i", "y", "z", "first", "n", "component", "deviation", "_part", "_at")])
    assert sorted(map(repr, whitening.whiten(clash).collect())) == sorted(map(repr, got))
    assert whitening.whiten(df.filter("false")).collect() == []
    assert whitening.whiten(df.filter("vec_id = 1")).collect() == []  # one distinct vector spans nothing
    line = spark.createDataFrame([(i, [i, 2 * i]) for i in range(5)], "vec_id long, x array<bigint>")
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}


def test_scaled_drops_what_is_not_finite(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, [0.5, -0.001]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, None), (6, [])],
                               "vec_id long, embedding array<float>")
    assert [tuple(r) for r in whitening.scaled(df).collect()] == [(1, [1_000_032, 999_999])]
