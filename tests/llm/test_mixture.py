"""Targets by water filling, exact cuts, repeats."""

import pytest

from tallyloom.llm import mixture


def plain_targets(sizes, share, epochs, weights):
    """Excess of full sources shared again by weight until none is above its cap."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > epochs * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = epochs * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 1000, "b": 5, "c": 90, "d": 3000, None: 17}, {"a": 10}, {"a": 0, "b": 0}, {"b": 1, "a": 100_000, "c": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixture.targets(df).collect()}
    for s, t in plain_targets(sizes, 1.5, 2, (3, 1, 2)).items():
        assert got[s] == pytest.approx(t)


def test_cuts_are_exact(spark, monkeypatch):
    monkeypatch.setattr(mixture, "SLICE_ROWS", 7)
    docs = spark.createDataFrame(
        [(i, "w " * (i % 13), "hot" if i % 3 else f"s{i % 9}") for i in range(600)] + [(5, None, None), (5, "a b c", None), (5, "a b c", None)],
        "doc_id long, text string, source string")
    rows = mixture.mix(docs).collect()
    assert len(rows) == 603
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["epochs"] * r["size"] <= r["taken"]
        by.setdefault(r["source"], []).append(r)
    for source, own in by.items():
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
        assert sum(r["taken"] not in (r["epochs"] * r["size"], (r["epochs"] + 1) * r["size"]) for r in own) <= 1
    assert sorted(map(repr, rows)) == sorted(map(repr, mixture.mix(docs.repartition(5)).collect()))


def test_rows_without_an_id_are_folded(spark, monkeypatch):
    """A third of all rows without an id, and one id in thousands of rows: few rows take one place."""
    monkeypatch.setattr(mixture, "SLICE_ROWS", 50)
    monkeypatch.setattr(mixture, "COPIES", 7)
    rows = [(None, "w " * (i % 5), "a") for i in range(500)] + [(3, "x y", "a")] * 400 + [(i, "w " * (i % 9), "b") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    folded = []
    stored = mixture.stage
    monkeypatch.setattr(mixture, "stage", lambda df, name: folded.append((name, stored(df, name))) or folded[-1][1])
    got = mixture.mix(docs).collect()
    held = dict(folded)["folded"]
    assert held.groupBy("source", "place").count().agg({"count": "max"}).first()[0] == 5  # one row per size
    assert len(got) == 1500
    for source in "ab":
        own = [r for r in got if r["source"] == source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"]) and sum(r["size"] for r in own) == own[0]["source_size"]
        assert sum(r["taken"] not in (r["epochs"] * r["size"], (r["epochs"] + 1) * r["size"]) for r in own) <= 1
    assert sorted(map(repr, got)) == sorted(map(repr, mixture.mix(docs.repartition(3)).collect()))
