"""Hard negatives against brute force; bounds that hold; odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import negatives

SCHEMA = "vec_id long, label int, x array<bigint>"


def brute(rows, positives=5, negatives_wanted=3):
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    width = max((len(r[2]) for r in rows), default=0)
    full = [(i, r[0], r[1], list(r[2]) + [0] * (width - len(r[2]))) for i, r in enumerate(rows)]

    def order(s, r):
        return -s, r[1] is None, r[1] or 0

    out = []
    for a in full:
        if a[1] is None or a[1] % 50:
            continue
        scored = [(sum(p * q for p, q in zip(a[3], b[3])), b) for b in full if b[0] != a[0]]
        same = sorted(((s, b) for s, b in scored if b[2] == a[2]), key=lambda t: order(*t))[:positives]
        for ps, p in same:
            fit = sorted(((s, b) for s, b in scored if b[2] != a[2] and 50 * ps <= 100 * s <= 95 * ps), key=lambda t: order(*t))
            out += [(a[1], p[1], k + 1, n[1], ps, s) for k, (s, n) in enumerate(fit[:negatives_wanted])]
    return out


def mined(spark, rows, schema=SCHEMA):
    return [tuple(r) for r in negatives.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).collect()]


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-4, 5, (6, 20))
    # small numbers, so scores tie often; clusters of several labels, so the windows are full
    rows = [(int(i), int(rng.integers(0, 3)), (centres[i % 6] + rng.integers(-1, 2, 20)).tolist()) for i in range(0, 2500, 5)]
    got = mined(spark, rows)
    assert len(got) > 100 and same(got, brute(rows))


def test_small_batches(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROW_STEP", 7)
    monkeypatch.setattr(negatives, "ANCHOR_STEP", 2)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    rng = np.random.default_rng(3)
    rows = [(int(i), int(rng.integers(0, 2)), rng.integers(0, 4, 9).tolist()) for i in range(0, 1000, 5)]
    assert same(mined(spark, rows), brute(rows))


def test_odd_rows(spark):
    rows = [(0, 1, [2, 2]), (0, 1, [2, 2]), (50, 1, [2, 2, 0]), (1, 1, [3]), (2, 2, [1, 1]), (None, 2, [2, 1]), (None, 1, [2, 1]),
            (3, None, [9, 9]), (4, 2, None), (5, 2, []), (100, 3, [-1, -1]), (6, 3, [-2, 0]), (7, 2, [1, 1]), (7, 2, [1, 1])]
    got = mined(spark, rows)
    assert got and same(got, brute(rows))
    extra = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("number", "summary", "anchor", "place", "block", "score", "rank")])
    assert same(got, [tuple(r) for r in negatives.mine(extra, F.col("vec_id") % 50 == 0).collect()])
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1]), (2, 2, [1])]) == []


def test_very_large_numbers(spark):
    rows = [(0, 1, [2**29 + 1, 3]), (1, 1, [2**29 + 1, 5]), (2, 2, [2**28 + 3, 7]), (3, 2, [2**28 + 2, 7])]
    want = [(*r[:4], int(float(r[4])), int(float(r[5]))) for r in brute(rows)]  # rounded to doubles, as the docstring says
    assert same(mined(spark, rows), want)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(40, 64)) * 100, rng.normal(size=(60, 64)) * 100 + 30
    sa, sb, true = negatives.summaries(a), negatives.summaries(b), a @ b.T
    widths = []
    for level in range(3):
        lower, upper = negatives.bounds(sa, sb, level)
        assert (lower <= true).all() and (true <= upper).all()
        widths.append((upper - lower).mean())
    assert widths[0] > widths[1] > widths[2]


def test_filter_drops_far_rows_before_scoring(monkeypatch):
    """Rows that point away from the anchors never reach the exact scores."""
    rng = np.random.default_rng(5)
    near, far = rng.integers(90, 110, (50, 64)), rng.integers(-110, -90, (500, 64))
    x = np.concatenate([near, far]).astype(float)
    rows = negatives.Batch(np.arange(550), np.arange(550), np.zeros(550, dtype=int), x, negatives.summaries(x))
    block = negatives.Block(rows.number[:5], rows.label[:5], rows.x[:5], rows.summary[:5], np.zeros((5, 0)))
    scored = []
    plain = negatives.exact
    monkeypatch.setattr(negatives, "exact", lambda a, b: scored.append(len(b)) or plain(a, b))
    first, second = rows.cut(np.arange(50)), rows.cut(np.arange(50, 550))
    best = negatives.nearest(block, iter([first, second]), 5)
    assert scored == [50]
    want = np.sort(x[:5] @ x.T - np.where(np.arange(550) == np.arange(5)[:, None], 1e12, 0), axis=1)[:, ::-1][:, :5]
    assert (best.score == want).all()
