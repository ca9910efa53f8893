"""Running sums inside groups that are cut into slices."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import ordered, panel


def hot(n=2000, seed=1):
    """Nine tenths of the rows in one group, a null group, and values that tie and are null."""
    rng = np.random.default_rng(seed)
    group = np.where(rng.random(n) < 0.9, "hot", rng.choice(["a", "b", "z"], n)).astype(object)
    group[::37] = None
    value = rng.integers(0, 30, n).astype(float).astype(object)
    value[::11] = None
    return [(int(i), g, v, int(w)) for i, g, v, w in zip(rng.permutation(n), group, value, rng.integers(1, 9, n))]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("slice_rows", [40, 10**6])
def test_hot_group(spark, descending, slice_rows):
    rows = hot()
    df = spark.createDataFrame(rows, "id long, g string, v double, w long")
    got = ordered.running_by(df, ["g"], "v", ["id"], {"upto": "w"}, {"whole": "w", "known": F.when(F.col("v").isNotNull(), 1)},
                             descending, slice_rows=slice_rows).collect()
    want = {}
    for g in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == g]
        mine.sort(key=lambda r: ((r[2] is None) if descending else (r[2] is not None), (-(r[2] or 0) if descending else (r[2] or 0)), r[0]))
        total = 0
        for k, r in enumerate(mine):
            total += r[3]
            want[r[0]] = (k + 1, total, sum(x[3] for x in mine), sum(x[2] is not None for x in mine))
    assert len(got) == len(rows)
    assert all((r["position"], r["upto"], r["whole"], r["known"]) == want[r["id"]] for r in got)


def test_slices_are_bounded_whatever_the_groups(spark, monkeypatch):
    """The windows see slices, not groups: a group with nine tenths of the rows is spread over many."""
    seen = []
    plain = ordered.stage
    monkeypatch.setattr(ordered, "stage", lambda df, name: seen.append(plain(df, name)) or seen[-1])
    df = spark.createDataFrame(hot(4000), "id long, g string, v double, w long")
    ordered.running_by(df, ["g"], "v", ["id"], slice_rows=100)
    sizes = [r["count"] for r in seen[-1].groupBy(ordered.SLICE).count().collect()]
    assert len(sizes) > 25 and max(sizes) < 400


def test_two_group_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", None, 2.0), (2, "a", None, 1.0), (3, "a", "x", 5.0)], "id long, g string, h string, v double")
    got = {r["id"]: (r["position"], r["s"], r["t"]) for r in ordered.running_by(df, ["g", "h"], "v", ["id"], {"s": "v"}, {"t": "v"}, slice_rows=1).collect()}
    assert got == {2: (1, 1.0, 3.0), 1: (2, 3.0, 3.0), 3: (1, 5.0, 5.0)}
    assert ordered.running_by(df.limit(0), ["g"], "v", ["id"], {"s": "v"}).collect() == []


def test_tail_and_top_of_a_hot_group(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [("hot", f"k{i:04d}", float(rng.integers(1, 100))) for i in range(900)] + [("cold", f"k{i}", float(i + 1)) for i in range(9)]
    pdf = pd.DataFrame(rows, columns=["g", "k", "q"])
    monkeypatch.setattr(ordered.running_by, "__defaults__", (None, None, False, "position", 50, True))
    df = spark.createDataFrame(pdf)
    tail = {(r["g"], r["k"]): r["share"] for r in panel.tail_share(df, ["g"], "k", "q", 0.8).collect()}
    ordered_rows = pdf.sort_values(["g", "q", "k"], ascending=[True, False, True])
    share = ordered_rows.groupby("g")["q"].cumsum() / ordered_rows.groupby("g")["q"].transform("sum")
    want = {(g, k): s for g, k, s in zip(ordered_rows["g"], ordered_rows["k"], share) if s >= 0.8}
    assert tail == pytest.approx(want) and len(want) > 100
    top = panel.top_means(df, "g", "k", "q", panel.names(df, "g"), 5).orderBy("rank").collect()
    assert [r["hot"] for r in top] == ordered_rows[ordered_rows["g"] == "hot"]["k"].head(5).tolist()
    assert [r["cold"] for r in top] == ["k8", "k7", "k6", "k5", "k4"]


def test_names_are_bounded(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("c"))
    assert len(panel.names(df, "c", 20)) == 20
    with pytest.raises(ValueError):
        panel.names(df, "c", 19)
