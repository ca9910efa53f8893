import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import scalar as sc
from tallyloom.operators import fill, ordered, panel, scale


def month(i):
    return dt.date(2020 + i // 12, i % 12 + 1, 1)


def series(spark, values, partner="A"):
    return spark.createDataFrame([(partner, month(i), v) for i, v in enumerate(values)],
                                 "partner string, month date, x double")


def column(df, name, order="month"):
    return [r[name] for r in df.orderBy(order).collect()]


@pytest.mark.parametrize("values", [
    [None, 1.0, None, None, 4.0, None], [None, None], [2.0], [1.0, None, None, 7.0, None, 9.0, None]])
def test_interpolation_is_by_position(spark, values):
    out = fill.interpolate(series(spark, values), ["x"], ["partner"], "month")
    expected = pd.Series(values, dtype=float).interpolate().tolist()
    assert [None if np.isnan(e) else pytest.approx(e) for e in expected] == column(out, "x")


def test_fill_and_change(spark):
    df = series(spark, [None, 2.0, None, 4.0, None])
    out = df.withColumn("f", fill.forward_then_backward("x", ["partner"], "month")).withColumn(
        "c", fill.percent_change("x", ["partner"], "month"))
    assert column(out, "f") == [2.0, 2.0, 2.0, 4.0, 4.0]
    assert column(out, "c") == [0.0] * 5
    both = series(spark, [2.0, 3.0, 0.0, 5.0]).withColumns({
        "c": fill.percent_change("x", ["partner"], "month"), "d": fill.difference("x", ["partner"], "month")})
    assert column(both, "c") == [0.0, 0.5, -1.0, 0.0]  # a change from zero is undefined
    assert column(both, "d") == [0.0, 1.0, -3.0, 5.0]


def test_year_to_months(spark):
    df = spark.createDataFrame([("A", 2019, 12.0), ("A", 2020, 24.0)], "partner string, year int, gdp double")
    out = column(fill.year_to_months(df, ["gdp"], ["partner"], "year"), "gdp")
    assert out[:13] == pytest.approx([12.0 + i for i in range(13)])
    assert out[13:] == [24.0] * 11


def test_zero_quantity_has_no_price(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0), (None, 1.0)], "v double, q double")
    assert [r[0] for r in df.select(sc.unit_price("v", "q")).collect()] == [None, 2.5, None]


def test_indicator_pivot_drops_half_rows_and_duplicates(spark):
    rows = [("A", month(0), "quantity", 2.0), ("A", month(0), "quantity", 2.0), ("A", month(0), "value", 8.0),
            ("B", month(0), "value", 3.0)]
    df = spark.createDataFrame(rows, "partner string, month date, indicator string, value double")
    out = panel.pivot_indicators(df, ["partner", "month"], ["quantity", "value"]).collect()
    assert [tuple(r) for r in out] == [("A", month(0), 2.0, 8.0)]


def test_densify_uses_seen_months_or_the_calendar(spark):
    df = spark.createDataFrame([("A", month(0), 1.0), ("B", month(2), 2.0)], "partner string, month date, x double")
    assert panel.densify(df, ["partner"]).count() == 4
    assert panel.densify(df, ["partner"], calendar=True).count() == 6
    assert panel.densify(df.limit(0), ["partner"]).count() == 0


def test_group_with_a_bad_value_leaves(spark):
    df = spark.createDataFrame([("A", "1"), ("A", ".."), ("B", "2.5")], "k string, v string")
    assert [tuple(r) for r in sc.drop_groups_with_bad_value(df, "k", "v").collect()] == [("B", "2.5")]


def test_pareto_keeps_the_crossing_row(spark):
    df = spark.createDataFrame([("A", 50.0), ("B", 30.0), ("C", 15.0), ("D", 5.0)], "k string, q double")
    assert {r["k"] for r in panel.top_partners(df, "k", "q", 0.8).collect()} == {"A", "B"}  # exactly 0.8
    assert {r["k"] for r in panel.top_partners(df, "k", "q", 0.81).collect()} == {"A", "B", "C"}
    tail = panel.tail_share(df.withColumn("g", F.lit(1)), ["g"], "k", "q", 0.8)
    assert {r["k"] for r in tail.collect()} == {"B", "C", "D"}


def test_outliers_and_scaling(spark):
    values = [float(i % 5) for i in range(60)] + [1000.0]
    df = series(spark, values)
    masked = column(scale.mask_outliers(df, ["x"]), "x")
    assert masked[-1] is None and masked[:-1] == values[:-1]
    chain = scale.Chain(scale.Logged(["x"], 10.0), scale.Scaled(scale.fit_standard(df, ["x"]), ["x"]))
    shifted = df.withColumn("x", F.col("x") + 1)
    back = column(chain.reverse(chain(shifted)), "x")
    assert back == pytest.approx([v + 1 for v in values], rel=1e-6)
    flat = series(spark, [3.0, 3.0])
    assert column(scale.apply_scale(flat, scale.fit_standard(flat, ["x"]), ["x"]), "x") == [0.0, 0.0]
    assert column(scale.apply_scale(flat, scale.fit_minmax(flat, ["x"]), ["x"]), "x") == [None, None]


@pytest.mark.parametrize("descending", [False, True])
def test_running_with_a_hot_value(spark, descending):
    rng = np.random.default_rng(1)
    values = [7.0] * 400 + [float(v) for v in rng.integers(0, 50, 800)]
    pdf = pd.DataFrame({"id": rng.permutation(1200), "v": values, "w": rng.integers(1, 9, 1200)})
    df = spark.createDataFrame(pdf)
    got = ordered.running(df, "v", ["id"], {"total": "w"}, descending, slice_rows=75).toPandas().sort_values("position")
    want = pdf.sort_values(["v", "id"], ascending=[not descending, True])
    assert got["id"].tolist() == want["id"].tolist()
    assert got["position"].tolist() == list(range(1, 1201))
    assert got["total"].tolist() == want["w"].cumsum().tolist()
    sliced = ordered.with_slices(df, "v", ["id"], descending, 75).groupBy(ordered.SLICE).count()
    assert sliced.agg(F.max("count")).first()[0] < 250  # 400 equal values are cut up


@pytest.mark.parametrize("descending", [False, True])
def test_running_keeps_nulls_and_nan(spark, descending):
    values = [None, 5.0, float("nan"), None, 3.0, float("inf"), 3.0, None]
    df = spark.createDataFrame([(i, v, None if i == 1 else i) for i, v in enumerate(values)], "id long, v double, w long")
    got = ordered.running(df, "v", ["id"], {"total": "w"}, descending, slice_rows=2).collect()
    order = [0, 3, 7, 4, 6, 1, 5, 2] if not descending else [2, 5, 1, 4, 6, 0, 3, 7]
    assert [r["id"] for r in sorted(got, key=lambda r: r["position"])] == order
    totals, own = [], 0
    for i in order:
        own += 0 if i == 1 else i
        totals.append(own)
    assert [r["total"] for r in sorted(got, key=lambda r: r["position"])] == totals


def test_running_with_long_keys_and_a_text_tie(spark):
    """Longs above 2^53 stay apart; one value in 90 % of the rows is cut along a text."""
    big = [2**53 + i for i in (3, 1, 2, 0)]
    df = spark.createDataFrame([(v,) for v in big], "v long")
    assert [r["v"] for r in ordered.running(df, "v", [], slice_rows=1).orderBy("position").collect()] == sorted(big)
    rows = [(f"k{i:05d}", 1.0 if i % 10 else float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = ordered.running(df, "v", ["k"], slice_rows=200).orderBy("position").collect()
    assert [(r["k"], r["v"]) for r in got] == sorted(rows, key=lambda r: (r[1], r[0]))
    assert ordered.with_slices(df, "v", ["k"], slice_rows=200).groupBy(ordered.SLICE).count().agg(F.max("count")).first()[0] < 1000


def test_cumulative_share_with_a_null(spark):
    df = spark.createDataFrame([("A", 5.0), ("B", 3.0), ("C", None)], "k string, x double")
    got = {r["k"]: (r["position"], r["cumulative"]) for r in panel.cumulative_share(df, "k", "x").collect()}
    assert got == {"A": (1, 5.0), "B": (2, 8.0), "C": (3, 8.0)}


def test_exact_quantiles(spark):
    values = np.r_[np.full(300, 2.0), np.random.default_rng(0).normal(size=701)]
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    row = ordered.quantiles(df, "x", {"a": 0.1, "b": 0.5, "c": 0.9, "lo": 0.0, "hi": 1.0}).first()
    assert list(row) == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.9, 0, 1])))


def test_first_per_key_and_patch(spark):
    df = spark.createDataFrame([("A", 2, "x"), ("A", 1, "y"), ("B", 5, "z")], "k string, o int, v string")
    assert sorted(tuple(r) for r in panel.first_per_key(df, ["k"], ["o"]).collect()) == [("A", 1, "y"), ("B", 5, "z")]
    a = spark.createDataFrame([("A", None), ("B", 1.0)], "k string, v double")
    b = spark.createDataFrame([("A", 9.0), ("B", 8.0), ("C", 7.0)], "k string, v double")
    assert sorted(tuple(r) for r in panel.patch(a, b, ["k"], ["v"]).collect()) == [("A", 9.0), ("B", 1.0), ("C", 7.0)]


def test_fill_down_a_file(spark):
    rows = [(i, {0: None, 1: "A", 5: "B"}.get(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "row long, label string")
    out = fill.down_the_file(df, "label", "row").orderBy("row").collect()
    assert [r["label"] for r in out] == [None] + ["A"] * 4 + ["B"] * 3


def test_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    assert {r["bin"]: r["n"] for r in scale.histogram(df, "x", 5).collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "partner string, month date, x double")
    assert ordered.running(df, "x", ["partner"]).count() == 0
    assert ordered.quantiles(df, "x", {"a": 0.5}).first()["a"] is None
    assert panel.top_partners(df, "partner", "x").count() == 0
    assert fill.interpolate(df, ["x"], ["partner"], "month").count() == 0
    assert scale.mask_outliers(df, ["x"]).count() == 0
    assert scale.apply_scale(df, scale.fit_standard(df, ["x"]), ["x"]).count() == 0


def test_one_row_series(spark):
    df = series(spark, [4.0])
    assert column(fill.interpolate(df, ["x"], ["partner"], "month"), "x") == [4.0]
    assert column(scale.mask_outliers(df, ["x"]), "x") == [4.0]  # no deviation, so no outlier
    assert ordered.quantiles(df, "x", {"a": 0.3}).first()["a"] == 4.0
