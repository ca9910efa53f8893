"""Fitted models at settings where the fit has a closed form that SQL can say."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import decompose as dc
from tallyloom.operators import forecast as fc
from tallyloom.operators import leastsq as ls
from tallyloom.operators import posterior as po
from tallyloom.operators import selection as sl
from tallyloom.operators import windows as win
from tallyloom.plans.panel_queries import r
from tallyloom.plans.registry import query
from tallyloom.plans.series_queries import KEYS, SERIES_SQL, price_series
from tallyloom.plans.standins import table
from tallyloom.plans.statistics_queries import POINTS_SQL, brand_sales, points
from tallyloom.session import stage


@query("spline_without_knots", "L1", f"""
with {POINTS_SQL}
select round(regr_intercept(x2, x1), 6) as b0, round(regr_slope(x2, x1), 6) as b1,
       round(avg(power(x2 - regr_i - regr_s * x1, 2)), 6) as mse
from points, (select regr_intercept(x2, x1) as regr_i, regr_slope(x2, x1) as regr_s from points)""")
def spline_without_knots(spark, sf_dir):
    """A linear spline without knots is the line of least squares."""
    data = stage(points(spark, sf_dir), "points")
    beta, fitted = ls.fit_basis(data, ls.linear_basis("x1", []), "x2")
    return fitted.agg(F.round(F.lit(float(beta[0])), 6).alias("b0"), F.round(F.lit(float(beta[1])), 6).alias("b1"),
                      r(F.avg((F.col("x2") - F.col("fitted")) * (F.col("x2") - F.col("fitted"))), 6).alias("mse"))


@query("stiff_smoothing_spline", "L2", f"""
with {POINTS_SQL} select round(regr_intercept(x2, x1), 4) as b0, round(regr_slope(x2, x1), 4) as b1 from points""")
def stiff_smoothing_spline(spark, sf_dir):
    """A smoothing spline whose penalty lets no slope change is the line of least squares."""
    data = stage(points(spark, sf_dir), "points")
    knots = [2.0, 5.0, 8.0]
    beta, _ = ls.fit_basis(data, ls.linear_basis("x1", knots), "x2", ls.smoothing_penalty(knots, 1e9, data.count()))
    return spark.createDataFrame([tuple(float(b) for b in beta[:2])], "b0 double, b1 double").select(
        F.round("b0", 4).alias("b0"), F.round("b1", 4).alias("b1"))


_TREND_SQL = SERIES_SQL + """,
n as (select partner, month, price, year(month) * 12 + month(month) as t,
             row_number() over (partition by partner order by month) as rn,
             count(*) over (partition by partner) as total from series)"""


def _with_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_series(spark, sf_dir).withColumn("t", F.year("month") * 12 + F.month("month"))


@query("exogenous_line_forecasts", "N3 N7", f"""
with {_TREND_SQL},
s as (select partner, month as origin, rn from n where rn > 24 and rn + 5 <= total),
fit as (select s.partner, s.origin, s.rn, regr_slope(a.price, a.t) as b, regr_intercept(a.price, a.t) as c
        from s join n a on a.partner = s.partner and a.rn between s.rn - 24 and s.rn - 1 group by 1, 2, 3)
select fit.partner, origin, n.rn - fit.rn + 1 as step, round(c + b * n.t, 2) as prediction
from fit join n on n.partner = fit.partner and n.rn between fit.rn and fit.rn + 5""")
def exogenous_line_forecasts(spark, sf_dir):
    """Order (0, 0, 0) with a constant and one exogenous column is a regression on that column."""
    windows = win.origins(_with_trend(spark, sf_dir), KEYS, "month", "price", 24, 6, exogenous=["t"])
    paths = fc.forecasts(fc.with_configs(windows, fc.configs([0], [0], [0], trend=["c"])), 6, exogenous=True)
    return fc.forecast_rows(paths, KEYS).select(
        "partner", "origin", F.col("step").cast("long").alias("step"), r("prediction", 2).alias("prediction"))


@query("first_order_residuals", "N10", f"""
with {_TREND_SQL},
fit as (select b.partner, regr_slope(b.price, a.price) as f, regr_intercept(b.price, a.price) as c
        from n a join n b on a.partner = b.partner and b.rn = a.rn + 1 group by 1)
select b.partner, b.month, round(b.price - c - f * a.price, 2) as residual
from fit join n b on b.partner = fit.partner join n a on a.partner = b.partner and b.rn = a.rn + 1""")
def first_order_residuals(spark, sf_dir):
    """Residuals of order (1, 0, 0) over whole series."""
    whole = price_series(spark, sf_dir).groupBy("partner").agg(
        F.array_sort(F.collect_list(F.struct("month", "price"))).alias("rows"))  # one row per month
    fitted = fc.fitted_values(fc.with_configs(
        whole.select("partner", F.col("rows.month").alias("months"), F.col("rows.price").alias("past")),
        fc.configs([1], [0], [0], trend=["c"])))
    rows = fitted.select("partner", F.explode(F.arrays_zip("months", "past", "fitted")).alias("z")).select(
        "partner", F.col("z.months").alias("month"), r(F.col("z.past") - F.col("z.fitted"), 2).alias("residual"))
    return rows.dropna()


@query("stl_parts_sum", "E25 U2", f"""
with {SERIES_SQL}, n as (select *, count(*) over (partition by partner) as total from series)
select partner, month, round(price, 2) as price from n where total >= 24""")
def stl_parts_sum(spark, sf_dir):
    """Trend, season and residual of a series add up to it."""
    parts = dc.stl(price_series(spark, sf_dir), KEYS, "month", "price")
    total = F.col("trend") + F.col("seasonal") + F.col("residual")
    return parts.filter(F.col("trend").isNotNull()).select("partner", "month", r(total, 2).alias("price"))


_BRAND_LINE_SQL = """
with b as (select p_brand as brand, ln(l_extendedprice / 1000) as y, ln(l_quantity) as q
           from lineitem join part on l_partkey = p_partkey)"""


def _line_draws(spark, sf_dir, **options) -> tuple[DataFrame, DataFrame]:
    sales = brand_sales(spark, sf_dir)
    xs = ["const", "logprice"]
    draws = po.regression_draws(ls.gram(sales, xs, "logsales", ["brand"]), xs, ["brand"], 2000, **options)
    lines = sales.groupBy("brand").agg(F.regr_slope("logsales", "logprice").alias("slope"))
    return po.kept_draws(draws, 500, 1), lines


@query("posterior_near_least_squares", "M1 M4", f"""
{_BRAND_LINE_SQL} select brand, round(regr_slope(y, q), 6) as slope, true as near from b group by brand""")
def posterior_near_least_squares(spark, sf_dir):
    """The posterior mean of a slope lies within a quarter of its deviation of least squares."""
    draws, lines = _line_draws(spark, sf_dir)
    means = po.summary(draws.filter("param = 'logprice'"), ["brand"])
    return means.join(lines, "brand").select(
        "brand", r("slope", 6).alias("slope"), (F.abs(F.col("mean") - F.col("slope")) <= 0.25 * F.col("sd")).alias("near"))


@query("bounded_posterior_above_one", "M2", f"""
{_BRAND_LINE_SQL} select brand, cast(1500 as bigint) as draws, true as above, true as pushed from b group by brand""")
def bounded_posterior_above_one(spark, sf_dir):
    """Draws of a coefficient bounded at one stay at or above it, and near it where least squares lies below."""
    draws, lines = _line_draws(spark, sf_dir, bounded="logprice", bound=1.0)
    held = draws.filter("param = 'logprice'").groupBy("brand").agg(
        F.count(F.lit(1)).alias("draws"), F.min("value").alias("least"), F.avg("value").alias("mean"))
    return held.join(lines, "brand").select(
        "brand", "draws", (F.col("least") >= 1).alias("above"),
        (F.col("mean") >= F.greatest(F.lit(1.0), F.col("slope") - 0.1)).alias("pushed"))


def labelled_texts(spark: SparkSession, sf_dir: str, flag) -> DataFrame:
    """(id, label, x, features) of the labelled documents, x one 0/1 feature."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), flag.cast("int").alias("x"))
    return labels.join(docs, "id").withColumn("features", array_to_vector(F.array(F.col("x").cast("double"))))


@query("stump_predictions", "N14 N20", """
with d as (select doc_id as id, quality, cast(contains(text, '!!') as integer) as x from labels join documents using (doc_id)),
cells as (select x, avg(quality) as p from d group by x)
select id, x, cast(p > 0.5 as integer) as prediction from d join cells using (x)""")
def stump_predictions(spark, sf_dir):
    """A tree of depth one on one 0/1 feature predicts the commoner label of each value."""
    data = stage(labelled_texts(spark, sf_dir, F.contains("text", F.lit("!!"))), "labelled")
    model = sl.fit_classifier(data, "tree", {"depth": 1, "max_features": None}, 1, 2)
    return sl.predict(model, data, ["id", "x"]).withColumn("prediction", F.col("prediction").cast("int"))


@query("one_tree_forest", "N15 N20", """
with d as (select doc_id as id, quality, cast(contains(text, '!!') as integer) as x from labels join documents using (doc_id)),
cells as (select x, avg(quality) as p from d group by x)
select id, x, cast(p > 0.5 as integer) as prediction from d join cells using (x)""")
def one_tree_forest(spark, sf_dir):
    """An unresampled forest of one tree on one 0/1 feature is the stump."""
    data = stage(labelled_texts(spark, sf_dir, F.contains("text", F.lit("!!"))), "labelled")
    model = sl.fit_classifier(data, "tree", {"depth": 1, "max_features": "sqrt"}, 1, 2)
    return sl.predict(model, data, ["id", "x"]).withColumn("prediction", F.col("prediction").cast("int"))


@query("logit_cells", "N17", """
with d as (select doc_id as id, quality, cast(n_chars % 2 = 1 as integer) as x from labels join documents using (doc_id))
select x, count(*) as n, round(avg(quality), 3) as p from d group by x""")
def logit_cells(spark, sf_dir):
    """An unpenalised logit on one 0/1 feature gives the share of ones of each value."""
    data = stage(labelled_texts(spark, sf_dir, F.col("n_chars") % 2 == 1), "labelled")
    model = sl.fit_classifier(data, "logit", {"lambda_inverse": 1e12, "iterations": 200}, 1, 2)
    scored = model.transform(data).withColumn("p", vector_to_array("probability")[1])
    return scored.groupBy("x").agg(F.count(F.lit(1)).alias("n"), r(F.avg("p"), 3).alias("p"))


@query("stored_product_panel", "A6 A12", """
select o_orderpriority as feature, cast(date_trunc('month', o_orderdate) as date) as month, count(*) as orders
from orders where o_orderstatus = 'F' group by 1, 2""")
def stored_product_panel(spark, sf_dir):
    """One product of a stored panel: the filter reaches only its folder."""
    from tallyloom.session import scratch_path
    from tallyloom.sources import readers, sinks

    path = scratch_path(spark, "panel")
    cells = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderstatus").alias("product"), F.col("o_orderpriority").alias("feature"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    sinks.write_by(cells, path, ["product"])
    return readers.panel(spark, path, "feature string, month date, orders bigint, product string", "F").drop("product")


@query("stl_line_and_cycle", "E25 U2", f"""
with {SERIES_SQL},
n as (select partner, month, row_number() over (partition by partner order by month) as rn,
             count(*) over (partition by partner) as total, avg(price) over (partition by partner) as level from series)
select partner, month, round(level + 0.01 * level * rn, 3) as trend, round(0.1 * level * ((rn * 5) % 12 - 5.5), 3) as seasonal,
       0.0 as residual
from n where total >= 24""")
def stl_line_and_cycle(spark, sf_dir):
    """A line plus a cycle of twelve values with mean zero comes apart into just these."""
    from pyspark.sql import Window

    own = Window.partitionBy(*KEYS)  # one short series
    rn, level = F.row_number().over(own.orderBy("month")), F.avg("price").over(own)
    series = price_series(spark, sf_dir).select("partner", "month", rn.alias("rn"), level.alias("level"))
    made = series.withColumn("y", F.col("level") * (1 + 0.01 * F.col("rn") + 0.1 * ((F.col("rn") * 5) % 12 - 5.5)))
    parts = dc.stl(made, KEYS, "month", "y").filter(F.col("trend").isNotNull())
    return parts.select("partner", "month", r("trend", 3).alias("trend"), r("seasonal", 3).alias("seasonal"),
                        F.abs(r("residual", 3)).alias("residual"))


@query("additive_lines", "L9", f"""
with {POINTS_SQL},
d as (select id, x1, c_nationkey as x3, x2 as y from points join customer on c_custkey = id),
m as (select regr_sxx(y, x1) as xx, regr_sxx(y, x3) as zz, regr_sxy(y, x1) as xy, regr_sxy(y, x3) as zy,
             regr_sxy(x1, x3) as xz, avg(y) as my, avg(x1) as mx, avg(x3) as mz from d)
select id, round(my, 6) as constant, round((xy * zz - zy * xz) / (xx * zz - xz * xz) * (x1 - mx), 6) as g_x1,
       round((zy * xx - xy * xz) / (xx * zz - xz * xz) * (x3 - mz), 6) as g_x3
from d, m""")
def additive_lines(spark, sf_dir):
    """Without knots and penalty the parts of the additive model are those of a regression on two columns."""
    data = stage(points(spark, sf_dir).join(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("double").alias("x3")), "id"), "points")
    constant, parts = ls.additive_model(data, ["x1", "x3"], "x2", {"x1": [], "x3": []}, lam=0.0)
    return parts.select("id", r(F.lit(constant), 6).alias("constant"), r("g_x1", 6).alias("g_x1"), r("g_x3", 6).alias("g_x3"))


_COMMONER_SQL = """
with d as (select doc_id as id, quality, cast(contains(text, '!!') as integer) as x from labels join documents using (doc_id)),
cells as (select x, avg(quality) as p from d group by x)
select id, x, cast(p > 0.5 as integer) as prediction from d join cells using (x)"""


def _on_a_flag(spark, sf_dir, kind: str, h: dict) -> DataFrame:
    data = stage(labelled_texts(spark, sf_dir, F.contains("text", F.lit("!!"))), "labelled")
    model = sl.fit_classifier(data, kind, h, 1, 2)
    return sl.predict(model, data, ["id", "x"]).withColumn("prediction", F.col("prediction").cast("int"))


@query("forest_on_a_flag", "N15 N20", _COMMONER_SQL)
def forest_on_a_flag(spark, sf_dir):
    """Twenty resampled trees on one 0/1 feature vote for the commoner label of each value."""
    return _on_a_flag(spark, sf_dir, "forest", {"n_estimators": 20, "depth": 2, "criterion": "entropy", "max_features": None})


@query("boosting_on_a_flag", "N16 N20", _COMMONER_SQL)
def boosting_on_a_flag(spark, sf_dir):
    """Ten boosted trees on one 0/1 feature predict the commoner label of each value."""
    return _on_a_flag(spark, sf_dir, "boost", {"n_estimators": 10, "depth": 1, "max_features": None})


@query("net_on_a_flag", "N18 N20", _COMMONER_SQL)
def net_on_a_flag(spark, sf_dir):
    """A small net on one 0/1 feature predicts the commoner label of each value."""
    return _on_a_flag(spark, sf_dir, "net", {"hidden": [4], "iterations": 200})
