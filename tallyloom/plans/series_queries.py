"""Windows, decomposition, backtests and error measures on the monthly price series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import rates
from tallyloom.functions.scalar import log_base, pow_base
from tallyloom.operators import decompose as dc
from tallyloom.operators import fill, forecast as fc, windows as win
from tallyloom.operators.scale import Scaled, fit_standard, histogram
from tallyloom.plans.panel_queries import DENSE_SQL, INTERPOLATE_SQL, dense_cells, r
from tallyloom.plans.registry import query
from tallyloom.session import stage

KEYS = ["partner"]


def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(partner, month, price, quantity) without gaps."""
    dense = dense_cells(spark, sf_dir).select("partner", "month", "price", "quantity")
    return fill.interpolate(dense, ["price", "quantity"], KEYS, "month").dropna()


SERIES_SQL = DENSE_SQL + "," + INTERPOLATE_SQL.format(source="dense", c="price") + """,
series as (select partner, month, v as price from interpolated where v is not null)
"""


@query("chronological_split", "E16", f"""
with {SERIES_SQL},
i as (select *, row_number() over (partition by partner order by month) - 1 as i,
             cast(floor(count(*) over (partition by partner) * 0.7) as integer) as a,
             cast(floor(count(*) over (partition by partner) * 0.9) as integer) as b from series)
select partner, month, 'train' as split from i where i < a
union all select partner, month, 'val' from i where i >= a - 8 and i < b
union all select partner, month, 'test' from i where i >= b - 8""")
def chronological_split(spark, sf_dir):
    parts = win.chronological_split(
        price_series(spark, sf_dir), KEYS, "month", 0.7, 0.9, connect=True, window=9)
    return parts.select("partner", "month", "split")


@query("supervised_windows", "E17 E18", f"""
with {SERIES_SQL}, q as (
  select d.partner, d.month, d.price, c.quantity from series d join dense c using (partner, month)),
n as (select *, row_number() over (partition by partner order by month) as rn,
             count(*) over (partition by partner) as total from series),
starts as (select partner, rn, month as start from n where rn + 8 <= total)
select s.partner, s.start, 'inputs' as role, n.rn - s.rn + 1 as step, n.month, round(n.price, 4) as price
from starts s join n on n.partner = s.partner and n.rn between s.rn and s.rn + 5
union all
select s.partner, s.start, 'labels', n.rn - s.rn - 6, n.month, round(n.price, 4)
from starts s join n on n.partner = s.partner and n.rn between s.rn + 7 and s.rn + 8""")
def supervised_windows(spark, sf_dir):
    inputs = win.input_columns(["price", "quantity"], ["quantity"])
    made = win.supervised_windows(
        price_series(spark, sf_dir), KEYS, "month", inputs, ["price"], 6, 2, 3)
    both = win.window_rows(made, KEYS, ["inputs", "labels"])
    return both.withColumns({"price": r("price"), "step": F.col("step").cast("long")})


@query("sliding_sequences", "E19", f"""
with {SERIES_SQL},
n as (select *, row_number() over (partition by partner order by month) as rn,
             count(*) over (partition by partner) as total from series)
select a.partner, a.month as start, 'table' as form, round(sum(b.price), 3) as total
from n a join n b on a.partner = b.partner and b.rn between a.rn and a.rn + 3
where a.rn + 3 <= a.total group by a.partner, a.month
union all
select a.partner, a.month, 'univariate', round(sum(b.price), 3)
from n a join n b on a.partner = b.partner and b.rn between a.rn and a.rn + 3
where a.rn + 4 <= a.total group by a.partner, a.month""")
def sliding_sequences(spark, sf_dir):
    series = price_series(spark, sf_dir)

    def totals(form: str, drop_last: bool) -> DataFrame:
        runs = win.sequences(series, KEYS, "month", ["price"], 4, drop_last)
        total = F.aggregate("rows", F.lit(0.0), lambda a, x: a + x["price"])
        return runs.select("partner", "start", F.lit(form).alias("form"), r(total, 3).alias("total"))

    return totals("table", False).unionByName(totals("univariate", True))


@query("lagged_design", "B18 E21 E4", f"""
with {SERIES_SQL}
select partner, month, 1.0::double as const, round(lag(price, 1) over w, 4) as price_lag1,
       round(lag(price, 2) over w, 4) as price_lag2, round(lag(price, 3) over w, 4) as price_lag3,
       round(100 * coalesce(price - lag(price, 1) over w, 0), 2) as change
from series window w as (partition by partner order by month)""")
def lagged_design(spark, sf_dir):
    design = win.lagged(price_series(spark, sf_dir), KEYS, "month", "price", 3)
    change = r(100 * fill.difference("price", KEYS, "month"), 2)
    return design.select("partner", "month", "const", *[r(f"price_lag{i}").alias(f"price_lag{i}") for i in (1, 2, 3)],
                         change.alias("change"))


@query("rolling_metric", "E22 U3", f"""
with {SERIES_SQL},
n as (select *, count(*) over w as c, avg(price) over w as m, max(price) over w as hi from series
      window w as (partition by partner order by month rows between 11 preceding and current row))
select partner, month, case when c = 12 then round(hi - m, 3) end as score from n""")
def rolling_metric(spark, sf_dir):
    def peak_over_mean(run):
        return F.array_max(run) - F.aggregate(run, F.lit(0.0), lambda a, x: a + x) / F.size(run)

    scored = win.rolling_apply(price_series(spark, sf_dir), KEYS, "month", "price", 12, peak_over_mean)
    return scored.select("partner", "month", r("score", 3).alias("score"))


# The mean of the last w months as a forecaster, rolling by one month, in SQL.
ORIGINS_SQL = SERIES_SQL + """,
n as (select *, row_number() over (partition by partner order by month) as rn,
             count(*) over (partition by partner) as total from series),
starts as (select partner, month as origin, rn from n where rn > 24 and rn + 5 <= total),
means as (
  select s.partner, s.origin, s.rn, w.config, avg(n.price) as prediction
  from starts s, (values (1), (3), (6), (12)) w(config), n
  where n.partner = s.partner and n.rn between s.rn - w.config and s.rn - 1
  group by s.partner, s.origin, s.rn, w.config),
paths as (
  select m.partner, m.origin, m.config, n.rn - m.rn + 1 as step, n.month as target, n.price as label, m.prediction
  from means m join n on n.partner = m.partner and n.rn between m.rn and m.rn + 5)
"""
WIDTHS = [1, 3, 6, 12]


def mean_paths(spark, sf_dir) -> DataFrame:
    windows = win.origins(price_series(spark, sf_dir), KEYS, "month", "price", 24, 6)
    return fc.mean_of_last(windows, WIDTHS)


@query("rolling_backtest", "N5 P1", f"""
with {ORIGINS_SQL}
select partner, config, origin, round(avg((label - prediction) * (label - prediction)), 1) as mse
from paths group by partner, config, origin""")
def rolling_backtest(spark, sf_dir):
    scores = fc.window_scores(mean_paths(spark, sf_dir), ["partner", "config"])
    return scores.withColumn("mse", r("mse", 1))


@query("grid_search_means", "D17 N6", f"""
with {ORIGINS_SQL},
w as (select partner, config, origin, avg((label - prediction) * (label - prediction)) as mse
      from paths group by partner, config, origin),
m as (select partner, config, avg(mse) as mse from w group by partner, config)
select partner, config, round(mse, 1) as mse from m
qualify row_number() over (partition by partner order by mse, config) = 1""")
def grid_search_means(spark, sf_dir):
    scores = fc.window_scores(mean_paths(spark, sf_dir), ["partner", "config"])
    return fc.grid_search(scores, KEYS, "config").withColumn("mse", r("mse", 1))


@query("ith_step_pairs", "E23", f"""
with {ORIGINS_SQL}
select partner, config, target, round(prediction, 3) as prediction, round(label, 4) as label
from paths where step = 4""")
def ith_step_pairs(spark, sf_dir):
    series = stage(price_series(spark, sf_dir), "series")
    windows = win.origins(series, KEYS, "month", "price", 24, 6)
    rows = fc.forecast_rows(fc.mean_of_last(windows, WIDTHS), ["partner", "config"]).drop("label")
    pairs = win.ith_step(rows, series, KEYS, 4, "month", "price")
    return pairs.select("partner", "config", "target", r("prediction", 3).alias("prediction"),
                        r("label").alias("label"))


@query("forecast_errors", "P1 P2", f"""
with {ORIGINS_SQL}
select config, step, round(avg((prediction - label) * (prediction - label)), 1) as mse,
       round(avg(abs(prediction - label)), 3) as mae, round(avg(abs((prediction - label) / nullif(label, 0))), 6) as mape,
       round(100 * power(avg(2 * abs(prediction - label) / (abs(label) + abs(prediction) + 1e-6)), 1), 5) as smape
from paths group by config, step""")
def forecast_errors(spark, sf_dir):
    rows = fc.forecast_rows(mean_paths(spark, sf_dir), ["partner", "config"])
    return rows.groupBy("config", F.col("step").cast("long").alias("step")).agg(
        r(rates.squared_error("label", "prediction"), 1).alias("mse"),
        r(rates.absolute_error("label", "prediction"), 3).alias("mae"),
        r(rates.relative_error("label", "prediction"), 6).alias("mape"),
        r(rates.smape("label", "prediction"), 5).alias("smape"))


@query("moving_window_blocks", "N4", f"""
with {SERIES_SQL},
n as (select *, row_number() over (partition by partner order by month) as rn,
             count(*) over (partition by partner) as total from series),
starts as (select partner, month as origin, rn, total from n where rn > 24 and (rn - 1 - 24) % 6 = 0)
select s.partner, s.origin, least(6, s.total - s.rn + 1) as horizon,
       round((select sum(price) from n where n.partner = s.partner and n.rn between s.rn - 24 and s.rn - 1), 2) as past,
       round((select sum(price) from n where n.partner = s.partner and n.rn between s.rn and s.rn + 5), 2) as future
from starts s""")
def moving_window_blocks(spark, sf_dir):
    blocks = win.origins(price_series(spark, sf_dir), KEYS, "month", "price", 24, 6, stride=6, partial=True)

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    return blocks.select("partner", "origin", F.size("future").cast("long").alias("horizon"),
                         r(total("past"), 2).alias("past"), r(total("future"), 2).alias("future"))


@query("exported_forecasts", "B13 E13 N11", f"""
with {SERIES_SQL},
s as (select partner, avg(ln(price + 1e-8)) as m, coalesce(nullif(stddev_samp(ln(price + 1e-8)), 0), 1) as s
      from series where month <= date '1999-12-01' group by partner),
z as (select x.partner, x.month, (ln(x.price + 1e-8) - s.m) / s.s as z, s.m, s.s from series x join s using (partner)),
l as (select *, lag(z) over (partition by partner order by month) as p from z)
select partner, month, round(z, 6) as label_scaled, round(p, 6) as prediction_scaled,
       round(exp(z * s + m), 3) as label, round(exp(p * s + m), 3) as prediction from l where p is not null""")
def exported_forecasts(spark, sf_dir):
    from pyspark.sql import Window

    logged = stage(price_series(spark, sf_dir).withColumn("price", log_base("price")), "logged")
    train, _ = win.split_at(logged, "month", "1999-12-01", "2000-01-01")
    step = Scaled(fit_standard(train, ["price"], KEYS), ["price"], KEYS)
    w = Window.partitionBy("partner").orderBy("month")
    scaled = step(logged).select(
        "partner", "month", "price", F.lag("price").over(w).alias("prediction")).dropna()
    both = scaled.unpivot(["partner", "month"], ["price", "prediction"], "kind", "price")
    back = both.withColumnRenamed("price", "scaled").join(
        step.reverse(both).withColumn("price", pow_base("price")), ["partner", "month", "kind"])

    def pick(kind: str, column: str, digits: int):
        return r(F.max(F.when(F.col("kind") == kind, F.col(column))), digits)

    return back.groupBy("partner", "month").agg(
        pick("price", "scaled", 6).alias("label_scaled"), pick("prediction", "scaled", 6).alias("prediction_scaled"),
        pick("price", "price", 3).alias("label"), pick("prediction", "price", 3).alias("prediction"))


@query("additive_decomposition", "E24", f"""
with {SERIES_SQL},
a as (select *, (row_number() over w - 1) % 12 as phase, lag(price, 6) over w as lo, lead(price, 6) over w as hi,
             sum(price) over (partition by partner order by month rows between 5 preceding and 5 following) as mid
      from series window w as (partition by partner order by month)),
t as (select *, case when lo is not null and hi is not null then (mid + (lo + hi) / 2) / 12 end as trend from a),
p as (select partner, phase, avg(price - trend) as m from t group by partner, phase),
s as (select partner, phase, m - avg(m) over (partition by partner) as seasonal from p)
select t.partner, t.month, round(t.price, 4) as price, round(t.trend, 3) as trend, round(s.seasonal, 3) as seasonal,
       round(t.price - t.trend - s.seasonal, 3) as residual
from t join s on t.partner = s.partner and t.phase = s.phase""")
def additive_decomposition(spark, sf_dir):
    parts = dc.additive(price_series(spark, sf_dir).drop("quantity"), KEYS, "month", "price")
    return parts.select("partner", "month", r("price").alias("price"), r("trend", 3).alias("trend"),
                        r("seasonal", 3).alias("seasonal"), r("residual", 3).alias("residual"))


@query("stl_decomposition", "E25 U2")
def stl_decomposition(spark, sf_dir):
    return dc.stl(price_series(spark, sf_dir), KEYS, "month", "price")


@query("autocorrelation", "E26", f"""
with {SERIES_SQL},
x as (select *, price - avg(price) over (partition by partner) as d,
             row_number() over (partition by partner order by month) as rn from series),
v as (select partner, sum(d * d) as v from x group by partner),
k as (select x.partner, l.lag, sum(x.d * y.d) as c from x, (select unnest(range(0, 11)) as lag) l, x y
      where y.partner = x.partner and y.rn = x.rn - l.lag group by x.partner, l.lag)
select k.partner, cast(k.lag as integer) as lag, round(k.c / v.v, 6) as acf from k join v on k.partner = v.partner""")
def autocorrelation(spark, sf_dir):
    out = dc.autocorrelation(price_series(spark, sf_dir), KEYS, "month", "price", 10)
    return out.withColumn("acf", r("acf", 6))


@query("partial_autocorrelation", "E27")
def partial_autocorrelation(spark, sf_dir):
    acf = dc.autocorrelation(price_series(spark, sf_dir), KEYS, "month", "price", 10)
    return dc.partial_autocorrelation(acf, KEYS)


WEIGHTS_SQL = DENSE_SQL + """,
weights as (
  select partner, 'quantity' as feature, stddev_samp(quantity) / avg(quantity) as weight from dense group by partner
  union all select partner, 'value', stddev_samp(value) / avg(value) from dense group by partner
  union all select partner, 'price', stddev_samp(price) / avg(price) from dense group by partner)
"""
FEATURES = ["price", "quantity", "value"]


def feature_weights(spark, sf_dir) -> DataFrame:
    """Stand-in for learned weights: the relative spread of each feature per partner."""
    dense = dense_cells(spark, sf_dir)
    long = dense.unpivot(["partner"], FEATURES, "feature", "x")
    return long.groupBy("partner", "feature").agg((F.stddev_samp("x") / F.avg("x")).alias("weight"))


@query("weights_by_partner", "E28", f"""
with {WEIGHTS_SQL}
select partner, round(max(case when feature = 'price' then weight end), 6) as price,
       round(max(case when feature = 'quantity' then weight end), 6) as quantity,
       round(max(case when feature = 'value' then weight end), 6) as value from weights group by partner""")
def weights_by_partner(spark, sf_dir):
    wide = win.weights_by_partner(feature_weights(spark, sf_dir), "partner", "feature", "weight", FEATURES)
    return wide.select("partner", *[r(f, 6).alias(f) for f in FEATURES])


@query("chosen_features", "E29", f"""
with {WEIGHTS_SQL}, m as (select feature, avg(weight) as mean from weights group by feature)
select 'top' as rule, feature, round(mean, 6) as mean from m
qualify row_number() over (order by mean desc, feature) <= 1 or feature = 'price'
union all
select 'mean', feature, round(mean, 6) from m where mean >= (select avg(mean) from m) or feature = 'price'""")
def chosen_features(spark, sf_dir):
    weights = stage(feature_weights(spark, sf_dir), "weights")
    top = win.chosen_features(weights, "feature", "weight", ["price"], k=1).withColumn("rule", F.lit("top"))
    mean = win.chosen_features(weights, "feature", "weight", ["price"]).withColumn("rule", F.lit("mean"))
    return top.unionByName(mean).select("rule", "feature", r("mean", 6).alias("mean"))


@query("forecast_interval", "D15 P3", f"""
with {SERIES_SQL}
select partner, cast(month(month) as integer) as step, round(quantile_cont(price, 0.1), 4) as low,
       round(quantile_cont(price, 0.5), 4) as mid, round(quantile_cont(price, 0.9), 4) as high
from series group by 1, 2""")
def forecast_interval(spark, sf_dir):
    from tallyloom.operators.posterior import interval

    draws = price_series(spark, sf_dir).withColumn("step", F.month("month"))
    out = interval(draws, ["partner", "step"], "price", 0.1)
    return out.select("partner", "step", r("low").alias("low"), r("mid").alias("mid"), r("high").alias("high"))


@query("trimmed_series", "B17", f"""
with {SERIES_SQL}, k as (select distinct month from series order by month desc limit 2)
select partner, month, round(price, 4) as price from series
where month < (select min(month) from k)""")
def trimmed_series(spark, sf_dir):
    series = price_series(spark, sf_dir)
    # the two last months of the calendar
    last = series.select("month").distinct().orderBy(F.col("month").desc()).limit(2).agg(F.min("month")).scalar()
    return series.filter(F.col("month") < last).select("partner", "month", r("price").alias("price"))


@query("unit_root_check", "D18 N9", f"""
with {SERIES_SQL},
d as (select partner, price - lag(price) over w as dy, lag(price) over w as x from series
      window w as (partition by partner order by month)),
g as (select partner, count(*) as n, regr_slope(dy, x) as b, regr_sxx(dy, x) as sxx, regr_syy(dy, x) as syy
      from d where dy is not null group by partner),
t as (select partner, n, b / sqrt((syy - b * b * sxx) / (n - 2) / sxx) as t from g)
select partner, n, round(t, 4) as t, cast(case when n <= 25 then -3.0 when n <= 50 then -2.93 when n <= 100 then -2.89
       when n <= 250 then -2.88 when n <= 500 then -2.87 else -2.86 end as double) as critical,
       t < (case when n <= 25 then -3.0 when n <= 50 then -2.93 when n <= 100 then -2.89
       when n <= 250 then -2.88 when n <= 500 then -2.87 else -2.86 end) as stationary from t""")
def unit_root_check(spark, sf_dir):
    series = price_series(spark, sf_dir).withColumn("price", F.col("price") / 1000)
    out = fc.unit_root(series, KEYS, "month", "price", 0)
    return out.withColumn("t", r("t", 4))


@query("unit_root_lagged", "N9 E21")
def unit_root_lagged(spark, sf_dir):
    series = price_series(spark, sf_dir).withColumn("price", F.col("price") / 1000)
    return fc.unit_root(series, KEYS, "month", "price", 2)


@query("series_config_grid", "N1 N2", f"""
with {SERIES_SQL}, p as (select distinct partner from series),
g as (select p, d, q, sp, sq from (values (1), (2)) a(p), (values (0), (1)) b(d), (values (0), (1)) c(q),
      (values (0), (1)) e(sp), (values (0), (1)) f(sq))
select partner, p, d, q, sp, sq, 12 as m, 'n' as trend from p, g""")
def series_config_grid(spark, sf_dir):
    grid = fc.configs([1, 2], [0, 1], [0, 1], [0, 1], [0], [0, 1], [12], ["n"])
    partners = price_series(spark, sf_dir).select("partner").distinct()
    return fc.with_configs(partners, grid).select(
        "partner", *[F.col(f"config.{c}").alias(c) for c in ("p", "d", "q", "sp", "sq", "m", "trend")])


# The orders tried by the registered backtests.
ARIMA_GRID = fc.configs([0, 1, 2], [0, 1], [0, 1], trend=["c"])
SEASONAL_GRID = fc.configs([0, 1], [0], [1], [0], [0, 1], [0], [12], ["n"])


def _logged(spark, sf_dir) -> DataFrame:
    return price_series(spark, sf_dir).withColumns(
        {"price": log_base("price"), "quantity": F.col("quantity") / 1000})


@query("arima_grid_search", "N1 N3 N5 N6")
def arima_grid_search(spark, sf_dir):
    windows = win.origins(_logged(spark, sf_dir), KEYS, "month", "price", 24, 6)
    paths = fc.forecasts(fc.with_configs(windows, ARIMA_GRID), 6)
    scores = fc.window_scores(paths.withColumn("id", F.col("config.id")), ["partner", "id"])
    return fc.grid_search(scores, KEYS, "id")


@query("seasonal_arima_backtest", "N1 N3 N5")
def seasonal_arima_backtest(spark, sf_dir):
    windows = win.origins(_logged(spark, sf_dir), KEYS, "month", "price", 36, 6)
    paths = fc.forecasts(fc.with_configs(windows, SEASONAL_GRID), 6)
    scores = fc.window_scores(paths.withColumn("id", F.col("config.id")), ["partner", "id"])
    return scores.groupBy("partner", "id").agg(F.avg("mse").alias("mse"), F.count("mse").alias("windows"))


@query("arimax_moving_window", "N3 N4 N7 N11")
def arimax_moving_window(spark, sf_dir):
    windows = win.origins(
        _logged(spark, sf_dir), KEYS, "month", "price", 24, 6, stride=6, partial=True, exogenous=["quantity"])
    paths = fc.forecasts(fc.with_configs(windows, fc.configs([1], [0], [0], trend=["c"])), 6, exogenous=True)
    return fc.forecast_rows(paths, KEYS)


@query("residual_report", "D10 E26 E27 N10")
def residual_report(spark, sf_dir):
    series = stage(_logged(spark, sf_dir), "series")
    whole = series.groupBy("partner").agg(
        F.array_sort(F.collect_list(F.struct("month", "price"))).alias("rows"))  # one row per month
    fitted = fc.fitted_values(fc.with_configs(
        whole.select("partner", F.col("rows.month").alias("months"), F.col("rows.price").alias("past")),
        fc.configs([1], [0], [1], trend=["c"])))
    rows = fitted.select("partner", F.explode(F.arrays_zip("months", "past", "fitted")).alias("z")).select(
        "partner", F.col("z.months").alias("month"), (F.col("z.past") - F.col("z.fitted")).alias("residual")).dropna()
    rows = stage(rows, "residuals")
    summary = rows.groupBy("partner").agg(
        F.count("residual").alias("n"), F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"),
        F.min("residual").alias("low"), F.max("residual").alias("high"))
    acf = dc.autocorrelation(rows, KEYS, "month", "residual", 5)
    both = dc.partial_autocorrelation(acf, KEYS)
    bars = histogram(rows, "residual", 25, KEYS).groupBy("partner").agg(
        F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("histogram"))  # at most 25 bins
    return both.join(summary, "partner").join(bars, "partner")


@query("first_order_forecasts", "N3 N5 N11", f"""
with {SERIES_SQL},
n as (select partner, month, ln(price + 1e-8) as y, row_number() over (partition by partner order by month) as rn,
             count(*) over (partition by partner) as total from series),
s as (select partner, month as origin, rn from n where rn > 24 and rn + 5 <= total),
pairs as (select s.partner, s.origin, s.rn, a.y as y, b.y as x from s
          join n a on a.partner = s.partner and a.rn between s.rn - 23 and s.rn - 1
          join n b on b.partner = a.partner and b.rn = a.rn - 1),
fit as (select partner, origin, rn, regr_slope(y, x) as f, regr_intercept(y, x) as c from pairs group by 1, 2, 3),
path as (select fit.partner, origin, h as step, f, c, n.y as last, fit.rn from fit
         join n on n.partner = fit.partner and n.rn = fit.rn - 1, (select unnest(range(1, 7)) as h))
select path.partner, origin, step, n.month as target, round(n.y, 6) as label,
       round(pow(f, step) * last + c * (pow(f, step) - 1) / (f - 1), 6) as prediction
from path join n on n.partner = path.partner and n.rn = path.rn + step - 1""")
def first_order_forecasts(spark, sf_dir):
    windows = win.origins(_logged(spark, sf_dir), KEYS, "month", "price", 24, 6)
    paths = fc.forecasts(fc.with_configs(windows, fc.configs([1], [0], [0], trend=["c"])), 6)
    rows = fc.forecast_rows(paths, KEYS)
    return rows.select("partner", "origin", F.col("step").cast("long").alias("step"), "target",
                       r("label", 6).alias("label"), r("prediction", 6).alias("prediction"))


@query("seasonal_difference_forecasts", "N1 N3 N5", f"""
with {SERIES_SQL},
n as (select partner, month, ln(price + 1e-8) as y, row_number() over (partition by partner order by month) as rn,
             count(*) over (partition by partner) as total from series),
s as (select partner, month as origin, rn from n where rn > 24 and rn + 5 <= total)
select s.partner, s.origin, n.rn - s.rn + 13 as step, round(n.y, 6) as prediction
from s join n on n.partner = s.partner and n.rn between s.rn - 12 and s.rn - 7""")
def seasonal_difference_forecasts(spark, sf_dir):
    windows = win.origins(_logged(spark, sf_dir), KEYS, "month", "price", 24, 6)
    grid = fc.configs([0], [0], [0], [0], [1], [0], [12], ["n"])
    rows = fc.forecast_rows(fc.forecasts(fc.with_configs(windows, grid), 6), KEYS)
    return rows.select("partner", "origin", F.col("step").cast("long").alias("step"),
                       r("prediction", 6).alias("prediction"))


@query("moving_average_forecasts", "N3 N5 N6", f"""
with {SERIES_SQL},
n as (select partner, month, ln(price + 1e-8) as y, row_number() over (partition by partner order by month) as rn,
             count(*) over (partition by partner) as total from series),
s as (select partner, month as origin, rn from n where rn > 24 and rn + 5 <= total),
l as (select s.partner, s.origin, s.rn as pos, a.rn, a.y, b.y as x, d.y as z from s
      join n a on a.partner = s.partner and a.rn between s.rn - 22 and s.rn - 1
      join n b on b.partner = a.partner and b.rn = a.rn - 1 join n d on d.partner = a.partner and d.rn = a.rn - 2),
m as (select partner, origin, regr_sxx(y, x) as xx, regr_sxx(y, z) as zz, regr_sxy(y, x) as xy, regr_sxy(y, z) as zy,
             regr_sxy(x, z) as xz, avg(y) as my, avg(x) as mx, avg(z) as mz from l group by 1, 2),
b as (select *, (xy * zz - zy * xz) / (xx * zz - xz * xz) as bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) as bz from m),
e as (select l.partner, l.origin, pos, rn, y, (y - my) - bx * (x - mx) - bz * (z - mz) as e from l join b using (partner, origin)),
f as (select e.partner, e.origin, regr_slope(e.y, p.e) as theta, regr_intercept(e.y, p.e) as c from e
      join e p on p.partner = e.partner and p.origin = e.origin and p.rn = e.rn - 1 group by 1, 2)
select f.partner, f.origin, h as step, round(c + case when h = 1 then theta * e.e else 0 end, 6) as prediction
from f join e on e.partner = f.partner and e.origin = f.origin and e.rn = e.pos - 1, (select unnest(range(1, 7)) as h)""")
def moving_average_forecasts(spark, sf_dir):
    """Order (0, 0, 1) with a constant: innovations from two lags, then a regression on the last innovation."""
    windows = win.origins(_logged(spark, sf_dir), KEYS, "month", "price", 24, 6)
    rows = fc.forecast_rows(fc.forecasts(fc.with_configs(windows, fc.configs([0], [0], [1], trend=["c"])), 6), KEYS)
    return rows.select("partner", "origin", F.col("step").cast("long").alias("step"), r("prediction", 6).alias("prediction"))


@query("partial_autocorrelation_three", "E27", f"""
with {SERIES_SQL},
x as (select *, price - avg(price) over (partition by partner) as d,
             row_number() over (partition by partner order by month) as rn from series),
v as (select partner, sum(d * d) as v from x group by partner),
k as (select x.partner, l.lag, sum(x.d * y.d) as c from x, (select unnest(range(1, 4)) as lag) l, x y
      where y.partner = x.partner and y.rn = x.rn - l.lag group by x.partner, l.lag),
r as (select k.partner, max(case when lag = 1 then c / v end) as r1, max(case when lag = 2 then c / v end) as r2,
             max(case when lag = 3 then c / v end) as r3 from k join v on k.partner = v.partner group by k.partner)
select partner, round(r1, 6) as p1, round((r2 - r1 * r1) / (1 - r1 * r1), 6) as p2,
       round((r3 * (1 - r1 * r1) + r1 * r1 * r1 + r1 * r2 * r2 - 2 * r1 * r2)
             / (1 - 2 * r1 * r1 - r2 * r2 + 2 * r1 * r1 * r2), 6) as p3 from r""")
def partial_autocorrelation_three(spark, sf_dir):
    acf = dc.autocorrelation(price_series(spark, sf_dir), KEYS, "month", "price", 3)
    pacf = dc.partial_autocorrelation(acf, KEYS)
    return pacf.groupBy("partner").agg(
        *[r(F.max(F.when(F.col("lag") == i, F.col("pacf"))), 6).alias(f"p{i}") for i in (1, 2, 3)])


@query("unit_root_one_lag", "D18 E21 N9", f"""
with {SERIES_SQL},
d as (select partner, month, price / 1000 - lag(price / 1000) over w as dy, lag(price / 1000) over w as x from series
      window w as (partition by partner order by month)),
e as (select *, lag(dy) over (partition by partner order by month) as z from d),
m as (select partner, count(*) as n, regr_sxx(dy, x) as xx, regr_sxx(dy, z) as zz, regr_syy(dy, x) as yy,
             regr_sxy(dy, x) as xy, regr_sxy(dy, z) as zy, regr_sxy(x, z) as xz
      from e where dy is not null and z is not null group by partner),
b as (select *, xx * zz - xz * xz as det, (xy * zz - zy * xz) / (xx * zz - xz * xz) as bx,
             (zy * xx - xy * xz) / (xx * zz - xz * xz) as bz from m)
select partner, n, round(bx / sqrt((yy - bx * xy - bz * zy) / (n - 3) * zz / det), 4) as t from b""")
def unit_root_one_lag(spark, sf_dir):
    series = price_series(spark, sf_dir).withColumn("price", F.col("price") / 1000)
    out = fc.unit_root(series, KEYS, "month", "price", 1)
    return out.select("partner", "n", r("t", 4).alias("t"))
