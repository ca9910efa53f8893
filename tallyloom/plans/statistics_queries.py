"""Mixtures, splines, kernels and posterior summaries on customers, orders and brands."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import rates
from tallyloom.operators import decompose as dc
from tallyloom.operators import kernel as kn
from tallyloom.operators import leastsq as ls
from tallyloom.operators import mixture as mx
from tallyloom.operators import posterior as po
from tallyloom.operators import windows as win
from tallyloom.operators.scale import histogram
from tallyloom.plans.panel_queries import r
from tallyloom.plans.registry import query
from tallyloom.plans.standins import cents, table
from tallyloom.session import stage


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, cls, x1, x2): balance in thousands, mean order total in hundred thousands."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        (F.sum(cents("o_totalprice")) / 100 / F.count(F.lit(1)) / 100000).alias("x2"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("cls"), (F.col("c_acctbal") / 1000).alias("x1"))
    return customers.join(orders, F.col("id") == F.col("o_custkey")).select("id", "cls", "x1", "x2")


POINTS_SQL = """
points as (
  select c_custkey as id, c_mktsegment as cls, c_acctbal / 1000 as x1, o.x2
  from customer join (
    select o_custkey, cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) / 100 / count(*) / 100000 as x2
    from orders group by o_custkey) o on c_custkey = o.o_custkey)
"""

# The mixture at which single steps are compared with SQL.
MODEL = mx.Mixture([[1.5, 2.0], [6.5, 3.0]], [[[4.0, 0.2], [0.2, 0.5]], [[6.0, -0.3], [-0.3, 0.8]]], [0.4])

#: Plain steps of EM that the SQL takes; they reach the maximum at every scale the tables come in.
SQL_STEPS = 1500

MIXTURE_SQL = POINTS_SQL + """,
comps(k, m1, m2, s11, s12, s22, pi) as (values (0, 1.5, 2.0, 4.0, 0.2, 0.5, 0.4), (1, 6.5, 3.0, 6.0, -0.3, 0.8, 0.6)),
dens as (
  select id, x1, x2, k, cast(pi as double) * exp(-0.5 * (s22 * (x1 - m1) ** 2 - 2 * s12 * (x1 - m1) * (x2 - m2)
         + s11 * (x2 - m2) ** 2) / (s11 * s22 - s12 * s12)) / (2 * pi() * sqrt(s11 * s22 - s12 * s12)) as d
  from points, comps),
share as (select *, d / sum(d) over (partition by id) as w, sum(d) over (partition by id) as lik from dens)
"""


@query("mixture_likelihood", "K1 K5", f"""
with {MIXTURE_SQL}, l as (select sum(ln(lik)) as loglik, count(*) as n from share where k = 0)
select round(loglik, 3) as loglik, round(11 * ln(n) - 2 * loglik, 3) as bic from l""")
def mixture_likelihood(spark, sf_dir):
    out = mx.bic(points(spark, sf_dir), ["x1", "x2"], MODEL)
    return out.select(r("loglik", 3).alias("loglik"), r("bic", 3).alias("bic"))


@query("mixture_shares", "K2", f"""
with {MIXTURE_SQL}
select id, round(max(case when k = 0 then w end), 7) as w_0, round(max(case when k = 1 then w end), 7) as w_1
from share group by id""")
def mixture_shares(spark, sf_dir):
    out = mx.with_shares(points(spark, sf_dir), ["x1", "x2"], MODEL)
    return out.select("id", r("w_0", 7).alias("w_0"), r("w_1", 7).alias("w_1"))


@query("mixture_step", "K3", f"""
with {MIXTURE_SQL},
m as (select k, sum(w) as s, sum(w * x1) / sum(w) as m1, sum(w * x2) / sum(w) as m2, sum(w) / count(*) as pi
      from share group by k)
select share.k, round(max(m.pi), 7) as pi, round(max(m.m1), 6) as m1, round(max(m.m2), 6) as m2,
       round(sum(w * (x1 - m.m1) ** 2) / max(s), 6) as s11, round(sum(w * (x1 - m.m1) * (x2 - m.m2)) / max(s), 6) as s12,
       round(sum(w * (x2 - m.m2) ** 2) / max(s), 6) as s22
from share join m on share.k = m.k group by share.k""")
def mixture_step(spark, sf_dir):
    (_, after), = mx.stepper(["x1", "x2"])(points(spark, sf_dir), {0: MODEL}).values()
    rows = [
        (k, *(round(float(v), d) for v, d in (
            (after.pi[k], 7), (after.mu[k, 0], 6), (after.mu[k, 1], 6), (after.sigma[k, 0, 0], 6),
            (after.sigma[k, 0, 1], 6), (after.sigma[k, 1, 1], 6))))
        for k in range(after.size)
    ]
    return spark.createDataFrame(rows, "k int, pi double, m1 double, m2 double, s11 double, s12 double, s22 double")


@query("mixture_conditional_mean", "K6", f"""
with {POINTS_SQL},
comps(k, m1, m2, s11, s12, pi) as (values (0, 1.5, 2.0, 4.0, 0.2, 0.4), (1, 6.5, 3.0, 6.0, -0.3, 0.6)),
d as (select id, x1, cast(pi as double) * exp(-0.5 * (x1 - m1) ** 2 / s11) / sqrt(2 * pi() * s11) as d,
             m2 + s12 / s11 * (x1 - m1) as y from points, comps)
select id, round(sum(d * y) / sum(d), 6) as x2_given from d group by id""")
def mixture_conditional_mean(spark, sf_dir):
    out = mx.conditional_mean(points(spark, sf_dir), ["x1", "x2"], MODEL)
    return out.select("id", r("x2_given", 6).alias("x2_given"))


@query("mixture_single_segment", "K4 K5", f"""
with {POINTS_SQL},
m as (select avg(x1) as m1, avg(x2) as m2, var_pop(x1) as s11, covar_pop(x1, x2) as s12, var_pop(x2) as s22,
             count(*) as n from points),
l as (select *, -0.5 * n * (2 * ln(2 * pi()) + ln(s11 * s22 - s12 * s12) + 2) as loglik from m)
select round(m1, 6) as m1, round(m2, 6) as m2, round(s11, 6) as s11, round(s12, 6) as s12, round(s22, 6) as s22,
       round(loglik, 3) as loglik, round(5 * ln(n) - 2 * loglik, 3) as bic from l""")
def mixture_single_segment(spark, sf_dir):
    data = stage(points(spark, sf_dir), "points")
    m, value, _ = mx.fit_em(data, "id", ["x1", "x2"], 1, restarts=2)
    bic = m.parameters() * float(np.log(data.count())) - 2 * value
    fitted = spark.createDataFrame(
        [(*map(float, m.mu[0]), *(float(m.sigma[0][a]) for a in ((0, 0), (0, 1), (1, 1))), value, bic)],
        "m1 double, m2 double, s11 double, s12 double, s22 double, loglik double, bic double")
    return fitted.select(*[r(c, 3 if c in ("loglik", "bic") else 6).alias(c) for c in fitted.columns])


@query("mixture_two_segments", "K2 K3 K4 K5", f"""
with recursive {POINTS_SQL.strip()},
em(step, p0, a0, b0, s0, t0, u0, p1, a1, b1, s1, t1, u1) as (
  select 0, 0.4::double, 1.5::double, 2.0::double, 4.0::double, 0.2::double, 0.5::double,
         0.6::double, 6.5::double, 3.0::double, 6.0::double, -0.3::double, 0.8::double
  union all
  select step + 1, s / n, sx / s, sy / s, sxx / s - (sx / s) ** 2, sxy / s - sx / s * sy / s, syy / s - (sy / s) ** 2,
         (n - s) / n, (x - sx) / (n - s), (y - sy) / (n - s), (xx - sxx) / (n - s) - ((x - sx) / (n - s)) ** 2,
         (xy - sxy) / (n - s) - (x - sx) / (n - s) * (y - sy) / (n - s), (yy - syy) / (n - s) - ((y - sy) / (n - s)) ** 2
  from (
    select step, count(*) n, sum(w) s, sum(w * x1) sx, sum(w * x2) sy, sum(w * x1 * x1) sxx, sum(w * x1 * x2) sxy,
           sum(w * x2 * x2) syy, sum(x1) x, sum(x2) y, sum(x1 * x1) xx, sum(x1 * x2) xy, sum(x2 * x2) yy
    from (
      select step, x1, x2, d0 / (d0 + d1) as w
      from (
        select step, x1, x2,
               p0 * exp(-0.5 * (u0 * (x1 - a0) ** 2 - 2 * t0 * (x1 - a0) * (x2 - b0) + s0 * (x2 - b0) ** 2)
                        / (s0 * u0 - t0 * t0)) / sqrt(s0 * u0 - t0 * t0) as d0,
               p1 * exp(-0.5 * (u1 * (x1 - a1) ** 2 - 2 * t1 * (x1 - a1) * (x2 - b1) + s1 * (x2 - b1) ** 2)
                        / (s1 * u1 - t1 * t1)) / sqrt(s1 * u1 - t1 * t1) as d1
        from em, points where step < {SQL_STEPS}) _d) _w
    group by step) _s),
last as (select * from em where step = {SQL_STEPS}),
l as (
  select sum(ln((p0 * exp(-0.5 * (u0 * (x1 - a0) ** 2 - 2 * t0 * (x1 - a0) * (x2 - b0) + s0 * (x2 - b0) ** 2)
                          / (s0 * u0 - t0 * t0)) / sqrt(s0 * u0 - t0 * t0)
                 + p1 * exp(-0.5 * (u1 * (x1 - a1) ** 2 - 2 * t1 * (x1 - a1) * (x2 - b1) + s1 * (x2 - b1) ** 2)
                            / (s1 * u1 - t1 * t1)) / sqrt(s1 * u1 - t1 * t1)) / (2 * pi()))) as loglik, count(*) as n
  from points, last)
select 0 as k, round(p0, 3) as pi, round(a0, 2) as m1, round(b0, 3) as m2, round(loglik, 2) as loglik,
       round(11 * ln(n) - 2 * loglik, 2) as bic from last, l
union all
select 1, round(p1, 3), round(a1, 2), round(b1, 3), round(loglik, 2), round(11 * ln(n) - 2 * loglik, 2) from last, l""")
def mixture_two_segments(spark, sf_dir):
    """The maximum that two segments reach from fixed ones; the SQL takes plain steps of EM, many more of them."""
    data = stage(points(spark, sf_dir), "points")
    fit = mx.fit_sizes(data, "id", ["x1", "x2"], [2], tolerance=1e-13, starts=[MODEL])[2]
    bic = fit.model.parameters() * float(np.log(data.count())) - 2 * fit.value
    rows = [(k, float(fit.model.pi[k]), *map(float, fit.model.mu[k]), fit.value, bic) for k in range(2)]
    out = spark.createDataFrame(rows, "k int, pi double, m1 double, m2 double, loglik double, bic double")
    return out.select("k", *[r(c, d).alias(c) for c, d in (("pi", 3), ("m1", 2), ("m2", 3), ("loglik", 2), ("bic", 2))])


@query("mixture_fit", "K4 K5")
def mixture_fit(spark, sf_dir):
    """Two, three and four segments from ten starts each, to convergence."""
    data = stage(points(spark, sf_dir), "points")
    n = data.count()
    rows = [
        (k, f.value, f.model.parameters() * float(np.log(n)) - 2 * f.value, [float(p) for p in f.model.pi],
         max(map(len, f.paths)), f.converged)
        for k, f in sorted(mx.fit_sizes(data, "id", ["x1", "x2"], [2, 3, 4]).items())]
    return spark.createDataFrame(rows, "k int, loglik double, bic double, pi array<double>, steps int, converged boolean")


@query("gram_sums", "B20 D18 L1", f"""
with {POINTS_SQL},
b as (select 1.0::double as b0, x1 as b1, greatest(x1 - 3, 0) as b2, greatest(x1 - 7, 0) as b3,
             pow(least(x1 - 5, 0), 3) as c, x2 as y from points)
select count(*) as n, round(sum(y * y), 4) as yy, round(sum(b0 * y), 4) as xy_0, round(sum(b1 * y), 4) as xy_1,
       round(sum(b2 * y), 4) as xy_2, round(sum(b3 * y), 4) as xy_3, round(sum(c * y), 3) as xy_4,
       round(sum(b1 * b1), 4) as xx_1_1, round(sum(b1 * b2), 4) as xx_1_2, round(sum(b2 * b3), 4) as xx_2_3,
       round(sum(b3 * c), 4) as xx_3_4, round(sum(c * c), 1) as xx_4_4 from b""")
def gram_sums(spark, sf_dir):
    from tallyloom.functions.scalar import below_cubed

    basis = {**ls.linear_basis("x1", [3.0, 7.0]), "c": below_cubed("x1", 5.0)}
    rows = points(spark, sf_dir).withColumns(basis)
    g = ls.gram(rows, list(basis), "x2")
    digits = {"xy_4": 3, "xx_4_4": 1}
    names = ["yy", "xy_0", "xy_1", "xy_2", "xy_3", "xy_4", "xx_1_1", "xx_1_2", "xx_2_3", "xx_3_4", "xx_4_4"]
    return g.select("n", *[r(c, digits.get(c, 4)).alias(c) for c in names])


@query("spline_fits", "L1 L2")
def spline_fits(spark, sf_dir):
    data = stage(points(spark, sf_dir), "points")
    n = data.count()
    knots = [float(i) for i in range(1, 10)]
    bases = {
        "linear": (ls.linear_basis("x1", [3.0, 7.0]), None),
        "cubic": (ls.cubic_basis("x1", 5.0), None),
        "linear_then_cubic": (ls.linear_then_cubic_basis("x1", 5.0), None),
        **{f"smooth_{lam:g}": (ls.linear_basis("x1", knots), ls.smoothing_penalty(knots, lam, n))
           for lam in (1e-7, 1e-4, 1e-1)},
    }
    out = None
    for name, (basis, penalty) in bases.items():
        beta, fitted = ls.fit_basis(data, basis, "x2", penalty)
        one = fitted.agg(
            F.lit(name).alias("spline"), F.array(*[F.lit(float(b)) for b in beta]).alias("beta"),
            rates.squared_error("x2", "fitted").alias("mse"))
        out = one if out is None else out.unionByName(one)
    return out


@query("additive_model", "L9")
def additive_model(spark, sf_dir):
    data = stage(
        points(spark, sf_dir).join(
            table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey"), "id")
        .withColumn("x3", F.col("c_nationkey").cast("double")), "points")
    constant, parts = ls.additive_model(
        data, ["x1", "x3"], "x2", {"x1": [2.0, 5.0, 8.0], "x3": [6.0, 12.0, 18.0]})
    return parts.agg(
        F.lit(constant).alias("constant"), F.avg("g_x1").alias("mean_g_x1"), F.avg("g_x3").alias("mean_g_x3"),
        F.stddev_pop("g_x1").alias("sd_g_x1"), F.stddev_pop("g_x3").alias("sd_g_x3"))


BANDWIDTH = np.array([[0.5, 0.0], [0.0, 0.5]])
GRID = 20

DENSITY_SQL = POINTS_SQL + f""",
span as (select min(x1) as a1, max(x1) as b1, min(x2) as a2, max(x2) as b2 from points),
nodes as (select i, j, a1 + (b1 - a1) * i / {GRID - 1} as g1, a2 + (b2 - a2) * j / {GRID - 1} as g2
          from span, (select unnest(range(0, {GRID})) as i), (select unnest(range(0, {GRID})) as j)),
density as (
  select cls, i, j, g1, g2, avg(exp(-0.5 * (((g1 - x1) / 0.5) ** 2 + ((g2 - x2) / 0.5) ** 2)) / (2 * pi() * 0.25)) as density
  from points, nodes group by cls, i, j, g1, g2),
prior as (select cls, cast(count(*) as double) / (select count(*) from points) as prior from points group by cls),
posterior as (
  select d.cls, i, j, density * prior / nullif(sum(density * prior) over (partition by i, j), 0) as p
  from density d join prior on d.cls = prior.cls),
classes as (select i, j, cls as predicted, p from posterior
            qualify row_number() over (partition by i, j order by p desc, cls) = 1)
"""


@query("grid_density", "C15 L3 L5", f"""
with {DENSITY_SQL}
select cast(i as integer) as i, cast(j as integer) as j, round(max(g1), 6) as g1, round(max(g2), 6) as g2,
       round(sum(density * prior), 8) as density
from density join prior using (cls) group by i, j""")
def grid_density(spark, sf_dir):
    out = kn.grid_density(stage(points(spark, sf_dir), "points"), "x1", "x2", BANDWIDTH, GRID)
    return out.select("i", "j", r("g1", 6).alias("g1"), r("g2", 6).alias("g2"), r("density", 8).alias("density"))


@query("class_priors", "D14", f"""
with {POINTS_SQL}
select cls, count(*) as n, round(cast(count(*) as double) / (select count(*) from points), 8) as prior
from points group by cls""")
def class_priors(spark, sf_dir):
    return kn.priors(points(spark, sf_dir), "cls").withColumn("prior", r("prior", 8))


@query("density_classes", "L4 L5", f"""
with {DENSITY_SQL}
select cast(i as integer) as i, cast(j as integer) as j, cls, round(p, 7) as posterior from posterior""")
def density_classes(spark, sf_dir):
    out = kn.classify_grid(stage(points(spark, sf_dir), "points"), "x1", "x2", "cls", BANDWIDTH, GRID)
    return out.select("i", "j", "cls", r("posterior", 7).alias("posterior"))


@query("density_hit_flags", "L4 L10", f"""
with {DENSITY_SQL},
placed as (select p.id, p.cls, cast(floor((x1 - a1) * {GRID - 1} / (b1 - a1) + 0.5) as integer) as i,
                  cast(floor((x2 - a2) * {GRID - 1} / (b2 - a2) + 0.5) as integer) as j from points p, span),
hits as (select p.id, cast(p.cls = 'BUILDING' as integer) as y, cast(c.predicted = 'BUILDING' as integer) as z
         from placed p join classes c on p.i = c.i and p.j = c.j)
select id, y = 1 and z = 1 as tp, y = 0 and z = 0 as tn, y = 0 and z = 1 as fp, y = 1 and z = 0 as fn from hits""")
def density_hit_flags(spark, sf_dir):
    rows = kn.classify_rows(stage(points(spark, sf_dir), "points"), "x1", "x2", "cls", BANDWIDTH, GRID)
    flags = rates.hit_flags(
        (F.col("cls") == "BUILDING").cast("int"), (F.col("predicted") == "BUILDING").cast("int"))
    return rows.select("id", *[c.alias(n) for n, c in flags.items()])


def curve(spark, sf_dir) -> DataFrame:
    return points(spark, sf_dir).select(F.col("x1").alias("x"), F.col("x2").alias("y"))


@query("knn_regression", "C15 F3 L6", f"""
with {POINTS_SQL}, span as (select min(x1) as lo, max(x1) as hi from points),
q as (select lo + (hi - lo) * s / 99 as x from span, (select unnest(range(0, 100)) as s)),
d as (select q.x, p.x2 as y, abs(q.x - p.x1) as d, rank() over (partition by q.x order by abs(q.x - p.x1)) as k
      from q, points p)
select round(x, 6) as x, round(sum(exp(-0.5 * d * d) * y) / sum(exp(-0.5 * d * d)), 6) as fitted
from d where k <= 20 group by x""")
def knn_regression(spark, sf_dir):
    data = stage(curve(spark, sf_dir), "curve")
    span = data.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    asked = span.select(F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(99)), lambda s: F.col("lo") + (F.col("hi") - F.col("lo")) * s / 99)).alias("x"))
    out = kn.knn_regression(data, asked, 1.0, 20)
    return out.select(r("x", 6).alias("x"), r("fitted", 6).alias("fitted"))


LOO_SQL = POINTS_SQL + """,
d as (select a.id, a.x2 as y, b.x2 as z, abs(a.x1 - b.x1) as d,
             rank() over (partition by a.id order by abs(a.x1 - b.x1)) as k
      from points a join points b on a.id <> b.id),
f as (select h, n, id, y, sum(exp(-0.5 * (d / h) ** 2) * z) / nullif(sum(exp(-0.5 * (d / h) ** 2)), 0) as p
      from d, (values (0.5), (1.0), (2.0)) a(h), (values (1), (5), (20)) b(n) where k <= n group by h, n, id, y),
scores as (select cast(h as double) as bandwidth, n as neighbours, avg((y - p) ** 2) as score from f group by h, n)
"""


@query("leave_one_out", "C15 L7", f"""
with {LOO_SQL} select bandwidth, neighbours, round(score, 6) as score from scores""")
def leave_one_out(spark, sf_dir):
    out = kn.leave_one_out(curve(spark, sf_dir), [0.5, 1.0, 2.0], [1, 5, 20])
    return out.withColumn("score", r("score", 6))


@query("best_bandwidth", "D17 L7", f"""
with {LOO_SQL} select round(score, 6) as score, bandwidth, neighbours from scores
qualify row_number() over (order by score, bandwidth, neighbours) = 1""")
def best_bandwidth(spark, sf_dir):
    scores = kn.leave_one_out(curve(spark, sf_dir), [0.5, 1.0, 2.0], [1, 5, 20])
    return kn.best_score(scores, ["bandwidth", "neighbours"]).withColumn("score", r("score", 6))


@query("single_index", "L8", f"""
with {POINTS_SQL},
i as (select id, b as direction, x1 + b * (c_nationkey / 10) as v, x2 as y
      from points join customer on c_custkey = id,
      (values (-2.0::double), (-1.0), (0.0), (1.0), (2.0)) t(b)),
d as (select a.direction, a.id, a.y, b.y as z, abs(a.v - b.v) as d,
             rank() over (partition by a.direction, a.id order by abs(a.v - b.v)) as k
      from i a join i b on a.direction = b.direction and a.id <> b.id),
f as (select direction, id, y, sum(exp(-0.5 * d * d) * z) / sum(exp(-0.5 * d * d)) as p
      from d where k <= 20 group by direction, id, y)
select direction, round(avg((y - p) ** 2), 6) as score from f group by direction""")
def single_index(spark, sf_dir):
    data = points(spark, sf_dir).join(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey"), "id")
    data = stage(data.withColumn("x3", F.col("c_nationkey") / 10), "points")
    out = kn.single_index(data, "x1", "x3", "x2", [-2.0, -1.0, 0.0, 1.0, 2.0], 1.0, 20)
    return out.withColumn("score", r("score", 6))


def daily_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for draws: per priority, the mean order total of each day, numbered by day."""
    from pyspark.sql import Window

    days = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("param"), F.col("o_orderdate").cast("date").alias("day")
    ).agg((F.sum(cents("o_totalprice")) / 100 / F.count(F.lit(1)) / 100000).alias("value"))
    # one row per calendar day
    i = F.row_number().over(Window.partitionBy("param").orderBy("day")) - 1
    return days.select("param", i.cast("int").alias("iter"), "value")


DRAWS_SQL = """
draws as (
  select o_orderpriority as param, row_number() over (partition by o_orderpriority order by cast(o_orderdate as date)) - 1 as iter,
         cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) / 100 / count(*) / 100000 as value
  from orders group by o_orderpriority, cast(o_orderdate as date)),
kept as (select * from draws where iter >= 100 and (iter - 100) % 2 = 0)
"""


@query("kept_draws", "M3", f"with {DRAWS_SQL} select param, cast(iter as integer) as iter, value from kept")
def kept_draws(spark, sf_dir):
    return po.kept_draws(daily_draws(spark, sf_dir), 100, 2)


@query("posterior_table", "D15 M4", f"""
with {DRAWS_SQL}
select param, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as sd, round(median(value), 6) as median,
       round(quantile_cont(value, 0.1), 6) as p10, round(quantile_cont(value, 0.9), 6) as p90,
       round(avg(ln(value)), 6) as mean_log from kept group by param""")
def posterior_table(spark, sf_dir):
    out = po.summary(po.kept_draws(daily_draws(spark, sf_dir), 100, 2), ["param"])
    return out.select("param", *[r(c, 6).alias(c) for c in out.columns if c != "param"])


@query("order_statistics", "D15", f"""
with {DRAWS_SQL}, k as (select param, value, row_number() over (partition by param order by value) as rn,
  count(*) over (partition by param) as n from draws)
select param, value from k where rn = cast(round_even(n * 0.3, 0) as bigint)""")
def order_statistics(spark, sf_dir):
    return po.order_statistic(daily_draws(spark, sf_dir), ["param"], "value", 0.3)


@query("shortest_interval", "M5", f"""
with {DRAWS_SQL}, k as (select param, value, row_number() over (partition by param order by value) as rn,
  count(*) over (partition by param) as n from draws),
p as (select a.param, a.rn, a.value as low, b.value as high from k a join k b on a.param = b.param
        and b.rn = a.rn + a.n - cast(round_even(a.n * (1 - 0.9), 0) as bigint)
      where a.rn between 2 and cast(round_even(a.n * (1 - 0.9), 0) as bigint))
select param, low, high from p qualify row_number() over (partition by param order by high - low, rn) = 1""")
def shortest_interval(spark, sf_dir):
    return po.shortest_interval(daily_draws(spark, sf_dir), ["param"], "value", 0.9)


@query("stationarity_test", "M6", f"""
with {DRAWS_SQL}, k as (select *, iter + 1 as i, count(*) over (partition by param) as n from draws),
h as (select *, cast(round_even(n * 0.1, 0) as bigint) as e, cast(round_even(n * 0.5, 0) as bigint) as l from k),
m as (select param, avg(value) filter (i <= e) as a, avg(value) filter (i > l) as b,
             sqrt(var_pop(value) filter (i <= e) / max(e) + var_pop(value) filter (i > l) / max(l)) as se from h group by param)
select param, round(a, 6) as mean_first, round(b, 6) as mean_second, round(se, 6) as se, round((a - b) / se, 5) as z from m""")
def stationarity_test(spark, sf_dir):
    out = po.stationarity(daily_draws(spark, sf_dir), ["param"], "iter", "value")
    return out.select("param", *[r(c, 6).alias(c) for c in ("mean_first", "mean_second", "se")], r("z", 5).alias("z"))


@query("stationarity_p_values", "M6")
def stationarity_p_values(spark, sf_dir):
    out = po.stationarity(daily_draws(spark, sf_dir), ["param"], "iter", "value")
    return out.withColumn("p", po.lower_tail(F.col("z")))


@query("long_run_mean", "M7", f"""
with {DRAWS_SQL},
w as (select iter, max(case when param = '1-URGENT' then value / 10 end) as b0,
             max(case when param = '2-HIGH' then value / 10 end) as b1,
             max(case when param = '3-MEDIUM' then value / 10 end) as b2 from draws group by iter)
select cast(iter as integer) as iter, round(b0 / nullif(1 - (b1 + b2), 0), 5) as value from w""")
def long_run_mean(spark, sf_dir):
    draws = daily_draws(spark, sf_dir).withColumn("value", F.col("value") / 10)
    return po.long_run_mean(draws, ["iter"], ["1-URGENT", "2-HIGH", "3-MEDIUM"]).withColumn("value", r("value", 5))


@query("long_run_mean_all_terms", "M7", f"""
with {DRAWS_SQL},
w as (select iter, max(case when param = '1-URGENT' then value / 10 end) as b0,
             max(case when param = '2-HIGH' then value / 10 end) as b1, max(case when param = '3-MEDIUM' then value / 10 end) as b2,
             max(case when param = '4-NOT SPECIFIED' then value / 10 end) as b3, max(case when param = '5-LOW' then value / 10 end) as b4
      from draws group by iter)
select cast(iter as integer) as iter, round(b0 / nullif(1 - (b1 + b2 + b3 + b4), 0), 5) as value from w""")
def long_run_mean_all_terms(spark, sf_dir):
    """The first priority as the constant, all others as lags."""
    draws = daily_draws(spark, sf_dir).withColumn("value", F.col("value") / 10)
    terms = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return po.long_run_mean(draws, ["iter"], terms).withColumn("value", r("value", 5))


@query("value_histogram", "D20", f"""
with {DRAWS_SQL}, s as (select min(value) as lo, max(value) as hi from draws)
select param, cast(least(floor((value - lo) / (hi - lo) * 25) + 1, 25) as integer) as bin, count(*) as n
from draws, s group by 1, 2""")
def value_histogram(spark, sf_dir):
    draws = stage(daily_draws(spark, sf_dir), "draws")
    return histogram(draws, "value", 25, ["param"])


@query("draw_autocorrelation", "E26 M3", f"""
with {DRAWS_SQL},
x as (select param, iter, value - avg(value) over (partition by param) as d from draws),
v as (select param, sum(d * d) as v from x group by param),
k as (select x.param, l.lag, sum(x.d * y.d) as c from x, (select unnest(range(0, 11)) as lag) l, x y
      where y.param = x.param and y.iter = x.iter - l.lag group by x.param, l.lag)
select k.param, cast(k.lag as integer) as lag, round(k.c / v.v, 6) as acf from k join v on k.param = v.param""")
def draw_autocorrelation(spark, sf_dir):
    out = dc.autocorrelation(daily_draws(spark, sf_dir), ["param"], "iter", "value", 10)
    return out.withColumn("acf", r("acf", 6))


XS = ["const", "displ", "coupon", "logprice"]


def brand_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for store sales: line items by brand."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    return table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.log(F.col("l_extendedprice") / 1000).alias("logsales"), F.lit(1.0).alias("const"),
        (F.col("l_discount") > 0.05).cast("double").alias("displ"),
        (F.col("l_tax") > 0.04).cast("double").alias("coupon"), F.log("l_quantity").alias("logprice"),
    ).join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")


@query("brand_gram", "D18 M1", """
with b as (
  select p_brand as brand, ln(l_extendedprice / 1000) as y, cast(l_discount > 0.05 as double) as d,
         cast(l_tax > 0.04 as double) as c, ln(l_quantity) as q
  from lineitem join part on l_partkey = p_partkey)
select brand, count(*) as n, round(sum(y * y), 2) as yy, round(sum(y), 3) as xy_0, round(sum(d * y), 3) as xy_1,
       round(sum(c * y), 3) as xy_2, round(sum(q * y), 2) as xy_3, round(sum(d), 2) as xx_0_1, round(sum(d * c), 2) as xx_1_2,
       round(sum(q * q), 2) as xx_3_3 from b group by brand""")
def brand_gram(spark, sf_dir):
    g = ls.gram(brand_sales(spark, sf_dir), XS, "logsales", ["brand"])
    digits = {"xy_0": 3, "xy_1": 3, "xy_2": 3}
    names = ["yy", "xy_0", "xy_1", "xy_2", "xy_3", "xx_0_1", "xx_1_2", "xx_3_3"]
    return g.select("brand", "n", *[r(c, digits.get(c, 2)).alias(c) for c in names])


def _posterior(spark, sf_dir, bounded: str | None) -> DataFrame:
    sums = ls.gram(brand_sales(spark, sf_dir), XS, "logsales", ["brand"])
    draws = po.regression_draws(sums, XS, ["brand"], 2000, chains=2, bounded=bounded, bound=0.0)
    return po.summary(po.kept_draws(draws, 500, 3), ["brand", "param"])


@query("brand_posterior", "M1 M3 M4 U2")
def brand_posterior(spark, sf_dir):
    return _posterior(spark, sf_dir, None)


@query("brand_posterior_bounded", "M2 M3 M4")
def brand_posterior_bounded(spark, sf_dir):
    return _posterior(spark, sf_dir, "displ")


@query("autoregression_forecast_draws", "E4 E21 M8")
def autoregression_forecast_draws(spark, sf_dir):
    from pyspark.sql import Window

    draws = daily_draws(spark, sf_dir).withColumnRenamed("value", "y")
    series = win.lagged(draws, ["param"], "iter", "y", 2)
    xs = ["const", "y_lag1", "y_lag2"]
    sums = ls.gram(series.dropna(), xs, "y", ["param"]).withColumnRenamed("param", "series")
    posterior = po.regression_draws(sums, xs, ["series"], 1000)
    kept = po.kept_draws(posterior, 200, 1)
    newest = F.row_number().over(Window.partitionBy("param").orderBy(F.col("iter").desc()))
    last = draws.withColumn("_r", newest).filter(F.col("_r") <= 2).groupBy(F.col("param").alias("series")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_r", "y"))), lambda s: s["y"]).alias("recent"))
    paths = po.forecast_draws(kept, last, ["series"], ["y_lag1", "y_lag2"], "const", 2)
    return po.interval(paths, ["series", "step"], "value", 0.1)


@query("autoregression_mean_paths", "M8", f"""
with {DRAWS_SQL},
ranked as (select param, value, row_number() over (partition by param order by iter desc) as k from draws),
s as (select param as series, avg(value) / 4 as c, max(case when k = 1 then value end) as v1,
             max(case when k = 2 then value end) as v2 from ranked group by param),
a as (select *, c + 0.5 * v1 + 0.25 * v2 as f1 from s),
b as (select *, c + 0.5 * f1 + 0.25 * v1 as f2 from a),
d as (select *, c + 0.5 * f2 + 0.25 * f1 as f3 from b)
select series, cast(k as integer) as step, round(case k when 0 then f1 when 1 then f2 else f3 end, 6) as value
from d, (select unnest(range(0, 3)) as k) steps""")
def autoregression_mean_paths(spark, sf_dir):
    """Paths of draws without variance: the recursion of the means itself."""
    from pyspark.sql import Window

    draws = daily_draws(spark, sf_dir)
    newest = F.row_number().over(Window.partitionBy("param").orderBy(F.col("iter").desc()))
    ranked = draws.withColumn("_r", newest)
    last = ranked.filter(F.col("_r") <= 2).groupBy(F.col("param").alias("series")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_r", "value"))), lambda s: s["value"]).alias("recent"))
    terms = F.create_map(F.lit("const"), F.avg("value") / 4, F.lit("y_lag1"), F.lit(0.5), F.lit("y_lag2"), F.lit(0.25),
                         F.lit("sigma2"), F.lit(0.0))
    fixed = draws.groupBy(F.col("param").alias("series")).agg(terms.alias("t")).select(
        "series", F.lit(0).alias("chain"), F.lit(0).alias("iter"), F.explode("t").alias("param", "value"))
    paths = po.forecast_draws(fixed, last, ["series"], ["y_lag1", "y_lag2"], "const", 3)
    return paths.select("series", "step", r("value", 6).alias("value"))
