"""Choice models: each line item chooses the region of its supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import choice as ch
from tallyloom.operators import logittable as lt
from tallyloom.plans.panel_queries import r
from tallyloom.plans.registry import query
from tallyloom.plans.standins import cents, month_of, table
from tallyloom.session import stage

# The alternatives (first is the base), attributes and the coefficients at
# which single steps are compared with SQL.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE_EAST"]
ATTRIBUTES = ["price", "dis", "feature"]
TERMS = ch.names(REGIONS, ATTRIBUTES)
THETA = [0.1, -0.05, 0.02, 0.08, -0.8, 0.5, 0.3]


def chosen_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, choice, holdout, ...): one row per line item."""
    lines = table(spark, sf_dir, "lineitem").select(
        month_of("l_shipdate").alias("month"), "l_suppkey", "l_quantity",
        cents("l_extendedprice").alias("cents"), "l_discount", "l_tax", "l_returnflag")
    regions = (
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
              F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.replace("r_name", F.lit(" "), F.lit("_")).alias("choice")))
    return lines.join(regions, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "month", "choice", "l_quantity", "cents", "l_discount", "l_tax", "l_returnflag")


def choice_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide occasions: (month, choice, l_returnflag, n) with price_R, dis_R, feature_R.

    Occasions of one month share their attributes, so they are counted map-side first;
    months in which some region is not available leave.
    """
    cells = stage(
        chosen_lines(spark, sf_dir).groupBy("month", "choice", "l_returnflag").agg(
            F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"), F.sum("cents").alias("cents"),
            F.count_if(F.col("l_discount") > 0.05).alias("dis"), F.count_if(F.col("l_tax") > 0.04).alias("feature")),
        "choices")
    by_region = cells.groupBy("month", "choice").agg(
        (F.sum("cents") / 100 / F.sum("quantity") / 1000).alias("price"),
        (F.sum("dis") / F.sum("n")).alias("dis"), (F.sum("feature") / F.sum("n")).alias("feature"))
    wide = by_region.groupBy("month").agg(*[
        F.max(F.when(F.col("choice") == a, F.col(x))).alias(f"{x}_{a}") for a in REGIONS for x in ATTRIBUTES
    ]).dropna()
    return cells.select("month", "choice", "l_returnflag", "n").join(wide, "month")


def choice_rows(spark, sf_dir, keep: list[str] | None = None) -> DataFrame:
    return ch.occasions(choice_table(spark, sf_dir), "choice", REGIONS, ATTRIBUTES, keep, weight="n")


CHOICE_SQL = f"""
lines as (
  select cast(date_trunc('month', l_shipdate) as date) as month, replace(r.r_name, ' ', '_') as alt, l_returnflag,
         l_quantity as q, cast(round(l_extendedprice * 100) as bigint) as cents, l_discount > 0.05 as d, l_tax > 0.04 as f
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  join region r on n_regionkey = r_regionkey),
attrs0 as (
  select month, alt, cast(sum(cents) as double) / 100 / sum(q) / 1000 as price,
         cast(count(*) filter (d) as double) / count(*) as dis, cast(count(*) filter (f) as double) / count(*) as feature
  from lines group by month, alt),
attrs as (select *, list_position(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE_EAST'], alt) as j from attrs0
          where month in (select month from attrs0 group by month having count(*) = 5)),
chosen as (select month, alt, l_returnflag, cast(count(*) as double) as n from lines
           where month in (select month from attrs) group by month, alt, l_returnflag),
totals as (select month, sum(n) as n from chosen group by month),
util as (select *, [0.0, 0.1, -0.05, 0.02, 0.08][j] - 0.8 * price + 0.5 * dis + 0.3 * feature as u from attrs),
prob as (select *, exp(u) / sum(exp(u)) over (partition by month) as p from util)
"""


@query("choice_long_table", "J1 J2 J3", f"""
with {CHOICE_SQL}
select a.month, a.alt, cast(sum(c.n) as bigint) as occasions,
       cast(sum(case when c.alt = a.alt then c.n else 0 end) as bigint) as chosen, a.price, a.dis, a.feature
from attrs a join chosen c on a.month = c.month group by a.month, a.alt, a.price, a.dis, a.feature""")
def choice_long_table(spark, sf_dir):
    wide = choice_table(spark, sf_dir).withColumns(
        {f"is_{a}": (F.col("choice") == a).cast("int") for a in REGIONS})
    named = wide.withColumn("picked", ch.chosen_from_flags({a: f"is_{a}" for a in REGIONS}))
    long = ch.wide_to_long(named, "month", "picked", REGIONS, ATTRIBUTES, keep=["n"])
    present = ch.available_only(long.withColumn("available", F.col("price").isNotNull()))
    return present.groupBy("month", "alt", *ATTRIBUTES).agg(
        F.sum("n").alias("occasions"), F.sum(F.when(F.col("chosen"), F.col("n")).otherwise(0)).alias("chosen")
    ).select("month", "alt", "occasions", "chosen", *ATTRIBUTES)


@query("choice_share_table", "D12 J12", f"""
with {CHOICE_SQL},
long as (select a.alt, c.alt = a.alt as hit, a.price, a.dis, a.feature
         from lines c join attrs a on a.month = c.month)
select alt, count(*) filter (hit) as n, round(avg(price), 6) as mean_price, round(avg(dis), 6) as mean_dis,
       round(avg(feature), 6) as mean_feature, round(avg(price) filter (hit), 6) as chosen_price,
       round(avg(dis) filter (hit), 6) as chosen_dis, round(avg(feature) filter (hit), 6) as chosen_feature,
       round(100.0 * count(*) filter (hit) / count(*), 6) as share
from long group by alt""")
def choice_share_table(spark, sf_dir):
    counted = choice_table(spark, sf_dir)
    long = ch.wide_to_long(counted, "month", "choice", REGIONS, ATTRIBUTES, keep=["n"])
    out = ch.share_table(long, ATTRIBUTES, "n")
    return out.select("alt", "n", *[r(c, 6).alias(c) for c in out.columns if c not in ("alt", "n")])


@query("logit_likelihood", "J5 J7", f"""
with {CHOICE_SQL},
ll as (select sum(c.n * ln(p.p)) as loglik from chosen c join prob p on c.month = p.month and c.alt = p.alt),
k as (select alt, sum(n) as n from chosen group by alt),
z as (select sum(n * ln(n / (select sum(n) from k))) as z from k)
select round(loglik, 3) as loglik, round(z, 3) as loglik_null, round(1 - loglik / z, 7) as mcfadden from ll, z""")
def logit_likelihood(spark, sf_dir):
    out = ch.log_likelihood(choice_rows(spark, sf_dir), THETA)
    return out.select(r("loglik", 3).alias("loglik"), r("loglik_null", 3).alias("loglik_null"),
                      r("mcfadden", 7).alias("mcfadden"))


@query("logit_gradient", "J5", f"""
with {CHOICE_SQL},
x as (select p.*, [cast(j = 2 as double), cast(j = 3 as double), cast(j = 4 as double), cast(j = 5 as double),
                   price, dis, feature] as v from prob p),
g as (select t.i, sum(coalesce(c.n, 0) * x.v[t.i] - m.n * x.p * x.v[t.i]) as g
      from x join totals m on x.month = m.month
      left join (select month, alt, sum(n) as n from chosen group by month, alt) c on c.month = x.month and c.alt = x.alt,
      (select unnest(range(1, 8)) as i) t group by t.i)
select ['const_AMERICA', 'const_ASIA', 'const_EUROPE', 'const_MIDDLE_EAST', 'price', 'dis', 'feature'][i] as term,
       round(g, 4) as gradient from g""")
def logit_gradient(spark, sf_dir):
    row = ch.derivatives(choice_rows(spark, sf_dir), THETA)
    pairs = F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"g_{i}").alias("gradient")) for i, t in enumerate(TERMS)])
    return row.select(F.inline(pairs)).withColumn("gradient", r("gradient"))


@query("choice_probabilities", "J8", f"""
with {CHOICE_SQL}
select month, alt, round(p, 8) as probability, first_value(alt) over (partition by month order by p desc, j) as predicted
from prob""")
def choice_probabilities(spark, sf_dir):
    rows = choice_rows(spark, sf_dir, ["month"])
    scored = ch.with_probabilities(rows.dropDuplicates(["month"]), ch.literal(THETA)).withColumn(
        "predicted", ch.predicted_class("p", REGIONS))
    long = ch.alternative_rows(scored, REGIONS, ["month", "predicted"])
    return long.select("month", "alt", r("probability", 8).alias("probability"), "predicted")


@query("partial_effects", "J9", f"""
with {CHOICE_SQL}
select a.alt as share_of, b.alt as changed,
       round(sum(t.n * -0.8 * a.p * (cast(a.alt = b.alt as integer) - b.p)) / sum(t.n), 8) as effect
from prob a join prob b on a.month = b.month join totals t on a.month = t.month group by a.alt, b.alt""")
def partial_effects(spark, sf_dir):
    scored = ch.with_probabilities(choice_rows(spark, sf_dir), ch.literal(THETA))
    out = ch.partial_effects(scored, REGIONS, THETA[TERMS.index("price")])
    return out.withColumn("effect", r("effect", 8))


MEANS_SQL = CHOICE_SQL + """,
means as (select a.alt, a.j, sum(t.n * price) / sum(t.n) as price, sum(t.n * dis) / sum(t.n) as dis,
                 sum(t.n * feature) / sum(t.n) as feature
          from attrs a join totals t on a.month = t.month group by a.alt, a.j),
mu as (select *, [0.0, 0.1, -0.05, 0.02, 0.08][j] - 0.8 * price + 0.5 * dis + 0.3 * feature as u from means)
"""


@query("effects_at_means", "J9", f"""
with {MEANS_SQL}, q as (select alt, exp(u) / sum(exp(u)) over () as p from mu)
select a.alt as share_of, b.alt as changed, round(-0.8 * a.p * (cast(a.alt = b.alt as integer) - b.p), 8) as effect
from q a, q b""")
def effects_at_means(spark, sf_dir):
    out = ch.effects_at_means(choice_rows(spark, sf_dir), THETA, REGIONS, THETA[TERMS.index("price")])
    return out.withColumn("effect", r("effect", 8))


@query("scenario_effect", "J10", f"""
with {CHOICE_SQL},
z as (select month, alt, j, [0.0, 0.1, -0.05, 0.02, 0.08][j] - 0.8 * price as u0 from attrs),
s as (select month, alt, exp(u0) / sum(exp(u0)) over (partition by month) as p0,
             exp(u0 + case when alt = 'EUROPE' then 0.5 else 0 end)
             / sum(exp(u0 + case when alt = 'EUROPE' then 0.5 else 0 end)) over (partition by month) as p1 from z)
select alt, round(sum(t.n * (p1 - p0)) / sum(t.n), 8) as effect
from s join totals t on s.month = t.month group by alt""")
def scenario_effect(spark, sf_dir):
    flags = [TERMS.index("dis"), TERMS.index("feature")]
    out = ch.scenario_effect(
        choice_rows(spark, sf_dir), THETA, REGIONS, flags[0], flags, REGIONS.index("EUROPE"))
    return out.withColumn("effect", r("effect", 8))


@query("probability_curve", "B21 J14 J15", f"""
with {MEANS_SQL},
b as (select min(price) as lo, max(price) as hi from attrs where alt = 'ASIA'),
g as (select lo + (hi - lo) * s / 20 as value from b, (select unnest(range(0, 21)) as s)),
o as (select sum(exp(u)) as others from mu where alt <> 'ASIA'),
a as (select j, dis, feature from mu where alt = 'ASIA'),
c as (select value, exp(-0.05 - 0.8 * value + 0.5 * dis + 0.3 * feature) as e, others from g, o, a),
p as (select value, e / (e + others) as p from c)
select round(value, 8) as value, round(p, 8) as probability, round(-0.8 * value * p * (1 - p), 8) as elasticity,
       round(-0.8 * value * (1 - p), 8) as elasticity_textbook from p""")
def probability_curve(spark, sf_dir):
    out = ch.probability_curve(
        choice_rows(spark, sf_dir), THETA, REGIONS, TERMS.index("price"), REGIONS.index("ASIA"), 21)
    return out.select(*[r(c, 8).alias(c) for c in out.columns])


@query("realisation_table", "D13 J4 J8 J13", f"""
with {CHOICE_SQL},
best as (select month, alt as predicted from prob qualify row_number() over (partition by month order by p desc, j) = 1),
c as (select case when l_returnflag = 'R' then 'test' else 'train' end as part, chosen.alt as actual, predicted, n
      from chosen join best on chosen.month = best.month),
k as (select part, actual, predicted, sum(n) as n from c group by part, actual, predicted)
select part, actual, predicted, round(n / sum(n) over (partition by part), 8) as share,
       round(sum(case when actual = predicted then n else 0 end) over (partition by part)
             / sum(n) over (partition by part), 8) as hit_rate from k""")
def realisation_table(spark, sf_dir):
    wide = choice_table(spark, sf_dir).withColumn("last", (F.col("l_returnflag") == "R").cast("int"))

    def part(rows: DataFrame, name: str) -> DataFrame:
        x = ch.occasions(rows, "choice", REGIONS, ATTRIBUTES, ["choice"], weight="n")
        scored = ch.with_probabilities(x, ch.literal(THETA)).withColumn("predicted", ch.predicted_class("p", REGIONS))
        out = ch.realisation_table(scored.withColumnRenamed("choice", "actual"), "actual", "predicted")
        return out.select(F.lit(name).alias("part"), "actual", "predicted", r("share", 8).alias("share"),
                          r("hit_rate", 8).alias("hit_rate"))

    train, test = ch.split_by_flag(wide, "last")
    return part(train, "train").unionByName(part(test, "test"))


def _fit_frame(spark, fits: dict) -> DataFrame:
    rows = [
        (str(g), t, float(f.theta[i]), float(f.errors[i]), float(f.loglik), float(abs(f.gradient).max()), f.steps)
        for g, f in sorted(fits.items()) for i, t in enumerate(f.names)
    ]
    return spark.createDataFrame(
        rows, "dataset string, term string, beta double, se double, loglik double, gradient double, steps int")


@query("logit_fit", "J5 J6")
def logit_fit(spark, sf_dir):
    return _fit_frame(spark, {"all": ch.fit_logit(choice_rows(spark, sf_dir), TERMS)})


@query("logit_fit_by_dataset", "A8 J5 J6 J16")
def logit_fit_by_dataset(spark, sf_dir):
    rows = choice_rows(spark, sf_dir, ["l_returnflag"])
    fits = lt.coefficients(lt.fit_logit_table(rows, TERMS, "l_returnflag"), TERMS, "l_returnflag")
    return fits.withColumnRenamed("l_returnflag", "dataset")


@query("independence_test", "J11")
def independence_test(spark, sf_dir):
    wide = stage(choice_table(spark, sf_dir), "occasions")
    full = ch.fit_logit(ch.occasions(wide, "choice", REGIONS, ATTRIBUTES, weight="n"), TERMS)
    some = REGIONS[:3]
    left = wide.filter(F.col("choice").isin(some))
    subset = ch.fit_logit(ch.occasions(left, "choice", some, ATTRIBUTES, weight="n"), ch.names(some, ATTRIBUTES))
    value, df, p = ch.independence_test(full, subset)
    return spark.createDataFrame([(value, df, p)], "statistic double, df int, p double")


@query("dataset_answers", "A8 J5 J7 J9 J10 J11 J16")
def dataset_answers(spark, sf_dir):
    key, some = "l_returnflag", REGIONS[:3]
    wide = stage(choice_table(spark, sf_dir), "occasions")
    rows = ch.occasions(wide, "choice", REGIONS, ATTRIBUTES, [key], weight="n")
    part = ch.occasions(wide.filter(F.col("choice").isin(some)), "choice", some, ATTRIBUTES, [key], weight="n")
    few = ch.names(some, ATTRIBUTES)
    fits, subset = lt.fit_logit_table(rows, TERMS, key), lt.fit_logit_table(part, few, key)
    return lt.answers(rows, key, fits, TERMS, subset, few, REGIONS, "price", "dis", ["dis", "feature"], "EUROPE")


@query("dataset_constants", "A8 J5 J6 J16", f"""
with {CHOICE_SQL}, k as (select month, alt, sum(n) as n from chosen group by month, alt),
b as (select month, n as base from k where alt = 'AFRICA'), t as (select month, sum(n) as n from k group by month)
select month, 'const_' || alt as term, round(ln(k.n / base), 6) as beta, round(sqrt(1 / k.n + 1 / base), 6) as se,
       round((select sum(z.n * ln(z.n / t.n)) from k z where z.month = k.month), 3) as loglik
from k join b using (month) join t using (month)
where alt <> 'AFRICA' and (select count(*) from k z where z.month = k.month) = 5""")
def dataset_constants(spark, sf_dir):
    """Constants of every month's choices: closed forms, months without one of the regions left out."""
    wide = stage(choice_table(spark, sf_dir), "occasions")
    whole = wide.filter("n > 0").groupBy("month").agg(F.count_distinct("choice").alias("seen")).filter(F.col("seen") == len(REGIONS))
    terms = ch.names(REGIONS, [])
    rows = ch.occasions(wide.join(whole, "month", "left_semi"), "choice", REGIONS, [], ["month"], weight="n")
    fits = lt.coefficients(lt.fit_logit_table(rows, terms, "month", tolerance=1e-20), terms, "month")
    return fits.select("month", "term", r("beta", 6).alias("beta"), r("se", 6).alias("se"), r("loglik", 3).alias("loglik"))


@query("independence_statistics", "J11 J16", f"""
with {CHOICE_SQL}, k as (select alt, l_returnflag as flag, sum(n) as n, coalesce(sum(n) filter (month(month) % 2 = 1), 0) as m
                         from chosen group by 1, 2),
v as (select flag, sum(n) filter (alt = 'AFRICA') as na, sum(n) filter (alt = 'AMERICA') as nb,
             sum(m) filter (alt = 'AFRICA') as ma, sum(m) filter (alt = 'AMERICA') as mb from k group by flag)
select flag, round(pow(ln(mb / ma) - ln(nb / na), 2) / (1 / ma + 1 / mb - 1 / na - 1 / nb), 4) as statistic, 1 as degrees from v""")
def independence_statistics(spark, sf_dir):
    """Constants of all five regions against those of two of them in the odd months: a closed form."""
    key, some = "l_returnflag", REGIONS[:2]
    wide = stage(choice_table(spark, sf_dir), "occasions")
    all_terms, few = ch.names(REGIONS, []), ch.names(some, [])
    full = lt.fit_logit_table(ch.occasions(wide, "choice", REGIONS, [], [key], weight="n"), all_terms, key, tolerance=1e-14)
    odd = wide.filter(F.col("choice").isin(some) & (F.month("month") % 2 == 1))
    subset = lt.fit_logit_table(ch.occasions(odd, "choice", some, [], [key], weight="n"), few, key, tolerance=1e-14)
    found = lt.independence_tests(full, all_terms, subset, few, key)
    return found.select(F.col(key).alias("flag"), r("statistic").alias("statistic"), "degrees")


@query("logit_constants_only", "J5 J6 J7", f"""
with {CHOICE_SQL}, k as (select alt, sum(n) as n from chosen group by alt),
b as (select n as base from k where alt = 'AFRICA')
select 'const_' || alt as term, round(ln(n / base), 6) as beta, round(sqrt(1 / n + 1 / base), 6) as se,
       round((select sum(n * ln(n / (select sum(n) from k))) from k), 3) as loglik
from k, b where alt <> 'AFRICA'""")
def logit_constants_only(spark, sf_dir):
    rows = ch.occasions(choice_table(spark, sf_dir), "choice", REGIONS, [], weight="n")
    fits = _fit_frame(spark, {"all": ch.fit_logit(rows, ch.names(REGIONS, []))})
    return fits.select("term", r("beta", 6).alias("beta"), r("se", 6).alias("se"), r("loglik", 3).alias("loglik"))
