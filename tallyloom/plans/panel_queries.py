"""Panel building: prices, joins, densify, fills, scaling, partner choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.scalar import unit_price, zeros_to_null
from tallyloom.operators import fill, panel, scale
from tallyloom.plans.registry import query
from tallyloom.plans.standins import (
    FUTURES_SQL, MACRO_SQL, OIL_SQL, TRADE_SQL, exact_prices, indicator_records, monthly_futures,
    monthly_oil, product_cells, stored_cells, stored_product_cells, table, trade_cells, weather_days, yearly_macro,
)


def r(column, digits: int = 4):
    """Round half away from zero after scaling, as SQL engines round doubles."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c * 10.0**digits) / 10.0**digits


# The part types that stand for products, and a split of them in categories.
#: The products that SQL text must spell out; the queries take them from the data.
PRODUCTS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def dense_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = stored_cells(spark, sf_dir).withColumn("price", unit_price("value", "quantity"))
    return panel.densify(cells, ["partner"], staged=False)


DENSE_SQL = TRADE_SQL + """,
dense as (
  select g.partner, g.month, c.quantity, c.value, c.value / nullif(c.quantity, 0) as price
  from grid g left join cells c on g.partner = c.partner and g.month = c.month)
"""


@query("unit_price_monthly", "A6 B2 C1 D1", f"""
with {TRADE_SQL}
select partner, month, quantity, round(value, 2) as value, round(value / nullif(quantity, 0), 4) as price
from cells""")
def unit_price_monthly(spark, sf_dir):
    cells = trade_cells(spark, sf_dir)
    return cells.select(
        "partner", "month", "quantity", r("value", 2).alias("value"),
        r(unit_price("value", "quantity")).alias("price"),
    )


@query("global_price", "C3 D1", f"""
with {TRADE_SQL}
select c.partner, g.month, round(c.value / nullif(c.quantity, 0), 4) as price,
       round(g.globalprice, 4) as globalprice
from cells c right join globals g on c.month = g.month""")
def global_price(spark, sf_dir):
    cells = stored_cells(spark, sf_dir)
    monthly = exact_prices(cells, ["month"], "globalprice").select("month", "globalprice")
    return cells.join(monthly, "month", "right").select(
        "partner", "month", r(unit_price("value", "quantity")).alias("price"),
        r("globalprice").alias("globalprice"),
    )


@query("price_by_product_month", "D1 G1", f"""
with {TRADE_SQL}
select product, month, sum(quantity) as quantity, cast(sum(cents) as bigint) as cents,
       cast(sum(cents) as double) / nullif(sum(quantity), 0) / 100 as price
from product_cells group by product, month
union all
select 'ALL' as product, month, sum(quantity), cast(sum(cents) as bigint),
       cast(sum(cents) as double) / nullif(sum(quantity), 0) / 100
from product_cells group by month""")
def price_by_product_month(spark, sf_dir):
    cells = stored_product_cells(spark, sf_dir)
    each = exact_prices(cells, ["product", "month"])
    whole = exact_prices(each, ["month"]).withColumn("product", F.lit("ALL"))
    return each.unionByName(whole).select("product", "month", "quantity", "cents", "price")


@query("indicator_pivot", "D4 D6 G2", f"""
with {TRADE_SQL},
long as (
  select distinct * from (
    select partner, month, 'quantity' as indicator, quantity as v from cells
    union all select partner, month, 'value', value from cells
    union all select partner, month, 'quantity', quantity from cells))
select partner, month, max(case when indicator = 'quantity' then v end) as quantity,
       round(max(case when indicator = 'value' then v end), 2) as value
from long group by partner, month
having max(case when indicator = 'quantity' then v end) is not null
   and max(case when indicator = 'value' then v end) is not null""")
def indicator_pivot(spark, sf_dir):
    cells = trade_cells(spark, sf_dir)
    records = indicator_records(cells)
    twice = records.unionByName(records.filter(F.col("indicator") == "quantity"))
    wide = panel.pivot_indicators(twice, ["partner", "month"], ["quantity", "value"])
    return wide.withColumn("value", r("value", 2))


@query("dense_panel", "C2 C7 U6", f"""
with {DENSE_SQL}
select partner, month, quantity, round(value, 2) as value, round(price, 4) as price from dense""")
def dense_panel(spark, sf_dir):
    return dense_cells(spark, sf_dir).select(
        "partner", "month", "quantity", r("value", 2).alias("value"), r("price").alias("price"))


@query("enriched_panel", "B7 B8 C3 C4 C5", f"""
with {DENSE_SQL}, {OIL_SQL}, {FUTURES_SQL}, {MACRO_SQL},
january as (select partner, make_date(year, 1, 1) as month, gdp from macro),
a as (
  select d.partner, g.month, d.quantity, d.price, g.globalprice
  from dense d right join globals g on d.month = g.month),
b as (
  select a.partner, coalesce(a.month, o.month) as month, a.quantity, a.price, a.globalprice, o.oil_price
  from a full join oil o on a.month = o.month),
c as (
  select b.partner, coalesce(b.month, f.month) as month, b.quantity, b.price, b.globalprice,
         b.oil_price, f.futures
  from b full join futures f on b.month = f.month),
d as (
  select coalesce(c.partner, j.partner) as partner, coalesce(c.month, j.month) as month, c.quantity,
         c.price, c.globalprice, c.oil_price, c.futures, j.gdp
  from c full join january j on c.partner = j.partner and c.month = j.month)
select partner, month, nullif(quantity, 0) as quantity, round(nullif(price, 0), 4) as price,
       round(nullif(globalprice, 0), 4) as globalprice, nullif(oil_price, 0) as oil_price,
       round(nullif(futures, 0), 4) as futures, nullif(gdp, 0) as gdp,
       coalesce(nullif(quantity, 0), 0) as quantity_or_zero
from d""")
def enriched_panel(spark, sf_dir):
    cells = stored_cells(spark, sf_dir)
    monthly = exact_prices(cells, ["month"], "globalprice").select("month", "globalprice")
    january = yearly_macro(cells).select(
        "partner", F.make_date("year", F.lit(1), F.lit(1)).alias("month"), "gdp")
    dense = panel.densify(
        cells.select("partner", "month", "quantity", unit_price("value", "quantity").alias("price")),
        ["partner"], staged=False)
    joined = (
        dense.join(monthly, "month", "right")
        .join(monthly_oil(spark, sf_dir), "month", "full")
        .join(monthly_futures(spark, sf_dir), "month", "full")
        .join(january, ["partner", "month"], "full")
    )
    clean = zeros_to_null(joined)
    return clean.select(
        "partner", "month", "quantity", r("price").alias("price"), r("globalprice").alias("globalprice"),
        "oil_price", r("futures").alias("futures"), "gdp",
        F.coalesce("quantity", F.lit(0.0)).alias("quantity_or_zero"))


@query("outer_fold_products", "C6 C16", f"""
with {TRADE_SQL},
e as (select partner, month, quantity as economy from product_cells where product = 'ECONOMY'),
l as (select partner, month, quantity as large from product_cells where product = 'LARGE'),
s as (select partner, month, quantity as standard from product_cells where product = 'STANDARD')
select partner, month, economy, large, standard
from e full join l using (partner, month) full join s using (partner, month)""")
def outer_fold_products(spark, sf_dir):
    cells = stored_product_cells(spark, sf_dir)
    parts = [
        cells.filter(F.col("product") == p).select("partner", "month", F.col("quantity").alias(p.lower()))
        for p in ("ECONOMY", "LARGE", "STANDARD")
    ]
    return panel.outer_fold(parts, ["partner", "month"])


@query("sum_of_parts", "B11 C6 D8", f"""
with {TRADE_SQL}
select partner, month, sum(quantity) as quantity, cast(sum(cents) as bigint) as cents,
       cast(sum(cents) as double) / 100 / nullif(sum(quantity), 0) as price
from product_cells where product in ('ECONOMY', 'LARGE', 'STANDARD') group by partner, month""")
def sum_of_parts(spark, sf_dir):
    cells = stored_product_cells(spark, sf_dir)
    parts = [cells.filter(F.col("product") == p) for p in ("ECONOMY", "LARGE", "STANDARD")]
    summed = panel.sum_parts(parts, ["partner", "month"], ["quantity", "cents"])
    return summed.select(
        "partner", "month", "quantity", "cents", unit_price(F.col("cents") / 100, "quantity").alias("price"))


@query("category_totals", "B11 C17 D8", f"""
with {TRADE_SQL},
t as (
  select *, case product when 'ECONOMY' then 'basic' when 'STANDARD' then 'basic'
                         when 'LARGE' then 'sized' when 'MEDIUM' then 'sized' when 'SMALL' then 'sized' end
            as category, value / nullif(quantity, 0) as price
  from product_cells)
select month, category, sum(quantity) as quantity, round(sum(value), 2) as value,
       round(sum(quantity) * sum(price), 0) as weighted_value
from t group by month, category""")
def category_totals(spark, sf_dir):
    from tallyloom.functions.scalar import category_of

    # Product code to category.
    categories = {"ECONOMY": "basic", "STANDARD": "basic", "LARGE": "sized", "MEDIUM": "sized",
                  "SMALL": "sized"}
    cells = product_cells(spark, sf_dir).withColumns(
        {"category": category_of("product", categories), "price": unit_price("value", "quantity")})
    return cells.groupBy("month", "category").agg(
        F.sum("quantity").alias("quantity"), r(F.sum("value"), 2).alias("value"),
        r(F.sum("quantity") * F.sum("price"), 0).alias("weighted_value"))


@query("share_weighted_price", "C17 D7", f"""
with {TRADE_SQL},
w as (select *, quantity / nullif(sum(quantity) over (partition by month, product), 0) as weight
      from product_cells)
select partner, month, product, round(weight, 6) as weight,
       weight * (value / nullif(quantity, 0)) as weighted_price,
       round(weight * quantity, 4) as weighted_quantity, round(weight * value, 3) as weighted_value
from w""")
def share_weighted_price(spark, sf_dir):
    cells = stored_product_cells(spark, sf_dir).withColumn("price", unit_price("value", "quantity"))
    w = panel.share_weights(cells, ["month", "product"])
    return w.select(
        "partner", "month", "product", r("weight", 6).alias("weight"),
        "weighted_price", r("weighted_quantity").alias("weighted_quantity"),
        r("weighted_value", 3).alias("weighted_value"))


@query("top_mean_partners", "D2 F2", f"""
with {TRADE_SQL},
m as (select product, partner, avg(quantity) as mean from product_cells group by product, partner),
k as (select *, row_number() over (partition by product order by mean desc, partner) as rank from m)
select cast(rank as integer) as rank, max(case when product = 'ECONOMY' then partner end) as "ECONOMY",
       max(case when product = 'LARGE' then partner end) as "LARGE",
       max(case when product = 'MEDIUM' then partner end) as "MEDIUM",
       max(case when product = 'PROMO' then partner end) as "PROMO",
       max(case when product = 'SMALL' then partner end) as "SMALL",
       max(case when product = 'STANDARD' then partner end) as "STANDARD"
from k where rank <= 10 group by rank""")
def top_mean_partners(spark, sf_dir):
    cells = stored_product_cells(spark, sf_dir)
    return panel.top_means(cells, "product", "partner", "quantity", panel.names(cells, "product"), 10)


@query("top_mean_partners_zero_filled", "D2 G1", f"""
with {TRADE_SQL},
g as (select gr.partner, gr.month, coalesce(c.quantity, 0) as quantity
      from grid gr left join cells c on gr.partner = c.partner and gr.month = c.month),
m as (select partner, avg(quantity) as mean from g group by partner)
select cast(row_number() over (order by mean desc, partner) as integer) as rank, partner, round(mean, 6) as mean
from m qualify row_number() over (order by mean desc, partner) <= 10""")
def top_mean_partners_zero_filled(spark, sf_dir):
    from pyspark.sql import Window

    means = dense_cells(spark, sf_dir).groupBy("partner").agg(
        F.avg(F.coalesce("quantity", F.lit(0.0))).alias("mean"))
    best = means.orderBy(F.col("mean").desc(), "partner").limit(10)
    # ten rows
    rank = F.row_number().over(Window.orderBy(F.col("mean").desc(), "partner"))
    return best.select(rank.alias("rank"), "partner", r("mean", 6).alias("mean"))


@query("weather_rollup", "A1 D3", """
with d as (
  select event_type as country, cast(ts as date) as day, avg(value - 1) as tmin, avg(value) as tavg,
         avg(value + 1) as tmax from events group by 1, 2)
select country, cast(date_trunc('month', day) as date) as month, round(avg(tavg), 4) as avg_tavg,
       round(min(tmin), 4) as min_tmin, round(max(tmax), 4) as max_tmax
from d group by 1, 2""")
def weather_rollup(spark, sf_dir):
    out = panel.daily_then_monthly(weather_days(spark, sf_dir), ["country"], "day")
    return out.select("country", "month", r("avg_tavg").alias("avg_tavg"),
                      r("min_tmin").alias("min_tmin"), r("max_tmax").alias("max_tmax"))


@query("wide_month_table", "D5 F4", f"""
with {TRADE_SQL}
select month, {', '.join(f"avg(case when product = '{p}' then quantity end) as mean_{p.lower()}" for p in PRODUCTS)}
from product_cells group by month""".replace("avg(", "round(avg(").replace(" end) as", " end), 6) as"))
def wide_month_table(spark, sf_dir):
    cells = stored_product_cells(spark, sf_dir)
    products = panel.names(cells, "product")
    wide = panel.to_wide(cells, "month", "product", "quantity", products)
    return wide.select("month", *[r(p, 6).alias(f"mean_{p.lower()}") for p in products])


@query("long_feature_rows", "D6 D19", f"""
with {TRADE_SQL}, l as (
  select partner, month, 'quantity' as feature, quantity as value from cells
  union all select partner, month, 'value', value from cells)
select feature, count(distinct partner) as partners, count(distinct month) as months, count(*) as n,
       round(sum(value), 1) as total from l group by feature""")
def long_feature_rows(spark, sf_dir):
    long = panel.to_long(trade_cells(spark, sf_dir), ["partner", "month"], ["quantity", "value"])
    return long.groupBy("feature").agg(
        F.count_distinct("partner").alias("partners"), F.count_distinct("month").alias("months"),
        F.count(F.lit(1)).alias("n"), r(F.sum("value"), 1).alias("total"))


@query("outlier_mask", "E9 D9", f"""
with {DENSE_SQL},
s as (select avg(price) as pm, stddev_samp(price) as ps, avg(quantity) as qm, stddev_samp(quantity) as qs from dense)
select partner, month, case when coalesce(abs(price - pm) / nullif(ps, 0), 0) <= 3 then round(price, 4) end as price,
       case when coalesce(abs(quantity - qm) / nullif(qs, 0), 0) <= 3 then quantity end as quantity
from dense, s""")
def outlier_mask(spark, sf_dir):
    masked = scale.mask_outliers(dense_cells(spark, sf_dir), ["price", "quantity"])
    return masked.select("partner", "month", r("price").alias("price"), "quantity")


@query("price_changes", "E3 E4", f"""
with {DENSE_SQL}, f as (
  select *, lag(price) over (partition by partner order by month) as p,
         row_number() over (partition by partner order by month) as rn from dense)
select partner, month, round(coalesce(price / nullif(p, 0) - 1, 0), 6) as change,
       round(case when rn = 1 then 0 else price - p end, 4) as difference from f""")
def price_changes(spark, sf_dir):
    dense = dense_cells(spark, sf_dir)
    return dense.select(
        "partner", "month",
        r(fill.percent_change("price", ["partner"], "month"), 6).alias("change"),
        r(fill.difference("price", ["partner"], "month")).alias("difference"))


@query("forward_backward_fill", "E5 E6", f"""
with {DENSE_SQL}
select partner, month,
  round(last_value(price ignore nulls) over (partition by partner order by month
        rows between unbounded preceding and current row), 4) as down,
  round(coalesce(last_value(price ignore nulls) over (partition by partner order by month
        rows between unbounded preceding and current row),
    first_value(price ignore nulls) over (partition by partner order by month
        rows between current row and unbounded following)), 4) as filled
from dense""")
def forward_backward_fill(spark, sf_dir):
    dense = dense_cells(spark, sf_dir)
    return dense.select(
        "partner", "month", r(fill.forward("price", ["partner"], "month")).alias("down"),
        r(fill.forward_then_backward("price", ["partner"], "month")).alias("filled"))


INTERPOLATE_SQL = """
numbered as (select *, row_number() over (partition by partner order by month) as rn from {source}),
around as (
  select *, last_value(case when {c} is not null then rn end ignore nulls) over down as pr,
         last_value({c} ignore nulls) over down as pv,
         first_value(case when {c} is not null then rn end ignore nulls) over up as nr,
         first_value({c} ignore nulls) over up as nv
  from numbered
  window down as (partition by partner order by month rows between unbounded preceding and current row),
         up as (partition by partner order by month rows between current row and unbounded following)),
interpolated as (
  select partner, month, case when {c} is not null then {c} when nr is null then pv
         else pv + (nv - pv) * ((rn - pr) / cast(nr - pr as double)) end as v from around)
"""


@query("interpolated_panel", "E7", f"""
with {DENSE_SQL}, {INTERPOLATE_SQL.format(source="dense", c="price")}
select partner, month, round(v, 4) as price from interpolated""")
def interpolated_panel(spark, sf_dir):
    dense = dense_cells(spark, sf_dir).select("partner", "month", "price")
    out = fill.interpolate(dense, ["price"], ["partner"], "month")
    return out.withColumn("price", r("price"))


@query("yearly_to_monthly", "E8 B22", f"""
with {TRADE_SQL}, {MACRO_SQL},
monthly as (
  select partner, cast(unnest(generate_series(make_date(year, 1, 1), make_date(year, 12, 1),
         interval 1 month)) as date) as month, gdp from macro),
sparse as (select partner, month, case when month(month) = 1 then gdp end as gdp from monthly),
{INTERPOLATE_SQL.format(source="sparse", c="gdp")}
select partner, month, cast(last_day(month) + interval 1 day as date) as next_month, round(v, 4) as gdp
from interpolated""")
def yearly_to_monthly(spark, sf_dir):
    from tallyloom.functions.scalar import next_month_start

    macro = yearly_macro(trade_cells(spark, sf_dir))
    out = fill.year_to_months(macro, ["gdp"], ["partner"], "year")
    return out.select("partner", "month", next_month_start("month").alias("next_month"),
                      r("gdp").alias("gdp"))


@query("price_filled_by_global", "C13 C14 E10", f"""
with {DENSE_SQL},
g as (select month, coalesce(globalprice / lag(globalprice) over (order by month) - 1, 0) + 1 as factor
      from globals),
near as (
  select *, coalesce(last_value(price ignore nulls) over (partition by partner order by month
        rows between unbounded preceding and current row),
    first_value(price ignore nulls) over (partition by partner order by month
        rows between current row and unbounded following)) as near from dense)
select n.partner, n.month, round(coalesce(n.price, n.near * g.factor), 4) as price
from near n join g on n.month = g.month""")
def price_filled_by_global(spark, sf_dir):
    dense = dense_cells(spark, sf_dir)
    monthly = exact_prices(
        dense.filter(F.col("cents").isNotNull()), ["month"], "globalprice").select("month", "globalprice")
    filled = panel.fill_price_by_global(dense.join(monthly, "month", "left"))
    return filled.select("partner", "month", r("price").alias("price"))


@query("price_filled_by_partners", "E11", f"""
with {DENSE_SQL},
ch as (select month, coalesce(price / lag(price) over (partition by partner order by month) - 1, 0) as c
       from dense where partner in ('NATION_1', 'NATION_2', 'NATION_3')),
g as (select month, avg(c) + 1 as factor from ch group by month),
near as (
  select *, coalesce(last_value(price ignore nulls) over (partition by partner order by month
        rows between unbounded preceding and current row),
    first_value(price ignore nulls) over (partition by partner order by month
        rows between current row and unbounded following)) as near from dense)
select n.partner, n.month, round(coalesce(n.price, n.near * g.factor), 4) as price
from near n left join g on n.month = g.month""")
def price_filled_by_partners(spark, sf_dir):
    # The partners whose price changes are taken as reference.
    references = ["NATION_1", "NATION_2", "NATION_3"]
    filled = panel.fill_price_by_partners(dense_cells(spark, sf_dir), references)
    return filled.select("partner", "month", r("price").alias("price"))


@query("combine_first_price", "C13", f"""
with {TRADE_SQL},
e as (select partner, month, value / nullif(quantity, 0) as price from product_cells where product = 'ECONOMY'),
l as (select partner, month, value / nullif(quantity, 0) as price from product_cells where product = 'LARGE')
select coalesce(e.partner, l.partner) as partner, coalesce(e.month, l.month) as month,
       coalesce(e.price, l.price) as price
from e full join l on e.partner = l.partner and e.month = l.month""")
def combine_first_price(spark, sf_dir):
    cells = stored_product_cells(spark, sf_dir).withColumn("price", unit_price("value", "quantity"))
    one = [cells.filter(F.col("product") == p).select("partner", "month", "price")
           for p in ("ECONOMY", "LARGE")]
    return panel.patch(one[0], one[1], ["partner", "month"], ["price"])


@query("series_times_factor", "C14", f"""
with {TRADE_SQL}, {OIL_SQL}
select c.partner, c.month, round(c.quantity * (o.oil_price / 100000), 4) as quantity
from cells c left join oil o on c.month = o.month""")
def series_times_factor(spark, sf_dir):
    factors = monthly_oil(spark, sf_dir).select("month", (F.col("oil_price") / 100000).alias("f"))
    scaled = panel.scale_by_month(trade_cells(spark, sf_dir), factors, "quantity", "f")
    return scaled.select("partner", "month", r("quantity").alias("quantity"))


@query("pareto_shares", "E1 F1", f"""
with {TRADE_SQL}, t as (select partner, sum(quantity) as quantity from cells group by partner)
select partner, quantity, row_number() over (order by quantity desc, partner) as position,
       sum(quantity) over (order by quantity desc, partner rows unbounded preceding) as cumulative,
       round(sum(quantity) over (order by quantity desc, partner rows unbounded preceding)
             / sum(quantity) over (), 6) as share
from t""")
def pareto_shares(spark, sf_dir):
    out = panel.cumulative_share(trade_cells(spark, sf_dir), "partner", "quantity")
    return out.drop("share_before").withColumn("share", r("share", 6))


@query("pareto_partners", "B6 E2", f"""
with {TRADE_SQL},
w as (select * from cells where month between date '1996-01-01' and date '2022-10-01'),
t as (select partner, sum(quantity) as quantity from w group by partner),
s as (select *, sum(quantity) over (order by quantity desc, partner rows unbounded preceding) - quantity as before,
             sum(quantity) over () as total from t),
top as (select partner from s where before / total < 0.8)
select partner, month, quantity from cells where partner in (select partner from top)""")
def pareto_partners(spark, sf_dir):
    cells = stored_cells(spark, sf_dir)
    inside = cells.filter(F.col("month").between("1996-01-01", "2022-10-01"))
    top = panel.top_partners(inside, "partner", "quantity", 0.8).select("partner")
    return cells.join(top, "partner", "left_semi").select("partner", "month", "quantity")


@query("tail_share_partners", "F6", f"""
with {TRADE_SQL},
s as (select product, month, partner, quantity,
        sum(quantity) over (partition by product, month order by quantity desc, partner rows unbounded preceding)
        / sum(quantity) over (partition by product, month) as share from product_cells)
select product, month, partner, quantity, round(share, 6) as share from s where share >= 0.8""")
def tail_share_partners(spark, sf_dir):
    out = panel.tail_share(product_cells(spark, sf_dir), ["product", "month"], "partner", "quantity")
    return out.select("product", "month", "partner", "quantity", r("share", 6).alias("share"))


@query("product_ranking", "F1 F5", f"""
with {TRADE_SQL},
m as (select product, avg(value) as mean_value, avg(quantity) as mean_quantity from product_cells group by product)
select product, round(mean_value, 4) as mean_value, round(mean_quantity, 6) as mean_quantity,
       cast(row_number() over (order by mean_value desc, product) as integer) as rank from m""")
def product_ranking(spark, sf_dir):
    from tallyloom.operators.ordered import running

    means = product_cells(spark, sf_dir).groupBy("product").agg(
        F.avg("value").alias("mean_value"), F.avg("quantity").alias("mean_quantity"))
    ranked = running(means, "mean_value", ["product"], descending=True, position="rank")
    return ranked.select("product", r("mean_value").alias("mean_value"),
                         r("mean_quantity", 6).alias("mean_quantity"), F.col("rank").cast("int").alias("rank"))


@query("standardised_panel", "E12", f"""
with {DENSE_SQL},
j as (select d.*, g.globalprice from dense d join globals g on d.month = g.month),
s as (select partner, avg(quantity) as qm, coalesce(nullif(stddev_pop(quantity), 0), 1) as qs,
             avg(globalprice) as gm, coalesce(nullif(stddev_pop(globalprice), 0), 1) as gs
      from j group by partner)
select j.partner, j.month, round(j.price, 4) as price, round((quantity - qm) / qs, 6) as quantity,
       round((globalprice - gm) / gs, 6) as globalprice
from j join s on j.partner = s.partner""")
def standardised_panel(spark, sf_dir):
    dense = dense_cells(spark, sf_dir)
    monthly = exact_prices(
        dense.filter(F.col("cents").isNotNull()), ["month"], "globalprice").select("month", "globalprice")
    joined = dense.join(monthly, "month").select("partner", "month", "price", "quantity", "globalprice")
    columns = ["quantity", "globalprice"]  # the column price is left as it is
    fitted = scale.fit_standard(joined, columns, ["partner"], population=True)
    out = scale.apply_scale(joined, fitted, columns, ["partner"])
    return out.select("partner", "month", r("price").alias("price"),
                      r("quantity", 6).alias("quantity"), r("globalprice", 6).alias("globalprice"))


@query("train_fitted_scaling", "E13 E16", f"""
with {DENSE_SQL},
s as (select partner, avg(price) as m, coalesce(nullif(stddev_samp(price), 0), 1) as s
      from dense where month < date '2000-01-01' group by partner)
select d.partner, d.month, round((price - m) / s, 6) as scaled,
       case when price is not null then true end as restored
from dense d join s on d.partner = s.partner where d.month >= date '2000-01-01'""")
def train_fitted_scaling(spark, sf_dir):
    dense = dense_cells(spark, sf_dir).select("partner", "month", "price")
    train = dense.filter(F.col("month") < "2000-01-01")
    test = dense.filter(F.col("month") >= "2000-01-01")
    step = scale.Scaled(scale.fit_standard(train, ["price"], ["partner"]), ["price"], ["partner"])
    scaled = step(test)
    both = (
        scaled.withColumnRenamed("price", "scaled")
        .join(step.reverse(scaled).withColumnRenamed("price", "back"), ["partner", "month"])
        .join(test, ["partner", "month"])
    )
    return both.select("partner", "month", r("scaled", 6).alias("scaled"),
                       (F.abs(F.col("back") - F.col("price")) < 1e-6).alias("restored"))


@query("minmax_scaling", "E14", f"""
with {TRADE_SQL}, s as (select partner, min(quantity) as lo, max(quantity) as hi from cells group by partner)
select c.partner, c.month, round((quantity - lo) / nullif(hi - lo, 0), 6) as quantity
from cells c join s on c.partner = s.partner""")
def minmax_scaling(spark, sf_dir):
    cells = stored_cells(spark, sf_dir).select("partner", "month", "quantity")
    fitted = scale.fit_minmax(cells, ["quantity"], ["partner"])
    return scale.apply_scale(cells, fitted, ["quantity"], ["partner"]).withColumn(
        "quantity", r("quantity", 6))


@query("transform_chain", "B13 B19 E15 U4", f"""
with {TRADE_SQL}, p as (select partner, month, ln(value / quantity + 1e-8) / ln(10) as price from cells),
s as (select avg(price) as m, coalesce(nullif(stddev_samp(price), 0), 1) as s from p)
select p.partner, p.month, round((p.price - m) / s, 6) as scaled, true as restored
from p, s""")
def transform_chain(spark, sf_dir):
    cells = stored_cells(spark, sf_dir).withColumn("price", unit_price("value", "quantity"))
    kept, logged = scale.Kept(["partner", "month", "price"]), scale.Logged(["price"], 10.0)
    prices = scale.Chain(kept, logged)(cells)
    chain = scale.Chain(logged, scale.Scaled(scale.fit_standard(prices, ["price"]), ["price"]))
    scaled = chain(kept(cells))
    back = chain.reverse(scaled)
    both = (
        scaled.withColumnRenamed("price", "scaled")
        .join(back.withColumnRenamed("price", "back"), ["partner", "month"])
        .join(kept(cells), ["partner", "month"])
    )
    return both.select("partner", "month", r("scaled", 6).alias("scaled"),
                       (F.abs(F.col("back") - F.col("price")) < 1e-4).alias("restored"))


@query("column_moments", "D9 D10", f"""
with {TRADE_SQL}, p as (select value / quantity as price from cells)
select count(price) as n, round(avg(price), 4) as mean, round(stddev_samp(price), 4) as std,
       round(stddev_pop(price), 4) as std_pop, round(median(price), 4) as median,
       round(min(price), 4) as low, round(max(price), 4) as high,
       round(quantile_cont(price, 0.25), 4) as q25, round(quantile_cont(price, 0.75), 4) as q75 from p""")
def column_moments(spark, sf_dir):
    from tallyloom.operators.ordered import quantiles
    from tallyloom.session import stage

    prices = stage(trade_cells(spark, sf_dir).select(unit_price("value", "quantity").alias("price")), "prices")
    names = {"median": 0.5, "q25": 0.25, "q75": 0.75}
    points = quantiles(prices, "price", names).select(F.struct(*names).alias("q")).scalar()
    out = prices.agg(F.count("price").alias("n"), *scale.moments("price"), F.min("price").alias("low"),
                     F.max("price").alias("high"))
    return out.select("n", *[r(c).alias(c) for c in out.columns if c != "n"],
                      *[r(points[n]).alias(n) for n in names])


@query("population_join", "C18 C8", f"""
with {TRADE_SQL}, {MACRO_SQL},
a as (select partner, year, gdp from macro),
b as (select partner, year, population from macro where population > 700000),
j as (select a.partner, a.year, a.gdp, b.population, false as missing
      from a left join b on a.partner = b.partner and a.year = b.year)
select partner, year, gdp, round(population, 2) as population, missing from j
union all
select a.partner, a.year, a.gdp, null, true from a
where not exists (select 1 from b where b.partner = a.partner and b.year = a.year)""")
def population_join(spark, sf_dir):
    macro = yearly_macro(stored_cells(spark, sf_dir))
    left = macro.select("partner", "year", "gdp")
    right = macro.filter(F.col("population") > 700000).select("partner", "year", "population")
    on = ["partner", "year"]
    joined = left.join(right, on, "left").withColumn("missing", F.lit(False))
    report = left.join(right, on, "left_anti").withColumns(
        {"population": F.lit(None).cast("double"), "missing": F.lit(True)})
    return joined.unionByName(report).withColumns(
        {"population": r("population", 2), "year": F.col("year").cast("long")})


@query("zero_rows_appended", "G1 B8", f"""
with {TRADE_SQL},
extra as (select partner, cast(unnest(generate_series(date '2030-01-01', date '2030-10-01', interval 1 month)) as date)
          as month, cast(0 as double) as quantity from partners)
select partner, month, quantity from cells union all select partner, month, quantity from extra""")
def zero_rows_appended(spark, sf_dir):
    cells = stored_cells(spark, sf_dir).select("partner", "month", "quantity")
    months = F.expr("sequence(date'2030-01-01', date'2030-10-01', interval 1 month)")
    extra = cells.select("partner").distinct().select(
        "partner", F.explode(months).alias("month"), F.lit(0.0).alias("quantity"))
    return cells.unionByName(extra)


@query("first_order_per_month", "G3", """
with k as (
  select cast(date_trunc('month', o_orderdate) as date) as month, o_orderkey, o_totalprice,
         row_number() over (partition by date_trunc('month', o_orderdate) order by o_orderdate, o_orderkey) as rn
  from orders)
select month, o_orderkey, o_totalprice from k where rn = 1""")
def first_order_per_month(spark, sf_dir):
    from tallyloom.plans.standins import month_of

    orders = table(spark, sf_dir, "orders").select(
        month_of("o_orderdate").alias("month"), "o_orderdate", "o_orderkey", "o_totalprice")
    return panel.first_per_key(orders, ["month"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("distinct_pairs_and_difference", "G2 G5 G6", """
select 'part_only' as side, l_partkey as k from (select distinct l_partkey from lineitem where l_discount < 0.05
  except select distinct l_partkey from lineitem where l_tax > 0.05)
union all
select 'both', l_partkey from (select distinct l_partkey from lineitem where l_discount < 0.05
  intersect select distinct l_partkey from lineitem where l_tax > 0.05)""")
def distinct_pairs_and_difference(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    a = lines.filter(F.col("l_discount") < 0.05).select(F.col("l_partkey").alias("k")).distinct()
    b = lines.filter(F.col("l_tax") > 0.05).select(F.col("l_partkey").alias("k")).distinct()
    only = a.join(b, "k", "left_anti").select(F.lit("part_only").alias("side"), "k")
    both = a.intersect(b).select(F.lit("both").alias("side"), "k")
    return only.unionByName(both)
