"""Scalar expressions and row filters over texts derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import scalar as sc
from tallyloom.operators import ordered
from tallyloom.operators import panel as pn
from tallyloom.plans.panel_queries import r
from tallyloom.plans.registry import query
from tallyloom.plans.standins import table


@query("date_layouts", "B3 B5 B22", """
select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as a, cast(date_trunc('month', o_orderdate) as date) as b,
       cast(date_trunc('month', o_orderdate) as date) as c, cast(date_trunc('month', o_orderdate) as date) as d,
       cast(o_orderdate as date) as e, cast(o_orderdate as date) as f, cast(date_trunc('year', o_orderdate) as date) as g,
       strftime(o_orderdate, '%Y/%m/%d') as text, cast(last_day(o_orderdate) + interval 1 day as date) as next_month,
       case when o_orderstatus = 'F' then cast(o_orderdate as date) end as moment
from orders""")
def date_layouts(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    patterns = list(sc.DATE_LAYOUTS.items())
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("day"), "o_orderstatus",
        *[F.date_format(day, p).alias(f"t{i}") for i, (_, p) in enumerate(patterns)],
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd")).otherwise("unknown").alias("stamp"))
    order = ["year-month", "yearmonth", "month-name", "year-M-month", "day-first", "month-first", "year"]
    numbers = {name: i for i, (name, _) in enumerate(patterns)}
    return texts.select(
        "o_orderkey", *[sc.parse_date(f"t{numbers[n]}", n).alias(c) for c, n in zip("abcdefg", order)],
        F.date_format("day", "yyyy/MM/dd").alias("text"), sc.next_month_start("day").alias("next_month"),
        sc.to_moment("stamp").cast("date").alias("moment"))


@query("number_coercion", "B4 B7 B8", """
select l_orderkey, l_linenumber, l_partkey, l_quantity,
       case when l_returnflag = 'R' then null else l_discount end as parsed,
       nullif(l_discount, 0) as known, coalesce(nullif(l_tax, 0), 0) as zero_filled,
       case when l_linestatus = 'O' then 0.0 else l_tax end as replaced
from lineitem""")
def number_coercion(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_discount").cast("string"))
    marked = F.when(F.col("l_linestatus") == "O", "..").otherwise(F.col("l_tax").cast("string"))
    known = sc.zeros_to_null(lines.withColumns({"known": F.col("l_discount"), "zero_filled": F.col("l_tax")}),
                             ["known", "zero_filled"])
    filled = sc.nulls_to_zero(known, ["zero_filled"])
    return filled.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", sc.to_number(text).alias("parsed"), "known",
        "zero_filled", sc.to_number(sc.replace_sentinel(marked)).alias("replaced"))


@query("label_substring_drop", "B1 B6 B9", """
select p_partkey as part, p_name as label, p_size from part
where not contains(p_name, 'red') and p_size between 5 and 40 and p_type in ('ECONOMY', 'PROMO')""")
def label_substring_drop(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_type")
    kept = sc.drop_labels_with(parts, "p_name", "red").filter(
        F.col("p_size").between(5, 40) & F.col("p_type").isin("ECONOMY", "PROMO"))
    return kept.drop("p_type").withColumnsRenamed({"p_partkey": "part", "p_name": "label"})


@query("bad_groups_drop", "B10 C8", """
with t as (select o_custkey, o_orderkey, case when o_totalprice > 480000 then '..' else cast(o_totalprice as varchar) end as v
           from orders)
select o_custkey, o_orderkey, cast(v as double) as value from t
where o_custkey not in (select o_custkey from t where try_cast(v as double) is null)""")
def bad_groups_drop(spark, sf_dir):
    text = F.when(F.col("o_totalprice") > 480000, "..").otherwise(F.col("o_totalprice").cast("string"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", text.alias("v"))
    clean = sc.drop_groups_with_bad_value(orders, "o_custkey", "v")
    return clean.select("o_custkey", "o_orderkey", sc.to_number("v").alias("value"))


@query("seen_order_of_products", "B12", """
with f as (select p_type, min(p_partkey) as first_row from part group by p_type),
n as (select p_type, dense_rank() over (order by first_row) - 1 as product_index from f)
select p_partkey, p.p_type, cast(product_index as integer) as product_index
from part p join n on p.p_type = n.p_type""")
def seen_order_of_products(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return pn.nth_values(parts, "p_type", "p_partkey").withColumnRenamed("p_type_index", "product_index")


@query("products_by_number", "B12", """
with f as (select p_type, min(p_partkey) as first_row from part group by p_type),
n as (select p_type, dense_rank() over (order by first_row) - 1 as product_index from f)
select p_partkey, p.p_type, cast(product_index as integer) as product_index
from part p join n on p.p_type = n.p_type where product_index in (0, 2, 5)""")
def products_by_number(spark, sf_dir):
    """The rows of the first, third and sixth product in first-seen order."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return pn.nth_values(parts, "p_type", "p_partkey", [0, 2, 5]).withColumnRenamed("p_type_index", "product_index")


@query("basis_terms", "B20", """
select c_custkey, round(greatest(c_acctbal / 1000 - 3, 0), 6) as up, round(pow(least(c_acctbal / 1000 - 5, 0), 3), 6) as down,
       round(ln(abs(c_acctbal) + 1e-8) / ln(2), 6) as log2, round(pow(2, c_acctbal / 1000 + 1e-8), 5) as power
from customer""")
def basis_terms(spark, sf_dir):
    x = F.col("c_acctbal") / 1000
    return table(spark, sf_dir, "customer").select(
        "c_custkey", r(sc.above(x, 3.0), 6).alias("up"), r(sc.below_cubed(x, 5.0), 6).alias("down"),
        r(sc.log_base(F.abs("c_acctbal"), 2.0), 6).alias("log2"), r(sc.pow_base(x, 2.0, 1e-8), 5).alias("power"))


@query("category_shares", "D12", """
select o_orderpriority, o_orderstatus, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 6) as percent
from orders group by 1, 2""")
def category_shares(spark, sf_dir):
    from pyspark.sql import Window

    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"))
    # one row per pair of categories
    return counts.withColumn("percent", r(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("running_order_total", "E1 E20", """
select o_orderkey, sum(cast(round(o_totalprice * 100) as bigint)) over (order by o_orderdate, o_orderkey
       rows unbounded preceding)::bigint as running, row_number() over (order by o_orderdate, o_orderkey) as position
from orders""")
def running_order_total(spark, sf_dir):
    from tallyloom.plans.standins import cents

    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.unix_date(F.col("o_orderdate").cast("date")).alias("day"), cents("o_totalprice").alias("c"))
    out = ordered.running(orders, "day", ["o_orderkey"], {"running": "c"}, staged=False)
    return out.select("o_orderkey", F.col("running"), "position")
