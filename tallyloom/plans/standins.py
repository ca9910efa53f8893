"""The reference inputs as they are built from the given tables, for Spark and for SQL.

Each ``*_SQL`` text holds the common table expressions that say the same in SQL.
Money is summed in whole cents, so a sum does not depend on the order of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def month_of(column: str) -> Column:
    return F.trunc(F.col(column).cast("date"), "month")


def trade_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(partner, month, quantity, cents, value): line items by customer nation and order month.

    Line items are summed per order before the join, so the join moves one row per order
    and an order with very many lines is folded map-side.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("quantity"), F.sum(cents("l_extendedprice")).alias("cents"))
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", month_of("o_orderdate").alias("month")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("partner"))
    by_nation = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "month")
        .agg(F.sum("quantity").alias("quantity"), F.sum("cents").alias("cents"))
    )
    return by_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "partner", "month", "quantity", "cents", (F.col("cents") / 100).alias("value")
    )


def product_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(partner, month, product, quantity, cents, value); product is the part type."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("product"))
    lines = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey", "l_quantity", cents("l_extendedprice").alias("cents"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey", "product")
        .agg(F.sum("l_quantity").alias("quantity"), F.sum("cents").alias("cents"))
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", month_of("o_orderdate").alias("month")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("partner"))
    by_nation = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "month", "product")
        .agg(F.sum("quantity").alias("quantity"), F.sum("cents").alias("cents"))
    )
    return by_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "partner", "month", "product", "quantity", "cents", (F.col("cents") / 100).alias("value")
    )


def stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trade_cells`` written once, for queries that read them several times."""
    return stage(trade_cells(spark, sf_dir), "cells")


def stored_product_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(product_cells(spark, sf_dir), "product-cells")


def exact_prices(cells: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    """(keys, quantity, cents, price) with the money summed in whole cents."""
    from tallyloom.operators.panel import price_by

    whole = cells.select(*keys, "quantity", F.col("cents").alias("value"))
    return price_by(whole, keys, price).withColumnRenamed("value", "cents").withColumn(
        price, F.col(price) / 100)


TRADE_SQL = """
trade as (
  select n.n_name as partner, cast(date_trunc('month', o.o_orderdate) as date) as month,
         p.p_type as product, l.l_quantity as quantity,
         cast(round(l.l_extendedprice * 100) as bigint) as cents
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
  join customer c on o.o_custkey = c.c_custkey
  join nation n on c.c_nationkey = n.n_nationkey
  join part p on l.l_partkey = p.p_partkey),
cells as (
  select partner, month, sum(quantity) as quantity, sum(cents) as cents, cast(sum(cents) as double) / 100 as value
  from trade group by partner, month),
product_cells as (
  select partner, month, product, sum(quantity) as quantity, sum(cents) as cents,
         cast(sum(cents) as double) / 100 as value
  from trade group by partner, month, product),
months as (select distinct month from cells),
partners as (select distinct partner from cells),
grid as (select partner, month from partners, months),
globals as (
  select month, cast(sum(cents) as double) / sum(quantity) / 100 as globalprice from cells group by month)
"""


def indicator_records(cells: DataFrame) -> DataFrame:
    """The long form of trade records: one row per indicator."""
    return cells.unpivot(["partner", "month"], ["quantity", "value"], "indicator", "value")


def monthly_oil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the oil price: mean order total per month."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(month_of("o_orderdate").alias("month"))
        .agg((F.sum(cents("o_totalprice")) / 100 / F.count(F.lit(1))).alias("oil_price"))
    )


OIL_SQL = """
oil as (
  select cast(date_trunc('month', o_orderdate) as date) as month,
         cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) / 100 / count(*) as oil_price
  from orders group by 1)
"""


def monthly_futures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for futures: mean tax rate per shipping month, in hundredths."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(month_of("l_shipdate").alias("month"))
        .agg((F.sum(cents("l_tax")) / F.count(F.lit(1))).alias("futures"))
    )


FUTURES_SQL = """
futures as (
  select cast(date_trunc('month', l_shipdate) as date) as month,
         cast(sum(cast(round(l_tax * 100) as bigint)) as double) / count(*) as futures
  from lineitem group by 1)
"""


def weather_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for station weather: event type as country, user as station."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("country"),
        F.col("user_id").alias("station"),
        F.col("ts").cast("date").alias("day"),
        (F.col("value") - 1).alias("tmin"),
        F.col("value").alias("tavg"),
        (F.col("value") + 1).alias("tmax"),
    )


def yearly_macro(cells: DataFrame) -> DataFrame:
    """Stand-in for the yearly country indicators: yearly sums of trade."""
    return cells.groupBy("partner", F.year("month").alias("year")).agg(
        F.sum("quantity").alias("gdp"), F.sum("value").alias("population")
    )


MACRO_SQL = """
macro as (
  select partner, year(month) as year, sum(quantity) as gdp, sum(value) as population
  from cells group by 1, 2)
"""
