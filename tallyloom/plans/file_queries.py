"""Sources and sinks: tables written by Spark to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import scalar as sc
from tallyloom.operators import panel as pn
from tallyloom.plans.panel_queries import r
from tallyloom.plans.registry import query
from tallyloom.plans.series_queries import ORIGINS_SQL, mean_paths
from tallyloom.plans.standins import (
    OIL_SQL, TRADE_SQL, indicator_records, monthly_oil, product_cells, table, trade_cells,
)
from tallyloom.operators import forecast as fc
from tallyloom.session import scratch_path
from tallyloom.sources import readers, sinks


@query("csv_trade_records", "A1 B1 C1 D4 G2", f"""
with {TRADE_SQL} select n_nationkey as partner_code, c.month, c.quantity, round(c.value, 2) as value
from cells c join nation on n_name = c.partner""")
def csv_trade_records(spark, sf_dir):
    """Long records with partner codes from a comma file, labels from a semicolon file."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    records = indicator_records(trade_cells(spark, sf_dir)).join(
        nations, F.col("partner") == F.col("label")).select("code", "month", "indicator", "value")
    trade, labels = scratch_path(spark, "trade-csv"), scratch_path(spark, "labels-csv")
    records.write.option("header", True).csv(trade)
    nations.write.option("header", True).option("sep", ";").csv(labels)
    long = readers.comma_csv(spark, trade, "code string, month date, indicator string, value double").dropDuplicates()
    named = long.join(readers.semicolon_csv(spark, labels, "code string, label string"), "code")
    wide = pn.pivot_indicators(named, ["code", "label", "month"], ["quantity", "value"])
    renamed = wide.withColumnsRenamed({"code": "partner_code"}).drop("label")
    return renamed.select(F.col("partner_code").cast("int").alias("partner_code"), "month", "quantity",
                          r("value", 2).alias("value"))


@query("decimal_comma_file", "A2 A3 B4", """
select c_custkey, c_mktsegment, c_acctbal from customer""")
def decimal_comma_file(spark, sf_dir):
    path = scratch_path(spark, "decimal-comma")
    text = F.regexp_replace(F.col("c_acctbal").cast("string"), r"\.", ",")
    table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", text.alias("c_acctbal")).write.option(
        "header", True).option("sep", ";").csv(path)
    return readers.decimal_comma_csv(
        spark, path, "c_custkey bigint, c_mktsegment string, c_acctbal double", ["c_acctbal"])


@query("futures_file", "A4 B3 B4", f"""
with {OIL_SQL} select month, round(oil_price, 3) as price from oil""")
def futures_file(spark, sf_dir):
    path = scratch_path(spark, "futures")
    price = F.regexp_replace(r("oil_price", 3).cast("decimal(18,3)").cast("string"), r"\.", ",")
    monthly_oil(spark, sf_dir).select(
        F.date_format("month", "MM/dd/yyyy").alias("Date"), price.alias("Price"), price.alias("Open"),
        price.alias("High"), price.alias("Low"), F.lit("2.81M").alias("Vol."), F.lit("1.0%").alias("Change %"),
    ).write.option("header", True).option("quoteAll", True).csv(path)
    return readers.futures_csv(spark, path)


@query("titled_file", "A7 B3", f"""
with {OIL_SQL} select month, round(oil_price, 3) as price from oil""")
def titled_file(spark, sf_dir):
    """A file with title and footer rows: only rows whose key is a date stay."""
    path = scratch_path(spark, "titled")
    text = r("oil_price", 3).cast("string")
    rows = monthly_oil(spark, sf_dir).select(F.date_format("month", "yyyy'M'MM").alias("key"), text.alias("price"))
    titles = spark.createDataFrame([("World prices", None), ("(monthly)", "USD"), ("Source: tables", None)],
                                   "key string, price string")
    titles.unionByName(rows).write.csv(path)
    raw = spark.read.schema("key string, price string").csv(path)
    return readers.dated_rows(raw, "key", "year-M-month").select("month", sc.to_number("price").alias("price"))


@query("offers_file", "A5", """
with o as (select lang || '-' || coalesce(cast(quality as varchar), 'unlabelled') as product, d.*
           from documents d left join labels using (doc_id)),
k as (select product from o group by 1 having count(*) >= 3)
select product, cast(doc_id as varchar) as model_id, source as shop, md5(text) as title, n_chars as chars
from o where product in (select product from k)""")
def offers_file(spark, sf_dir):
    path = scratch_path(spark, "offers")
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    offer = F.struct(
        F.col("doc_id").cast("string").alias("modelID"), F.col("source").alias("shop"), F.col("text").alias("title"),
        F.lit("").alias("url"), F.create_map(F.lit("chars"), F.col("n_chars").cast("string")).alias("featuresMap"))
    product = F.concat_ws("-", "lang", F.coalesce(F.col("quality").cast("string"), F.lit("unlabelled")))
    docs.select(F.to_json(F.create_map(product, F.array(offer))).alias("value")).write.text(path)
    offers = readers.offers_json(spark, path, minimum_duplicates=3)
    return offers.select(
        "product", F.col("modelID").alias("model_id"), "shop", F.md5("title").alias("title"),
        F.col("featuresMap.chars").cast("long").alias("chars"))


@query("numbered_files", "A8", """
select cast(n_regionkey as integer) as dataset_id, count(*) as rows, round(sum(c_acctbal), 2) as total
from customer join nation on c_nationkey = n_nationkey group by n_regionkey""")
def numbered_files(spark, sf_dir):
    folder = scratch_path(spark, "numbered")
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_acctbal", F.col("n_regionkey").alias("dataset"))
    sinks.write_by(customers, folder, ["dataset"], "csv", header=True)
    back = readers.numbered_csv(spark, f"{folder}/dataset=*/*.csv", "c_custkey bigint, c_acctbal double")
    return back.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("rows"), r(F.sum("c_acctbal"), 2).alias("total"))


@query("brand_files", "A9 B13 D6", """
with w as (
  select cast(date_trunc('week', l_shipdate) as date) as week, p_brand as brand, sum(l_quantity) as sales,
         max(cast(l_discount > 0.09 as integer)) as displ, max(cast(l_tax > 0.07 as integer)) as coupon,
         cast(sum(cast(round(l_extendedprice * 100) as bigint)) as double) / sum(l_quantity) as price
  from lineitem join part on l_partkey = p_partkey group by 1, 2)
select week, brand, sales, cast(displ as double) as displ, cast(coupon as double) as coupon, price,
       round(ln(sales), 6) as logsales, round(ln(price), 6) as logprice from w""")
def brand_files(spark, sf_dir):
    from tallyloom.plans.standins import cents

    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    weekly = table(spark, sf_dir, "lineitem").select(
        F.trunc(F.col("l_shipdate").cast("date"), "week").alias("week"), "l_partkey", "l_quantity", "l_discount",
        "l_tax", cents("l_extendedprice").alias("cents")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("week", "brand").agg(
        F.sum("l_quantity").alias("sales"), F.max((F.col("l_discount") > 0.09).cast("int")).alias("displ"),
        F.max((F.col("l_tax") > 0.07).cast("int")).alias("coupon"),
        (F.sum("cents") / F.sum("l_quantity")).alias("price"))
    brands, folder = pn.names(parts, "brand"), scratch_path(spark, "brands")
    paths = {name: f"{folder}/{name}" for name in ("sales", "displ", "coupon", "price")}
    for name, path in paths.items():
        weekly.groupBy("week").agg(
            *[F.max(F.when(F.col("brand") == b, F.col(name))).alias(b) for b in brands]
        ).write.option("header", True).csv(path)
    back = readers.brand_files(spark, paths, brands).dropna(subset=["sales"])
    logs = readers.with_logs(back, ["sales", "price"]).drop("const")
    return logs.withColumns({c: r(c, 6) for c in ("logsales", "logprice")})


@query("stored_panel", "A6 A12 D6", f"""
with {TRADE_SQL}
select product, partner, month, 'quantity' as feature, quantity as value from product_cells
union all select product, partner, month, 'value', round(value, 2) from product_cells""")
def stored_panel(spark, sf_dir):
    """A long panel stored by product and feature, and its read."""
    folder = scratch_path(spark, "panel")
    long = product_cells(spark, sf_dir).unpivot(["product", "partner", "month"], ["quantity", "value"], "feature", "value")
    sinks.write_by(long, folder, ["product", "feature"])
    back = readers.panel(spark, folder, "partner string, month date, value double, product string, feature string")
    return back.select("product", "partner", "month", "feature", r("value", 2).alias("value"))


@query("run_stamped_table", "A10 N20", f"""
with {TRADE_SQL} select '2024-01-31' as run, partner, month, quantity from cells""")
def run_stamped_table(spark, sf_dir):
    folder = scratch_path(spark, "runs")
    sinks.write_run(trade_cells(spark, sf_dir).select("partner", "month", "quantity"), folder, "2024-01-31")
    back = spark.read.schema("partner string, month date, quantity double, run string").parquet(folder)
    return back.select("run", "partner", "month", "quantity")


@query("appended_results", "A11 D16", f"""
with {ORIGINS_SQL}
select config, step, round(avg(abs(prediction - label)), 3) as mae, 2 as runs from paths group by config, step""")
def appended_results(spark, sf_dir):
    """Two runs appended to one results table and averaged over the runs."""
    from tallyloom.functions import rates

    folder = scratch_path(spark, "results")
    errors = fc.forecast_rows(mean_paths(spark, sf_dir), ["partner", "config"]).groupBy("config", "step").agg(
        rates.absolute_error("label", "prediction").alias("mae"))
    for run in (1, 2):
        sinks.append_results(errors.withColumn("run", F.lit(run)), folder)
    back = spark.read.schema("config int, step int, mae double, run int").parquet(folder)
    return back.groupBy("config", F.col("step").cast("long").alias("step")).agg(
        r(F.avg("mae"), 3).alias("mae"), F.count(F.lit(1)).cast("int").alias("runs"))


@query("stored_scoring_inputs", "A13", f"""
with {ORIGINS_SQL}
select 'labels' as kind, config, count(*) as n, round(sum(label), 0) as total from paths group by config
union all select 'predictions', config, count(*), round(sum(prediction), 0) from paths group by config""")
def stored_scoring_inputs(spark, sf_dir):
    folder = scratch_path(spark, "kinds")
    rows = fc.forecast_rows(mean_paths(spark, sf_dir), ["partner", "config"])
    keys = ["partner", "config", "origin", "step"]
    sinks.write_kinds({
        "labels": rows.select(*keys, F.col("label").alias("value")),
        "predictions": rows.select(*keys, F.col("prediction").alias("value"))}, folder)
    back = spark.read.schema(
        "partner string, config int, origin date, step int, value double, kind string").parquet(folder)
    return back.groupBy("kind", "config").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), 0).alias("total"))


@query("forecasts_by_partner", "A12 N8 N11", f"""
with {ORIGINS_SQL}
select partner, config, origin, step, round(prediction, 3) as prediction from paths""")
def forecasts_by_partner(spark, sf_dir):
    folder = scratch_path(spark, "forecasts")
    rows = fc.forecast_rows(mean_paths(spark, sf_dir), ["partner", "config"])
    sinks.write_by(rows.select("partner", "config", "origin", "step", "prediction"), folder, ["partner"])
    back = spark.read.schema(
        "config int, origin date, step long, prediction double, partner string").parquet(folder)
    return back.select("partner", "config", "origin", "step", r("prediction", 3).alias("prediction"))


@query("blocks_filled_down", "A7 B3 E6", """
select o_orderpriority as country, cast(date_trunc('month', o_orderdate) as date) as month,
       cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) / 100 / count(*) as cpi
from orders group by 1, 2""")
def blocks_filled_down(spark, sf_dir):
    """A price index file whose country stands only in the first row of each block."""
    from tallyloom.operators import fill
    from tallyloom.operators.ordered import running
    from tallyloom.plans.standins import cents, month_of

    path = scratch_path(spark, "blocks")
    monthly = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("country"), month_of("o_orderdate").alias("month")
    ).agg((F.sum(cents("o_totalprice")) / 100 / F.count(F.lit(1))).alias("cpi"))
    ranked = monthly.withColumn("place", F.substring("country", 1, 1).cast("int") * 100000 + F.unix_date("month"))
    rows = running(ranked, "place", ["country"], position="row")
    starts = rows.groupBy("country").agg(F.min("row").alias("start"))
    rows.join(starts, "country").select(
        "row", F.when(F.col("row") == F.col("start"), F.col("country")).alias("country"),
        F.date_format("month", "MMM-yyyy").alias("time"), "cpi").write.option("header", True).csv(path)
    raw = readers.comma_csv(spark, path, "row bigint, country string, time string, cpi double")
    filled = fill.down_the_file(raw, "country", "row")
    return readers.dated_rows(filled, "time", "month-name").select("country", "month", "cpi")
