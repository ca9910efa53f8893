"""File sources: explicit schemas, content-based row filters, one scan for many files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.scalar import parse_date, to_number


def comma_csv(spark: SparkSession, path: str, schema: str, quote: str = '"') -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("quote", quote).csv(path)


def semicolon_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("sep", ";").csv(path)


def decimal_comma_csv(spark: SparkSession, path: str, schema: str, numbers: list[str]) -> DataFrame:
    """Semicolon file whose numbers have a decimal comma; bad numbers become null."""
    columns = [f.name for f in T._parse_datatype_string(schema).fields]
    text = ", ".join(
        f"`{f.name}` string" if f.name in numbers else f"`{f.name}` {f.dataType.simpleString()}"
        for f in T._parse_datatype_string(schema).fields)
    raw = semicolon_csv(spark, path, text)
    return raw.withColumns({c: to_number(c, decimal_comma=True) for c in numbers}).select(*columns)


def futures_csv(spark: SparkSession, path: str, price: str = "price") -> DataFrame:
    """(month, price) of a quoted futures file: month-first dates, decimal commas, a BOM."""
    schema = "Date string, Price string, Open string, High string, Low string, Vol string, Change string"
    raw = comma_csv(spark, path, schema)
    return raw.select(
        parse_date("Date", "month-first").alias("month"), to_number("Price", decimal_comma=True).alias(price)
    ).filter(F.col("month").isNotNull())


def dated_rows(raw: DataFrame, key: str, layout: str, date: str = "month") -> DataFrame:
    """Title and footer rows leave: they are the rows whose key is no date."""
    return raw.withColumn(date, parse_date(key, layout)).filter(F.col(date).isNotNull())


OFFERS = "map<string,array<struct<modelID:string,shop:string,title:string,url:string,featuresMap:map<string,string>>>>"


def offers_json(spark: SparkSession, path: str, minimum_duplicates: int = 1, whole_file: bool = False) -> DataFrame:
    """One row per offer of JSON maps product -> offers, one map per line (or per file).

    Products with fewer offers than ``minimum_duplicates`` leave. Offers are counted per
    product over all lines, so a product may be spread over many lines and files.
    """
    text = spark.read.text(path, wholetext=whole_file)
    pairs = text.select(F.explode(F.from_json("value", OFFERS)).alias("product", "offers"))
    offers = pairs.select("product", F.inline("offers"))
    if minimum_duplicates <= 1:
        return offers
    counts = pairs.groupBy("product").agg(F.sum(F.size("offers")).alias("_n"))
    enough = counts.filter(F.col("_n") >= minimum_duplicates).select("product")
    return offers.join(enough, "product", "left_semi")


def panel(spark: SparkSession, path: str, schema: str, product: str | None = None) -> DataFrame:
    """Long (feature, partner, month) panel stored by product; the filter prunes its folders."""
    df = spark.read.schema(schema).parquet(path)
    return df if product is None else df.filter(F.col("product") == product)


def numbered_csv(spark: SparkSession, pattern: str, schema: str, dataset: str = "dataset_id") -> DataFrame:
    """All files of a glob in one scan; the digits of the file or folder name tell them apart."""
    raw = spark.read.schema(schema).option("header", True).csv(pattern)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"dataset[_=]?(\d+)", 1)
    return raw.select("*", name.try_cast("int").alias(dataset))


def brand_files(
    spark: SparkSession, paths: dict[str, str], brands: list[str], key: str = "week",
) -> DataFrame:
    """Files with one column per brand to (week, brand, one column per file), with logs."""
    schema = f"`{key}` date, " + ", ".join(f"`{b}` double" for b in brands)

    def long(name: str, path: str) -> DataFrame:
        wide = spark.read.schema(schema).option("header", True).csv(path)
        return wide.unpivot([key], brands, "brand", name)

    joined = reduce(lambda a, b: a.join(b, [key, "brand"]), [long(n, p) for n, p in paths.items()])
    return joined


def with_logs(df: DataFrame, columns: list[str]) -> DataFrame:
    """log{column} for positive values, null otherwise, and the constant."""
    logs: dict[str, Column] = {f"log{c}": F.when(F.col(c) > 0, F.log(c)) for c in columns}
    return df.withColumns({**logs, "const": F.lit(1.0)})
