import datetime as dt
import json
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.session import scratch_path, shared_dir, stage
from tallyloom.sources import readers, sinks


def test_futures_file_with_mark_and_commas(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_bytes("﻿".encode() + b'"Date","Price","Open","High","Low","Vol.","Change %"\r\n'
                     b'"10/01/2022","259,000","1,0","1,0","1,0","2.81M","-1%"\r\n"x","1,0","","","","",""\r\n')
    rows = readers.futures_csv(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [(dt.date(2022, 10, 1), 259.0)]


def test_decimal_comma(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;x;y\n1;1,5;a\n2;bad;b\n")
    rows = readers.decimal_comma_csv(spark, str(tmp_path), "id int, x double, y string", ["x"]).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 1.5, "a"), (2, None, "b")]


def test_offers(spark, tmp_path):
    def offer(i):
        return {"modelID": f"m{i}", "shop": "s", "title": "t", "url": "u", "featuresMap": {"Brand": "b"}}

    (tmp_path / "a.json").write_text(json.dumps({"p": [offer(1), offer(2)], "q": [offer(3)]}))
    path = str(tmp_path / "a.json")
    assert readers.offers_json(spark, path, 1, whole_file=True).count() == 3
    twice = readers.offers_json(spark, path, 2, whole_file=True)
    assert {r["modelID"] for r in twice.collect()} == {"m1", "m2"}


def test_model_ids(spark):
    titles = ["Sony KDL46 1080p LED", "no token", "ab1 cd2", "Brand X600Hz99a tv", ""]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = [r[0] for r in df.select(tx.model_id(F.col("t"))).collect()]
    # the longest match wins, the first of equals; without a match there is no id
    assert got[1] is None and got[2] == "ab1" and got[4] is None
    assert got[3] == "X99a"


def test_brand_order(spark):
    df = spark.sql("""select map('Brand Name', 'n') as f, 'first word' as t union all
                      select map('Brand', 'b', 'Brand Name', 'n'), 'first word' union all select map(), ' first word'""")
    got = [r[0] for r in df.select(tx.brand_of(F.col("f").cast("map<string,string>"), F.col("t"))).collect()]
    assert got == ["n", "b", "first"]


def test_sinks(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("k"))
    path = sinks.write_run(df, scratch_path(spark, "t"), "r1")
    assert spark.read.parquet(path).count() == 100
    folder = scratch_path(spark, "t")
    sinks.append_results(df, folder)
    sinks.append_results(df, folder)
    assert spark.read.parquet(folder).count() == 200
    by = scratch_path(spark, "t")
    sinks.write_by(df, by, ["k"])
    pruned = readers.panel(spark, by, "id long, k int").filter("k = 1")
    assert pruned.count() == 33 and "PartitionFilters: [isnotnull(k" in pruned._jdf.queryExecution().toString()


def test_shared_folder_is_read_from_the_session(spark):
    def session(setting, folder, master="local[4]"):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": setting}.get(key) or default),
            sparkContext=SimpleNamespace(getCheckpointDir=lambda: folder, master=master))

    assert shared_dir(session("hdfs://x/shared/", None)) == "hdfs://x/shared"
    assert shared_dir(session(None, "hdfs://x/set")) == "hdfs://x/set"
    assert shared_dir(session(None, None)) == shared_dir(session(None, None))
    for master in ("yarn", "spark://x:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            shared_dir(session(None, None, master))
    assert stage(spark.range(3), "x").count() == 3
