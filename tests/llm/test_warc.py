"""Archives: round trip, pushed predicates, payloads left alone, foreign files."""

import base64
import gzip
import hashlib

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, StringStartsWith

from tallyloom.llm import warc

DIR = "/root/testdata/sf0.001"


def expected(pages, least=0):
    last = {}
    for p, h in pages:
        if len(h) >= least:
            last[h] = max(last.get(h, p), p)
    return {p: (len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(),
                "response" if last.get(h, p) == p else "revisit", None if last.get(h, p) == p else last[h]) for p, h in pages}


def test_round_trip(spark):
    pages = spark.read.parquet(f"{DIR}/pages.parquet").select("page_id", "url", "html")
    extra = spark.createDataFrame(
        [(10_001, "u", None), (10_002, "u", ""), (10_003, "u", "a\r\n\r\nb"), (10_004, "u", "a\r\n\r\nb"), (10_005, None, "WARC/1.0 é")],
        "page_id long, url string, html string")
    every = pages.unionAll(extra).unionAll(pages.filter("page_id < 20").withColumn("page_id", F.col("page_id") + 20_000))
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in every.collect()]
    for least in (0, 5):
        got = {r["page_id"]: tuple(r)[1:] for r in warc.round_trip(every, least).collect()}
        assert got == expected(rows, least)


def test_payloads_come_back(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/1", "x" * 100_000), (2, "http://b/2", "é\r\n\r\nß"), (3, "http://a/3", "")], "page_id long, url string, html string")
    warc.archive(pages, str(tmp_path / "w"))
    got = warc.read(spark, str(tmp_path / "w")).select("target_uri", F.decode("payload", "utf-8").alias("p")).collect()
    assert {tuple(r) for r in got} == {("http://a/1", "x" * 100_000), ("http://b/2", "é\r\n\r\nß"), ("http://a/3", "")}
    pushed = warc.read(spark, str(tmp_path / "w")).filter("record_type = 'response' and target_uri like 'http://a/%'")
    assert pushed.count() == 2


def test_pushed_predicates_spare_payloads(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://{'a' if i % 10 else 'b'}/{i}", f"page {i} " * 500) for i in range(100)], "page_id long, url string, html string")
    warc.archive(pages.coalesce(2), str(tmp_path / "w"))
    reader = warc.WarcReader({"path": str(tmp_path / "w"), "partitionbytes": "1"})
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), StringStartsWith(("target_uri",), "http://b/"),
                                    EqualTo(("payload",), b"x"), EqualTo(("payload_length",), 3)]))
    assert len(left) == 2
    parts = reader.partitions()
    assert len(parts) >= 2 or len(parts[0].paths) == 1
    read = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert len(read) == 10 == reader.inflated


def test_foreign_files(spark, tmp_path):
    """Gzip members without the length field, plain files, many records, an unknown type."""
    records = [warc.record({"record_type": t, "record_id": f"<urn:x:{i}>", "target_uri": f"http://x/{i}", "payload": p})
               for i, (t, p) in enumerate([("warcinfo", b"i"), ("response", b"y" * 200_000), ("response", b""), ("metadata", None)])]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    (tmp_path / "c.warc.gz").write_bytes(b"")
    got = warc.read(spark, str(tmp_path)).filter("record_type = 'response'").select(F.octet_length("payload").alias("n")).collect()
    assert sorted(r["n"] for r in got) == [0, 0, 200_000, 200_000]
    assert warc.read(spark, str(tmp_path), payload=False).count() == 8


def test_many_records_in_one_member(spark, tmp_path):
    """A whole file compressed at once, several such members, line ends between records; nothing is lost."""
    records = [warc.record({"record_type": t, "record_id": f"<urn:x:{i}>", "payload": p})
               for i, (t, p) in enumerate([("response", b"a\r\n\r\nb" * 40_000), ("warcinfo", b"i"), ("response", b""), ("response", b"z" * 70_000)])]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(b"".join(records[:3])) + gzip.compress(b"\r\n".join(records[3:])) + warc.member(records[0]))
    (tmp_path / "c.warc").write_bytes(b"\r\n\r\n".join(records) + b"\r\n")
    for payload in (True, False):
        got = warc.read(spark, str(tmp_path), payload).groupBy("record_id").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.octet_length("payload")).alias("bytes")).collect()
        assert {r["record_id"]: r["n"] for r in got} == {"<urn:x:0>": 4, "<urn:x:1>": 3, "<urn:x:2>": 3, "<urn:x:3>": 3}
        if payload:
            assert {r["record_id"]: r["bytes"] for r in got} == {"<urn:x:0>": 240_000, "<urn:x:1>": 1, "<urn:x:2>": 0, "<urn:x:3>": 70_000}
    assert warc.read(spark, str(tmp_path)).filter("record_type = 'warcinfo'").count() == 3


def test_a_cut_file_is_an_error(tmp_path):
    whole = warc.record({"record_type": "response", "record_id": "<urn:x:1>", "payload": b"abc" * 100})
    forms = {"a.warc": whole, "b.warc.gz": gzip.compress(whole + whole), "c.warc.gz": warc.member(whole)}
    for name, data in forms.items():
        for cut in (30, len(data) * 2 // 3):
            path = tmp_path / f"{cut}{name}"
            path.mkdir()
            (path / name).write_bytes(data[:cut])
            for payload in ("true", "false"):
                reader = warc.WarcReader({"path": str(path), "payload": payload})
                try:
                    list(reader.read(reader.partitions()[0]))
                except ValueError as error:
                    assert "ends inside" in str(error)
                else:
                    raise AssertionError(f"{name} cut at {cut} was read as if whole")


def test_digest_is_checked(tmp_path):
    bad = warc.record({"record_type": "response", "record_id": "<urn:x:1>", "payload": b"abc", "payload_digest": "sha1:AAAA"})
    (tmp_path / "a.warc").write_bytes(bad)
    reader = warc.WarcReader({"path": str(tmp_path)})
    try:
        list(reader.read(reader.partitions()[0]))
    except ValueError as error:
        assert "digest" in str(error)
    else:
        raise AssertionError("a wrong digest went unseen")
