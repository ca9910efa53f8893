"""WARC archives as a Spark data source: one gzip member per record, headers parsed first.

``write`` stores records, ``read`` gives them back. The reader plans its partitions from file
sizes, takes predicates on the record type and the other header columns, parses a record's
headers, and inflates its payload only if the record passes and the payload is asked for. The
writer notes the length of each member in its gzip header (the "sl" field that the WARC
standard names), so unwanted members are skipped by a seek. Foreign files without that field are
read too; there the unwanted rest of a member is inflated in pieces and thrown away.

Files are reached by pyarrow's file systems (local, hdfs, s3, gs), from any executor.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage,
)

from tallyloom.session import scratch_path, stage

SCHEMA = ("record_type string, record_id string, target_uri string, payload_digest string, refers_to string, "
          "payload_length bigint, headers map<string,string>, payload binary")
HEADER_COLUMNS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "payload_length": "WARC-X-Payload-Length",
}
#: Compressed bytes after which the writer begins another file, and that one reading task takes at least one file of.
FILE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def member(raw: bytes) -> bytes:
    """One gzip member with its lengths in the extra field."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeeze.compress(raw) + squeeze.flush()
    total = 12 + 12 + len(body) + 8
    lengths = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF) if total < 2**32 else b"xx" + bytes(10)
    return b"".join([b"\x1f\x8b\x08\x04\0\0\0\0\0\xff", struct.pack("<H", 12), lengths, body,
                     struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)])


def one_line(value: str) -> str:
    return " ".join(value.split())


def record(row: dict) -> bytes:
    """A record's bytes; a payload goes behind an HTTP head, a record without one has an empty block."""
    payload = row.get("payload")
    block = b"" if payload is None else HTTP % len(payload) + payload
    lines = ["WARC/1.1", "WARC-Date: 1970-01-01T00:00:00Z"]
    for column, name in HEADER_COLUMNS.items():
        if row.get(column) is not None:
            lines.append(f"{name}: {one_line(str(row[column]))}")
    for name, value in row.get("headers") or []:
        if value is not None:
            lines.append(f"{one_line(name)}: {one_line(value)}")
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files under names of its own; only those of tasks that count get their final names."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator) -> Written:
        store, root = _filesystem(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name = uuid.uuid4().hex
                    files.append((f"{root}/_{name}", f"{root}/{name}.warc.gz"))
                    out, size = store.open_output_stream(files[-1][0]), 0
                data = member(record(row))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        store, root = _filesystem(self.path)
        store.create_dir(root, recursive=True)
        for m in messages:
            for made, final in m.files if m else []:
                store.move(made, final)

    def abort(self, messages) -> None:
        store, _ = _filesystem(self.path)
        for m in messages:
            for made, _final in m.files if m else []:
                store.delete_file(made)


@dataclass
class Files(InputPartition):
    paths: list[str]


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", FILE_BYTES))
        self.tests: list[tuple[str, str, tuple]] = []
        self.inflated = 0

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            usable = column in HEADER_COLUMNS and column != "payload_length"
            if usable and isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif usable and isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif usable and isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", (f.value,)))
            else:
                yield f

    def partitions(self):
        store, root = _filesystem(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        files = sorted((f.path, f.size) for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz")))
        parts, held = [[]], 0
        for path, size in files:
            if parts[-1] and held + size > self.partition_bytes:
                parts.append([])
                held = 0
            parts[-1].append(path)
            held += size
        return [Files(p) for p in parts]

    def wanted(self, headers: dict[str, str]) -> bool:
        for column, how, values in self.tests:
            own = headers.get(HEADER_COLUMNS[column])
            if own is None or not (own in values if how == "in" else own.startswith(values[0])):
                return False
        return True

    def read(self, partition: Files):
        store, _ = _filesystem(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as source:
                for headers, payload in self.records(source):
                    rows.append([*[headers.get(h) for h in HEADER_COLUMNS.values()], list(headers.items()), payload])
                    held += len(payload or b"") + 1000
                    if held >= BATCH_BYTES:
                        yield self.batch(rows)
                        rows, held = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows))
        names = [*HEADER_COLUMNS, "headers", "payload"]
        types = [*[pa.string()] * 5, pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
        columns[5] = [None if v is None else int(v) for v in columns[5]]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    def records(self, source):
        """(headers, payload) of the wanted records of one open file; a file that ends inside a record is an error."""
        size, at = source.size(), 0
        while at < size:
            source.seek(at)
            first = source.read(4096)
            part = _Member(source, at, first) if first[:2] == b"\x1f\x8b" else _Plain(source, at, first)
            while (head := part.until_blank_line()) is not None:
                headers = parse_headers(head)
                length = int(headers.get("Content-Length", 0))
                payload = None
                if self.wanted(headers):
                    if self.payload:
                        block = part.block(length)
                        if len(block) < length:
                            raise ValueError(f"file ends inside the record at byte {at}")
                        self.inflated += 1
                        payload = self.payload_of(headers, block)
                    yield headers, payload
                if not part.another(length):
                    break
            at = part.end()
            if at > size:
                raise ValueError("file ends inside its last record")

    def payload_of(self, headers: dict[str, str], block: bytes) -> bytes | None:
        if not block and headers.get("WARC-Type") == "revisit":
            return None
        payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
        told = headers.get("WARC-Payload-Digest", "")
        if self.verify and told.startswith("sha1:"):
            own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if own != told[5:]:
                raise ValueError(f"payload of {headers.get('WARC-Record-ID')} has digest {own}, not {told[5:]}")
        return payload


class _Plain:
    """A record of an uncompressed file."""

    def __init__(self, source, at: int, first: bytes):
        self.source, self.at, self.data = source, at, first

    def more(self) -> bool:
        extra = self.source.read(65536)
        self.data += extra
        return bool(extra)

    def until_blank_line(self) -> bytes | None:
        """The record's head; none where only line ends are left."""
        while (cut := self.data.find(b"\r\n\r\n", len(self.data) - len(self.data.lstrip(b"\r\n")))) < 0 and self.more():
            pass
        if cut < 0:
            if self.data.strip(b"\r\n"):
                raise ValueError(f"file ends inside the head of the record at byte {self.at}")
            self.next = self.at + len(self.data)
            return None
        self.body = cut + 4
        return self.data[:cut].lstrip(b"\r\n")

    def block(self, length: int) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < self.body + length and (extra := self.source.read(self.body + length - have)):
            parts.append(extra)
            have += len(extra)
        return b"".join(parts)[self.body:self.body + length]

    def another(self, length: int) -> bool:
        """False: the next record of a plain file is found by a seek, past the line ends that follow this one."""
        self.next = self.at + self.body + length
        return False

    def end(self) -> int:
        return self.next


class _Member:
    """A gzip member: one record, or several behind each other where no length field says that it is one."""

    def __init__(self, source, at: int, first: bytes):
        self.source, self.at = source, at
        self.total = None
        if first[3] & 4:
            (n,), extra = struct.unpack("<H", first[10:12]), first[12:]
            while n >= 4:
                kind, length = extra[:2], struct.unpack("<H", extra[2:4])[0]
                if kind == b"sl":
                    self.total = struct.unpack("<I", extra[4:8])[0]
                extra, n = extra[4 + length:], n - 4 - length
        self.inflate, self.pending, self.read_bytes = zlib.decompressobj(31), first, len(first)
        self.data = b""

    def step(self) -> bytes:
        """More inflated bytes; none at the end of the member."""
        while not self.inflate.eof:
            if not self.pending:
                self.pending = self.source.read(65536)
                self.read_bytes += len(self.pending)
                if not self.pending:
                    break
            out = self.inflate.decompress(self.pending, 65536)
            self.pending = self.inflate.unconsumed_tail
            if out:
                return out
        return b""

    def until_blank_line(self) -> bytes | None:
        """The head of the next record of the member; none where only line ends are left."""
        while (cut := self.data.find(b"\r\n\r\n", len(self.data) - len(self.data.lstrip(b"\r\n")))) < 0 and (out := self.step()):
            self.data += out
        if cut < 0:
            if self.data.strip(b"\r\n") or not self.inflate.eof:
                raise ValueError(f"file or member ends inside a head, member at byte {self.at}")
            return None
        self.body = cut + 4
        return self.data[:cut].lstrip(b"\r\n")

    def block(self, length: int) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < self.body + length and (out := self.step()):
            parts.append(out)
            have += len(out)
        self.data = b"".join(parts)
        return self.data[self.body:self.body + length]

    def another(self, length: int) -> bool:
        """Skip the rest of this record; whether more of the member may follow. What is skipped is not held."""
        if self.total:
            return False
        left = self.body + length
        while len(self.data) < left:
            left -= len(self.data)
            self.data = self.step()
            if not self.data:
                raise ValueError(f"file or member ends inside a record, member at byte {self.at}")
        self.data = self.data[left:]
        return True

    def end(self) -> int:
        if self.total:
            return self.at + self.total
        return self.at + self.read_bytes - len(self.inflate.unused_data)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"])


def _register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of all archives under ``path``; without ``payload`` that column is null and never inflated.

    That is asked for by ``payload``, not found out from the columns a query selects. Headers a
    record does not have are null; repeated records stay; no files, or empty ones, give no rows.
    Foreign files may be plain, hold a gzip member per record, or many records in one member. A
    file that ends inside a record is an error.
    """
    _register(spark)
    return spark.read.format("warc").option("payload", str(payload)).load(path)


def write(records: DataFrame, path: str) -> None:
    """Store records; needs the columns of ``SCHEMA`` that are to be written, others are left out.

    A null column is a header that is not written, a null payload an empty block; repeated rows
    are records of their own. An empty table writes no file.
    """
    _register(records.sparkSession)
    known = {**{c: "string" for c in HEADER_COLUMNS}, "headers": "map<string,string>", "payload": "binary"}
    records.select(*[F.col(c).cast(t).alias(c) for c, t in known.items() if c in records.columns]) \
        .write.format("warc").mode("append").save(path)


def revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """(key, digest, payload_length, record_type, refers_to) per page row; digest: SHA-1 in hex.

    Of pages with equal payloads of at least ``least_bytes``, the one with the largest key is the
    response and the others revisit it; all smaller payloads are responses. A null payload is
    empty. A null key never is the largest; where a payload has no other, all are responses.
    Repeated rows with the largest key are all responses.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    slim = stage(pages.select(F.col(key), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("payload_length")), "payloads")
    # Stored, so that the join below may split a payload that very many pages share.
    last = stage(slim.filter(F.col("payload_length") >= least_bytes).groupBy("digest").agg(F.max(key).alias("_last")), "responses")
    other = F.col("_last").isNotNull() & ~F.col(key).eqNullSafe(F.col("_last"))
    return slim.join(last, "digest", "left").select(
        key, "digest", "payload_length", F.when(other, "revisit").otherwise("response").alias("record_type"),
        F.when(other, F.col("_last")).alias("refers_to"))


def record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def key_of(record: Column) -> Column:
    return F.regexp_extract(record, r"^<urn:x-page:(.+)>$", 1).try_cast("long")


def base32(hexed: Column) -> Column:
    """Upper-case base32 of a hex string of 40 digits: eight groups of five digits, four letters each."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = []
    for g in range(8):
        number = F.conv(F.substring(hexed, 5 * g + 1, 5), 16, 10).cast("int")
        groups += [F.substring(letters, F.shiftright(number, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*groups)


def archive(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Store one record per row of pages (page_id, url, html); null html: empty payload. Other columns are not read."""
    spark = pages.sparkSession
    kinds = revisits(pages, "page_id", "html", least_bytes).distinct().select(
        F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "payload_length", "record_type", "refers_to")
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    own = pages.select("page_id", "url", body.alias("payload")).withColumn("digest", F.sha1("payload"))
    told = own.join(stage(kinds, "kinds"), own["page_id"].eqNullSafe(F.col("_id")) & (own["digest"] == F.col("_digest")))
    write(told.select(
        "record_type", record_id(F.col("page_id")).alias("record_id"), F.col("url").alias("target_uri"),
        F.concat(F.lit("sha1:"), base32(F.col("digest"))).alias("payload_digest"),
        F.when(F.col("refers_to").isNotNull(), record_id(F.col("refers_to"))).alias("refers_to"), "payload_length",
        F.when(F.col("record_type") == "response", F.col("payload")).alias("payload")), path)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), read back from archives of all pages.

    Responses are read with their payloads, which the reader checks against their digests; revisits by their headers alone.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    archive(pages, path, least_bytes)
    digest = F.substring("payload_digest", 6, 32).alias("payload_digest")
    page, target = key_of(F.col("record_id")).alias("page_id"), key_of(F.col("refers_to")).alias("refers_to")
    responses = read(spark, path).filter(F.col("record_type") == "response").select(
        page, F.octet_length("payload").cast("long").alias("payload_bytes"), digest, "record_type", target)
    others = read(spark, path, payload=False).filter(F.col("record_type") == "revisit").select(
        page, F.col("payload_length").alias("payload_bytes"), digest, "record_type", target)
    return responses.unionAll(others)
