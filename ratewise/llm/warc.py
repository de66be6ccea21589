"""WARC archives as a PySpark data source.

``spark.read.format("warc")`` plans one partition per stretch of a file, answers filters on record
type and headers from the headers alone, and only decodes the payloads of records that pass, and
only if the payload column is asked for. ``df.write.format("warc")`` writes one archive per task.

Every record is written as a gzip member of its own whose extra field ``sl`` holds the member's
compressed length (as the WARC standard's annex on compression proposes). A reader inflates a record's
headers first and steps over a payload that it does not want without inflating it.

Other archives are read too: a folder without a manifest is any number of ``.warc`` and ``.warc.gz``
files, one partition each, whose records are found by their ``Content-Length``; gzip members are
inflated one after the other to find their end. A record that is cut off, has a wrong checksum or
does not begin as one raises an error in its task; nothing is passed over.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
                                    LessThan, LessThanOrEqual, WriterCommitMessage)

from ..session import scratch_path
from .common import ship, stored

SCHEMA = ("record_id string, record_type string, target_uri string, date string, refers_to string, "
          "payload_digest string, payload_bytes long, content_length long, payload string")
#: Payloads shorter than this are always written in full.
REVISIT_BYTES = 100
#: Compressed bytes that one read task covers.
SPLIT_BYTES = 16 << 20
#: One offset is kept in the manifest for each stretch of so many compressed bytes.
MARK_BYTES = 4 << 20
MANIFEST = "_manifest.json"
#: Fixed value: the records' date, so that a rewrite gives the same bytes.
DATE = "2024-01-01T00:00:00Z"

_VERSION = b"WARC/1.1"
_HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
    "date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length", "content_length": "Content-Length",
}
_NUMBERS = ("payload_bytes", "content_length")
_HEAD = struct.Struct("<4sLBB")
_EXTRA = struct.Struct("<H2sHLL")  # extra length, "sl", 8, compressed and uncompressed length


def member(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """A record as a gzip member with its own length in the extra field. Line breaks cannot
    stand in a header; they are written as blanks."""
    lines = [_VERSION] + [f"{k}: {' '.join(v.splitlines())}".encode() for k, v in headers]
    block = b"\r\n".join(lines) + b"\r\n\r\n" + payload + b"\r\n\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = pack.compress(block) + pack.flush()
    size = 10 + _EXTRA.size + len(body) + 8
    return (_HEAD.pack(b"\x1f\x8b\x08\x04", 0, 0, 255) + _EXTRA.pack(12, b"sl", 8, size, len(block) & 0xFFFFFFFF)
            + body + struct.pack("<LL", zlib.crc32(block), len(block) & 0xFFFFFFFF))


def record(row) -> bytes:
    payload = (row["payload"] or "").encode("utf-8", "surrogatepass")
    headers = [(_HEADERS[c], str(row[c])) for c in _HEADERS if c != "content_length" and row[c] is not None]
    return member([*headers, ("Content-Length", str(len(payload)))], payload)


def parse_headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _values(head: bytes) -> dict:
    got = parse_headers(head)
    row = {c: got.get(h.lower()) for c, h in _HEADERS.items()}
    for c in _NUMBERS:
        row[c] = int(row[c]) if row[c] is not None else None
    return row


def _some(file, n: int) -> bytes:
    """At least one byte, at most ``n``; an end here is a fault."""
    data = file.read(n)
    if not data:
        raise ValueError("the archive ends within a record")
    return data


def records(file, start: int, end: int, wanted, payloads: bool) -> Iterator[tuple[dict, str | None]]:
    """(column values, payload) of the wanted records whose members start in [start, end), for
    archives of this module. A payload that is decoded is checked against its member's checksum."""
    file.seek(start)
    at = start
    while at < end:
        fixed = file.read(10 + _EXTRA.size)
        if not fixed:
            return
        if len(fixed) < 10 + _EXTRA.size:
            raise ValueError("the archive ends within a record")
        if fixed[:4] != b"\x1f\x8b\x08\x04" or fixed[12:14] != b"sl":
            raise ValueError("a gzip member without its length in an archive with a manifest")
        size = _EXTRA.unpack(fixed[10:])[3]
        left = size - len(fixed) - 8
        inflate, head = zlib.decompressobj(-15), b""
        while b"\r\n\r\n" not in head:
            more = inflate.unconsumed_tail
            if not more:
                if inflate.eof or left <= 0:
                    raise ValueError("a record without the blank line after its headers")
                more = _some(file, min(left, 1024 if not head else 4096))
                left -= len(more)
            head += inflate.decompress(more, 4096)
        cut = head.index(b"\r\n\r\n")
        row = _values(head[:cut])
        if wanted(row):
            payload = None
            if payloads:
                rest = file.read(left)
                block = head + inflate.decompress(inflate.unconsumed_tail + rest) + inflate.flush()
                trailer = file.read(8)
                if len(rest) < left or len(trailer) < 8 or not inflate.eof:
                    raise ValueError("the archive ends within a record")
                if struct.unpack("<LL", trailer) != (zlib.crc32(block), len(block) & 0xFFFFFFFF):
                    raise ValueError(f"record {row['record_id']}: wrong checksum")
                body = block[cut + 4:-4]
                if len(body) != row["content_length"]:
                    raise ValueError(f"record {row['record_id']}: {len(body)} bytes, {row['content_length']} announced")
                payload = body.decode("utf-8", "surrogatepass")
            yield row, payload
        at += size
        file.seek(at)


class _Inflated:
    """The bytes of a file of gzip members as one stream; zlib checks every member's checksum."""

    def __init__(self, file):
        self.file, self.inflate, self.raw, self.fresh = file, zlib.decompressobj(31), b"", True

    def read(self, n: int) -> bytes:
        while True:
            if not self.raw:
                self.raw = self.file.read(1 << 16)
                if not self.raw:
                    if not self.fresh:
                        raise ValueError("the archive ends within a gzip member")
                    return b""
            try:
                data = self.inflate.decompress(self.raw, n)
            except zlib.error as e:
                raise ValueError(f"a damaged gzip member: {e}") from e
            self.fresh = False
            if self.inflate.eof:
                self.raw, self.inflate, self.fresh = self.inflate.unused_data, zlib.decompressobj(31), True
            else:
                self.raw = self.inflate.unconsumed_tail
            if data:
                return data


def any_records(file, compressed: bool, wanted, payloads: bool) -> Iterator[tuple[dict, str | None]]:
    """(column values, payload) of the wanted records of any archive, from its beginning. Unwanted
    payloads are stepped over piece by piece. Bytes of a payload that are no UTF-8 become U+FFFD."""
    source, held = (_Inflated(file) if compressed else file), b""
    while True:
        while not held.strip(b"\r\n"):  # blank lines between records
            held = source.read(1 << 16)
            if not held:
                return
        held = held.lstrip(b"\r\n")
        while b"\r\n\r\n" not in held:
            if len(held) >= 5 and not held.startswith(b"WARC/") or len(held) > 1 << 24:
                raise ValueError(f"not a WARC record: {held[:40]!r}")
            held += _some(source, 1 << 16)
        head, _, held = held.partition(b"\r\n\r\n")
        row = _values(head)
        if row["content_length"] is None:
            raise ValueError(f"record {row['record_id']}: no Content-Length")
        want, parts, left = wanted(row), [], row["content_length"]
        while True:
            if want and payloads:
                parts.append(held[:left])
            used = min(left, len(held))
            held, left = held[used:], left - used
            if not left:
                break
            held = _some(source, 1 << 16)
        if want:
            yield row, b"".join(parts).decode("utf-8", "replace") if payloads else None


_TESTS = {EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, GreaterThan: lambda x, v: x > v,
          GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
          IsNotNull: lambda x, v: True}


@dataclass
class Stretch(InputPartition):
    path: str
    start: int
    end: int
    own: bool = True


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.path = _local(options["path"])
        self.columns = [f.name for f in schema.fields]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if type(f) in _TESTS and len(f.attribute) == 1 else None
            if column in _HEADERS:
                self.tests.append((column, type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        """Stretches of about ``splitBytes``, cut at offsets that the manifest names; without a manifest
        every archive of the folder (or the one file) is a partition."""
        if not os.path.exists(os.path.join(self.path, MANIFEST)):
            found = [self.path] if os.path.isfile(self.path) else sorted(
                os.path.join(top, x) for top, _, names in os.walk(self.path) for x in names if x.endswith((".warc", ".warc.gz")))
            if not os.path.exists(self.path):
                raise FileNotFoundError(self.path)
            return [Stretch(x, 0, os.path.getsize(x), False) for x in found] or [Stretch("", 0, 0)]
        with open(os.path.join(self.path, MANIFEST)) as f:
            files = json.load(f)["files"]
        out = []
        for x in files:
            at = 0
            for mark in [*x["marks"], x["bytes"]]:
                if mark - at >= self.split or mark == x["bytes"] and mark > at:
                    out.append(Stretch(os.path.join(self.path, x["name"]), at, mark))
                    at = mark
        return out or [Stretch("", 0, 0)]

    def wanted(self, row: dict) -> bool:
        return all(row[c] is not None and _TESTS[kind](row[c], v) for c, kind, v in self.tests)

    def read(self, partition):
        if not partition.path:
            return
        payloads = "payload" in self.columns
        with open(partition.path, "rb") as f:
            found = (records(f, partition.start, partition.end, self.wanted, payloads) if partition.own
                     else any_records(f, partition.path.endswith(".gz"), self.wanted, payloads))
            for row, payload in found:
                yield tuple(payload if c == "payload" else row[c] for c in self.columns)


@dataclass
class Written(WriterCommitMessage):
    name: str
    bytes: int
    marks: list


class WarcWriter(DataSourceWriter):
    def __init__(self, options, overwrite):
        self.path, self.overwrite = _local(options["path"]), overwrite

    def write(self, iterator):
        """One archive per task attempt; only archives of committed attempts enter the manifest,
        so a task that is lost and run again leaves nothing that a reader sees."""
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        os.makedirs(self.path, exist_ok=True)
        at, last, marks = 0, 0, []
        with open(os.path.join(self.path, name), "wb") as f:
            for row in iterator:
                if at - last >= MARK_BYTES:
                    marks.append(at)
                    last = at
                data = record(row)
                f.write(data)
                at += len(data)
        return Written(name, at, marks)

    def commit(self, messages):
        files = [{"name": m.name, "bytes": m.bytes, "marks": m.marks} for m in messages if m and m.bytes]
        os.makedirs(self.path, exist_ok=True)
        target = os.path.join(self.path, MANIFEST)
        if not self.overwrite and os.path.exists(target):
            with open(target) as f:
                files = json.load(f)["files"] + files
        with open(target + ".new", "w") as f:
            json.dump({"files": files}, f)
        os.replace(target + ".new", target)

    def abort(self, messages):
        for m in messages:
            if m and os.path.exists(p := os.path.join(self.path, m.name)):
                os.remove(p)


def _local(path: str) -> str:
    """A mounted path for Python's files: archives lie in a folder that driver and executors share."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        raise ValueError(f"WARC archives need a mounted folder, not {path}")
    return path


class WarcDataSource(DataSource):
    """Options: ``path`` (a shared folder) and ``splitBytes``. The read schema is any part of
    ``SCHEMA``; without the column ``payload`` no payload is decoded."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A row of ``SCHEMA`` (less ``content_length``) for each page: ``response``, or ``revisit`` of
    the response with the smallest key among equal payloads of ``REVISIT_BYTES`` or more.

    Pages are matched by the payload's SHA-256; only (digest, key) is shuffled for the minimum.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    p = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), body.alias("body"),
                     F.sha2(body.cast("binary"), 256).alias("digest"),
                     F.octet_length(body).cast("long").alias("bytes"))
    long_ = F.col("bytes") >= REVISIT_BYTES
    first = stored(p.where(long_).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
                   .where("n > 1").select(F.col("digest").alias("d"), "first"), "first")
    p = p.join(first, (F.col("digest") == F.col("d")) & long_, "left")
    # rows that repeat the smallest key are all responses
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return p.select(
        urn(F.col("page")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.lit(DATE).alias("date"),
        F.when(again, urn(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.col("bytes").alias("payload_bytes"),
        F.lit(None).cast("long").alias("content_length"),
        F.when(again, "").otherwise(F.col("body")).alias("payload"))


def write(recs: DataFrame, path: str) -> None:
    register(recs.sparkSession)
    recs.write.format("warc").mode("overwrite").save(path)


def read(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


def page_of(urn) -> F.Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).cast("long")


def round_trip(pages: DataFrame, path: str | None = None, key: str = "page_id", url: str = "url",
               html: str = "html") -> DataFrame:
    """Archive ``pages`` and read the archives back: (page_id, payload_bytes, payload_digest,
    record_type, refers_to), one row per row of ``pages``.

    Responses are measured on their decoded payloads; revisits are read from headers alone. Null
    html is an empty payload. A null key has no record id: it comes back as null, and is a revisit
    if a page with a key has the same payload. Repeated rows are archived again; those of the
    smallest key are all responses. An empty table gives no rows. Other columns are not archived.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write(page_records(pages, key, url, html), path)
    body = F.col("payload").cast("binary")
    responses = (read(spark, path, "record_id string, record_type string, payload string")
                 .where("record_type = 'response'")
                 .select(page_of(F.col("record_id")).alias(key), F.octet_length(body).cast("long").alias("payload_bytes"),
                         F.sha2(body, 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to")))
    revisits = (read(spark, path, "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long")
                .where("record_type = 'revisit'")
                .select(page_of(F.col("record_id")).alias(key), "payload_bytes",
                        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
                        "record_type", page_of(F.col("refers_to")).alias("refers_to")))
    return responses.union(revisits)
