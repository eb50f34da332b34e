"""Web archives (WARC 1.1): written by Spark's text writer, read by a Python data source.

Writing is a projection: each row becomes the text of one record, and records are joined by the
line separator, so any store that Spark writes to will do. Rows with equal payloads become one
response and revisit records that refer to it, which carry the HTTP header but no payload.

Reading plans partitions of whole files by size. A partition reads a record's header block first
and asks the pushed-down predicates on record type and headers; the block of an unwanted record is
skipped (sought over in plain files), and a payload is decoded only when it is asked for.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull
from pyspark.sql.types import StructType

from txnrisk.llm.common import ship
from txnrisk.llm.steps import Steps

HEX_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"

# Column -> header that it shows. Predicates on these are tested on the header block alone.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_length": "content-length",
}
SCHEMA = (
    "record_type string, record_id string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, content_length long, http_header string, payload binary"
)


def sha1_base32(payload: Column) -> Column:
    """SHA-1 of bytes in upper-case base32: five hexadecimal digits are four digits of 32."""
    digits = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0")
        for i in range(8)
    ]
    return F.translate(F.concat(*parts), HEX_DIGITS, BASE32_DIGITS)


def record_uri(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.url_encode(key.cast("string")), F.lit(">"))


def key_of(uri: Column) -> Column:
    """The key in a record's URI, as text; null where there is none."""
    found = F.regexp_extract(uri, "^<urn:page:(.*)>$", 1)
    return F.url_decode(F.when(found != "", found))


def header(name: str, value: Column) -> Column:
    """A header line; nothing where the value is null. Line ends in a value become blanks."""
    clean = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    compression: str = "gzip",
    records_per_file: int = 50_000,
) -> None:
    """Write one record for each row to files under ``path``.

    Rows with equal payloads of at least ``least_bytes`` bytes: those with the least key are
    responses, the others revisits. A null payload counts as empty; a row with a null key has a
    record id without a key, and is a revisit where another equal row has a key; where none has,
    all are responses. Repeated rows with the least key are all responses. A null URI has no
    header. Other columns are not written; an empty table gives an archive without records.
    """
    steps = Steps(pages.sparkSession, "warc")
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{uri}`").alias("uri"), body.alias("body"))
    rows = rows.withColumn("digest", sha1_base32(F.encode("body", "UTF-8"))).withColumn("bytes", F.octet_length("body"))
    equal = rows.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
    first = equal.agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = steps.put("first", first)
    rows = rows.join(first, ["digest", "bytes"], "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("key"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "bytes", F.lit("\r\n\r\n"))
    stored = F.when(again, F.lit("")).otherwise(F.col("body"))
    block = F.concat(http, stored)
    profile = F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(again, "revisit").otherwise("response")),
        header("WARC-Record-ID", F.coalesce(record_uri(F.col("key")), F.lit("<urn:page:>"))),
        header("WARC-Date", F.lit(DATE)),
        header("WARC-Target-URI", F.col("uri")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        header("WARC-Refers-To", F.when(again, record_uri(F.col("first")))),
        header("WARC-Profile", profile),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        header("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
        F.lit("\r\n"),
    )
    out = rows.select(record.alias("value")).write.option("lineSep", "\r\n").option("compression", compression)
    out.option("maxRecordsPerFile", records_per_file).text(path)
    steps.drop("first")


@dataclass
class Files(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class WarcReader(DataSourceReader):
    """Options: ``path``; ``payload`` (true): whether payloads are read; ``partition_bytes``."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", 32 << 20))
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for item in filters:
            name = ".".join(getattr(item, "attribute", ()))
            if name in HEADERS and isinstance(item, (EqualTo, In, IsNotNull, IsNull)):
                values = (item.value,) if isinstance(item, EqualTo) else tuple(getattr(item, "value", ()))
                self.tests.append((HEADERS[name], type(item).__name__, values))
            else:
                yield item

    def partitions(self) -> list[Files]:
        """Whole files, in groups of about ``partition_bytes``."""
        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((i.path, i.size) for i in found if i.is_file and i.base_name[0] not in "._" and i.size)
        groups, room = [], 0
        for path, size in files:
            if not groups or size > room:
                groups.append(Files([]))
                room = self.partition_bytes
            groups[-1].paths.append(path)
            room -= size
        return groups

    def wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, values in self.tests:
            value = headers.get(name)
            if kind in ("IsNull", "IsNotNull"):
                if (value is None) != (kind == "IsNull"):
                    return False
            elif value is None or (int(value) if name == "content-length" else value) not in values:
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        schema = arrow_schema()
        rows, held = [], 0
        for path in partition.paths:
            with opened(store, path) as source:
                for row in records(source, self.wanted, self.with_payload):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)  # noqa: B905
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)  # noqa: B905


def arrow_schema() -> pa.Schema:
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([pa.field(n, types[t]) for n, t in (f.split() for f in SCHEMA.split(", "))])


def opened(store: fs.FileSystem, path: str) -> io.BufferedIOBase:
    """A file for reading from the start, unpacked if its name says so."""
    if path.endswith(".gz"):
        return gzip.GzipFile(fileobj=store.open_input_file(path))
    return io.BufferedReader(store.open_input_file(path), 1 << 20)


def records(source: io.BufferedIOBase, wanted, with_payload: bool) -> Iterator[tuple]:
    """The wanted records of a file, one after another, in the order of the schema."""
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record where one should begin: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := source.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        if not wanted(headers):
            source.seek(length, io.SEEK_CUR)
            continue
        http, left = [], length
        if headers.get("content-type", "").startswith("application/http"):
            while left:
                line = source.readline(left)
                left -= len(line)
                if not line.strip():
                    break
                http.append(line)
        payload = None
        if with_payload and headers.get("warc-type") != "revisit":
            payload = source.read(left)
            if len(payload) < left:
                raise ValueError("the last record is cut short")
        else:
            source.seek(left, io.SEEK_CUR)
        shown = [headers.get(h) for h in HEADERS.values()]
        yield (*shown[:-1], length, b"".join(http).decode("utf-8", "replace"), payload)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``: one row for each record."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of an archive. Filters on record type and headers are pushed down.

    ``payload`` is null for revisits, and for all records if it is not asked for.
    """
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def http_length(http_header: Column) -> Column:
    """The payload's length that the HTTP header states."""
    return F.regexp_extract(http_header, r"(?i)content-length:\s*(\d+)", 1).cast("long")


def round_trip(pages: DataFrame, path: str, **options) -> DataFrame:
    """Write ``pages`` to ``path`` and read the archive back.

    ``key``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` (a key) of
    each record. The digests of responses are computed from the payloads that were read.
    """
    write(pages, path, **options)
    spark = pages.sparkSession
    full = read(spark, path).where(F.col("record_type") == "response").select(
        "record_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"),
    )
    again = read(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        "record_id", "record_type", "refers_to", http_length(F.col("http_header")).alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
    )
    both = full.union(again)
    return both.select(
        key_of(F.col("record_id")).alias("key"), "payload_bytes", "payload_digest", "record_type",
        key_of(F.col("refers_to")).alias("refers_to"),
    )
