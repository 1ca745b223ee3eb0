"""WARC archives: written by Spark's text writer, read back by a Python data source.

Writing: a record is its header block and its content, and records are separated by two
line breaks.  Spark's text writer with that separator writes exactly this, on any file
system Spark can write to, one archive file for each partition.

Reading: ``spark.read.format("warc")`` plans partitions over whole files (small files
share one), takes over equality and IN predicates on the header columns, and parses a
record's headers first: a record that a predicate excludes, and every payload that the
requested columns do not need, is skipped by its length without being decoded.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition
from pyspark.sql.types import StructType

from panelcast.llm.common import importable_on_workers, looked_up, pack_scratch, scratch_path

# Names of the record format.
SEPARATOR = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_COLUMNS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
}
SCHEMA = "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"

#: Bytes of files that one read partition holds at least, if there are so many; payload bytes of one batch.
PARTITION_BYTES, BATCH_BYTES = 32 << 20, 8 << 20
#: Payloads shorter than this are always stored.
REVISIT_FROM = 1000


# ---- writing ---------------------------------------------------------------------


def _header(name: str, value):
    """One header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            revisit_from: int = REVISIT_FROM, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One ``record`` (text without the separator) for each page.

    Of pages with equal payloads of at least ``revisit_from`` bytes the one with the largest
    id is the response (all, if several rows have that id) and the others revisit it; every
    other page is a response.  A null html is an empty payload; a null url has no header;
    line breaks in a url become spaces; a null id has an empty record id and is the smallest.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    p = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                     F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("bigint").alias("n"))
    groups = pack_scratch(
        p.where(F.col("n") >= revisit_from).groupBy("digest").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1"), "warc-groups")
    large = looked_up(p.where(F.col("n") >= revisit_from), groups, "digest", "rows")
    every = large.unionByName(p.where(F.col("n") < revisit_from).withColumn("first", F.lit(None).cast("bigint")))
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:record:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(SEPARATOR))
    content = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", urn(F.col("id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _header("WARC-Refers-To", F.when(revisit, urn(F.col("first")))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", F.octet_length(content).cast("string")),
    )
    return every.select(F.concat(head, F.lit("\r\n"), content).alias("record"))


def write_warc(pages: DataFrame, path: str, compression: str = "none", **kw) -> str:
    """Write a record for every page; ``path`` gets one archive file for each partition."""
    records(pages, **kw).write.option("lineSep", SEPARATOR).option("compression", compression).text(path)
    return path


# ---- reading ---------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    """Whole files that one task reads."""

    paths: list[str] = field(default_factory=list)


def file_system(uri: str):
    """The file system of a URI and the path in it (Spark writes local paths as file:/...)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; give ``.schema(...)`` with some of the columns
    to read no others, and ``option("verify", "true")`` to check every stored payload's digest."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(schema, dict(self.options))


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = schema.fieldNames()
        unknown = set(self.columns) - {c.split()[0] for c in SCHEMA.split(", ")}
        if unknown:
            raise ValueError(f"unknown columns: {sorted(unknown)}")
        self.path = options["path"]
        self.verify = str(options.get("verify", "false")).lower() == "true"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADER_COLUMNS and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        system, root = file_system(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        files = sorted((f.path, f.size) for f in found if f.is_file and f.base_name[0] not in "._")
        out, size = [], PARTITION_BYTES
        for path, n in files:
            if size >= PARTITION_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(path)
            size += n
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}
        arrow = pa.schema([(c, kinds.get(c, pa.string())) for c in self.columns])
        system, _ = file_system(self.path)
        rows: list[dict] = []
        held = 0
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                for row in self.records(raw):
                    rows.append(row)
                    held += 200 + len(row.get("payload") or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    def records(self, raw) -> Iterator[dict]:
        """The wanted records of one file, as rows of the requested columns."""
        packed = raw.read(2) == b"\x1f\x8b"
        raw.seek(0)
        stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw, 1 << 20)
        body = "payload" in self.columns or self.verify
        length = "payload_bytes" in self.columns
        while (line := stream.readline()) != b"":
            if not line.strip():
                continue  # the separator of the record before
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a record: {line[:40]!r}")
            head = read_headers(stream)
            size = int(head["content-length"])
            row = {c: head.get(h.lower()) for c, h in HEADER_COLUMNS.items()}
            row = {c: unwrapped(c, v) for c, v in row.items()}
            if any(row[c] not in ok for c, ok in self.wanted.items()):
                stream.seek(size, io.SEEK_CUR)
                continue
            if (body or length) and head.get("content-type", "").startswith("application/http"):
                begin = stream.tell()
                stream.readline()  # status
                http = read_headers(stream)
                rest = size - (stream.tell() - begin)
                row["payload_bytes"] = int(http.get("content-length", rest))
            else:
                rest = size
                row["payload_bytes"] = size
            if body and row["record_type"] != "revisit":
                row["payload"] = stream.read(rest)
                if self.verify and hashlib.sha1(row["payload"]).hexdigest() != row["payload_digest"]:
                    raise ValueError(f"payload of {row['record_id']} does not match its digest")
                if self.verify and len(row["payload"]) != row["payload_bytes"]:
                    raise ValueError(f"payload of {row['record_id']} is not as long as its header says")
            else:
                stream.seek(rest, io.SEEK_CUR)
            yield {c: row.get(c) for c in self.columns}


def read_headers(stream) -> dict[str, str]:
    """Header lines up to the blank line; names in lower case."""
    out = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def unwrapped(column: str, value: str | None) -> str | None:
    """Record ids without their brackets, digests without their algorithm (in lower case)."""
    if value is None:
        return None
    if column in ("record_id", "refers_to"):
        return value.removeprefix("<").removesuffix(">")
    return value.rpartition(":")[2].lower() if column == "payload_digest" else value


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA, verify: bool = False) -> DataFrame:
    """The records below ``path`` with the given columns (a part of ``SCHEMA``)."""
    importable_on_workers(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(columns).option("verify", json.dumps(verify)).load(path)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages' archives (to the shared scratch folder unless ``path`` is given) and read them back.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``, one row for each
    page; every stored payload is hashed again while it is read.  See ``records`` for nulls and
    ties; further columns are not read; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = write_warc(pages, path or scratch_path(spark, "warc"))
    back = read_warc(spark, path, "record_type string, record_id string, refers_to string, payload_digest string, payload_bytes bigint", True)
    number = lambda c: F.regexp_extract(c, r"(-?\d+)$", 1).try_cast("bigint")
    return back.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       number("refers_to").alias("refers_to"))
