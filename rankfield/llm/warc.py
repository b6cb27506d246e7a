"""WARC archives as a Spark data source, and page tables written as archives.

Writing: each task writes one file of gzip members, a record each, under a name that no other
attempt uses; the commit lists the files that count in a manifest, so what a lost or repeated
task left behind is never read. The gzip header holds the member's length (the ``sl`` field).

Reading: the driver plans partitions of whole files; a task inflates a record's headers first,
tests the pushed-down predicates, and inflates a payload only when the record is wanted;
otherwise it goes on at the next member. Plain ``.warc`` files are read too.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from rankfield.llm.common import batches, quoted

MANIFEST = "_records.json"

#: Bytes of archives that one partition is planned to hold; a larger file is one by itself.
PARTITION_BYTES = 64 << 20

#: Payloads shorter than this are stored every time.
LEAST_REVISIT = 100

READ_SCHEMA = (
    "record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, content_length bigint, headers map<string,string>, payload binary"
)

WRITE_COLUMNS = ("record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload")

_READ = pa.schema(
    [
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_digest", pa.string()),
        ("content_length", pa.int64()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
    ]
)

# The format's line, the profile of a revisit, and the fields of a record that
# are columns here.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
COLUMN_FIELD = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """Return the file system of a URI or path, and the path in it."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def member(record: bytes) -> bytes:
    """Return the record as a gzip member whose header tells its own length."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    total = 12 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _clean(value: str) -> str:
    """A header value is one line: controls are written as ``%XX``."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(row: dict, date: str) -> bytes:
    """Return one record, headers and block; fields that are null are left out."""
    payload = row["payload"] or b""
    lines = [VERSION, f"WARC-Type: {row['record_type']}", f"WARC-Date: {date}"]
    for name, key in (("WARC-Record-ID", "record_id"), ("WARC-Target-URI", "target_uri"), ("WARC-Refers-To", "refers_to")):
        if row[key] is not None:
            lines.append(f"{name}: {_clean(row[key])}")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    if row["payload_digest"] is not None:
        lines.append(f"WARC-Payload-Digest: sha256:{row['payload_digest']}")
    if row["payload_bytes"] is not None:
        lines.append(f"X-Payload-Length: {row['payload_bytes']}")
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


@dataclass
class _Files(WriterCommitMessage):
    name: str
    size: int
    records: int


class WarcWriter(DataSourceArrowWriter):
    """Write record batches of ``WRITE_COLUMNS`` to one file for each task."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Files:
        store, folder = open_folder(self.path)
        store.create_dir(folder, recursive=True)
        name, size, records = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
        with store.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in iterator:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i].as_py() for c in WRITE_COLUMNS}
                    size += out.write(member(record_bytes(row, self.date)))
                    records += 1
        return _Files(name, size, records)

    def commit(self, messages: list[_Files | None]) -> None:
        store, folder = open_folder(self.path)
        store.create_dir(folder, recursive=True)
        files = [{"name": m.name, "size": m.size, "records": m.records} for m in messages if m]
        with store.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[_Files | None]) -> None:
        """Files without a manifest are never read."""


@dataclass
class _Split(InputPartition):
    files: list[str]


class WarcReader(DataSourceReader):
    """Plan whole files; test predicates on headers before a payload is inflated."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.split_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.payloads = options.get("payload", "true").lower() == "true"
        self.wanted: list[tuple[str, set]] = [
            (name.removeprefix("header."), {value}) for name, value in options.items() if name.startswith("header.")
        ]

    def pushFilters(self, filters):
        """Take equality tests on columns that are header fields; leave the rest to Spark."""
        for test in filters:
            values = {test.value} if isinstance(test, EqualTo) else set(test.value) if isinstance(test, In) else None
            name = COLUMN_FIELD.get(test.attribute[0]) if values and len(test.attribute) == 1 else None
            if name:
                self.wanted.append((name, {str(v) for v in values}))
            else:
                yield test

    def partitions(self) -> list[_Split]:
        store, folder = open_folder(self.path)
        listed = store.get_file_info(f"{folder}/{MANIFEST}")
        if listed.type == fs.FileType.File:
            with store.open_input_stream(f"{folder}/{MANIFEST}") as source:
                files = [(f["name"], f["size"]) for f in json.loads(source.read())]
        else:
            infos = store.get_file_info(fs.FileSelector(folder))
            files = [(i.base_name, i.size) for i in infos if i.base_name.endswith((".warc", ".warc.gz"))]
        splits: list[_Split] = []
        held, size = [], 0
        for name, length in sorted(files, key=lambda f: f[0]):
            if held and size + length > self.split_bytes:
                splits.append(_Split(held))
                held, size = [], 0
            held.append(f"{folder}/{name}")
            size += length
        return [*splits, _Split(held)] if held else splits

    def read(self, partition: _Split) -> Iterator[pa.RecordBatch]:
        store, _ = open_folder(self.path)
        for file in partition.files:
            with store.open_input_file(file) as source:
                yield from batches(self._rows(source), _READ, 256)

    def _rows(self, source) -> Iterator[tuple]:
        for headers, payload in records(source, self._keep):
            digest = headers.get("warc-payload-digest")
            yield (
                headers.get("warc-type"),
                headers.get("warc-record-id"),
                headers.get("warc-target-uri"),
                headers.get("warc-refers-to"),
                digest.removeprefix("sha256:") if digest else None,
                int(headers.get("content-length", 0)),
                list(headers.items()),
                payload() if self.payloads else None,
            )

    def _keep(self, headers: dict) -> bool:
        return all(_field(headers, name) in values for name, values in self.wanted)


def _field(headers: dict, name: str) -> str | None:
    value = headers.get(name)
    return value.removeprefix("sha256:") if value and name == "warc-payload-digest" else value


def parse_headers(block: bytes) -> dict[str, str]:
    """Return the named fields in lower case; the first of a repeated name counts."""
    fields: dict[str, str] = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, found, value = line.partition(":")
        if found:
            fields.setdefault(name.strip().lower(), value.strip())
    return fields


def records(source, keep) -> Iterator[tuple[dict, object]]:
    """Yield the headers of each kept record and a function that reads its payload.

    It is called at most once, before the next record is asked for.
    """
    file = io.BufferedReader(source, 1 << 16) if isinstance(source, io.RawIOBase) else source
    at, end = 0, file.size() if hasattr(file, "size") and callable(file.size) else None
    while end is None or at < end:
        file.seek(at)
        head = file.read(24)
        if not head:
            return
        at = yield from (_packed if head[:2] == b"\x1f\x8b" else _plain)(file, at, head, keep)


def _packed(file, at: int, head: bytes, keep):
    """One gzip member. Returns where the next one starts."""
    total = struct.unpack("<I", head[16:20])[0] if head[3] & 4 and head[12:14] == b"sl" else None
    file.seek(at)
    inflate = zlib.decompressobj(31)
    text, read, seen = bytearray(), 0, 0
    while text.find(b"\r\n\r\n", max(0, seen - 3)) < 0 and not inflate.eof:
        seen, raw = len(text), inflate.unconsumed_tail
        if not raw:
            raw = file.read(4096 if total is None else min(4096, total - read))
            read += len(raw)
        # Without new bytes there can still be output that the last call had no room for.
        text += inflate.decompress(raw, 8192)
        if not raw and len(text) == seen and not inflate.eof:
            raise ValueError(f"the archive ends within the record at byte {at}")
    head_end = text.index(b"\r\n\r\n", max(0, seen - 3)) + 4
    headers = parse_headers(bytes(text[: head_end - 4]))
    length = int(headers.get("content-length", 0))

    called = False

    def rest() -> bytes:
        nonlocal read, called
        called = True
        file.seek(at + read)
        parts = [text[head_end:]]
        if not inflate.eof:  # after the end the tail is what follows the member
            parts.append(inflate.decompress(inflate.unconsumed_tail))
        while not inflate.eof:
            more = file.read(1 << 16 if total is None else min(1 << 16, total - read))
            if not more:
                raise ValueError(f"the archive ends within the record at byte {at}")
            read += len(more)
            parts.append(inflate.decompress(more))
        return b"".join(parts)[:length]

    if total is None:
        # Only the end of the member tells where the next one starts.
        payload = rest()
        if keep(headers):
            yield headers, lambda: payload
        return at + read - len(inflate.unused_data)
    if keep(headers):
        yield headers, rest
        if not called:  # a payload nobody asked for is passed over, but has to be there
            file.seek(at + total - 1)
            if not file.read(1):
                raise ValueError(f"the archive ends within the record at byte {at}")
    return at + total


def _plain(file, at: int, head: bytes, keep):
    """One record that is not compressed. Returns where the next one starts."""
    text = head
    while b"\r\n\r\n" not in text:
        more = file.read(4096)
        if not more:
            if not text.strip():
                return at + len(text)
            raise ValueError(f"the archive ends within the record at byte {at}")
        text += more
    lead = len(text) - len(text.lstrip(b"\r\n"))
    head_end = text.index(b"\r\n\r\n", lead) + 4
    headers = parse_headers(text[lead : head_end - 4])
    length = int(headers.get("content-length", 0))

    def payload() -> bytes:
        file.seek(at + head_end)
        return file.read(length)

    if keep(headers):
        yield headers, payload
    return at + head_end + length + 4


class WarcDataSource(DataSource):
    """Format ``warc``. Options: ``path``; reading also ``payload`` (``false`` leaves payloads
    unread), ``header.<field>`` (a value the field must have) and ``partitionBytes``; writing
    also ``date``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def _lower(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self._lower())

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self._lower())


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let filters reach it."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Read archives. Filters on type, ids, target and digest are tested on the headers."""
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def page_records(
    pages: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = LEAST_REVISIT,
) -> DataFrame:
    """Turn pages into records; equal payloads of ``least`` bytes or more are stored once.

    The smallest key among equal payloads is the response, and the others revisit it. A null
    payload is empty; a null key sorts after all others; of repeated rows with that smallest
    key each is a response.
    """
    body = F.coalesce(F.col(quoted(payload)).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(
        F.col(quoted(key)).cast("string").alias("page"),
        F.col(quoted(key)).alias("page_key"),
        F.col(quoted(url)).cast("string").alias("target_uri"),
        body.alias("payload"),
    ).withColumns(
        {"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("bigint")}
    )
    first = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min("page_key").alias("first_key"), F.count("*").alias("copies"))
        .filter((F.col("copies") > 1) & F.col("first_key").isNotNull())
        .select(F.col("payload_digest").alias("first_digest"), "first_key")
    )
    met = rows.join(first, F.col("payload_digest") == F.col("first_digest"), "left")
    again = F.col("first_key").isNotNull() & ~F.col("page_key").eqNullSafe(F.col("first_key"))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return met.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        name(F.col("page")).alias("record_id"),
        "target_uri",
        F.when(again, name(F.col("first_key"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_warc(records_: DataFrame, path: str, **options: str) -> None:
    """Write records (``WRITE_COLUMNS``) as archives below ``path``."""
    register(records_.sparkSession)
    records_.select(*WRITE_COLUMNS).write.format("warc").options(**options).mode("append").save(path)
