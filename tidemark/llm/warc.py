"""WARC archives as a Spark data source, and pages written to and read from them.

Reading: the driver plans one partition per archive file.  Filters on header columns (record
type, url, digest, page id and so on) are pushed into the reader.  A record's headers are parsed
first; a record that a filter rules out, or whose payload the schema does not ask for, is stepped
over without being decompressed.  For that, written records carry their compressed size in the
gzip header; archives of other origin, with or without compression, are read as well.

Writing: each task writes files of bounded size under names of its own, and the driver commits
the job by one list of the files that count, so retried tasks leave nothing that is read.

Paths may name any file system that pyarrow opens (file, hdfs, s3 and so on).
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tidemark.functions.scratch import scratch_path, written
from tidemark.llm.common import joined_with_groups, stably_numbered, whole

SCHEMA = (
    "record_id string, record_type string, url string, date string, page_id bigint, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, payload binary"
)
FILE_BYTES = 64 << 20  # a task starts a new file after so many
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # pages carry no time of capture
_SUFFIXES = (".warc", ".warc.gz")
_HEAD = 4096  # bytes taken out of a record at first to find its headers
_ID = re.compile(r"<urn:x-page:(-?\d+)(?::\d+)?>")


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _value(text: str) -> str:
    """A header value on one line."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str | None) -> str | None:
    return None if value is None else value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


# --- writing ------------------------------------------------------------------------------


def record(url: str | None, page_id: int | None, row: int, record_type: str, payload: bytes, refers_to: int | None, level: int = 1) -> bytes:
    """One record as a gzip member.  A revisit keeps the headers of its payload and leaves it out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if record_type == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:x-page:{page_id if page_id is not None else -1}:{row}>", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {_value(url)}"] if url is not None else []
    head += [f"X-Page-Id: {page_id}"] if page_id is not None else []
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if record_type == "revisit":
        head += [f"WARC-Profile: {PROFILE}"] + ([f"WARC-Refers-To: <urn:x-page:{refers_to}>"] if refers_to is not None else [])
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    data = "\r\n".join(head).encode() + body + b"\r\n\r\n"
    squeezed = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = squeezed.compress(data) + squeezed.flush()
    size = 24 + len(packed) + 8
    # The extra field "SL" holds the sizes of the member and of the record.
    extra = struct.pack("<H2sHII", 12, b"SL", 8, size, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x04\xff" + extra + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class _Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    """Takes the columns ``page_id, row, url, record_type, refers_to, payload``."""

    def __init__(self, path: str, file_bytes: int):
        self.path, self.file_bytes = path, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, root = fs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        done, out, size = _Written(), None, 0
        for batch in iterator:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                get = lambda name: columns[name][i].as_py()  # noqa: B023, E731
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, size = system.open_output_stream(f"{root}/{name}", compression=None), 0
                    done.files.append(name)
                data = record(get("url"), get("page_id"), get("row"), get("record_type"), bytes(get("payload") or b""), get("refers_to"))
                out.write(data)
                size += len(data)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return done

    def commit(self, messages) -> None:
        system, root = fs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        files = sorted(name for m in messages if m is not None for name in m.files)
        with system.open_output_stream(f"{root}/_files-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        """Files of a failed job stay out of every list, so nothing reads them."""


# --- reading ------------------------------------------------------------------------------


@dataclass
class _File(InputPartition):
    path: str


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _number(value: str | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(r"-?\d+", value) else None


def parse(head: bytes) -> dict:
    """The header columns of a record, from its bytes up to the payload."""
    own, _, rest = head.partition(b"\r\n\r\n")
    headers = _headers(own)
    http = {}
    if headers.get("content-type", "").startswith("application/http"):
        http = _headers(rest.partition(b"\r\n\r\n")[0])
    length = _number(http.get("content-length")) if http else _number(headers.get("content-length"))
    refers = _ID.fullmatch(headers.get("warc-refers-to", ""))
    named = headers.get("warc-payload-digest")
    return {
        "record_id": headers.get("warc-record-id"),
        "record_type": headers.get("warc-type"),
        "url": _plain(headers.get("warc-target-uri")),
        "date": headers.get("warc-date"),
        "page_id": _number(headers.get("x-page-id")),
        "refers_to": int(refers[1]) if refers else None,
        "payload_bytes": length,
        "payload_digest": named.removeprefix("sha1:") if named else None,
        "_http": bool(http),
        "_block": _number(headers.get("content-length")) or 0,
    }


class _Stream:
    """Buffered reading with steps forward that touch nothing."""

    def __init__(self, source: pa.NativeFile):
        self.source, self.buffer, self.size = source, b"", source.size()
        self.at = 0  # where the buffer starts

    def peek(self, n: int) -> bytes:
        if len(self.buffer) < n:
            self.source.seek(self.at + len(self.buffer))
            self.buffer += self.source.read(max(n - len(self.buffer), 1 << 18))
        return self.buffer[:n]

    def skip(self, n: int) -> None:
        self.buffer = self.buffer[n:]
        self.at += n

    def done(self) -> bool:
        return self.at >= self.size


def records(source: pa.NativeFile, wants, payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """The records whose header columns ``wants`` accepts; payloads only when asked for."""
    stream = _Stream(source)
    while not stream.done():
        start = stream.peek(24)
        if start[:2] == b"\x1f\x8b":
            known = struct.unpack("<I", start[16:20])[0] if len(start) == 24 and start[3] & 4 and start[12:14] == b"SL" else None
            if known:
                yield from _member(stream, known, wants, payload)
            else:
                yield from _foreign_member(stream, wants, payload)
        elif start[:1] in (b"\r", b"\n"):  # the empty lines after a record
            stream.skip(1)
        else:
            yield from _bare(stream, wants, payload)


def _payload(row: dict, block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2] if row["_http"] else block


def _has_headers(head: bytes) -> bool:
    """Whether the headers end in ``head``, of a captured message also its own."""
    own, end, rest = head.partition(b"\r\n\r\n")
    return bool(end) and (b"\r\n\r\n" in rest or not _headers(own).get("content-type", "").startswith("application/http"))


def _member_head(stream: _Stream, size: int) -> bytes:
    """The start of a gzip member of known size, as far as its headers go, however long they are."""
    engine, head, taken, feed = zlib.decompressobj(31), b"", 0, b""
    while not _has_headers(head):
        if not feed and taken < size:
            more = min(size, max(_HEAD, 2 * taken))
            feed, taken = stream.peek(more)[taken:], more
        piece = engine.decompress(feed, max(_HEAD, len(head)))
        feed = engine.unconsumed_tail
        if not piece and (engine.eof or (not feed and taken == size)):
            raise ValueError("a WARC record ends before its headers do")
        head += piece
    return head


def _member(stream: _Stream, size: int, wants, payload: bool):
    """A gzip member of known size: headers first, the rest only when wanted."""
    row = parse(_member_head(stream, size))
    if wants(row):
        content = None
        if payload and row["record_type"] != "revisit":
            data = zlib.decompress(stream.peek(size), 31)
            body = data.index(b"\r\n\r\n") + 4
            content = _payload(row, data[body : body + row["_block"]])
        yield row, content
    stream.skip(size)


def _foreign_member(stream: _Stream, wants, payload: bool):
    """A gzip member of unknown size has to be decompressed to find its end."""
    engine, parts = zlib.decompressobj(31), []
    while not engine.eof and not stream.done():
        chunk = stream.peek(1 << 16)
        parts.append(engine.decompress(chunk))
        stream.skip(len(chunk) - len(engine.unused_data))
    data = b"".join(parts)
    body = data.find(b"\r\n\r\n") + 4
    row = parse(data)
    if row["record_type"] and wants(row):
        yield row, _payload(row, data[body : body + row["_block"]]) if payload and row["record_type"] != "revisit" else None


def _bare(stream: _Stream, wants, payload: bool):
    """A record without compression: the block is stepped over unless its payload is wanted."""
    n = _HEAD
    while b"\r\n\r\n" not in (own := stream.peek(n)) and len(own) == n:
        n *= 2
    if b"\r\n\r\n" not in own:
        raise ValueError("not a WARC record")
    body = own.index(b"\r\n\r\n") + 4
    size = _number(_headers(own[: body - 4]).get("content-length")) or 0
    n = min(size, _HEAD)
    while not _has_headers(head := stream.peek(body + n)) and n < size:
        n = min(size, 2 * n)
    row = parse(head)
    if wants(row):
        yield row, _payload(row, stream.peek(body + size)[body:]) if payload and row["record_type"] != "revisit" else None
    stream.skip(body + size)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, verify: bool):
        self.path, self.schema, self.verify = path, schema, verify
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        """Takes tests on header columns; the rest stays with Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
            if column in ("", "payload") or column not in self.schema.fieldNames():
                yield f
            elif isinstance(f, (EqualTo, EqualNullSafe)):
                self.tests.append((column, "in", [f.value]))
            elif isinstance(f, In):
                self.tests.append((column, "in", list(f.value)))
            elif isinstance(f, (IsNull, IsNotNull)):
                self.tests.append((column, "null", isinstance(f, IsNull)))
            else:
                yield f

    def partitions(self) -> list[_File]:
        system, root = fs.FileSystem.from_uri(self.path)
        found = [f for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.is_file]
        lists = [f for f in found if f.base_name.startswith("_files-")]
        if lists:
            names = []
            for f in lists:
                with system.open_input_stream(f.path, compression=None) as listed:
                    names += json.loads(listed.read())
        else:
            names = [f.base_name for f in found if f.base_name.endswith(_SUFFIXES)]
        return [_File(name) for name in sorted(names)] or [_File("")]

    def wants(self, row: dict) -> bool:
        for column, kind, value in self.tests:
            have = row.get(column)
            if (kind == "in" and (have not in value)) or (kind == "null" and (have is None) != value):
                return False
        return True

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.path:
            return
        names, schema = self.schema.fieldNames(), to_arrow_schema(self.schema)
        system, root = fs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        with system.open_input_file(f"{root}/{partition.path}") as source:
            for row, content in records(source, self.wants, "payload" in names):
                if content is not None:
                    if self.verify and row["payload_digest"] and digest(content) != row["payload_digest"]:
                        raise ValueError(f"payload of {row['record_id']} does not match its digest")
                    if self.verify and row["payload_bytes"] != len(content):
                        raise ValueError(f"payload of {row['record_id']} does not match its length")
                    size += len(content)
                rows.append([content if name == "payload" else row.get(name) for name in names])
                if len(rows) >= 4096 or size >= 8 << 20:
                    yield _batch(rows, schema)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, schema)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


class WarcSource(DataSource):
    """``format("warc")``; options: ``verify`` checks read payloads against their headers, ``file_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, self.options.get("verify", "false").lower() == "true")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to")
        return WarcWriter(self.options["path"], int(self.options.get("file_bytes", FILE_BYTES)))


def register(spark: SparkSession) -> None:
    """Makes ``format("warc")`` known, and lets Spark hand filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_pages(pages: DataFrame, path: str, least: int = 0, id_col: str = "page_id", url: str = "url", html: str = "html") -> None:
    """One record per page: of equal payloads of at least ``least`` bytes the page with the smallest
    id is a response and the others revisit it; smaller payloads are all responses.

    A NULL page is an empty payload.  NULL ids come last; rows that repeat id and payload are told
    apart by their place, so exactly one of a group is the response.
    """
    columns = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), whole(html).alias("html"))
    rows, row = stably_numbered(columns)
    rows = rows.withColumnRenamed(row, "row")
    # Which pages revisit which is decided on digests; copies of a page never meet with their texts.
    digests = rows.select("page_id", "row", F.sha1(F.col("html").cast("binary")).alias("sha"), F.octet_length("html").alias("size"))
    digests = written(digests.filter(F.col("size") >= least), "page-digests")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
    best = digests.groupBy("sha", "size").agg(first.alias("best"), F.count("*").alias("pages"))
    best = written(best.filter("pages > 1"), "page-groups")
    again = joined_with_groups(digests.drop("page_id"), best, ["sha", "size"], "pages", digests.count()).filter(F.col("best.row") != F.col("row"))
    told = rows.join(again.select("row", F.lit(True).alias("again"), F.col("best.page_id").alias("refers_to")), "row", "left")
    kind = F.when(F.col("again"), "revisit").otherwise("response")
    told.select("page_id", "row", "url", kind.alias("record_type"), "refers_to", F.col("html").cast("binary").alias("payload")).write.format("warc").mode("append").save(path)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the pages and reads the archives back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Payloads of responses are read and held against the digests and lengths in their headers;
    of revisits only the headers are read.
    """
    spark = pages.sparkSession
    register(spark)
    path = scratch_path(spark, "warc")
    write_pages(pages, path, least)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"
    reader = spark.read.format("warc").option("verify", "true")
    responses = reader.schema(f"{kinds}, payload binary").load(path).filter("record_type = 'response'")
    responses = responses.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).select(*columns)
    revisits = reader.schema(kinds).load(path).filter("record_type = 'revisit'").select(*columns)
    return responses.unionByName(revisits)
