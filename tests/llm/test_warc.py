import base64
import gzip
import hashlib
import io
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scratch import scratch_path
from tidemark.llm import warc

PAGES = "page_id bigint, url string, html string, row string, sha string, size string"
ROWS = [
    (5, "http://a/1", "<p>same</p>", "x", "x", "x"), (3, "http://a/2", "<p>same</p>", "x", "x", "x"), (9, None, None, None, None, None), (8, "http://b", "", "x", "x", "x"),
    (1, "http://c\r\nX-Evil: 1 100%", "ünïcödé 🎉 " * 40_000, "x", "x", "x"), (None, "http://d", "<p>same</p>", "x", "x", "x"), (3, "http://a/2", "<p>same</p>", "x", "x", "x"),
    (7, "http://e", "one", "x", "x", "x"), (None, "http://f", "two\r\n\r\nWARC/1.1\r\n\r\n", "x", "x", "x"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    groups = {}
    for k, (i, _, h, *_) in enumerate(rows):
        groups.setdefault(h or "", []).append((i is None, i, k))
    out = []
    for html, members in groups.items():
        size = len(html.encode())
        best = min(members, key=lambda m: (m[0], m[1] or 0, m[2]))
        for m in members:
            again = size >= least and m != best
            out.append((m[1], size, digest(html), "revisit" if again else "response", best[1] if again else None))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = warc.round_trip(spark.createDataFrame(ROWS, PAGES).coalesce(1), least)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=repr) == expected(ROWS, least)


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = warc.round_trip(pages)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=repr) == expected([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


@pytest.fixture(scope="module")
def archive(spark):
    warc.register(spark)
    path = scratch_path(spark, "warc-test")
    warc.write_pages(spark.createDataFrame(ROWS, PAGES), path)
    return path


def test_payloads_and_headers_come_back_whole(spark, archive):
    rows = spark.read.format("warc").option("verify", "true").load(archive).collect()
    texts = {(r.page_id, r.url): r.payload for r in rows if r.record_type == "response"}
    assert bytes(texts[(1, "http://c\r\nX-Evil: 1 100%")]).decode() == "ünïcödé 🎉 " * 40_000
    assert bytes(texts[(None, "http://f")]) == b"two\r\n\r\nWARC/1.1\r\n\r\n"
    assert all(r.payload is None for r in rows if r.record_type == "revisit") and len(rows) == len(ROWS)


def test_filters_reach_the_reader_and_payloads_are_skipped(spark, archive, monkeypatch):
    from pyspark.sql.datasource import EqualTo, IsNotNull, StringContains

    reader = warc.WarcReader(archive, spark.read.format("warc").load(archive).drop("payload").schema, False)
    odd = StringContains(("url",), "a")
    assert list(reader.pushFilters([IsNotNull(("record_type",)), EqualTo(("record_type",), "revisit"), odd])) == [odd]
    monkeypatch.setattr(warc.zlib, "decompress", None)  # nothing may decompress a whole record
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in batches) == 4  # three pages repeat <p>same</p>, one repeats the empty page
    plan = spark.read.format("warc").load(archive).filter(F.col("record_type") == "revisit")._jdf.queryExecution().toString()
    assert "Filter (" not in plan.split("Physical Plan")[1]


def test_files_of_lost_attempts_are_not_read(spark, archive):
    from pyarrow import fs

    before = spark.read.format("warc").load(archive).count()
    system, root = fs.FileSystem.from_uri(archive)
    with system.open_output_stream(f"{root}/part-lost.warc.gz", compression=None) as out:
        out.write(warc.record("u", 1, 1, "response", b"x", None)[:20])
    assert spark.read.format("warc").load(archive).count() == before


def test_archives_of_other_origin(spark, tmp_path):
    parts = [gzip.decompress(warc.record(f"http://x/{k}", k, k, "response", b"body %d" % k * 3000, None)) for k in range(4)]
    (tmp_path / "plain.warc").write_bytes(b"".join(parts))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    rows = spark.read.format("warc").option("verify", "true").load(str(tmp_path)).collect()
    assert sorted(r.page_id for r in rows) == [0, 0, 1, 1, 2, 2, 3, 3]
    assert all(bytes(r.payload) == b"body %d" % r.page_id * 3000 for r in rows)


def test_files_are_bounded(spark):
    warc.register(spark)
    path = scratch_path(spark, "warc-small")
    rows = [(k, k, "u", "response", None, b"x%d" % k) for k in range(20)]
    frame = spark.createDataFrame(rows, "page_id bigint, row bigint, url string, record_type string, refers_to bigint, payload binary").coalesce(1)
    frame.write.format("warc").option("file_bytes", 1000).mode("append").save(path)
    assert len(warc.WarcReader(path, None, False).partitions()) > 3
    assert spark.read.format("warc").load(path).count() == 20


@pytest.mark.parametrize("n", [5_000, 100_000])
def test_headers_longer_than_the_first_look(spark, tmp_path, n):
    url = "http://long/" + "ab" * (n // 2)
    rows = [(1, url, "<p>tiny</p>", "x", "x", "x"), (2, url + "2", "<p>tiny</p>", "x", "x", "x"), (3, "http://next", "other", "x", "x", "x")]
    frame = spark.createDataFrame(rows, PAGES).coalesce(1)
    got = warc.round_trip(frame)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=repr) == expected(rows)
    warc.register(spark)
    path = scratch_path(spark, "warc-long")
    warc.write_pages(frame, path)
    read = {r.page_id: (r.url, r.payload) for r in spark.read.format("warc").load(path).collect()}
    assert read == {1: (url, b"<p>tiny</p>"), 2: (url + "2", None), 3: ("http://next", b"other")}
    # Message headers of that length, in a record without compression.
    http = b"HTTP/1.1 200 OK\r\nX-Long: " + b"c" * n + b"\r\nContent-Length: 4\r\n\r\nbody"
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(http)
    (tmp_path / "a.warc").write_bytes(head + http + b"\r\n\r\n")
    assert [(r.payload_bytes, r.payload) for r in spark.read.format("warc").load(str(tmp_path)).collect()] == [(4, b"body")]


def test_a_member_without_the_end_of_its_headers_fails():
    import pyarrow as pa

    squeezed = zlib.compressobj(1, zlib.DEFLATED, -15)
    data = b"WARC/1.1\r\nWARC-Type: response\r\n"
    packed = squeezed.compress(data) + squeezed.flush()
    extra = struct.pack("<H2sHII", 12, b"SL", 8, 24 + len(packed) + 8, len(data))
    member = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x04\xff" + extra + packed + struct.pack("<II", zlib.crc32(data), len(data))
    with pytest.raises(ValueError, match="headers"):
        list(warc.records(pa.PythonFile(io.BytesIO(member), "r"), lambda row: True, False))
