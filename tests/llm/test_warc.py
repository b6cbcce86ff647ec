"""WARC archives: the query against its SQL, plain parsing of the files, chunks, odd rows, lost writes."""

import glob
import gzip
import hashlib
import io
import json

import duckdb
import pytest
from pyspark.sql import types as T

from tidewatch.llm import warc
from tidewatch.llm.queries import QUERIES, SQL

from .helpers import FOLDER, as_set

LONG = "é" * 70_000
PAGES = [
    (5, "http://a/1", LONG), (3, "http://a/2", LONG), (9, None, LONG), (3, "http://a/2", LONG),
    (1, "http://a/3", "short"), (2, "http://a/4", "short"), (4, "u", None), (6, "u", ""), (7, "a b\r\nWARC-Type: x", "z" * 100),
    (8, "ü", "z" * 100), (10, "u", "z" * 99), (11, "u", "z" * 99), (None, None, "n" * 200), (None, "x", "n" * 200),
    (None, "x", "z" * 100), (12, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 20),
    (13, "u", "a\x00b" * 50), (-4, "u", "🙂" * 30), (-4, "u", "🙂" * 30), (14, "u", "🙂" * 30),
]
SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
    *[T.StructField(n, T.StringType()) for n in
      ("payload", "digest", "of", "n", "first_id", "chunk", "last", "data", "record_id", "of_chunk")]])


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, *["clash"] * 10) for r in rows], SCHEMA).repartition(3)


def expected(rows):
    first: dict = {}
    for i, _, html in rows:
        if i is not None:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = first.get(html) if len(body) >= 100 else None
        again = to is not None and to != i
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                    to if again else None))
    return sorted(out, key=repr)


def plain_records(folder):
    """(head, block) of all records of the committed archives."""
    out = []
    for name in json.load(open(f"{folder}/{warc.MANIFEST}")):
        data = gzip.open(f"{folder}/{name}").read()
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            version, *lines = data[at:end].decode().split("\r\n")
            assert version == "WARC/1.1"
            head = dict(x.split(": ", 1) for x in lines)
            at = end + 4
            out.append((head, data[at:at + int(head["Content-Length"])]))
            at += int(head["Content-Length"])
            assert data[at:at + 4] == b"\r\n\r\n"
            at += 4
    return out


def test_query_is_its_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    got = QUERIES["op13_warc"](spark, FOLDER)
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL['op13_warc']}) q").fetchall()
    assert as_set(got) == sorted(want, key=repr) and len(want) == 50


@pytest.mark.parametrize("chunk_bytes, archive_bytes", [(1 << 20, 64 << 20), (1000, 300), (7, 1), (140_000, 1 << 20)])
def test_odd_rows(spark, tmp_path, chunk_bytes, archive_bytes):
    got = warc.archived(pages(spark), folder=str(tmp_path / "a"), chunk_bytes=chunk_bytes, archive_bytes=archive_bytes)
    assert as_set(got) == expected(PAGES)


def test_no_rows(spark):
    assert warc.archived(pages(spark, [])).collect() == []


def test_other_id_types(spark):
    df = spark.createDataFrame([("x y/ü", "u", "p" * 120), ("b", "u", "p" * 120), (None, "u", "p" * 120)],
                               "page_id string, url string, html string")
    assert as_set(warc.archived(df).select("page_id", "record_type", "refers_to")) == [
        ("b", "response", None), ("x y/ü", "revisit", "b"), (None, "revisit", "b")]


def test_archives_are_warc_files(spark, tmp_path):
    folder = str(tmp_path / "a")
    warc.write_archives(warc.records(pages(spark)), folder, chunk_bytes=1000, archive_bytes=2000)
    found = plain_records(folder)
    assert len(glob.glob(f"{folder}/*.warc.gz")) == sum(h["WARC-Type"] == "warcinfo" for h, _ in found) > 3
    found = [(h, b.split(b"\r\n\r\n", 1)) for h, b in found if h["WARC-Type"] != "warcinfo"]
    assert len(found) == len(PAGES)
    for head, (http, payload) in found:
        assert http.startswith(b"HTTP/1.1 200 OK\r\n") and head["WARC-Target-URI"] and head["WARC-Date"]
        if head["WARC-Type"] == "response":
            assert head["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
            assert "WARC-Refers-To" not in head
        else:
            assert payload == b"" and head["WARC-Refers-To"] and head["WARC-Profile"] == warc.REVISIT_PROFILE
    texts = sorted(p for h, (_, p) in found if h["WARC-Type"] == "response")
    assert texts == sorted((h or "").encode() for (_, _, h), (i, *_, kind, to) in
                           zip(sorted(PAGES, key=lambda r: repr(expected([r])[0][:3])), expected(PAGES)) if kind == "response")
    assert {h["WARC-Target-URI"] for h, _ in found} >= {"a%20b%20%20WARC-Type:%20x", "urn:page:9", "ü"}


def test_chunks_carry_lengths_and_digests(spark, tmp_path):
    folder = str(tmp_path / "a")
    warc.write_archives(warc.records(pages(spark)), folder, chunk_bytes=999)
    rows = warc.read_archives(spark, folder, chunk_bytes=1000).filter("record_id = 'urn:page:12'").orderBy("chunk").collect()
    whole = PAGES[15][2].encode()
    assert [r.chunk for r in rows] == list(range(len(rows))) and [r.last for r in rows] == [False] * (len(rows) - 1) + [True]
    for r in rows:
        assert len(r.data) <= 1000
        assert r.bytes_so_far == min(1000 * (r.chunk + 1), len(whole))
        assert r.digest_so_far == hashlib.sha256(whole[:r.bytes_so_far]).hexdigest()
    assert b"".join(r.data for r in rows) == whole


def test_payloads_of_revisits(spark, tmp_path):
    rows = [(i, "u", LONG if i % 3 else "t" * 150) for i in range(12)]
    folder = str(tmp_path / "a")
    warc.write_archives(warc.records(pages(spark, rows)), folder)
    found: dict = {}
    for r in warc.payload_chunks(warc.read_archives(spark, folder, chunk_bytes=30_000)).collect():
        found.setdefault(r.record_id, {})[r.chunk] = bytes(r.data)
    assert {k: b"".join(v[i] for i in range(len(v))).decode() for k, v in found.items()} == {
        f"urn:page:{i}": t for i, _, t in rows}


def test_uncommitted_and_older_files_do_not_count(spark, tmp_path):
    folder = str(tmp_path / "a")
    warc.write_archives(warc.records(pages(spark)), folder)
    with gzip.open(f"{folder}/left-behind.warc.gz", "wb") as out:
        out.write(b"not an archive")
    assert warc.read_archives(spark, folder).filter("last").count() > len(PAGES)
    warc.write_archives(warc.records(pages(spark, PAGES[:1])), folder)
    assert [r.record_id for r in warc.read_archives(spark, folder).filter("last AND record_type <> 'warcinfo'").collect()] == ["urn:page:5"]


def test_archives_from_elsewhere(spark, tmp_path):
    def record(kind, extra, block):
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{kind}>\r\n{extra}"
                f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.0 404 Not Found\r\nX: y\r\n\r\nbody"
    whole = (record("warcinfo", "Content-Type: application/warc-fields\r\n", b"a: b\r\n")
             + record("request", "Content-Type: application/http;msgtype=request\r\n", b"HTTP/1.0 x\r\n\r\n")
             + record("response", "Content-Type: application/http; msgtype=response\r\n", http)
             + record("resource", "Content-Type: text/plain\r\n", b"") + record("metadata", "", b"x" * 10))
    (tmp_path / "plain.warc").write_bytes(whole)
    got = {r.record_id: bytes(r.data) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == {"urn:x:warcinfo": b"a: b\r\n", "urn:x:request": b"", "urn:x:response": b"body", "urn:x:resource": b"",
                   "urn:x:metadata": b"x" * 10}


def test_broken_archives_are_errors():
    head = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 50\r\n\r\n"
    for data in (b"x\r\n", head + b"short", b"WARC/1.1\r\nno header\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.chunk_rows(io.BytesIO(data), 10, True))


def test_writer_wants_whole_records(tmp_path):
    import pyarrow as pa

    def write(*chunks):
        rows = [dict(record_id="r", record_type="response", target_uri="u", refers_to=None, date="d", chunk=c, last=last,
                     data=data, payload_bytes=4, payload_digest=hashlib.sha256(b"abcd").hexdigest()) for c, last, data in chunks]
        return warc.WarcWriter(str(tmp_path), 100, True).write(iter([pa.RecordBatch.from_pylist(rows)] if rows else []))

    assert len(write((0, False, b"ab"), (1, True, b"cd")).files) == 1
    assert write().files == []
    for bad in ([(0, True, b"ab")], [(1, True, b"abcd")], [(0, False, b"abcd")], [(0, True, b"abce")],
                [(0, False, b"ab"), (0, True, b"abcd")]):
        with pytest.raises(ValueError):
            write(*bad)
