"""WARC archives as a Spark data source whose rows are chunks of records.

A payload is a run of rows (record id, chunk number, bytes) that lie together in order. The writer takes
such rows and the reader gives such rows, each with the digest and the length of the payload up to and
with that chunk, so no task holds more than a chunk of a record, however long the record is. Archives
are gzip files with one member per record, rolled over at a bounded size; a file is one task's
work when it is read. Files count only once the write is committed in the folder's manifest: what
lost or repeated tasks leave behind is never read.

The folder must be in a store that pyarrow opens from a URI (file, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    InputPartition, WriterCommitMessage)

from ..session import scratch_folder, written

FORMAT = "tidewatch_warc"
#: Payloads are handled in chunks of this many bytes.
CHUNK = 1 << 20
#: An archive is closed when it has this many compressed bytes.
ARCHIVE_BYTES = 64 << 20
#: Shorter payloads are never revisits.
LEAST_REVISIT = 100
LEVEL = 6
#: A line of a record's head that is longer than this is no head.
MOST_LINE = 1 << 20
#: Rows and bytes that a reader hands on at a time.
ROWS_AT_ONCE, BYTES_AT_ONCE = 1000, 8 << 20
MANIFEST = "_archives.json"

#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http;msgtype=response"

#: Rows to write: length and digest are those of the full payload and are on each of its chunks.
WRITE_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, date string, "
                "chunk int, last boolean, data binary, payload_bytes bigint, payload_digest string")
#: Rows read: length and digest are those of the payload up to this chunk, of a revisit those of the payload it stands for.
READ_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, chunk bigint, last boolean, "
               "data binary, bytes_so_far bigint, digest_so_far string")


def _store(folder: str):
    """The file system and the path in it of a folder's URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _head(lines: dict[str, str | None]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in lines.items() if v is not None).encode() + b"\r\n"


class _Archive:
    """A file of records that is being written."""

    def __init__(self, store, path: str, date: str):
        self.out, self.size = store.open_output_stream(path, compression=None), 0
        info = b"software: tidewatch\r\nformat: WARC File Format 1.1\r\n"
        self.start({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date,
                    "Content-Type": "application/warc-fields", "Content-Length": str(len(info))})
        self.add(info)
        self.end()

    def start(self, head: dict[str, str | None]) -> None:
        self.member = zlib.compressobj(LEVEL, wbits=31)
        self.add(f"{VERSION}\r\n".encode() + _head(head))

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self.add(b"\r\n\r\n")
        self._put(self.member.flush())

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Chunk rows to archives. A record's chunks must come one after the other."""

    def __init__(self, folder: str, archive_bytes: int, overwrite: bool):
        self.folder, self.archive_bytes, self.overwrite = folder, archive_bytes, overwrite

    def write(self, iterator):
        store, root = _store(self.folder)
        store.create_dir(root, recursive=True)
        files, archive = [], None
        digest, left, expected = None, 0, None
        for batch in iterator:
            names = batch.schema.names
            for values in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                row = dict(zip(names, values))
                if row["chunk"] == 0:
                    if digest is not None:
                        raise ValueError(f"the chunks before those of {row['record_id']} have no last one")
                    if archive is None or archive.size >= self.archive_bytes:
                        if archive is not None:
                            archive.out.close()
                        files.append(f"{uuid.uuid4().hex}.warc.gz")
                        archive = _Archive(store, f"{root}/{files[-1]}", row["date"])
                    self._begin(archive, row)
                    digest, expected = hashlib.sha256(), row["payload_digest"]
                    left = row["payload_bytes"] if row["record_type"] == "response" else 0
                elif digest is None:
                    raise ValueError(f"chunk {row['chunk']} of {row['record_id']} stands alone")
                data = row["data"] or b""
                archive.add(data)
                digest.update(data)
                left -= len(data)
                if row["last"]:
                    if row["record_type"] == "response" and (left or digest.hexdigest() != expected):
                        raise ValueError(f"the chunks of {row['record_id']} are not its payload")
                    archive.end()
                    digest = None
        if digest is not None:
            raise ValueError("the last record is not whole")
        if archive is not None:
            archive.out.close()
        return Written(files)

    @staticmethod
    def _begin(archive: _Archive, row: dict) -> None:
        http = b"HTTP/1.1 200 OK\r\n" + _head({"Content-Type": "text/html; charset=utf-8",
                                               "Content-Length": str(row["payload_bytes"])})
        response = row["record_type"] == "response"
        archive.start({
            "WARC-Type": row["record_type"], "WARC-Record-ID": f"<{row['record_id']}>", "WARC-Date": row["date"],
            "WARC-Target-URI": row["target_uri"], "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
            "WARC-Profile": None if response else REVISIT_PROFILE,
            "WARC-Refers-To": None if response else f"<{row['refers_to']}>", "Content-Type": RESPONSE_TYPE,
            "Content-Length": str(len(http) + (row["payload_bytes"] if response else 0))})
        archive.add(http)

    def commit(self, messages) -> None:
        store, root = _store(self.folder)
        store.create_dir(root, recursive=True)
        before = [] if self.overwrite else _manifest(store, root) or []
        with store.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(before + [f for m in messages if m for f in m.files]).encode())

    def abort(self, messages) -> None:
        store, root = _store(self.folder)
        for name in [f for m in messages if m for f in m.files]:
            store.delete_file(f"{root}/{name}")


def _manifest(store, root: str) -> list[str] | None:
    from pyarrow import fs

    if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(f"{root}/{MANIFEST}") as file:
        return json.loads(file.read())


def _fields(file, most: int) -> tuple[dict[str, str], int]:
    """The header fields up to the empty line, names in lower case, and how many bytes they took."""
    fields, size = {}, 0
    while size < most:
        line = file.readline(min(MOST_LINE, most - size))
        size += len(line)
        if line in (b"\r\n", b"\n"):
            break
        name, colon, value = line.partition(b":")
        if not line.endswith(b"\n") or not colon and not line.startswith(b"HTTP/"):
            raise ValueError(f"no header line: {line[:80]!r}")
        if colon:
            fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return fields, size


def chunk_rows(file, chunk_bytes: int, data: bool):
    """The rows of READ_SCHEMA of an archive's uncompressed bytes, in order."""
    while line := file.readline(MOST_LINE):
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:80]!r}")
        head, _ = _fields(file, 1 << 62)
        left = int(head["content-length"])
        kind, uri = head["warc-type"], head.get("warc-target-uri")
        record, refers = (head.get(n, "").removeprefix("<").removesuffix(">") or None
                          for n in ("warc-record-id", "warc-refers-to"))
        http = {}
        if head.get("content-type", "").startswith("application/http"):
            http, size = _fields(file, left)
            left -= size
        if kind == "revisit":
            digest = head.get("warc-payload-digest", "").removeprefix("sha256:")
            length = http.get("content-length")
            yield record, kind, uri, refers, 0, True, b"", int(length) if length else None, digest or None
            while left:  # an archive made elsewhere may repeat a part of the payload
                left -= len(file.read(min(left, chunk_bytes)))
            continue
        digest, so_far, chunk = hashlib.sha256(), 0, 0
        while True:
            held = file.read(min(left, chunk_bytes))
            if left and not held:
                raise ValueError(f"the archive ends within {record}")
            left -= len(held)
            so_far += len(held)
            digest.update(held)
            yield (record, kind, uri, refers, chunk, not left, held if data else None, so_far,
                   digest.hexdigest())
            chunk += 1
            if not left:
                break


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, chunk_bytes: int, data: bool):
        self.folder, self.chunk_bytes, self.data = folder, chunk_bytes, data

    def partitions(self):
        from pyarrow import fs

        store, root = _store(self.folder)
        names = _manifest(store, root)
        if names is None:  # archives from elsewhere
            found = store.get_file_info(fs.FileSelector(root))
            names = sorted(f.base_name for f in found if f.base_name.endswith((".warc", ".warc.gz")))
        return [InputPartition(n) for n in names] or [InputPartition(None)]

    def read(self, partition):
        if partition.value is None:
            return
        import gzip
        import io

        kinds = [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                 ("refers_to", pa.string()), ("chunk", pa.int64()), ("last", pa.bool_()), ("data", pa.binary()),
                 ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string())]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)],
                                              names=[n for n, _ in kinds])

        store, root = _store(self.folder)
        with store.open_input_file(f"{root}/{partition.value}") as raw:
            file = gzip.GzipFile(fileobj=raw) if partition.value.endswith(".gz") else raw
            held, size = [], 0
            for row in chunk_rows(io.BufferedReader(file, 1 << 16), self.chunk_bytes, self.data):
                held.append(row)
                size += len(row[6] or b"")
                if len(held) >= ROWS_AT_ONCE or size >= BYTES_AT_ONCE:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)


class WarcSource(DataSource):
    """Options: path; archiveBytes (writing); chunkBytes and data (reading: "false" leaves the bytes out)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return READ_SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], int(self.options.get("chunkBytes", CHUNK)),
                          self.options.get("data", "true") != "false")

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], int(self.options.get("archiveBytes", ARCHIVE_BYTES)), overwrite)


def record_id(id_: Column) -> Column:
    """The record id of a page; a null id gives one without a number."""
    return F.concat(F.lit("urn:page:"), F.coalesce(F.url_encode(id_.cast("string")), F.lit("")))


def page_of(record: Column, kind) -> Column:
    """The page id in a record id; null for a page without one."""
    inner = F.regexp_extract(record, "^urn:page:(.+)$", 1)
    return F.when(inner != "", F.url_decode(inner).cast(kind))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            least: int = LEAST_REVISIT) -> DataFrame:
    """One row per row of ``pages``: record_id, record_type, target_uri, refers_to, payload, payload_bytes,
    payload_digest.

    The payload is the page in UTF-8; a null page is an empty payload. Of equal payloads of at least
    ``least`` bytes the row with the smallest id is the response (several rows with that id are all responses,
    as are rows without an id when no row of the group has one); the others revisit it.
    Other records are responses. A null url becomes the record id; blanks and control characters of an
    url become %20.
    """
    payload = F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary")
    url = F.coalesce(pages[url_col].cast("string"), record_id(pages[id_col]))
    url = F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20")
    rows = pages.select(pages[id_col].alias("page_id"), url.alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"),
                             "digest": F.unhex(F.sha2("payload", 256))})
    # Only digests and ids are grouped. The groups are stored: where they are small the join
    # broadcasts them by their real size and no payload is shuffled.
    groups = written(rows.filter(F.col("payload_bytes") >= least).groupBy("digest")
                     .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                     .filter("n > 1 AND first_id IS NOT NULL").select(F.col("digest").alias("of"), "first_id"))
    joined = rows.join(groups, F.col("digest") == F.col("of"), "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        record_id(F.col("page_id")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.when(again, record_id(F.col("first_id"))).alias("refers_to"), "payload", "payload_bytes",
        F.lower(F.hex("digest")).alias("payload_digest"))


def chunked(found: DataFrame, chunk_bytes: int = CHUNK, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The records as rows of WRITE_SCHEMA; a revisit is one row without bytes, as is an empty payload."""
    response = F.col("record_type") == "response"
    last = F.when(response, F.greatest(F.ceil(F.col("payload_bytes") / chunk_bytes), F.lit(1)) - 1).otherwise(0)
    rows = found.withColumn("of_chunk", last.cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("of_chunk"))).alias("chunk"))
    data = F.when(response, F.substring(F.col("payload"), F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes)))
    return rows.select(
        "record_id", "record_type", "target_uri", "refers_to", F.lit(date).alias("date"), "chunk",
        (F.col("chunk") == F.col("of_chunk")).alias("last"), data.alias("data"), "payload_bytes", "payload_digest")


def write_archives(found: DataFrame, folder: str, chunk_bytes: int = CHUNK,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the rows of ``records`` as archives into ``folder``, which holds no others afterwards."""
    spark = found.sparkSession
    spark.dataSource.register(WarcSource)
    (chunked(found, chunk_bytes).write.format(FORMAT).mode("overwrite")
     .option("archiveBytes", archive_bytes).save(folder))


def read_archives(spark: SparkSession, folder: str, chunk_bytes: int = CHUNK, data: bool = True) -> DataFrame:
    """The chunks of all records of all archives in ``folder`` (READ_SCHEMA)."""
    spark.dataSource.register(WarcSource)
    return (spark.read.format(FORMAT).option("chunkBytes", chunk_bytes)
            .option("data", str(data).lower()).load(folder))


def payload_chunks(chunks: DataFrame) -> DataFrame:
    """(record_id, chunk, last, data) of every response and, by the chunks of the response it refers to, of
    every revisit."""
    of = chunks.filter("record_type = 'response'").select(
        F.col("record_id").alias("response_id"), "chunk", "last", "data")
    whole = chunks.filter("record_type IN ('response', 'revisit') AND chunk = 0").select(
        "record_id", F.coalesce("refers_to", "record_id").alias("of")).distinct()
    return whole.join(of, F.col("of") == F.col("response_id")).select("record_id", "chunk", "last", "data")


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             folder: str | None = None, chunk_bytes: int = CHUNK, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """One row per row, from the archives that were written: page_id, payload_bytes, payload_digest,
    record_type, refers_to (the response's id for a revisit)."""
    spark = pages.sparkSession
    folder = folder or f"{scratch_folder(spark)}/tidewatch/{uuid.uuid4().hex}"
    write_archives(records(pages, id_col, url_col, html_col), folder, chunk_bytes, archive_bytes)
    kind = pages.schema[id_col].dataType
    chunks = read_archives(spark, folder, chunk_bytes, data=False)
    return chunks.filter("last AND record_type IN ('response', 'revisit')").select(
        page_of(F.col("record_id"), kind).alias("page_id"), F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"), "record_type",
        page_of(F.col("refers_to"), kind).alias("refers_to"))
