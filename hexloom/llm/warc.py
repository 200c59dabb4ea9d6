"""WARC archives: writing with revisit records, and a Spark data source that reads them.

Writing: equal payloads of a least size are stored once. A native aggregation of digests
finds the record that keeps the payload; the others are revisits that
refer to it. No payload travels by its digest: where digests that several records have are few, they are
broadcast; else the revisits, without payloads, are found first and joined to the rows by key and digest. Each task writes one archive under a name of its own attempt and
then renames it, so that a repeated task leaves one whole file.

Every record is a gzip member that says its own length in an extra field, as the
skip-length extension of the format does, so that a reader can step over it.

Reading: ``spark.read.format("warc")`` plans partitions of whole files, takes
filters on the record type and the header columns, parses a record's headers
from its first bytes and inflates the rest only if the record passes the filters
and the wanted columns need it. Ask for fewer columns with ``schema(...)``: without
the column payload no payload is decoded.
"""

from __future__ import annotations

import base64
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith
from pyspark.sql.types import StructType

from .common import small_batches, written

#: Payloads below so many bytes are always stored.
LEAST_SHARED = 1000
#: Bytes of the table of shared digests up to which it is broadcast, and bytes that a digest takes there.
BROADCAST_BYTES, DIGEST_BYTES = 32 << 20, 160
#: The date of records of pages that have none.
NO_DATE = "1970-01-01T00:00:00Z"
#: Bytes that a reader takes at first, which hold the headers of most records, and bytes of files in a partition.
HEAD, PARTITION_BYTES = 2048, 64 << 20
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROW_ID = "urn:x-row:"
COLUMNS = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
    "content_length bigint, payload_length bigint, payload binary, file string, offset bigint"
)
_HEADER_OF = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to"}


def filesystem(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))


def member(data: bytes, level: int = 6) -> bytes:
    """One gzip member with its own length and that of its content in an ``SL`` extra field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0\0\0\0" + b"\0\xff" + struct.pack("<H", 12) + b"SL" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(row_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, length: int) -> bytes:
    """The bytes of a response or revisit record, not compressed. ``digest``: hexadecimal SHA-1 of the full payload."""
    name = f"{ROW_ID}{row_id}" if row_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {digest}')}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {NO_DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{ROW_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(), "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def planned_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_SHARED) -> DataFrame:
    """The record of every page: id, url, html, digest, length, kind and refers_to."""
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), body.alias("html"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("length"))
    shared = (F.col("length") >= least) & F.col("id").isNotNull()
    known = rows.select("id", "digest", "length")
    kept = written(known.where(shared).groupBy("digest").agg(F.max("id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-digests")
    if kept.count() * DIGEST_BYTES <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(kept), "digest", "left")
    else:
        again = written(known.where(shared).join(kept, "digest").where("id != keeper").select("id", "digest", "keeper").distinct(), "warc-revisits")
        rows = rows.join(again, ["id", "digest"], "left")
    revisit = F.col("keeper").isNotNull() & shared & (F.col("id") != F.col("keeper"))
    return rows.select(
        "id", "url", F.when(revisit, F.lit(b"")).otherwise(F.col("html")).alias("html"), "digest", "length",
        F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("keeper")).alias("refers_to"),
    )


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_SHARED) -> int:
    """Write one record for each row of ``pages`` to gzipped archives in ``path``; returns the number of records.

    Of rows with equal payloads of at least ``least`` bytes, the one with the
    largest key is a response and the others revisit it; rows equal in key and
    payload to that one are responses too. All other rows, and rows with a null key,
    are responses. A null html is an empty payload; a null url leaves out the header.
    Blanks and control characters in a url are percent-encoded.
    An empty table writes archives without records.
    """
    small_batches(pages.sparkSession)
    fs, base = filesystem(path)
    fs.create_dir(base, recursive=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = filesystem(path)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}.warc.gz"
        fs.create_dir(base, recursive=True)
        draft, n = posixpath.join(base, f".{name}.{task.taskAttemptId()}"), 0
        with fs.open_output_stream(draft, compression=None) as out:
            for batch in batches:
                for r in batch.itertuples(index=False):
                    row_id, refers_to = (None if pd.isna(x) else int(x) for x in (r.id, r.refers_to))
                    out.write(member(record(row_id, None if pd.isna(r.url) else r.url, r.html, r.digest, r.kind, refers_to, int(r.length))))
                    n += 1
        fs.move(draft, posixpath.join(base, name))
        yield pd.DataFrame({"file": [name], "records": [n]})

    rows = planned_records(pages, key, url, html, least)
    ids = ["id", "refers_to"]  # as text: a null among them must not turn the rest into floats
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ids})
    return rows.mapInPandas(run, "file string, records bigint").agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


class Files(InputPartition):
    """The archives of one partition."""

    def __init__(self, files: list[str]):
        super().__init__(files)
        self.files = files


class WarcReader(DataSourceReader):
    """Reads the archives of a folder, or one archive, under the filters that it could take."""

    #: Filters that records can be tested for by their headers.
    TESTS = {
        EqualTo: lambda v, f: v is not None and v == f.value,
        EqualNullSafe: lambda v, f: v == f.value,
        In: lambda v, f: v is not None and v in f.value,
        IsNotNull: lambda v, f: v is not None,
        StringStartsWith: lambda v, f: v is not None and v.startswith(f.value),
        GreaterThan: lambda v, f: v is not None and v > f.value,
        GreaterThanOrEqual: lambda v, f: v is not None and v >= f.value,
        LessThan: lambda v, f: v is not None and v < f.value,
        LessThanOrEqual: lambda v, f: v is not None and v <= f.value,
    }
    TESTED = {*_HEADER_OF, "payload_digest", "content_length"}

    def __init__(self, schema: StructType, options):
        self.names = [f.name for f in schema.fields]
        self.path = options["path"]
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.filters: list = []

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in self.TESTS and len(f.attribute) == 1 and f.attribute[0] in self.TESTED:
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        from pyarrow.fs import FileSelector, FileType

        fs, base = filesystem(self.path)
        found = fs.get_file_info(base)
        files = [found] if found.type == FileType.File else fs.get_file_info(FileSelector(base, recursive=True))
        bins: list[list[str]] = []
        room = 0
        for x in sorted((x for x in files if x.type == FileType.File and x.base_name.endswith((".warc.gz", ".warc")) and x.base_name[0] not in "._"), key=lambda x: x.path):
            if not bins or room < x.size:
                bins.append([])
                room = self.partition_bytes
            bins[-1].append(x.path)
            room -= x.size
        return [Files(b) for b in bins] or [Files([])]

    def read(self, partition: Files):
        fs, _ = filesystem(self.path)
        for path in partition.files:
            with fs.open_input_file(path) as source:
                yield from self._records(source, path)

    def _records(self, source, path: str):
        size, at = source.size(), 0
        while at < size:
            entry = Entry(source, at, size, path.endswith(".gz"))
            values = entry.values()
            wanted = all(self.TESTS[type(f)](values.get(f.attribute[0]), f) for f in self.filters)
            if wanted:
                values |= {"file": path, "offset": at}
                if "payload" in self.names:
                    values["payload"] = entry.payload()
                yield tuple(values.get(n) for n in self.names)
            at = entry.end()


class Entry:
    """A record at a place in an archive: headers at once, the rest on demand."""

    def __init__(self, source, at: int, size: int, zipped: bool):
        self.source, self.at, self.size, self.zipped = source, at, size, zipped
        self.next = at  # where to take the next bytes from
        self.length = None  # of the whole member, if it says so
        self.inflate = zlib.decompressobj(31) if zipped else None
        self.data = b""
        while (cut := self.data.find(b"\r\n\r\n")) < 0 and self._more():
            pass
        if cut < 0:
            raise ValueError(f"no WARC record at byte {at}")
        self.body = cut + 4
        lines = self.data[:cut].decode("utf-8", "replace").split("\r\n")
        self.headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        self.content = int(self.headers.get("content-length", 0))

    def _more(self) -> bool:
        if self.next >= self.size or (self.inflate and self.inflate.eof):
            return False
        self.source.seek(self.next)
        got = self.source.read(HEAD if self.next == self.at else 1 << 16)
        if self.next == self.at and self.zipped and got[3] & 4 and got[12:14] == b"SL":
            self.length = struct.unpack_from("<I", got, 16)[0]
        self.next += len(got)
        self.data += self.inflate.decompress(got) if self.inflate else got
        return bool(got)

    def _upto(self, n: int) -> bytes:
        parts, have = [self.data], len(self.data)
        self.data = b""
        while have < n and self._more():
            parts.append(self.data)
            have += len(self.data)
            self.data = b""
        self.data = b"".join(parts)
        return self.data[:n]

    def _http(self) -> tuple[int, dict[str, str]]:
        """Where the block's HTTP headers end, and what they say."""
        if "application/http" not in self.headers.get("content-type", ""):
            return self.body, {}
        limit = self.body + self.content
        while (cut := self.data.find(b"\r\n\r\n", self.body, limit)) < 0 and len(self.data) < limit and self._more():
            pass
        if cut < 0:
            return limit, {}
        lines = self.data[self.body : cut].decode("latin-1").split("\r\n")
        return cut + 4, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}

    def values(self) -> dict:
        digest = self.headers.get("warc-payload-digest", "")
        method, _, code = digest.partition(":")
        if method == "sha1" and len(code) == 32:
            digest = base64.b32decode(code).hex()
        elif method == "sha1":
            digest = code.lower()
        strip = lambda v: v[1:-1] if v and v[0] == "<" else v
        length = self._http()[1].get("content-length")
        return {c: strip(self.headers.get(h)) for c, h in _HEADER_OF.items()} | {
            "payload_digest": digest or None, "content_length": self.content, "payload_length": int(length) if length else None,
        }

    def payload(self) -> bytes:
        start, end = self._http()[0], self.body + self.content
        return self._upto(end)[start:]

    def end(self) -> int:
        if self.length:
            return self.at + self.length
        if not self.zipped:
            return self.at + self.body + self.content + 4
        while not self.inflate.eof and self._more():
            self.data = b""
        return self.next - len(self.inflate.unused_data)


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``; option partitionBytes bounds the files put into one partition."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)


def read_warc(spark, path: str, columns: str = COLUMNS) -> DataFrame:
    """The records of the archives in ``path``; ``columns`` (DDL) chooses what is decoded."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").schema(columns).load(path)
