"""WARC archives as a Spark data source, written and read in Python.

Every record is a gzip member of its own whose header says how long the member is (the subfield "sl" of the
gzip extra field). The reader plans one partition per file, reads the beginning of each record, parses the
WARC and HTTP headers, tests the predicates that Spark pushed down (equality and IN on the record type and
the other header columns), and inflates a payload only if the record passes and the schema asks for the
column; otherwise it goes straight to the next member. Archives without "sl", and plain ones, are read too.

Writers name their files at random; the commit lists the files of the tasks that count in a manifest, so
repeated and lost tasks leave nothing that is read.
"""

from __future__ import annotations

import re
import struct
import time
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from .scratch import Scratch

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_length long, payload binary"
)
MIN_REVISIT_BYTES = 1000
#: Each commit leaves a file of this name and its time, which names the commit's files; the first line says whether
#: they come beside those of earlier commits or in their place.
MANIFEST, BESIDE, INSTEAD = "_MANIFEST", "append", "overwrite"
FILE_BYTES = 256 << 20
_HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_OWN_FILE = re.compile(r"[0-9a-f]{32}\.warc\.gz")
_CHUNK = 1 << 16
_BATCH_BYTES = 8 << 20
_BATCH_RECORDS = 4096


# --- one record ---


def _line(name: str, value) -> str:
    clean = str(value).replace("%", "%25") if any(c in str(value) for c in "\r\n") else str(value)
    return f"{name}: " + clean.replace("\r", "%0D").replace("\n", "%0A") + "\r\n"


def record_bytes(row: dict) -> bytes:
    """A response or revisit record: WARC header, HTTP header and, for a response, the payload."""
    payload = row["payload"] if row["record_type"] == "response" else None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_length']}\r\n\r\n"
    ).encode()
    head = "WARC/1.1\r\n" + _line("WARC-Type", row["record_type"]) + _line("WARC-Record-ID", row["record_id"])
    head += _line("WARC-Date", row.get("date") or _DATE)
    if row["target_uri"] is not None:
        head += _line("WARC-Target-URI", row["target_uri"])
    head += _line("WARC-Payload-Digest", row["payload_digest"])
    if row["record_type"] == "revisit":
        head += _line("WARC-Profile", _PROFILE) + _line("WARC-Refers-To", row["refers_to"])
    head += "Content-Type: application/http; msgtype=response\r\n"
    head += f"Content-Length: {len(http) + len(payload or b'')}\r\n\r\n"
    return head.encode("utf-8", "surrogatepass") + http + (payload or b"") + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """A gzip member with its own length in the extra field (0: too long to say)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    lengths = (size, len(data)) if size < 1 << 32 and len(data) < 1 << 32 else (0, 0)
    extra = b"sl" + struct.pack("<HII", 8, *lengths)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = (line.partition(":") for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in fields}


class _Record:
    """One record of an open file: the header at once, the block only if asked for."""

    def __init__(self, file, at: int):
        self.file, self.at, self.plain, self.buffer = file, at, False, b""
        self.inflate, self.skip = None, 0
        file.seek(at)
        start = file.read(12)
        self.there = len(start) >= 12
        if not self.there:
            return
        if start[:2] == b"\x1f\x8b":
            self._gzip_head(start)
        else:
            self.plain = True
            file.seek(at)
        head = self._until(b"\r\n\r\n")
        self.warc = _parse_head(head)
        self.length = int(self.warc.get("content-length", 0))
        self.block_at = len(head)

    def _gzip_head(self, start: bytes) -> None:
        flags, file = start[3], self.file
        self.inflate = zlib.decompressobj(-15)
        if not flags & 4:
            file.seek(self.at + 10)
        else:
            extra = file.read(struct.unpack("<H", start[10:12])[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.skip = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size :]
        for bit in (8, 16):  # a name and a comment, each ended by a zero byte
            if flags & bit:
                while file.read(1) not in (b"\0", b""):
                    pass
        if flags & 2:
            file.read(2)

    def _more(self) -> bool:
        """Appends to the buffer; false at the end of the record's member or of the file."""
        if self.plain:
            got = self.file.read(_CHUNK)
            self.buffer += got
            return bool(got)
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.file.read(_CHUNK)
        if not data:
            return False
        self.buffer += self.inflate.decompress(data, _CHUNK)
        return True

    def _until(self, mark: bytes) -> bytes:
        while mark not in self.buffer and self._more():
            pass
        return self.buffer[: self.buffer.find(mark) + len(mark)] if mark in self.buffer else self.buffer

    def _fill(self, size: int) -> None:
        parts, have = [self.buffer], len(self.buffer)
        while have < size:
            self.buffer = b""
            if not self._more():
                break
            parts.append(self.buffer)
            have += len(self.buffer)
        self.buffer = b"".join(parts)

    def http_head(self) -> bytes:
        """The HTTP header of the block, up to the payload; empty if the block isn't HTTP."""
        if not self.warc.get("content-type", "").startswith("application/http"):
            return b""
        while b"\r\n\r\n" not in self.buffer[self.block_at :] and len(self.buffer) < self.block_at + self.length:
            if not self._more():
                break
        block = self.buffer[self.block_at : self.block_at + self.length]
        end = block.find(b"\r\n\r\n")
        return block[: end + 4] if end >= 0 else block

    def payload(self, head: int) -> bytes:
        self._fill(self.block_at + self.length)
        return self.buffer[self.block_at + head : self.block_at + self.length]

    def next_at(self) -> int:
        if self.plain:
            return self.at + self.block_at + self.length + 4
        if self.skip:
            return self.at + self.skip
        while not self.inflate.eof:
            self.buffer = b""
            if not self._more():
                return self.file.size()
        return self.file.tell() - len(self.inflate.unused_data) + 8


# --- the data source ---


@dataclass
class WarcFile(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str):
        self.names, self.path = schema.names, path
        #: headers and the values that pass; None: any value, but it must be there
        self.wanted: list[tuple[str, frozenset | None]] = []
        self.arrow = pa.schema(
            [pa.field(f.name, {"payload": pa.binary(), "payload_length": pa.int64()}.get(f.name, pa.string())) for f in schema]
        )

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In, IsNotNull)) and len(f.attribute) == 1 else None
            if column in _HEADER_OF and isinstance(f, IsNotNull):
                self.wanted.append((_HEADER_OF[column], None))
            elif column in _HEADER_OF:
                values = f.value if isinstance(f, In) else [f.value]
                self.wanted.append((_HEADER_OF[column], frozenset(v for v in values if v is not None)))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        system, root = _filesystem(self.path)
        if system.get_file_info(root).is_file:
            return [WarcFile(self.path)]
        found = sorted(i.base_name for i in system.get_file_info(fs.FileSelector(root)))
        names = [n for n in found if n.endswith((".warc", ".warc.gz"))]
        if manifests := [n for n in found if n.startswith(MANIFEST)]:
            names = []
            for name in manifests:
                with system.open_input_file(f"{root}/{name}") as f:
                    first, *own = f.read().decode().split("\n")
                names = own if first == INSTEAD else names + own
        return [WarcFile(f"{self.path}/{n}") for n in names if n]

    def read(self, partition: WarcFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no files
            return
        system, path = _filesystem(partition.path)
        rows: dict[str, list] = {n: [] for n in self.names}
        size = count = at = 0
        with system.open_input_file(path) as file:
            while (record := _Record(file, at)).there:
                if self._passes(record.warc):
                    size += self._add(record, rows) + 200
                    count += 1
                at = record.next_at()
                if size >= _BATCH_BYTES or count >= _BATCH_RECORDS:
                    yield self._batch(rows)
                    rows, size, count = {n: [] for n in self.names}, 0, 0
        if count:
            yield self._batch(rows)

    def _passes(self, header: dict[str, str]) -> bool:
        return all(name in header if values is None else header.get(name) in values for name, values in self.wanted)

    def _add(self, record: _Record, rows: dict[str, list]) -> int:
        http = record.http_head() if {"payload", "payload_length"} & set(self.names) else b""
        payload = None
        if "payload" in rows and record.warc.get("warc-type") != "revisit":
            payload = record.payload(len(http))
        for name, values in rows.items():
            if name == "payload":
                values.append(payload)
            elif name == "payload_length":
                said = _parse_head(http).get("content-length")
                values.append(int(said) if said else record.length - len(http))
            else:
                values.append(record.warc.get(_HEADER_OF[name]))
        return len(payload or b"")

    def _batch(self, rows: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in self.arrow], schema=self.arrow)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _filesystem(self.path)
        system.create_dir(root, recursive=True)
        files, out = [], None
        for batch in iterator:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                if out is None:
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = system.open_output_stream(f"{root}/{files[-1]}", compression=None)
                out.write(gzip_member(record_bytes(row)))
                if out.tell() >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _filesystem(self.path)
        system.create_dir(root, recursive=True)
        names = sorted(n for m in messages if m for n in m.files)
        there = [i.base_name for i in system.get_file_info(fs.FileSelector(root))]
        if not self.overwrite and not any(n.startswith(MANIFEST) for n in there):
            # an archive from elsewhere stays part of it; files named like these are left over from failed jobs
            names += sorted(n for n in there if n.endswith((".warc", ".warc.gz")) and not _OWN_FILE.fullmatch(n))
        # of times that are equal the random part decides; what was there before always sorts first
        name = f"{MANIFEST}-{time.time_ns():020d}-{uuid.uuid4().hex}"
        with system.open_output_stream(f"{root}/{name}") as f:
            f.write("\n".join([INSTEAD if self.overwrite else BESIDE, *names]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _filesystem(self.path)
        for name in (n for m in messages if m for n in m.files):
            system.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options["path"].rstrip("/"))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"].rstrip("/"), overwrite)


def read_warc(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Records of an archive folder or file; columns that aren't named are not decoded."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    schema = ", ".join(c for c in SCHEMA.split(", ") if not columns or c.split(" ")[0] in columns)
    return spark.read.format("warc").schema(schema).load(path)


def write_warc(records: DataFrame, path: str, mode: str = "append") -> None:
    """Writes ``records`` (the columns of SCHEMA but for date) as an archive folder, one file or more per task.

    ``mode``: append, or overwrite, after which the folder holds these records only; the files of earlier commits
    stay, unread, so that a reader that has begun keeps them. A job that fails leaves the archive as it was.
    """
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format("warc").mode(mode).save(path)


# --- pages ---


def page_records(pages: DataFrame, scratch: Scratch, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Records of ``pages`` (page_id, url, html; others are ignored), payload the html in UTF-8.

    Null html counts as empty. Of equal payloads of at least ``min_bytes`` the largest page_id is a response
    and the others revisit it. Rows that repeat that page are responses like it; a page without id never is
    revisited unless it is one of several without id, which are all responses.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "payload_length": F.octet_length("payload").cast("long")})
    long = rows.where(F.col("payload_length") >= min_bytes).groupBy("digest", "payload_length")
    shared = long.agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    shared = scratch.table(shared, "shared-payloads")
    joined = rows.join(shared, ["digest", "payload_length"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    named = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.uuid()), F.lit(">"))
    return joined.select(
        named(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(revisit, named(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def page_id_of(record_id) -> F.Column:
    return F.regexp_extract(record_id, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes ``pages`` to an archive, reads it back and returns one row per page: page_id, payload_bytes,
    payload_digest, record_type, refers_to.

    Length and digest of a response are those of the payload as read; those of a revisit, which has none, come
    from its headers. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    path = scratch.path("archive")
    write_warc(page_records(pages, scratch, min_bytes), path)
    kind = F.col("record_type")
    responses = read_warc(spark, path, ["record_id", "record_type", "payload"]).where(kind == "response")
    headers = ["record_id", "record_type", "refers_to", "payload_digest", "payload_length"]
    revisits = read_warc(spark, path, headers).where(kind == "revisit")
    whole = responses.select(
        page_id_of(F.col("record_id")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    return whole.unionAll(
        revisits.select(
            page_id_of(F.col("record_id")).alias("page_id"),
            F.col("payload_length").alias("payload_bytes"),
            F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
            "record_type",
            page_id_of(F.col("refers_to")).alias("refers_to"),
        )
    )
