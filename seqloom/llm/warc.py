"""WARC archives: a writer that stores equal payloads once, and a reader that goes on after damaged places."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from seqloom.session import known_source, materialize

FORMAT = "seqloom_warc"
SCHEMA = (
    "path string, offset long, length long, kind string, reason string, record_type string, record_id string, "
    "target_uri string, page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary"
)
#: Bytes of archive that one file and one reading task take, about; a record is never cut.
FILE_BYTES = 64_000_000
#: Bytes read at a time, bytes handed to Spark at a time, longest header.
READ, BATCH, HEADER = 1 << 18, 4_000_000, 1 << 16
MEMBER, VERSION = b"\x1f\x8b\x08", re.compile(rb"WARC/1\.[01]\r\n")
MANIFEST = "_SUCCESS"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record: the whole response, or for a revisit its HTTP header alone."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:none")
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = record_id(refers_to, digest)
        head["Refers-To-Page-Id"] = str(refers_to)
    if page_id is not None:
        head["Page-Id"] = str(page_id)
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


class Damaged(Exception):
    """A record that fails a check; ``end`` is where it ends if its frame is whole."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


class Found(NamedTuple):
    kind: str
    offset: int
    end: int
    reason: str | None = None
    head: dict | None = None
    block: bytes = b""


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _frame(data: bytes) -> tuple[dict[str, str], int, int]:
    """Headers of the record that begins ``data``, where its block begins and where it ends with the closing line ends."""
    version = VERSION.match(data)
    if not version:
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", 0, HEADER)
    if stop < 0:
        raise Damaged("header without an end")
    head = _headers(data[version.end() : stop].split(b"\r\n"))
    length = head.get("content-length", "")
    if not re.fullmatch("[0-9]{1,15}", length):
        raise Damaged("no content length")
    return head, stop + 4, stop + 4 + int(length) + 4


def _payload(block: bytes) -> tuple[dict[str, str], bytes] | None:
    """HTTP headers and payload of a block, if it is an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    http = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        http[name.decode("latin-1").strip().lower()] = value.decode("latin-1").strip()
    return http, payload


def _verify(head: dict[str, str], block: bytes, end: int) -> None:
    def right(name: str, data: bytes) -> bool:
        kind, _, digest = head.get(name, "").partition(":")
        return kind.lower() != "sha1" or digest.upper() == base32_sha1(data)

    if not head.get("warc-type"):
        raise Damaged("no record type", end)
    if not right("warc-block-digest", block):
        raise Damaged("block digest differs", end)
    parts = _payload(block) if head["warc-type"] == "response" else None
    if parts and "transfer-encoding" not in parts[0] and not right("warc-payload-digest", parts[1]):
        raise Damaged("payload digest differs", end)


class Archive:
    """Random reads of a file whose end is known."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size = file, size

    def read(self, at: int, n: int) -> bytes:
        return self.file.read_at(max(0, min(n, self.size - at)), at)

    def member(self, at: int) -> Found:
        """The record in the gzip member at ``at``; every member holds one record."""
        inflate, out, where = zlib.decompressobj(31), [], at
        while not inflate.eof:
            data = self.read(where, READ)
            if not data:
                raise Damaged("member is cut off")
            try:
                out.append(inflate.decompress(data))
            except zlib.error as error:
                raise Damaged(f"gzip: {str(error).split(':')[-1].strip()}") from None
            if where == at and len(out[0]) >= 5 and not out[0].startswith(b"WARC/"):
                raise Damaged("member holds no record")
            where += len(data)
        end = where - len(inflate.unused_data)
        data = b"".join(out)
        try:
            head, start, stop = _frame(data)
        except Damaged as error:
            raise Damaged(str(error), end) from None
        if stop != len(data) or not data.endswith(b"\r\n\r\n"):
            raise Damaged("content length differs", end)
        block = data[start : stop - 4]
        _verify(head, block, end)
        return Found("record", at, end, None, head, block)

    def plain(self, at: int) -> Found:
        """The record that stands uncompressed at ``at``."""
        first = self.read(at, HEADER)
        head, start, stop = _frame(first)
        if at + stop > self.size:
            raise Damaged("record is cut off")
        data = first[:stop] if stop <= len(first) else first + self.read(at + len(first), stop - len(first))
        if not data.endswith(b"\r\n\r\n"):
            raise Damaged("content length differs")
        block, end = data[start : stop - 4], at + stop
        # a frame that the next record or the end of the file confirms is skipped as a whole
        follows = self.read(end, 10)
        _verify(head, block, end if not follows or VERSION.match(follows) else None)
        return Found("record", at, end, None, head, block)

    def next_mark(self, at: int, mark: bytes) -> int:
        """The first place at or after ``at`` where ``mark`` stands, or the end of the file."""
        while at < self.size:
            data = self.read(at, READ)
            if (i := data.find(mark)) >= 0:
                return at + i
            if len(data) < READ:
                break
            at += len(data) - len(mark) + 1
        return self.size

    def records(self) -> Iterator[Found]:
        """Records and gaps in order; together they cover every byte of the file once."""
        packed = self.read(0, 1) == MEMBER[:1] or (VERSION.match(self.read(0, 10)) is None and self.seems_packed())
        parse, mark = (self.member, MEMBER) if packed else (self.plain, b"WARC/1.")
        at, gap, reason = 0, None, None
        while at < self.size:
            try:
                found = parse(at)
            except Damaged as error:
                if gap is None:
                    gap, reason = at, str(error)
                at = error.end or self.next_mark(at + 1, mark)
                continue
            if gap is not None:
                yield Found("gap", gap, at, reason)
                gap = None
            yield found
            at = found.end
        if gap is not None:
            yield Found("gap", gap, self.size, reason)

    def seems_packed(self) -> bool:
        """For a file with a damaged start: whether a whole member comes before any version line."""
        line, at = self.next_mark(0, b"WARC/1."), 0
        while (at := self.next_mark(at, MEMBER)) < line:
            try:
                self.member(at)
            except Damaged as error:
                if error.end is None:
                    at += 1
                    continue
            return True
        return False


def _row(path: str, found: Found, payload: bool) -> dict:
    row = {"path": path, "offset": found.offset, "length": found.end - found.offset, "kind": found.kind, "reason": found.reason}
    if found.kind == "gap":
        return row
    head, parts = found.head, _payload(found.block)
    kind = head["warc-type"]
    body = parts[1] if parts else found.block
    number = {k: int(v) for k in ("page-id", "refers-to-page-id") if re.fullmatch("-?[0-9]{1,19}", v := head.get(k, ""))}
    row |= {
        "record_type": kind,
        "record_id": head.get("warc-record-id"),
        "target_uri": head.get("warc-target-uri"),
        "page_id": number.get("page-id"),
        "refers_to": number.get("refers-to-page-id"),
    }
    if kind == "revisit":
        size = parts[0].get("content-length", "") if parts else ""
        digest = head.get("warc-payload-digest", "").partition(":")[2] or None
        row |= {"payload_bytes": int(size) if size.isdigit() else None, "payload_digest": digest}
    else:
        row |= {"payload_bytes": len(body), "payload_digest": base32_sha1(body)}
        row |= {"payload": body} if payload else {}
    return row


@dataclass
class Files(InputPartition):
    files: list[tuple[str, int]]


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def _place(path: str) -> tuple[fs.FileSystem, str]:
    system, where = fs.FileSystem.from_uri(path)
    return system, where.rstrip("/")


def _listed(system: fs.FileSystem, where: str) -> list[fs.FileInfo]:
    """The files that finished writes name; all archives of a folder that no such write has made."""
    marker = f"{where}/{MANIFEST}"
    if system.get_file_info(marker).type == fs.FileType.File:
        with system.open_input_stream(marker) as f:
            named = json.loads(f.read() or b"[]")
        return system.get_file_info([f"{where}/{n}" for n in named])
    found = system.get_file_info(fs.FileSelector(where, recursive=True))
    return [f for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz"))]


class Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.schema = to_arrow_schema(schema)

    def partitions(self) -> list[Files]:
        out, size = [], FILE_BYTES
        for info in sorted(_listed(*_place(self.path)), key=lambda f: f.path):
            if size + info.size > FILE_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].files.append((info.path, info.size))
            size += info.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _place(self.path)
        rows, size = [], 0
        for path, length in partition.files:
            with system.open_input_file(path) as file:
                for found in Archive(file, length).records():
                    rows.append(_row(path, found, self.payload))
                    size += 500 + len(rows[-1].get("payload") or b"")
                    if size > BATCH:
                        yield pa.RecordBatch.from_pylist(rows, self.schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.schema)


class Writer(DataSourceArrowWriter):
    """Tasks write files of their own name; the manifest, written last, names those of the tasks that count."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.date, self.packed = options.get("date", "1970-01-01T00:00:00Z"), options.get("compress", "true").lower() == "true"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, where = _place(self.path)
        system.create_dir(where, recursive=True)
        names, file, size = [], None, 0
        try:
            for batch in iterator:
                columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "record_type")]
                for i in range(batch.num_rows):
                    page, url, payload, refers, kind = (c[i].as_py() for c in columns)
                    data = record(page, url, payload, refers, kind == "revisit", self.date)
                    if self.packed:
                        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                        data = pack.compress(data) + pack.flush()
                    if file is None or size + len(data) > FILE_BYTES:
                        if file:
                            file.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc{'.gz' * self.packed}")
                        file, size = system.open_output_stream(f"{where}/{names[-1]}", compression=None), 0
                    file.write(data)
                    size += len(data)
        finally:
            if file:
                file.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        system, where = _place(self.path)
        system.create_dir(where, recursive=True)
        before = [f.path.rpartition("/")[2] for f in _listed(system, where)] if self._finished(system, where) else []
        names = [n for m in messages if m for n in m.files]
        with system.open_output_stream(f"{where}/{MANIFEST}") as f:
            f.write(json.dumps(names if self.overwrite else before + names).encode())
        for name in before if self.overwrite else []:
            system.delete_file(f"{where}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        system, where = _place(self.path)
        for name in (n for m in messages if m for n in m.files):
            system.delete_file(f"{where}/{name}")

    @staticmethod
    def _finished(system: fs.FileSystem, where: str) -> bool:
        return system.get_file_info(f"{where}/{MANIFEST}").type == fs.FileType.File


class WarcArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        return Reader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(dict(self.options), overwrite)


def with_roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """``(page_id, url, payload, record_type, refers_to)`` of ``pages (page_id, url, html)``; a null html is empty.

    Of pages with equal payloads of ``least`` bytes or more, that with the largest page_id is the response and the others
    revisit it (a null page_id is the smallest; rows that repeat the largest one are all responses). Payloads are compared by
    SHA-256; only groups of more than one row are joined back, and their number of rows never meets in one task.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    same = F.sha2("payload", 256).alias("same")
    groups = pages.where(F.octet_length("payload") >= least).groupBy(same)
    groups = groups.agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    groups = materialize(groups.withColumn("shared", F.lit(True)), "warc-groups")
    revisit: Column = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (
        pages.withColumn("same", same)
        .join(groups, "same", "left")
        .select(
            "page_id",
            "url",
            "payload",
            F.when(revisit, "revisit").otherwise("response").alias("record_type"),
            F.when(revisit, F.col("first")).alias("refers_to"),
        )
    )


def write_archives(records: DataFrame, path: str, *, compress: bool = True, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write rows of ``with_roles`` as WARC/1.1 files to a new folder or add them to one that this function has written."""
    rows = records.select("page_id", "url", "payload", "refers_to", "record_type")
    with known_source(records.sparkSession, WarcArchive):
        rows.write.format(FORMAT).mode("append").options(path=path, compress=str(compress).lower(), date=date).save()


def read_archives(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """Records and gaps of all archives of a folder (columns ``SCHEMA``), one task for some files of ``FILE_BYTES`` in all.

    Every record is checked: version line, headers, content length, closing line ends, gzip checksum, block and payload digest.
    After a failed check the reader looks for the next gzip member or version line that begins a whole record, and logs the
    bytes between as a row of kind ``gap`` with the first reason. A damaged record whose frame is whole is one gap; what
    stands inside it is not taken for records. Records and gaps cover each file without overlap. Revisits have the size and
    digest of the payload that they stand for. With ``payload=False`` payloads are checked but not returned.
    """
    with known_source(spark, WarcArchive):
        return spark.read.format(FORMAT).options(path=path, payload=str(payload).lower()).load()
