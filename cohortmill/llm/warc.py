"""Legacy web archives (ARC) to WARC.

An ARC file opens with a version block that declares the version and names the fields of the header
lines that follow: five in version 1, ten in version 2. A record is a header line and as many bytes
as its last field declares. The converter reads those and makes up what WARC wants besides: record
ids (from the place of the record, so a rerun of a lost task gives the same), ISO timestamps from the
14-digit dates, record types (an HTTP message is a ``response``, a name lookup or a bare file a
``resource``, the version block the ``warcinfo``) and SHA-1 digests of block and payload.

Of records with equal payloads one is written whole, the one with the largest key; the others become
``revisit`` records that refer to it. This is settled on narrow rows (place, key, digest). A digest
with a large share of all rows is joined by a bounded broadcast, see ``common.with_lookup``. Then
archives are converted one by one: what is shuffled are compressed archives, once, under unique names.

Archives are written and read by Spark itself (text writer, ``binaryFile``), so they may lie in any
store that Spark knows, and a task that is run again leaves no half of a file. An archive is closed
at ``ARCHIVE_BYTES`` (or holds one longer record): a bound for what a task holds.

Defined results: a null html is an empty payload; a null url becomes ``urn:x-page:<key>``; white
space and control characters in a url are percent-encoded; a null key is the smallest one; repeated
rows are records of their own, of which one is the response. Of input columns only those named are
read, so others cannot clash. An empty table gives no record. A header line that does not fit the
version, or a length beyond the end, stops the job with its place; with ``strict=False`` the reader
goes on at the next header line, and a record that was cut short is marked ``WARC-Truncated``.
"""

from __future__ import annotations

import base64
import gzip
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha1
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import scratch_table, with_lookup

ARCHIVE_BYTES = 8 << 20
CAPTURED = "20240101000000"  # for pages that do not say when they were fetched
KEY_HEADER = "X-Page-Id"

# Field names as both versions of the format fix them.
V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


class BrokenArchive(ValueError):
    """Bytes that are not what the format says."""


def opened(content: bytes) -> BinaryIO:
    """A stream over an archive, compressed (in any number of members) or not."""
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw


def digest_of(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


# ---- reading and writing ARC ------------------------------------------------------------


@dataclass(frozen=True)
class ArcRecord:
    offset: int  # of the header line in the uncompressed archive
    version: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    truncated: bool = False


def _fields(line: bytes, n: int) -> list[str] | None:
    """A header line as its ``n`` fields; blanks inside a url belong to it. None if it is no such line."""
    fields = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", n - 1)
    good = len(fields) == n and fields[0] and fields[-1].isdigit() and re.fullmatch("[0-9]{8,14}", fields[2])
    return fields if good else None


def read_arc_records(stream: BinaryIO, strict: bool = True) -> Iterator[ArcRecord]:
    """The version block, then every record, one at a time."""
    version, width, at = 0, 0, 0
    while line := stream.readline():
        offset, at = at, at + len(line)
        if not line.strip():
            continue
        if version:
            fields = _fields(line, width)
        else:  # the version is known only after the first line: its own width tells
            fields = _fields(line, 10) if line.count(b" ") >= 9 else _fields(line, 5)
        if fields is None:
            if strict:
                raise BrokenArchive(f"no header line at {offset}: {line[:100]!r}")
            continue
        length = int(fields[-1])
        block = stream.read(length)
        at += len(block)
        if len(block) < length and strict:
            raise BrokenArchive(f"record at {offset} declares {length} bytes, {len(block)} are left")
        if not version:
            lines = block.decode("utf-8", "replace").split("\n")
            if not fields[0].startswith("filedesc:") or lines[0][:1] not in ("1", "2"):
                raise BrokenArchive(f"no version block: {line[:100]!r}")
            version = int(lines[0][0])
            width = len(lines[1].split()) if len(lines) > 1 and lines[1].strip() else (5, 10)[version - 1]
        yield ArcRecord(offset, version, fields[0], fields[1], fields[2], fields[3], block, len(block) < length)


def arc_line(version: int, url: str, ip: str, date: str, mime: str, block: bytes, archive: str, offset: int,
             code: int = 200) -> bytes:
    fields = [url, ip, date, mime]
    if version == 2:
        fields += [str(code), digest_of(block), "-", str(offset), archive]
    return " ".join([*fields, str(len(block))]).encode() + b"\n"


def arc_head(version: int, archive: str, date: str = CAPTURED) -> bytes:
    block = f"{version} 0 cohortmill\n{(V1_FIELDS, V2_FIELDS)[version - 1]}\n".encode()
    return arc_line(version, f"filedesc://{archive}", "0.0.0.0", date, "text/plain", block, archive, 0) + block + b"\n"


def http_block(payload: bytes, key: object) -> bytes:
    """The answer of a server that sent the payload, with the key of the page as a header."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
    if key is not None:
        head += f"{KEY_HEADER}: {quote(str(key))}\r\n"
    return head.encode() + b"\r\n" + payload


def _url(url: str | None, key: object) -> str:
    if not url:
        return f"urn:x-page:{'' if key is None else key}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def write_arc(pages: DataFrame, folder: str, key: str = "page_id", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Pages as ARC files, of both versions by turns; every task writes archives of its own."""
    rows = pages.select(F.col(key).cast("string").alias("key"), "url", F.col("html").cast("binary").alias("html"))

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def done() -> pa.RecordBatch:
            # The writer ends every row, and with it the archive's last record, with a line feed.
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)[:-1]], pa.binary())], names=["archive"])

        for batch in batches:
            # One row at a time becomes a Python object, whatever the batch holds.
            for name, url, html in zip(*batch.columns, strict=True):
                block = http_block(html.as_py() or b"", name.as_py())
                if parts and size + len(block) > archive_bytes:
                    yield done()
                    number, parts, size = number + 1, [], 0
                version, archive = 1 + (task + number) % 2, f"pages-{task:06d}-{number:06d}.arc"
                if not parts:
                    parts.append(arc_head(version, archive))
                    size = len(parts[0])
                line = arc_line(version, _url(url.as_py(), name.as_py()), "0.0.0.0", CAPTURED, "text/html", block, archive, size)
                parts += [line, block, b"\n"]
                size += len(line) + len(block) + 1
        if parts:
            yield done()

    _write(rows.mapInArrow(archives, "archive binary"), folder, "\n")


def _write(archives: DataFrame, folder: str, ending: str) -> None:
    """Every row a file of its own, its bytes as they are."""
    archives.select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option(
        "lineSep", ending).option("compression", "gzip").text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


# ---- ARC to WARC -----------------------------------------------------------------------


def split_http(block: bytes) -> tuple[bytes, bytes] | None:
    """Head and payload of an HTTP message; None if the block is none."""
    if not block.startswith(b"HTTP/"):
        return None
    ends = [(i + len(gap)) for gap in (b"\r\n\r\n", b"\n\n") if (i := block.find(gap, 0, 1 << 20)) >= 0]
    end = min(ends, default=len(block))
    return block[:end], block[end:]


def _header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return unquote(found[1].decode("utf-8", "replace").strip()) if found else None


def record_id(place: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place}#{offset}')}>"


def warc_date(date: str) -> str:
    """14 digits (or fewer, the rest being zero, month and day one) as an ISO timestamp."""
    d = date + "00000101000000"[len(date):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _warc(kind: str, name: str, date: str, fields: dict[str, str | None], block: bytes) -> list[bytes]:
    head = {"WARC-Type": kind, "WARC-Record-ID": name, "WARC-Date": date, **fields,
            "WARC-Block-Digest": f"sha1:{digest_of(block)}", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return [b"WARC/1.0\r\n" + lines.encode() + b"\r\n", block, b"\r\n\r\n"]


def convert_record(place: str, record: ArcRecord, refers_to: dict | None = None) -> list[bytes]:
    """The WARC record of an ARC record, in pieces; as a revisit if it refers to another one."""
    name, date = record_id(place, record.offset), warc_date(record.date)
    fields = {"WARC-Truncated": "unspecified" if record.truncated else None}
    if record.url.startswith("filedesc:"):
        note = f"software: cohortmill\r\nformat: WARC File Format 1.0\r\nconverted-from: ARC version {record.version}\r\n"
        fields |= {"WARC-Filename": record.url.removeprefix("filedesc://"), "Content-Type": "application/warc-fields"}
        return _warc("warcinfo", name, date, fields, note.encode())
    http = split_http(record.block)
    payload = http[1] if http else record.block
    fields |= {"WARC-Warcinfo-ID": record_id(place, 0), "WARC-Target-URI": record.url,
               "WARC-IP-Address": None if record.ip in ("", "-", "0.0.0.0") else record.ip,
               "WARC-Payload-Digest": f"sha1:{digest_of(payload)}"}
    if http is None:
        return _warc("resource", name, date, fields | {"Content-Type": record.mime}, record.block)
    fields["Content-Type"] = "application/http; msgtype=response"
    if refers_to is None:
        return _warc("response", name, date, fields, record.block)
    fields |= {"WARC-Profile": IDENTICAL, "WARC-Refers-To": refers_to["id"],
               "WARC-Refers-To-Target-URI": refers_to["uri"], "WARC-Refers-To-Date": refers_to["date"]}
    return _warc("revisit", name, date, fields, http[0])


_PLACES = "path string, offset long, record_id string, key string, uri string, date string, payload_bytes long, digest string"


def payloads(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    """The HTTP records of all ARC files as narrow rows, with length and digest of the payload."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                place, out = path.as_py(), []
                for r in read_arc_records(opened(content.as_py()), strict):
                    if http := split_http(r.block):
                        out.append((place, r.offset, record_id(place, r.offset), _header(http[0], KEY_HEADER), r.url,
                                    warc_date(r.date), len(http[1]), digest_of(http[1])))
                yield _batch(out, _PLACES)

    return _files(spark, folder).mapInArrow(rows, _PLACES)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    names = [column.split() for column in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``path, offset`` of the records that another one stands for, and ``id, uri, date`` of that one."""
    size = F.col("payload_bytes") >= min_bytes
    chosen = F.max(F.struct(F.expr("try_cast(key as bigint)").alias("number"), "key", "path", "offset",
                            F.col("record_id").alias("id"), "uri", "date"))
    whole = records.where(size).groupBy("digest", "payload_bytes").agg(
        chosen.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.concat_ws(":", "digest", "payload_bytes").alias("payload"), "first")
    rows = records.where(size).select("path", "offset", F.concat_ws(":", "digest", "payload_bytes").alias("payload"))
    return with_lookup(rows, whole, "payload", "inner").where(
        (F.col("path") != F.col("first.path")) | (F.col("offset") != F.col("first.offset"))).select(
        "path", "offset", "first.id", "first.uri", "first.date")


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, min_bytes: int = 0, strict: bool = True) -> None:
    """Every ARC file of a folder as a WARC file in another."""
    narrow = scratch_table(payloads(spark, arc_folder, strict), "arc-records")
    # One row per archive, as long as the archive has records.
    verdicts = revisits(narrow, min_bytes).groupBy("path").agg(
        F.collect_list(F.struct("offset", "id", "uri", "date")).alias("revisits"))
    # The archives pass by the small side and need no sort.
    archives = _files(spark, arc_folder).join(verdicts.hint("shuffle_hash"), "path", "left")

    def converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, listed in zip(*batch.columns, strict=True):
                place, known = path.as_py(), {r["offset"]: r for r in listed.as_py() or ()}
                parts = [part for record in read_arc_records(opened(content.as_py()), strict)
                         for part in convert_record(place, record, known.get(record.offset))]
                if parts:  # the writer ends the last record
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts[:-1])], pa.binary())], names=["archive"])

    _write(archives.select("path", "content", "revisits").mapInArrow(converted, "archive binary"), warc_folder, "\r\n\r\n")


# ---- reading WARC ----------------------------------------------------------------------


def read_warc_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, names in lower case, and block of every record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise BrokenArchive(f"no version line: {line[:100]!r}")
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        if not head.get("content-length", "").isdigit():
            raise BrokenArchive(f"no length: {head.get('warc-record-id')}")
        length = int(head["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise BrokenArchive(f"{head.get('warc-record-id')} declares {length} bytes, {len(block)} are left")
        yield head, block


_READ = "record_id string, type string, uri string, date string, key string, payload_bytes long, digest string, refers_to string"


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The response, resource and revisit records of all WARC files, narrow. A payload that is there is
    measured, and must have the digest that its header declares; a revisit has a declared digest alone."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for head, block in read_warc_records(opened(content.as_py())):
                    kind, declared = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:")
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    http = split_http(block)
                    size, found = None, declared
                    if kind != "revisit":
                        payload = http[1] if http else block
                        size, found = len(payload), digest_of(payload)
                        if declared and declared != found:
                            raise BrokenArchive(f"{head['warc-record-id']}: digest {found}, declared {declared}")
                    out.append((head["warc-record-id"], kind, head.get("warc-target-uri"), head.get("warc-date"),
                                _header(http[0], KEY_HEADER) if http else None, size, found, head.get("warc-refers-to")))
                yield _batch(out, _READ)

    return _files(spark, folder).select("content").mapInArrow(rows, _READ)


def resolved(records: DataFrame) -> DataFrame:
    """The records, a revisit with the length of the payload it stands for and ``first``, the key of
    the record it refers to."""
    known = records.where("type <> 'revisit'").select(
        F.col("record_id").alias("refers_to"), F.col("key").alias("first"), F.col("payload_bytes").alias("size"))
    again = with_lookup(records.where("type = 'revisit'"), known, "refers_to", "left")
    columns = [name for name in records.columns if name != "payload_bytes"]
    return records.where("type <> 'revisit'").select(
        *columns, "payload_bytes", F.lit(None).cast("string").alias("first")).unionByName(
        again.select(*columns, F.col("size").alias("payload_bytes"), "first"))


def archive_pages(pages: DataFrame, key: str = "page_id", min_bytes: int = 0) -> DataFrame:
    """Pages into ARC files, those into WARC files, and what is read back from them:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``, and the url in the archive."""
    spark = pages.sparkSession
    arc, out = scratch_dir(spark, "llm/arc"), scratch_dir(spark, "llm/warc")
    write_arc(pages, arc, key)
    convert(spark, arc, out, min_bytes)
    kind = pages.schema[key].dataType
    return resolved(scratch_table(read_warc(spark, out), "warc-records")).select(
        F.col("key").cast(kind).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("first").cast(kind).alias("refers_to"), F.col("uri").alias("target_uri"))
