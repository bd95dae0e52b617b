"""WARC archives: written with one gzip member per record, read back as a stream.

Tasks write archives of a bounded size straight into the shared folder; a list of the finished ones is what a reader starts
from, so what a lost task left behind is never read. A reader inflates step by step and holds one record at a time; it takes
as many bytes as the record's ``Content-Length`` says and holds block and payload against their digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import named, stage
from millrace.session import work_path

#: Bytes after which an archive is closed and the next one begun, and bytes inflated at a time.
ARCHIVE, CHUNK = 64 << 20, 1 << 16
#: Tasks, at most, that read archives.
READERS = 10_000

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

_ID = "urn:page:"
_LIST = "path string, records long, bytes long"
_READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<{_ID}{'' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    return int(digits) if name and (digits := name.strip("<>").removeprefix(_ID)) else None


def _header(url: str) -> str:
    """A URL as a header value: control characters and blanks are escaped."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record. A revisit has the HTTP header only, whose length still is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}"]
    lines += [f"Content-Type: {HTTP_TYPE}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(stream: BinaryIO) -> Iterator[bytes]:
    """The inflated gzip members of a stream, one after the other."""
    inflate, parts, begun = zlib.decompressobj(31), [], False
    while data := stream.read(CHUNK):
        while data:
            begun = True
            parts.append(inflate.decompress(data))
            data = inflate.unused_data
            if inflate.eof:
                yield b"".join(parts)
                inflate, parts, begun = zlib.decompressobj(31), [], False
    if begun:
        raise ValueError("the archive ends within a record")


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8").split("\r\n")
    return first, {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse(member: bytes) -> tuple[dict[str, str], bytes, int]:
    """Fields, payload and full payload length of a record; ValueError if its length or a digest is wrong."""
    head, found, rest = member.partition(b"\r\n\r\n")
    version, fields = _fields(head)
    if not found or not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"{fields['warc-record-id']}: the record is not as long as its Content-Length says")
    if fields["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
        raise ValueError(f"{fields['warc-record-id']}: the block does not match its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(_fields(http)[1]["content-length"])
    if fields["warc-type"] == "response" and (len(payload) != full or fields["warc-payload-digest"] != f"sha1:{sha1_base32(payload)}"):
        raise ValueError(f"{fields['warc-record-id']}: the payload does not match its length or digest")
    return fields, payload, full


def _place(path: str) -> tuple[object, str]:
    """The file system of a path, and the path in it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path) if ":" in path else f"file://{path}")


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to`` of every row; ``refers_to`` is null where the record is a response."""
    p = pages.select(named(page_id).cast("long").alias("page_id"), named(url).cast("string").alias("url"), F.coalesce(named(html).cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("key", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    same = p.where("key IS NOT NULL").groupBy("key").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    same = stage(same.select(F.col("key").alias("of"), "first"), "same")  # copies only, so that the hot key is on one side
    p = p.join(same, p.key == same.of, "left")
    return p.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", size: int = ARCHIVE) -> DataFrame:
    """Write records to archives below ``folder``; returns the list of them (``path, records, bytes``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _place(folder)
        fs.create_dir(root, recursive=True)
        out, name, n, written = None, "", 0, 0
        done = []
        for b in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"  # of this attempt: one that is repeated writes another
                    out, n, written = fs.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                raw = record(page_id, url, payload, sha1_base32(payload), refers_to, refers_to is not None, date)
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed = deflate.compress(raw) + deflate.flush()
                out.write(packed)
                n, written = n + 1, written + len(packed)
                if written >= size:
                    out.close()
                    done.append((f"{folder}/{name}", n, written))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", n, written))
        columns = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["path", "records", "bytes"])

    return stage(records.select("page_id", "url", "payload", "refers_to").mapInArrow(run, _LIST), "archives")


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the archives that column ``path`` names: ``page_id, url, record_type, refers_to, payload_bytes,
    payload_digest``, both of the full payload, and with ``payload`` its bytes (null for a revisit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, at = _place(path)
                with fs.open_input_stream(at, compression=None) as stream:
                    rows, held = [], 0
                    for member in members(stream):
                        f, body, full = parse(member)
                        kind = f["warc-type"]
                        row = (_number(f["warc-record-id"]), f.get("warc-target-uri"), kind, _number(f.get("warc-refers-to")), full, f["warc-payload-digest"].removeprefix("sha1:"))
                        rows.append((*row, body if kind == "response" else None) if payload else row)
                        held += len(body) * payload
                        if len(rows) >= 1000 or held >= 16 << 20:
                            yield _rows(rows, payload)
                            rows, held = [], 0
                    yield _rows(rows, payload)

    tasks = min(READERS, max(1, archives.count()))
    return archives.select("path").repartition(tasks).mapInArrow(run, _READ + ", payload binary" * payload)


def _rows(rows: list[tuple], payload: bool) -> pa.RecordBatch:
    names = [x.split()[0] for x in _READ.split(", ")] + ["payload"] * payload
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * payload
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def archive_round_trip(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` to archives in the shared folder and read them back, without the payloads.

    The payload is the html in UTF-8, null: empty. Of records with equal payloads of at least ``least`` bytes that with the
    greatest ``page_id`` is a response and the others revisit it; rows that repeat that id are all responses, a null id is
    below all others, and a group of null ids only is all responses. No rows: no rows.
    """
    written = write_archives(plan_records(pages, least=least), work_path(spark, "warc"))
    return read_archives(written, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
