"""WARC records in ZIP packages, written by tasks and read back by byte ranges.

A package is a ZIP file with two stored members: the WARC file, whose records are gzip members
of their own, and its index, a line per record with offset, length and type. Packages are
written as streams, one per task, under a name of the attempt's own; the table of packages
that the write returns names only those of tasks that ended well. Readers never unpack: they
read the end of the file, follow the central directory (with the ZIP64 records where sizes or
offsets exceed 32 bits), find where the members' bytes start, read the index, and then fetch
runs of records as byte ranges. Folders are reached through Arrow's file systems, so any
address Arrow knows works that driver and executors share.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest
id is the response and holds the payload. The others are revisits: they name the response and
hold only the headers, length and digest among them. Null html is an empty payload. A null id
never is the smallest; if a payload has null ids only, all its records are responses. Rows
with the same smallest id and payload are all responses. A null address becomes the page's
own name; line breaks in an address are written in percent code. Pages have no date, so all
records carry the epoch. Other input columns don't matter; an empty table gives no packages.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import slices
from dockcast.session import materialise, scratch_path

REVISIT_BYTES = 100
RUN_BYTES = 4 << 20
RECORDS, INDEX = "records.warc.gz", "records.idx"
# Fixed values of the ZIP format: signatures and the marks for "see ZIP64".
_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


class Member(NamedTuple):
    name: str
    method: int
    packed: int
    size: int
    header: int


def _open(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address if "://" in address or address.startswith("file:") else f"file://{address}")


def _at(file, offset: int, n: int) -> bytes:
    file.seek(offset)
    return file.read(n)


def directory(file, size: int) -> list[Member]:
    """The members of a ZIP file, from its central directory."""
    tail_at = max(0, size - _FULL16 - 22)
    tail = _at(file, tail_at, size - tail_at)
    end = tail.rfind(_END)
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(_END, 0, end)  # a comment may hold the signature
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if _FULL16 == count or _FULL32 in (length, start):
        place = tail_at + end - 20
        locator = _at(file, place, 20) if place >= 0 else b""
        if locator[:4] != _LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record = _at(file, struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    return _entries(_at(file, start, length), count)


def _entries(data: bytes, count: int) -> list[Member]:
    members, at = [], 0
    for _ in range(count):
        if data[at : at + 4] != _ENTRY:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, size, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + name_n].decode()
        extra = data[at + 46 + name_n : at + 46 + name_n + extra_n]
        size, packed, header = _wide(extra, size, packed, header)
        members.append(Member(name, method, packed, size, header))
        at += 46 + name_n + extra_n + comment_n
    return members


def _wide(extra: bytes, *values: int) -> list[int]:
    """The values, those marked as too large taken from the ZIP64 field, in its order."""
    field, at = b"", 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            field = extra[at + 4 : at + 4 + n]
        at += 4 + n
    out, at = [], 0
    for value in values:
        if value == _FULL32:
            value = struct.unpack_from("<Q", field, at)[0]
            at += 8
        out.append(value)
    return out


def data_start(file, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} isn't stored")
    local = _at(file, member.header, 30)
    if local[:4] != _LOCAL:
        raise ValueError("broken member header")
    name_n, extra_n = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + name_n + extra_n


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record(page_id, url, payload: bytes, digest: str, refers_to, n: int) -> bytes:
    address = (url or f"urn:page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Target-URI: {address}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = http + (payload if refers_to is None else b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields and, if it holds one, its payload; checked against its own lengths and digest."""
    head, rest = data.split(b"\r\n\r\n", 1)
    first, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    n = int(fields["content-length"])
    if not first.startswith("WARC/") or rest[n:] != b"\r\n\r\n":
        raise ValueError("broken WARC record")
    http, payload = rest[:n].split(b"\r\n\r\n", 1)
    sizes = [line.split(b": ")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length: ")]
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response" and (len(payload) != int(sizes[0]) or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} isn't what its record says")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "payload": payload if fields["warc-type"] == "response" else None,
        "payload_bytes": int(sizes[0]),
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": _page(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
    }


def planned(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest and the response they refer to (null for responses)."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    all_pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"),
        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("n"),
    )
    firsts = (
        all_pages.where(F.col("n") >= REVISIT_BYTES)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("same"))
        .where("same > 1").select("digest", "first")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return all_pages.join(materialise(firsts, "warc-firsts"), "digest", "left").withColumn("refers_to", refers)


def write(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes packages to a shared folder; a table of their addresses, records and sizes."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    store, path = _open(folder)
    store.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        address, lines, at, package, member = f"{folder}/{uuid.uuid4().hex}.zip", [], 0, None, None
        store, path = _open(address)
        for part in slices(batches):
            if package is None and part.num_rows:
                stream = store.open_output_stream(path)
                package = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
                member = package.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True)
            columns = (part.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to", "n"))
            for row in zip(*columns, strict=True):
                packed = gzip.compress(record(*row), 6, mtime=0)
                member.write(packed)
                lines.append(f"{at} {len(packed)} {'response' if row[4] is None else 'revisit'}\n")
                at += len(packed)
        if package is not None:
            member.close()
            package.writestr(zipfile.ZipInfo(INDEX), "".join(lines))
            package.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"package": [address], "records": [len(lines)], "bytes": [at]})

    written = planned(pages).mapInArrow(run, "package string, records long, bytes long")
    return materialise(written, "warc-packages")


def runs(packages: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Byte ranges of whole records: ``package, start, lengths`` (of the records, as JSON)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column("package").to_pylist():
                store, path = _open(address)
                with store.open_input_file(path) as file:
                    members = {m.name: m for m in directory(file, file.size())}
                    index = members[INDEX]
                    lines = _at(file, data_start(file, index), index.size).decode().splitlines()
                    base = data_start(file, members[RECORDS])
                out, lengths, start = [], [], None
                for offset, n in (map(int, line.split()[:2]) for line in lines):
                    if lengths and offset + n - start > run_bytes:
                        out.append((start, lengths))
                        lengths = []
                    start = start if lengths else offset
                    lengths.append(n)
                out += [(start, lengths)] if lengths else []
                if out:
                    yield pa.RecordBatch.from_pydict(
                        {"package": [address] * len(out), "start": [base + s for s, _ in out], "lengths": [json.dumps(x) for _, x in out]}
                    )

    return packages.select("package").mapInArrow(find, "package string, start long, lengths string")


READ_SCHEMA = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read(packages: DataFrame, payloads: bool = True, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The records of the packages; without payloads they are still read and checked."""
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
    schema = pa.schema(list(zip((c.split()[0] for c in READ_SCHEMA.split(", ")), kinds, strict=True)))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, start, lengths in zip(*(batch.column(c).to_pylist() for c in ("package", "start", "lengths")), strict=True):
                store, path = _open(address)
                lengths = json.loads(lengths)
                with store.open_input_file(path) as file:
                    data = memoryview(_at(file, start, sum(lengths)))
                rows, at = [], 0
                for n in lengths:
                    row = parse(gzip.decompress(data[at : at + n]))
                    rows.append(row if payloads else row | {"payload": None})
                    at += n
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    spread = runs(packages, run_bytes).repartition("package", "start")
    return spread.mapInArrow(fetch, READ_SCHEMA)
