"""Web archives in ZIP packages: writing them, and reading records by range through the central directory."""

from __future__ import annotations

import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperfield.session import materialize, new_location

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
SMALL = 100  # payloads of fewer bytes are always written in full
# Signatures and sizes of the ZIP format.
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    """A stored member of a package: where its entry begins and how many bytes it has."""

    name: str
    header: int
    size: int
    method: int


def _read(source: Any, start: int, size: int) -> bytes:
    source.seek(start)
    return source.read(size)


def directory(source: Any, size: int) -> dict[str, Member]:
    """Members of a package of ``size`` bytes, from its central directory or, where that points to one, its ZIP64 form."""
    tail = _read(source, max(0, size - 66_000), min(size, 66_000))  # the longest comment and the end record
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == count or FULL32 in (length, start):
        if tail[at - 20 : at - 16] != LOCATOR:
            raise ValueError("no ZIP64 locator")
        place = struct.unpack_from("<Q", tail, at - 12)[0]
        record = _read(source, place, 56)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    data = _read(source, start, length)
    members, at = {}, 0
    for _ in range(count):
        if data[at : at + 4] != ENTRY:
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, plain, names, extra, comment = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + names].decode("utf-8")
        field, end = at + 46 + names, at + 46 + names + extra
        while field + 4 <= end:
            kind, n = struct.unpack_from("<HH", data, field)
            if kind == 1:  # 64-bit values stand only for those that are full, in this order
                values = iter(struct.unpack_from(f"<{n // 8}Q", data, field + 4))
                plain = next(values) if plain == FULL32 else plain
                packed = next(values) if packed == FULL32 else packed
                header = next(values) if header == FULL32 else header
            field += 4 + n
        members[name] = Member(name, header, packed, method)
        at = end + comment
    return members


def content_start(source: Any, member: Member) -> int:
    """Where the bytes of a stored member begin; its local header may have other extra fields than the directory."""
    head = _read(source, member.header, 30)
    if head[:4] != LOCAL or member.method != 0:
        raise ValueError(f"{member.name} is not stored")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def record(kind: str, name: str, uri: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the response's head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of a WARC record, fields of its HTTP head, and the payload."""

    def fields(head: bytes) -> dict[str, str]:
        pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
        return {k.strip().lower(): v.strip() for k, v in pairs}

    head, _, rest = data.partition(b"\r\n\r\n")
    own = fields(head)
    block = rest[: int(own["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return own, fields(http), payload


def _name(page_id: int | None) -> str:
    return "none" if page_id is None else str(page_id)


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """(path, bytes, records) of the packages written to ``folder``, one a task, with a record for each of ``pages``.

    ``pages`` has page_id, url, payload, digest, first (page_id of the response, or null). Records are compressed by
    themselves; a stored index gives the place of each. The folder may be any that Arrow's file systems reach. Each
    attempt of a task writes a package of its own name, and only those of attempts that succeeded are returned.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        path = f"{root}/{uuid.uuid4().hex}.wacz"
        index, at, count = [], 0, 0
        with system.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
            with package.open(ARCHIVE, "w", force_zip64=True) as archive:
                batch: pa.RecordBatch | None = first
                while batch is not None:
                    for row in batch.to_pylist():
                        kind = "response" if row["first"] is None else "revisit"
                        uri = (row["url"] or "").replace("\r", "").replace("\n", "")
                        plain = record(kind, _name(row["page_id"]), uri, row["payload"], row["digest"], row["first"])
                        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                        packed = packer.compress(plain) + packer.flush()
                        archive.write(packed)
                        index.append(f"{uri} {json.dumps({'offset': at, 'length': len(packed)})}")
                        at += len(packed)
                        count += 1
                    batch = next((b for b in batches if b.num_rows), None)
            with package.open(INDEX, "w", force_zip64=True) as member:
                for low in range(0, len(index), 1000):
                    member.write(("\n".join(index[low : low + 1000]) + "\n").encode())
        size = system.get_file_info(path).size
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], ["path", "bytes", "records"])

    written = pages.select("page_id", "url", "payload", "digest", "first").mapInArrow(work, "path string, bytes long, records long")
    return materialize(written, "packages")


def locate(packages: DataFrame, folder: str) -> DataFrame:
    """(path, uri, start, length): the place of every record in its package, from the packages' indexes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(path) as source:
                    members = directory(source, size)
                    base = content_start(source, members[ARCHIVE])
                    at, left = content_start(source, members[INDEX]), members[INDEX].size
                    held = b""
                    while left or held:
                        data = held + _read(source, at, min(left, 1 << 20))
                        at, left = at + min(left, 1 << 20), left - min(left, 1 << 20)
                        data, _, held = data.rpartition(b"\n") if left else (data, b"", b"")
                        lines = [line.rpartition(" {") for line in data.decode("utf-8").split("\n") if line]
                        places = [json.loads("{" + rest) for *_, rest in lines]
                        columns = [[path] * len(lines), [u for u, *_ in lines], [base + p["offset"] for p in places], [p["length"] for p in places]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["path", "uri", "start", "length"])

    return packages.select("path", "bytes").mapInArrow(work, "path string, uri string, start long, length long")


def read_records(places: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """(page_id, uri, record_type, refers_to, payload_bytes, payload_digest, payload) of the records at ``places``.

    Each record is fetched by its range and unpacked by itself. The payload is null for revisits; its size and digest
    are the response's. A response whose payload differs from its digest fails the read.
    """
    from hashlib import sha256

    def number(name: str | None) -> int | None:
        found = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return None if found in ("", "none") else int(found)

    names = ["page_id", "uri", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        path, source = None, None
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                if row["path"] != path:
                    if source is not None:
                        source.close()
                    path, source = row["path"], system.open_input_file(row["path"])
                own, http, payload = parse(zlib.decompress(_read(source, row["start"], row["length"]), 31))
                digest = own["warc-payload-digest"].removeprefix("sha256:")
                kind = own["warc-type"]
                if kind == "response" and sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {own['warc-record-id']} differs from its digest")
                size = len(payload) if kind == "response" else int(http["content-length"])
                body = payload if with_payload and kind == "response" else None
                rows.append((number(own["warc-record-id"]), own["warc-target-uri"], kind, number(own.get("warc-refers-to")), size, digest, body))
                if sum(len(r[-1] or b"") for r in rows[-64:]) > 1 << 23 or len(rows) == 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        if source is not None:
            source.close()

    schema = "page_id long, uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return places.mapInArrow(work, schema)


def archive(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """The packages written for ``pages`` (page_id, url, html), and their folder; see :func:`write_packages`.

    The payload is the html in UTF-8 (null: empty). Of equal payloads of at least ``SMALL`` bytes the record with the
    smallest page_id is the response and the others revisit it; rows that repeat that id are responses too, as are
    rows of a null id unless the payload has an id. Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or new_location(spark, "packages")
    if not re.match("[a-z0-9]+://", folder):  # file:/x and /x as Arrow's file systems want them
        folder = "file://" + folder.removeprefix("file:")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.length("payload") >= SMALL)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("least"), F.count("*").alias("c")).filter("c > 1").select("digest", "least")
    other = (F.length("payload") >= SMALL) & F.col("least").isNotNull() & ~F.col("least").eqNullSafe(F.col("page_id"))
    marked = rows.join(firsts, "digest", "left").withColumn("first", F.when(other, F.col("least")))
    return write_packages(marked, folder), folder


def read_archive(packages: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the packages, read by as many tasks as the session shuffles to; see :func:`read_records`."""
    parts = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = locate(packages, folder).repartitionByRange(parts, "path", "start").sortWithinPartitions("path", "start")
    return read_records(places, folder, with_payload)
