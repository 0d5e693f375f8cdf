"""WARC records in ZIP packages: writing them, and range-reading them without extraction.

A package holds one stored member of gzipped WARC records (one gzip member per record) and one stored index
with the place of every record. Tasks write one package each and return a manifest row, so a package of a
lost or repeated attempt is in no manifest. Reading takes the manifest: a task parses a package's central
directory (ZIP64 too) from its tail, reads the index by its range, and cuts the records into slices of a
few megabytes; other tasks read each slice by one range request.

Files are reached by URI through Arrow's file systems, so tasks need no common local folder.
"""

from __future__ import annotations

import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from tallyspan.session import materialise, scratch_path

# Layout of ZIP structures and names of WARC.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
STORED = 0
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

SLICE_BYTES = 4 << 20
ROOT_ID = "urn:page:"
ReadAt = Callable[[int, int], bytes]


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    stored_bytes: int
    header_at: int


def directory(read_at: ReadAt, size: int) -> list[Member]:
    """The members of a package of ``size`` bytes, from its central directory."""
    tail_at = max(0, size - (22 + 0xFFFF + 20))
    tail = read_at(tail_at, size - tail_at)
    end = tail.rfind(EOCD)
    while end >= 0 and (len(tail) < end + 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(EOCD, 0, end)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP package, or cut off")
    _, _, _, count, length, start, _ = struct.unpack_from("<HHHHIIH", tail, end + 4)
    end_at = tail_at + end
    directory_end = end_at
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = read_at(end_at - 20, 20) if end_at >= 20 else b""
        if locator[:4] == LOCATOR64:
            record_at = struct.unpack_from("<Q", locator, 8)[0]
            record = read_at(record_at, 56)
            if record[:4] != EOCD64:
                raise ValueError("ZIP64 end record not found where its locator says")
            count, length, start = struct.unpack_from("<QQQ", record, 32)
            directory_end = record_at
    if start + length > directory_end:
        raise ValueError("central directory lies outside the package")
    data, at, out = read_at(start, length), 0, []
    for _ in range(count):
        if data[at : at + 4] != CENTRAL:
            raise ValueError("central directory entry expected")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, plain, names, extras, comments = struct.unpack_from("<IIHHH", data, at + 20)
        header_at = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[at + 46 + names : at + 46 + names + extras]
        pos = 0
        while pos + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, pos)
            if kind == 1:  # wide values stand only for fields that are full, in this order
                field = pos + 4
                for which, value in (("plain", plain), ("packed", packed), ("at", header_at)):
                    if value == 0xFFFFFFFF and field + 8 <= pos + 4 + n:
                        wide = struct.unpack_from("<Q", extra, field)[0]
                        field += 8
                        if which == "packed":
                            packed = wide
                        elif which == "at":
                            header_at = wide
            pos += 4 + n
        out.append(Member(name, method, packed, header_at))
        at += 46 + names + extras + comments
    return out


def data_start(read_at: ReadAt, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != STORED:
        raise ValueError(f"{member.name} is compressed in its package: its records can't be read by range")
    header = read_at(member.header_at, 30)
    if header[:4] != LOCAL:
        raise ValueError(f"{member.name}: local header expected")
    names, extras = struct.unpack_from("<HH", header, 26)
    return member.header_at + 30 + names + extras


def _open(uri: str):
    files, path = fs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


def _reader(f) -> ReadAt:
    def read_at(at: int, n: int) -> bytes:
        f.seek(at)
        return f.read(n)

    return read_at


def record(kind: str, record_id: str, uri: str, digest: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record: an HTTP response, or a revisit with its headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if kind == "response" else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join(uri.split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("WARC record expected")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    body = rest[: int(headers["content-length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary or string column: five hex digits give four letters."""
    h = F.sha1(payload)
    letters = []
    for g in range(8):
        v = F.conv(F.substring(h, 5 * g + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def _pack(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]):
        out = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if out is None:
                uri = f"{folder}/{uuid.uuid4().hex}.zip"
                files, path = fs.FileSystem.from_uri(uri)
                files.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = files.open_output_stream(path)
                package = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                member = package.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True)
                index, at, n = [], 0, 0
            for page, url, digest, kind, refers, body in zip(*(c.to_pylist() for c in batch.columns)):
                record_id = ROOT_ID + ("" if page is None else str(page))
                data = record(kind, record_id, url or "", digest, body or b"", None if refers is None else f"{ROOT_ID}{refers}", date)
                gz = zlib.compressobj(1, zlib.DEFLATED, 31)
                packed = gz.compress(data) + gz.flush()
                member.write(packed)
                index.append(json.dumps({"id": record_id, "type": kind, "offset": at, "length": len(packed)}))
                at += len(packed)
                n += 1
        if out is not None:
            member.close()
            package.writestr(zipfile.ZipInfo(INDEX), "\n".join(index) + "\n")
            package.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"uri": [uri], "records": pa.array([n], pa.int64())})

    return run


def write_packages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the manifest (uri, records).

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with the largest page_id is a response
    and the others revisit it; smaller ones are all responses. Rows that repeat that page_id are responses too. A
    null page_id is smaller than any; where all are null, all are responses. A null html is an empty payload. An
    empty table writes no package.
    """
    body = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body"))
    records = records.withColumn("digest", base32_sha1(F.col("body")))
    large = F.octet_length("body") >= least_bytes
    shared = records.where(large).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("last")).where("n > 1").drop("n")
    again = large & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    typed = records.join(shared, "digest", "left").select(
        "page_id", "url", "digest", F.when(again, "revisit").otherwise("response").alias("type"), F.when(again, F.col("last")).alias("refers_to"),
        F.when(~F.coalesce(again, F.lit(False)), F.col("body")).alias("body"),
    )
    folder = scratch_path(pages.sparkSession, "warc")
    return materialise(typed.mapInArrow(_pack(folder, date), "uri string, records long"), "manifest")


def _slices(batches):
    """(uri, start, bytes): runs of whole records, from each package's index."""
    for batch in batches:
        out = []
        for uri in batch.column(0).to_pylist():
            with _open(uri) as f:
                read_at = _reader(f)
                members = {m.name: m for m in directory(read_at, f.size())}
                index = members[INDEX]
                base = data_start(read_at, members[RECORDS])
                start, length = None, 0
                at, left, carry = data_start(read_at, index), index.stored_bytes, b""
                while left:
                    step = min(left, SLICE_BYTES)
                    *lines, carry = (carry + read_at(at, step)).split(b"\n")
                    at, left = at + step, left - step
                    for line in lines:
                        entry = json.loads(line)
                        if start is None:
                            start = base + entry["offset"]
                        length += entry["length"]
                        if length >= SLICE_BYTES:
                            out.append((uri, start, length))
                            start, length = None, 0
                if length:
                    out.append((uri, start, length))
        uris, starts, sizes = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_pydict({"uri": pa.array(uris, pa.string()), "start": pa.array(starts, pa.int64()), "bytes": pa.array(sizes, pa.int64())})


def _records(batches):
    for batch in batches:
        for uri, start, size in zip(*(c.to_pylist() for c in batch.columns)):
            with _open(uri) as f:
                data = _reader(f)(start, size)
            rows: dict[str, list] = {k: [] for k in ("offset", "type", "record_id", "target_uri", "refers_to", "header_digest", "payload")}
            at = 0
            while at < len(data):
                gz = zlib.decompressobj(31)
                headers, payload = parse_record(gz.decompress(memoryview(data)[at:]) + gz.flush())
                rows["offset"].append(start + at)
                at = len(data) - len(gz.unused_data)
                rows["type"].append(headers["warc-type"])
                rows["record_id"].append(headers["warc-record-id"].strip("<>"))
                rows["target_uri"].append(headers.get("warc-target-uri"))
                rows["refers_to"].append(headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None)
                rows["header_digest"].append(headers["warc-payload-digest"].removeprefix("sha1:"))
                rows["payload"].append(payload if headers["warc-type"] == "response" else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "uri": pa.array([uri] * len(rows["offset"]), pa.string()),
                    "offset": pa.array(rows["offset"], pa.int64()),
                    **{k: pa.array(rows[k], pa.binary() if k == "payload" else pa.string()) for k in list(rows)[1:]},
                }
            )


def read_packages(manifest: DataFrame) -> DataFrame:
    """Every record of the packages in ``manifest`` (column uri): its place, headers and payload (null for revisits)."""
    parallel = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = materialise(manifest.select("uri").repartition(parallel, "uri").mapInArrow(_slices, "uri string, start long, bytes long"), "slices")
    return slices.repartition(parallel, "uri", "start").mapInArrow(
        _records,
        "uri string, offset long, type string, record_id string, target_uri string, refers_to string, header_digest string, payload binary",
    )


def page_records(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records; a revisit has its response's payload."""
    page = lambda c: F.when(F.length(c) > len(ROOT_ID), F.substring(c, len(ROOT_ID) + 1, 20).cast("long"))
    read = materialise(
        read_packages(manifest).select(
            page(F.col("record_id")).alias("page_id"),
            F.octet_length("payload").cast("long").alias("own_bytes"),
            F.coalesce(base32_sha1(F.col("payload")), F.col("header_digest")).alias("payload_digest"),
            F.col("type").alias("record_type"),
            page(F.col("refers_to")).alias("refers_to"),
        ),
        "records",
    )
    of = read.where("own_bytes is not null").groupBy("payload_digest").agg(F.max("own_bytes").alias("of_bytes"))
    return read.join(of, "payload_digest", "left").select(
        "page_id", F.coalesce("own_bytes", "of_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
