"""WARC records in ZIP packages: a writer, and a reader that takes ranges out of stored members.

A package is a ZIP file with the records in ``archive/data.warc.gz`` (each record a gzip member of
its own), their places in ``indexes/index.cdxj`` and a ``datapackage.json``, all stored, not deflated.
The reader finds the central directory from the end of the file (by the ZIP64 records where there
are any), locates the stored archive and index members, and reads ranges of records straight out of
the package; nothing is extracted. An index, in any order, plain or compressed, only says where a member may be
cut: every byte of an archive member is in one range, listed or not; without an index a member is one range. Index and ranges are rows, so the records of one large package are
spread over many tasks. Packages are read and written through ``pyarrow.fs`` in the shared folder.

A writing task names its file after its attempt and returns the name as a row; a file left by a
lost or repeated attempt is in no row and is never read.

Defined results: a null html is an empty payload; a null url leaves out the target; rows with equal
payloads and the same largest id are all responses; a null id is never the largest, and where a
payload has null ids alone its records are responses; repeated rows give repeated records; an empty
table gives no rows; only the id, url and html are read, so other columns may have any name. Records of
other types (warcinfo, request, resource) are returned with their type, the payload being their block without
HTTP headers; record ids that are not pages' are null; a digest that is missing or not SHA-1 is taken from the payload.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmloom.llm.common import small_batches, stored
from cdmloom.operators.durable import scratch_path

#: Payloads of fewer bytes are always written whole.
LEAST_REVISIT = 1000
#: A writing task begins another package after so many bytes of records.
PACKAGE = 256 * 1024 * 1024
#: Bytes of records that one row of work reads.
RANGE = 4 * 1024 * 1024
#: Bytes read and decompressed at a time.
PIECE = 256 * 1024
LEVEL = 4

ARCHIVE, INDEX, DESCRIPTION = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
ID_PREFIX = "urn:page:"

# Signatures and layouts of the ZIP format (fixed values).
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


# Writing


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit with the headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>"]
    return "\r\n".join([*lines, "", ""]).encode("utf-8", "replace") + block + b"\r\n\r\n"


def compressed(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Package:
    """A ZIP package under way; members are stored as they come."""

    def __init__(self, uri: str) -> None:
        where, path = fs.FileSystem.from_uri(uri)
        self.uri, self.sink = uri, where.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.archive = self.zip.open(ARCHIVE, "w", force_zip64=True)
        self.bytes, self.index = 0, []

    def add(self, data: bytes, about: dict[str, Any]) -> None:
        packed = compressed(data)
        self.index.append(json.dumps(about | {"offset": self.bytes, "length": len(packed)}))
        self.archive.write(packed)
        self.bytes += len(packed)

    def close(self) -> tuple[str, int]:
        self.archive.close()
        self.zip.writestr(INDEX, "".join(f"{x}\n" for x in self.index))
        self.zip.writestr(DESCRIPTION, json.dumps({"profile": "data-package", "resources": [{"path": ARCHIVE}, {"path": INDEX}]}))
        self.zip.close()
        self.sink.close()
        return self.uri, len(self.index)


def with_payload(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to); refers_to is null for responses.

    Only digests and ids are grouped. The payloads that occur more than once are stored
    first, so that Spark knows their size when it chooses how to join them.
    """
    rows = pages.select(
        F.col(id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    big = F.octet_length("payload") >= least
    shared = rows.where(big).groupBy("sha1").agg(F.max("page_id").alias("first_id"), F.count("*").alias("__n"))
    shared = stored(shared.where((F.col("__n") > 1) & F.col("first_id").isNotNull()).drop("__n"), "payloads")
    return rows.join(shared, "sha1", "left").select(
        "page_id", "url", "payload", "sha1", F.when(big & ~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id")).alias("refers_to")
    )


def write_packages(pages: DataFrame, folder: str | None = None, package: int = PACKAGE, **columns: str) -> DataFrame:
    """Write every page into packages under ``folder``; returns (path, records) of each."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "warc")
    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, at = TaskContext.get(), 0, None
        for batch in batches:
            for page_id, url, payload, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at is None:
                    at = Package(f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}-{n}.zip")
                    n += 1
                at.add(record(page_id, url, payload, sha1, refers_to), {"id": page_id, "type": "response" if refers_to is None else "revisit"})
                if at.bytes >= package:
                    yield _row(at.close())
                    at = None
        if at is not None:
            yield _row(at.close())

    def _row(made: tuple[str, int]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([made[0]]), pa.array([made[1]], pa.int64())], ["path", "records"])

    return stored(with_payload(pages, **columns).mapInArrow(run, "path string, records long"), "packages")


# Reading


class Member(NamedTuple):
    name: str
    method: int
    begin: int
    size: int


def _read(file: Any, begin: int, size: int) -> bytes:
    file.seek(begin)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"package ends at {begin + len(data)}, before {begin + size}")
    return data


def directory(file: Any, size: int) -> tuple[int, int, int]:
    """(offset, bytes, entries) of the central directory, from the end records of the file."""
    tail = _read(file, max(0, size - 22 - FULL16), min(size, 22 + FULL16))
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if entries == FULL16 or length == FULL32 or offset == FULL32:
        place = size - len(tail) + at - 20
        locator = _read(file, place, 20)
        if locator[:4] != LOCATOR64:
            raise ValueError("the ZIP64 locator is missing")
        end64 = _read(file, struct.unpack_from("<Q", locator, 8)[0], 56)
        if end64[:4] != END64:
            raise ValueError("the ZIP64 end record is missing")
        entries, length, offset = struct.unpack_from("<QQQ", end64, 32)
    return offset, length, entries


def members(file: Any, size: int) -> list[Member]:
    """Every member with the place of its data."""
    offset, length, entries = directory(file, size)
    data, at, found = _read(file, offset, length), 0, []
    for _ in range(entries):
        if data[at : at + 4] != CENTRAL:
            raise ValueError(f"no directory entry at {offset + at}")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        local = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
        extra, rest = data[at + 46 + n_name : at + 46 + n_name + n_extra], []
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # the 64-bit values of the fields that are full, in this order
                rest = list(struct.unpack_from(f"<{n // 8}Q", extra, 4))
            extra = extra[4 + n :]
        if plain == FULL32:
            plain = rest.pop(0)
        if packed == FULL32:
            packed = rest.pop(0)
        if local == FULL32:
            local = rest.pop(0)
        head = _read(file, local, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no member at {local}")
        skip = sum(struct.unpack_from("<HH", head, 26))
        found.append(Member(name, method, local + 30 + skip, packed))
        at += 46 + n_name + n_extra + n_comment
    return found


def _inflated(pieces: Iterator[bytes], wbits: int) -> Iterator[bytes]:
    """The pieces decompressed, one compressed stream after the other."""
    decompress = zlib.decompressobj(wbits)
    for pending in pieces:
        while pending:
            if decompress.eof:
                decompress = zlib.decompressobj(wbits)
            yield decompress.decompress(pending)
            pending = decompress.unused_data
    if not decompress.eof:
        raise ValueError("a compressed index is cut off")


def index_lines(file: Any, index: Member) -> Iterator[bytes]:
    """The lines of an index, which may be deflated in the package, a file of gzip members, or both."""
    pieces: Iterator[bytes] = (_read(file, index.begin + at, min(PIECE, index.size - at)) for at in range(0, index.size, PIECE))
    if index.method == zipfile.ZIP_DEFLATED:
        pieces = _inflated(pieces, -15)
    elif index.method:
        raise ValueError(f"{index.name} is compressed by method {index.method}")
    if index.name.endswith(".gz") and index.size:
        pieces = _inflated(pieces, 31)
    rest = b""
    for piece in pieces:
        *lines, rest = (rest + piece).split(b"\n")
        yield from lines
    if rest:
        yield rest


def _places(file: Any, found: list[Member], archives: list[Member]) -> dict[str, set[int]]:
    """By archive member, the ends of the records that the indexes list, in no order."""
    by_name: dict[str, str | None] = {}
    for m in archives:
        last = m.name.rpartition("/")[2]
        by_name[last] = None if last in by_name else m.name  # of two members alike in name neither is meant
    for m in archives:
        by_name |= {m.name: m.name, m.name.removeprefix("archive/"): m.name}
    size, ends = {m.name: m.size for m in archives}, {m.name: set() for m in archives}
    for index in found:
        if not index.name.startswith("indexes/") or not index.name.removesuffix(".gz").endswith((".cdxj", ".cdx")):
            continue
        for line in index_lines(file, index):
            at = 0 if line.startswith(b"{") else line.find(b" {") + 1
            if line.startswith(b"!") or line[at : at + 1] != b"{":
                continue  # not a record's line
            place = json.loads(line[at:])
            name = archives[0].name if len(archives) == 1 else by_name.get(place.get("filename", ""))
            if name is None or "offset" not in place or "length" not in place:
                continue
            begin, end = int(place["offset"]), int(place["offset"]) + int(place["length"])
            if begin < 0 or end > size[name]:
                raise ValueError(f"{index.name} lists a record at {begin} to {end} of {name}, which has {size[name]} bytes")
            ends[name] |= {begin, end}
    return ends


def ranges(file: Any, size: int, most: int = RANGE) -> Iterator[tuple[int, int]]:
    """Runs of whole records, of about ``most`` bytes each, as offsets in the package; together the whole archive members."""
    found = members(file, size)
    archives = [m for m in found if m.name.startswith("archive/") and not m.name.endswith("/")]
    for m in archives:
        if m.method:
            raise ValueError(f"{m.name} is deflated; records can only be read from stored members")
    ends = _places(file, found, archives) if archives else {}
    for m in archives:
        begin = 0
        for end in sorted(ends[m.name]):
            if end - begin >= most:
                yield m.begin + begin, m.begin + end
                begin = end
        if m.size > begin:
            yield m.begin + begin, m.begin + m.size


def record_bytes(file: Any, begin: int, end: int) -> Iterator[bytes]:
    """Each record in the range, decompressed; the range is read piece by piece."""
    file.seek(begin)
    left, pending, out = end - begin, b"", []
    decompress = zlib.decompressobj(31)
    while left or pending:
        if not pending:
            pending = file.read(min(left, PIECE))
            if not pending:
                raise ValueError("the package ends within a record")
            left -= len(pending)
        out.append(decompress.decompress(pending))
        pending = b""
        if decompress.eof:
            pending, decompress = decompress.unused_data, zlib.decompressobj(31)
            yield b"".join(out)
            out = []
    if out:
        raise ValueError("the last record is cut off")


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}, rest


def _page(value: str | None) -> int | None:
    """The page's number, null if the record id is no page's."""
    number = (value or "").strip("<>").removeprefix(ID_PREFIX)
    return int(number) if re.fullmatch("-?[0-9]{1,19}", number) and -(1 << 63) <= int(number) < 1 << 63 else None


def _sha1(value: str | None) -> str | None:
    """The SHA-1 digest of a header, in base 32 or 16, as hexadecimal digits; null if there is none."""
    kind, _, digest = (value or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return digest.lower() if len(digest) == 40 else base64.b32decode(digest.upper()).hex()


def parsed(data: bytes) -> tuple[int | None, str | None, int | None, str | None, str, int | None, bytes | None]:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload).

    The digest is taken anew from the payload; a response's must be the one in its header. A revisit's size and
    digest are those that its headers state, if they do.
    """
    warc, block = _headers(data)
    block = block[: int(warc["content-length"])]
    kind = warc["warc-type"].lower()
    is_http = kind in ("response", "revisit") and "content-type" not in warc or warc.get("content-type", "").lower().startswith("application/http")
    http, payload = _headers(block) if is_http else ({}, block)
    stated = _sha1(warc.get("warc-payload-digest"))
    if kind == "revisit":
        length = http.get("content-length", "")
        size, digest, payload = int(length) if length.isdecimal() else None, stated, None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if kind == "response" and stated not in (None, digest):
            raise ValueError(f"{warc['warc-record-id']}: the payload does not have its digest")
    return _page(warc["warc-record-id"]), warc.get("warc-target-uri"), size, digest, kind, _page(warc.get("warc-refers-to")), payload


def read_packages(packages: DataFrame, payloads: bool = False, most: int = RANGE) -> DataFrame:
    """The records of the packages whose addresses are in the column ``path``.

    (page_id, url, payload_bytes, payload_digest, record_type, refers_to), and the payload on request.
    """
    spark = packages.sparkSession
    small_batches(spark)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                where, path = fs.FileSystem.from_uri(uri)
                with where.open_input_file(path) as file:
                    runs = list(ranges(file, file.size(), most))
                yield pa.record_batch(
                    [pa.array([uri] * len(runs), pa.string()), *(pa.array([r[i] for r in runs], pa.int64()) for i in range(2))], ["path", "begin", "end"]
                )

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][: 6 + payloads]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: 6 + payloads]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                where, path = fs.FileSystem.from_uri(uri)
                with where.open_input_file(path) as file:
                    rows = [parsed(r)[: len(names)] for r in record_bytes(file, begin, end)]
                yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    runs = packages.select("path").mapInArrow(locate, "path string, begin long, end long")
    spread = runs.repartition(max(2, spark.sparkContext.defaultParallelism))
    spec = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spread.mapInArrow(read, spec + ", payload binary" * payloads)
