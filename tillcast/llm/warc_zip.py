"""WARC records in ZIP packages: write them, and read them back by range without unpacking.

A package holds stored (uncompressed) members: ``archive/data.warc.gz`` with one gzip member per record, and
``indexes/index.cdx`` with the place of each record in it. The reader parses the end record, the ZIP64 end record and the
central directory, finds where a stored member begins from its local header, and then reads only the ranges it needs.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import fresh_path, stage

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Fixed values of the ZIP format.
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
_FULL16, _FULL32, _EXTRA64 = 0xFFFF, 0xFFFFFFFF, 0x0001


@dataclass(frozen=True)
class WarcSpec:
    """``least_bytes``: payloads below it are never deduplicated. ``package_bytes``: a package is closed beyond it.

    ``range_bytes``: one read of the reader covers about this much of the archive member.
    """

    least_bytes: int = 0
    package_bytes: int = 256 << 20
    range_bytes: int = 4 << 20
    date: str = "2024-01-01T00:00:00Z"


# --- ZIP -------------------------------------------------------------------------------------------------------


class StoredZip:
    """Writes stored members to a stream that cannot seek: sizes follow each member and stand in the directory.

    ZIP64 records are written for every member, so size and count have no limit.
    """

    def __init__(self, out: BinaryIO) -> None:
        self.out, self.at, self.entries = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc = name.encode(), self.at, 0
        # Version 4.5, flags: sizes follow (3), names in UTF-8 (11); stored; 1980-01-01.
        self._put(struct.pack("<IHHHHHIIIHH", _LOCAL, 45, 0x0808, 0, 0, 33, 0, _FULL32, _FULL32, len(self.name), 20))
        self._put(self.name + struct.pack("<HHQQ", _EXTRA64, 16, 0, 0))
        self.data_at = self.at

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self._put(data)

    def end(self) -> None:
        size = self.at - self.data_at
        self._put(struct.pack("<IIQQ", 0x08074B50, self.crc, size, size))
        self.entries.append((self.name, self.crc, size, self.start))

    def close(self) -> None:
        begins = self.at
        for name, crc, size, start in self.entries:
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 0x0808, 0, 0, 33, crc, _FULL32, _FULL32, len(name), 28, 0, 0, 0, 0, _FULL32))
            self._put(name + struct.pack("<HHQQQ", _EXTRA64, 24, size, size, start))
        size, count, end64 = self.at - begins, len(self.entries), self.at
        self._put(struct.pack("<IQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, count, count, size, begins))
        self._put(struct.pack("<IIQI", _LOCATOR64, 0, end64, 1))
        self._put(struct.pack("<IHHHHIIH", _END, 0, 0, min(count, _FULL16), min(count, _FULL16), min(size, _FULL32), _FULL32, 0))


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    local_at: int


def _read_at(file: pa.NativeFile, offset: int, size: int) -> bytes:
    file.seek(offset)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"package ends early: {size} bytes wanted at {offset}, {len(data)} there")
    return data


def members(file: pa.NativeFile) -> dict[str, Member]:
    """The central directory by name, with or without ZIP64 records. A file without an end record is an error."""
    length = file.size()
    tail_at = max(0, length - 22 - _FULL16)
    tail = _read_at(file, tail_at, length - tail_at)
    mark, found = struct.pack("<I", _END), len(tail)
    while (found := tail.rfind(mark, 0, found)) >= 0:  # the mark may also stand in the note behind the record
        if found + 22 <= len(tail) and found + 22 + struct.unpack_from("<H", tail, found + 20)[0] == len(tail):
            break
    if found < 0:
        raise ValueError("no end record: not a ZIP package")
    count, size, begins = struct.unpack_from("<HII", tail, found + 10)
    if (count == _FULL16 or size == _FULL32 or begins == _FULL32) and tail_at + found >= 20:
        mark, _, end64, _ = struct.unpack("<IIQI", _read_at(file, tail_at + found - 20, 20))
        if mark == _LOCATOR64:
            mark, _, _, _, _, _, _, count, size, begins = struct.unpack("<IQHHIIQQQQ", _read_at(file, end64, 56))
            if mark != _END64:
                raise ValueError("broken ZIP64 end record")
    directory, at, named = _read_at(file, begins, size), 0, {}
    for _ in range(count):
        mark, _, _, _, method, _, _, _, packed, plain, n_name, n_extra, n_note, _, _, _, local_at = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
        if mark != _CENTRAL:
            raise ValueError("broken central directory")
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra, here = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while here + 4 <= len(extra):
            kind, width = struct.unpack_from("<HH", extra, here)
            if kind == _EXTRA64:
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, here + 4))
                plain = next(wide) if plain == _FULL32 else plain
                packed = next(wide) if packed == _FULL32 else packed
                local_at = next(wide) if local_at == _FULL32 else local_at
            here += 4 + width
        named[name] = Member(name, method, packed, local_at)
        at += 46 + n_name + n_extra + n_note
    return named


def data_offset(file: pa.NativeFile, member: Member) -> int:
    """Where the bytes of a stored member begin; a compressed member is an error."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; ranges need a stored member")
    header = struct.unpack("<IHHHHHIIIHH", _read_at(file, member.local_at, 30))
    if header[0] != _LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.local_at + 30 + header[9] + header[10]


# --- WARC ------------------------------------------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, spec: WarcSpec) -> bytes:
    """One gzip member: a response with its payload, or a revisit with the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", spec.date),
        ("WARC-Target-URI", "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url or "")),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        *([("WARC-Refers-To", _record_id(refers_to)), ("X-Refers-To-Page-Id", str(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def parse_record(packed: bytes) -> dict:
    """The fields of one record; a response whose payload does not have its digest is an error."""
    raw = zlib.decompress(packed, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(line for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")).split(b":")[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    page_id, refers = fields["X-Page-Id"], fields.get("X-Refers-To-Page-Id")
    return {
        "page_id": int(page_id) if page_id else None,
        "url": fields["WARC-Target-URI"],
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(refers) if refers else None,
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


# --- Spark -----------------------------------------------------------------------------------------------------


def with_refers_to(pages: DataFrame, spec: WarcSpec) -> DataFrame:
    """page_id, url, html, refers_to: the page of largest id with the same payload, null where that is the page itself.

    Only digests and ids are grouped; the join sees payloads that occur more than once.
    """
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    key = F.when(F.octet_length("html") >= spec.least_bytes, F.sha1(F.encode("html", "UTF-8")))
    keyed = pages.withColumn("same", key)
    groups = keyed.where("same is not null").groupBy("same").agg(F.max("page_id").alias("largest"), F.count("*").alias("held"))
    shared = stage(groups.where("held > 1").select("same", "largest"), "shared-payloads")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("largest")), None).otherwise(F.col("largest"))
    return keyed.join(shared, "same", "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write_packages(pages: DataFrame, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Write one or more packages per task to the shared folder; returns the list of packages (path, records).

    A task names its files by chance and the list is written by Spark's own commit, so files of lost attempts are in no list.
    """
    folder = fresh_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        package = None

        def opened() -> tuple:
            name = f"{uuid.uuid4().hex}.wacz"
            out = store.open_output_stream(f"{root}/{name}", compression=None)
            package = StoredZip(out)
            package.begin(DATA)
            return f"{folder}/{name}", out, package, []

        def closed(path: str, out: pa.NativeFile, package: StoredZip, index: list[str]) -> pa.RecordBatch:
            package.end()
            package.begin(INDEX)
            for line in index:
                package.write(line.encode())
            package.end()
            package.close()
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([len(index)], pa.int64())})

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(i) for i in range(4)), strict=True):
                if package is None:
                    package = opened()
                _, _, zipped, index = package
                packed = record(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8", "surrogatepass"), refers_to.as_py(), spec)
                index.append(f"{zipped.at - zipped.data_at} {len(packed)}\n")
                zipped.write(packed)
                if zipped.at >= spec.package_bytes:
                    yield closed(*package)
                    package = None
        if package is not None:
            yield closed(*package)

    return stage(with_refers_to(pages, spec).mapInArrow(run, "path string, records long"), "packages")


def _ranges(index: bytes, width: int) -> Iterator[list[tuple[int, int]]]:
    """Neighbouring records whose bytes lie within about ``width``."""
    group: list[tuple[int, int]] = []
    for line in index.splitlines():
        offset, size = map(int, line.split())
        if group and offset + size - group[0][0] > width:
            yield group
            group = []
        group.append((offset, size))
    if group:
        yield group


def read_packages(packages: DataFrame, spec: WarcSpec = WarcSpec(), payloads: bool = False) -> DataFrame:
    """All records of the packages: page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload).

    First the indexes become ranges of a few MB, then the ranges are dealt out to all tasks and read.
    """
    spark: SparkSession = packages.sparkSession

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    named = members(file)
                    listed = _read_at(file, data_offset(file, named[INDEX]), named[INDEX].size)
                    base = data_offset(file, named[DATA])
                groups = list(_ranges(listed, spec.range_bytes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(groups), pa.string()), pa.array([base + g[0][0] for g in groups], pa.int64()), pa.array([[size for _, size in g] for g in groups], pa.list_(pa.int64()))],
                    ["path", "offset", "sizes"],
                )

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())] + ([("payload", pa.binary())] if payloads else []))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset, sizes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    data, at, found = _read_at(file, offset, sum(sizes)), 0, []
                for size in sizes:
                    found.append(parse_record(data[at : at + size]))
                    at += size
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in schema.names} for r in found], schema)

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = packages.select("path").repartition(width).mapInArrow(index, "path string, offset long, sizes array<long>")
    columns = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return dealt.repartition(width).mapInArrow(read, columns + (", payload binary" if payloads else ""))
