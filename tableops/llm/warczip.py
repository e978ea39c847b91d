"""WARC records in ZIP packages: written, and read by ranges without extraction.

A package is a ZIP file whose members are stored, not compressed: ``archive/*.warc.gz`` (every record a gzip member of
its own, so a record is a byte range of the package) and ``indexes/*.cdxj`` (one line a record: target, time, and JSON
with member, offset and length). Packages of 4 GB or 65,535 members and more have ZIP64 records.

Reading: the directory at the end of every package is parsed (end record, ZIP64 locator and end record, central
directory with ZIP64 fields, then the local header, which alone tells where a member's bytes begin). Index members are
read in ranges of ``INDEX_RANGE`` bytes by different tasks; members that no index names are walked record by record.
The records' ranges are dealt out by package and zone of ``ZONE`` bytes and read in order, adjacent ones together. A
member that is compressed inside the ZIP, or a record whose payload does not have its digest, fails the job.

Writing: every task streams its records into packages of about ``PACKAGE`` bytes, under names no other attempt uses;
what counts is the table of packages that the finished tasks return. A task holds one member (``MEMBER`` bytes or one
record) and the index lines of one package.

Files are opened through ``pyarrow.fs`` by the URI of the folder (local, HDFS, S3, GCS), on driver and executors alike.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage, partitions

PACKAGE, MEMBER, ZONE, INDEX_RANGE = 256 << 20, 16 << 20, 8 << 20, 16 << 20
LEVEL = 1
DATE = "2000-01-01T00:00:00Z"

# Signatures and limits of the ZIP format, the profile of revisits.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_fs(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a URI as Spark writes it (``file:/x``, ``s3a://``, plain absolute paths)."""
    uri = re.sub(r"^file:/+", "/", uri)
    return arrow_fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


# ---- ZIP --------------------------------------------------------------------------------------------------------


class PackageWriter:
    """Streams stored members into a ZIP file; a member's bytes are known when it is added."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.entries = out, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, pieces: list[bytes]) -> None:
        raw, size, crc, start = name.encode(), sum(map(len, pieces)), 0, self.at
        for p in pieces:
            crc = zlib.crc32(p, crc)
        large = self.zip64 or size >= MAX32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if large else b""
        shown = MAX32 if large else size
        self._put(struct.pack("<4s5H3L2H", LOCAL, 45 if large else 20, 0x800, 0, 0, 0x21, crc, shown, shown, len(raw), len(extra)))
        self._put(raw + extra)
        for p in pieces:
            self._put(p)
        self.entries.append((raw, crc, size, start))

    def close(self) -> None:
        begin = self.at
        for raw, crc, size, start in self.entries:
            wide = [x for x in (size, size, start) if self.zip64 or x >= MAX32]
            extra = struct.pack(f"<HH{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            shown = [MAX32 if self.zip64 or x >= MAX32 else x for x in (size, start)]
            head = struct.pack("<4s6H3L", CENTRAL, 45, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, shown[0], shown[0])
            self._put(head + struct.pack("<5H2L", len(raw), len(extra), 0, 0, 0, 0, shown[1]) + raw + extra)
        size, n = self.at - begin, len(self.entries)
        if self.zip64 or n >= MAX16 or begin >= MAX32 or size >= MAX32:
            end64 = self.at
            self._put(struct.pack("<4sQ2H2L4Q", END64, 44, 45, 45, 0, 0, n, n, size, begin))
            self._put(struct.pack("<4sLQL", LOCATOR64, 0, end64, 1))
            n, size, begin = MAX16, MAX32, MAX32
        self._put(struct.pack("<4s4H2LH", END, 0, 0, n, n, size, begin, 0))


def directory(f, size: int) -> Iterator[tuple[str, int, int, int, int]]:
    """(name, method, compressed size, size, offset of the local header) of every member."""
    tail_at = max(0, size - 22 - MAX16)
    tail = f.read_at(size - tail_at, tail_at)
    at = len(tail) - 22
    while at >= 0 and not (tail[at : at + 4] == END and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)):
        at = tail.rfind(END, 0, at + 3) if at > 0 else -1
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    n, length, begin = struct.unpack_from("<H2L", tail, at + 10)
    where = tail_at + at - 20
    locator = f.read_at(20, where) if where >= 0 else b""
    if locator[:4] == LOCATOR64:
        end64 = f.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end record where its locator points")
        n, length, begin = struct.unpack_from("<3Q", end64, 32)
    data, p = f.read_at(length, begin), 0
    for _ in range(n):
        if data[p : p + 4] != CENTRAL:
            raise ValueError("a broken ZIP directory")
        method, (packed, full) = struct.unpack_from("<H", data, p + 10)[0], struct.unpack_from("<2L", data, p + 20)
        name_len, extra_len, note_len = struct.unpack_from("<3H", data, p + 28)
        start = struct.unpack_from("<L", data, p + 42)[0]
        name = data[p + 46 : p + 46 + name_len].decode("utf-8", "replace")
        extra = data[p + 46 + name_len : p + 46 + name_len + extra_len]
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<2H", extra)
            if kind == 1:  # only the fields that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                full = next(wide) if full == MAX32 else full
                packed = next(wide) if packed == MAX32 else packed
                start = next(wide) if start == MAX32 else start
            extra = extra[4 + width :]
        yield name, method, packed, full, start
        p += 46 + name_len + extra_len + note_len


def data_start(f, header: int) -> int:
    """Where a member's bytes begin: its local header has fields of its own lengths."""
    local = f.read_at(30, header)
    if local[:4] != LOCAL:
        raise ValueError("no local header where the ZIP directory points")
    return header + 30 + sum(struct.unpack_from("<2H", local, 26))


# ---- WARC -------------------------------------------------------------------------------------------------------


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(text: str) -> str:
    """Without characters that would end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(kind: str, record_id: str, target: str | None, refers_to: str | None, digest: str, size: int, payload: bytes) -> bytes:
    """A record of a page: the response's block is its HTTP head and payload, the revisit's the head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if target is not None:
        lines.append(f"WARC-Target-URI: {_uri(target)}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    lines += [f"Content-Length: {len(head) + len(payload)}", "", ""]
    return b"".join(["\r\n".join(lines).encode(), head, payload, b"\r\n\r\n"])


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block)."""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    length = int(headers["content-length"])
    return headers, raw[end + 4 : end + 4 + length]


def _unzipped(raw: bytes) -> bytes:
    return zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw


def walk(f, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of every record of a member without an index, offsets within the member."""
    at, end = 0, size
    while at < end:
        begin, first = at, f.read_at(min(1 << 16, end - at), start + at)
        if first[:2] == b"\x1f\x8b":
            unzip = zlib.decompressobj(31)
            while True:
                unzip.decompress(first)
                at += len(first) - len(unzip.unused_data)
                if unzip.eof:
                    break
                first = f.read_at(min(1 << 16, end - at), start + at)
                if not first:
                    raise ValueError("a record ends within its gzip member")
        else:
            while b"\r\n\r\n" not in first and len(first) < end - at:
                first = f.read_at(min(2 * len(first), end - at), start + at)
            cut = first.index(b"\r\n\r\n")
            length = re.search(rb"(?mi)^content-length:\s*(\d+)", first[:cut])
            at += cut + 4 + int(length[1]) + 4
        yield begin, at - begin


# ---- writing ----------------------------------------------------------------------------------------------------

#: ``sha1`` and ``size`` are the payload's, also of a revisit, which carries none
RECORD = ("type", "record_id", "target", "refers_to", "sha1", "size", "payload")


def _write(root: str, package_bytes: int, member_bytes: int, zip64: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_fs(root)
        rows = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in RECORD]))
        first = next(rows, None)
        rows = itertools.chain([first] if first is not None else [], rows)
        while (first := next(rows, None)) is not None:
            fs.create_dir(folder, recursive=True)
            path = f"{folder}/{uuid.uuid4().hex}.zip"
            with fs.open_output_stream(path) as out:
                package, index, n = PackageWriter(out, zip64), [], 0
                member, held, members = [], 0, 0
                for row in itertools.chain([first], rows):
                    kind, record_id, target, refers_to, sha1, size, payload = row
                    digest = base64.b32encode(sha1).decode()
                    raw = record_bytes(kind, record_id, target, refers_to, digest, size, payload or b"")
                    raw = zlib.compress(raw, LEVEL, 31)
                    name = f"archive/data-{members:05d}.warc.gz"
                    line = {"digest": f"sha1:{digest}", "filename": name, "offset": held, "length": len(raw)}
                    index.append(f"{_uri(target or '-')} {re.sub('[^0-9]', '', DATE)} {json.dumps(line)}\n".encode())
                    member.append(raw)
                    held, n = held + len(raw), n + 1
                    if held >= member_bytes:
                        package.add(name, member)
                        member, held, members = [], 0, members + 1
                    if package.at + held >= package_bytes:
                        break
                if member:
                    package.add(name, member)
                package.add("indexes/index.cdxj", index)
                package.close()
            found = f"{root.rstrip('/')}/{path.rsplit('/', 1)[1]}"
            yield pa.RecordBatch.from_arrays([pa.array([found]), pa.array([package.at]), pa.array([n])], ["path", "bytes", "records"])

    return run


def write_packages(
    records: DataFrame, stage: Stage, name: str = "packages", package_bytes: int = PACKAGE, member_bytes: int = MEMBER, zip64: bool = False
) -> DataFrame:
    """Writes ``records`` (columns ``RECORD``) into packages below the stage's folder: ``path, bytes, records``."""
    run = _write(f"{stage.root}/{name}-files", package_bytes, member_bytes, zip64)
    return stage.write(records.select(*RECORD).mapInArrow(run, "path string, bytes long, records long"), name)


# ---- reading ----------------------------------------------------------------------------------------------------


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, where = open_fs(path)
            with fs.open_input_file(where) as f:
                out = []
                for name, method, packed, full, header in directory(f, f.size()):
                    if not name.startswith(("archive/", "indexes/")) or name.endswith("/"):
                        continue
                    if method or packed != full:
                        raise ValueError(f"{path}: {name} is compressed within the package and cannot be read by ranges")
                    out.append((path, name, data_start(f, header), full))
            yield _batch(out, ["path", "name", "start", "size"], [pa.string(), pa.string(), pa.int64(), pa.int64()])


def index_lines(f, start: int, size: int, begin: int, end: int) -> Iterator[bytes]:
    """The lines of a member that begin in ``[begin, end)``."""
    at, left = begin, b""
    if begin:  # a line belongs to the range in which it begins
        at, left = begin - 1, None
    while at < size:
        data = f.read_at(min(1 << 20, size - at), start + at)
        base, at = at, at + len(data)
        if left is None:
            cut = data.find(b"\n")
            if cut < 0:
                if at >= end:
                    return
                continue
            data, base, left = data[cut + 1 :], base + cut + 1, b""
        base -= len(left)
        data = left + data
        lines = data.split(b"\n")
        left = lines.pop()
        for line in lines:
            if base >= end:
                return
            if line:
                yield line
            base += len(line) + 1
        if base >= end:
            return
    if left:
        yield left


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of index members to (path, name, offset, length) a record."""
    for batch in batches:
        for path, start, size, begin, end in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "size", "begin", "end")]):
            fs, where = open_fs(path)
            with fs.open_input_file(where) as f:
                out = []
                for line in index_lines(f, start, size, begin, end):
                    found = json.loads(line[line.index(b" {") :])
                    out.append((path, found["filename"], int(found["offset"]), int(found["length"])))
            yield _batch(out, ["path", "name", "offset", "length"], [pa.string(), pa.string(), pa.int64(), pa.int64()])


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, name, start, size in zip(*[batch.column(c).to_pylist() for c in ("path", "name", "start", "size")]):
            fs, where = open_fs(path)
            with fs.open_input_file(where) as f:
                out = [(path, name, offset, length) for offset, length in walk(f, start, size)]
            yield _batch(out, ["path", "name", "offset", "length"], [pa.string(), pa.string(), pa.int64(), pa.int64()])


READ = {
    "type": pa.string(),
    "record_id": pa.string(),
    "target": pa.string(),
    "refers_to": pa.string(),
    "digest": pa.string(),
    "size": pa.int64(),
    "payload": pa.binary(),
}


def _record(raw: bytes, payloads: bool) -> tuple:
    headers, block = parse_record(_unzipped(raw))
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    bare = lambda name: headers[name].strip("<>") if name in headers else None
    head, _, payload = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        stated = re.search(rb"(?mi)^content-length:\s*(\d+)", head)
        size, payload = int(stated[1]) if stated else None, None
    else:
        size = len(payload)
        if digest and base32_sha1(payload) != digest:
            raise ValueError(f"payload of {headers.get('warc-record-id')} does not have its digest")
    return kind, bare("warc-record-id"), headers.get("warc-target-uri"), bare("warc-refers-to"), digest, size, payload if payloads else None


def _read(payloads: bool):
    """Sorted ranges (path, at, length) to records; adjacent ranges are read together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, f = None, None

        def close(ranges: list[tuple[int, int]]) -> pa.RecordBatch:
            first = ranges[0][0]
            data = f.read_at(ranges[-1][0] + ranges[-1][1] - first, first)
            rows = [_record(data[at - first : at - first + length], payloads) for at, length in ranges]
            return _batch(rows, list(READ), list(READ.values()))

        pending: list[tuple[int, int]] = []
        for batch in batches:
            for path, at, length in zip(*[batch.column(c).to_pylist() for c in ("path", "at", "length")]):
                if pending and (path != opened or at != sum(pending[-1]) or at + length - pending[0][0] > ZONE):
                    yield close(pending)
                    pending = []
                if path != opened:
                    if f is not None:
                        f.close()
                    fs, where = open_fs(path)
                    opened, f = path, fs.open_input_file(where)
                pending.append((at, length))
        if pending:
            yield close(pending)

    return run


def members(packages: DataFrame, stage: Stage) -> DataFrame:
    """``path, name, start, size`` of the archive and index members of ``packages(path)``."""
    n = partitions(packages.sparkSession)
    found = packages.select("path").repartition(n).mapInArrow(_members, "path string, name string, start long, size long")
    return stage.write(found, "members")


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ``packages(path)``: ``type, record_id, target, refers_to, digest, size, payload``.

    ``size`` is the payload's length, for revisits that of the payload they stand for; their ``payload`` is null, and
    everybody's without ``payloads``. Payloads are checked against their digests in any case.
    """
    spark = packages.sparkSession
    stage, n = Stage(spark, "packages"), partitions(spark)
    found = members(packages, stage)
    data, indexes = found.where("name LIKE 'archive/%'"), found.where("name LIKE 'indexes/%'")
    begin = F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(INDEX_RANGE)))
    ranges = indexes.select("path", "start", "size", begin.alias("begin")).withColumn("end", F.col("begin") + INDEX_RANGE)
    ddl = "path string, name string, offset long, length long"
    named = stage.write(ranges.repartition(n, "path", "begin").mapInArrow(_entries, ddl), "entries")
    unnamed = data.join(named.select("path", "name").distinct(), ["path", "name"], "left_anti")
    walked = unnamed.repartition(n, "path", "name").mapInArrow(_walked, ddl)
    located = named.unionByName(walked).join(data, ["path", "name"])
    located = located.select("path", (F.col("start") + F.col("offset")).alias("at"), "length")
    dealt = located.repartition(n, F.col("path"), F.expr(f"at div {ZONE}")).sortWithinPartitions("path", "at")
    schema = "type string, record_id string, target string, refers_to string, digest string, size long, payload binary"
    return dealt.mapInArrow(_read(payloads), schema)


# ---- pages ------------------------------------------------------------------------------------------------------


def page_records(pages: DataFrame, stage: Stage, at_least: int = 0) -> DataFrame:
    """Records of ``pages(page_id, url, html)``: of equal payloads of ``at_least`` bytes the page with the largest id
    is the response (ties: the largest url, then any), others revisit it; smaller payloads are responses all.

    A null html is an empty payload, a null id the smallest. SHA-256 decides equality. Rows are counted per scan
    partition before anything is joined, and a payload leaves a scan partition once, whatever its copies there.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    read = pages.select(F.col("page_id").alias("id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    read = read.withColumn("d", F.unhex(F.sha2("payload", 256)))
    size = F.octet_length("payload").cast("long")
    keyed = read.select(
        "id", "url", "d", F.unhex(F.sha1("payload")).alias("sha1"), size.alias("size"), F.spark_partition_id().alias("part"),
        F.when(size < at_least, F.col("payload")).alias("payload"),
    )
    keys = stage.write(keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n")), "keys")
    best = keys.groupBy("d", "sha1", "size").agg(F.max(F.struct("id", "url", "part")).alias("best"), F.sum("n").alias("rows"))
    best = stage.write(best, "best")

    def name(page: Column, copy: Column) -> Column:
        parts = (F.lit("urn:page"), F.coalesce(page.cast("string"), F.lit("null")), F.lower(F.hex("d")).substr(1, 16), copy)
        return F.concat_ws(":", *parts)

    # every row but its payload's response: mostly revisits
    is_best = F.struct("id", "url", "part").eqNullSafe(F.col("best"))
    others = keys.join(best.where("rows > 1").select("d", "best"), "d")
    others = others.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n") + 1)))
    others = others.where(F.col("copy") <= F.col("n") - F.when(is_best, 1).otherwise(0))
    small = F.col("size") < at_least
    others = others.select(
        F.when(small, "response").otherwise("revisit").alias("type"),
        name(F.col("id"), F.concat_ws(".", "part", F.hex(F.xxhash64("url")), "copy")).alias("record_id"),
        F.col("url").alias("target"),
        F.when(~small, name(F.col("best.id"), F.lit("0"))).alias("refers_to"),
        "sha1",
        "size",
        "payload",
    )
    texts = read.groupBy("d").agg(F.first("payload").alias("payload"))
    responses = best.join(texts, "d").select(
        F.lit("response").alias("type"),
        name(F.col("best.id"), F.lit("0")).alias("record_id"),
        F.col("best.url").alias("target"),
        F.lit(None).cast("string").alias("refers_to"),
        "sha1",
        "size",
        "payload",
    )
    return responses.unionByName(others)


def page_report(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per record that ``page_records`` named: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    page = lambda c: F.nullif(F.split_part(F.col(c), F.lit(":"), F.lit(3)), F.lit("null")).cast(id_type)
    return records.select(
        page("record_id").alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        page("refers_to").alias("refers_to"),
    )
