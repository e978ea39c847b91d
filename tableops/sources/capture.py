"""Event-capture files in Avro containers, read in runs of blocks by several tasks.

A container is a header (schema, codec, a random 16-byte marker) and blocks of records, each followed by the marker.
A file is cut into byte ranges; a range has the blocks that follow the markers (or the header) ending in it, so it looks
for the first marker in its bytes and reads blocks until one begins beyond its end. Records come out as Arrow batches
of the capture's fields ``sequence_number, offset, enqueued_at, body``; other fields of the files' schema are stepped
over. Codecs: null and deflate. A damaged block (its marker differs) fails the job.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .ranges import list_files, open_uri

MAGIC, MARK = b"Obj\x01", 16
RANGE = 8 << 20
BATCH = 8192
# The capture's field names, and its schema (header maps left empty by our writer).
FIELDS = {"SequenceNumber": "sequence_number", "Offset": "offset", "EnqueuedTimeUtc": "enqueued_at", "Body": "body"}
SCHEMA = {
    "type": "record",
    "name": "EventData",
    "namespace": "capture",
    "fields": [
        {"name": "SequenceNumber", "type": "long"},
        {"name": "Offset", "type": "string"},
        {"name": "EnqueuedTimeUtc", "type": "string"},
        {"name": "Properties", "type": {"type": "map", "values": ["long", "double", "string", "bytes", "null"]}},
        {"name": "Body", "type": ["null", "bytes"]},
    ],
}
ROW = "sequence_number long, offset string, enqueued_at string, body binary"


class Cursor:
    """Avro's encoding of a few types, at a position in a buffer."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def long(self) -> int:
        shift = value = 0
        while True:
            byte = self.data[self.at]
            self.at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return (value >> 1) ^ -(value & 1)
            shift += 7

    def bytes(self) -> bytes:
        n = self.long()
        self.at += n
        return self.data[self.at - n : self.at]

    def value(self, kind):
        """The next value of a schema type; records as tuples, maps as dicts."""
        if isinstance(kind, list):
            return self.value(kind[self.long()])
        name = kind["type"] if isinstance(kind, dict) else kind
        if isinstance(name, (dict, list)):
            return self.value(name)
        if name in ("long", "int"):
            return self.long()
        if name == "bytes":
            return self.bytes()
        if name == "string":
            return self.bytes().decode()
        if name == "null":
            return None
        if name in ("double", "float"):
            size, code = (8, "<d") if name == "double" else (4, "<f")
            self.at += size
            return struct.unpack_from(code, self.data, self.at - size)[0]
        if name == "boolean":
            self.at += 1
            return self.data[self.at - 1] == 1
        if name == "record":
            return tuple(self.value(f["type"]) for f in kind["fields"])
        if name == "map":
            out = {}
            while n := self.long():
                if n < 0:
                    n, _ = -n, self.long()
                out.update((self.bytes().decode(), self.value(kind["values"])) for _ in range(n))
            return out
        raise ValueError(f"a capture file with a field of type {name!r}")


def _long(n: int) -> bytes:
    n, out = (n << 1) ^ (n >> 63), bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _text(data: bytes) -> bytes:
    return _long(len(data)) + data


class Truncated(ValueError):
    pass


def header(f, size: int) -> tuple[dict, str, bytes, int]:
    """(schema, codec, marker, where the first block begins)."""
    n = 1 << 12
    while True:
        data = f.read_at(min(n, size), 0)
        if data[:4] != MAGIC:
            raise ValueError("not an Avro container")
        cursor = Cursor(data, 4)
        try:
            meta = cursor.value({"type": "map", "values": "bytes"})
            mark = data[cursor.at : cursor.at + MARK]
            if len(mark) == MARK:
                codec = meta.get("avro.codec", b"null").decode()
                if codec not in ("null", "deflate"):
                    raise ValueError(f"a capture file with codec {codec!r}")
                return json.loads(meta["avro.schema"]), codec, mark, cursor.at + MARK
        except IndexError:
            pass
        if n >= size:
            raise Truncated("the container's header does not end")
        n *= 4


def first_block(f, mark: bytes, begin: int, end: int) -> int | None:
    """Where the block after the first marker that begins in ``[begin, end)`` begins."""
    at, left = begin, b""
    while at < end:
        data = left + f.read_at(min(1 << 20, end + MARK - 1 - at), at)
        found = data.find(mark)
        if found >= 0:
            place = at - len(left) + found
            return place + MARK if place < end else None
        at += len(data) - len(left)
        left = data[-(MARK - 1) :]
        if len(data) < MARK:
            return None
    return None


def blocks(f, size: int, begin: int, end: int) -> Iterator[tuple[dict, int, bytes]]:
    """(schema, records, data) of the blocks that belong to the range: those after a marker that begins in it; the
    first block of the file belongs to the range in which the header begins."""
    schema, codec, mark, start = header(f, size)
    at = start if begin == 0 else first_block(f, mark, max(begin, start), end)
    while at is not None and at < size and (at - MARK < end or at == start):
        head = f.read_at(min(20, size - at), at)
        cursor = Cursor(head)
        try:
            n, length = cursor.long(), cursor.long()
        except IndexError:
            raise Truncated("a block's head does not end") from None
        data = f.read_at(length + MARK, at + cursor.at)
        if len(data) < length + MARK or data[length:] != mark:
            raise Truncated("a block does not end with the file's marker")
        yield schema, n, zlib.decompress(data[:length], -15) if codec == "deflate" else data[:length]
        at += cursor.at + length + MARK


class Run(InputPartition):
    def __init__(self, path: str, size: int, begin: int, end: int):
        self.path, self.size, self.begin, self.end = path, size, begin, end


class CaptureReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], step: int):
        self.files, self.step = files, step

    def partitions(self) -> list[Run]:
        return [Run(p, n, b, min(b + self.step, n)) for p, n in self.files for b in range(0, n, self.step)]

    def read(self, run: Run | None) -> Iterator[pa.RecordBatch]:
        if run is None:  # no file, no partition
            return
        names = list(FIELDS.values())
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary()]
        fs, where = open_uri(run.path)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

        with fs.open_input_file(where) as f:
            for schema, n, data in blocks(f, run.size, run.begin, run.end):
                fields = [x["name"] for x in schema["fields"]]
                places = [fields.index(name) for name in FIELDS]
                cursor = Cursor(data)
                for _ in range(n):
                    record = cursor.value(schema)
                    rows.append(tuple(record[p] for p in places))
                if len(rows) >= BATCH:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()


class CaptureSource(DataSource):
    """``spark.read.format("event_capture")`` with options files (JSON of path and length) and range_bytes."""

    @classmethod
    def name(cls) -> str:
        return "event_capture"

    def schema(self) -> str:
        return ROW

    def reader(self, schema) -> CaptureReader:
        return CaptureReader(json.loads(self.options["files"]), int(self.options["range_bytes"]))


def read_capture(spark: SparkSession, path: str, range_bytes: int = RANGE, glob: str = "*.avro") -> DataFrame:
    """The events of the capture files below ``path``: ``sequence_number, offset, enqueued_at, body``."""
    spark.dataSource.register(CaptureSource)
    files = [tuple(r) for r in list_files(spark, path, glob).orderBy("path").collect()]  # the scan's file list
    return spark.read.format("event_capture").options(files=json.dumps(files), range_bytes=range_bytes).load()


def _write(folder: str, codec: str, block_records: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = open_uri(folder)
        name, mark, total, out = f"{uuid.uuid4().hex}.avro", uuid.uuid4().bytes, 0, None
        held: list[bytes] = []

        def block() -> bytes:
            data = b"".join(held)
            if codec == "deflate":
                squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
                data = squeeze.compress(data) + squeeze.flush()
            return _long(len(held)) + _text(data) + mark

        for batch in batches:
            for number, offset, at, body in zip(*[batch.column(c).to_pylist() for c in FIELDS.values()]):
                if out is None:
                    fs.create_dir(where, recursive=True)
                    out = fs.open_output_stream(f"{where}/{name}")
                    meta = _long(2) + _text(b"avro.schema") + _text(json.dumps(SCHEMA).encode())
                    out.write(MAGIC + meta + _text(b"avro.codec") + _text(codec.encode()) + _long(0) + mark)
                value = _long(0) if body is None else _long(1) + _text(body)
                held.append(_long(number) + _text(offset.encode()) + _text(at.encode()) + _long(0) + value)
                total += 1
                if len(held) == block_records:
                    out.write(block())
                    held = []
        if out is not None:
            if held:
                out.write(block())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([total])], ["path", "n"])

    return run


def write_capture(events: DataFrame, folder: str, codec: str = "deflate", block_records: int = 500) -> list[str]:
    """Land ``events`` (columns as ``read_capture`` gives them) as one container a partition; returns the files of the
    tasks that finished. Files of repeated attempts are removed."""
    written = events.select(*FIELDS.values()).mapInArrow(_write(folder, codec, block_records), "path string, n long").collect()
    paths = sorted(r["path"] for r in written)  # one row a file
    fs, where = open_uri(folder)
    if paths:
        kept = {p.rsplit("/", 1)[1] for p in paths}
        for info in fs.get_file_info(FileSelector(where)):
            if info.base_name not in kept:
                fs.delete_file(info.path)
    return paths
