"""Large JSON array files read by many tasks.

Spark reads a file that holds one array (``multiLine``) in one task. Here a file is cut into byte ranges. What a range
does to the reader's state is a function of the state before it: outside a string, in one, or in one after a backslash.
A first pass writes that function for every range (the state after it and the change of the nesting depth, from each
of the three states); the functions compose associatively, so one pass over these tiny rows in order tells every range
its state and depth. In the second pass a range knows which of its commas separate elements of the outer array and
returns the elements that *begin* in it, reading on past its end for the last one. Elements come out as text and are
parsed by ``from_json`` in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .ranges import byte_ranges, list_files, open_uri

RANGE = 8 << 20
OUTSIDE, INSIDE, ESCAPED = range(3)
QUOTE, BACKSLASH, COMMA = b'"\\,'
OPENING, CLOSING = b"[{", b"]}"


def _strings(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """(whether each byte is outside strings, the state after the last byte). A closing quote counts as outside, an
    opening one as inside; neither matters to brackets and commas."""
    at = np.arange(len(data), dtype=np.int32)
    back = data == BACKSLASH
    # an odd number of backslashes before a byte escapes it; the state before the range lengthens the first run
    run_start = np.maximum.accumulate(np.where(back, np.int32(-1), at))
    before = np.empty(len(data), np.int32)
    before[0] = state == ESCAPED
    run = at - run_start
    run[run_start < 0] += state == ESCAPED
    before[1:] = np.where(back[:-1], run[:-1], 0)
    quotes = (data == QUOTE) & (before % 2 == 0)
    inside = (np.cumsum(quotes, dtype=np.int32) + (state != OUTSIDE)) % 2 == 1
    if not inside[-1]:
        return ~inside, OUTSIDE
    return ~inside, ESCAPED if back[-1] and run[-1] % 2 == 1 else INSIDE


def _depths(data: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """+1 and -1 where brackets outside strings open and close."""
    step = np.isin(data, list(OPENING)).astype(np.int8) - np.isin(data, list(CLOSING)).astype(np.int8)
    return np.where(outside, step, np.int8(0))


def effect(data: bytes, state: int) -> tuple[int, int]:
    """(state after, change of depth) of a range read from ``state``."""
    if not data:
        return state, 0
    raw = np.frombuffer(data, np.uint8)
    outside, after = _strings(raw, state)
    return after, int(_depths(raw, outside).sum())


def separators(data: bytes, state: int, depth: int) -> tuple[np.ndarray, int, int]:
    """(positions of the outer array's opening bracket, commas and closing bracket, state after, depth after)."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, np.int64), state, depth
    outside, after = _strings(raw, state)
    step = _depths(raw, outside)
    level = depth + np.cumsum(step, dtype=np.int64)
    marks = outside & (raw == COMMA) & (level == 1) | (step > 0) & (level == 1) | (step < 0) & (level == 0)
    return np.flatnonzero(marks), after, int(level[-1])


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path, length, begin, end in zip(*[batch.column(c).to_pylist() for c in ("path", "length", "begin", "end")]):
            fs, where = open_uri(path)
            with fs.open_input_file(where) as f:
                data = f.read_at(end - begin, begin)
            each = [effect(data, s) for s in (OUTSIDE, INSIDE, ESCAPED)]
            out.append((path, length, begin, end, [e[0] for e in each], [e[1] for e in each]))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        yield _batch(out, ["path", "length", "begin", "end", "after", "change"], kinds)


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges sorted by file and place, with the state and depth before each."""
    current, state, depth = None, OUTSIDE, 0

    def check() -> None:
        if current is not None and (state != OUTSIDE or depth):
            raise ValueError(f"{current}: the array does not end")

    for batch in batches:
        out = []
        for path, length, begin, end, after, change in zip(*[c.to_pylist() for c in batch.columns]):
            if path != current:
                check()
                current, state, depth = path, OUTSIDE, 0
            out.append((path, length, begin, end, state, depth))
            state, depth = after[state], depth + change[state]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        yield _batch(out, ["path", "length", "begin", "end", "state", "depth"], kinds)
    check()


def elements(f, begin: int, end: int, size: int, state: int, depth: int, step: int = RANGE) -> Iterator[bytes]:
    """The elements of the outer array whose opening bracket or comma lies in ``[begin, end)`` of the open file ``f``."""
    held: list[bytes] | None = None  # pieces of the element being read; none while it began in an earlier range
    at, tail = begin, 1 << 12
    while at < size:
        if at < end:
            limit = min(end, at + step)
        else:
            tail = min(2 * tail, step)
            limit = min(size, at + tail)
        data, start = f.read_at(limit - at, at), 0
        marks, state, depth = separators(data, state, depth)
        for p in marks.tolist():
            if held is not None:
                held.append(data[start:p])
                text = b"".join(held).strip()
                if text or data[p] == COMMA:
                    yield text
            if data[p] in CLOSING:
                held = None
                continue
            if data[p] == OPENING[1]:
                raise ValueError("an object where an array is expected")
            if at + p >= end:
                return
            held, start = [], p + 1
        at += len(data)
        if held is not None:
            held.append(data[start:])
        elif at >= end:
            return
    if held is not None:
        raise ValueError("the array does not end")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(texts: list[tuple]) -> pa.RecordBatch:
        return _batch(texts, ["path", "value"], [pa.string(), pa.binary()])

    for batch in batches:
        for path, length, begin, end, state, depth in zip(*[c.to_pylist() for c in batch.columns]):
            fs, where = open_uri(path)
            with fs.open_input_file(where) as f:
                out, held = [], 0
                for text in elements(f, begin, end, length, state, depth):
                    out.append((path, text))
                    held += len(text)
                    if held >= RANGE:
                        yield batch_of(out)
                        out, held = [], 0
            yield batch_of(out)


def split_array_text(files: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """``path, value``: every element of the array ``files(path, length)`` as text, read in ranges of ``range_bytes``.

    Files are UTF-8 and not compressed. A file that ends within its array, a string or an element fails the job.
    """
    spark = files.sparkSession
    folder = scratch_path(spark, "array-ranges")
    schema = "path string, length long, begin long, end long, after array<int>, change array<long>"
    byte_ranges(files, range_bytes).mapInArrow(_effects, schema).write.parquet(folder)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = spark.read.schema(schema).parquet(folder).repartition(n, "path").sortWithinPartitions("path", "begin")
    starts = ordered.mapInArrow(_starts, "path string, length long, begin long, end long, state int, depth long")
    found = starts.repartition(n, "path", "begin").mapInArrow(_elements, "path string, value binary")
    return found.select("path", F.decode("value", "UTF-8").alias("value"))


def read_large_json_array(
    spark: SparkSession, path: str, schema: T.StructType | str, range_bytes: int = RANGE, compressed: str = r"\.(gz|bz2|zst|lz4|snappy)$"
) -> DataFrame:
    """Files holding one JSON array each, as ``read_json_array`` gives them, large files read by many tasks.

    Compressed files (names like ``compressed``) cannot be cut and go through Spark's reader, one task each. Elements
    that are no objects have nulls, a null element too.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = split_array_text(list_files(spark, path).where(~F.col("path").rlike(compressed)), range_bytes)
    rows = text.select(F.from_json("value", schema).alias("_v")).select("_v.*")
    whole = spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").json(path)
    return rows.unionByName(whole.where(F.col("_metadata.file_name").rlike(compressed)))
