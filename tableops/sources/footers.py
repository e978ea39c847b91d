"""Facts from Parquet footers: the largest values of columns, without reading the columns.

The list of files is the input table; tasks open the files' footers and return the statistics of their row groups, so
a report over a table of any number of rows reads a few kilobytes a file. A row group without usable statistics (older
writers, INT96 timestamps, truncated or missing values) is scanned in the same task, its one column chunk alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranges import list_files, open_uri

FACTS = "path string, column_name string, max_micros long, n_rows long, n_scanned long"


def _micros(column: pa.ChunkedArray | pa.Array) -> int | None:
    """The largest value of a date or timestamp column in microseconds since the epoch."""
    top = pc.max(column.cast(pa.timestamp("us", tz=getattr(column.type, "tz", None)), safe=False))
    return top.cast(pa.int64()).as_py()


def row_group_max(f: pq.ParquetFile, group: int, name: str) -> tuple[int | None, bool]:
    """(largest value in microseconds, whether the column had to be read) of a row group."""
    meta = f.metadata.row_group(group)
    index = next(i for i in range(meta.num_columns) if meta.column(i).path_in_schema == name)
    stats = meta.column(index).statistics
    if stats is not None and stats.has_null_count and stats.null_count == meta.num_rows:
        return None, False
    kind = f.schema_arrow.field(name).type
    if stats is not None and stats.has_min_max:
        top = stats.max_raw if pa.types.is_timestamp(kind) else stats.max
        if pa.types.is_date(kind):
            return _micros(pa.array([top], pa.date32())), False
        if isinstance(top, int):
            return _micros(pa.array([top], pa.int64()).cast(kind)), False
    return _micros(f.read_row_group(group, columns=[name]).column(0)), True


def _facts(columns: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                fs, where = open_uri(path)
                with fs.open_input_file(where) as opened, pq.ParquetFile(opened) as f:
                    for name in columns:
                        if name not in f.schema_arrow.names:
                            continue
                        found = [row_group_max(f, g, name) for g in range(f.metadata.num_row_groups)]
                        known = [x for x, _ in found if x is not None]
                        out.append((path, name, max(known, default=None), f.metadata.num_rows, sum(scanned for _, scanned in found)))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in FACTS.split(", ")]
            columns_out = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns_out, kinds)], names)

    return run


def footer_facts(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Per file below ``path`` and column: ``path, column_name, max_micros, n_rows, n_scanned`` (row groups read)."""
    files = list_files(spark, path, glob="*.parquet").select("path")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return files.repartition(n, "path").mapInArrow(_facts(list(columns)), FACTS)


def latest_by_footers(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row per date or timestamp column of the Parquet table at ``path``: ``column_name, max_ts, n_rows``.

    Equals ``max`` over the column (null when all values are). A column that no file has has no row.
    """
    facts = footer_facts(spark, path, columns)
    top = facts.groupBy("column_name").agg(F.max("max_micros").alias("m"), F.sum("n_rows").alias("n_rows"))
    return top.select("column_name", F.timestamp_micros("m").cast("timestamp_ntz").alias("max_ts"), "n_rows")
