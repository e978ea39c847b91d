"""Keyed batch loads that are checked when they commit.

The rows of a batch plan (``quality.batch_plan``) go to a store in calls of one batch each, and the store says how many
rows it took. Tasks return what they planned and what was written as commit messages; the driver reconciles them with
the plan's totals when the job commits, without reading anything back. Any difference aborts the load, and nothing of
it is visible: the files lie in a staging folder that only a successful commit renames, in one step, to
``<path>/load=<id>``. Attempts of tasks that failed or were repeated leave files that no message names; they go too.

Messages are small whatever the load: totals, and the first differing batches of a task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..sources.ranges import open_uri

#: Differing batches that a task names.
NAMED = 10


class ParquetStore:
    """Takes batches into one Parquet file of the task."""

    def __init__(self, folder: str, task: int):
        self.fs, self.folder = open_uri(folder)
        self.name, self.writer = f"part-{task:05d}-{uuid.uuid4().hex}.parquet", None

    def put(self, key: tuple, batch: int, rows: pa.Table) -> int:
        """Store one batch; returns the rows taken."""
        if self.writer is None:
            self.fs.create_dir(self.folder, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}")
            self.writer = pq.ParquetWriter(self.out, rows.schema)
        self.writer.write_table(rows)
        return rows.num_rows

    def close(self) -> None:
        if self.writer is not None:
            self.writer.close()
            self.out.close()


@dataclass
class Written(WriterCommitMessage):
    file: str | None = None
    batches: int = 0
    rows: int = 0
    differing: list[tuple] = field(default_factory=list)  # (key, batch, planned, written)


def batches_of(arriving: Iterator[pa.RecordBatch], by: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal ``by``, from sorted rows; a run may cross Arrow batches."""
    current, held = None, []
    for got in arriving:
        columns = [got.column(c).to_pylist() for c in by]
        start = 0
        for i, key in enumerate(zip(*columns)):
            if held or i > start:
                if key != current:
                    if i > start:
                        held.append(got.slice(start, i - start))
                    yield current, pa.Table.from_batches(held)
                    held, start = [], i
            current = key
        if got.num_rows > start:
            held.append(got.slice(start))
    if held:
        yield current, pa.Table.from_batches(held)


class KeyedBatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, store):
        self.path, self.staging = options["path"].rstrip("/"), f"_staging-{uuid.uuid4().hex}"
        self.by = [*options["keys"].split(","), options["batch_col"]]
        self.expected = int(options["batches"]), int(options["rows"])
        self.load, self.store = options["load"], store

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store = self.store(f"{self.path}/{self.staging}", TaskContext.get().partitionId())
        said = Written()
        for key, rows in batches_of(iterator, self.by):
            written = store.put(key[:-1], key[-1], rows)
            said.batches += 1
            said.rows += written
            if written != rows.num_rows and len(said.differing) < NAMED:
                said.differing.append((*key, rows.num_rows, written))
        store.close()
        said.file = store.name if said.batches else None
        return said

    def commit(self, messages: list[Written | None]) -> None:
        said = [m for m in messages if m is not None]
        differing = [d for m in said for d in m.differing][:NAMED]
        total = sum(m.batches for m in said), sum(m.rows for m in said)
        if differing or total != self.expected:
            named = ", ".join(f"{dict(zip(self.by, d))}: {d[-2]} planned, {d[-1]} written" for d in differing)
            raise ValueError(f"load of {self.expected} (batches, rows) wrote {total}; differing batches: {named or 'none of those written'}")
        fs, root = open_uri(self.path)
        files = {m.file for m in said}
        if any(files):
            for info in fs.get_file_info(FileSelector(f"{root}/{self.staging}")):
                if info.base_name not in files:
                    fs.delete_file(info.path)
            fs.move(f"{root}/{self.staging}", f"{root}/load={self.load}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = open_uri(self.path)
        if fs.get_file_info(f"{root}/{self.staging}").type == FileType.Directory:
            fs.delete_dir(f"{root}/{self.staging}")


class KeyedBatchSink(DataSource):
    """``df.write.format("keyed_batches")`` with options path, keys, batch_col, batches, rows, load."""

    store = ParquetStore

    @classmethod
    def name(cls) -> str:
        return "keyed_batches"

    def writer(self, schema, overwrite: bool) -> KeyedBatchWriter:
        return KeyedBatchWriter(self.options, self.store)


def write_batches(
    plan: DataFrame, path: str, keys: Sequence[str], load: str, batch_col: str = "batch", sink: type[KeyedBatchSink] = KeyedBatchSink
) -> None:
    """Load a batch plan (a written table: it is read for its totals and for its rows) into ``<path>/load=<load>``.

    Every batch goes to one task, as the plan bounds its size; a hot key's batches go to all tasks.
    """
    spark = plan.sparkSession
    spark.dataSource.register(sink)
    by = [*keys, batch_col]
    totals = plan.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    write = plan.repartition(n, *by).sortWithinPartitions(*by).write.format(sink.name()).mode("append")
    options = {"path": path, "keys": ",".join(keys), "batch_col": batch_col, "load": load, "batches": totals[0], "rows": totals[1]}
    write.options(**options).save()
