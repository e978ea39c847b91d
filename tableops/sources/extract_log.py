"""Incremental extracts with a durable, tie-safe watermark.

``incremental`` takes rows strictly after the last watermark, so a row that arrives late with the watermark's own time
is lost. Here an extract also takes the rows *at* the watermark that no earlier extract has (by their id), and what has
been extracted is what an append-only log says: one entry an extract, created in one step and never overwritten, after
the extract's files are complete. A run that dies leaves files without an entry, which the next run overwrites; two
runs that race cannot both write an entry of one number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import TEXT_TS_OPTIONS


class Extract(NamedTuple):
    number: int
    watermark: str  # as text that casts back to the column's type
    rows: int


class ExtractLog:
    """Extracts below ``path``: data in ``data-<number>``, entries in ``log/<number>.json``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._log = self._path(f"{self.path}/log")
        self._fs = self._log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def data(self, number: int) -> str:
        return f"{self.path}/data-{number}"

    def entries(self) -> list[Extract]:
        """Committed extracts in order: one small entry each."""
        if not self._fs.exists(self._log):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._log)]
        numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))
        paths = [f"{self.path}/log/{n}.json" for n in numbers]
        if not paths:
            return []
        lines = self.spark.read.text(paths).collect()
        return sorted(Extract(**json.loads(r["value"])) for r in lines)

    def commit(self, entry: Extract) -> None:
        """Append an entry; fails when its number has been taken."""
        self._fs.mkdirs(self._log)
        made, final = self._path(f"{self.path}/log/_{uuid.uuid4().hex}"), self._path(f"{self.path}/log/{entry.number}.json")
        out = self._fs.create(made, False)
        out.write(bytearray(json.dumps(entry._asdict()).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(made, final):
            self._fs.delete(made, False)
            raise RuntimeError(f"extract {entry.number} below {self.path} has been committed by another run")

    def read(self, schema) -> DataFrame:
        """All committed extracts, with their ``extract`` number."""
        paths = [self.data(e.number) for e in self.entries()]
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("extract", F.lit(0))
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/data-(\d+)/[^/]*$", 1).cast("int")
        return self.spark.read.schema(schema).options(**TEXT_TS_OPTIONS).json(paths).withColumn("extract", number)


def not_extracted(df: DataFrame, log: ExtractLog, ts_col: str, ids: Sequence[str]) -> DataFrame:
    """Rows of ``df`` after the log's watermark, and those at it that no extract has. A NULL time fails the job: such a
    row would never be after anything."""
    check = F.when(F.col(ts_col).isNull(), F.raise_error(F.lit(f"a row without {ts_col} cannot be extracted by time")))
    checked = df.where(F.coalesce(check.cast("boolean"), F.lit(True)))
    done = log.entries()
    if not done:
        return checked
    mark = F.lit(done[-1].watermark).cast(df.schema[ts_col].dataType)
    tied = [e.number for e in done if e.watermark == done[-1].watermark]  # only these can hold rows at the mark
    had = log.read(df.schema).where(F.col("extract").isin(tied) & (F.col(ts_col) == mark)).select(*ids).distinct()
    late = df.where(F.col(ts_col) == mark).join(had, list(ids), "left_anti").select(*df.columns)
    return checked.where(F.col(ts_col).isNull() | (F.col(ts_col) > mark)).unionByName(late)


def extract_new(df: DataFrame, log: ExtractLog, ts_col: str, ids: Sequence[str]) -> Extract | None:
    """Extract what is new as gzipped JSON lines and commit it; None when nothing is new.

    ``ids`` tell the rows of one time apart. Rows that arrive with a time before the watermark are late beyond what a
    watermark can tell and stay out, as with ``incremental``.
    """
    done = log.entries()
    number = done[-1].number + 1 if done else 1
    new = not_extracted(df, log, ts_col, ids)
    new.write.mode("overwrite").option("compression", "gzip").options(**TEXT_TS_OPTIONS).json(log.data(number))
    written = log.spark.read.schema(df.schema).options(**TEXT_TS_OPTIONS).json(log.data(number))
    top = written.agg(F.max(ts_col).cast("string"), F.count(F.lit(1))).first()
    if not top[1]:
        return None
    entry = Extract(number, top[0], top[1])
    log.commit(entry)
    return entry


