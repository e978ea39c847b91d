"""Streaming upserts into a keyed, partitioned table, each micro-batch applied once.

New files reach the table through ``foreachBatch`` and ``merge_partitions``. A ledger beside the checkpoint names the
batches whose merge has been published; a batch that Spark repeats after a failure is skipped when the ledger has it.
When the run died between publishing and writing the ledger, the batch is merged again, which changes nothing: a key's
row is replaced only by a row that is not below it in ``newest``, so the table depends on the rows alone, not on how
they fall into batches or how often one is merged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sinks.merge import merge_partitions


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


class Ledger:
    """Published batches: one small folder each, there once its ``_SUCCESS`` is."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def has(self, batch_id: int) -> bool:
        return _exists(self.spark, f"{self.path}/{batch_id}/_SUCCESS")

    def add(self, batch_id: int, partitions: Sequence[str]) -> None:
        entry = self.spark.createDataFrame([(batch_id, list(partitions))], "batch bigint, partitions array<string>")
        entry.coalesce(1).write.mode("overwrite").json(f"{self.path}/{batch_id}")

    def entries(self) -> DataFrame:
        return self.spark.read.schema("batch bigint, partitions array<string>").json(f"{self.path}/*")


def upsert_new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    part_cols: Sequence[str],
    newest: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
    published: Callable[[int], None] | None = None,
    **options,
) -> int:
    """Merge every file below ``path`` that was not merged before into ``target``; returns the batches merged.

    ``newest`` must order the rows of a key totally. ``published`` is called after a batch's partitions are in place
    and before the ledger knows (monitoring; tests let it fail).
    """
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true").options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(path)
    stream = transform(stream) if transform is not None else stream
    ledger, merged = Ledger(spark, f"{checkpoint.rstrip('/')}-ledger"), []

    def apply(batch: DataFrame, batch_id: int) -> None:
        if ledger.has(batch_id):
            return
        rows = batch.persist()  # read for its partitions and for its rows
        try:
            touched = merge_partitions(
                batch.sparkSession, target, rows, keys, part_cols, newest=newest, on_duplicate="first", order=newest
            )
        finally:
            rows.unpersist()
        if published is not None:
            published(batch_id)
        ledger.add(batch_id, touched)
        merged.append(batch_id)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).outputMode("append")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return len(merged)
