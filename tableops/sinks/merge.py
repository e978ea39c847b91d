"""Merges into partitioned Parquet tables that rewrite only the partitions a source touches.

``upsert`` and ``merge_partial`` are functions of the whole target. Here the target stays where it is: the partitions
that hold a source row's key are found, only their files are read and written anew, and they are published by a
dynamic overwrite, so the files of all other partitions are not opened and keep their names. The partition columns
must belong to the key (a store's partition key does): a key then lives in one partition and cannot move.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import merge_partial, one_per_key, upsert
from .writers import clustered


def read_or_none(spark: SparkSession, path: str, part_types: Mapping[str, T.DataType] | None = None) -> DataFrame | None:
    """The Parquet table at ``path``; None before its first write. ``part_types`` are the partition columns' types,
    which folder names alone would only let Spark guess."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    kinds = part_types or {}
    return spark.read.schema(T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found.schema])).parquet(path)


def _partition_name(part_cols: Sequence[str]) -> Column:
    """One text for a row's partition values; a deterministic expression over partition columns only, so a filter on it
    prunes partitions before any file is listed for reading."""
    return F.to_json(F.struct(*part_cols))


def touched_partitions(source: DataFrame, part_cols: Sequence[str]) -> list[str]:
    """The partitions that ``source`` has rows for: as many names as folders are to be rewritten."""
    return [r[0] for r in source.select(*part_cols).distinct().select(_partition_name(part_cols)).collect()]


def merge_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    part_cols: Sequence[str],
    fields: Sequence[str] | None = None,
    newest: Sequence[str] | None = None,
    on_duplicate: str = "error",
    order: Sequence[str] | None = None,
    n: int | None = None,
) -> list[str]:
    """Merge ``source`` into the table at ``path`` (created when missing); returns the partitions rewritten.

    Without ``fields`` a source row replaces the target row of its key; with ``fields`` only those are overwritten
    (see ``upsert``, ``merge_partial``). ``newest``: columns of both sides by which a source row must not be below the
    target row to replace it, so that merging the same rows again, or late rows, changes nothing. ``on_duplicate`` and
    ``order`` say what several source rows of a key mean. NULL keys of whole rows fail the job.

    The job reads the source twice (its partitions, its rows); give it a written table when it is expensive. A hot
    partition is written by several tasks (range-partitioned on the partition columns and the key). Partitions are
    replaced one after another when the job commits: a run that dies there is repeated.
    """
    keys, part_cols = list(keys), list(part_cols)
    loose = [c for c in part_cols if c not in keys]
    if loose:
        raise ValueError(f"partition columns {loose} are not part of the key {keys}")
    touched = touched_partitions(source, part_cols)
    if not touched:
        return []
    target = read_or_none(spark, path, {c: source.schema[c].dataType for c in part_cols})
    target = spark.createDataFrame([], source.schema) if target is None else target.where(_partition_name(part_cols).isin(touched))
    if newest:
        source = _not_below(target, source, keys, list(newest), on_duplicate, order)
        on_duplicate = "error"
    if fields is None:
        merged = upsert(target, source, keys, on_duplicate, order)
    else:
        merged = merge_partial(target, source, keys, fields, on_duplicate, order)
    write = clustered(merged, part_cols, [k for k in keys if k not in part_cols], n).write.mode("overwrite")
    write.option("partitionOverwriteMode", "dynamic").partitionBy(*part_cols).parquet(path)
    return touched


def _not_below(target: DataFrame, source: DataFrame, keys: list[str], newest: list[str], on_duplicate: str, order) -> DataFrame:
    """The source rows, one a key, that are not below the target row of their key by ``newest``."""
    if on_duplicate == "first":
        source = one_per_key(source, keys, order or newest)
    there = target.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*newest).alias("_there"))
    same = [source[k] == there[f"_k_{k}"] for k in keys]
    joined = source.join(there, same, "left")
    return joined.where(F.col("_there").isNull() | (F.struct(*[source[c] for c in newest]) >= F.col("_there"))).select(*source.columns)
