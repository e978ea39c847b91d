"""Byte ranges of files as rows, for readers that cut a file where Spark's own readers take it whole."""

from __future__ import annotations

import re

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def open_uri(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a URI as Spark names files (``file:/x``, ``file:///x``, ``s3a://``, absolute paths)."""
    uri = re.sub(r"^file:/+", "/", uri)
    return arrow_fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path, length`` of every file below ``path``; no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


def byte_ranges(files: DataFrame, size: int) -> DataFrame:
    """``path, length, begin, end`` for consecutive ranges of at most ``size`` bytes (an empty file has none), dealt
    out by path and place so that the ranges of one file go to many tasks."""
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long")))
    cut = files.where("length > 0").select("path", "length", begin.alias("begin"))
    cut = cut.withColumn("end", F.least(F.col("begin") + size, "length"))
    n = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return cut.repartition(n, "path", "begin")
