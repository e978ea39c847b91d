"""Helpers shared by the training-data operators: written intermediate tables and row keys."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, read_table, remove_path


class Stage:
    """A folder of written tables below ``spark.checkpoint.dir``, shared by driver and executors.

    ``write`` stores a DataFrame as Parquet and reads it back: lineage is cut, a lost executor costs at most the
    tasks of the running job, and later plans see the true size of the table. ``drop`` removes a table once
    everything made from it has been written; what is left goes when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        atexit.register(remove_path, spark, self.root)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_path(self.spark, f"{self.root}/{name}")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def text_of(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column (in any case) has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
