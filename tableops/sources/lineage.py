"""Lineage columns for loaded rows: source file, row number within the file, load time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_lineage(
    df: DataFrame,
    loaded_at: dt.datetime | None = None,
    row_number: bool = True,
    file_col: str = "etl_metadata_filename",
    row_col: str = "etl_metadata_file_row_number",
    time_col: str = "etl_created_timestamp_utc",
) -> DataFrame:
    """Add the source file path, the 1-based row number within that file and the load timestamp.

    ``df`` must come straight from a file scan (it reads ``_metadata``). Parquet gives the row position
    directly (``row_index``). For other formats a row's number is its place in its block of the file plus the rows of
    the file's earlier blocks: one small aggregate row per block, so rows are neither sorted nor gathered per file.
    ``loaded_at`` defaults to the query's ``current_timestamp()``; pass it to make a load reproducible.
    """
    meta = df.select("_metadata.*").columns
    ts = F.lit(loaded_at).cast("timestamp") if loaded_at is not None else F.current_timestamp()
    out = df.withColumn(file_col, F.col("_metadata.file_path")).withColumn(time_col, ts)
    if not row_number:
        return out
    if "row_index" in meta:
        return out.withColumn(row_col, (F.col("_metadata.row_index") + 1).cast("long"))
    # a task reads the rows of a block one after another, so their ids there are consecutive
    out = out.withColumns({"_block": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id()})
    blocks = out.groupBy(file_col, "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(file_col).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    number = F.col("_row") - F.col("_first") + F.col("_off") + 1
    return out.join(blocks.drop("_n"), [file_col, "_block"]).withColumn(row_col, number.cast("long")).drop("_block", "_row", "_first", "_off")
