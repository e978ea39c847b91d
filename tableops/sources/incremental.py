"""High-watermark incremental extraction."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def incremental(df: DataFrame, ts_col: str, prev=None) -> DataFrame:
    """All rows when there is no previous watermark, else rows with ``ts_col > prev`` (strict).

    The comparison is a plain predicate on the scan, so it is pushed into the Parquet reader.
    """
    if prev is None:
        return df
    lit = F.lit(prev)
    if isinstance(prev, dt.datetime):
        lit = lit.cast(df.schema[ts_col].dataType)
    return df.where(F.col(ts_col) > lit)


def next_watermark(df: DataFrame, ts_col: str, prev=None) -> DataFrame:
    """One row ``(watermark)``: the largest ``ts_col`` extracted, or ``prev`` when nothing is new."""
    got = df.agg(F.max(ts_col).alias("watermark"))
    if prev is None:
        return got
    return got.select(F.coalesce("watermark", F.lit(prev).cast(df.schema[ts_col].dataType)).alias("watermark"))
