"""Lookup enrichment and weather flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Thresholds of the simplified forecast.
CLOUD_CLEAR_MAX = 50  # cloud_area_fraction above this is not a clear sky
RAIN_MIN = 0.1  # precipitation above this (mm, next hour) counts as rain


def enrich(df: DataFrame, lookup: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Keep rows whose key is in ``lookup`` and attach its columns (inner join; lookup unique per key).

    Whether the lookup is broadcast is left to Spark, which knows its size in bytes at run time.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(lookup, keys, "inner")


def weather_flags(df: DataFrame, cloud: str = "cloud", rain: str = "precipitation") -> DataFrame:
    """``clear_sky`` yes/no and ``precipitation_flag`` yes/no; NULL input gives NULL."""
    return df.withColumns(
        {
            "clear_sky": F.when(F.col(cloud) > CLOUD_CLEAR_MAX, F.lit("no")).when(F.col(cloud).isNotNull(), F.lit("yes")),
            "precipitation_flag": F.when(F.col(rain) > RAIN_MIN, F.lit("yes")).when(F.col(rain).isNotNull(), F.lit("no")),
        }
    )
