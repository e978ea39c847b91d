"""Wide <-> long reshaping: regex column selection, month unpivot, pivot with a fixed value list."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: month columns of forecast sheets are named ``mmm-yy``.
MONTH_COLUMN_REGEX = r"[a-zA-Z]{3}-\d{2}"


def columns_matching(df: DataFrame, regex: str) -> list[str]:
    """Column names matching ``regex`` over the whole name, in frame order."""
    pat = re.compile(regex)
    return [c for c in df.columns if pat.fullmatch(c)]


def select_by(df: DataFrame, static: Sequence[str], regex: str = MONTH_COLUMN_REGEX) -> DataFrame:
    """Keep the listed static columns that exist plus every column whose name matches ``regex``."""
    keep = [c for c in static if c in df.columns]
    keep += [c for c in columns_matching(df, regex) if c not in keep]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def unpivot_months(
    df: DataFrame,
    ids: Sequence[str],
    regex: str = MONTH_COLUMN_REGEX,
    var: str = "period",
    value: str = "value",
) -> DataFrame:
    """One row per (ids, month column); NULL cells are kept, as a melt does."""
    months = columns_matching(df, regex)
    if not months:
        raise ValueError(f"no column matches {regex!r}")
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in months], var, value)


def pivot_sum(
    df: DataFrame, keys: Sequence[str], pivot_col: str, value_col: str, values: Sequence
) -> DataFrame:
    """``pivot(sum(value) for pivot_col in (values))``: one column per listed value, NULL where nothing matched.

    One aggregate with a conditional sum per listed value: a single shuffle, and a fixed output schema.
    """
    sums = [F.sum(F.when(F.col(pivot_col) == v, F.col(value_col))).alias(str(v)) for v in values]
    return df.groupBy(*keys).agg(*sums)
