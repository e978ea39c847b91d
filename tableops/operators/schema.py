"""Schema evolution of a table as a projection: add nullable columns, rename, drop, widen types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evolve(
    df: DataFrame,
    add: Mapping[str, str] | None = None,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] | None = None,
    cast: Mapping[str, str] | None = None,
) -> DataFrame:
    """Apply, in order: add (NULL columns of the given type), rename, drop, cast. Unknown names raise."""
    cols = set(df.columns)
    for name in list(rename or {}) + list(drop or []) + list(cast or {}):
        if name not in cols and name not in (add or {}) and name not in (rename or {}).values():
            raise ValueError(f"unknown column {name!r}")
    if add:
        df = df.withColumns({n: F.lit(None).cast(t) for n, t in add.items()})
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    if drop:
        df = df.drop(*drop)
    if cast:
        df = df.withColumns({n: F.col(n).cast(t) for n, t in cast.items()})
    return df
