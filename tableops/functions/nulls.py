"""NULL-propagating variants of functions whose Spark versions skip NULLs.

Warehouse ``concat_ws`` and ``greatest`` return NULL when any argument is NULL; Spark skips NULL arguments.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _any_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def concat_ws_strict(sep: str, *cols) -> Column:
    cols = _cols(cols)
    return F.when(_any_null(cols), F.lit(None).cast("string")).otherwise(F.concat_ws(sep, *cols))


def greatest_strict(*cols) -> Column:
    cols = _cols(cols)
    return F.when(_any_null(cols), F.lit(None)).otherwise(F.greatest(*cols))
