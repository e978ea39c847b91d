"""Small text expressions: composite codes and name normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def code(a, sep: str, b) -> Column:
    """Composite code such as ``<club>p<id>``; NULL when either part is NULL."""
    return F.concat(_c(a).cast("string"), F.lit(sep), _c(b).cast("string"))


def normalise_name(x) -> Column:
    """Lower case with spaces and dots turned into underscores (sheet / metric names)."""
    return F.lower(F.translate(_c(x), " .", "__"))


def normalise_name_py(name: str) -> str:
    """The same rule for column names known on the driver."""
    return name.replace(" ", "_").replace(".", "_").lower()


def last_path_part(x, sep: str = "/") -> Column:
    """Last element of a separated path (``split_part(x, sep, -1)``)."""
    return F.split_part(_c(x), F.lit(sep), F.lit(-1))
