"""Date and timestamp expressions (all return ``Column``; nothing here runs a job).

Spark's own ``datediff``/``months_between`` count whole elapsed units, whereas warehouse ``datediff(unit, a, b)``
counts unit *boundaries crossed*; ``boundary_diff`` gives the latter. Weeks are ISO weeks (Monday first).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Norwegian month abbreviations that differ from English, as they appear in forecast sheets.
MONTH_LABEL_REPLACEMENTS = {"mai": "may", "okt": "oct", "des": "dec"}

# Accepted text formats.
US_TIMESTAMP_FORMAT = "M/d/yyyy h:mm:ss a"
LOOSE_ISO_DATE_FORMAT = "yyyy-M-d"
MONTH_LABEL_FORMAT = "MMM-yy"


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (_dt.date, _dt.datetime)):
        return F.lit(x)
    return F.col(x)


def as_date(x) -> Column:
    """A DATE column from a date, timestamp, timestamp_ntz or ISO text column (or a Python date)."""
    if isinstance(x, str) and not _looks_like_column(x):
        return F.lit(_dt.date.fromisoformat(x))
    return F.to_date(_c(x))


def _looks_like_column(s: str) -> bool:
    return not (len(s) == 10 and s[4] == "-" and s[7] == "-" and s.replace("-", "").isdigit())


def boundary_diff(unit: str, a, b) -> Column:
    """Number of ``unit`` boundaries crossed going from ``a`` to ``b`` (negative when ``b`` is earlier)."""
    a, b = as_date(a), as_date(b)
    unit = unit.lower()
    if unit in ("day", "days", "d"):
        return F.datediff(b, a)
    if unit in ("week", "weeks", "w"):
        return (F.datediff(F.trunc(b, "week"), F.trunc(a, "week")) / 7).cast("int")
    if unit in ("month", "months", "mm"):
        return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))
    if unit in ("quarter", "quarters", "q"):
        return (F.year(b) * 4 + F.quarter(b)) - (F.year(a) * 4 + F.quarter(a))
    if unit in ("year", "years", "y"):
        return F.year(b) - F.year(a)
    raise ValueError(f"unsupported unit {unit!r}")


def first_day_of_week(d) -> Column:
    """Monday on or before ``d``."""
    return F.trunc(as_date(d), "week")


def last_day_of_week(d) -> Column:
    """Sunday on or after ``d`` (``last_day(d, 'week')``)."""
    return F.date_add(F.trunc(as_date(d), "week"), 6)


def previous_monday(d) -> Column:
    """The most recent Monday strictly before ``d`` (``previous_day(d, 'mo')``)."""
    return F.next_day(F.date_sub(as_date(d), 8), "Mon")


def iso_day_of_week(d) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), as_date(d)).cast("int")


def iso_year_of_week(d) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), as_date(d)).cast("int")


def parse_date_any(c, fmts) -> Column:
    """First format that parses wins; unparseable text gives NULL."""
    c = _c(c)
    return F.coalesce(*[F.try_to_date(c, f) for f in fmts])


def parse_event_ts(c) -> Column:
    """Timestamp (no zone) from text in either ``M/d/yyyy h:mm:ss AM`` (chosen when the text holds ``/``) or ISO."""
    c = _c(c)
    us = F.try_to_timestamp(c, F.lit(US_TIMESTAMP_FORMAT))
    iso = F.try_to_timestamp(c)
    return F.when(c.contains("/"), us).otherwise(iso).cast("timestamp_ntz")


def parse_month_label(c) -> Column:
    """``'mai-21'`` / ``'Jan-99'`` -> ``'2021-05'`` / ``'1999-01'``; anything else -> NULL. Two-digit years from 69 on
    are of the last century."""
    c = F.lower(_c(c))
    for src, dst in MONTH_LABEL_REPLACEMENTS.items():
        c = F.replace(c, F.lit(src), F.lit(dst))
    d = F.try_to_date(c, MONTH_LABEL_FORMAT)
    return F.date_format(F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d), "yyyy-MM")


def date_or_monday(c, as_of) -> Column:
    """``c`` if it is a valid ``yyyy-M-d`` date, else the Monday of ``as_of``'s week; as ``yyyy-MM-dd`` text."""
    parsed = F.try_to_date(_c(c), LOOSE_ISO_DATE_FORMAT)
    return F.date_format(F.coalesce(parsed, F.trunc(as_date(as_of), "week")), "yyyy-MM-dd")


def epoch_micros_to_date(c) -> Column:
    return F.to_date(F.timestamp_micros(_c(c)))


def date_path(d) -> Column:
    """``yyyy/MM/dd/`` folder of a date, as used by date-partitioned landing zones."""
    return F.date_format(as_date(d), "yyyy/MM/dd/")


def year_month(d) -> Column:
    return F.date_format(as_date(d), "yyyy-MM")


def unpadded_year_month(d) -> Column:
    """``2024-1`` style label (month not zero-padded)."""
    d = as_date(d)
    return F.concat(F.year(d).cast("string"), F.lit("-"), F.month(d).cast("string"))
