"""Date ranges, a date dimension, Easter-based holidays and working-day numbers.

Generators take an *anchor* DataFrame (one row per anchor date, e.g. the latest order date) and expand each
anchor with ``sequence`` + ``explode``; no fixed driver-side list is needed and the plan stays lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import (
    as_date,
    boundary_diff,
    iso_day_of_week,
    iso_year_of_week,
    last_day_of_week,
)

# Holiday labels and their rules, in precedence order (the first rule that matches wins).
# Movable feasts as days after Easter Sunday, then fixed (month, day) dates.
MOVABLE_HOLIDAYS = [
    ("Easter Sunday", 0),
    ("Easter Monday", 1),
    ("Palm Sunday", -7),
    ("Maundy Thursday", -3),
    ("Good Friday", -2),
    ("Ascension Day", 39),
    ("Whit Sunday", 49),
    ("Whit Monday", 50),
]
FIXED_HOLIDAYS = [
    ("New Year's day", 1, 1),
    ("New Year's eve", 12, 31),
    ("Labour day", 5, 1),
    ("Constitution day", 5, 17),
    ("Christmas eve", 12, 24),
    ("Christmas day", 12, 25),
    ("Boxing day", 12, 26),
]


def _idiv(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def easter(year) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous Gregorian algorithm, Meeus/Jones/Butcher)."""
    y = (F.col(year) if isinstance(year, str) else year).cast("int")
    a = F.pmod(y, F.lit(19))
    b = _idiv(y, 100)
    c = F.pmod(y, F.lit(100))
    d = _idiv(b, 4)
    e = F.pmod(b, F.lit(4))
    f = _idiv(b + 8, 25)
    g = _idiv(b - f + 1, 3)
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = _idiv(c, 4)
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = _idiv(a + 11 * h + 22 * l_, 451)
    t = h + l_ - 7 * m + 114
    return F.make_date(y, _idiv(t, 31), F.pmod(t, F.lit(31)) + 1)


def holiday(d, easter_col=None) -> Column:
    """Holiday label of date ``d`` or NULL. Pass ``easter_col`` (that year's Easter Sunday, as a column) to
    compute Easter once per row instead of once per rule."""
    d = as_date(d)
    e = easter(F.year(d)) if easter_col is None else (F.col(easter_col) if isinstance(easter_col, str) else easter_col)
    expr = None
    for label, offset in MOVABLE_HOLIDAYS:
        cond = d == F.date_add(e, offset)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    for label, month, day in FIXED_HOLIDAYS:
        expr = expr.when((F.month(d) == month) & (F.dayofmonth(d) == day), F.lit(label))
    return expr


def is_working_day(d, holiday_col: Column | None = None) -> Column:
    """1 for Monday-Friday that is not a holiday, else 0."""
    hol = holiday(d) if holiday_col is None else holiday_col
    return F.when(hol.isNotNull(), F.lit(0)).when(iso_day_of_week(d) <= 5, F.lit(1)).otherwise(F.lit(0))


def with_holidays(df: DataFrame, date_col: str, label_col: str = "holiday", flag_col: str = "is_working_day") -> DataFrame:
    out = df.withColumn("_easter", easter(F.year(as_date(date_col))))
    out = out.withColumn(label_col, holiday(date_col, "_easter")).drop("_easter")
    return out.withColumn(flag_col, is_working_day(date_col, F.col(label_col)))


def with_working_days(
    df: DataFrame, date_col: str, flag_col: str = "is_working_day", out: str = "working_day_number"
) -> DataFrame:
    """Running count of working days within each calendar month, in date order.

    ``df`` holds one row per date (a dimension), so each month window has at most 31 rows.
    """
    d = as_date(date_col)
    w = (
        Window.partitionBy(F.year(d), F.month(d))
        .orderBy(F.col(date_col))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(out, F.sum(F.col(flag_col)).over(w).cast("int"))


# --- range generators ------------------------------------------------------------------------------------


def _expand(anchor: DataFrame, n: int, make) -> DataFrame:
    i = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_i")
    return anchor.select("*", i).select("*", make(F.col("_i")).alias("period")).drop("_i")


def last_days(anchor: DataFrame, as_of: str, n: int = 365) -> DataFrame:
    """``n`` dates ending at ``as_of`` (included), one row each."""
    return _expand(anchor, n, lambda i: F.date_sub(as_date(as_of), i))


def month_ends(anchor: DataFrame, as_of: str, n: int = 36) -> DataFrame:
    """Last day of the ``n`` months ending with ``as_of``'s month."""
    return _expand(anchor, n, lambda i: F.last_day(F.add_months(as_date(as_of), -i)))


def week_ends(anchor: DataFrame, as_of: str, n: int = 52) -> DataFrame:
    """Sunday of the ``n`` ISO weeks ending with ``as_of``'s week."""
    return _expand(anchor, n, lambda i: last_day_of_week(F.date_sub(as_date(as_of), i * 7)))


def weekly_snapshots(anchor: DataFrame, start: str, years: int = 10, out: str = "snapshot_date") -> DataFrame:
    """Every Monday from ``start`` to ``start + years`` (both inclusive)."""
    s = as_date(start)
    first_monday = F.when(iso_day_of_week(s) == 1, s).otherwise(F.next_day(s, "Mon"))
    stop = F.add_months(s, 12 * years)
    days = F.sequence(first_monday, stop, F.expr("INTERVAL 7 DAYS"))
    return anchor.select("*", F.explode(days).alias(out))


def dimension_range(anchor: DataFrame, as_of: str, days: int = 10_000, years_ahead: int = 3, out: str = "nk_date") -> DataFrame:
    """Dates for a dimension table: the ``days`` days ending at ``as_of``, moved ``years_ahead`` years forward.

    Generated as one gap-free ``sequence`` between the moved end points. Moving each day separately (the
    warehouse recipe) maps 29 Feb onto 28 Feb, repeating one day and dropping the leap day; the range here has
    every calendar day exactly once.
    """
    end = F.add_months(as_date(as_of), 12 * years_ahead)
    start = F.add_months(F.date_sub(as_date(as_of), days - 1), 12 * years_ahead)
    return anchor.select("*", F.explode(F.sequence(start, end)).alias(out))


def date_span(df: DataFrame, col: str, out: str = "nk_date") -> DataFrame:
    """Every date from the smallest to the largest value of ``col`` (gap-free)."""
    bounds = df.agg(F.min(as_date(col)).alias("_lo"), F.max(as_date(col)).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi")).alias(out))


# --- date dimension --------------------------------------------------------------------------------------


def date_dimension(dates: DataFrame, date_col: str, as_of) -> DataFrame:
    """Calendar attributes for each (distinct) date in ``dates``, relative to ``as_of``.

    Relative positions count boundaries from the date to ``as_of`` (the past is positive). Week numbers are
    ISO. ``holiday``/``is_working_day``/``working_day_number`` follow the holiday calendar above.
    """
    today = as_date(as_of)
    df = dates.select(as_date(date_col).alias("nk_date"))
    d = F.col("nk_date")
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    week_iso = F.weekofyear(d)
    first_of_week = F.trunc(d, "week")
    cols = {
        "date_number": (year * 10000 + month * 100 + F.dayofmonth(d)).cast("int"),
        "day_month_number": F.dayofmonth(d),
        "week_number": week_iso,
        "month_number": month,
        "year_number": year,
        "quarter_number": quarter,
        "day_of_week": iso_day_of_week(d),
        "year_of_week": iso_year_of_week(d),
        "first_day_of_month": F.trunc(d, "month"),
        "last_day_of_month": F.last_day(d),
        "first_day_of_week": first_of_week,
        "last_day_of_week": F.date_add(first_of_week, 6),
        "week_of_year": week_iso,
        "week_iso": week_iso,
        "days_in_month": F.dayofmonth(F.last_day(d)),
        "days_in_week": F.lit(7),
        "year_month_number": year * 100 + month,
        "year_month_name": F.concat(year.cast("string"), F.lit("-"), month.cast("string")),
        "relative_day_position": boundary_diff("day", d, today),
        "relative_month_position": boundary_diff("month", d, today),
        "relative_quarter_position": boundary_diff("quarter", d, today),
        "relative_year_position": boundary_diff("year", d, today),
        "relative_week_position": boundary_diff("week", d, today),
        "year_name": year.cast("string"),
        "week_name": F.concat(F.lit("W "), week_iso.cast("string")),
        "year_week_name": F.concat(iso_year_of_week(d).cast("string"), F.lit("-"), week_iso.cast("string")),
        "quarter_name": F.concat(F.lit("Q"), quarter.cast("string")),
        "year_quarter_name": F.concat(F.lit("Q"), quarter.cast("string"), F.right(year.cast("string"), F.lit(2))),
    }
    df = df.select("nk_date", *[c.cast("int").alias(k) if k in _INT_COLS else c.alias(k) for k, c in cols.items()])
    df = with_holidays(df, "nk_date")
    df = with_working_days(df, "nk_date")
    this_month = F.trunc(today, "month")
    month_of = F.trunc(F.col("nk_date"), "month")
    df = df.withColumn(
        "reporting_month_name",
        F.when(month_of == this_month, F.lit("Current month"))
        .when(month_of == F.add_months(this_month, -1), F.lit("Last month"))
        .otherwise(F.col("year_month_name")),
    ).withColumn(
        "reporting_date",
        F.when(F.col("nk_date") == today, F.lit("Today"))
        .when(F.col("nk_date") == F.date_sub(today, 1), F.lit("Yesterday"))
        .otherwise(F.date_format("nk_date", "yyyy-MM-dd")),
    )
    return df


_INT_COLS = {
    "day_month_number", "week_number", "month_number", "year_number", "quarter_number", "day_of_week",
    "year_of_week", "week_of_year", "week_iso", "days_in_month", "days_in_week", "year_month_number",
    "relative_day_position", "relative_month_position", "relative_quarter_position", "relative_year_position",
    "relative_week_position",
}
