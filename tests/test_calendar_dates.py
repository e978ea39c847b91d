import datetime as dt

from dateutil.easter import easter as py_easter
from pyspark.sql import functions as F

from tableops.functions import dates as D
from tableops.functions.nulls import concat_ws_strict, greatest_strict
from tableops.operators import calendar
from helpers import rows


def test_easter_matches_independent_algorithm(spark):
    years = spark.range(1600, 2400).select(F.col("id").cast("int").alias("y"))
    got = {r.y: r.e for r in years.select("y", calendar.easter("y").alias("e")).collect()}
    assert all(got[y] == py_easter(y) for y in range(1600, 2400))


def test_holidays_and_working_days(spark):
    days = [dt.date(2024, 3, 28), dt.date(2024, 3, 29), dt.date(2024, 3, 31), dt.date(2024, 4, 1),
            dt.date(2024, 5, 1), dt.date(2024, 5, 9), dt.date(2024, 5, 17), dt.date(2024, 5, 20),
            dt.date(2024, 12, 24), dt.date(2024, 4, 2), dt.date(2024, 4, 6)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = dict(rows(calendar.with_holidays(df, "d").select("d", "holiday")))
    assert got[dt.date(2024, 3, 28)] == "Maundy Thursday"
    assert got[dt.date(2024, 3, 29)] == "Good Friday"
    assert got[dt.date(2024, 3, 31)] == "Easter Sunday"
    assert got[dt.date(2024, 4, 1)] == "Easter Monday"
    assert got[dt.date(2024, 5, 1)] == "Labour day"
    assert got[dt.date(2024, 5, 9)] == "Ascension Day"
    assert got[dt.date(2024, 5, 17)] == "Constitution day"
    assert got[dt.date(2024, 5, 20)] == "Whit Monday"
    assert got[dt.date(2024, 12, 24)] == "Christmas eve"
    assert got[dt.date(2024, 4, 2)] is None


def test_date_dimension_span_and_working_day_numbers(spark):
    dates = spark.createDataFrame([(dt.date(2024, 2, 1),), (dt.date(2024, 4, 30),)], "d date")
    dim = calendar.date_dimension(calendar.date_span(dates, "d", out="d"), "d", dt.date(2024, 4, 3))
    assert dim.count() == 90  # 1 Feb .. 30 Apr 2024, 29 Feb included
    r = {x.nk_date: x for x in dim.collect()}
    leap = r[dt.date(2024, 2, 29)]
    assert (leap.day_of_week, leap.week_iso, leap.days_in_month, leap.year_month_name) == (4, 9, 29, "2024-2")
    assert r[dt.date(2024, 4, 3)].reporting_date == "Today"
    assert r[dt.date(2024, 4, 2)].reporting_date == "Yesterday"
    assert r[dt.date(2024, 4, 3)].reporting_month_name == "Current month"
    assert r[dt.date(2024, 3, 15)].reporting_month_name == "Last month"
    # April 2024: 1 Apr is Easter Monday (holiday), so 2 Apr is working day 1
    assert r[dt.date(2024, 4, 1)].working_day_number == 0
    assert r[dt.date(2024, 4, 2)].working_day_number == 1
    assert r[dt.date(2024, 2, 1)].relative_month_position == 2
    assert r[dt.date(2024, 4, 30)].relative_day_position == -27


def test_boundary_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 31), dt.date(2021, 2, 1)), (dt.date(2020, 12, 31), dt.date(2021, 1, 1)),
                                (dt.date(2021, 1, 3), dt.date(2021, 1, 4))], "a date, b date")
    got = df.select(*[D.boundary_diff(u, "a", "b").alias(u) for u in ["day", "week", "month", "quarter", "year"]])
    assert [tuple(r) for r in got.collect()] == [(1, 1, 1, 0, 0), (1, 0, 1, 1, 1), (1, 1, 0, 0, 0)]  # 31 Jan 2021 is a Sunday


def test_week_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 3),)], "d date")
    got = rows(df.select("d", D.previous_monday("d"), D.last_day_of_week("d"), D.first_day_of_week("d")))
    assert got == [
        (dt.date(2024, 1, 1), dt.date(2023, 12, 25), dt.date(2024, 1, 7), dt.date(2024, 1, 1)),
        (dt.date(2024, 1, 3), dt.date(2024, 1, 1), dt.date(2024, 1, 7), dt.date(2024, 1, 1)),
        (dt.date(2024, 1, 7), dt.date(2024, 1, 1), dt.date(2024, 1, 7), dt.date(2024, 1, 1)),
    ]


def test_parsers(spark):
    df = spark.createDataFrame(
        [("3/4/2021 1:02:03 PM", "mai-21", "2021-2-3"), ("2021-03-04T05:06:07", "Des-22", "2021-02-30"),
         ("garbage", "jan-2021", None)],
        "ts string, label string, d string",
    )
    got = df.select(
        D.parse_event_ts("ts").alias("ts"), D.parse_month_label("label").alias("m"),
        D.date_or_monday("d", dt.date(2024, 1, 3)).alias("dm"),
    ).collect()
    assert got[0].ts == dt.datetime(2021, 3, 4, 13, 2, 3) and got[0].m == "2021-05" and got[0].dm == "2021-02-03"
    assert got[1].ts == dt.datetime(2021, 3, 4, 5, 6, 7) and got[1].m == "2022-12" and got[1].dm == "2024-01-01"
    assert got[2].ts is None and got[2].m is None and got[2].dm == "2024-01-01"


def test_range_generators(spark):
    anchor = spark.createDataFrame([(dt.date(2024, 3, 31),)], "as_of date")
    days = [r.period for r in calendar.last_days(anchor, "as_of", 3).collect()]
    assert sorted(days) == [dt.date(2024, 3, 29), dt.date(2024, 3, 30), dt.date(2024, 3, 31)]
    ends = sorted(r.period for r in calendar.month_ends(anchor, "as_of", 3).collect())
    assert ends == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31)]
    weeks = sorted(r.period for r in calendar.week_ends(anchor, "as_of", 2).collect())
    assert weeks == [dt.date(2024, 3, 24), dt.date(2024, 3, 31)]
    start = spark.createDataFrame([(dt.date(2019, 1, 7),)], "s date")
    snaps = sorted(r.snapshot_date for r in calendar.weekly_snapshots(start, "s", 1).collect())
    assert snaps[0] == dt.date(2019, 1, 7) and snaps[-1] == dt.date(2020, 1, 6) and len(snaps) == 53


def test_strict_null_functions(spark):
    df = spark.createDataFrame([("a", "b", 1, 2), ("a", None, 3, None)], "x string, y string, p int, q int")
    got = df.select(concat_ws_strict(".", "x", "y").alias("c"), greatest_strict("p", "q").alias("g")).collect()
    assert (got[0].c, got[0].g) == ("a.b", 2)
    assert (got[1].c, got[1].g) == (None, None)


def test_dimension_range_is_gap_free(spark):
    anchor = spark.createDataFrame([(dt.date(2026, 12, 1),)], "as_of date")
    d = [r.nk_date for r in calendar.dimension_range(anchor, "as_of").collect()]
    assert len(d) == len(set(d)) and max(d) == dt.date(2029, 12, 1)
    assert (max(d) - min(d)).days + 1 == len(d)
    assert dt.date(2028, 2, 29) in d
