"""The composite jobs, wired to the benchmark tables.

Each ``q_<name>(spark, sf_dir)`` reads the parquet tables under ``sf_dir`` and returns a lazy DataFrame (a few
operators run a small action by contract, e.g. to pin a range partitioning). Every computed column carries an
explicit alias and type so that results compare column-for-column with the SQL in ``oracle.py``.

Mapping of reference shapes onto the tables (the reference's own tables are warehouse-internal):

* spenders / contacts -> ``orders`` x ``customer`` x ``nation``; activity events -> ``events``
* employee-team validity rows -> ``orders`` per customer (open = status not F)
* access log and query history -> derived from ``events`` (``access_log`` / ``query_history`` below)
* forecast sheets -> monthly order value per customer, pivoted to ``mmm-yy`` columns
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    boundary_diff,
    code,
    concat_ws_strict,
    date_or_monday,
    date_path,
    epoch_micros_to_date,
    iso_day_of_week,
    iso_year_of_week,
    last_day_of_week,
    last_path_part,
    normalise_name,
    parse_date_any,
    parse_event_ts,
    parse_month_label,
    previous_monday,
    try_number,
    year_month,
)
from ..operators import audit, calendar, enrich, ordered, quality, reshape, schema, semistructured, upsert
from ..operators.ranking import top_percent
from ..session import Tables
from ..sources import catalog_columns, catalog_tables

AS_OF = dt.date(2001, 8, 1)  # fixed "today" for the order tables (last order date)
EVENTS_AS_OF = dt.date(2024, 1, 31)  # fixed "today" for the January 2024 event log
MONEY = "decimal(18,2)"


def money_sum(c) -> Column:
    """Exact sum of a 2-decimal money column, returned as double.

    Each value is rounded to cents exactly as ``cast(.. as decimal(18,2))`` does, and the cents are summed as
    ``bigint``: a sum of ``decimal(18,2)`` widens to a 28-digit buffer that no longer fits a long and adds
    through per-row big-decimal objects (about 2x slower here). Overflow of the long (beyond about 9e16 currency
    units in one group) fails the job under the session's ANSI mode instead of wrapping.
    """
    col = F.col(c) if isinstance(c, str) else c
    cents = (col.cast(MONEY) * 100).cast("bigint")
    return (F.sum(cents).cast("decimal(38,0)") / 100).cast("double")


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# --- ranking / duplicates / pivot (C17 C18 C19) --------------------------------------------------------


def q_top_percent(spark, sf_dir, pct: float = 0.10) -> DataFrame:
    """Top spenders of the last 12 months: dense rank by spend, keep rank < max_rank * pct. Tenure counts from the
    customer's first order of all, so one aggregate over all orders gives both."""
    t = _t(spark, sf_dir)
    since = F.lit(dt.datetime.combine(AS_OF.replace(year=AS_OF.year - 1), dt.time()))
    recent = F.col("o_orderdate") >= since.cast("timestamp_ntz")
    sales = (
        t.orders.groupBy("o_custkey")
        .agg(
            money_sum(F.when(recent, F.col("o_totalprice"))).alias("total_spent"),
            F.min("o_orderdate").alias("first_order"),
            F.count_if(recent).alias("_recent"),
        )
        .where(F.col("_recent") > 0)
    )
    members = t.customer.where(F.col("c_name").startswith("Customer#"))
    joined = sales.join(members, sales.o_custkey == members.c_custkey).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    ranked = top_percent(joined, "total_spent", pct, rank_col="rank", max_col="max_rank")
    return ranked.select(
        F.col("rank").cast("long").alias("rank"),
        F.expr("substring(c_name, 10)").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        boundary_diff("year", "first_order", AS_OF).cast("int").alias("tenure_years"),
        "total_spent",
        F.col("max_rank").cast("long").alias("max_rank"),
    )


def q_duplicate_rows(spark, sf_dir) -> DataFrame:
    """Line items whose (order, line number) key is not unique."""
    t = _t(spark, sf_dir)
    return quality.duplicate_rows(t.lineitem, ["l_orderkey", "l_linenumber"], count_col="dup_count")


PIVOT_TYPES = ["click", "view", "purchase"]


def q_pivot_counts(spark, sf_dir) -> DataFrame:
    """Event counts per user and type, pivoted over a fixed type list (missing -> NULL)."""
    t = _t(spark, sf_dir)
    counted = t.events.select("user_id", "event_type", F.col("event_id").isNotNull().cast("long").alias("cnt"))
    return reshape.pivot_sum(counted, ["user_id"], "event_type", "cnt", PIVOT_TYPES)


PIVOT_PART_TYPES = ["ECONOMY", "SMALL", "PROMO"]


def q_pivot_joined(spark, sf_dir) -> DataFrame:
    """Line items per supplier and part type (looked up in the part dimension), pivoted over a fixed type list."""
    t = _t(spark, sf_dir)
    facts = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    counted = facts.select("l_suppkey", "p_type", F.col("l_orderkey").isNotNull().cast("long").alias("cnt"))
    return reshape.pivot_sum(counted, ["l_suppkey"], "p_type", "cnt", PIVOT_PART_TYPES)


# --- date ranges and the date dimension (C14 C15 C16) --------------------------------------------------


def _daily_orders(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.count(F.lit(1)).alias("n_orders"), money_sum("o_totalprice").alias("revenue")
    )


def _with_order_totals(periods: DataFrame, totals: DataFrame, on: Column) -> DataFrame:
    j = periods.join(totals, on, "left")
    return j.select(
        "period",
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("n_orders"),
        F.coalesce(F.col("revenue"), F.lit(0.0)).alias("revenue"),
    )


# A report over a range starts from its anchor date: an argument, or else one row read ahead. The range is then a
# filter on the raw date column, which reaches the scan, so only the row groups of the range are read.


def _anchor(t: Tables, as_of: dt.date | None, first: bool = False) -> dt.date:
    """``as_of``, or else the latest (``first``: earliest) order day."""
    if as_of is None:
        d = t.orders.agg((F.min if first else F.max)("o_orderdate")).first()[0]
        as_of = d.date() if isinstance(d, dt.datetime) else d
    return as_of


def _orders_between(t: Tables, first: dt.date, last: dt.date) -> DataFrame:
    """Orders from the day ``first`` to the day ``last``."""
    at = lambda d: F.lit(dt.datetime.combine(d, dt.time())).cast("timestamp_ntz")
    return t.orders.where((F.col("o_orderdate") >= at(first)) & (F.col("o_orderdate") < at(last + dt.timedelta(days=1))))


def _one(spark, as_of: dt.date) -> DataFrame:
    return spark.range(1).select(F.lit(as_of).alias("as_of"))


def _period_orders(orders: DataFrame, period: Column) -> DataFrame:
    return orders.groupBy(period.alias("p")).agg(
        F.count(F.lit(1)).alias("n_orders"), money_sum("o_totalprice").alias("revenue")
    )


def q_last_days(spark, sf_dir, n: int = 365, as_of: dt.date | None = None) -> DataFrame:
    """The last ``n`` days up to ``as_of`` (default: the latest order day), with that day's order count and revenue."""
    t = _t(spark, sf_dir)
    as_of = _anchor(t, as_of)
    daily = _period_orders(_orders_between(t, as_of - dt.timedelta(days=n - 1), as_of), F.to_date("o_orderdate"))
    days = calendar.last_days(_one(spark, as_of), "as_of", n).select("period")
    return _with_order_totals(days, daily, days.period == daily.p)


def q_month_ends(spark, sf_dir, n: int = 36, as_of: dt.date | None = None) -> DataFrame:
    """Month ends of the last ``n`` months up to ``as_of`` (default: the latest order day), with that month's orders."""
    t = _t(spark, sf_dir)
    as_of = _anchor(t, as_of)
    month = as_of.year * 12 + as_of.month - n  # months since year 0, of the earliest month
    first = dt.date(month // 12, month % 12 + 1, 1)
    last = (as_of.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    monthly = _period_orders(_orders_between(t, first, last), F.last_day(F.to_date("o_orderdate")))
    ends = calendar.month_ends(_one(spark, as_of), "as_of", n).select("period")
    return _with_order_totals(ends, monthly, ends.period == monthly.p)


def q_week_ends(spark, sf_dir, n: int = 52, as_of: dt.date | None = None) -> DataFrame:
    """Week ends (Sundays) of the last ``n`` ISO weeks up to ``as_of`` (default: the latest order day), with that
    week's orders."""
    t = _t(spark, sf_dir)
    as_of = _anchor(t, as_of)
    sunday = as_of + dt.timedelta(days=7 - as_of.isoweekday())
    weekly = _period_orders(_orders_between(t, sunday - dt.timedelta(days=7 * n - 1), sunday), last_day_of_week("o_orderdate"))
    ends = calendar.week_ends(_one(spark, as_of), "as_of", n).select("period")
    return _with_order_totals(ends, weekly, ends.period == weekly.p)


def q_weekly_snapshots(spark, sf_dir, years: int = 10, start: dt.date | None = None) -> DataFrame:
    """Mondays over ``years`` years from ``start`` (default: the first order day), with the orders of each snapshot
    week."""
    t = _t(spark, sf_dir)
    start = _anchor(t, start, first=True)
    stop = start + dt.timedelta(days=366 * years + 7)  # no snapshot week ends later
    weekly = _period_orders(_orders_between(t, start - dt.timedelta(days=7), stop), F.trunc(F.to_date("o_orderdate"), "week"))
    snaps = calendar.weekly_snapshots(_one(spark, start), "as_of", years, out="snapshot_date").select("snapshot_date")
    j = snaps.join(weekly, snaps.snapshot_date == weekly.p, "left")
    return j.select("snapshot_date", F.coalesce("n_orders", F.lit(0)).cast("long").alias("n_orders"))


def q_dimension_orders(spark, sf_dir, days: int = 10_000, years_ahead: int = 3) -> DataFrame:
    """The generated range of a date dimension (``days`` days up to ``AS_OF``, moved ahead), with each day's orders."""
    t = _t(spark, sf_dir)
    dates = calendar.dimension_range(_one(spark, AS_OF), "as_of", days, years_ahead).select(F.col("nk_date").alias("period"))
    daily = _daily_orders(t)
    return _with_order_totals(dates, daily, dates.period == daily.d)


def q_date_dimension(spark, sf_dir) -> DataFrame:
    """Gap-free date dimension over the order-date span, relative to ``AS_OF``."""
    t = _t(spark, sf_dir)
    dates = calendar.date_span(t.orders, "o_orderdate", out="d")
    return calendar.date_dimension(dates, "d", AS_OF)


def q_easter_holidays(spark, sf_dir) -> DataFrame:
    """Orders and revenue per holiday (Easter-based and fixed), and on non-holiday working/other days."""
    t = _t(spark, sf_dir)
    daily = _daily_orders(t)
    labelled = calendar.with_holidays(daily, "d")
    return labelled.groupBy(
        F.coalesce(F.col("holiday"), F.lit("(none)")).alias("holiday"), "is_working_day"
    ).agg(F.sum("n_orders").cast("long").alias("n_orders"), F.count(F.lit(1)).cast("long").alias("n_days"))


def q_working_days(spark, sf_dir) -> DataFrame:
    """Orders per month with the month's working-day count and orders per working day number."""
    t = _t(spark, sf_dir)
    daily = _daily_orders(t)  # the span comes from the daily aggregate (its branch reads only the date column)
    dim = calendar.date_dimension(calendar.date_span(daily, "d", out="d"), "d", AS_OF)
    j = dim.select("nk_date", "year_month_number", "is_working_day", "working_day_number").join(
        daily, dim.nk_date == daily.d, "left"
    )
    return j.groupBy("year_month_number").agg(
        F.max("working_day_number").cast("int").alias("working_days"),
        F.sum(F.when(F.col("is_working_day") == 1, F.col("n_orders"))).cast("long").alias("orders_on_working_days"),
        F.sum(F.coalesce(F.col("n_orders"), F.lit(0))).cast("long").alias("orders"),
    )


# --- corrections (C22 C23 U1 U6 W6 C7) ------------------------------------------------------------------


def _intervals(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        d.alias("from_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(d, 30)).alias("to_date"),
    )


def q_close_intervals(spark, sf_dir) -> DataFrame:
    """Close open validity rows of customers with more than one open row (end = next start - 1 day)."""
    t = _t(spark, sf_dir)
    return upsert.close_open_intervals(_intervals(t), "o_custkey", "from_date", "to_date", "o_orderkey", changed_col="changed")


def q_update_join(spark, sf_dir) -> DataFrame:
    """UPDATE orders SET priority = customer's segment FROM customer WHERE keys match AND status = 'O'."""
    t = _t(spark, sf_dir)
    return upsert.update_from(
        t.orders,
        t.customer,
        [("o_custkey", "c_custkey")],
        {"o_orderpriority": "c_mktsegment"},
        where=lambda tc, sc: tc("o_orderstatus") == "O",
    )


def _product_groups(t: Tables) -> DataFrame:
    """Correction source: a chain of many-to-one joins (supplier -> nation -> region) with an inequality
    residual and DISTINCT output, as in the warehouse statement; unique per supplier."""
    s, n, r = t.supplier, t.nation, t.region
    j = s.join(n, (n.n_nationkey == s.s_nationkey) & (n.n_name != "NATION_0")).join(
        r, (r.r_regionkey == n.n_regionkey) & (r.r_regionkey != 0)
    )
    return j.select("s_suppkey", "n_name", "r_name").distinct()


def q_update_defaulted(spark, sf_dir) -> DataFrame:
    """UPDATE lineitem SET flag/status = nvl(concat('FF', source value), '-1') FROM a three-way join."""
    t = _t(spark, sf_dir)

    def ff(c):
        return lambda s: F.coalesce(F.concat(F.lit("FF"), s(c)), F.lit("-1"))

    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    return upsert.update_from(
        li,
        _product_groups(t),
        [("l_suppkey", "s_suppkey")],
        {"l_returnflag": ff("n_name"), "l_linestatus": ff("r_name")},
        where=lambda tc, sc: tc("l_shipdate") >= F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz"),
    )


def _customer_target(t: Tables) -> DataFrame:
    early = t.orders.where(F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"))
    return t.customer.join(early, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


def _customer_changes(t: Tables) -> DataFrame:
    late = t.orders.where(F.col("o_orderdate") >= F.lit(dt.datetime(2001, 1, 1)).cast("timestamp_ntz"))
    changed = t.customer.join(late, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return changed.select(
        "c_custkey",
        F.upper("c_name").alias("c_name"),
        "c_nationkey",
        (F.col("c_acctbal").cast(MONEY) + F.lit(Decimal("100"))).cast("double").alias("c_acctbal"),
        F.lower("c_mktsegment").alias("c_mktsegment"),
    )


def q_upsert_full(spark, sf_dir) -> DataFrame:
    """Full-row upsert of changed customers into the customers known before 1998."""
    t = _t(spark, sf_dir)
    return upsert.upsert(_customer_target(t), _customer_changes(t), ["c_custkey"])


def q_merge_partial(spark, sf_dir) -> DataFrame:
    """Partial merge: existing customers get only balance and segment; new ones are inserted whole."""
    t = _t(spark, sf_dir)
    return upsert.merge_partial(_customer_target(t), _customer_changes(t), ["c_custkey"], ["c_acctbal", "c_mktsegment"])


def q_limit_per_group(spark, sf_dir, n: int = 5) -> DataFrame:
    """The ``n`` most recent orders of every customer."""
    t = _t(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return upsert.limit_per_group(o, ["o_custkey"], n, ["o_orderdate", "o_orderkey"], descending=True)


def q_running_totals(spark, sf_dir) -> DataFrame:
    """Every order with what had been sold up to it: number and value of orders, the largest one, the customer of the
    last finished one, over all orders by date; and the customer's own value so far."""
    t = _t(spark, sf_dir)
    o = t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        (F.col("o_totalprice").cast(MONEY) * 100).cast("bigint").alias("cents"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("finished_by"),
    )
    by_date = ["o_orderdate", "o_orderkey"]
    overall = {
        "orders_so_far": ("count", "o_orderkey"),
        "cents_so_far": ("sum", "cents"),
        "largest_so_far": ("max", "cents"),
        "last_finished_by": ("last", "finished_by"),
    }
    rows = ordered.running_within(o, [], by_date, overall)
    return ordered.running_within(rows, ["o_custkey"], by_date, {"customer_cents_so_far": ("sum", "cents")}).drop("finished_by")


def q_batched_load(spark, sf_dir, size: int = 100) -> DataFrame:
    """Batch plan for a keyed bulk load: batches of at most ``size`` orders per priority (partition key)."""
    t = _t(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_orderpriority")
    return quality.batch_plan(o, ["o_orderpriority"], size, ["o_orderkey"], batch_col="batch")


# --- semi-structured (C3 C20 C21) ----------------------------------------------------------------------


def _k(props: str = "props") -> Column:
    """The integer ``k`` of the ``{"k": int}`` event payload (NULL when the payload is not JSON)."""
    return F.from_json(F.col(props), "k int").getField("k")


def q_json_path(spark, sf_dir) -> DataFrame:
    """Payload path extraction, composite member code and a filter on the derived alias."""
    t = _t(spark, sf_dir)
    e = t.events.where(F.col("event_type") == "purchase").withColumn("k", _k())
    e = e.withColumn("member_code", code("user_id", "p", "k"))
    return e.where(F.col("k") >= 50).select("event_id", "user_id", "k", "member_code")


def _event_bodies(t: Tables) -> DataFrame:
    """Event-capture style rows: a hex-encoded JSON body (two timestamp formats; error events are corrupt)."""
    us = F.date_format("ts", "M/d/yyyy h:mm:ss a")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    body = F.to_json(
        F.struct(
            F.when(F.col("event_type").isin("click", "view"), us).otherwise(iso).alias("UtcTime"),
            F.col("user_id").cast("string").alias("Member"),
            F.col("event_type").alias("Source"),
            F.concat(F.lit("/api/members/"), F.col("user_id").cast("string"), F.lit("/device/"), F.col("event_id").cast("string")).alias("Path"),
        )
    )
    body = F.when(F.col("event_type") == "error", F.substring(body, 1, 12)).otherwise(body)
    return t.events.select("event_id", "ts", F.hex(F.encode(body, "UTF-8")).alias("Body"))


def q_event_decode(spark, sf_dir) -> DataFrame:
    """Decode hex event bodies once, then read typed fields from the parsed payload."""
    t = _t(spark, sf_dir)
    decoded = semistructured.decode_events(_event_bodies(t), "Body", hex_text=True)
    fields = semistructured.extract(
        decoded, "payload", {"utc": ("UtcTime", "string"), "member_id": ("Member", "string"), "source": ("Source", "string"), "path": ("Path", "string")}
    )
    return fields.select(
        "event_id",
        parse_event_ts("utc").alias("event_timestamp_utc"),
        "member_id",
        "source",
        last_path_part("path").alias("deviceid"),
    )


def q_flatten_array(spark, sf_dir) -> DataFrame:
    """Lateral flatten of the embedding arrays with element index, filtered on the element value."""
    t = _t(spark, sf_dir)
    flat = semistructured.flatten(t.embeddings.select("vec_id", "embedding"), "embedding", index="idx", value="v")
    return flat.where(F.col("v") > 0.2).select("vec_id", F.col("idx").cast("int").alias("idx"), F.col("v").cast("double").alias("value"))


# --- forecast matrix (C1) ------------------------------------------------------------------------------

# Month labels as they appear in the sheets (Norwegian where they differ from English), and the
# sheet's static column headers with the names they get in the facts.
MONTH_LABELS = ["jan", "feb", "mar", "apr", "mai", "jun", "jul", "aug", "sep", "okt", "nov", "des"]
FORECAST_RENAME = {
    "CC": "center_id",
    "Name": "center_name",
    "Country": "country_code",
    "Business unit": "business_unit",
    "UniqeID": "unique_id",
    "Currency": "currency",
    "Currency rate": "currency_rate",
    "Account": "account",
    "Club/OH": "club_oh",
    "Current FC": "current_fc",
}
# Countries the report keeps (the benchmark's nations stand in for the four markets).
RECOGNIZED_COUNTRIES = ["NATION_1", "NATION_2", "NATION_3", "NATION_4"]


def month_columns(t: Tables) -> list[str]:
    """The ``mmm-yy`` labels of all months from the first to the last order, in order."""
    first, last = t.orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"{MONTH_LABELS[m % 12]}-{m // 12 % 100:02d}" for m in months]


def forecast_sheet(t: Tables, how: str = "sum") -> DataFrame:
    """A wide 'forecast sheet': one row per customer with orders, the ten static columns, one ``mmm-yy`` column per
    month (order value, or order count with ``how='count'``), plus an extra column the job must drop."""
    label = F.concat(
        F.element_at(F.array(*[F.lit(m) for m in MONTH_LABELS]), F.month("o_orderdate")), F.date_format("o_orderdate", "-yy")
    )
    amount = (F.col("o_totalprice").cast(MONEY) * 100).cast("bigint") if how == "sum" else F.lit(1).cast("bigint")
    months = t.orders.select("o_custkey", label.alias("label"), amount.alias("amount"))
    labels = month_columns(t)
    wide = months.groupBy("o_custkey").pivot("label", labels).agg(F.sum("amount"))  # too many for conditional sums
    scale = 100 if how == "sum" else 1
    c = wide.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(
        F.col("o_custkey").alias("CC"),
        F.col("c_name").alias("Name"),
        F.col("n_name").alias("Country"),
        F.col("c_mktsegment").alias("Business unit"),
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("UniqeID"),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("Currency"),
        F.concat(F.lit("1."), F.col("c_nationkey").cast("string")).alias("Currency rate"),
        F.lit("3000").alias("Account"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit("OH")).otherwise(F.lit("Club")).alias("Club/OH"),
        F.add_months(F.lit(AS_OF), -F.col("c_nationkey")).alias("Current FC"),
        *[(F.col(m) / scale).alias(m) for m in labels],
        F.lit("extra column, dropped by the job").alias("Comment"),
    )


def forecast_long(wide: DataFrame, metric, forecast_file, extract_date: dt.date) -> DataFrame:
    """Sheet -> long facts: rename, keep recognised countries, keep static + month columns, unpivot, parse.

    ``metric`` and ``forecast_file`` are names or columns (e.g. the sheet and workbook of each row).
    """
    metric = F.lit(metric) if isinstance(metric, str) else metric
    forecast_file = F.lit(forecast_file) if isinstance(forecast_file, str) else forecast_file
    df = wide.withColumnsRenamed(FORECAST_RENAME)
    df = df.where(F.col("country_code").isin(RECOGNIZED_COUNTRIES))
    df = df.withColumns({"_metric": metric, "_file": forecast_file})
    static = list(FORECAST_RENAME.values()) + ["_metric", "_file"]
    df = reshape.select_by(df, static, reshape.MONTH_COLUMN_REGEX)
    long = reshape.unpivot_months(df, static, reshape.MONTH_COLUMN_REGEX, var="period", value="value")
    made = {"center_id": F.col("center_id").cast("string"), "current_fc": year_month(F.to_date("current_fc"))}
    return long.select(
        *[made.get(c, F.col(c)).alias(c) for c in FORECAST_RENAME.values()],
        parse_month_label("period").alias("period"),
        F.col("value").cast("double").alias("value"),
        F.lit(extract_date.isoformat()).alias("extract_date"),
        normalise_name(F.col("_metric")).alias("metric_name"),
        F.col("_file").alias("forecast_file"),
    )


def q_forecast_unpivot(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    return forecast_long(forecast_sheet(t), "Total price", "200008 forecast", AS_OF)


# --- scalar function sets (X1-X34) ---------------------------------------------------------------------


def q_date_functions(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate", F.to_date("o_orderdate").alias("d"))
    text_in = F.when(F.col("o_orderstatus") == "F", F.date_format("d", "yyyy-M-d")).otherwise(F.lit("not a date"))
    return o.select(
        "o_orderkey",
        "d",
        F.trunc("d", "week").alias("first_day_of_week"),
        last_day_of_week("d").alias("last_day_of_week"),
        previous_monday("d").alias("previous_monday"),
        F.last_day("d").alias("last_day_of_month"),
        F.trunc("d", "month").alias("first_day_of_month"),
        F.trunc("d", "year").alias("first_day_of_year"),
        boundary_diff("day", "d", AS_OF).cast("int").alias("days_to_as_of"),
        boundary_diff("week", "d", AS_OF).cast("int").alias("weeks_to_as_of"),
        boundary_diff("month", "d", AS_OF).cast("int").alias("months_to_as_of"),
        boundary_diff("quarter", "d", AS_OF).cast("int").alias("quarters_to_as_of"),
        boundary_diff("year", "d", AS_OF).cast("int").alias("years_to_as_of"),
        iso_day_of_week("d").alias("iso_dow"),
        iso_year_of_week("d").alias("iso_year"),
        F.weekofyear("d").cast("int").alias("iso_week"),
        F.quarter("d").cast("int").alias("quarter"),
        date_path("d").alias("date_path"),
        year_month("d").alias("year_month"),
        F.add_months("d", 3).alias("plus_3_months"),
        F.date_add("d", 7).alias("plus_week"),
        date_or_monday(text_in, AS_OF).alias("date_or_monday"),
        parse_date_any(F.date_format("d", "MM/dd/yyyy"), ["yyyy-MM-dd", "MM/dd/yyyy"]).alias("parsed_back"),
        epoch_micros_to_date(F.unix_micros(F.col("o_orderdate").cast("timestamp"))).alias("from_epoch_micros"),
        parse_event_ts(F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a")).alias("parsed_us_ts"),
        F.make_date(F.year("d"), F.month("d"), F.lit(1)).alias("from_parts"),
    )


def q_text_functions(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    p = t.part
    return p.select(
        "p_partkey",
        code("p_brand", "p", "p_partkey").alias("part_code"),
        concat_ws_strict(".", "p_brand", "p_type", "p_name").alias("fq_name"),
        F.regexp_replace("p_brand", r"#.", "").alias("brand_stripped"),
        F.split_part("p_name", F.lit(" "), F.lit(-1)).alias("last_word"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand_no"),
        F.substring("p_type", 1, 3).alias("type3"),
        F.right("p_brand", F.lit(2)).alias("brand_right2"),
        F.lower("p_type").alias("type_lower"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("name_underscored"),
        normalise_name(F.concat("p_type", F.lit(". "), "p_name")).alias("normalised"),
        F.regexp_count("p_name", F.lit("e")).cast("int").alias("n_e"),
        F.col("p_name").like("blue%").alias("is_blue"),
        F.col("p_name").rlike("^(red|blue) ").alias("is_colour"),
        F.concat(F.lit("W "), F.col("p_size").cast("string")).alias("size_label"),
    )


def q_cast_and_math(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.floor(F.col("l_quantity") / 7).cast("long").alias("qty_div7"),
        F.pmod(F.col("l_linenumber"), F.lit(3)).cast("int").alias("line_mod3"),
        (F.col("l_extendedprice").cast(MONEY) * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(20,4)").cast("double").alias("net_price"),
        F.when(F.col("l_discount") > 0.05, F.lit("high")).when(F.col("l_discount") > 0.0, F.lit("low")).otherwise(F.lit("none")).alias("discount_band"),
        F.coalesce(F.when(F.col("l_tax") > 0.0, F.col("l_tax")), F.lit(-1.0)).alias("tax_or_default"),
        F.col("l_quantity").cast("int").alias("qty_int"),
        F.col("l_linenumber").cast("string").alias("line_text"),
        try_number("l_returnflag", "int").alias("flag_as_int"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )


def q_filters_mix(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    o = t.orders
    cond = (
        o.o_orderpriority.isin("1-URGENT", "2-HIGH", "3-MEDIUM")
        & ~o.o_orderstatus.isin("P")
        & ((o.o_totalprice > 300000) | o.o_orderpriority.like("1-%"))
        & F.to_date("o_orderdate").between(dt.date(1996, 1, 1), dt.date(1999, 12, 31))
        & o.o_orderdate.isNotNull()
        & (F.regexp_count(o.o_orderpriority, F.lit("[0-9]-")) > 0)
    )
    return o.where(cond).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def q_joins_mix(spark, sf_dir) -> DataFrame:
    """Semi join, inner ON, inner USING, left join to an aggregate."""
    t = _t(spark, sf_dir)
    buyers = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    cn = buyers.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    cnr = cn.join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"])
    sup = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_suppliers"))
    j = cnr.join(sup, F.col("c_nationkey") == F.col("s_nationkey"), "left")
    return j.select("c_custkey", "c_name", "n_name", "r_name", F.coalesce("n_suppliers", F.lit(0)).cast("long").alias("n_suppliers"))


def q_self_join(spark, sf_dir) -> DataFrame:
    """Names present under both of two types. The warehouse writes a self-join + DISTINCT; here one aggregate
    per name decides it, so no name's rows are paired with each other."""
    t = _t(spark, sf_dir)
    p = t.part.where(F.col("p_type").isin("ECONOMY", "SMALL"))
    by_name = p.groupBy("p_name").agg(
        F.max((F.col("p_type") == "ECONOMY").cast("int")).alias("_a"), F.max((F.col("p_type") == "SMALL").cast("int")).alias("_b")
    )
    return by_name.where((F.col("_a") == 1) & (F.col("_b") == 1)).select("p_name", F.lit("yes").alias("in_both"))


def q_aggs_mix(spark, sf_dir) -> DataFrame:
    """count/sum/max by key with HAVING."""
    t = _t(spark, sf_dir)
    li = t.lineitem
    agg = li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("count_order"),
        money_sum("l_quantity").alias("sum_qty"),
        money_sum("l_extendedprice").alias("sum_base_price"),
        F.max("l_shipdate").alias("max_shipdate"),
        F.min("l_shipdate").alias("min_shipdate"),
        F.max("l_discount").alias("max_discount"),
    )
    return agg.where(F.col("count_order") > 100)


def q_top_orders(spark, sf_dir, k: int = 10) -> DataFrame:
    """Top-k report: the ``k`` largest orders (ties broken by key)."""
    t = _t(spark, sf_dir)
    return (
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
        .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc())
        .limit(k)
    )


# --- audit reports (C10-C13) ---------------------------------------------------------------------------


def query_history(t: Tables) -> DataFrame:
    """Query history shaped from events: one 'query' per event."""
    k = _k()
    text = (
        F.when(F.col("event_type") == "error", F.lit("select 1"))
        .when(F.col("event_type") == "signup", F.lit("SELECT 'keep alive'"))
        .otherwise(F.concat(F.lit("select * from t where k = "), k.cast("string")))
    )
    qtype = F.when(F.col("event_type") == "purchase", F.lit("INSERT")).otherwise(F.lit("SELECT"))
    return t.events.select(
        F.col("event_id").cast("string").alias("query_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_name"),
        text.alias("query_text"),
        qtype.alias("query_type"),
        F.col("ts").alias("end_time"),
    )


def _obj_name(k: Column) -> Column:
    schema_ = F.element_at(F.array(F.lit("S1"), F.lit("S2"), F.lit("S3")), F.pmod(k, F.lit(3)) + 1)
    kind = F.element_at(F.array(F.lit("D_"), F.lit("F_")), F.pmod(k, F.lit(2)) + 1)
    return F.concat(F.lit("DB1."), schema_, F.lit("."), kind, F.lit("T"), F.pmod(k, F.lit(5)).cast("string"))


ACCESS_OBJECTS_TYPE = "array<struct<objectName:string,objectDomain:string,columns:array<struct<columnName:string>>>>"


def access_log(t: Tables) -> DataFrame:
    """Access log shaped from events: each event reads two objects (error events none).

    The payload is parsed once into ``k``; every object field is then a cheap expression over ``k``.
    """
    base = t.events.select("event_id", "event_type", "user_id", "ts", _k().alias("k"))
    k = F.col("k")
    col = lambda name: F.struct(name.alias("columnName"))
    obj1 = F.struct(
        _obj_name(k).alias("objectName"),
        F.lit("Table").alias("objectDomain"),
        F.array(col(F.concat(F.lit("C"), F.pmod(k, F.lit(4)).cast("string"))), col(F.concat(F.lit("C"), F.pmod(k, F.lit(6)).cast("string")))).alias("columns"),
    )
    obj2 = F.struct(
        F.concat(F.lit("DB1.ST.STG_T"), F.pmod(k, F.lit(4)).cast("string")).alias("objectName"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.lit("Table")).otherwise(F.lit("View")).alias("objectDomain"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.array().cast("array<struct<columnName:string>>")).otherwise(F.array(col(F.lit("C0")))).alias("columns"),
    )
    objects = F.when(F.col("event_type") == "error", F.array().cast(ACCESS_OBJECTS_TYPE)).otherwise(F.array(obj1, obj2))
    log = base.select(
        F.col("event_id").cast("string").alias("query_id"),
        F.concat(F.lit("SYS_"), F.upper("event_type")).alias("user_name"),
        F.col("ts").alias("query_start_time"),
        objects.alias("direct_objects_accessed"),
    )
    return log.withColumn("base_objects_accessed", F.col("direct_objects_accessed"))


def table_inventory(t: Tables) -> DataFrame:
    """Catalog inventory shaped from the same log: every object ever read, with sizes and change times."""
    flat = semistructured.flatten(access_log(t), "direct_objects_accessed")
    inv = flat.groupBy(F.col("value.objectName").alias("fq")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("query_start_time").alias("created"), F.max("query_start_time").alias("last_altered")
    )
    return inv.select(
        F.split_part("fq", F.lit("."), F.lit(1)).alias("table_catalog"),
        F.split_part("fq", F.lit("."), F.lit(2)).alias("table_schema"),
        F.split_part("fq", F.lit("."), F.lit(3)).alias("table_name"),
        F.lit("BASE TABLE").alias("table_type"),
        "row_count",
        "last_altered",
        "created",
    )


def q_table_usage(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.table_usage(
        table_inventory(t), access_log(t), EVENTS_AS_OF, ["SYS_VIEW", "SYS_CLICK"], r"DB1\.(S1|S2|S3)\.(D|F)_", ("S1", "S2"), when_queried="S3"
    )


def q_column_usage(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.column_usage(
        access_log(t), query_history(t), "DB1.S2.F_T1", EVENTS_AS_OF, 30, ["SYS_VIEW", "SYS_CLICK"], columns=["C1", "C3"], query_type="SELECT"
    )


def q_table_usage_search(spark, sf_dir) -> DataFrame:
    """Every SELECT of one user in the last 30 days that read a table, one row per accessed column."""
    t = _t(spark, sf_dir)
    return audit.column_usage(access_log(t), query_history(t), "DB1.S1.D_T0", EVENTS_AS_OF, 30, ["SYS_VIEW"], query_type="SELECT")


def q_query_search(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.query_search(query_history(t), "U7", ["SELECT 'keep alive'", "select 1"], "SELECT")


def _freshness_meta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            ("orders", "BASE TABLE", dt.datetime(2001, 8, 2)),
            ("lineitem", "BASE TABLE", dt.datetime(2001, 8, 2)),
            ("events", "VIEW", dt.datetime(2024, 2, 1)),
        ],
        "table_name string, table_type string, last_altered timestamp_ntz",
    )


def q_freshness(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    tables = {
        "orders": (t.orders, ["o_orderdate"]),
        "lineitem": (t.lineitem, ["l_shipdate"]),
        "events": (t.events, ["ts"]),
    }
    return audit.freshness(tables, _freshness_meta(spark))


def q_freshness_footers(spark, sf_dir) -> DataFrame:
    """The same report from the tables' footers."""
    columns = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"], "events": ["ts"]}
    tables = {name: (f"{sf_dir.rstrip('/')}/{name}.parquet", cols) for name, cols in columns.items()}
    return audit.freshness_by_footers(spark, tables, _freshness_meta(spark))


FRESHNESS_COLUMNS = ["o_orderdate", "l_shipdate", "ts"]


def q_freshness_catalog(spark, sf_dir) -> DataFrame:
    """Freshness of what the live catalog lists: the timestamp columns are found by name in its metadata, and views
    are reported as such."""
    t = _t(spark, sf_dir)
    prefix = "tableops_live_"
    for name in ("orders", "lineitem", "events", "nation"):
        getattr(t, name).createOrReplaceTempView(prefix + name)
    listed = catalog_tables(spark).where(F.col("table_name").startswith(prefix))
    names = [r["table_name"] for r in listed.select("table_name").collect()]
    columns: dict[str, list[str]] = {}
    for r in catalog_columns(spark, names, FRESHNESS_COLUMNS, exclude=[prefix + "nation"]).collect():
        columns.setdefault(r["table_name"], []).append(r["column_name"])
    meta = listed.select("table_name", F.lit("BASE TABLE").alias("table_type"), F.col("table_type").alias("last_altered"))
    found = audit.freshness({n: (spark.table(n), c) for n, c in columns.items()}, meta)
    return found.select(
        F.expr(f"substring(table_name, {len(prefix) + 1})").alias("table_name"), "column_name", "max_ts", F.col("last_altered").alias("table_type")
    )


# --- enrichment (C9) and schema evolution (C24) and incremental extract (S11) --------------------------


def weather_documents(t: Tables) -> DataFrame:
    """Forecast API responses per city (nation), landed as JSON text."""
    n = t.nation
    step = F.struct(
        F.lit("2024-01-01T12:00:00Z").alias("time"),
        F.struct(
            F.struct(F.struct((F.col("n_nationkey") - 5).cast("double").alias("air_temperature"), (F.col("n_nationkey") * 5).cast("double").alias("cloud_area_fraction")).alias("details")).alias("instant"),
            F.when(F.col("n_nationkey") % 4 != 3, F.struct(F.struct((F.col("n_nationkey") * 0.025).cast("double").alias("precipitation_amount")).alias("details"))).alias("next_1_hours"),
        ).alias("data"),
    )
    doc = F.to_json(F.struct(F.struct(F.array(step).alias("timeseries")).alias("properties")))
    # forecasts exist for the cities outside region 4 (clubs there get none and drop out of the report)
    return n.where(F.col("n_regionkey") != 4).select(F.col("n_name").alias("city_name"), doc.alias("response"))


def q_weather_enrich(spark, sf_dir) -> DataFrame:
    """Clubs (suppliers) in cities with a forecast, with simplified weather flags, written as a stamped CSV."""
    from ..session import scratch_path
    from ..sinks import write_csv_stamped

    t = _t(spark, sf_dir)
    w = enrich.weather_flags(semistructured.parse_forecast(weather_documents(t), "response"))
    w = w.select("city_name", "measure_time", "temperature", "clear_sky", F.col("precipitation_flag").alias("precipitation"))
    clubs = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("center_code"), F.col("n_name").alias("city_name")
    )
    out = enrich.enrich(clubs, w, "city_name").select("center_code", "measure_time", "temperature", "clear_sky", "precipitation")
    path = write_csv_stamped(out, scratch_path(spark, "ClubInfoWeather"), dt.datetime(2024, 1, 1, 12, 0, 0))
    return spark.read.schema(out.schema).option("header", "true").csv(path)


def q_schema_evolution(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    return schema.evolve(
        t.customer,
        add={"training_duration": "string"},
        rename={"c_name": "customer_name"},
        drop=["c_acctbal"],
        cast={"c_nationkey": "bigint"},
    )


INCREMENTAL_PREV = dt.datetime(2024, 1, 15)


def q_incremental_extract(spark, sf_dir) -> DataFrame:
    """Rows changed after the previous high-watermark (strict ``>``)."""
    from ..sources.incremental import incremental

    t = _t(spark, sf_dir)
    rows = incremental(t.events, "ts", INCREMENTAL_PREV)
    return rows.select("event_id", "ts", "user_id", "event_type")


def q_date_or_monday(spark, sf_dir) -> DataFrame:
    t = _t(spark, sf_dir)
    text_in = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-M-d")).when(
        F.col("o_orderstatus") == "F", F.lit("2021-02-30")
    )
    return t.orders.select("o_orderkey", date_or_monday(text_in, AS_OF).alias("scoring_date"))

