"""Usage and freshness reports over catalog metadata and access logs.

Inputs are ordinary DataFrames (metadata and audit logs landed as tables):

* inventory: ``table_catalog, table_schema, table_name, table_type, row_count, last_altered, created``
* access log: ``query_id, user_name, query_start_time`` and an array of accessed objects
  ``array<struct<objectName, objectDomain, columns: array<struct<columnName>>>>``
* query history: ``query_id, user_name, query_text, query_type, end_time`` (+ any)

``as_of`` is always passed explicitly so that reports are reproducible.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..functions.nulls import concat_ws_strict, greatest_strict
from ..sources.footers import latest_by_footers
from .semistructured import flatten


def _ts(as_of):
    return as_date(as_of).cast("timestamp_ntz")


def freshness(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], meta: DataFrame) -> DataFrame:
    """Latest value of each timestamp column of each table, joined to table metadata.

    One aggregate per table computes every ``max`` in a single scan; the results are stacked into
    ``(table_name, column_name, max_ts)`` rows, unioned, and inner-joined to ``meta`` (``table_name``,
    ``table_type``, ``last_altered``); views are excluded by the join, since their metadata rows are dropped.
    """
    parts = []
    for name, (df, cols) in tables.items():
        agg = df.agg(*[F.max(F.col(c)).cast("timestamp_ntz").alias(c) for c in cols])
        stacked = agg.select(
            F.lit(name).alias("table_name"),
            F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("max_ts")) for c in cols])).alias("_s"),
        ).select("table_name", "_s.column_name", "_s.max_ts")
        parts.append(stacked)
    union = reduce(DataFrame.unionByName, parts)
    tables_only = meta.where(~F.lower(F.col("table_type")).isin("view", "materialized view"))
    return union.join(tables_only.select("table_name", "last_altered"), "table_name", "inner")


def freshness_by_footers(spark: SparkSession, tables: Mapping[str, tuple[str, Sequence[str]]], meta: DataFrame) -> DataFrame:
    """``freshness`` of Parquet tables ``{name: (path, columns)}`` from file footers: what is read grows with the number
    of files, not of rows. Adds ``n_rows``, the table's number of rows."""
    parts = [latest_by_footers(spark, path, cols).withColumn("table_name", F.lit(name)) for name, (path, cols) in tables.items()]
    tables_only = meta.where(~F.lower(F.col("table_type")).isin("view", "materialized view"))
    found = reduce(DataFrame.unionByName, parts).join(tables_only.select("table_name", "last_altered"), "table_name")
    return found.select("table_name", "column_name", "max_ts", "last_altered", "n_rows")


def table_usage(
    inventory: DataFrame,
    access: DataFrame,
    as_of,
    users: Sequence[str],
    pattern: str,
    pair: tuple[str, str],
    when_queried: str | None = None,
    objects_col: str = "direct_objects_accessed",
    lookback_days: int = 1,
) -> DataFrame:
    """Per table whose full name matches ``pattern``: size, change dates, whether it changed or was queried by
    ``users`` in the last ``lookback_days``, and whether a table of the same name exists in both schemas of ``pair``.

    Kept: the tables of the two schemas, plus those of the schema ``when_queried`` that were queried.
    """
    fq = concat_ws_strict(".", "table_catalog", "table_schema", "table_name")
    inv = inventory.withColumn("fq_table_name", fq).where(F.regexp_count(F.col("fq_table_name"), F.lit(pattern)) > 0)

    since = _ts(as_of) - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    acc = (
        flatten(access.where(F.col("user_name").isin(list(users)) & (F.col("query_start_time") >= since)), objects_col)
        .select(F.col("value.objectName").alias("fq_table_name"), "query_start_time")
        .where(F.regexp_count(F.col("fq_table_name"), F.lit(pattern)) > 0)
    )
    latest = acc.groupBy("fq_table_name").agg(F.max("query_start_time").alias("latest_queried_timestamp"))

    # "same name in both schemas": a window over the inventory (one row per table, so each name holds at most a
    # handful of rows) instead of a self-join, so the inventory is read once
    by_name = Window.partitionBy("table_name")
    in_both = (F.max((F.col("table_schema") == pair[0]).cast("int")).over(by_name) == 1) & (
        F.max((F.col("table_schema") == pair[1]).cast("int")).over(by_name) == 1
    )
    inv = inv.withColumn("table_exists_in_both", F.when(in_both, F.lit("yes")))

    joined = inv.join(latest, "fq_table_name", "left")
    day_before = F.date_sub(as_date(as_of), 1).cast("timestamp_ntz")
    changed = greatest_strict(F.col("last_altered"), F.col("created")) > day_before
    final = joined.where(
        F.col("table_schema").isin(*pair)
        | (F.col("table_schema").eqNullSafe(when_queried) & F.col("latest_queried_timestamp").isNotNull())
    ).select(
        "fq_table_name",
        F.col("table_catalog").alias("table_database"),
        "table_schema",
        "table_name",
        "row_count",
        F.to_date("last_altered").alias("last_altered_date"),
        F.to_date("created").alias("created_date"),
        F.when(changed, F.lit("yes")).otherwise(F.lit("no")).alias("updated_or_created_last_day"),
        F.when(F.col("latest_queried_timestamp").isNotNull(), F.lit("yes")).otherwise(F.lit("no")).alias("queried_last_day"),
        F.coalesce(F.col("table_exists_in_both"), F.lit("no")).alias("table_exists_in_both"),
    )
    return final.orderBy("fq_table_name", "table_database", "table_schema", "table_name")


def column_usage(
    access: DataFrame,
    queries: DataFrame,
    table: str,
    as_of,
    days: int,
    users: Sequence[str],
    columns: Sequence[str] | None = None,
    query_type: str | None = None,
    objects_col: str = "base_objects_accessed",
) -> DataFrame:
    """Queries by ``users`` in the last ``days`` that read ``table``: one row per accessed column of it
    (multiplicity kept), with the table name and every query-history column."""
    since = _ts(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    objs = flatten(access.where(F.col("user_name").isin(list(users)) & (F.col("query_start_time") >= since)), objects_col)
    objs = objs.where((F.col("value.objectName") == table) & (F.col("value.objectDomain") == "Table")).select(
        "query_id", F.col("value.objectName").alias("accessed_table"), F.col("value.columns").alias("_cols")
    )
    cols = flatten(objs, "_cols").select("query_id", "accessed_table", F.col("value.columnName").alias("column_accessed"))
    if columns is not None:
        cols = cols.where(F.col("column_accessed").isin(list(columns)))
    q = queries
    if query_type is not None:
        q = q.where(F.col("query_type") == query_type)
    out = cols.join(q, "query_id", "inner")
    return out.select("accessed_table", *[F.col(c) for c in queries.columns])


def query_search(
    queries: DataFrame, user: str, exclude_texts: Sequence[str] = (), query_type: str | None = "SELECT"
) -> DataFrame:
    """A user's queries, minus listed boilerplate texts, newest first."""
    cond = F.col("user_name") == user
    if exclude_texts:
        cond = cond & ~F.col("query_text").isin(list(exclude_texts))
    if query_type is not None:
        cond = cond & (F.col("query_type") == query_type)
    return queries.where(cond).orderBy(F.col("end_time").desc())
