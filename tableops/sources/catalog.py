"""Catalog metadata as DataFrames (the live session's tables and columns)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``table_catalog, table_schema, table_name, table_type`` of the session catalog (views included)."""
    rows = []
    for t in spark.catalog.listTables(database):
        ttype = "VIEW" if (t.tableType or "").upper() in ("VIEW", "TEMPORARY") else "BASE TABLE"
        rows.append((t.catalog or "spark_catalog", t.namespace[0] if t.namespace else (database or ""), t.name, ttype))
    return spark.createDataFrame(rows, "table_catalog string, table_schema string, table_name string, table_type string")


def catalog_columns(
    spark: SparkSession,
    tables: Iterable[str],
    names: Iterable[str] | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """``table_name, column_name`` for the given tables, optionally only columns named in ``names``, and
    without the tables in ``exclude``. Metadata only: no data is read."""
    wanted = {n.lower() for n in names} if names is not None else None
    skip = {t.lower() for t in exclude}
    rows = []
    for table in tables:
        if table.lower() in skip:
            continue
        for c in spark.catalog.listColumns(table):
            if wanted is None or c.name.lower() in wanted:
                rows.append((table, c.name))
    return spark.createDataFrame(rows, "table_name string, column_name string")
