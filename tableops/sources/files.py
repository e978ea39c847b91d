"""File scans: selection by name pattern, JSON payloads, delimited text, landed workbook sheets.

All readers return lazy DataFrames. File selection uses ``_metadata`` filters, which Spark applies while
listing files (they show up as ``DataFilters`` on the scan), so unmatched files are never opened.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import try_number


def name_matches(regex: str, on: str = "file_name") -> Column:
    """``regex`` matched from the start of the file name (``on='file_name'``) or searched in the whole path
    (``on='file_path'``), like ``re.match`` / ``re.search``."""
    if on == "file_name":
        return F.col("_metadata.file_name").rlike("^(?:" + regex + ")")
    return F.col("_metadata.file_path").rlike(regex)


def read_matching(
    spark: SparkSession,
    base: str,
    fmt: str,
    regex: str,
    schema: T.StructType | str | None = None,
    on: str = "file_name",
    glob: str | None = None,
    **options,
) -> DataFrame:
    """All files below ``base`` whose name matches ``regex`` (start-anchored). ``glob`` is an optional coarse
    pre-filter (``pathGlobFilter``); a glob is not a regex, so the regex is always applied too."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true").options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(base).where(name_matches(regex, on))


def read_json_payload(spark: SparkSession, path: str, regex: str | None = None, out: str = "payload") -> DataFrame:
    """JSON lines as one VARIANT column (``out``) plus the raw line (``<out>_text``). A line that is not JSON
    gives a NULL payload and the row is kept."""
    reader = spark.read.option("recursiveFileLookup", "true").format("text")
    df = reader.load(path)
    if regex:
        df = df.where(name_matches(regex))
    return df.select(F.col("value").alias(f"{out}_text"), F.try_parse_json("value").alias(out), "_metadata")


def typed_fields(df: DataFrame, payload: str, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Typed columns read from a VARIANT payload: ``{name: (json_path, type)}``; text that does not convert to
    the type gives NULL (numbers are converted without the per-row exception cost of ``try_cast``)."""
    cols = {}
    for name, (path, typ) in spec.items():
        p = path if path.startswith("$") else "$." + path
        as_text = F.try_variant_get(F.col(payload), p, "string")
        if typ in ("string", "varchar"):
            cols[name] = as_text
        elif typ.startswith(("decimal", "int", "bigint", "long", "double", "float", "smallint")):
            cols[name] = try_number(as_text, typ)
        else:
            cols[name] = F.try_variant_get(F.col(payload), p, typ)
    return df.withColumns(cols)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Files holding one JSON array each (outer array stripped): one row per element; ``.gz`` is decompressed."""
    reader = spark.read.option("multiLine", "true").option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ";",
    header: bool = True,
    encoding: str = "UTF-8",
    regex: str | None = None,
) -> DataFrame:
    """Delimited text read by position into ``schema`` (header line skipped, not used for names)."""
    df = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", str(header).lower())
        .option("enforceSchema", "true")
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", "true")
        .csv(path)
    )
    if regex:
        df = df.where(name_matches(regex))
    return df


def sheet_layouts(
    spark: SparkSession, base: str, sheet_col: str = "sheet", file_col: str = "workbook", regex: str | None = None, **options
) -> list[DataFrame]:
    """Workbook sheets landed as ``<base>/<workbook>/<sheet>/<CSV files>``: one DataFrame per distinct header.

    The folders are chosen first (``regex`` selects workbooks by name, start-anchored), so no other file is opened.
    Each sheet's header is read from its own files; sheets with the same header, in the same order, are read in one
    scan. Values are text; every row is tagged with its workbook and sheet.
    """
    parts = F.split("path", "/")
    names = {file_col: F.url_decode(F.element_at(parts, -3)), sheet_col: F.url_decode(F.element_at(parts, -2))}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path").withColumns(names)
    if regex:
        files = files.where(F.col(file_col).rlike("^(?:" + regex + ")"))
    folders = files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).distinct().orderBy("folder").collect()
    by_header: dict[tuple[str, ...], list[str]] = {}
    for r in folders:  # one row per sheet
        header = spark.read.options(**options).option("header", "true").csv(r["folder"]).columns
        by_header.setdefault(tuple(header), []).append(r["folder"])
    out = []
    for header, paths in by_header.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        df = spark.read.options(**options).option("header", "true").schema(schema).csv(paths)
        located = F.split(F.col("_metadata.file_path"), "/")
        out.append(
            df.withColumns({file_col: F.url_decode(F.element_at(located, -3)), sheet_col: F.url_decode(F.element_at(located, -2))})
        )
    return out


def read_sheets(spark: SparkSession, base: str, **options) -> DataFrame:
    """All sheets of :func:`sheet_layouts` matched by column name; a column that a sheet lacks is NULL in its rows."""
    layouts = sheet_layouts(spark, base, **options)
    if not layouts:
        raise ValueError(f"no sheet below {base} matches")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layouts)
