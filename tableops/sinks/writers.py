"""Writers (eager by nature): typed append, partition unload, partitioned JSON lines, gzip JSON, stamped CSV.

Paths should live on shared storage; every writer goes through Spark's committer, so a lost executor's
partial output is never published.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Timestamp text formats with full (microsecond) precision; Spark's JSON/CSV default is
# milliseconds, which would silently truncate on a round trip.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TEXT_TS_OPTIONS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_NTZ_FORMAT}


def load_append(df: DataFrame, target: str, columns: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """Append the listed columns (in that order) to a table name or a path."""
    out = df.select(*columns) if columns else df
    if "/" in target:
        out.write.mode("append").format(fmt).save(target)
    elif df.sparkSession.catalog.tableExists(target):
        out.write.insertInto(target)
    else:
        out.write.mode("append").format(fmt).saveAsTable(target)


def clustered(df: DataFrame, part_cols: Sequence[str], cluster_by: Sequence[str], n: int | None = None) -> DataFrame:
    """Range-partition by ``part_cols`` + ``cluster_by`` and sort within tasks.

    Each task then holds a contiguous run of partition values and writes few, large, sorted files (min/max
    statistics prune well); a partition value holding much of the data is split across tasks by the secondary
    columns instead of landing in one task, as ``repartition(part_cols)`` would do.
    """
    cols = [*part_cols, *cluster_by]
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)


def unload_partition(
    df: DataFrame,
    path: str,
    part_cols: Sequence[str],
    fmt: str = "parquet",
    compression: str = "snappy",
    cluster_by: Sequence[str] | None = None,
) -> None:
    """Write ``df`` partitioned by ``part_cols``, replacing only the partitions present in ``df``.
    ``cluster_by`` (secondary columns) clusters the output first, see ``clustered``."""
    if cluster_by:
        df = clustered(df, part_cols, cluster_by)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*part_cols)
        .format(fmt)
        .save(path)
    )


def write_json_parts(
    df: DataFrame,
    path: str,
    part_cols: Sequence[str],
    compression: str | None = None,
    cluster_by: Sequence[str] | None = None,
) -> None:
    """JSON lines in one folder per ``part_cols`` value combination (e.g. per file and metric)."""
    if cluster_by:
        df = clustered(df, part_cols, cluster_by)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**TEXT_TS_OPTIONS)
    w = w.partitionBy(*part_cols)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def write_date_folders(df: DataFrame, base: str, day_col: str, fmt: str = "parquet") -> int:
    """One folder ``yyyy/MM/dd`` per day of the date column ``day_col``, from one partitioned write; returns the number
    of folders. Rows without a day fail the job. Spark's own folder names (``day=2024-01-11``) are renamed afterwards,
    one call a day; a day that is there already is replaced."""
    spark, staging = df.sparkSession, f"{base.rstrip('/')}/_landing-{uuid.uuid4().hex}"
    no_day = F.raise_error(F.lit(f"a row without {day_col} has no folder")).cast("string")
    path = F.when(F.col(day_col).isNull(), no_day).otherwise(F.date_format(day_col, "yyyy-MM-dd"))
    df.withColumn("_day", path).drop(day_col).write.partitionBy("_day").format(fmt).save(staging)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path_of(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = [s.getPath() for s in fs.listStatus(path_of(staging)) if s.getPath().getName().startswith("_day=")]
    for day in days:
        final = path_of(f"{base.rstrip('/')}/{day.getName().removeprefix('_day=').replace('-', '/')}")
        fs.delete(final, True)
        fs.mkdirs(final.getParent())
        if not fs.rename(day, final):
            raise RuntimeError(f"{day} could not be moved to {final}")
    fs.delete(path_of(staging), True)
    return len(days)


def write_json_gzip(df: DataFrame, path: str) -> None:
    """Gzip-compressed JSON lines extract."""
    df.write.mode("overwrite").option("compression", "gzip").options(**TEXT_TS_OPTIONS).json(path)


def write_csv_stamped(df: DataFrame, base: str, stamp: dt.datetime | None = None, sep: str = ",") -> str:
    """CSV with a header line into ``<base>_<yyyymmdd-HHMMSS>``; returns the path written."""
    stamp = stamp or dt.datetime.now(dt.timezone.utc)
    path = f"{base}_{stamp:%Y%m%d-%H%M%S}"
    df.write.mode("overwrite").option("header", "true").option("sep", sep).options(**TEXT_TS_OPTIONS).csv(path)
    return path
