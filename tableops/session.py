"""Session set-up and table access shared by every job.

The session is pinned to UTC with ANSI semantics and adaptive execution (skew-join splitting and partition
coalescing on), so results are reproducible and hot join keys are split at run time. Lineage cuts go to the
folder the cluster names in ``spark.checkpoint.dir``; a private folder is only chosen when none is set
(local runs and tests).
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "tableops") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TABLEOPS_DRIVER_MEMORY", "16g"))
    )
    for k, v in _SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on to an existing session."""
    for k, v in _SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a session whose driver and executors are one process (master
    ``local`` or ``local[..]``: tests, local runs) may leave it unset and gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master or ""):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local folder is unsafe on a cluster")
        current = tempfile.mkdtemp(prefix="tableops-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for jobs that write and read back files; it is removed when
    the driver's Python ends, as the returned DataFrame still reads from it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(remove_path, spark, path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a folder on any file system Spark can write to; does nothing once the session has been stopped."""
    sc = spark.sparkContext
    if sc._jsc is not None:
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable, survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)
