"""Data-quality guards: duplicates, per-key batch plans with reconciliation, required values.

``duplicate_rows`` is lazy. ``batch_plan`` (NULL-key guard), ``reconcile_counts`` and ``require_values`` run a
small action by contract, because their purpose is to stop a run.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import row_number_within


def duplicate_rows(df: DataFrame, keys: Sequence[str], count_col: str = "dup_count") -> DataFrame:
    """All rows whose key occurs more than once (``qualify count(*) over (partition by keys) > 1``).

    Counted with a map-side-combined aggregate and joined back, so a hot key never sits in one window task;
    NULL keys group together, as in the window form.
    """
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)
    counts = counts.select(*[F.col(k).alias(f"_dk_{k}") for k in keys], count_col)
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(counts[f"_dk_{k}"]) for k in keys])
    return df.join(counts, on, "inner").drop(*[f"_dk_{k}" for k in keys])


def require_at_most(df: DataFrame, keys: Sequence[str], n: int) -> None:
    """Raise when a key has more than ``n`` rows, naming some such keys and how many rows a cap would drop."""
    over = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > n)
    found = over.orderBy(F.desc("n_rows")).limit(5).collect()
    if found:
        dropped = over.agg(F.sum(F.col("n_rows") - n)).first()[0]
        raise ValueError(f"a cap of {n} rows per {list(keys)} would drop {dropped} rows, e.g. {[r.asDict() for r in found]}")


def batch_plan(
    df: DataFrame,
    keys: Sequence[str],
    size: int,
    order: Sequence[str],
    batch_col: str = "batch",
) -> DataFrame:
    """Number rows within each key by ``order`` and cut them into batches of at most ``size`` rows.

    ``batch = floor((row_number - 1) / size)``; every batch holds one key only (the store's partition key).
    A NULL key fails the job (a document store cannot take it), checked inside the plan.
    """
    if size < 1:
        raise ValueError("size must be positive")
    keys = list(keys)
    numbered = row_number_within(df, keys, order, out="_rn")
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    batch = F.when(null_key, F.raise_error(F.lit(f"NULL value in key column(s) {keys}")).cast("long")).otherwise(
        F.floor((F.col("_rn") - 1) / F.lit(size)).cast("long")
    )
    return numbered.withColumn(batch_col, batch).drop("_rn")


def batch_counts(plan: DataFrame, keys: Sequence[str], batch_col: str = "batch") -> DataFrame:
    return plan.groupBy(*keys, batch_col).agg(F.count(F.lit(1)).alias("n_rows"))


def reconcile_counts(
    planned: DataFrame, written: DataFrame, keys: Sequence[str], batch_col: str = "batch", raise_on_mismatch: bool = True
) -> DataFrame:
    """Compare planned and written rows per (key, batch); raise when any batch differs."""
    on = list(keys) + [batch_col]
    p = batch_counts(planned, keys, batch_col).withColumnRenamed("n_rows", "planned")
    w = batch_counts(written, keys, batch_col).withColumnRenamed("n_rows", "written")
    cmp = p.join(w, on, "full_outer").fillna(0, ["planned", "written"])
    bad = cmp.where(F.col("planned") != F.col("written"))
    if raise_on_mismatch:
        sample = bad.limit(5).collect()
        if sample:
            raise ValueError(f"batch counts differ from the plan, e.g. {[r.asDict() for r in sample]}")
    return cmp


def require_values(df: DataFrame, col: str, expected: Iterable) -> None:
    """Raise with the list of expected values of ``col`` that do not occur (e.g. missing sheets)."""
    expected = list(expected)
    spark = df.sparkSession
    exp = spark.createDataFrame([(v,) for v in expected], [col])
    missing = exp.join(df.select(col).distinct(), col, "left_anti").collect()
    if missing:
        names = sorted(r[0] for r in missing)
        raise ValueError(f"missing required {col} value(s): {names}")
