"""Centroid clustering in integers with a distance matrix that is kept and updated, not recomputed.

Vectors of exactly ``dims`` finite components become integers ``floor(scale * x)``; others take no part. Every row
persists, beside its vector, the exact dot products with all centroids, written as a table after each round. When the
centroids move, a product changes by ``sum(v[j] * (new[j] - old[j]))`` over the components ``j`` that changed, so a
round reads the table, adds these terms, and takes the argmin of ``|v|^2 - 2 v.c + |c|^2`` again. The first round
starts from products with zero centroids. The new centroids are exact sums per cluster, combined map-side: ``k * dims``
numbers reach the driver in a round, whatever the number of rows, and no row is shuffled.

Ties go to the smaller centroid number. Repeated rows and rows of one id are vectors of their own; a null id hashes as
``null`` when the first centroids are chosen. Fewer usable rows than ``k`` give as many centroids as there are rows;
none give an empty result. Components beyond ``2**27`` after scaling fail the job, as squared distances would not fit
in a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage

K, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
LARGEST = 1 << 27


def _integers(dims: int, scale: int):
    """Keeps usable vectors, as integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("size"))
            x = batch.column("e").flatten().cast(pa.float64())
            x = np.asarray(x.to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)  # a null component is NaN here
            usable = np.isfinite(x).all(axis=1)
            v = np.floor(x[usable] * scale)
            if v.size and np.abs(v).max() > LARGEST:
                raise ValueError(f"a component beyond {LARGEST} after scaling: squared distances would not fit in a long")
            ids = batch.column("id").filter(pa.array(usable))
            yield pa.RecordBatch.from_arrays([ids, _lists(v.astype(np.int32), pa.int32())], ["id", "v"])

    return run


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), kind))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def moved(dots: np.ndarray, v: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Products with ``new`` from products with ``old``: only the changed components of a centroid are read."""
    out = dots.copy()
    for k, change in enumerate(new - old):
        at = np.flatnonzero(change)
        if len(at):
            out[:, k] += v[:, at] @ change[at]
    return out


def _assign(old: np.ndarray, new: np.ndarray, first: bool):
    """The table's rows with the products, cluster and distance under the centroids ``new``."""
    k, dims = new.shape
    norms = (new * new).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), dims)
            dots = np.zeros((len(v), k), np.int64) if first else _matrix(batch.column("dots"), k)
            dots = moved(dots, v, old, new)
            distances = (v * v).sum(axis=1)[:, None] - 2 * dots + norms
            cluster = distances.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("v"),
                    _lists(dots, pa.int64()),
                    pa.array(cluster.astype(np.int32)),
                    pa.array(distances[np.arange(len(v)), cluster]),
                ],
                ["id", "v", "dots", "cluster", "distance"],
            )

    return run


def _means(rows: DataFrame, old: np.ndarray) -> np.ndarray:
    """Componentwise floor of the exact mean of every cluster; an empty cluster keeps its centroid."""
    sums = [F.sum(F.get("v", F.lit(j)).cast("long")) for j in range(old.shape[1])]
    new = old.copy()
    for row in rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("s")).collect():
        new[row["cluster"]] = [s // row["n"] for s in row["s"]]
    return new


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: str = "1",
) -> DataFrame:
    """One row per usable vector: ``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    The first centroids are the ``k`` usable rows with the smallest sha256 of ``seed:id``, ties by the vector.
    """
    spark = vectors.sparkSession
    stage = Stage(spark, "centroids")
    kind = dict(vectors.dtypes)[id_col]
    parsed = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("e"))
    parsed = parsed.withColumn("size", F.coalesce(F.size("e") == dims, F.lit(False)))
    rows = stage.write(parsed.mapInArrow(_integers(dims, scale), f"id {kind}, v array<int>"), "rows")

    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    first = rows.select(named.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    new = np.array([r["v"] for r in first], np.int64).reshape(-1, dims)
    if not len(new):
        new = np.zeros((1, dims), np.int64)  # no usable row: nothing is assigned to it
    old = np.zeros_like(new)
    schema = f"id {kind}, v array<int>, dots array<bigint>, cluster int, distance bigint"
    for r in range(rounds + 1):
        rows = stage.write(rows.mapInArrow(_assign(old, new, first=r == 0), schema), f"assigned-{r}")
        stage.drop(f"assigned-{r - 1}" if r else "rows")
        if r < rounds:
            old, new = new, _means(rows, new)

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in new.tolist()]
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = dict(rows.groupBy("cluster").agg(total).collect())  # one number a cluster
    lookup = F.array(*[F.lit(int(sums.get(c, 0))).cast("long") for c in range(len(new))])
    return rows.select(
        F.col("id").alias(id_col),
        "cluster",
        "distance",
        F.get(lookup, "cluster").alias("cluster_inertia"),
        F.lit(int(sum(sums.values()))).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), "cluster").alias("centroid_sha256"),
    )
