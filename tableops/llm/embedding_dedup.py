"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosine, connected components.

Equal vectors are one class; only classes are compared. Each table hashes a class to the signs of its dot products
with ``bits`` random hyperplanes. ``bits`` follows the logarithm of the number of classes, so that a bucket of a
table holds about ``BUCKET`` unrelated classes at any size of the corpus; the number of tables follows from it, so
that a pair at the threshold shares a bucket in at least one table but for a chance of ``MISS``.

The classes of a bucket are compared exactly, in double precision, as a block product; a bucket of more than
``BLOCK`` classes is cut into blocks and every two blocks meet in a task of their own. A pair that shares buckets in
several tables is counted in the first of them only. Tasks return numbers of links and a spanning forest of them,
never the pairs.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of different
lengths never link. Repeated rows and rows with the same id are vectors of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, partitions
from .graph import components

COSINE = 0.95
BUCKET, BLOCK, MISS = 256, 2048, 1e-6
SEED = 20240229


def plan(classes: int, cosine: float = COSINE) -> tuple[int, int]:
    """(bits, tables) for a number of classes."""
    same_sign = 1 - math.acos(cosine) / math.pi
    bits = max(4, math.ceil(math.log2(max(classes, 1) / BUCKET)))
    return bits, math.ceil(math.log(MISS) / math.log(1 - same_sign**bits))


def _keys(planes: Broadcast, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column("v").to_pylist():
                v = np.frombuffer(raw)
                signs = (v @ planes.value[: len(v)] > 0).reshape(-1, bits)
                rows.append(signs @ (1 << np.arange(bits)))
            keys = pa.array([r.tolist() for r in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("cid", "n", "v")] + [keys], ["cid", "n", "v", "keys"])

    return run


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``v``: the doubles of usable vectors; null otherwise."""
    for batch in batches:
        out = []
        for x in batch.column("e").to_pylist():
            v = None if not x or any(c is None for c in x) else np.array(x, np.float64)
            out.append(v.tobytes() if v is not None and np.isfinite(v).all() and v.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "v"])


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw)).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def block_links(left: dict, right: dict | None, table: int, cosine: float):
    """Links within ``left`` or between ``left`` and ``right`` that are new in ``table``.

    A side has ``cid, n, keys, v`` as arrays. Returns (cid, linked vectors) and (cid, cid) forest edges.
    """
    other = left if right is None else right
    linked = _unit(left["v"]) @ _unit(other["v"]).T >= cosine
    if right is None:
        np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    new = np.ones(len(i), bool)
    for t in range(table):
        new &= left["keys"][i, t] != other["keys"][j, t]
    linked[i[~new], j[~new]] = False
    i, j = i[new], j[new]
    counts = [(left["cid"], np.bincount(i, other["n"][j], len(left["cid"])))]
    if right is not None:
        counts.append((right["cid"], np.bincount(j, left["n"][i], len(right["cid"]))))
    # smallest label on either side until nothing changes: one edge a row is left
    a, b = np.arange(linked.shape[0]), np.arange(linked.shape[1])
    ids_a, ids_b = left["cid"].copy(), other["cid"].copy()
    while len(i):
        before = ids_a.copy(), ids_b.copy()
        np.minimum.at(ids_a, i, ids_b[j])
        np.minimum.at(ids_b, j, ids_a[i])
        if (ids_a == before[0]).all() and (ids_b == before[1]).all():
            break
    edges = [(left["cid"][a], ids_a), (other["cid"][b], ids_b)] if len(i) else []
    return counts, edges


def _compare(cosine: float):
    """Per block (rows sorted by block): link numbers as (cid, null, n) and forest edges as (a, b, null)."""

    def close(group: dict[int, list], table: int, same: bool) -> Iterator[pa.RecordBatch]:
        sides = []
        for side in (0, 1):
            rows = group[side]
            if rows:
                sides.append(
                    {
                        "cid": np.array([r[0] for r in rows], np.int64),
                        "n": np.array([r[1] for r in rows], np.float64),
                        "keys": np.array([r[2] for r in rows], np.int32),
                        "v": [r[3] for r in rows],
                    }
                )
        if not sides or (not same and len(sides) < 2):
            return
        counts, edges = block_links(sides[0], None if same else sides[1], table, cosine)
        for cid, n in counts:
            keep = n > 0
            yield _rows(cid[keep], None, n[keep])
        for x, y in edges:
            keep = x != y
            yield _rows(x[keep], y[keep], None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group, kind = None, {0: [], 1: []}, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("block", "side", "same", "t", "cid", "n", "keys", "v")]
            for block, side, same, t, *row in zip(*columns):
                if block != current:
                    if current is not None:
                        yield from close(group, *kind)
                    current, group, kind = block, {0: [], 1: []}, (t, same)
                group[side].append(row)
        if current is not None:
            yield from close(group, *kind)

    return run


def _rows(a: np.ndarray, b: np.ndarray | None, n: np.ndarray | None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), none if b is None else pa.array(b, pa.int64()), none if n is None else pa.array(n.astype(np.int64))],
        ["a", "b", "n"],
    )


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per row: ``id_col, n_links, component_id, kept``."""
    spark = vectors.sparkSession
    stage = Stage(spark, "embeddings")
    kind = dict(vectors.dtypes)[id_col]
    parsed = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("e")).mapInArrow(_vectors, f"id {kind}, v binary")
    keyed = parsed.withColumns(
        {"rid": F.monotonically_increasing_id(), "h1": F.xxhash64(F.lit(1), "v"), "h2": F.xxhash64(F.lit(2), "v")}
    )
    rows = stage.write(keyed, "rows")
    classes = rows.where("v IS NOT NULL").groupBy("h1", "h2").agg(
        F.min("rid").alias("cid"), F.count(F.lit(1)).alias("n"), F.min_by("v", "rid").alias("v")
    )
    classes = stage.write(classes, "classes")
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("v")).alias("d")).first()
    bits, tables = plan(size["n"], cosine)
    planes = spark.sparkContext.broadcast(np.random.default_rng(SEED).standard_normal(((size["d"] or 8) // 8, bits * tables)))
    hashed = classes.select("cid", "n", "v").mapInArrow(_keys(planes, bits), "cid long, n long, v binary, keys array<int>")
    hashed = stage.write(hashed, "hashed")

    member = hashed.select("*", F.octet_length("v").alias("d"), F.posexplode("keys").alias("t", "key"))
    large = member.groupBy("d", "t", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    large = stage.write(large.select("d", "t", "key", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")), "buckets")
    placed = member.join(large, ["d", "t", "key"]).withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    met = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        F.xxhash64("d", "t", "key", F.least("part", "with"), F.greatest("part", "with")).alias("block"),
        (F.col("part") > F.col("with")).cast("int").alias("side"),
        "part",
        "with",
        "t",
        "cid",
        "n",
        "keys",
        "v",
    )
    # a block with itself has one side only
    met = met.withColumn("same", F.col("part") == F.col("with")).drop("part", "with")
    met = met.repartition(partitions(spark), "block").sortWithinPartitions("block")
    found = stage.write(met.mapInArrow(_compare(cosine), "a long, b long, n long"), "found")

    links = found.where("n IS NOT NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("others"))
    labels = components(found.where("b IS NOT NULL").select("a", "b"), Stage(spark, "embedding-components"))
    judged = classes.select("h1", "h2", "cid", "n").join(links, "cid", "left").join(labels, F.col("cid") == F.col("node"), "left")
    judged = stage.write(
        judged.select("h1", "h2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("label", "cid").alias("label")),
        "judged",
    )
    rows_in = rows.select("id", "rid", "h1", "h2", F.col("v").isNotNull().alias("usable"))
    # vectors that cannot link all share one hash of null: they take no part in the join
    usable = rows_in.where("usable").join(judged, ["h1", "h2"]).select("id", "n_links", "label")
    alone = rows_in.where("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("rid").alias("label"))
    labelled = stage.write(usable.unionByName(alone), "labelled")
    least = stage.write(labelled.groupBy("label").agg(F.min("id").alias("component_id")), "least")
    return labelled.join(least, "label").select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
