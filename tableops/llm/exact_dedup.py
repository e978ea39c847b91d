"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition turns its rows into one sorted run of digests. Runs then meet in binomial rounds: in each
round ``FAN`` neighbouring runs exchange their parts, so that a task holds the same digest range of all of them,
merges them in sorted order and keeps, for each digest, the best identifier and the number of rows. After the
last round one run is left, cut into as many digest ranges as there were runs. Equal digests meet as early as possible: a text that
makes up a third of all rows is one row per run after the first merge, and no task ever sees more than one
digest range of ``FAN`` runs. Digests are SHA-256; each level verifies that rows with one digest also agree in
an independent 64-bit hash and in length, and fails otherwise.

Nulls and ties: a null text is empty; the row with the largest id stays (null ids last); of repeated rows with
the same id the first read stays. Rows of the result correspond one to one to rows of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage, ascii_lower, fresh, partitions, text_of

#: How many sorted runs are merged at once.
FAN = 4

_RUN = "run int, digest binary, id long, rid long, n long, check long, n_bytes long"
_ARROW = pa.schema(
    [("run", pa.int32()), ("digest", pa.binary())] + [(c, pa.int64()) for c in ("id", "rid", "n", "check", "n_bytes")]
)


def digests(docs: DataFrame, text: Column, id_col: str) -> DataFrame:
    """``id, rid, part, digest, check, n_bytes`` per row, without the texts; ``rid`` numbers the rows, ``part`` the
    partitions they were read in."""
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("rid"),
        F.spark_partition_id().alias("part"),
        text.alias("t"),
    ).select(
        "id",
        "rid",
        "part",
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.xxhash64("t").alias("check"),
        F.octet_length("t").cast("long").alias("n_bytes"),
    )


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the first row of every (run, digest) with the summed ``n``; rows come sorted by run, digest and rank.

    One batch and one carried row are held at a time.
    """
    carry: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays(batch.columns, schema=_ARROW)
        if carry is not None:
            batch = pa.concat_batches([carry, batch])
        n = batch.num_rows
        run = batch.column("run").to_numpy(zero_copy_only=False)
        digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint64).reshape(n, 4)
        check = batch.column("check").to_numpy(zero_copy_only=False)
        size = batch.column("n_bytes").to_numpy(zero_copy_only=False)
        same = (run[1:] == run[:-1]) & (digest[1:] == digest[:-1]).all(axis=1)
        if (same & ((check[1:] != check[:-1]) | (size[1:] != size[:-1]))).any():
            raise ValueError("two texts share a SHA-256 digest but differ in hash or length")
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        total = np.add.reduceat(batch.column("n").to_numpy(zero_copy_only=False), first)
        kept = batch.take(pa.array(first))
        kept = kept.set_column(kept.schema.get_field_index("n"), "n", pa.array(total, pa.int64()))
        carry = kept.slice(kept.num_rows - 1)
        if kept.num_rows > 1:
            yield kept.slice(0, kept.num_rows - 1)
    if carry is not None:
        yield carry


def _sorted_merge(df: DataFrame) -> DataFrame:
    ranked = df.sortWithinPartitions("run", "digest", F.desc_nulls_last("id"), "rid")
    return ranked.mapInArrow(_merge_sorted, _RUN)


def merge_runs(rows: DataFrame) -> DataFrame:
    """``digest, keep_id, keep_rid, group_size`` per distinct digest from the rows of :func:`digests`.

    There are as many runs as shuffle partitions, rounded up to a power of ``FAN``.
    """
    runs, ranges = 1, 1
    while runs < partitions(rows.sparkSession):
        runs *= FAN
    tasks = runs
    run = F.pmod("part", F.lit(runs)).alias("run")
    merged = _sorted_merge(rows.select(run, "digest", "id", "rid", F.lit(1).cast("long").alias("n"), "check", "n_bytes"))
    while runs > 1:
        runs, ranges = runs // FAN, ranges * FAN
        # the runs of a group exchange: each of the group's tasks takes one digest range of all of them
        lead = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int")
        met = merged.withColumn("run", F.floor(F.col("run") / FAN).cast("int")).withColumn(
            "slot", F.col("run") * ranges + F.floor(lead * ranges / 65536).cast("int")
        )
        merged = _sorted_merge(met.repartition(tasks, "slot").drop("slot"))
    return merged.select("digest", F.col("id").alias("keep_id"), F.col("rid").alias("keep_rid"), F.col("n").alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, rid, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z. The rows and the merged groups are written tables, so
    the join on the digest reads both from scans and a digest with very many rows is split at run time.
    """
    stage = Stage(docs.sparkSession, "exact-dedup")
    rows = stage.write(digests(docs, ascii_lower(text_of(text_col)), id_col), "digests")
    groups = stage.write(merge_runs(rows), "groups")
    return (
        rows.select("id", "rid", "digest")
        .join(groups, "digest")
        .select(
            F.col("id").alias(id_col),
            "rid",
            "keep_id",
            "group_size",
            (F.col("rid") == F.col("keep_rid")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns; of repeated rows with the same id one stays.

    Rows are matched on (id, digest), which is spread evenly however many copies a text has.
    """
    stage = Stage(docs.sparkSession, "exact-dedup")
    text = ascii_lower(text_of(text_col))
    rows = stage.write(digests(docs, text, id_col), "digests")

    def key(id_: Column, hexed: Column) -> Column:
        return F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("null")), hexed)

    name = fresh(docs.columns, "_key")
    stays = stage.write(merge_runs(rows).select(key(F.col("keep_id"), F.lower(F.hex("digest"))).alias(name)), "stays")
    tagged = docs.withColumn(name, key(F.col(id_col).cast("long"), F.sha2(text, 256)))
    return tagged.join(stays, name, "left_semi").dropDuplicates([name]).drop(name)
