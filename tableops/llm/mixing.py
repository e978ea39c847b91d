"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Sources share the words of the corpus by weight. A source that would have to be repeated more than ``max_epochs``
times is clamped there, and what it cannot take is shared again among the rest by weight until no source is above
its cap. Within a source every document is repeated the whole number of times that the target is of the source's
size; the fraction that is left goes to the documents with the smallest seeded hashes, up to a threshold that is
found exactly from histograms of the hash, refined level by level. So a source that holds a third of all rows is
only ever pre-aggregated, never gathered or sorted in one task.

Nulls and ties: a null text has size 0; a null source is a source of its own, ranked last; documents whose hashes
tie at the threshold are taken or left together. Reruns agree, as the hash depends on seed and id only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import row_number_within
from .common import Stage, fresh, text_of

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: The hash has 32 bits; each level of the threshold search resolves this many of them.
LEVEL_BITS = (12, 10, 10)

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(col: Column) -> Column:
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(id_col: Column, seed: int) -> Column:
    """32 bits from seed and id."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), id_col.cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")


def water_fill(sources: DataFrame, max_epochs: int) -> float:
    """The level: words per unit of weight in every source that is not clamped. ``sources`` has ``size, weight``.

    Clamping can only raise the level, so the loop ends after at most as many steps as there are sources; each is
    one aggregate over the per-source table that brings back two numbers.
    """
    cap = F.col("size") * max_epochs
    total = sources.agg(F.sum("size").alias("t"), F.sum("weight").alias("w")).first()
    if not total["t"]:
        return 0.0
    level, previous = total["t"] / total["w"], -1.0
    while level != previous:
        previous = level
        over = cap < F.lit(level) * F.col("weight")
        got = sources.agg(F.sum(F.when(over, cap)).alias("clamped"), F.sum(F.when(~over, F.col("weight"))).alias("w")).first()
        if not got["w"]:
            break
        level = (total["t"] - (got["clamped"] or 0)) / got["w"]
    return level


def _thresholds(rows: DataFrame, shares: DataFrame, stage: Stage) -> DataFrame:
    """Per source, the hash where the running size crosses the wanted fraction, and whether it is still taken.

    ``rows``: source, size, u; ``shares``: source, wanted. Each level keeps one bin per source: the first whose
    running size exceeds what is wanted; ``before`` is the size of all earlier bins.
    """
    bits = sum(LEVEL_BITS)
    at = shares.select("source", "wanted", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    done = 0
    for k, b in enumerate(LEVEL_BITS):
        inside = rows.alias("r").join(at.alias("a"), F.col("r.source").eqNullSafe(F.col("a.source"))).where(
            F.shiftright("u", bits - done) == F.col("prefix")
        )
        done += b
        hist = inside.groupBy(F.col("r.source").alias("source"), F.shiftright("u", bits - done).alias("bin")).agg(
            F.sum("size").alias("inside"), F.first("wanted").alias("wanted"), F.first("before").alias("before")
        )
        # at most 2 ** b rows for a source
        w = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        running = hist.withColumn("before", F.col("before") + F.coalesce(F.sum("inside").over(w), F.lit(0)))
        crossing = (
            running.where(F.col("before") + F.col("inside") > F.col("wanted"))
            .groupBy("source")
            .agg(F.min_by(F.struct("bin", "before", "inside", "wanted"), "bin").alias("x"))
        )
        at = stage.write(
            crossing.select("source", F.col("x.wanted").alias("wanted"), F.col("x.bin").alias("prefix"), F.col("x.before").alias("before"), F.col("x.inside").alias("inside")),
            f"level-{k}",
        )
    # the documents at the threshold are taken when that comes nearer to what is wanted
    return at.select("source", F.col("prefix").alias("cut"), (F.col("before") + F.col("inside") / 2 <= F.col("wanted")).alias("take_cut"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 17,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: ``id_col, source, size, source_size, target, copies, taken``, and what ``keep`` names.

    ``weights`` go to the sources in code-point order of their names, over and over, null last.
    """
    stage = Stage(docs.sparkSession, "mix")
    rows = stage.write(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            seeded_hash(F.col(id_col), seed).alias("u"),
            *[value.alias(name) for name, value in (keep or {}).items()],
        ),
        "rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size")).withColumn("none", F.col("source").isNull())
    sizes = row_number_within(stage.write(sizes, "per-source"), [], ["none", "source"], out="position")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("position") - 1, F.lit(len(weights))).cast("int"))
    sizes = stage.write(sizes.select("source", "size", weight.alias("weight")), "sizes")
    level = water_fill(sizes, max_epochs)
    target = F.least((F.col("size") * max_epochs).cast("double"), F.lit(level) * F.col("weight"))
    plan = sizes.select("source", F.col("size").alias("source_size"), target.alias("target")).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    )
    shares = plan.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("wanted")).where("wanted > 0")
    plan = plan.alias("p").join(
        _thresholds(rows, shares, stage).alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")), "left"
    ).select("p.*", "cut", "take_cut")
    plan = stage.write(plan, "plan")
    part = F.when((F.col("u") < F.col("cut")) | ((F.col("u") == F.col("cut")) & F.col("take_cut")), 1).otherwise(0)
    joined = rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    copies = (F.col("whole") + part).cast("long")
    return joined.select(
        F.col("r.id").alias(id_col),
        F.col("r.source").alias("source"),
        F.col("r.size").alias("size"),
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("r.size") * copies).alias("taken"),
        *[F.col(f"r.{name}") for name in keep or ()],
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, repeated ones repeatedly, all columns.

    Copies are looked up by two hashes of id, source and text, so no source is gathered.
    """
    k1, k2, copies = (fresh(docs.columns, name) for name in ("_k1", "_k2", "_copies"))
    row = (F.col(id_col), F.col(source_col), text_of(text_col))
    hashes = {k1: F.xxhash64(F.lit(1), *row), k2: F.xxhash64(F.lit(2), *row)}
    took = mix(docs, id_col, text_col, source_col, keep=hashes, **kw)
    took = took.groupBy(k1, k2).agg(F.max("copies").alias(copies)).where(F.col(copies) > 0)
    joined = docs.withColumns(hashes).join(took, [k1, k2])
    repeats = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    return joined.select(*docs.columns, repeats.alias(k1)).drop(k1)
