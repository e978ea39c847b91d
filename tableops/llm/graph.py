"""Distributed connected components by randomised contraction.

Each round every node picks, among itself and its neighbours, the one that comes first in an order drawn anew for
the round; edges are relabelled with the picks, and loops and repeats go. The number of nodes that still have edges
falls by a constant factor a round in expectation, whatever the shape of the graph, and the edges never grow.
The picks of all rounds put together give each node its component. Edges, picks and labels are written tables, so
the joins read scans on both sides and a node with very many edges is split at run time; nothing but an emptiness
test reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage


def components(edges: DataFrame, stage: Stage, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node with an edge; ``label`` is the smallest node of its component. Loops and
    nulls are ignored."""
    links = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL")
    links = stage.write(links.where("a <> b").distinct(), "links-0")
    label, k = None, 0
    while not links.isEmpty():
        ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(k), c).alias("h"), F.col(c).alias("node"))  # noqa: B023, E731
        picks = ends.groupBy("a").agg(F.min(rank("b")).alias("best"))
        picks = stage.write(picks.select(F.col("a").alias("node"), F.least("best", rank("a"))["node"].alias("pick")), f"picks-{k}")
        first = links.join(picks.withColumnRenamed("node", "a"), "a").select(F.col("pick").alias("pa"), "b")
        first = stage.write(first, f"half-{k}")
        both = first.join(picks.withColumnRenamed("node", "b"), "b").select(F.least("pa", "pick").alias("a"), F.greatest("pa", "pick").alias("b"))
        links = stage.write(both.where("a <> b").distinct(), f"links-{k + 1}")
        if label is None:
            label = picks.withColumnRenamed("pick", "label")
        else:
            moved = label.join(picks.withColumnRenamed("node", "label"), "label", "left")
            label = stage.write(moved.select("node", F.coalesce("pick", "label").alias("label")), f"labels-{k}")
        stage.drop(f"links-{k}", f"half-{k}")
        k += 1
    if label is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    least = stage.write(label.groupBy("label").agg(F.min("node").alias("least")), "least")
    return stage.write(label.join(least, "label").select("node", F.col("least").alias("label")), "components")
