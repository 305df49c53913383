"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens.runtime import cut


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Re-hang each node's larger (else smaller) neighbours on the smallest node around it."""
    around = _both_ways(links) if large else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    hung = around.join(least, "a")
    moved = hung.where("b > a" if large else "b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("low").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``links(a, b)``; the root is its component's smallest node.

    Large and small stars alternate until nothing moves, which takes a number of rounds in the
    order of the logarithm of the largest component. Each round is a grouped minimum and a join back
    to it: a node with very many links is combined in the map tasks and split by the skewed join.
    Links from a node to itself and repeated links are harmless; no links give no rows.
    """
    now = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        now = cut(_star(_star(now, large=True), large=False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
