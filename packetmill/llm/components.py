"""Connected components of a link table by alternating star contractions, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import discard, materialise


def _towards_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of every node (only the larger ones, or else the smaller ones and itself) to the least of its neighbourhood.

    Nodes with many links are aggregated before the shuffle, and the join that hands the
    minimum back is a plain equi-join, whose large partitions Spark splits.
    """
    if larger_only:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    linked = both.join(least, F.col("a") == F.col("k"))
    if larger_only:
        return linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("k").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links of long ids to (node, component): the least id reachable from every node that has a link.

    Links from a node to itself and repeats are harmless; an empty table gives an empty table.
    Each round is written to the shared folder, and the loop ends when a round changes nothing.
    """
    def tidy(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = materialise(tidy(edges), "links")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
        after = materialise(tidy(_towards_least(tidy(_towards_least(now, True)), False)), "links")
        discard(now)
        now = after
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b"), F.col("b")).distinct())
