"""Connected components of a graph that no task or driver could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots; a root is the smallest node.

    Alternating large-star and small-star steps: neighbours above a node move to its smallest
    neighbour, then the rest do. Each round is written out; the driver sees a count and a checksum.
    Only node pairs are shuffled, never lists of neighbours, and loops and repeats are ignored.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    links = materialize(links, "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # lowest neighbours are written, so that a node with very many links can be split in the join
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("_a"), F.least("a", "low").alias("low"))
        lowest = materialize(lowest, "lowest")
        large = both.join(lowest, F.col("a") == F.col("_a")).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialize(large.distinct(), "large-star")
        lowest = materialize(large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "_a"), "lowest")
        moved = large.join(lowest, F.col("a") == F.col("_a"))
        small = moved.filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            moved.select("a", F.col("low").alias("b"))
        )
        links = materialize(small.distinct(), "small-star")
        before, state = state, _state(links)
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
