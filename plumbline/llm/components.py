"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import saved, small

NODES_BROADCAST = 500_000


def _least(pairs: DataFrame) -> DataFrame:
    """Each node of the first column with the least node it is linked to, itself included."""
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of the links ``a, b``: the least node that can be reached.

    Each round joins every node's larger neighbours, then its smaller ones, to
    the least of them. The number of rounds grows with the logarithm of the
    longest path. All tables are written; the driver sees only counts.
    """
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = small(saved(_least(both), "least"), NODES_BROADCAST)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.where("a <> b").distinct(), "large")
        least = small(saved(_least(large), "least"), NODES_BROADCAST)
        stars = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = saved(stars.where("a <> b").distinct(), "small")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
