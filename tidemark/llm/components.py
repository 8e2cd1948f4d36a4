"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import landed


def _down(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (u, v) with u > v."""
    return pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _are_stars(stars: DataFrame) -> bool:
    """Whether every node is a centre, or hangs on one centre alone: one partial aggregate, one row back."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        stars.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    return ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where(
        "child > 1 or child = 1 and parent = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns ``u, v`` (long). Returns ``node, component`` (least node reachable) of the nodes that
    are not the least of their component; any other node is its own component.

    A round links every node's larger neighbours to the least node around it, then its smaller ones; the
    number of rounds grows with the logarithm of the longest chain. No node's neighbours meet in one
    task: least neighbours come from partial aggregates, and the joins on hot nodes split.
    """
    stars = landed(_down(edges), "edges")
    while not _are_stars(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("n", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").toDF("u", "v").unionByName(least.toDF("u", "v"))
        stars = landed(_down(small), "edges")
    return stars.toDF("node", "component")
