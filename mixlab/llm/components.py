"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlab.session import stage

MAX_ROUNDS = 60


def _settled(edges: DataFrame) -> bool:
    """Whether the links (u, its lesser v) are stars: one link per u, and no v is a u."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return not seen.where("ups > 1 or (ups = 1 and low = 0)").take(1)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node it is linked with.

    Each round links every node's larger neighbours to its least one, then its smaller
    neighbours too, until the links are stars; the number of rounds grows with the
    logarithm of the components' size. Every round is written to the shared folder, so
    lineage stays short. Loops and repeated links do no harm; no links, no nodes.
    """
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    for _ in range(MAX_ROUNDS):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.col("c")).alias("m"))
        large = both.join(least, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v"), "links")
        least = large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        joined = large.join(least, F.col("u") == F.col("c"))
        small = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stage(small.where("u <> v").distinct(), "links")
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
