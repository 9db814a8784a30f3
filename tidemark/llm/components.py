"""Connected components over an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, join_by_key


def connected_components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> tuple[DataFrame, Scratch]:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has long columns u, v in any orientation; self-loops, repeats and null ends are ignored.
    Returns (node, component) for all nodes but the components' own smallest, and the scratch that holds it.
    Each round groups with partial aggregation and joins on the node; hubs, at most ``HOT_SHARE`` of them, are
    joined by broadcast, so their edges stay spread. The forest after each round is written to the shared folder.
    """
    scratch = Scratch(spark, "cc")
    u, v = F.col("u"), F.col("v")
    forest = scratch.save(
        edges.where(u.isNotNull() & v.isNotNull() & (u != v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges"
    )
    mark = _mark(forest)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = forest.unionByName(forest.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_by_key(both.where(v > u), low, ["u"], "n", 2 * mark[0], "inner").select(v.alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.save(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_by_key(large, least, ["u"], "n", large.count(), "inner").select(v.alias("u"), F.col("m").alias("v")).where(u != v)
        after = scratch.save(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "forest")
        scratch.drop(forest, large)
        forest, before, mark = after, mark, _mark(after)
        if before == mark:
            break
    else:
        raise RuntimeError("components did not settle")
    return forest.select(u.alias("node"), v.alias("component")), scratch


def _mark(forest: DataFrame) -> tuple:
    row = forest.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
    return tuple(row)
