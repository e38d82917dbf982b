"""Connected components of an edge table by alternating hooks and pointer jumps, on Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.session import settle


def _by_node(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges joined to the least of each u. The second key makes Spark shuffle both sides for the join itself, and adaptive
    execution can then split the partition of a hub."""
    return edges.withColumn("h", F.xxhash64("u")).join(least.withColumn("h", F.xxhash64("u")), ["u", "h"]).drop("h")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node is either the v of its edges or the u of exactly one: then v is the least node of its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("outs")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("outs")))
    seen = ends.groupBy("node").agg(F.sum("outs").alias("outs"), F.min("outs").alias("low"))
    return seen.agg(F.count(F.when((F.col("outs") > 1) | (F.col("outs") > F.col("low")), 1))).first()[0] == 0


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 50) -> DataFrame:
    """node, component (the least node of its component) of every node on an edge.

    Each round replaces the edges of a node by edges to the least node around it (large and small star): both halves are
    one grouped minimum and one join, written to the shared folder; rounds grow with the logarithm of the longest path. Edges
    that already lead to the least node of their component, as stars, take no round.
    Null ends and loops are ignored; an empty edge table gives an empty result.
    """
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    now = settle(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        if _is_stars(now):
            break
        # large star: every larger neighbour of a node is linked to the least of its neighbourhood
        wide = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = wide.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _by_node(wide.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.where("u <> v").distinct())
        # small star: a node and its smaller neighbours are linked to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = _by_node(large, least)
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = settle(small.where("u <> v").distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
