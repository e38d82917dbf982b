"""Call chains: the shortest simple paths that lead from entry points to functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.operators.graph import bfs_levels
from corvid.session import settle


def call_chains(calls: DataFrame, entries: DataFrame, targets: DataFrame, most: int = 3, longest: int = 10) -> DataFrame:
    """target, rank (from 1), chain: for each of targets(node) the `most` simple paths of calls(src, dst) from entries(node), of at
    most `longest` calls; shorter ones first, then by the ids along the path. A target that no entry leads to is a chain of its own,
    and so is one that is an entry itself and has none.

    A search from the targets backward tells how far each node is from them, and paths grow only where a target is still within
    reach. The first pass follows shortest paths, each step one nearer: what is behind two paths at one node is the same, so that
    only the best `most` at each node go on, and hubs don't multiply them. Targets with fewer than `most` are searched again with
    detours, level by level, until enough paths are whole; a path may not come back to its nodes."""
    links = settle(calls.where("src is not null and dst is not null and src <> dst").select("src", "dst").distinct())
    goals = settle(targets.select("node").distinct())
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    left = settle(bfs_levels(back, goals, longest).select(F.col("root").alias("target"), "node", F.col("distance").alias("left")))
    starts = settle(entries.select("node").distinct().join(left, "node").where("left > 0"))
    nearest = settle(starts.groupBy("target").agg(F.min("left").alias("least")))
    begin = starts.join(nearest, "target").where("left = least").select("target", "node", F.array("node").alias("chain"))

    def grow(front: DataFrame) -> DataFrame:
        on = links.select(F.col("src").alias("node"), F.col("dst").alias("next"))
        return front.join(on, "node").where(~F.array_contains("chain", F.col("next"))).select("target", F.col("next").alias("node"), F.concat("chain", F.array("next")).alias("chain"))

    best = Window.partitionBy("target", "node").orderBy("chain")
    front, whole, level = settle(begin), None, 0
    keep = lambda df: df.withColumn("r", F.row_number().over(best)).where(F.col("r") <= most).drop("r")
    front = settle(keep(front))
    while not front.isEmpty():
        level += 1
        step = grow(front).join(left, ["target", "node"]).join(nearest, "target").where(F.col("left") == F.col("least") - level)
        step = settle(keep(step.select("target", "node", "chain")))
        done = step.where("target = node")
        whole = done if whole is None else whole.unionByName(done)
        front = step.where("target <> node")
    counts = None if whole is None else whole.groupBy("target").agg(F.count("*").alias("n"))
    few = nearest if counts is None else nearest.join(counts.where(F.col("n") >= most), "target", "left_anti")
    few = settle(few)
    detours, level = None, 0
    front = settle(starts.join(few, "target", "left_semi").select("target", "node", F.array("node").alias("chain")))
    while level < longest and not front.isEmpty():
        level += 1
        step = settle(grow(front).join(left, ["target", "node"]).where(F.col("left") <= longest - level).select("target", "node", "chain"))
        done = step.where("target = node")
        detours = done if detours is None else settle(detours.unionByName(done))
        enough = detours.groupBy("target").agg(F.count("*").alias("n")).where(F.col("n") >= most)
        front = settle(step.where("target <> node").join(enough, "target", "left_anti"))
    found = goals.select(F.col("node").alias("target"))
    parts = [p.select("target", "chain") for p in (None if whole is None else whole.join(few, "target", "left_anti"), detours) if p is not None]
    if not parts:
        return found.select("target", F.lit(1).alias("rank"), F.array("target").alias("chain"))
    paths = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    ranked = paths.withColumn("rank", F.row_number().over(Window.partitionBy("target").orderBy(F.size("chain"), "chain"))).where(F.col("rank") <= most)
    rest = found.join(ranked, "target", "left_anti").select("target", F.lit(1).alias("rank"), F.array("target").alias("chain"))
    return ranked.select("target", "rank", "chain").unionByName(rest)
