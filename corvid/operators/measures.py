"""Measures of whole graphs whose exact form needs a row for each pair of nodes: by sketches of neighbourhoods that travel along
edges. And the table of global statistics, with the clustering of directed graphs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators.components import connected_components
from corvid.operators.graph import bfs_levels, nodes_of, simple_layers
from corvid.operators.ranges import numbered
from corvid.operators.registers import sliced_neighbourhoods
from corvid.operators.sketches import ROWS, Sketches
from corvid.session import settle, shuffle_width

#: 2^LG registers a sketch. Sets of up to about 2^(LG - 3) members are counted exactly, larger ones with a relative standard error
#: of 1.04 / 2^(LG / 2), 1.6 % at 12; a sketch takes 2^LG bytes at most.
LG = 12


#: A task unites the sketches of a block of nodes: at most so many bytes of them, and no fewer nodes than make a task worth while.
BLOCK_BYTES, BLOCK_NODES = 1 << 27, 4096


def _unite(lg: int, size: int):
    """Rows of the whole nodes of a block, with the unions of their sketches and of those sent to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, tuple[Sketches, list[pa.StructArray]]] = {}
        for batch in batches:
            to, images = batch.column("to"), batch.column("sketch")
            ends, flat, of = to.offsets.to_numpy(), to.values.to_numpy(), batch.column("block").to_numpy()
            for block in np.unique(of):
                held = blocks.setdefault(int(block), (Sketches(lg, size), []))
                held[1].append(batch.column("own").filter(pc.and_(pc.equal(batch.column("block"), block), batch.column("own").is_valid())))
            for i, block in enumerate(of):
                blocks[block][0].add(images[i].as_buffer(), flat[ends[i] : ends[i + 1]])
        for sketches, parts in blocks.values():
            for own in (p.slice(k, ROWS) for p in parts for k in range(0, len(p), ROWS)):
                columns = dict(zip([f.name for f in own.type], own.flatten(), strict=True))
                columns["sketch"] = pa.array(list(sketches.images(columns["at"].to_numpy())), pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def neighbourhoods(edges: DataFrame, lg: int = LG, inbound: bool = True) -> DataFrame:
    """node, reached (nodes that reach it, itself left out), distance_sum, harmonic (sums of distances and of their
    inverses), last (the round in which its set last grew). Outbound sets with inbound=False. Round t unites each set with those
    of the nodes one edge before it, so it then holds all within t edges; only sets that grew are sent, and rounds end with the longest
    shortest path. No row stands for a pair of nodes.

    Nodes are dealt to blocks by their order, and a set goes once to each block that has an edge from it, with the places of the
    nodes there, not once along each edge. A round is one shuffle of these; the state of the round before is deleted."""
    far, near = ("src", "dst") if inbound else ("dst", "src")
    links = settle(edges.where("src is not null and dst is not null and src <> dst").select(F.col(far).alias("far"), F.col(near).alias("node")).distinct())
    placed, n = numbered(nodes_of(edges).where("node is not null"), ["node"])
    size = max(1, min(BLOCK_BYTES >> lg, max(BLOCK_NODES, -(-n // shuffle_width(edges.sparkSession)))))
    homes = settle(placed.select("node", F.floor(F.col("__place") / size).cast("int").alias("block"), (F.col("__place") % size).cast("int").alias("at")))
    sends = links.join(homes, "node").groupBy("far", "block").agg(F.collect_list("at").alias("to")).groupBy(F.col("far").alias("node")).agg(F.collect_list(F.struct("block", "to")).alias("sends"))
    own = homes.groupBy("node", "block", "at").agg(F.hll_sketch_agg("node", F.lit(lg)).alias("sketch"))
    zero = F.lit(0.0)
    none = F.array().cast("array<struct<block: int, to: array<int>>>")
    rest = [F.lit(1.0).alias("size"), zero.alias("distance_sum"), zero.alias("harmonic"), F.lit(0).alias("last")]
    state = settle(own.join(sends, "node", "left").select("node", "block", "at", F.coalesce("sends", none).alias("sends"), *rest, "sketch"))
    schema, level = state.schema, 0
    while True:
        level += 1
        home = F.struct("block", F.array("at").alias("to"), F.lit(True).alias("mine"))
        away = F.transform("sends", lambda x: F.struct(x["block"].alias("block"), x["to"].alias("to"), F.lit(False).alias("mine")))
        sent = state.select(F.explode(F.when(F.col("last") == level - 1, F.concat(F.array(home), away)).otherwise(F.array(home))).alias("s"), "sketch", F.struct(*(c for c in state.columns if c != "sketch")).alias("own"))
        sent = sent.select("s.block", "s.to", "sketch", F.when(F.col("s.mine"), F.col("own")).alias("own"))
        united = sent.repartitionById(max(1, -(-n // size)), "block").mapInArrow(_unite(lg, size), schema)
        grown = united.withColumn("now", F.greatest(F.hll_sketch_estimate("sketch").cast("double"), "size"))
        more = F.col("now") - F.col("size")
        state = settle(
            grown.select(
                "node", "block", "at", "sends", F.col("now").alias("size"), (F.col("distance_sum") + level * more).alias("distance_sum"), (F.col("harmonic") + more / level).alias("harmonic"),
                F.when(more > 0, level).otherwise(F.col("last")).alias("last"), "sketch",
            ), state
        )
        if state.where(F.col("last") == level).isEmpty():
            return settle(state.select("node", (F.col("size") - 1).alias("reached"), "distance_sum", "harmonic", "last"), state)


def _around(edges: DataFrame, lg: int, inbound: bool = True) -> DataFrame:
    """Neighbourhoods by slices of registers where a task can hold the graph, else by sketches that travel."""
    found = sliced_neighbourhoods(edges, lg, inbound)
    return neighbourhoods(edges, lg, inbound) if found is None else found


def sketched_reach(edges: DataFrame, lg: int = LG) -> DataFrame:
    """node, descendants, ancestors, closeness and harmonic (inbound) from two passes of sketches."""
    edges = settle(edges.select("src", "dst"))
    into, out = _around(edges, lg), _around(edges, lg, inbound=False)
    n = into.agg(F.count("*").alias("n"))
    near = F.col("reached") / F.col("distance_sum") * F.col("reached") / (F.col("n") - 1)
    return (
        into.join(out.select("node", F.col("reached").alias("descendants")), "node")
        .crossJoin(F.broadcast(n))  # one row
        .select("node", "descendants", F.col("reached").alias("ancestors"), F.when(F.col("distance_sum") > 0, near).otherwise(0.0).alias("closeness"), "harmonic")
    )


def largest_component(edges: DataFrame) -> DataFrame:
    """src, dst both ways of the component with the most nodes, ties by its least node."""
    parts = settle(connected_components(edges))
    best = parts.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "component").limit(1).select("component")
    inside = parts.join(F.broadcast(best), "component").select(F.col("node").alias("src"))  # one row
    held = settle(edges.where("src <> dst").select("src", "dst").join(inside, "src", "left_semi").distinct())
    return held.unionByName(held.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def path_stats(edges: DataFrame, lg: int = LG) -> DataFrame:
    """One row about the largest component without directions: nodes, diameter_low, diameter_high, mean_path. The bounds come from
    two sweeps, from the least node and from the least of those farthest from it: the second one's depth is a lower bound, and
    twice the lesser depth an upper one. mean_path is estimated by sketches."""
    ways = settle(largest_component(edges))
    around = _around(ways, lg)
    first = bfs_levels(ways, nodes_of(ways).agg(F.min("node").alias("node")).where("node is not null"))
    end = settle(first.groupBy("distance").agg(F.min("node").alias("node")).orderBy(F.desc("distance")).limit(1))
    second = bfs_levels(ways, end.select("node"))
    depths = end.agg(F.max("distance").alias("a")).crossJoin(second.agg(F.max("distance").alias("b")))  # one row each
    n = F.col("nodes")
    return (
        around.agg(F.count("*").alias("nodes"), F.sum("distance_sum").alias("total"))
        .crossJoin(depths)
        .select(
            "nodes", F.greatest("a", "b").alias("diameter_low"), (2 * F.least("a", "b")).alias("diameter_high"),
            F.when(n > 1, F.col("total") / (n * (n - 1))).alias("mean_path"),
        )
    )


def directed_clustering(edges: DataFrame) -> DataFrame:
    """node, clustering of a directed graph: closed over possible directed triangles, two-way edges counted twice. Pairs point to
    the higher degree, so that a hub never pairs up all of its neighbours."""
    links = settle(edges.where("src is not null and dst is not null and src <> dst").select("src", "dst").distinct())
    pairs = settle(links.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.count("*").alias("m")))
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("node"), "m")
    degree = settle(ends.groupBy("node").agg(F.sum("m").alias("total"), F.count_if(F.col("m") == 2).alias("both"), F.count("*").alias("d")))
    a, b = degree.select(F.col("node").alias("src"), F.col("d").alias("da")), degree.select(F.col("node").alias("dst"), F.col("d").alias("db"))
    up = F.struct("da", "src") < F.struct("db", "dst")
    turned = settle(pairs.join(a, "src").join(b, "dst").select(F.when(up, F.col("src")).otherwise(F.col("dst")).alias("x"), F.when(up, F.col("dst")).otherwise(F.col("src")).alias("y"), "m"))
    one, two = turned.select("x", F.col("y").alias("y1"), F.col("m").alias("m1")), turned.select("x", F.col("y").alias("y2"), F.col("m").alias("m2"))
    far = pairs.select(F.col("src").alias("y1"), F.col("dst").alias("y2"), F.col("m").alias("m3"))
    closed = one.join(two, "x").where("y1 < y2").join(far, ["y1", "y2"]).withColumn("p", F.col("m1") * F.col("m2") * F.col("m3"))
    sums = closed.select(F.explode(F.array("x", "y1", "y2")).alias("node"), "p").groupBy("node").agg(F.sum("p").alias("t"))
    room = F.col("total") * (F.col("total") - 1) - 2 * F.col("both")
    known = degree.join(sums, "node", "left").select("node", F.when(F.col("t") > 0, F.col("t") / room).otherwise(0.0).alias("clustering"))
    return nodes_of(edges).where("node is not null").join(known, "node", "left").na.fill(0.0, ["clustering"])


def global_stats(name: str, edges: DataFrame) -> DataFrame:
    """One row: graph, nodes, edges, weak_components, strong_components, layers (of the condensation), mean_clustering. Nodes are
    those on edges; a loop is an edge."""
    links = settle(edges.where("src is not null and dst is not null").select("src", "dst").distinct())
    nodes = settle(nodes_of(links))
    weak = connected_components(links)
    strong = simple_layers(links.withColumn("weight", F.lit(1)))
    met, lone = F.col("met"), F.col("nodes") - F.col("k")  # nodes with loops only are components of their own
    return (
        nodes.agg(F.count("*").alias("nodes"))
        .crossJoin(links.agg(F.count("*").alias("edges")))  # one row each, here and below
        .crossJoin(weak.agg(F.countDistinct("component").alias("met"), F.count("*").alias("k")))
        .crossJoin(strong.agg(F.countDistinct("component").alias("strong_components"), F.max("layer").alias("deepest")))
        .crossJoin(directed_clustering(links).agg(F.avg("clustering").alias("mean_clustering")))
        .select(
            F.lit(name).alias("graph"), "nodes", "edges", (met + lone).alias("weak_components"), "strong_components",
            F.coalesce(F.col("deepest") + 1, F.lit(0)).alias("layers"), F.coalesce("mean_clustering", F.lit(0.0)).alias("mean_clustering"),
        )
    )
