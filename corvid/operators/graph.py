"""Graphs as edge tables (src, dst, weight): building, degrees, distances, ranks, structure. All steps are joins and grouped
sums; loops write their state to the shared folder each round, and end when nothing changes or after a stated number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.operators.dense import is_dense, triangle_sums
from corvid.operators.ranges import numbered
from corvid.session import settle, shuffle_width


def weighted_edges(pairs: DataFrame, src: str, dst: str, weight: Column | None = None) -> DataFrame:
    """src, dst, weight: the number of pairs or the sum of a weight; pairs with a null end are left out."""
    known = pairs.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    total = F.count("*") if weight is None else F.sum(weight)
    return known.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(total.alias("weight"))


def undirected_edges(edges: DataFrame) -> DataFrame:
    """Each pair once with src < dst, weights summed, loops dropped."""
    return (
        edges.where("src <> dst")
        .groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.sum("weight").alias("weight"))
    )


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst", "weight").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()


def neighbor_stats(edges: DataFrame) -> DataFrame:
    """node, out_degree, in_degree (distinct neighbours), out_weight, in_weight."""
    out = edges.groupBy(F.col("src").alias("node")).agg(F.countDistinct("dst").alias("out_degree"), F.sum("weight").alias("out_weight"))
    into = edges.groupBy(F.col("dst").alias("node")).agg(F.countDistinct("src").alias("in_degree"), F.sum("weight").alias("in_weight"))
    return out.join(into, "node", "full_outer").na.fill(0)


def bipartite_degrees(edges: DataFrame) -> DataFrame:
    """side, node, degree, weighted_degree, centrality (degree over the size of the other side)."""

    def side(name: str, own: str, other: str) -> DataFrame:
        size = edges.agg(F.countDistinct(other).alias("n"))
        rows = edges.groupBy(F.col(own).alias("node")).agg(F.countDistinct(other).alias("degree"), F.sum("weight").alias("weighted_degree"))
        return rows.crossJoin(F.broadcast(size)).select(F.lit(name).alias("side"), "node", "degree", "weighted_degree", (F.col("degree") / F.col("n")).alias("centrality"))

    return side("left", "src", "dst").unionByName(side("right", "dst", "src"))


#: A task of `projection` makes about so many pairs, and at a right node each block of BLOCK_NODES left nodes is met with all of them alone.
TASK_PAIRS = 2_000_000
BLOCK_NODES = 1024


def projection(edges: DataFrame, most: int | None = None) -> DataFrame:
    """src < dst, weight: pairs of left nodes by the number of right nodes that they share. The pairs at one right node
    grow with the square of its degree; `most` leaves out right nodes of a higher degree, and is None unless stated.

    Tasks are as many as the pairs need, not the links, so that what one holds doesn't grow with the input."""
    links = edges.select(F.col("src"), F.col("dst")).distinct()
    if most is not None:
        links = links.join(links.groupBy("dst").count().where(F.col("count") <= most).select("dst"), "dst", "left_semi")
    links = settle(links)
    degrees = links.groupBy("dst").agg(F.count("*").alias("k"), F.ceil(F.count("*") / BLOCK_NODES).alias("blocks"))
    pairs = degrees.agg(F.sum(F.col("k") * (F.col("k") - 1))).first()[0] or 0
    tasks = max(shuffle_width(edges.sparkSession), -(-int(pairs) // (2 * TASK_PAIRS)))
    known = links.join(degrees.select("dst", "blocks"), "dst")
    a = known.select(F.col("src").alias("a"), "dst", F.pmod(F.xxhash64("src"), "blocks").alias("block"))
    b = known.select(F.col("src").alias("b"), "dst", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    met = a.repartition(tasks, "dst", "block").join(b.repartition(tasks, "dst", "block"), ["dst", "block"]).where("a < b")
    return met.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.count("*").alias("weight"))


def projection_stars(edges: DataFrame) -> DataFrame:
    """src, dst: the least left node at each right node, with each of the others there. These are pairs of `projection`, no more than edges,
    and its components are theirs."""
    links = edges.select("src", "dst", F.xxhash64("dst").alias("h")).distinct()  # h: a join that Spark can split at hubs
    least = links.groupBy("dst").agg(F.min("src").alias("least")).withColumn("h", F.xxhash64("dst"))
    return links.join(least, ["dst", "h"]).where("src <> least").select(F.col("least").alias("src"), F.col("src").alias("dst")).distinct()


def bfs_levels(edges: DataFrame, roots: DataFrame, most: int | None = None) -> DataFrame:
    """root, node, distance: least numbers of edges from each root; one join a level, until no new node is reached, or as
    far as `most` where a radius is asked for."""
    links = settle(edges.select("src", "dst").distinct())
    known = settle(roots.select(F.col("node").alias("root"), "node", F.lit(0).alias("distance")))
    front, level = known, 0
    while most is None or level < most:
        level += 1
        reached = front.join(links, front["node"] == links["src"]).select("root", F.col("dst").alias("node")).distinct()
        front = settle(reached.join(known.select("root", "node"), ["root", "node"], "left_anti").withColumn("distance", F.lit(level)))
        if front.isEmpty():
            break
        known = known.unionByName(front)
        if level % 16 == 0:  # long paths: the union of levels stays short
            known = settle(known)
    return known


def reach_counts(edges: DataFrame, most: int | None = None) -> DataFrame:
    """node, descendants, ancestors: sizes of what can be reached, the node itself left out."""
    reached = settle(bfs_levels(edges, nodes_of(edges), most).where("root <> node"))
    down = reached.groupBy(F.col("root").alias("node")).agg(F.count("*").alias("descendants"))
    up = reached.groupBy("node").agg(F.count("*").alias("ancestors"))
    return nodes_of(edges).join(down, "node", "left").join(up, "node", "left").na.fill(0)


def closeness_harmonic(edges: DataFrame) -> DataFrame:
    """node, closeness (inbound, scaled by the share of nodes that reach it), harmonic (inbound, a plain sum)."""
    nodes = settle(nodes_of(edges))
    total = nodes.agg(F.count("*").alias("n"))
    paths = bfs_levels(edges, nodes).where("distance > 0")
    sums = paths.groupBy("node").agg(F.count("*").alias("r"), F.sum("distance").alias("d"), F.sum(1.0 / F.col("distance")).alias("harmonic"))
    near = (F.col("r") / F.col("d")) * (F.col("r") / (F.col("n") - 1))
    return nodes.join(sums, "node", "left").crossJoin(F.broadcast(total)).select("node", F.coalesce(near, F.lit(0.0)).alias("closeness"), F.coalesce("harmonic", F.lit(0.0)).alias("harmonic"))


def dag_layers(edges: DataFrame) -> DataFrame:
    """node, layer: the longest path from a node without predecessors; for acyclic edges. Layers deeper than there are nodes
    mean a cycle, and are an error."""
    links = settle(edges.select("src", "dst").distinct())
    nodes = settle(nodes_of(links))
    most = nodes.count()
    layers, moved = nodes.withColumn("layer", F.lit(0)), 0
    while True:
        deeper = links.join(layers, F.col("src") == F.col("node")).groupBy(F.col("dst").alias("node")).agg((F.max("layer") + 1).alias("deeper"))
        deepest = F.coalesce("deeper", F.lit(0))
        after = settle(layers.join(deeper, "node", "left").select("node", deepest.alias("layer"), (deepest != F.col("layer")).alias("moved")))
        layers, moved = after.select("node", "layer"), moved + 1
        if after.where("moved").isEmpty():
            return layers
        if moved > most:
            raise ValueError("the edges have a cycle")


def pagerank(edges: DataFrame, damping: float = 0.85, rounds: int = 20, tolerance: float | None = None) -> DataFrame:
    """node, rank after a number of power iterations; weighted, dangling mass spread evenly. With a tolerance, iterations end
    once the ranks of all nodes move by less than nodes x tolerance together; it is an error if `rounds` don't get there."""
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    shares = settle(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share")))
    nodes = settle(nodes_of(edges))
    n = nodes.count()
    sinks = settle(nodes.join(out.select(F.col("src").alias("node")), "node", "left_anti"))
    ranks, before = nodes.withColumn("rank", F.lit(1.0 / n)), None
    for _ in range(rounds):
        ranks = settle(ranks)
        if tolerance is not None and before is not None:
            moves = ranks.join(before.withColumnRenamed("rank", "old"), "node").agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
            if (moves or 0.0) < n * tolerance:
                return ranks
        before = ranks
        lost = ranks.join(sinks, "node", "left_semi").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("lost"))
        moved = ranks.join(shares, F.col("node") == F.col("src")).groupBy("dst").agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        ranks = (
            nodes.join(moved, F.col("node") == F.col("dst"), "left")
            .crossJoin(F.broadcast(lost))
            .select("node", ((1 - damping) / n + damping * (F.coalesce("got", F.lit(0.0)) + F.col("lost") / n)).alias("rank"))
        )
    if tolerance is not None:
        raise RuntimeError(f"ranks did not settle in {rounds} rounds")
    return ranks


def triangles(edges: DataFrame) -> DataFrame:
    """node, degree, triangles, clustering of an undirected graph. Edges point from the lower to the higher degree, so a
    hub never pairs up all of its neighbours. A dense graph's triangles are counted by products of blocks."""
    simple = settle(undirected_edges(edges).select("src", "dst"))
    degree = settle(both_ways(simple.withColumn("weight", F.lit(1))).groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree")))
    a, b = degree.select(F.col("node").alias("src"), F.col("degree").alias("da")), degree.select(F.col("node").alias("dst"), F.col("degree").alias("db"))
    up = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("src") < F.col("dst")))
    turned = settle(simple.join(a, "src").join(b, "dst").select(F.when(up, F.col("src")).otherwise(F.col("dst")).alias("x"), F.when(up, F.col("dst")).otherwise(F.col("src")).alias("y")))
    wedges = turned.groupBy("x").count().agg(F.sum(F.expr("count * (count - 1) div 2"))).first()[0] or 0
    pairs = F.col("degree") * (F.col("degree") - 1)
    if is_dense(degree.count(), wedges):
        sums = triangle_sums(both_ways(simple.withColumn("weight", F.lit(1))), holes=False).select("node", F.expr("closed div 2").alias("triangles"))
        rows = degree.join(sums, "node", "left").na.fill(0, ["triangles"])
        return rows.withColumn("clustering", F.when(pairs > 0, 2.0 * F.col("triangles") / pairs).otherwise(0.0))
    wedge = turned.select("x", F.col("y").alias("y1")).join(turned.select("x", F.col("y").alias("y2")), "x").where("y1 < y2")
    closed = wedge.join(simple, (F.col("y1") == F.col("src")) & (F.col("y2") == F.col("dst")), "left_semi")
    count = closed.select(F.explode(F.array("x", "y1", "y2")).alias("node")).groupBy("node").agg(F.count("*").alias("triangles"))
    rows = degree.join(count, "node", "left").na.fill(0, ["triangles"])
    return rows.withColumn("clustering", F.when(pairs > 0, 2.0 * F.col("triangles") / pairs).otherwise(0.0))


def core_numbers(edges: DataFrame) -> DataFrame:
    """node, core: each node's value starts at its degree and becomes the largest h such that h neighbours have values of h
    or more, until no value moves; these values are the core numbers. Neighbours are counted by value, at most the node's
    own, before they are gathered, so that a hub holds as many entries as its value at most."""
    links = settle(both_ways(undirected_edges(edges)).select("src", "dst"))
    values = settle(links.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("core")))
    while True:
        mine = values.select(F.col("node").alias("src"), F.col("core").alias("own"))
        theirs = values.select(F.col("node").alias("dst"), F.col("core").alias("value"))
        counts = links.join(theirs, "dst").join(mine, "src").groupBy("src", "own", F.least("own", "value").alias("value")).agg(F.count("*").alias("n"))
        found = F.sort_array(F.collect_list(F.struct("value", "n")), False)  # the largest values first
        zero = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("h"))
        step = lambda acc, x: F.struct((acc["seen"] + x["n"]).alias("seen"), F.greatest(acc["h"], F.least(x["value"], acc["seen"] + x["n"])).alias("h"))
        h = counts.groupBy("src", "own").agg(found.alias("found")).select(F.col("src").alias("node"), F.aggregate("found", zero, step)["h"].alias("core"), "own")
        after = settle(h)
        values = after.select("node", "core")
        if after.where("core <> own").isEmpty():
            return values


def rich_club(edges: DataFrame, share: float = 0.1) -> DataFrame:
    """node, degree, rich: degree at or above that of the node at place max(0, int(share n) - 1) by descending degree."""
    degree = settle(both_ways(undirected_edges(edges)).groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree")))
    place = max(0, int(share * degree.count()) - 1)
    cut = degree.orderBy(F.desc("degree")).offset(place).limit(1).select(F.col("degree").alias("cut"))
    return degree.crossJoin(F.broadcast(cut)).select("node", "degree", (F.col("degree") >= F.col("cut")).alias("rich"))


def quotient(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """src, dst, weight between the groups of labels(node, label), inner edges dropped."""
    a, b = labels.select(F.col("node").alias("src"), F.col("label").alias("a")), labels.select(F.col("node").alias("dst"), F.col("label").alias("b"))
    joined = edges.join(a, "src").join(b, "dst").where("a <> b")
    return joined.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("weight").alias("weight"))


def boundary(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """label, internal and external weight, distinct groups that it points to and that point to it."""
    a, b = labels.select(F.col("node").alias("src"), F.col("label").alias("a")), labels.select(F.col("node").alias("dst"), F.col("label").alias("b"))
    joined = edges.join(a, "src").join(b, "dst")
    ends = joined.select(F.col("a").alias("label"), F.col("b").alias("other"), "weight", F.lit(True).alias("out"))
    ends = ends.unionByName(joined.where("a <> b").select(F.col("b").alias("label"), F.col("a").alias("other"), "weight", F.lit(False).alias("out")))
    outer = F.col("label") != F.col("other")
    return ends.groupBy("label").agg(
        F.sum(F.when(~outer, F.col("weight")).otherwise(0)).alias("internal"),
        F.sum(F.when(outer, F.col("weight")).otherwise(0)).alias("external"),
        F.countDistinct(F.when(outer & F.col("out"), F.col("other"))).alias("fan_out"),
        F.countDistinct(F.when(outer & ~F.col("out"), F.col("other"))).alias("fan_in"),
    )


def strong_components(edges: DataFrame) -> DataFrame:
    """node, component (its least member). Each round drops nodes that have no way in or out of what is left, as long as these are a
    tenth of it, then spreads colours forward by the least hash, and back within a colour: what a colour's root
    reaches both ways is a component. Hashes cut a path at random places, so that rounds grow with the logarithm of it;
    rounds end when no node is left, and each takes one component of every colour at least."""
    links = settle(edges.select("src", "dst").where("src <> dst").distinct())
    nodes = settle(nodes_of(edges))
    done = None

    def keep(part: DataFrame) -> None:
        nonlocal done, nodes, links
        done = part if done is None else settle(done.unionByName(part))
        nodes = settle(nodes.join(part.select("node"), "node", "left_anti"))
        ends = [nodes.select(F.col("node").alias(c)) for c in ("src", "dst")]
        links = settle(links.join(ends[0], "src", "left_semi").join(ends[1], "dst", "left_semi"))

    while not nodes.isEmpty():
        while True:
            both = links.select(F.col("src").alias("node")).distinct().intersect(links.select(F.col("dst").alias("node")).distinct())
            alone = settle(nodes.join(both, "node", "left_anti"))
            n, left = alone.count(), nodes.count()
            if not n:
                break
            keep(alone.select("node", F.struct(F.xxhash64("node").alias("h"), "node").alias("colour")))
            if n == left or 10 * n < left:
                break
        if nodes.isEmpty():
            break
        colour = settle(nodes.select("node", F.struct(F.xxhash64("node").alias("h"), "node").alias("colour")))
        while True:
            got = links.join(colour, F.col("src") == F.col("node")).groupBy(F.col("dst").alias("node")).agg(F.min("colour").alias("least"))
            least = F.least("colour", F.coalesce("least", "colour"))
            after = settle(colour.join(got, "node", "left").select("node", least.alias("colour"), (least != F.col("colour")).alias("moved")))
            colour = after.select("node", "colour")
            if after.where("moved").isEmpty():
                break
        found = settle(colour.where("node = colour.node"))
        front, level = found, 0
        while True:
            back = front.join(links, F.col("node") == F.col("dst")).select(F.col("src").alias("node"), "colour").distinct()
            front = settle(back.join(colour, ["node", "colour"], "left_semi").join(found, ["node", "colour"], "left_anti"))
            if front.isEmpty():
                break
            found, level = found.unionByName(front), level + 1
            if level % 16 == 0:
                found = settle(found)
        keep(settle(found))
    if done is None:
        return nodes.select("node", F.col("node").alias("component"))
    names = done.groupBy("colour").agg(F.min("node").alias("component"))
    return done.join(names, "colour").select("node", "component")


def edge_ranks(edges: DataFrame, share: float) -> DataFrame:
    """The heaviest share of the edges, ties by the ends: a threshold that means the same at any size. Edges are sorted in
    ranges, and a table with a row for each range holds the edges before it, so that no task sees them all."""
    placed, n = numbered(edges, [F.desc("weight"), F.col("src"), F.col("dst")])
    return placed.where(F.col("__place") < max(1, int(n * share))).select(*edges.columns)


def simple_layers(edges: DataFrame) -> DataFrame:
    """node, component, layer over the condensation of strong components."""
    parts = settle(strong_components(edges))
    labels = parts.withColumnRenamed("component", "label")
    condensed = quotient(edges, labels).select("src", "dst")
    layers = dag_layers(condensed) if not condensed.isEmpty() else parts.select(F.col("component").alias("node"), F.lit(0).alias("layer")).distinct()
    return parts.join(layers.withColumnRenamed("node", "component"), "component", "left").na.fill(0, ["layer"])


def ego(edges: DataFrame, root: object, radius: int, most: int) -> DataFrame:
    """The nodes within radius of one node, nearest first, `most` of them (a report)."""
    start = edges.sparkSession.createDataFrame([(root,)], "node long")
    return bfs_levels(edges, start, radius).orderBy("distance", "node").limit(most)

