"""Metric tables: a row for each node of a graph, joined from the measures of the other modules. Every measure is a table by node, so a
row is a chain of joins on one key; nodes without an edge can be given and get the values of lone nodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import communities, graph, measures, structure
from corvid.operators.components import connected_components
from corvid.operators.relational import fan_counts
from corvid.session import settle


def _all_nodes(edges: DataFrame, nodes: DataFrame | None) -> DataFrame:
    met = graph.nodes_of(edges).where("node is not null")
    return settle(met if nodes is None else met.unionByName(nodes.select("node").where("node is not null")).distinct())


def _wide(nodes: DataFrame, tables: list[DataFrame], zero: list[str]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, "node", "left"), tables, nodes).na.fill(0, zero)


def component_metadata(edges: DataFrame, nodes: DataFrame | None = None, layers: bool = True) -> DataFrame:
    """node, component_id (least node of its weak component), component_size, scc_id (least node of its strong component), scc_size,
    in_cycle (a strong component of several nodes), layer (longest path of the condensation that leads to it). Without `layers` that
    column is left out, and the condensation isn't built."""
    links = settle(edges.where("src is not null and dst is not null").select("src", "dst").distinct())
    every = _all_nodes(links, nodes)
    weak = connected_components(links).withColumnRenamed("component", "component_id")
    weighted = links.withColumn("weight", F.lit(1))
    strong = (graph.simple_layers(weighted) if layers else graph.strong_components(weighted)).withColumnRenamed("component", "scc_id")
    rows = settle(_wide(every, [weak, strong], ["layer"] if layers else []).withColumns({c: F.coalesce(c, "node") for c in ("component_id", "scc_id")}))
    sizes = [rows.groupBy(f"{c}_id").agg(F.count("*").alias(f"{c}_size")) for c in ("component", "scc")]
    return rows.join(sizes[0], "component_id").join(sizes[1], "scc_id").select(
        "node", "component_id", "component_size", "scc_id", "scc_size", (F.col("scc_size") > 1).alias("in_cycle"), *(["layer"] if layers else [])
    )


def eigenvector(edges: DataFrame, rounds: int = 200, tolerance: float | None = 1e-6) -> DataFrame:
    """node, eigenvector: power iteration on the undirected graph (weights summed, loops kept once), each node adding to its own value
    what its neighbours have, scaled to length 1. It ends once all values together move by less than nodes x tolerance; it is an
    error if `rounds` don't get there. Without a tolerance, that many rounds are taken."""
    known = edges.where("src is not null and dst is not null")
    pairs = known.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.sum("weight").cast("double").alias("weight"))
    ways = settle(pairs.unionByName(pairs.where("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")))
    nodes = settle(graph.nodes_of(known))
    n = nodes.count()
    now = settle(nodes.withColumn("x", F.lit(1.0 / max(n, 1))))
    for _ in range(rounds):
        sent = ways.join(now, ways["src"] == now["node"]).groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("weight") * F.col("x")).alias("got"))
        raw = now.join(sent, "node", "left").select("node", F.col("x").alias("old"), (F.col("x") + F.coalesce("got", F.lit(0.0))).alias("x"))
        raw = settle(raw)
        length = raw.agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
        scaled = raw.crossJoin(F.broadcast(length)).select("node", "old", (F.col("x") / F.col("length")).alias("x"))  # one row
        if tolerance is not None:
            scaled = settle(scaled)
            if (scaled.agg(F.sum(F.abs(F.col("x") - F.col("old")))).first()[0] or 0.0) < n * tolerance:
                return scaled.select("node", F.col("x").alias("eigenvector"))
        now = settle(scaled.select("node", "x"))
    if tolerance is not None and n:
        raise RuntimeError(f"values did not settle in {rounds} rounds")
    return now.select("node", F.col("x").alias("eigenvector"))


def directed_metrics(edges: DataFrame, nodes: DataFrame | None = None, sketched: bool = False, sample: int | None = None) -> DataFrame:
    """Functions of a call graph or modules of an import graph, by node: fan_in, fan_out (distinct), calls_in, calls_out (rows of
    edges(src, dst)), pagerank, closeness, harmonic, betweenness, and the component metadata. With `sketched`, closeness and harmonic
    are estimated without a row for each pair of nodes; `sample` bounds the sources of betweenness."""
    known = settle(edges.where("src is not null and dst is not null").select("src", "dst"))
    weighted = settle(known.groupBy("src", "dst").agg(F.count("*").alias("weight")))
    near = measures.sketched_reach(weighted).select("node", "closeness", "harmonic") if sketched else graph.closeness_harmonic(weighted)
    tables = [
        fan_counts(known, "src", "dst"), graph.pagerank(weighted, rounds=100, tolerance=1e-6).withColumnRenamed("rank", "pagerank"), near, structure.path_betweenness(weighted, sample=sample),
    ]
    zero = ["fan_in", "fan_out", "calls_in", "calls_out", "pagerank", "closeness", "harmonic", "betweenness"]
    return _wide(_all_nodes(known, nodes), tables, zero).join(component_metadata(known, nodes), "node")


def undirected_metrics(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Symbols, subsystems and projections, by node of edges(src, dst, weight): degree, weighted_degree, triangles, clustering, core,
    hole_constraint, effective_size, eigenvector, community, component_id, component_size, is_articulation, is_bridge_end."""
    pairs = settle(graph.undirected_edges(edges))
    ways = graph.both_ways(pairs)
    degree = ways.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("weighted_degree"))
    parts = connected_components(pairs).withColumnRenamed("component", "component_id")
    sizes = parts.groupBy("component_id").agg(F.count("*").alias("component_size"))
    tables = [
        degree, graph.triangles(pairs), graph.core_numbers(pairs), structure.structural_holes(pairs), eigenvector(pairs, 500), communities.merge_communities(pairs).withColumnRenamed("label", "community"),
        parts.join(sizes, "component_id"), structure.cut_nodes(pairs),
    ]
    wide = _wide(_all_nodes(edges.select("src", "dst"), nodes), tables, ["degree", "weighted_degree", "triangles", "clustering", "core", "eigenvector"])
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("is_articulation", "is_bridge_end")}
    return wide.withColumns({"community": F.coalesce("community", "node"), "component_id": F.coalesce("component_id", "node"), "component_size": F.coalesce("component_size", F.lit(1).cast("long"))} | flags)


def module_metrics(edges: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The directed metrics of the groups of labels(node, label): an edge between two groups counts once for each edge between their
    members; groups without edges are rows too."""
    between = graph.quotient(edges.withColumn("weight", F.lit(1)), labels)
    repeated = between.select("src", "dst", F.explode(F.sequence(F.lit(1).cast("long"), F.col("weight").cast("long"))).alias("k")).select("src", "dst")
    return directed_metrics(repeated, labels.select(F.col("label").alias("node")), **options)


def projected_degrees(edges: DataFrame) -> DataFrame:
    """node, projected_degree, projected_weight of the left nodes of edges(src, dst) that share a right node with another one: what both_ways
    and a grouped sum make of `projection`, without a row for each pair of nodes.

    The weight is a sum over a node's right nodes of their degrees less one. For the degree, nodes with equal sets of right nodes (by
    their number and 128 bits of hashes) are one class. A right node that half of all classes have is a hub: a class at a hub meets all
    that are there, and only those that are not are looked for by its other right nodes, as distinct pairs of classes; so are all that
    classes without a hub meet."""
    links = settle(edges.where("src is not null and dst is not null").select("src", "dst").distinct())
    weights = links.join(links.groupBy("dst").agg((F.count("*") - 1).alias("w")), "dst").groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("projected_weight"))
    digest = F.concat_ws(":", F.count("*"), F.bit_xor(F.xxhash64("dst")), F.bit_xor(F.xxhash64(F.lit(1), "dst")))
    homes = settle(links.groupBy(F.col("src").alias("node")).agg(digest.alias("class")))
    classes = homes.groupBy("class").agg(F.count("*").alias("size"), F.min("node").alias("src"))
    held = settle(links.join(classes, "src").select("class", "size", "dst"))
    n = held.select("class").distinct().count()
    hubs = held.groupBy("dst").agg(F.count("*").alias("k"), F.sum("size").alias("degree")).where(F.col("k") * 2 >= n).select(F.col("dst").alias("hub"), "degree")
    tops = held.join(hubs, F.col("dst") == F.col("hub"), "left").groupBy("class").agg(F.max(F.when(F.col("hub").isNotNull(), F.struct("degree", "hub"))).alias("top"))
    tops = settle(tops.select("class", "top.degree", "top.hub"))
    ways = held.select("class", "dst")
    others = held.select(F.col("class").alias("other"), F.col("size").alias("n"), "dst")
    taken = tops.where("hub is not null").select("hub").distinct()  # at most twice the mean number of right nodes of a class
    absent = taken.crossJoin(others.select("other").distinct()).join(ways.select(F.col("dst").alias("hub"), F.col("class").alias("other")), ["hub", "other"], "left_anti")
    far = tops.where("hub is not null").select("class", "hub").join(ways, "class").join(absent.join(others, "other"), ["hub", "dst"]).select("class", "other", "n")
    near = tops.where("hub is null").select("class").join(ways, "class").join(others, "dst").select("class", "other", "n")
    more = far.unionByName(near).distinct().groupBy("class").agg(F.sum("n").alias("more"))
    zero = F.lit(0).cast("long")
    degrees = tops.join(more, "class", "left").select("class", (F.coalesce("degree", zero) + F.coalesce("more", zero) - 1).alias("projected_degree"))
    return homes.join(degrees, "class").join(weights, "node").where("projected_degree > 0").select("node", "projected_degree", "projected_weight")


def bipartite_metrics(edges: DataFrame) -> DataFrame:
    """Tests and functions, or configuration keys and modules, of edges(src, dst, weight): side, node, degree, weighted_degree, centrality,
    and of the projection onto its side: projected_degree, projected_weight."""
    edges = settle(edges)
    flipped = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    sides = [projected_degrees(held).withColumn("side", F.lit(name)) for name, held in (("left", edges), ("right", flipped))]
    both = sides[0].unionByName(sides[1])
    return graph.bipartite_degrees(edges).join(both, ["side", "node"], "left").na.fill(0, ["projected_degree", "projected_weight"])
