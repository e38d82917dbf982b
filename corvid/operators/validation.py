"""Checks of a snapshot's tables and graphs, as findings: check_name, severity, path, detail, items (how many), sample (the first few, in
order). A check that finds nothing has no row. Findings of a graph are one row for each check; what was found is counted and its first
few taken by combined aggregates, and never gathered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.operators import graph, structure
from corvid.operators.metric_tables import component_metadata
from corvid.session import settle

# Least degrees and sizes that count as unusual.
HUB_FLOOR = 10
HUB_SHARE = 0.1
LARGE_CYCLE = 5
LARGE_COMMUNITY = 2
CONFIG_FLOOR = 2
CONFIG_SHARE = 0.05
BRIDGE_SHARE = 0.25
SAMPLE = 5


def _summary(found: DataFrame, item: Column, check: str, severity: str, text: str) -> DataFrame:
    """One finding about all rows of found, none if it is empty; the sample is the least few items."""
    rows = settle(found.select(item.cast("string").alias("item")))
    first = rows.orderBy("item").limit(SAMPLE).agg(F.array_sort(F.collect_list("item")).alias("sample"))
    return rows.agg(F.count("*").alias("items")).where("items > 0").crossJoin(first).select(  # one row each
        F.lit(check).alias("check_name"), F.lit(severity).alias("severity"), F.lit(None).cast("string").alias("path"),
        F.concat(F.col("items").cast("string"), F.lit(f" {text}")).alias("detail"), "items", "sample",
    )


def _by_path(rows: DataFrame, check: str, detail: Column) -> DataFrame:
    return rows.select(F.lit(check).alias("check_name"), F.lit("warning").alias("severity"), "path", detail.alias("detail"), F.lit(1).cast("long").alias("items"), F.array("path").alias("sample"))


def missing_functions(parsed: DataFrame, known: DataFrame) -> DataFrame:
    """A finding for each file with more functions in parsed(path) than in known(path)."""
    a, b = parsed.groupBy("path").agg(F.count("*").alias("a")), known.groupBy("path").agg(F.count("*").alias("b"))
    rows = a.join(b, "path", "left").withColumn("b", F.coalesce("b", F.lit(0))).where("b < a")
    return _by_path(rows, "missing_function_goids", F.concat(F.col("a").cast("string"), F.lit(" functions, "), F.col("b").cast("string"), F.lit(" GOIDs")))


def stray_calls(calls: DataFrame, spans: DataFrame) -> DataFrame:
    """A finding for each call of calls(caller_id, path, line) outside the lines of its caller in spans(function_id, first, last)."""
    met = calls.join(spans, F.col("caller_id") == F.col("function_id")).where((F.col("line") < F.col("first")) | (F.col("line") > F.col("last")))
    text = F.concat(F.lit("callsite "), F.col("line").cast("string"), F.lit(" outside span "), F.col("first").cast("string"), F.lit("-"), F.col("last").cast("string"))
    return _by_path(met, "callsite_span_mismatch", text)


def orphan_modules(modules: DataFrame, known: DataFrame) -> DataFrame:
    """A finding for each path of modules(path) that known(path) doesn't have."""
    return _by_path(modules.select("path").join(known.select("path"), "path", "left_anti"), "orphan_module", F.lit("no module GOID"))


def _degrees(edges: DataFrame) -> DataFrame:
    """node, degree: distinct edges in and out; a loop counts on both sides."""
    links = edges.select("src", "dst").distinct()
    return links.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))


def hubs(edges: DataFrame, check: str, severity: str) -> DataFrame:
    """Nodes of a degree above a tenth of the nodes' number, ten at least."""
    degree = settle(_degrees(edges))
    least = degree.agg(F.greatest(F.lit(HUB_FLOOR), F.floor(F.count("*") * HUB_SHARE)).alias("least"))
    return _summary(degree.crossJoin(F.broadcast(least)).where("degree > least"), F.col("node"), check, severity, "hubs")  # one row


def isolated(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes of nodes(node, kind) without an edge, but for modules and classes."""
    alone = nodes.where(~F.coalesce(F.col("kind"), F.lit("")).isin("module", "class")).join(graph.nodes_of(edges), "node", "left_anti")
    return _summary(alone, F.col("node"), "call_graph_isolated_nodes", "warning", "isolated nodes")


def large_cycles(parts: DataFrame, check: str, least: int) -> DataFrame:
    """Strong components of `least` nodes or more, of component metadata."""
    return _summary(parts.where(F.col("scc_size") >= least).select("scc_id").distinct(), F.col("scc_id"), check, "warning", "cycles")


def cross_package_cycles(parts: DataFrame, package: Column) -> DataFrame:
    """Strong components whose nodes lie in several packages."""
    mixed = parts.where("in_cycle").groupBy("scc_id").agg((F.min(package) != F.max(package)).alias("mixed")).where("mixed")
    return _summary(mixed, F.col("scc_id"), "import_graph_cross_package_cycles", "warning", "cycles cross package boundaries")


def upward_edges(edges: DataFrame, layers: DataFrame) -> DataFrame:
    """Edges from a deeper layer of layers(node, layer) to a shallower one."""
    a, b = (layers.where("layer is not null").select(F.col("node").alias(n), F.col("layer").alias(f"{n}_layer")) for n in ("src", "dst"))
    up = edges.select("src", "dst").distinct().join(a, "src").join(b, "dst").where("src_layer > dst_layer")
    return _summary(up, F.concat(F.col("src").cast("string"), F.lit("->"), F.col("dst").cast("string")), "import_graph_upward_edges", "info", "edges go from deeper to shallower layer")


def bridges(edges: DataFrame, sample: int = 200) -> DataFrame:
    """Nodes with a quarter of the greatest betweenness or more; sources are sampled beyond `sample` nodes."""
    scores = settle(structure.path_betweenness(edges, sample=sample))
    most = scores.agg(F.max("betweenness").alias("most"))
    high = scores.crossJoin(F.broadcast(most)).where((F.col("betweenness") > 0) & (F.col("betweenness") >= BRIDGE_SHARE * F.col("most")))  # one row
    return _summary(high, F.col("node"), "import_graph_bridges", "info", "modules with high betweenness")


def large_communities(labels: DataFrame) -> DataFrame:
    """Communities of labels(node, label) with more than two nodes."""
    big = labels.where("label is not null").groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > LARGE_COMMUNITY)
    return _summary(big, F.col("label"), "symbol_graph_large_community", "info", "communities exceed threshold")


def broad_keys(uses: DataFrame) -> DataFrame:
    """Keys of uses(key, module) that more modules use than a twentieth of the keys' number, two at least."""
    counts = settle(uses.groupBy("key").agg(F.countDistinct("module").alias("n")))
    least = counts.agg(F.greatest(F.lit(CONFIG_FLOOR), F.floor(F.count("*") * CONFIG_SHARE)).alias("least"))
    return _summary(counts.crossJoin(F.broadcast(least)).where("n > least"), F.col("key"), "config_keys_broad_usage", "info", "keys used widely")  # one row


def disagreements(members: DataFrame) -> DataFrame:
    """Modules of members(module, agrees) that don't agree with their subsystem."""
    return _summary(members.where("not agrees"), F.col("module"), "subsystem_community_disagreement", "warning", "modules disagree")


def call_graph_checks(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    parts = settle(component_metadata(edges))
    return reduce(DataFrame.unionByName, [isolated(nodes, edges), large_cycles(parts, "call_graph_large_scc", LARGE_CYCLE), hubs(edges, "call_graph_degree_hubs", "info")])


def import_graph_checks(edges: DataFrame, layers: DataFrame, package: Column) -> DataFrame:
    """package: of the column `node`."""
    parts = settle(component_metadata(edges))
    found = [
        large_cycles(parts, "import_graph_large_scc", HUB_FLOOR // 2 + 1), cross_package_cycles(parts, package), hubs(edges, "import_graph_degree_hubs", "info"),
        upward_edges(edges, layers), bridges(edges),
    ]
    return reduce(DataFrame.unionByName, found)
