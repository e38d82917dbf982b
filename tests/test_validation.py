"""Checks of snapshots on tables made to be found fault with."""

from pyspark.sql import functions as F

from corvid.operators import validation as V


def _read(df):
    return {r["check_name"]: (r["severity"], r["items"], list(r["sample"])) for r in df.collect()}


def test_graph_checks(spark):
    edge = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    ring = [(f"a.m{k}", f"a.m{(k + 1) % 6}") for k in range(6)]
    star = [("hub", f"x{k:02}") for k in range(11)]
    pair = [("a.p", "b.q"), ("b.q", "a.p")]
    nodes = spark.createDataFrame([("lone", "function"), ("file", "module"), ("hub", "function"), ("odd", None)], "node string, kind string")
    layers = spark.createDataFrame([("a.m0", 0), ("a.m1", 1), ("a.m2", 0), ("hub", None)], "node string, layer int")
    assert _read(V.call_graph_checks(nodes, edge(ring + star))) == {
        "call_graph_isolated_nodes": ("warning", 2, ["lone", "odd"]), "call_graph_large_scc": ("warning", 1, ["a.m0"]), "call_graph_degree_hubs": ("info", 1, ["hub"])
    }
    found = _read(V.import_graph_checks(edge(ring + star + pair + star), layers, F.substring_index("node", ".", 1)))
    assert found.pop("import_graph_bridges")[2] == [f"a.m{k}" for k in range(5)]
    assert found == {
        "import_graph_large_scc": ("warning", 1, ["a.m0"]), "import_graph_cross_package_cycles": ("warning", 1, ["a.p"]), "import_graph_degree_hubs": ("info", 1, ["hub"]),
        "import_graph_upward_edges": ("info", 1, ["a.m1->a.m2"]),
    }
    quiet = edge(star[:3])
    assert _read(V.call_graph_checks(nodes.limit(0), quiet)) == {} and _read(V.import_graph_checks(quiet, layers.limit(0), F.lit("p"))) == {}


def test_table_checks(spark):
    uses = spark.createDataFrame([("k", m) for m in "abc"] + [("k", "a"), ("j", "a"), ("j", "b")], "key string, module string")
    assert _read(V.broad_keys(uses)) == {"config_keys_broad_usage": ("info", 1, ["k"])}
    labels = spark.createDataFrame([(k, "big" if k < 3 else "small" if k < 5 else None) for k in range(9)], "node long, label string")
    assert _read(V.large_communities(labels)) == {"symbol_graph_large_community": ("info", 1, ["big"])}
    members = spark.createDataFrame([("m", False), ("n", True), ("o", None)], "module string, agrees boolean")
    assert _read(V.disagreements(members)) == {"subsystem_community_disagreement": ("warning", 1, ["m"])}
    paths = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    assert [(r["path"], r["detail"]) for r in V.missing_functions(paths("a", "a", "b"), paths("a", "b", "b")).collect()] == [("a", "2 functions, 1 GOIDs")]
    assert [r["path"] for r in V.orphan_modules(paths("a", "c"), paths("a")).collect()] == ["c"]
    calls = spark.createDataFrame([(1, "f", 5), (1, "f", 9), (None, "f", 1), (7, "f", 1), (1, "f", None)], "caller_id long, path string, line int")
    spans = spark.createDataFrame([(1, 2, 6)], "function_id long, first int, last int")
    assert [r["detail"] for r in V.stray_calls(calls, spans).collect()] == ["callsite 9 outside span 2-6"]
