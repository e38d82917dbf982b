"""Metric tables against plain Python."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.operators import metric_tables as T

SCHEMA = "src long, dst long, weight long"


def test_two_nodes_that_call_each_other(spark):
    """A cycle of two with one call doubled, and a function that nothing calls."""
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (None, 1)], "src long, dst long")
    got = {r["node"]: r for r in T.directed_metrics(edges, spark.createDataFrame([(9,)], "node long")).collect()}
    assert {v: (r["fan_in"], r["fan_out"], r["calls_out"], r["calls_in"], r["in_cycle"]) for v, r in got.items()} == {1: (1, 1, 2, 1, True), 2: (1, 1, 1, 2, True), 9: (0, 0, 0, 0, False)}
    assert got[1]["pagerank"] == pytest.approx(0.5) and got[1]["closeness"] == 1 and got[9]["component_size"] == 1 and got[9]["layer"] == 0 and got[1]["scc_size"] == 2
    near = T.directed_metrics(edges, sketched=True).where("node = 2").first()
    assert (near["closeness"], near["harmonic"], near["betweenness"]) == (pytest.approx(1), pytest.approx(1), 0)


def _reach(rows, v):
    seen, todo = {v}, [v]
    while todo:
        x = todo.pop()
        for a, b in rows:
            if a == x and b not in seen:
                seen.add(b)
                todo.append(b)
    return seen


def test_component_metadata(spark):
    rng = random.Random(1)
    rows = sorted({(rng.randrange(30), rng.randrange(30)) for _ in range(34)}) + [(70, 70)]
    nodes = {v for e in rows for v in e}
    down = {v: _reach(rows, v) for v in nodes}
    wide = {v: _reach(rows + [(b, a) for a, b in rows], v) for v in nodes}
    strong = {v: {u for u in down[v] if v in down[u]} for v in nodes}
    head = {v: min(strong[v]) for v in nodes}
    steps = {(head[a], head[b]) for a, b in rows if head[a] != head[b]}

    def layer(c):
        return max((1 + layer(a) for a, b in steps if b == c), default=0)

    got = {r["node"]: tuple(r)[1:] for r in T.component_metadata(spark.createDataFrame(rows, "src long, dst long")).collect()}
    assert got == {v: (min(wide[v]), len(wide[v]), head[v], len(strong[v]), len(strong[v]) > 1, layer(head[v])) for v in nodes}


def test_eigenvector_and_undirected_metrics(spark):
    rng = random.Random(2)
    rows = [(a, b, rng.randint(1, 3)) for a, b in {(rng.randrange(12), rng.randrange(12)) for _ in range(40)}]
    nodes = sorted({v for a, b, _ in rows for v in (a, b)})
    m = np.eye(len(nodes))
    for a, b, w in rows:
        i, j = nodes.index(a), nodes.index(b)
        m[i, j] += w
        m[j, i] += w * (i != j)
    value, vector = np.linalg.eigh(m)
    want = np.abs(vector[:, np.argmax(value)])
    edges = spark.createDataFrame(rows, SCHEMA)
    got = {r["node"]: r["eigenvector"] for r in T.eigenvector(edges, 500, 1e-9).collect()}
    assert [got[v] for v in nodes] == pytest.approx(want, abs=1e-5)
    with pytest.raises(RuntimeError):
        T.eigenvector(edges, 1, 1e-12)
    near = defaultdict(dict)
    for a, b, w in rows:
        if a != b:
            near[a][b] = near[a].get(b, 0) + w
            near[b][a] = near[b].get(a, 0) + w
    table = {r["node"]: r for r in T.undirected_metrics(edges, spark.createDataFrame([(99,)], "node long")).collect()}
    assert set(table) == {*nodes, 99} and table[99]["degree"] == 0 and table[99]["community"] == 99 and not table[99]["is_articulation"]
    for v in nodes:
        r = table[v]
        assert (r["degree"], r["weighted_degree"]) == (len(near[v]), sum(near[v].values()))
        assert r["triangles"] == sum(u < w and w in near[u] for u in near[v] for w in near[v]) and r["community"] in nodes


def test_bipartite_metrics(spark):
    rows = [("t1", "f", 2), ("t1", "g", 1), ("t2", "f", 1), ("t3", "h", 4)]
    got = {(r["side"], r["node"]): (r["degree"], r["weighted_degree"], r["projected_degree"], r["projected_weight"]) for r in T.bipartite_metrics(spark.createDataFrame(rows, "src string, dst string, weight long")).collect()}
    assert got == {
        ("left", "t1"): (2, 3, 1, 1), ("left", "t2"): (1, 1, 1, 1), ("left", "t3"): (1, 4, 0, 0), ("right", "f"): (2, 3, 1, 1), ("right", "g"): (1, 1, 1, 1), ("right", "h"): (1, 4, 0, 0)
    }


@pytest.mark.parametrize("kind", ["hub", "sparse", "copies"])
def test_projected_degrees_are_those_of_the_projection(spark, kind):
    rng = random.Random(5)
    rows = {(a, 100 + rng.randrange(12 if kind == "sparse" else 6)) for a in range(40) for _ in range(rng.choice((1, 2, 3)))}
    if kind == "hub":
        rows |= {(a, 200) for a in range(40) if a % 4} | {(90, 300), (91, 300), (92, 301)}
    if kind == "copies":
        rows = {(a % 3 + 10 * c, b) for a, b in rows for c in range(20)}
    edges = spark.createDataFrame([(a, b, 1) for a, b in sorted(rows)] + [(None, 100, 1), (1, None, 1)], SCHEMA)
    near, weight = defaultdict(set), defaultdict(int)
    for a, b in rows:
        for c, d in rows:
            if b == d and a != c:
                near[a].add(c)
                weight[a] += 1
    assert {r["node"]: (r["projected_degree"], r["projected_weight"]) for r in T.projected_degrees(edges).collect()} == {v: (len(near[v]), weight[v]) for v in near}


def test_projected_degrees_make_no_row_for_each_pair(spark):
    """300,000 nodes at one right node have 45 billion pairs."""
    edges = spark.range(300000).select(F.col("id").alias("src"), F.lit(1).cast("long").alias("dst"))
    got = T.projected_degrees(edges).agg(F.count("*"), F.min("projected_degree"), F.max("projected_weight")).first()
    assert tuple(got) == (300000, 299999, 299999)


def test_components_without_layers_build_no_condensation(spark, monkeypatch):
    """A cycle of two that leads to a third node, and a loop."""
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (8, 8)], "src long, dst long")
    want = {tuple(r)[:-1] for r in T.component_metadata(edges).collect()}
    for name in ("quotient", "dag_layers"):
        monkeypatch.setattr(T.graph, name, None)
    got = T.component_metadata(edges, layers=False)
    assert "layer" not in got.columns and {tuple(r) for r in got.collect()} == want
