"""Graph queries without SQL against plain Python on the smallest tables, and graphs that are deep, cyclic or skewed."""

import os
import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from corvid.operators import graph as G
from corvid.operators import relational as R
from corvid.operators.components import connected_components
from corvid.plans import catalog, graphs

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def near_of(pairs):
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    return near


def parts_of(near, without=None, cut=None):
    """Number of connected parts, leaving out a node or an edge."""
    seen, n = {without}, 0
    for v in near:
        if v not in seen:
            n += 1
            seen.add(v)
            queue = deque([v])
            while queue:
                x = queue.popleft()
                for y in near[x]:
                    if y not in seen and {x, y} != cut:
                        seen.add(y)
                        queue.append(y)
    return n


def plain_cores(near):
    near, core, k = {v: set(n) for v, n in near.items()}, {}, 0
    while near:
        v = min(near, key=lambda x: len(near[x]))
        k = max(k, len(near[v]))
        core[v] = k
        for y in near.pop(v):
            near[y].discard(v)
    return core


def reach(out, v):
    seen, queue = {v}, deque([v])
    while queue:
        for y in out[queue.popleft()]:
            if y not in seen:
                seen.add(y)
                queue.append(y)
    return seen


@needs_data
def test_cores_labels_and_cuts(spark):
    edges = [(r["src"], r["dst"], r["weight"]) for r in graphs._follow(spark, DATA).collect()]
    near = near_of((a, b) for a, b, _ in edges)
    assert {r["node"]: r["core"] for r in graphs.kcore(spark, DATA).collect()} == plain_cores(near)
    whole = parts_of(near)
    got = {r["node"]: (r["is_articulation"], r["is_bridge_end"]) for r in graphs.articulation_bridges(spark, DATA).collect()}
    bridges = {v for a, b in {(a, b) for a, b, _ in edges if min(len(near[a]), len(near[b])) <= 2} if parts_of(near, cut={a, b}) > whole for v in (a, b)}
    assert got.keys() == near.keys() and {v for v, g in got.items() if g[1]} == bridges
    for v in list(near)[:40]:
        assert got[v][0] == (parts_of(near, without=v) > whole - (not near[v]))
    weights = defaultdict(dict)
    for a, b, w in edges:
        weights[a][b] = weights[b][a] = float(w)
    label = {v: str(v) for v in near}
    for _ in range(20):
        before = dict(label)
        for v in sorted(near):
            votes = defaultdict(float)
            for u, w in weights[v].items():
                votes[label[u]] += w
            label[v] = max((w, name) for name, w in votes.items())[1]
        if label == before:
            break
    assert {r["node"]: r["label"] for r in graphs.label_propagation(spark, DATA).collect()} == label


@needs_data
def test_layers_betweenness_and_dominance(spark):
    edges = [(r["src"], r["dst"]) for r in graphs.graph_edges(spark, DATA).collect()]
    out = defaultdict(set)
    for a, b in edges:
        out[a].add(b)
    nodes = {v for e in edges for v in e}
    far = {v: reach(out, v) for v in nodes}
    component = {v: min(w for w in far[v] if v in far[w]) for v in nodes}
    got = {r["node"]: (r["component"], r["layer"]) for r in graphs.condensation_layers(spark, DATA).collect()}
    layer = {v: 0 for v in set(component.values())}
    for _ in layer:
        for a, b in edges:
            if component[a] != component[b]:
                layer[component[b]] = max(layer[component[b]], layer[component[a]] + 1)
    assert got == {v: (component[v], layer[component[v]]) for v in nodes}
    total = defaultdict(float)
    for s in nodes:
        dist, paths, order = {s: 0}, defaultdict(int, {s: 1}), [s]
        for v in order:
            for w in out[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    order.append(w)
                if dist[w] == dist[v] + 1 and w != v:
                    paths[w] += paths[v]
        need = defaultdict(float)
        for w in reversed(order):
            for v in nodes:
                if w in out[v] and v in dist and dist[v] + 1 == dist[w]:
                    need[v] += paths[v] / paths[w] * (1 + need[w])
            if w != s:
                total[w] += need[w]
    n = len(nodes)
    found = {r["node"]: r["betweenness"] for r in graphs.betweenness(spark, DATA).collect()}
    assert found.keys() == nodes and all(abs(found[v] - total[v] / ((n - 1) * (n - 2))) < 1e-7 for v in nodes)
    rows = graphs.dominance(spark, DATA).collect()
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").join(spark.read.parquet(f"{DATA}/orders.parquet"), F.col("l_orderkey") == F.col("o_orderkey"))
    flow = defaultdict(set)
    for r in lines.select("o_custkey", "l_linenumber").distinct().collect():
        flow[r[0]] |= {(0, r[1]), (r[1], 2 * r[1])}
    assert len({r["graph"] for r in rows}) == len(flow)
    for g in sorted(flow)[:25]:
        ways = defaultdict(set)
        for a, b in flow[g]:
            ways[a].add(b)
        all_ = reach(ways, 0)
        # a node's dominators are those without which it can't be reached
        doms = {v: {d for d in all_ if d == 0 or d == v or v not in reach({x: set() if x == d else ways[x] for x in [*all_, d]}, 0)} for v in all_ - {0}}
        for r in rows:
            if r["graph"] == g and r["node"] in doms:
                strict = doms[r["node"]] - {r["node"]}
                assert r["idom"] in strict and r["depth"] == len(strict) and all(d == r["idom"] or d == 0 or d in doms[r["idom"]] for d in strict)


def edges_of(spark, pairs):
    return spark.createDataFrame([(a, b, 1) for a, b in pairs], "src long, dst long, weight long")


def test_deep_and_cyclic_graphs(spark):
    chain = [(i, i + 1) for i in range(30)]
    rings = [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(30, 100), (103, 200), (200, 201), (201, 200), (300, 300)]
    got = {r["node"]: r["component"] for r in G.strong_components(edges_of(spark, chain + rings)).collect()}
    assert got == {**{i: i for i in range(31)}, **{100 + i: 100 for i in range(7)}, 200: 200, 201: 200, 300: 300}
    with pytest.raises(ValueError):
        G.dag_layers(edges_of(spark, [(1, 2), (2, 3), (3, 1)]))
    assert G.strong_components(edges_of(spark, [(1, 2)]).where("false")).count() == 0


def test_random_cores_and_heaviest(spark):
    rnd = random.Random(3)
    pairs = {(a, b) for a, b in ((rnd.randrange(40), rnd.randrange(40)) for _ in range(160)) if a < b} | {(99, i) for i in range(30)}
    assert {r["node"]: r["core"] for r in G.core_numbers(edges_of(spark, sorted(pairs))).collect()} == plain_cores(near_of(pairs))
    rows = [(a, b, rnd.randrange(6)) for a, b in sorted(pairs)]
    df = spark.createDataFrame(rows, "src long, dst long, weight long")
    for share in (0.01, 0.3, 0.77, 1.0):
        want = sorted(rows, key=lambda r: (-r[2], r[0], r[1]))[: max(1, int(len(rows) * share))]
        assert sorted(tuple(r) for r in G.edge_ranks(df, share).collect()) == sorted(want)


def test_ranks_to_a_tolerance(spark):
    df = edges_of(spark, [(1, 2), (2, 3), (3, 1), (3, 4)])
    a = {r["node"]: r["rank"] for r in G.pagerank(df, rounds=200, tolerance=1e-9).collect()}
    b = {r["node"]: r["rank"] for r in G.pagerank(df, rounds=60).collect()}
    assert all(abs(a[v] - b[v]) < 1e-7 for v in b)
    with pytest.raises(RuntimeError):
        G.pagerank(df, rounds=2, tolerance=1e-12)


def test_bands_give_what_plain_joins_give(spark):
    rnd = random.Random(9)
    spans = [(rnd.randrange(3), a, None if rnd.random() < 0.1 else a + rnd.randrange(-3, 60), i) for i in range(60) for a in [rnd.randrange(200)]]
    points = [(rnd.randrange(3), rnd.randrange(220)) for _ in range(150)] + [(None, 5), (1, None)]
    left = spark.createDataFrame(spans, "f long, a long, b long, id long")
    right = spark.createDataFrame(points, "f long, p long")
    take = lambda df: sorted((r[0], -1 if r[1] is None else r[1]) for r in df.select("l.id", "r.p").collect())
    assert take(R.band_join(left, right, ["f"], "a", "b", "p", width=7)) == take(R.band_join(left, right, ["f"], "a", "b", "p"))
    x = left.where("b is not null").select("id", "a", "b")
    y = x.select(F.col("id").alias("id2"), (F.col("a") + 5).alias("c"), (F.col("b") + 9).alias("d"))
    got = sorted(map(tuple, R.interval_join(x, y, ("a", "b"), ("c", "d"), 11).select("id", "id2").collect()))
    want = sorted((i, j) for _, a, b, i in spans for _, c, d, j in spans if b is not None and d is not None and a <= b and c + 5 <= d + 9 and a <= d + 9 and b >= c + 5)
    assert got == want


def test_every_query_is_held_against_something():
    brute = {"kcore", "condensation_layers", "betweenness", "label_propagation", "articulation_bridges", "dominance",
             "betweenness_sampled", "path_stats", "sketched_reach", "communities_by_mergers", "communities_by_graph", "small_clusters", "limited_clusters", "supplier_metrics"}
    assert set(catalog.queries()) == set(catalog.oracles()) | brute


def test_projection_in_blocks_and_its_stars(spark, monkeypatch):
    """Right nodes with more left nodes than a block has, tasks by pairs, nulls; the stars have the components of all pairs."""
    rng = random.Random(3)
    links = {(rng.randrange(40), rng.randrange(12)) for _ in range(90)} | {(100 + k, 50) for k in range(30)} | {(200, 60), (None, 50), (3, None)}
    edges = spark.createDataFrame([(*p, 1) for p in links for _ in range(2)], "src long, dst long, weight long")
    at = defaultdict(set)
    for a, b in links:
        if a is not None and b is not None:
            at[b].add(a)
    want = defaultdict(int)
    for held in at.values():
        for a in held:
            for b in held:
                if a < b:
                    want[a, b] += 1
    monkeypatch.setattr(G, "BLOCK_NODES", 7)
    monkeypatch.setattr(G, "TASK_PAIRS", 50)
    assert {(r["src"], r["dst"]): r["weight"] for r in G.projection(edges).collect()} == want
    stars = [(r["src"], r["dst"]) for r in G.projection_stars(edges).collect()]
    assert set(stars) <= set(want) and len(stars) == len(set(stars)) <= len(links)
    parts = [{(r["node"], r["component"]) for r in connected_components(e).collect()} for e in (G.projection(edges), G.projection_stars(edges))]
    assert parts[0] == parts[1]


def test_tasks_of_the_projection_follow_its_pairs(spark, monkeypatch):
    """One right node with 400 left ones: 79800 pairs, of which no task makes more than a block's share."""
    monkeypatch.setattr(G, "BLOCK_NODES", 40)
    monkeypatch.setattr(G, "TASK_PAIRS", 2_000)
    edges = spark.range(400).select(F.col("id").alias("src"), F.lit(1).alias("dst"), F.lit(1).alias("weight"))
    plan = G.projection(edges)._jdf.queryExecution().toString()
    assert "RepartitionByExpression" in plan and ", 40" in plan


def test_components_of_suppliers_make_no_pairs(spark, monkeypatch):
    if not os.path.isdir(DATA):
        pytest.skip("needs the test tables")
    monkeypatch.setattr(G, "projection", None)
    assert graphs.components(spark, DATA).count() > 0
