"""Sketched and global measures against plain Python."""

import random
from collections import defaultdict, deque

import pytest

from corvid.operators import measures as M
from corvid.operators import structure as T

SCHEMA = "src long, dst long, weight long"


def drawn(seed, n, m):
    rng = random.Random(seed)
    return [(a, b, 1) for a, b in sorted({(rng.randrange(n), rng.randrange(n)) for _ in range(m)})]


def distances(rows, undirected=False):
    near = defaultdict(set)
    nodes = {v for a, b, _ in rows for v in (a, b)}
    for a, b, _ in rows:
        near[a].add(b)
        if undirected:
            near[b].add(a)
    out = {}
    for v in nodes:
        seen, todo = {v: 0}, deque([v])
        while todo:
            x = todo.popleft()
            for y in near[x]:
                if y not in seen:
                    seen[y] = seen[x] + 1
                    todo.append(y)
        out[v] = seen
    return out


def test_small_sets_are_exact(spark):
    rows = drawn(1, 40, 60) + [(100 + i, 101 + i, 1) for i in range(9)] + [(7, 7, 1)]
    far = distances(rows)
    got = {r["node"]: r for r in M.sketched_reach(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == set(far)
    for v, r in got.items():
        into = [d[v] for u, d in far.items() if u != v and v in d]
        assert (r["descendants"], r["ancestors"]) == pytest.approx((len(far[v]) - 1, len(into)), abs=1e-3)
        near = len(into) / sum(into) * len(into) / (len(far) - 1) if into else 0
        assert (r["closeness"], r["harmonic"]) == pytest.approx((near, sum(1 / d for d in into)), rel=1e-3)


def test_error_of_large_sets(spark):
    """Sets beyond what a sketch of 2^8 registers holds exactly: within four standard errors of 6.5 % each, 4 % on average."""
    rows = drawn(2, 1500, 2600)
    far = distances(rows)
    got = {r["node"]: r for r in M.sketched_reach(spark.createDataFrame(rows, SCHEMA), lg=8).collect()}
    errors = [got[v]["descendants"] / (len(d) - 1) - 1 for v, d in far.items() if len(d) > 300]
    assert len(errors) > 100 and max(map(abs, errors)) < 0.26 and abs(sum(errors) / len(errors)) < 0.1


def test_path_stats(spark):
    rows = drawn(3, 60, 70) + [(500 + i, 501 + i, 1) for i in range(4)]
    far = distances(rows, True)
    best = max(far.values(), key=lambda d: (len(d), -min(d)))
    inside = {v: far[v] for v in best}
    diameter = max(max(d.values()) for d in inside.values())
    mean = sum(sum(d.values()) for d in inside.values()) / (len(inside) * (len(inside) - 1))
    r = M.path_stats(spark.createDataFrame(rows, SCHEMA)).first()
    assert r["nodes"] == len(inside) and r["diameter_low"] <= diameter <= r["diameter_high"] and r["mean_path"] == pytest.approx(mean, rel=1e-3)
    assert M.path_stats(spark.createDataFrame([], SCHEMA)).first()["nodes"] == 0


def test_directed_clustering(spark):
    rows = drawn(4, 14, 70)
    a = defaultdict(int) | {(x, y): 1 for x, y, _ in rows if x != y}
    nodes = sorted({v for x, y, _ in rows for v in (x, y)})
    want = {}
    for u in nodes:
        t = sum((a[u, v] + a[v, u]) * (a[u, w] + a[w, u]) * (a[v, w] + a[w, v]) for v in nodes for w in nodes if len({u, v, w}) == 3) / 2
        total, both = sum(a[u, v] + a[v, u] for v in nodes), sum(a[u, v] * a[v, u] for v in nodes)
        want[u] = t / (total * (total - 1) - 2 * both) if t else 0.0
    got = {r["node"]: r["clustering"] for r in M.directed_clustering(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == pytest.approx(want)


def test_global_stats_of_loops_and_nothing(spark):
    rows = [(1, 2, 1), (2, 1, 1), (2, 3, 1), (3, 4, 1), (9, 9, 1), (None, 5, 1)]
    assert M.global_stats("g", spark.createDataFrame(rows, SCHEMA)).first().asDict() == {
        "graph": "g", "nodes": 5, "edges": 5, "weak_components": 2, "strong_components": 4, "layers": 3, "mean_clustering": 0.0
    }
    assert M.global_stats("g", spark.createDataFrame([], SCHEMA)).first()["nodes"] == 0


def test_sampled_betweenness_takes_the_least_hashes_and_scales(spark):
    """The sources are those of the least seeded hash, and sums are scaled by nodes over sources: counted plainly."""
    rows = [(a, b, 1) for a, b, _ in drawn(6, 16, 45) if a != b]
    far = distances(rows)
    nodes = sorted(far)
    order = {r["node"]: r["h"] for r in spark.createDataFrame([(v,) for v in nodes], "node long").selectExpr("node", "xxhash64(7, node) AS h").collect()}
    chosen = sorted(nodes, key=lambda v: (order[v], v))[:5]

    def paths(s, t):
        """All shortest paths from s to t."""
        if s == t:
            return [[t]]
        return [p + [t] for v, w, _ in rows if w == t and v in far[s] and far[s][v] + 1 == far[s][t] for p in paths(s, v)]

    want = dict.fromkeys(nodes, 0.0)
    for s in chosen:
        for t in far[s]:
            if t != s:
                ways = paths(s, t)
                for p in ways:
                    for v in p[1:-1]:
                        want[v] += 1 / len(ways)
    n = len(nodes)
    want = {v: x * n / 5 / ((n - 1) * (n - 2)) for v, x in want.items()}
    edges = spark.createDataFrame(rows, SCHEMA)
    for block in (2, 256):
        got = {r["node"]: r["betweenness"] for r in T.path_betweenness(edges, sample=5, seed=7, block=block).collect()}
        assert got == pytest.approx(want)
