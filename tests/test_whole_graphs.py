"""Graph queries over all part keys, held against walks of the whole tree."""

import os
from collections import Counter

import pytest

from corvid.plans import graphs

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.fixture(scope="module")
def keys(spark):
    return sorted(r[0] for r in spark.read.parquet(f"{DATA}/part.parquet").select("p_partkey").collect())


def up(k):
    """The nodes above k, the nearest first."""
    while k > 0:
        k //= 2
        yield k


def test_reach_covers_every_part(spark, keys):
    assert len(keys) > 500
    below = Counter(a for k in keys for a in up(k))
    got = {r["node"]: (r["descendants"], r["ancestors"]) for r in graphs.reach_counts(spark, DATA).collect()}
    assert got == {k: (below[k], len(list(up(k)))) for k in [0, *keys]}


def test_levels_and_layers_cover_every_part(spark, keys):
    got = {(r["root"], r["node"]): r["distance"] for r in graphs.bfs_levels(spark, DATA).collect()}
    want = {(root, root): 0 for root in (1, 2, 3)} | {(a, k): d for k in keys for d, a in enumerate(up(k), 1) if a in (1, 2, 3)}
    assert got == want
    assert {r["node"]: r["layer"] for r in graphs.dag_layers(spark, DATA).collect()} == {k: len(list(up(k))) for k in [0, *keys]}


def test_pagerank_runs_20_rounds(spark):
    data = "/root/testdata/sf0.001"
    edges = [(r["src"], r["dst"], r["weight"]) for r in graphs.graph_edges(spark, data).collect()]
    nodes = sorted({x for s, t, _ in edges for x in (s, t)})
    total = Counter()
    for s, _, w in edges:
        total[s] += w
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(20):
        lost = sum(rank[v] for v in nodes if not total[v])
        got = Counter()
        for s, t, w in edges:
            got[t] += rank[s] * w / total[s]
        rank = {v: 0.15 / len(nodes) + 0.85 * (got[v] + lost / len(nodes)) for v in nodes}
    found = {r["node"]: r["rank"] for r in graphs.pagerank_fixed(spark, data).collect()}
    assert set(found) == set(nodes) and all(abs(found[v] - rank[v]) < 2e-8 for v in nodes)
