"""Distances and reach on paths of more than 100 edges."""

from corvid.operators import graph as G


def test_path_of_105_edges(spark):
    n = 106
    edges = spark.createDataFrame([(i, i + 1, 1) for i in range(n - 1)], "src long, dst long, weight long")
    got = {r["node"]: (r["descendants"], r["ancestors"]) for r in G.reach_counts(edges).collect()}
    assert got == {i: (n - 1 - i, i) for i in range(n)}
    ego = G.ego(edges, 5, 3, 10).collect()
    assert [(r["node"], r["distance"]) for r in ego] == [(5, 0), (6, 1), (7, 2), (8, 3)], "a radius is still one"
