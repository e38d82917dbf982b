"""New links join the components that they touch, and nodes that had none."""

from corvid.llm import ngram_join


def test_links_join_components_and_lone_nodes(spark):
    component = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)], "node long, component long")
    links = spark.createDataFrame([(3, 6), (9, 10), (2, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in ngram_join._merged(component, links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 1, 6: 1, 9: 9, 10: 9}
