"""Queries of whole-graph measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import measures as M
from corvid.plans import graphs


def global_stats(spark, d) -> DataFrame:
    out = M.global_stats("trade", graphs._trade(spark, d)).unionByName(M.global_stats("tree", graphs._tree(spark, d)))
    return out.withColumn("mean_clustering", F.round("mean_clustering", 8))


def path_stats(spark, d) -> DataFrame:
    """Diameter bounds and mean path of the parts bought in a row."""
    return M.path_stats(graphs._follow(spark, d))


def sketched_reach(spark, d) -> DataFrame:
    """Reach, closeness and harmonic centrality of all parts in the key tree and of those bought in a row."""
    tree, follow = graphs._tree(spark, d).select("src", "dst"), graphs._follow(spark, d).select((-F.col("src")).alias("src"), (-F.col("dst")).alias("dst"))
    return M.sketched_reach(tree.unionByName(follow))


QUERIES = {f.__name__: f for f in (global_stats, path_stats, sketched_reach)}

ORACLES = {
    "global_stats": f"""WITH RECURSIVE {graphs._TRADE}, {graphs._TREE}, e AS (SELECT 'trade' AS graph, src, dst FROM trade UNION SELECT 'tree', src, dst FROM tree),
        n AS (SELECT graph, src AS node FROM e UNION SELECT graph, dst FROM e),
        w AS (SELECT graph, src, dst FROM e WHERE src <> dst UNION SELECT graph, dst, src FROM e WHERE src <> dst),
        low AS (SELECT graph, node, node AS low FROM n UNION SELECT w.graph, w.dst, low.low FROM low JOIN w ON w.graph = low.graph AND w.src = low.node WHERE low.low < w.dst),
        weak AS (SELECT graph, count(DISTINCT low) AS weak_components FROM (SELECT graph, node, min(low) AS low FROM low GROUP BY 1, 2) GROUP BY 1),
        reach AS (SELECT graph, node AS a, node AS b FROM n UNION SELECT r.graph, r.a, e.dst FROM reach r JOIN e ON e.graph = r.graph AND e.src = r.b),
        scc AS (SELECT r.graph, r.a AS node, min(r.b) AS c FROM reach r JOIN reach s ON s.graph = r.graph AND s.a = r.b AND s.b = r.a GROUP BY 1, 2),
        ce AS (SELECT DISTINCT e.graph, x.c AS src, y.c AS dst FROM e JOIN scc x ON x.graph = e.graph AND x.node = e.src JOIN scc y ON y.graph = e.graph AND y.node = e.dst WHERE x.c <> y.c),
        lay AS (SELECT DISTINCT graph, c, 0 AS l FROM scc UNION SELECT ce.graph, ce.dst, lay.l + 1 FROM lay JOIN ce ON ce.graph = lay.graph AND ce.src = lay.c),
        strong AS (SELECT graph, count(DISTINCT c) AS strong_components, max(l) + 1 AS layers FROM lay GROUP BY 1),
        m AS (SELECT graph, least(src, dst) AS a, greatest(src, dst) AS b, count(*) AS m FROM e WHERE src <> dst GROUP BY 1, 2, 3),
        mw AS (SELECT graph, a, b, m FROM m UNION ALL SELECT graph, b, a, m FROM m),
        deg AS (SELECT graph, a AS node, sum(m) AS t, count(*) FILTER (WHERE m = 2) AS r FROM mw GROUP BY 1, 2),
        tri AS (SELECT x.graph, x.a AS node, sum(x.m * y.m * z.m) / 2 AS p FROM mw x JOIN mw y ON x.graph = y.graph AND x.a = y.a AND x.b <> y.b
            JOIN mw z ON z.graph = x.graph AND z.a = x.b AND z.b = y.b GROUP BY 1, 2),
        cl AS (SELECT n.graph, avg(CASE WHEN p > 0 THEN p / (t * (t - 1) - 2 * r) ELSE 0.0 END) AS c FROM n LEFT JOIN deg USING (graph, node) LEFT JOIN tri USING (graph, node) GROUP BY 1)
        SELECT graph, (SELECT count(*) FROM n WHERE n.graph = weak.graph) AS nodes, (SELECT count(*) FROM e WHERE e.graph = weak.graph) AS edges, weak_components,
            strong_components, layers, round(c, 8) AS mean_clustering FROM weak JOIN strong USING (graph) JOIN cl USING (graph)""",
}
