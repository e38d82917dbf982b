"""Graph operators on graphs drawn from the star schema: trade between nations, parts bought in a row, suppliers that share
parts, a key tree. All read their tables whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators import graph as G
from corvid.operators import kernels as K
from corvid.operators import structure as T
from corvid.operators.components import connected_components
from corvid.session import settle


def _t(spark: SparkSession, sf_dir: str, *names: str):
    found = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return found[0] if len(found) == 1 else found


def _trade(spark, d) -> DataFrame:
    """Customer nation to supplier nation by lines, summed before nations are looked up."""
    lines, orders, customer, supplier = _t(spark, d, "lineitem", "orders", "customer", "supplier")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return G.weighted_edges(joined.withColumns({"a": F.col("c_nationkey").cast("long"), "b": F.col("s_nationkey").cast("long")}), "a", "b")


def _tree(spark, d) -> DataFrame:
    """All part keys, each below its half; key 0 is the root, with no edge of its own."""
    part = _t(spark, d, "part")
    return part.where("p_partkey > 0").select(F.floor(F.col("p_partkey") / 2).alias("src"), F.col("p_partkey").alias("dst"), F.lit(1).cast("long").alias("weight"))


def _follow(spark, d) -> DataFrame:
    """Parts bought in a row: from each line's part to that of the next line number of its order."""
    lines = _t(spark, d, "lineitem")
    a = lines.select("l_orderkey", F.col("l_linenumber").alias("n"), F.col("l_partkey").cast("long").alias("src"))
    b = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("n"), F.col("l_partkey").cast("long").alias("dst"))
    return G.undirected_edges(G.weighted_edges(a.join(b, ["l_orderkey", "n"]), "src", "dst"))


def graph_edges(spark, d) -> DataFrame:
    return _trade(spark, d)


def neighbor_stats(spark, d) -> DataFrame:
    return G.neighbor_stats(_trade(spark, d))


def bipartite_degrees(spark, d) -> DataFrame:
    pairs = G.weighted_edges(_t(spark, d, "lineitem"), "l_suppkey", "l_partkey")
    return G.bipartite_degrees(pairs).withColumn("centrality", F.round("centrality", 6))


def projection_edges(spark, d) -> DataFrame:
    return G.projection(G.weighted_edges(_t(spark, d, "lineitem"), "l_suppkey", "l_partkey"))


def components(spark, d) -> DataFrame:
    """Of the suppliers that share parts, without a row for each pair of them."""
    return connected_components(G.projection_stars(G.weighted_edges(_t(spark, d, "lineitem"), "l_suppkey", "l_partkey")))


def bfs_levels(spark, d) -> DataFrame:
    roots = spark.range(1, 4).select(F.col("id").alias("node"))
    return G.bfs_levels(_tree(spark, d), roots)


def reach_counts(spark, d) -> DataFrame:
    return G.reach_counts(_tree(spark, d))


def ego_radius(spark, d) -> DataFrame:
    return G.ego(_tree(spark, d), 5, 3, 10).select("node", "distance")


def dag_layers(spark, d) -> DataFrame:
    return G.dag_layers(_tree(spark, d))


def triangles_clustering(spark, d) -> DataFrame:
    return G.triangles(_follow(spark, d)).withColumn("clustering", F.round("clustering", 6))


def closeness_harmonic(spark, d) -> DataFrame:
    out = G.closeness_harmonic(_trade(spark, d))
    return out.select("node", F.round("closeness", 6).alias("closeness"), F.round("harmonic", 6).alias("harmonic"))


def pagerank_fixed(spark, d) -> DataFrame:
    return G.pagerank(_trade(spark, d), rounds=20).select("node", F.round("rank", 8).alias("rank"))


def kcore(spark, d) -> DataFrame:
    return G.core_numbers(_follow(spark, d))


def rich_club(spark, d) -> DataFrame:
    return G.rich_club(_follow(spark, d))


def quotient_graph(spark, d) -> DataFrame:
    labels = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.col("n_regionkey").alias("label"))
    return G.quotient(_trade(spark, d), labels)


def edge_boundary(spark, d) -> DataFrame:
    labels = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.col("n_regionkey").alias("label"))
    return G.boundary(_trade(spark, d), labels)


def strong_components(spark, d) -> DataFrame:
    return G.strong_components(_trade(spark, d))


def condensation_layers(spark, d) -> DataFrame:
    return G.simple_layers(_trade(spark, d))


def hub_findings(spark, d) -> DataFrame:
    """Nodes of a degree of max(10, n/10) or more, and nodes without an edge, as findings."""
    edges, nation = _trade(spark, d), _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"))
    stats = G.neighbor_stats(edges)
    least = stats.agg(F.greatest(F.lit(10), F.floor(F.count("*") * 0.1)).alias("least"))
    hubs = stats.crossJoin(F.broadcast(least)).where("out_degree + in_degree >= least").select(F.lit("hub").alias("rule"), "node")
    return hubs.unionByName(nation.join(stats, "node", "left_anti").select(F.lit("isolated").alias("rule"), "node"))


def betweenness(spark, d) -> DataFrame:
    return K.betweenness(_trade(spark, d)).select("node", F.round("betweenness", 8).alias("betweenness"))


def _by_component(edges: DataFrame) -> DataFrame:
    """edges with the component that each lies in: no label and no path leaves it."""
    edges = settle(edges)
    parts = connected_components(edges).select(F.col("node").alias("src"), F.col("component").cast("string").alias("graph"))
    return edges.join(parts, "src")


def label_propagation(spark, d) -> DataFrame:
    return K.label_propagation(_by_component(_follow(spark, d)))


def articulation_bridges(spark, d) -> DataFrame:
    return T.cut_nodes(_follow(spark, d))


def structural_holes(spark, d) -> DataFrame:
    found = T.structural_holes(_follow(spark, d))
    return found.select("node", *(F.round(c, 6).alias(c) for c in ("hole_constraint", "effective_size")))


def betweenness_sampled(spark, d) -> DataFrame:
    """Ten nations as sources, by joins."""
    return T.path_betweenness(_trade(spark, d), sample=10, seed=7).select("node", F.round("betweenness", 8).alias("betweenness"))


def dominance(spark, d) -> DataFrame:
    """The control-flow shape of each customer's orders: an edge from each line number to the next ones of its order."""
    lines, orders = _t(spark, d, "lineitem", "orders")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    edges = rows.select(F.col("o_custkey").alias("graph"), F.lit(0).cast("long").alias("src"), F.col("l_linenumber").cast("long").alias("dst")).distinct()
    more = rows.select(F.col("o_custkey").alias("graph"), F.col("l_linenumber").cast("long").alias("src"), (F.col("l_linenumber") * 2).cast("long").alias("dst")).distinct()
    return K.dominance(edges.unionByName(more).distinct(), entry=0)


QUERIES = {
    f.__name__: f
    for f in (
        graph_edges, neighbor_stats, bipartite_degrees, projection_edges, components, bfs_levels, reach_counts, ego_radius, dag_layers, triangles_clustering,
        closeness_harmonic, pagerank_fixed, kcore, rich_club, quotient_graph, edge_boundary, strong_components, condensation_layers, hub_findings, betweenness,
        label_propagation, articulation_bridges, dominance, structural_holes, betweenness_sampled,
    )
}

_TRADE = """trade AS (SELECT CAST(c_nationkey AS BIGINT) AS src, CAST(s_nationkey AS BIGINT) AS dst, count(*) AS weight FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""
_BUSY = _TRADE + ", busy AS (SELECT * FROM trade)"
_PROJ = """pairs AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem),
    proj AS (SELECT a.s AS src, b.s AS dst, count(*) AS weight FROM pairs a JOIN pairs b ON a.p = b.p AND a.s < b.s GROUP BY 1, 2)"""
_SHARED = """follow AS (SELECT least(a.l_partkey, b.l_partkey) AS src, greatest(a.l_partkey, b.l_partkey) AS dst FROM lineitem a JOIN lineitem b
    ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber WHERE a.l_partkey <> b.l_partkey), shared AS (SELECT src, dst, count(*) AS weight FROM follow GROUP BY 1, 2)"""
_TREE = "tree AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part WHERE p_partkey > 0)"
_WAYS = "ways AS (SELECT src, dst FROM shared UNION ALL SELECT dst, src FROM shared)"
_RANK = "SELECT n.node, 0.15::DOUBLE / c + 0.85::DOUBLE * (coalesce(g, 0) + coalesce(lost, 0) / c) AS rank FROM n CROSS JOIN (SELECT count(*) AS c FROM n)"


def _rank_step(k: int) -> str:
    return f"""r{k} AS MATERIALIZED ({_RANK} LEFT JOIN (SELECT dst, sum(rank * share) AS g FROM r{k - 1} JOIN shares ON node = src GROUP BY 1) ON dst = n.node
        CROSS JOIN (SELECT sum(rank) FILTER (WHERE node NOT IN (SELECT src FROM trade)) AS lost FROM r{k - 1}))"""


ORACLES = {
    "graph_edges": f"WITH {_TRADE} SELECT * FROM trade",
    "neighbor_stats": f"""WITH {_BUSY}, o AS (SELECT src AS node, count(DISTINCT dst) AS d, sum(weight) AS w FROM busy GROUP BY 1),
        i AS (SELECT dst AS node, count(DISTINCT src) AS d, sum(weight) AS w FROM busy GROUP BY 1)
        SELECT coalesce(o.node, i.node) AS node, coalesce(o.d, 0) AS out_degree, coalesce(i.d, 0) AS in_degree,
            CAST(coalesce(o.w, 0) AS BIGINT) AS out_weight, CAST(coalesce(i.w, 0) AS BIGINT) AS in_weight FROM o FULL JOIN i ON o.node = i.node""",
    "bipartite_degrees": """WITH e AS (SELECT l_suppkey AS s, l_partkey AS p, count(*) AS w FROM lineitem GROUP BY 1, 2)
        SELECT 'left' AS side, s AS node, count(*) AS degree, CAST(sum(w) AS BIGINT) AS weighted_degree, round(count(*) / (SELECT count(DISTINCT p) FROM e)::DOUBLE, 6) AS centrality FROM e GROUP BY s
        UNION ALL SELECT 'right', p, count(*), CAST(sum(w) AS BIGINT), round(count(*) / (SELECT count(DISTINCT s) FROM e)::DOUBLE, 6) FROM e GROUP BY p""",
    "projection_edges": f"WITH {_PROJ} SELECT * FROM proj",
    "components": f"""WITH RECURSIVE {_PROJ}, ways AS (SELECT src, dst FROM proj UNION ALL SELECT dst, src FROM proj), r AS (SELECT src AS node, src AS root FROM ways UNION SELECT ways.dst, root FROM r JOIN ways ON ways.src = node)
        SELECT node, min(root) AS component FROM r GROUP BY 1""",
    "bfs_levels": f"""WITH RECURSIVE {_TREE}, r AS (SELECT range AS root, range AS node, 0 AS distance FROM range(1, 4)
        UNION SELECT root, dst, distance + 1 FROM r JOIN tree ON src = node) SELECT root, node, min(distance) AS distance FROM r GROUP BY 1, 2""",
    "reach_counts": f"""WITH RECURSIVE {_TREE}, n AS (SELECT src AS node FROM tree UNION SELECT dst FROM tree),
        r AS (SELECT node AS root, node FROM n UNION SELECT root, dst FROM r JOIN tree ON src = r.node)
        SELECT n.node, coalesce(d, 0) AS descendants, coalesce(a, 0) AS ancestors FROM n LEFT JOIN (SELECT root, count(*) AS d FROM r WHERE root <> node GROUP BY 1) x ON x.root = n.node
            LEFT JOIN (SELECT node, count(*) AS a FROM r WHERE root <> node GROUP BY 1) y ON y.node = n.node""",
    "ego_radius": f"""WITH RECURSIVE {_TREE}, r AS (SELECT 5::BIGINT AS node, 0 AS distance UNION SELECT dst, distance + 1 FROM r JOIN tree ON src = node WHERE distance < 3)
        SELECT node, min(distance) AS distance FROM r GROUP BY 1 ORDER BY 2, 1 LIMIT 10""",
    "dag_layers": f"""WITH RECURSIVE {_TREE}, r AS (SELECT src AS node, 0 AS layer FROM tree WHERE src NOT IN (SELECT dst FROM tree)
        UNION SELECT dst, layer + 1 FROM r JOIN tree ON src = node) SELECT node, max(layer) AS layer FROM r GROUP BY 1""",
    "triangles_clustering": f"""WITH {_SHARED}, {_WAYS}, deg AS (SELECT src AS node, count(*) AS degree FROM ways GROUP BY 1),
        tri AS (SELECT a.src AS node, count(*) // 2 AS t FROM ways a JOIN ways b ON a.dst = b.src JOIN ways c ON b.dst = c.src AND c.dst = a.src GROUP BY 1)
        SELECT node, degree, coalesce(t, 0) AS triangles, CASE WHEN degree > 1 THEN round(2.0::DOUBLE * coalesce(t, 0) / (degree * (degree - 1)), 6) ELSE 0 END AS clustering
        FROM deg LEFT JOIN tri USING (node)""",
    "closeness_harmonic": f"""WITH RECURSIVE {_BUSY}, n AS (SELECT src AS node FROM busy UNION SELECT dst FROM busy),
        r AS (SELECT node AS root, node, 0 AS d FROM n UNION SELECT root, dst, d + 1 FROM r JOIN busy ON src = r.node WHERE d < 25),
        s AS (SELECT root, node, min(d) AS d FROM r GROUP BY 1, 2), g AS (SELECT node, count(*) AS r, sum(d) AS d, sum(1.0::DOUBLE / d) AS h FROM s WHERE d > 0 GROUP BY 1)
        SELECT n.node, round(coalesce(r / d::DOUBLE * (r / ((SELECT count(*) FROM n) - 1)::DOUBLE), 0), 6) AS closeness, round(coalesce(h, 0), 6) AS harmonic FROM n LEFT JOIN g USING (node)""",
    "pagerank_fixed": f"""WITH {_TRADE}, n AS (SELECT src AS node FROM trade UNION SELECT dst FROM trade),
        shares AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src)::DOUBLE AS share FROM trade),
        r0 AS (SELECT node, 1 / (SELECT count(*) FROM n)::DOUBLE AS rank FROM n), {", ".join(map(_rank_step, range(1, 21)))}
        SELECT node, round(rank, 8) AS rank FROM r20""",
    "rich_club": f"""WITH {_SHARED}, {_WAYS}, deg AS (SELECT src AS node, count(*) AS degree FROM ways GROUP BY 1)
        SELECT node, degree, degree >= (SELECT degree FROM deg ORDER BY degree DESC LIMIT 1
            OFFSET (SELECT greatest(0, CAST(floor(count(*) * 0.1::DOUBLE) AS BIGINT) - 1) FROM deg)) AS rich FROM deg""",
    "structural_holes": f"""WITH {_SHARED}, ways AS (SELECT src, dst, weight FROM shared UNION ALL SELECT dst, src, weight FROM shared),
        s AS (SELECT src AS node, sum(weight)::DOUBLE AS total, max(weight)::DOUBLE AS most, count(*) AS degree FROM ways GROUP BY 1),
        g AS (SELECT x.src AS v, z.dst AS n, sum(x.weight / a.total * z.weight / b.total) AS indirect, sum(x.weight / a.total * z.weight / c.most) AS spare
            FROM ways x JOIN ways z ON x.dst = z.src JOIN ways y ON y.src = x.src AND y.dst = z.dst JOIN s a ON a.node = x.src JOIN s b ON b.node = x.dst JOIN s c ON c.node = z.dst GROUP BY 1, 2)
        SELECT e.src AS node, round(sum(power(e.weight / s.total + coalesce(indirect, 0), 2)), 6) AS hole_constraint, round(max(degree) - sum(coalesce(spare, 0)), 6) AS effective_size
        FROM ways e JOIN s ON s.node = e.src LEFT JOIN g ON v = e.src AND n = e.dst GROUP BY 1""",
    "quotient_graph": f"""WITH {_TRADE} SELECT a.n_regionkey AS src, b.n_regionkey AS dst, CAST(sum(weight) AS BIGINT) AS weight
        FROM trade JOIN nation a ON a.n_nationkey = src JOIN nation b ON b.n_nationkey = dst WHERE a.n_regionkey <> b.n_regionkey GROUP BY 1, 2""",
    "edge_boundary": f"""WITH {_BUSY}, j AS (SELECT a.n_regionkey AS a, b.n_regionkey AS b, weight FROM busy JOIN nation a ON a.n_nationkey = src JOIN nation b ON b.n_nationkey = dst),
        e AS (SELECT a AS label, b AS other, weight, true AS o FROM j UNION ALL SELECT b, a, weight, false FROM j WHERE a <> b)
        SELECT label, CAST(coalesce(sum(weight) FILTER (WHERE label = other), 0) AS BIGINT) AS internal, CAST(coalesce(sum(weight) FILTER (WHERE label <> other), 0) AS BIGINT) AS external,
            count(DISTINCT other) FILTER (WHERE o AND label <> other) AS fan_out, count(DISTINCT other) FILTER (WHERE NOT o AND label <> other) AS fan_in FROM e GROUP BY 1""",
    "strong_components": f"""WITH RECURSIVE {_BUSY}, n AS (SELECT src AS node FROM busy UNION SELECT dst FROM busy),
        r AS (SELECT node AS root, node FROM n UNION SELECT root, dst FROM r JOIN busy ON src = r.node)
        SELECT a.root AS node, min(a.node) AS component FROM r a JOIN r b ON a.root = b.node AND a.node = b.root GROUP BY 1""",
    "hub_findings": f"""WITH {_BUSY}, deg AS (SELECT node, count(*) AS d FROM (SELECT src AS node FROM busy UNION ALL SELECT dst FROM busy) GROUP BY 1)
        SELECT 'hub' AS rule, node FROM deg WHERE d >= greatest(10, floor((SELECT count(*) FROM deg) * 0.1::DOUBLE))
        UNION ALL SELECT 'isolated', CAST(n_nationkey AS BIGINT) FROM nation WHERE n_nationkey NOT IN (SELECT node FROM deg)""",
}
