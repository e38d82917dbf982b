"""Queries of the operators that pick rows, over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import selection as S
from corvid.plans import graphs


def _t(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def induced_edges(spark, d) -> DataFrame:
    known = _t(spark, d, "nation").where("n_regionkey in (1, 2)").select(F.col("n_nationkey").cast("long").alias("node"))
    return S.induced(graphs.graph_edges(spark, d), known)


def ranked_span_lookup(spark, d) -> DataFrame:
    """Each event looked up among its user's spans of events by type. Names are dotted and asked for by their last part, lookups run
    past their span, and some have no end or no name."""
    events = _t(spark, d, "events")
    spans = events.groupBy("user_id", F.concat(F.lit("m."), "event_type").alias("span_name")).agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    spans = spans.withColumn("span_id", F.concat_ws(":", F.col("user_id").cast("string"), "span_name"))
    e = F.col("event_id")
    wanted = events.select(
        "user_id", e.alias("lookup_id"), e.alias("start"), F.when(e % 5 != 0, e + (e % 3) * 100_000).alias("end"),
        F.when(e % 7 == 0, F.lit(None)).when(e % 2 == 0, F.concat(F.lit("other."), "event_type")).otherwise(F.col("event_type")).alias("name"),
    )
    found = S.best_span(wanted, spans, ["user_id"])
    return found.select("lookup_id", F.coalesce("span_id", F.lit("")).alias("span_id"), F.coalesce("step", F.lit(0)).alias("step"))


def first_seen_definition(spark, d) -> DataFrame:
    orders = _t(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return S.first_seen(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


def capped_findings(spark, d) -> DataFrame:
    """The first findings of each rule, severities overridden."""
    rows = _t(spark, d, "events").select(F.col("event_type").alias("rule"), "event_id", F.when(F.col("value") > 50, "warning").otherwise("info").alias("given"))
    rows = S.capped(rows, "rule", ["event_id"], 5)
    return rows.select("rule", "event_id", S.severity(F.col("rule"), F.col("given"), {"error": "error", "click": "ignored"}).alias("severity"))


def symbol_roles(spark, d) -> DataFrame:
    """Suppliers as symbols: a line defines, imports, writes or reads by its return flag and status."""
    r, ship = F.col("l_returnflag"), F.col("l_linestatus")
    bits = F.when(r == "A", 1).otherwise(0) + F.when(ship == "F", 8).otherwise(0) + F.when(r == "N", 2).otherwise(0)
    rows = _t(spark, d, "lineitem").select("l_suppkey", bits.alias("roles"))
    return rows.groupBy("l_suppkey").agg(
        F.count_if(S.is_definition(F.col("roles"))).alias("definitions"), F.count_if(S.is_reference(F.col("roles"))).alias("references"),
        F.count_if(S.is_definition(F.col("roles")) & S.is_reference(F.col("roles"))).alias("both"),
    )


def dependency_risk_score(spark, d) -> DataFrame:
    s = _t(spark, d, "supplier")
    level = F.when(F.col("s_suppkey") % 5 == 0, "critical").when(F.col("s_suppkey") % 5 == 1, "high").when(F.col("s_suppkey") % 5 == 2, "medium").when(F.col("s_suppkey") % 5 == 3, "low")
    return s.select("s_suppkey", S.dependency_risk(level, F.when(F.col("s_nationkey") < 12, F.lit(0.5))).alias("score"))


def unresolved_calls(spark, d) -> DataFrame:
    lines, known = _t(spark, d, "lineitem"), _t(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_suppkey").alias("callee"))
    return S.unresolved_calls(lines.select("l_orderkey", "l_suppkey").join(known, "l_suppkey", "left"), "l_orderkey", "callee")


def known_or_all(spark, d) -> DataFrame:
    """Each order's suppliers: those in credit, or all if none is."""
    lines, supplier = _t(spark, d, "lineitem"), _t(spark, d, "supplier")
    rows = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    lists = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("v"), F.array_sort(F.collect_set(F.when(F.col("s_acctbal") > 0, F.col("l_suppkey")))).alias("k"))
    return lists.select("l_orderkey", F.array_join(S.known_or_all(F.col("v"), F.col("k")).cast("array<string>"), ",").alias("suppliers"))


def common_prefixes(spark, d) -> DataFrame:
    part = _t(spark, d, "part").select(F.concat(F.lit("pkg."), F.translate("p_brand", "#", "."), F.lit("."), F.col("p_size").cast("string")).alias("name"), "p_brand")
    return part.groupBy("p_brand").agg(F.collect_set("name").alias("n")).select("p_brand", S.common_prefix(F.col("n"), 3).alias("prefix"))


def trimmed_nodes(spark, d) -> DataFrame:
    return S.trimmed(_t(spark, d, "part").select(F.col("p_partkey").alias("node")), 50, 23)


def trimmed_edges(spark, d) -> DataFrame:
    """A view of the trade graph within budgets of nodes and edges."""
    return S.trimmed_graph(graphs.graph_edges(spark, d), 15, 60, 8)[0]


def graph_stats(spark, d) -> DataFrame:
    out = S.graph_stats("trade", graphs.graph_edges(spark, d)).unionByName(S.graph_stats("tree", graphs._tree(spark, d)))
    return out.withColumns({"density": F.round("density", 8), "mean_degree": F.round("mean_degree", 6)})


def path_union(spark, d) -> DataFrame:
    """Nations of customers or suppliers, of those in two regions."""
    c, s, n = _t(spark, d, "customer"), _t(spark, d, "supplier"), _t(spark, d, "nation").where("n_regionkey < 2")
    both = c.select(F.col("c_nationkey").alias("nation")).union(s.select("s_nationkey")).distinct()
    return both.join(n.select(F.col("n_nationkey").alias("nation")), "nation", "left_semi")


QUERIES = {
    f.__name__: f
    for f in (
        induced_edges, ranked_span_lookup, first_seen_definition, capped_findings, symbol_roles, dependency_risk_score, unresolved_calls, known_or_all, common_prefixes,
        trimmed_nodes, trimmed_edges, graph_stats, path_union,
    )
}

ORACLES = {
    "induced_edges": f"""WITH {graphs._TRADE}, k AS (SELECT n_nationkey AS n FROM nation WHERE n_regionkey IN (1, 2))
        SELECT * FROM trade WHERE src IN (SELECT n FROM k) AND dst IN (SELECT n FROM k)""",
    "ranked_span_lookup": """
        WITH s AS (SELECT user_id, 'm.' || event_type AS span_name, min(event_id) AS first, max(event_id) AS last FROM events GROUP BY 1, 2),
        q AS (SELECT user_id, event_id AS start, CASE WHEN event_id % 5 <> 0 THEN event_id + (event_id % 3) * 100000 ELSE event_id END AS stop,
            CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'other.' || event_type ELSE event_type END AS name FROM events),
        c AS (SELECT start AS id, user_id || ':' || span_name AS span_id, first, start = first AND stop = last AS same, first <= start AND start <= last AS inside,
            coalesce(span_name = name OR suffix(span_name, '.' || string_split(name, '.')[-1]), false) AS named, start = first AS top FROM q JOIN s USING (user_id)),
        k AS (SELECT *, CASE WHEN same AND named THEN 1 WHEN same THEN 2 WHEN inside AND named THEN 3 WHEN inside THEN 4 WHEN top THEN 5 END AS step FROM c),
        b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step, first, span_id) AS r FROM k WHERE step IS NOT NULL)
        SELECT e.event_id AS lookup_id, coalesce(span_id, '') AS span_id, coalesce(step, 0) AS step FROM events e LEFT JOIN (SELECT * FROM b WHERE r = 1) b ON b.id = e.event_id""",
    "first_seen_definition": """SELECT o_custkey, o_orderkey, o_orderstatus FROM
        (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1""",
    "capped_findings": """SELECT rule, event_id, CASE rule WHEN 'error' THEN 'error' WHEN 'click' THEN 'ignored' ELSE given END AS severity FROM
        (SELECT event_type AS rule, event_id, CASE WHEN value > 50 THEN 'warning' ELSE 'info' END AS given, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r FROM events) WHERE r <= 5""",
    "symbol_roles": """SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'A') AS definitions, count(*) FILTER (WHERE l_linestatus = 'F' OR l_returnflag = 'N') AS "references",
        count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS both FROM lineitem GROUP BY 1""",
    "dependency_risk_score": """SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 4.0::DOUBLE WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0.5 END
        * CASE WHEN s_nationkey < 12 THEN 0.5::DOUBLE ELSE 1 END AS score FROM supplier""",
    "unresolved_calls": """SELECT l_orderkey, count(*) AS unresolved FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey
        WHERE s_suppkey IS NULL GROUP BY 1""",
    "known_or_all": """SELECT l_orderkey, coalesce(string_agg(DISTINCT CASE WHEN s_acctbal > 0 THEN l_suppkey END, ',' ORDER BY CASE WHEN s_acctbal > 0 THEN l_suppkey END),
        string_agg(DISTINCT l_suppkey, ',' ORDER BY l_suppkey)) AS suppliers FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""",
    "common_prefixes": """WITH n AS (SELECT DISTINCT p_brand, translate(p_brand, '#', '.') AS b, p_size FROM part),
        c AS (SELECT p_brand, string_split('pkg.' || any_value(b) || CASE WHEN count(*) = 1 THEN '.' || any_value(p_size) ELSE '' END, '.') AS l FROM n GROUP BY 1)
        SELECT p_brand, array_to_string(l[1:3], '.') AS prefix FROM c""",
    "trimmed_nodes": """SELECT p_partkey AS node FROM (SELECT p_partkey, row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) - 1 AS r, count(*) OVER () AS n FROM part)
        WHERE (r - 23 + n) % n < 50""",
    "trimmed_edges": f"""WITH {graphs._TRADE}, n AS (SELECT src AS node FROM trade UNION SELECT dst FROM trade),
        k AS (SELECT node FROM (SELECT node, row_number() OVER (ORDER BY CAST(node AS VARCHAR)) - 1 AS r, count(*) OVER () AS c FROM n) WHERE (r - 8 + c) % c < 15),
        i AS (SELECT *, row_number() OVER (ORDER BY CAST(src AS VARCHAR), CAST(dst AS VARCHAR)) - 1 AS r, count(*) OVER () AS c FROM trade
            WHERE src IN (SELECT node FROM k) AND dst IN (SELECT node FROM k))
        SELECT src, dst, weight FROM i WHERE (r - 8 + c) % c < 60""",
    "graph_stats": f"""WITH RECURSIVE {graphs._TRADE}, {graphs._TREE}, e AS (SELECT 'trade' AS graph, src, dst FROM trade UNION SELECT 'tree', src, dst FROM tree),
        w AS (SELECT graph, src, dst FROM e UNION SELECT graph, dst, src FROM e),
        low AS (SELECT DISTINCT graph, src AS node, src AS low FROM w UNION SELECT w.graph, w.dst, low.low FROM low JOIN w ON w.graph = low.graph AND w.src = low.node WHERE low.low < w.dst),
        n AS (SELECT graph, count(DISTINCT src) AS nodes FROM w GROUP BY 1),
        r AS (SELECT graph, count(DISTINCT low) AS components FROM (SELECT graph, node, min(low) AS low FROM low GROUP BY 1, 2) GROUP BY 1),
        m AS (SELECT graph, count(*) AS edges, count(*) FILTER (WHERE src = dst) AS loops FROM e GROUP BY 1),
        b AS (SELECT x.graph, count(*) AS reciprocal FROM e x JOIN e y ON x.graph = y.graph AND x.src = y.dst AND x.dst = y.src WHERE x.src <> x.dst GROUP BY 1)
        SELECT graph, nodes, edges, round(edges / (nodes * (nodes - 1))::DOUBLE, 8) AS density, round(2 * edges / nodes::DOUBLE, 6) AS mean_degree,
            components, loops, coalesce(reciprocal, 0) AS reciprocal FROM n JOIN m USING (graph) JOIN r USING (graph) LEFT JOIN b USING (graph)""",
    "path_union": """SELECT nation FROM (SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier) WHERE nation IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)""",
}
