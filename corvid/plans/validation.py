"""Findings of the checks over the star schema: nations call each other, regions are layers and packages, parts are functions in files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import validation as V
from corvid.plans import code_tables, graphs
from corvid.session import settle


def _t(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _said(df: DataFrame) -> DataFrame:
    return df.select("check_name", "severity", "path", "detail", "items", F.array_join("sample", ",").alias("sample"))


def graph_findings(spark, d) -> DataFrame:
    """Checks of the trade between nations, of the brands that suppliers' nations sell, and of suppliers beside their nations."""
    edges, nation = settle(graphs._trade(spark, d).select("src", "dst")), _t(spark, d, "nation")
    key = F.col("n_nationkey").cast("long")
    nodes = nation.select(key.alias("node"), F.lit("function").alias("kind")).unionByName(nation.select((key + 100).alias("node"), F.when(key % 2 == 0, "class").alias("kind")))
    layers = nation.select(key.alias("node"), F.col("n_regionkey").alias("layer"))
    sold = _t(spark, d, "lineitem").join(_t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select((F.col("l_partkey") % 400).alias("key"), F.col("s_nationkey").alias("module"))
    members = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("module"), (F.col("s_suppkey") % 7 != 0).alias("agrees"))
    labels = _t(spark, d, "part").select(F.col("p_partkey").alias("node"), F.when(F.col("p_size") > 3, F.col("p_size")).alias("label"))
    found = [V.call_graph_checks(nodes, edges), V.import_graph_checks(edges, layers, (F.col("node") % 5).cast("string")).where("check_name <> 'import_graph_bridges'"), V.broad_keys(sold), V.disagreements(members), V.large_communities(labels), V.hubs(edges, "symbol_graph_hubs", "warning")]
    return _said(reduce(DataFrame.unionByName, found))


def file_findings(spark, d) -> DataFrame:
    """Checks of files: functions that aren't known, calls outside their caller, files without a known function."""
    functions = code_tables.functions(spark, d)
    known = functions.where("complexity % 3 <> 0")
    calls = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("caller_id"), F.concat(F.lit("o"), (F.col("l_orderkey") % 50).cast("string")).alias("path"), (F.col("l_partkey") % 300 + F.col("l_linenumber")).alias("line"))
    spans = functions.select("function_id", F.col("start_line").alias("first"), F.coalesce("end_line", "start_line").alias("last"))
    modules = _t(spark, d, "orders").select(F.concat(F.lit("f"), (F.col("o_custkey") % 120).cast("string"), F.lit(".py")).alias("path")).distinct()
    return _said(V.missing_functions(functions, known).unionByName(V.stray_calls(calls, spans)).unionByName(V.orphan_modules(modules, known)))


QUERIES = {f.__name__: f for f in (graph_findings, file_findings)}

#: (check, severity, text, a query for item as text)
_CHECKS = [
    ("call_graph_isolated_nodes", "warning", "isolated nodes", "SELECT n_nationkey + 100 AS i FROM nation WHERE n_nationkey % 2 <> 0 UNION SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT node FROM n)"),
    ("call_graph_large_scc", "warning", "cycles", "SELECT c AS i FROM scc GROUP BY c HAVING count(*) >= 5"),
    ("call_graph_degree_hubs", "info", "hubs", "SELECT node AS i FROM deg WHERE d > (SELECT greatest(10, floor(count(*) * 0.1)) FROM deg)"),
    ("import_graph_large_scc", "warning", "cycles", "SELECT c AS i FROM scc GROUP BY c HAVING count(*) > 5"),
    ("import_graph_cross_package_cycles", "warning", "cycles cross package boundaries", "SELECT c AS i FROM scc GROUP BY c HAVING count(DISTINCT node % 5) > 1"),
    ("import_graph_degree_hubs", "info", "hubs", "SELECT node AS i FROM deg WHERE d > (SELECT greatest(10, floor(count(*) * 0.1)) FROM deg)"),
    ("import_graph_upward_edges", "info", "edges go from deeper to shallower layer", "SELECT src || '->' || dst AS i FROM trade JOIN nation a ON a.n_nationkey = src JOIN nation b ON b.n_nationkey = dst WHERE a.n_regionkey > b.n_regionkey"),
    ("config_keys_broad_usage", "info", "keys used widely", "SELECT k AS i FROM u WHERE c > (SELECT greatest(2, floor(count(*) * 0.05)) FROM u)"),
    ("subsystem_community_disagreement", "warning", "modules disagree", "SELECT s_suppkey AS i FROM supplier WHERE s_suppkey % 7 = 0"),
    ("symbol_graph_large_community", "info", "communities exceed threshold", "SELECT p_size AS i FROM part WHERE p_size > 3 GROUP BY 1 HAVING count(*) > 2"),
    ("symbol_graph_hubs", "warning", "hubs", "SELECT node AS i FROM deg WHERE d > (SELECT greatest(10, floor(count(*) * 0.1)) FROM deg)"),
]

ORACLES = {
    "graph_findings": f"""WITH RECURSIVE {graphs._TRADE}, n AS (SELECT src AS node FROM trade UNION SELECT dst FROM trade), deg AS (SELECT node, count(*) AS d FROM (SELECT src AS node FROM trade UNION ALL SELECT dst FROM trade) GROUP BY 1),
        reach AS (SELECT node AS a, node AS b FROM n UNION SELECT r.a, dst FROM reach r JOIN trade ON src = r.b), scc AS (SELECT r.a AS node, min(r.b) AS c FROM reach r JOIN reach s ON s.a = r.b AND s.b = r.a GROUP BY 1),
        u AS (SELECT l_partkey % 400 AS k, count(DISTINCT s_nationkey) AS c FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
        f AS ({" UNION ALL ".join(f"SELECT '{c}' AS check_name, '{v}' AS severity, '{t}' AS t, CAST(i AS VARCHAR) AS i FROM ({q})" for c, v, t, q in _CHECKS)})
        SELECT check_name, severity, NULL::VARCHAR AS path, count(*) || ' ' || t AS detail, count(*) AS items, array_to_string(list_sort(list(i))[1:5], ',') AS sample FROM f GROUP BY check_name, severity, t""",
    "file_findings": f"""WITH {code_tables._FN}, k AS (SELECT * FROM fn WHERE cx % 3 <> 0), p AS (SELECT path, count(*) AS a FROM fn GROUP BY 1), q AS (SELECT path, count(*) AS b FROM k GROUP BY 1),
        c AS (SELECT l_partkey AS id, 'o' || (l_orderkey % 50) AS path, l_partkey % 300 + l_linenumber AS line FROM lineitem)
        SELECT 'missing_function_goids' AS check_name, 'warning' AS severity, path, a || ' functions, ' || coalesce(b, 0) || ' GOIDs' AS detail, 1::BIGINT AS items, path AS sample FROM p LEFT JOIN q USING (path) WHERE coalesce(b, 0) < a
        UNION ALL SELECT 'callsite_span_mismatch', 'warning', c.path, 'callsite ' || line || ' outside span ' || s || '-' || coalesce(e, s), 1, c.path FROM c JOIN fn USING (id) WHERE line < s OR line > coalesce(e, s)
        UNION ALL SELECT DISTINCT 'orphan_module', 'warning', 'f' || (o_custkey % 120) || '.py', 'no module GOID', 1, 'f' || (o_custkey % 120) || '.py' FROM orders WHERE 'f' || (o_custkey % 120) || '.py' NOT IN (SELECT path FROM k)""",
}
