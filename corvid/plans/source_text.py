"""Queries over source text, index files and patch logs that Spark writes out of the star schema: a file for each part, a document for
each order, a commit for each order. What their SQL says of a file was read off its text by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators import chains, communities, graph, incremental
from corvid.plans import graphs
from corvid.session import scratch_dir, settle
from corvid.sources import contracts, patches, python_ast, python_flow, symbols

#: Three kinds of functions; % stands for the part's size.
_LOOP = """def run(a, n):
    total = a
    for i in range(n):
        if i > %:
            total = total + i
        else:
            continue
        total = total - 1
    return total
"""
_RETRY = """def run(a: int, n: Optional[str]) -> bool:
    assert a >= %
    if n is None:
        raise ValueError("n")
    while a:
        a = step(a)
        if a == n:
            break
    else:
        a = n
    return a == %
"""
_PLAIN = """def run(a, n):
    b = a
    if n:
        b = n
    c = b
    def inner(d=b):
        return d + c
    if not n:
        raise errors.Empty
    c = inner
"""


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark, d) -> DataFrame:
    """path, text: a file for each part, of a kind by its key."""
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 3
    text = F.when(kind == 0, _LOOP).when(kind == 1, _RETRY).otherwise(_PLAIN)
    return _t(spark, d, "part").select(F.concat(F.lit("src/p"), F.col("p_partkey").cast("string"), F.lit(".py")).alias("path"), F.replace(text, F.lit("%"), size).alias("text"))


def _part(df: DataFrame) -> DataFrame:
    return df.withColumn("part", F.regexp_extract("path", r"p(\d+)\.py", 1).cast("long"))


def data_flow(spark, d) -> DataFrame:
    """Edges from definitions to reads of all functions."""
    return _part(python_flow.data_flow(files(spark, d)).where("qualname = 'run'")).select("part", "src_block", "dst_block", "symbol", "kind", "via_phi", "uses")


def control_flow(spark, d) -> DataFrame:
    """Measures of the control flow of all functions."""
    rows = _part(python_flow.flow_metrics(files(spark, d))[0].where("qualname = 'run'"))
    cols = ("blocks", "edges", "components", "longest_path", "loops", "largest_loop", "unreachable", "loop_headers", "paths", "branching_max", "dominator_height", "frontier_max")
    return rows.select("part", *[F.col(c).cast("long").alias(c) for c in cols], F.round("mean_distance", 6).alias("mean_distance"), F.round("frontier_mean", 6).alias("frontier_mean"))


def contract_rows(spark, d) -> DataFrame:
    """Conditions, raises and nullability of all functions, as text."""
    rows = _part(contracts.function_contracts(files(spark, d)).where("qualname = 'run'"))
    said = lambda c, *fields: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[F.coalesce(x[f].cast("string"), F.lit("-")) for f in fields])), ",")
    return rows.select(
        "part", said("preconditions", "kind", "param", "value", "source", "line").alias("pre"), said("postconditions", "kind", "line").alias("post"), said("raises", "exception", "message", "line").alias("raised"),
        F.element_at("param_nullability", "a").alias("a"), F.element_at("param_nullability", "n").alias("n"), F.coalesce("return_nullability", F.lit("-")).alias("result"), F.round("confidence", 3).alias("confidence"),
    )


def function_rows(spark, d) -> DataFrame:
    """Sizes and typedness of all functions."""
    rows = _part(python_ast.functions(files(spark, d)))
    return rows.select("part", "qualname", "kind", "n_params", "n_annotated", "returns_annotated", "loc", "n_returns", "n_raises", "typedness")


def call_rows(spark, d) -> DataFrame:
    """Calls by callee, over all files."""
    return python_ast.calls(files(spark, d)).groupBy("caller", "callee").agg(F.count("*").alias("calls"))


def index_payloads(spark, d) -> DataFrame:
    """name, text: an index of documents for each customer, a document for each order, an occurrence for each line."""
    bits = F.when(F.col("l_returnflag") == "A", 1).otherwise(0) + F.when(F.col("l_linestatus") == "F", 8).otherwise(0) + F.when(F.col("l_returnflag") == "N", 2).otherwise(0)
    at = F.struct("l_linenumber", F.struct(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("symbol"), bits.alias("symbol_roles"), F.array(F.col("l_linenumber").cast("int"), F.lit(0)).alias("range")).alias("o"))
    docs = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(at)), lambda x: x["o"]).alias("occurrences"))
    path = F.concat(F.lit("o\\"), F.col("o_orderkey").cast("string"), F.lit(".py"))
    held = docs.join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", F.struct(F.col("o_orderkey").alias("k"), path.alias("relative_path"), "occurrences").alias("x"))
    listed = held.groupBy("o_custkey").agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: F.struct(x["relative_path"].alias("relative_path"), x["occurrences"].alias("occurrences"))).alias("documents"))
    return listed.select(F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("name"), F.to_json(F.struct("documents")).alias("text"))


def symbol_uses(spark, d) -> DataFrame:
    """Which orders use symbols, and where each is defined first; orders of one priority are a module."""
    rows = settle(symbols.occurrences(index_payloads(spark, d)))
    modules = _t(spark, d, "orders").select(F.concat(F.lit("o/"), F.col("o_orderkey").cast("string"), F.lit(".py")).alias("path"), F.col("o_orderpriority").alias("module"))
    return symbols.symbol_uses(rows, modules)


def symbol_definitions(spark, d) -> DataFrame:
    return symbols.definition_paths(symbols.occurrences(index_payloads(spark, d)))


def patch_deltas(spark, d) -> DataFrame:
    """Lines added and deleted by file and commit, read back from a patch log with a commit for each order and a hunk for each line."""
    lines = _t(spark, d, "lineitem").join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    hunk = F.concat(
        F.lit("diff --git a/s"), F.col("l_suppkey").cast("string"), F.lit(".py b/s"), F.col("l_suppkey").cast("string"), F.lit(".py\n@@ -"), F.col("l_partkey").cast("string"), F.lit(","),
        F.col("l_linenumber").cast("string"), F.lit(" +"), F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, ",0").otherwise(""), F.lit(" @@"),
    )
    commits = lines.groupBy("o_orderkey", "o_custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", hunk.alias("t")))), lambda x: x["t"]), "\n").alias("hunks"))
    head = F.concat(F.lit("@@@c"), F.col("o_orderkey").cast("string"), F.lit("\tu"), F.col("o_custkey").cast("string"), F.lit("\t2024-01-02T03:04:05+00:00\n"))
    path = f"{scratch_dir(spark)}/corvid-log-{spark.sparkContext.applicationId}-{id(commits)}"
    commits.select(F.concat(head, "hunks")).write.mode("overwrite").text(path)
    deltas = patches.commit_deltas(patches.hunks(spark, path))
    return deltas.select("path", "commit", "author", F.col("lines_added").cast("long").alias("added"), F.col("lines_deleted").cast("long").alias("deleted"), "hunks")


def communities_by_mergers(spark, d) -> DataFrame:
    """Communities of the suppliers that share parts."""
    return communities.merge_communities(graphs.projection_edges(spark, d))


def community_modularity(spark, d) -> DataFrame:
    """Modularity of the nations' regions over their trade."""
    labels = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.col("n_regionkey").cast("long").alias("label"))
    return communities.modularity(graphs._trade(spark, d), labels).withColumn("modularity", F.round("modularity", 8))


def communities_by_graph(spark, d) -> DataFrame:
    """Communities of each customer's suppliers, linked where two lines of an order follow each other."""
    lines, orders = _t(spark, d, "lineitem"), _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    a = lines.select("l_orderkey", F.col("l_linenumber").alias("n"), F.col("l_suppkey").cast("long").alias("src"))
    b = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("n"), F.col("l_suppkey").cast("long").alias("dst"))
    links = a.join(b, ["l_orderkey", "n"]).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("graph"), "src", "dst").agg(F.count("*").alias("weight"))
    return communities.greedy_communities(links)


def _clusters(spark, d) -> DataFrame:
    """Parts by brand, those of large sizes by their own key."""
    label = F.when(F.col("p_size") <= 30, F.col("p_brand")).otherwise(F.concat(F.lit("x"), (F.col("p_partkey") % 700).cast("string")))
    return _t(spark, d, "part").select(F.col("p_partkey").cast("long").alias("node"), label.alias("label"), F.col("p_partkey").cast("long").alias("place"))


def small_clusters(spark, d) -> DataFrame:
    """Parts of small clusters, moved one after the other along the key tree."""
    return communities.reassign_small(_clusters(spark, d), graphs._tree(spark, d), 20)


def limited_clusters(spark, d) -> DataFrame:
    return communities.limit_clusters(_clusters(spark, d), graphs._tree(spark, d), 8)


def transitive_effects(spark, d) -> DataFrame:
    """What parts reach within three steps of the parts bought in a row, where every ninth part has an effect."""
    calls = graphs._follow(spark, d).select("src", "dst", F.col("weight").alias("place"))
    marked = _t(spark, d, "part").where("p_partkey % 9 = 0").select(F.col("p_partkey").cast("long").alias("node"))
    found = communities.transitive_effects(calls, marked)
    return found.select("node", F.array_join(F.col("targets").cast("array<string>"), ",").alias("targets"), "hop")


def call_chains(spark, d) -> DataFrame:
    """Chains of at most four trades from two nations to all others, the shortest three."""
    nation = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"))
    found = chains.call_chains(graphs._trade(spark, d), nation.where("node in (3, 11)"), nation, 3, 4)
    return found.select("target", "rank", F.array_join(F.col("chain").cast("array<string>"), ">").alias("chain"))


def refreshed_table(spark, d) -> DataFrame:
    """Sizes of files after every tenth part's text has changed and every hundredth is gone: only what is affected is built again."""
    after = files(spark, d).withColumn("k", F.regexp_extract("path", r"p(\d+)", 1).cast("long"))
    hashed = lambda df: df.withColumn("content_hash", F.sha2("text", 256))
    before, after = hashed(after), hashed(after.where("k % 100 <> 7").withColumn("text", F.when(F.col("k") % 10 == 3, F.concat("text", F.lit("\n# changed\n"))).otherwise(F.col("text"))))
    uses = graph.weighted_edges(after.select(F.col("path").alias("a"), F.concat(F.lit("src/p"), F.floor(F.col("k") / 2).cast("string"), F.lit(".py")).alias("b")), "a", "b")
    build = lambda f: f.select("path", F.length("text").alias("chars"))
    target = f"{scratch_dir(spark)}/corvid-refresh-{spark.sparkContext.applicationId}-{id(after)}"
    incremental.refresh(target, before.limit(0), before, build, uses)
    incremental.refresh(target, before, after, build, uses)
    return _part(incremental.read_current(spark, target)).select("part", "chars")


QUERIES = {
    f.__name__: f
    for f in (
        data_flow, control_flow, contract_rows, function_rows, call_rows, symbol_uses, symbol_definitions, patch_deltas, communities_by_mergers, community_modularity,
        communities_by_graph, small_clusters, limited_clusters, transitive_effects, call_chains, refreshed_table,
    )
}

# Kinds of files by part key: 0 a loop with a guard, 1 a while with a break and an else, 2 two ifs.
_OCC = """occ AS (SELECT o_custkey AS c, o_orderkey AS k, l_linenumber AS n, 's' || l_suppkey AS symbol, 'o/' || o_orderkey || '.py' AS path, o_orderpriority AS module,
    l_returnflag = 'A' AS def, l_linestatus = 'F' OR l_returnflag = 'N' AS ref FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    defs AS (SELECT symbol, first(path ORDER BY lpad(CAST(c AS VARCHAR), 12, '0'), k, n) AS def_path, first(module ORDER BY lpad(CAST(c AS VARCHAR), 12, '0'), k, n) AS def_module FROM occ WHERE def GROUP BY 1)"""

ORACLES = {
    "data_flow": """SELECT p_partkey AS part, v.* EXCLUDE (k) FROM part JOIN (VALUES
        (0, 2, 4, 'i', 'data-flow', false, 1), (0, 1, 5, 'total', 'data-flow', true, 1), (0, 7, 5, 'total', 'data-flow', true, 1), (0, 2, 5, 'i', 'data-flow', false, 1),
        (0, 5, 7, 'total', 'data-flow', false, 1), (0, 1, 3, 'total', 'data-flow', true, 1), (0, 7, 3, 'total', 'data-flow', true, 1),
        (1, 6, 4, 'a', 'data-flow', false, 1), (1, 6, 6, 'a', 'data-flow', false, 1), (1, 6, 6, 'a', 'intra-block', false, 1), (1, 6, 5, 'a', 'data-flow', true, 1),
        (1, 9, 5, 'a', 'data-flow', true, 1), (2, 1, 3, 'b', 'data-flow', true, 2), (2, 2, 3, 'b', 'data-flow', true, 2), (2, 3, 3, 'c', 'intra-block', false, 1))
        v(k, src_block, dst_block, symbol, kind, via_phi, uses) ON p_partkey % 3 = k""",
    "control_flow": """SELECT p_partkey AS part, v.* EXCLUDE (k) FROM part JOIN (VALUES
        (0, 9, 9, 5, 3, 1, 5, 1, 1, 0, 2, 5, 1, 2.75::DOUBLE, 0.555556::DOUBLE), (1, 11, 11, 9, 5, 1, 3, 1, 1, 0, 2, 5, 2, 3.1, 0.545455), (2, 7, 7, 7, 5, 0, 0, 0, 0, 2, 2, 4, 1, 2.142857, 0.142857))
        v(k, blocks, edges, components, longest_path, loops, largest_loop, unreachable, loop_headers, paths, branching_max, dominator_height, frontier_max, mean_distance, frontier_mean) ON p_partkey % 3 = k""",
    "function_rows": """SELECT p_partkey AS part, v.* EXCLUDE (k) FROM part JOIN (VALUES
        (0, 'run', 'function', 2, 0, false, 9, 1, 0, 'untyped'), (1, 'run', 'function', 2, 2, true, 11, 1, 1, 'typed'),
        (2, 'run', 'function', 2, 0, false, 10, 0, 1, 'untyped'), (2, 'run.inner', 'method', 1, 0, false, 2, 1, 0, 'untyped'))
        v(k, qualname, kind, n_params, n_annotated, returns_annotated, loc, n_returns, n_raises, typedness) ON p_partkey % 3 = k""",
    "call_rows": """SELECT 'run' AS caller, callee, count(*) AS calls FROM part JOIN (VALUES (0, 'range'), (1, 'ValueError'), (1, 'step')) v(k, callee) ON p_partkey % 3 = k GROUP BY 2""",
    "contract_rows": """SELECT p_partkey AS part, CASE p_partkey % 3 WHEN 1 THEN 'ge:a:' || p_size || ':assert:2,non_null:n:-:guard:3' WHEN 2 THEN 'truthy:n:-:assert:8' ELSE '' END AS pre,
        CASE p_partkey % 3 WHEN 1 THEN 'non_null:11,returns_bool_predicate:11' ELSE '' END AS post, CASE p_partkey % 3 WHEN 1 THEN 'ValueError:n:4' WHEN 2 THEN 'errors.Empty:-:9' ELSE '' END AS raised,
        CASE p_partkey % 3 WHEN 1 THEN 'non_null' ELSE 'unknown' END AS a, CASE p_partkey % 3 WHEN 1 THEN 'nullable' ELSE 'unknown' END AS n,
        CASE p_partkey % 3 WHEN 1 THEN 'non_null' ELSE '-' END AS result, CASE p_partkey % 3 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 0.6 ELSE 0.3 END AS confidence FROM part""",
    "symbol_uses": f"""WITH {_OCC} SELECT DISTINCT symbol, def_path, path AS use_path, def_path = path AS same_file, def_module = module AS same_module FROM occ JOIN defs USING (symbol) WHERE ref""",
    "symbol_definitions": f"WITH {_OCC} SELECT symbol, def_path FROM defs",
    "patch_deltas": """SELECT 's' || l_suppkey || '.py' AS path, 'c' || o_orderkey AS "commit", 'u' || o_custkey AS author, CAST(sum(CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS added,
        CAST(sum(l_linenumber) AS BIGINT) AS deleted, count(*) AS hunks FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
    "community_modularity": f"""WITH {graphs._TRADE}, u AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, sum(weight) AS w FROM trade WHERE src <> dst GROUP BY 1, 2),
        r AS (SELECT n_nationkey AS n, n_regionkey AS g FROM nation), l AS (SELECT x.g AS ga, y.g AS gb, w FROM u JOIN r x ON x.n = a JOIN r y ON y.n = b), m AS (SELECT sum(w) AS m FROM l),
        k AS (SELECT g, sum(w) AS k, sum(i) AS i FROM (SELECT ga AS g, w, CASE WHEN ga = gb THEN w ELSE 0 END AS i FROM l UNION ALL SELECT gb, w, 0 FROM l) GROUP BY 1)
        SELECT round(sum(i / m - (k / (2 * m)) * (k / (2 * m))), 8) AS modularity FROM k, m""",
    "transitive_effects": """WITH e AS (SELECT least(a.l_partkey, b.l_partkey) AS src, greatest(a.l_partkey, b.l_partkey) AS dst, count(*) AS place FROM lineitem a JOIN lineitem b
            ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber WHERE a.l_partkey <> b.l_partkey GROUP BY 1, 2),
        t0 AS (SELECT src AS node, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS targets FROM e WHERE dst % 9 = 0 GROUP BY 1),
        t1 AS (SELECT src AS node, first(targets ORDER BY place, dst) AS targets FROM e JOIN t0 ON node = dst GROUP BY 1),
        t2 AS (SELECT src AS node, first(targets ORDER BY place, dst) AS targets FROM e JOIN t1 ON node = dst GROUP BY 1),
        u AS (SELECT *, 1 AS hop FROM t0 UNION ALL SELECT *, 2 FROM t1 UNION ALL SELECT *, 3 FROM t2)
        SELECT node, first(targets ORDER BY hop) AS targets, min(hop) AS hop FROM u WHERE node % 9 <> 0 GROUP BY node""",
    "call_chains": f"""WITH RECURSIVE {graphs._TRADE}, n AS (SELECT CAST(n_nationkey AS BIGINT) AS node FROM nation),
        p AS (SELECT node AS v, [node] AS chain FROM n WHERE node IN (3, 11) UNION ALL SELECT dst, list_append(chain, dst) FROM p JOIN trade ON src = v AND NOT list_contains(chain, dst) WHERE len(chain) <= 4),
        r AS (SELECT v AS target, chain, row_number() OVER (PARTITION BY v ORDER BY len(chain), chain) AS rank FROM p WHERE len(chain) > 1)
        SELECT target, CAST(rank AS INTEGER) AS rank, array_to_string(chain, '>') AS chain FROM r WHERE rank <= 3
        UNION ALL SELECT node, 1, CAST(node AS VARCHAR) FROM n WHERE node NOT IN (SELECT target FROM r)""",
    "refreshed_table": f"""SELECT p_partkey AS part, CAST(CASE p_partkey % 3 {" ".join(f"WHEN {k} THEN {len(t) - t.count('%')} + {t.count('%')} * length(CAST(p_size AS VARCHAR))" for k, t in enumerate((_LOOP, _RETRY, _PLAIN)))} END
        + CASE WHEN p_partkey % 10 = 3 THEN 11 ELSE 0 END AS BIGINT) AS chars FROM part WHERE p_partkey % 100 <> 7""",
}
