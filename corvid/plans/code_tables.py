"""Queries of the tables and views of code analysis: parts are functions in files, lines of orders are covered lines, suppliers are tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import domain as D
from corvid.session import settle
from corvid.sources import reports
from corvid.streaming import changes


def _t(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _snap(df: DataFrame) -> DataFrame:
    return df.select(F.lit("r").alias("repo"), F.lit("c").alias("commit"), "*")


def _path(key):
    return F.concat(F.lit("f"), (key % 97).cast("string"), F.lit(".py"))


def functions(spark, d) -> DataFrame:
    key, start = F.col("p_partkey"), F.floor(F.col("p_partkey") / 97) * 20 + 1
    end = F.when(F.col("p_size") % 7 != 0, start + F.col("p_size") % 19)
    return _snap(_t(spark, d, "part").select(_path(key).alias("path"), key.alias("function_id"), start.cast("long").alias("start_line"), end.cast("long").alias("end_line"), F.col("p_size").alias("complexity")))


def lines(spark, d) -> DataFrame:
    rows = _t(spark, d, "lineitem")
    line = F.floor(F.col("l_partkey") / 97) * 20 + F.col("l_linenumber") * 2
    return _snap(rows.select(_path(F.col("l_partkey")).alias("path"), line.alias("line"), (F.col("l_quantity") > 5).alias("is_executable"), (F.col("l_returnflag") != "R").alias("is_covered"), F.concat(F.lit("t"), F.col("l_suppkey").cast("string")).alias("test_id")))


def catalog(spark, d) -> DataFrame:
    status = F.when(F.col("s_nationkey") % 4 == 1, "failed").when(F.col("s_nationkey") % 4 == 2, "error").otherwise("passed")
    return _snap(_t(spark, d, "supplier").select(F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("test_id"), status.alias("status")))


def function_coverage(spark, d) -> DataFrame:
    out = D.function_coverage(functions(spark, d), lines(spark, d).drop("test_id"))
    return out.select("path", "function_id", "executable_lines", "covered_lines", F.round("coverage_ratio", 8).alias("coverage_ratio"), "untested_reason")


def _edges(spark, d) -> DataFrame:
    return settle(D.test_edges(functions(spark, d), lines(spark, d).select("repo", "commit", "path", "line", "test_id")))


def test_coverage_edges(spark, d) -> DataFrame:
    return _edges(spark, d).select("test_id", "function_id", "covered_lines", F.round("coverage_ratio", 8).alias("coverage_ratio"))


def function_tests(spark, d) -> DataFrame:
    return D.function_tests(_edges(spark, d), catalog(spark, d)).drop("repo", "commit")


def _churn(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    return reports.churn(o.select(
        F.col("o_orderkey").cast("string").alias("commit"), F.col("o_custkey").cast("string").alias("author"), (F.col("o_orderkey") % 50).cast("string").alias("added"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("-")).otherwise((F.col("o_custkey") % 9).cast("string")).alias("deleted"), _path(F.col("o_orderkey") % 80).alias("path"),
    ))


def file_churn(spark, d) -> DataFrame:
    return _churn(spark, d)


def file_hotspots(spark, d) -> DataFrame:
    files = functions(spark, d).groupBy("path").agg(F.sum("complexity").alias("complexity"))
    return D.hotspots(files, _churn(spark, d)).select("path", F.round("score", 8).alias("score"))


def _coverage(spark, d) -> DataFrame:
    return D.function_coverage(functions(spark, d), lines(spark, d).drop("test_id"))


def _tests(spark, d) -> DataFrame:
    return D.function_tests(_edges(spark, d), catalog(spark, d))


def _risk(spark, d, coverage: DataFrame | None = None, tests: DataFrame | None = None) -> DataFrame:
    """Risk factors; coverage and tests may be given where a query needs them beside."""
    f, key = functions(spark, d), F.col("o_custkey")
    errors = _t(spark, d, "orders").select(_path(key).alias("path"), F.when((F.col("o_orderstatus") == "F") & (key % 97 % 3 == 0), 1).otherwise(0).alias("errors"))
    spots = D.hotspots(f.groupBy("path").agg(F.sum("complexity").alias("complexity")), _churn(spark, d))
    return settle(D.risk_factors(f, coverage or _coverage(spark, d), tests or _tests(spark, d), errors, spots))


def risk_factors(spark, d) -> DataFrame:
    return _risk(spark, d).select("function_id", "complexity_bucket", F.round("risk_score", 8).alias("risk_score"), "risk_level", "test_status", "untested_reason")


def file_summary(spark, d) -> DataFrame:
    out = D.file_profile(_risk(spark, d)).drop("repo", "commit")
    return out.withColumns({"mean_risk": F.round("mean_risk", 8), "max_risk": F.round("max_risk", 8)})


def module_summary(spark, d) -> DataFrame:
    """Files by the last digit of their number; imports from each file's module to that of the file after it."""
    risk = _risk(spark, d)
    name = lambda path: F.concat(F.lit("m"), F.regexp_extract(path, r"(\d)\.py", 1))
    files = D.file_profile(risk)
    modules = functions(spark, d).select("repo", "commit", "path", name(F.col("path")).alias("module"), F.lit(None).cast("array<string>").alias("tags")).distinct()
    imports = _t(spark, d, "orders").select(F.concat(F.lit("m"), (F.col("o_orderkey") % 10).cast("string")).alias("src"), F.concat(F.lit("m"), (F.col("o_custkey") % 10).cast("string")).alias("dst"))
    return D.module_profile(files, modules, imports).select("module", "files", "functions", F.round("max_risk", 8).alias("max_risk"), "high_risk_functions", "fan_in", "fan_out", "calls_in", "calls_out")


def call_graph_enriched(spark, d) -> DataFrame:
    """Calls between functions by the risk of both ends; every fifth supplier's callee isn't known."""
    calls = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("caller_id"), F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("callee_id"))
    named = functions(spark, d).withColumn("qualname", F.concat(F.lit("q"), F.col("function_id").cast("string")))
    rows = D.call_graph_enriched(calls, named, _risk(spark, d))
    none = lambda c: F.coalesce(c, F.lit("-")).alias(c)
    return rows.groupBy(none("caller_risk_level"), none("callee_risk_level")).agg(F.count("*").alias("calls"), F.countDistinct("callee_qualname").alias("callees"))


def affinity(spark, d) -> DataFrame:
    """Nations by the trade between them, the regions that they share, and the brands that their suppliers sell."""
    s, c = _t(spark, d, "supplier"), _t(spark, d, "customer")
    module = lambda k: F.concat(F.lit("n"), F.col(k).cast("string"))
    nation = _t(spark, d, "nation")
    imports = s.join(c, F.col("s_suppkey") == F.col("c_custkey")).select(module("s_nationkey").alias("src"), module("c_nationkey").alias("dst"))
    a, b = nation.select("n_regionkey", module("n_nationkey").alias("src")), nation.select("n_regionkey", module("n_nationkey").alias("dst"))
    shared = a.join(b, "n_regionkey").where("src < dst").select("src", "dst")
    sold = _t(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.concat(F.lit("k"), (F.col("l_partkey") % 500).cast("string")).alias("key"), module("s_nationkey").alias("module"))
    return D.affinity_edges(imports, shared, sold).withColumn("weight", F.round("weight", 6))


def subsystem_agreement(spark, d) -> DataFrame:
    s = _t(spark, d, "supplier")
    members = s.select(F.col("s_nationkey").alias("subsystem_id"), F.col("s_suppkey").alias("module"))
    found = s.where("s_suppkey % 11 <> 0").select(F.col("s_suppkey").alias("module"), (F.col("s_suppkey") % 4).alias("community"))
    return D.subsystem_agreement(members, found).withColumn("agreement", F.round("agreement", 8))


def function_history(spark, d) -> DataFrame:
    """Commits that touch functions, by overlap of their lines."""
    rows = _t(spark, d, "lineitem").join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    start = F.floor(F.col("l_partkey") / 97) * 20 + F.col("l_linenumber") * 3
    hunks = rows.select(_path(F.col("l_partkey")).alias("path"), F.col("o_orderkey").alias("commit_id"), F.col("o_custkey").alias("author"), F.col("o_orderdate").cast("date").alias("ts"), start.alias("start"), (start + F.col("l_linenumber") % 3).alias("end"))
    out = D.function_history(functions(spark, d).where("end_line is not null"), hunks, F.lit("1998-09-01").cast("date"))
    known = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("first_commit", "last_commit", "age_days")]
    return out.select("function_id", "commits", "authors", "changed_lines", *known, F.round("churn_score", 8).alias("churn_score"), "stability")


def tag_rules(spark, d) -> DataFrame:
    """Tags of paths made of the words of a part's type."""
    files = _t(spark, d, "part").select("p_partkey", F.concat(F.lower(F.replace("p_type", F.lit(" "), F.lit("/"))), F.lit("/"), (F.col("p_partkey") % 10).cast("string"), F.lit(".py")).alias("path"))
    rules = [
        {"tag": "promo", "includes": ["promo*"]}, {"tag": "even", "includes": ["*/[02468].py"], "excludes": ["*steel*"]}, {"tag": "named", "matches": ["promo/steel/2.py"], "includes": ["economy*/1.py"]},
    ]
    return D.tags_for_paths(files, rules).select("p_partkey", F.array_join("tags", ",").alias("tags"))


def changed_files(spark, d) -> DataFrame:
    """Users as files: their state after the first half of the events beside that after all of them."""
    states = _t(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("rel_path"), F.col("event_id").alias("mtime_ns"), F.col("event_type").alias("content_hash"))
    early = states.where("mtime_ns % 2 = 0")
    return changes.changed_files(early, states)


QUERIES = {
    f.__name__: f
    for f in (
        function_coverage, test_coverage_edges, function_tests, file_churn, file_hotspots, risk_factors, file_summary, module_summary, call_graph_enriched, affinity, subsystem_agreement,
        function_history, tag_rules, changed_files,
    )
}

_FN = """fn AS (SELECT 'f' || (p_partkey % 97) || '.py' AS path, p_partkey AS id, p_partkey // 97 * 20 + 1 AS s, CASE WHEN p_size % 7 <> 0 THEN p_partkey // 97 * 20 + 1 + p_size % 19 END AS e, p_size AS cx FROM part)"""
_LN = """ln AS (SELECT 'f' || (l_partkey % 97) || '.py' AS path, l_partkey // 97 * 20 + l_linenumber * 2 AS line, l_quantity > 5 AS ex, l_returnflag <> 'R' AS cov, 't' || l_suppkey AS test FROM lineitem)"""
_COV = f"""{_FN}, {_LN}, cv AS (SELECT fn.path, id, count(*) FILTER (WHERE ex) AS n, count(*) FILTER (WHERE ex AND cov) AS c FROM fn LEFT JOIN ln ON fn.path = ln.path AND line BETWEEN s AND coalesce(e, s) GROUP BY 1, 2),
    cover AS (SELECT *, CASE WHEN n > 0 THEN c / n::DOUBLE END AS r, CASE WHEN n = 0 THEN 'no_executable_code' WHEN c = 0 THEN 'no_tests' ELSE '' END AS why FROM cv)"""
_TE = f"""te AS (SELECT test, id, count(DISTINCT line) AS k, max(coalesce(e, s) - s + 1) AS size FROM fn JOIN ln ON fn.path = ln.path AND line BETWEEN s AND coalesce(e, s) GROUP BY 1, 2)"""
_FT = """ct AS (SELECT 't' || s_suppkey AS test, CASE s_nationkey % 4 WHEN 1 THEN 'failed' WHEN 2 THEN 'error' ELSE 'passed' END AS st FROM supplier),
    ts AS (SELECT id, count(DISTINCT test) AS tests, count(DISTINCT test) FILTER (WHERE st IN ('failed', 'error')) AS failing, count(DISTINCT test) FILTER (WHERE st = 'passed') AS passing FROM te LEFT JOIN ct USING (test) GROUP BY 1),
    md AS (SELECT id, st AS dominant_status FROM (SELECT id, st, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, st) AS r FROM te JOIN ct USING (test) GROUP BY 1, 2) WHERE r = 1),
    ft AS (SELECT id, tests, failing, passing, dominant_status, CASE WHEN tests = 0 THEN 'untested' WHEN failing > 0 THEN 'some_failing' WHEN passing = tests THEN 'all_passing' ELSE 'unknown' END AS test_status FROM ts LEFT JOIN md USING (id))"""
_CH = """ch AS (SELECT 'f' || (o_orderkey % 80 % 97) || '.py' AS path, count(DISTINCT o_orderkey) AS commits, count(DISTINCT o_custkey) AS authors, CAST(sum(o_orderkey % 50) AS BIGINT) AS added,
    CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_custkey % 9 END) AS BIGINT) AS deleted FROM orders GROUP BY 1)"""
_HS = """hs AS (SELECT path, 0.4 * ln(1 + coalesce(commits, 0)) + 0.3 * ln(1 + coalesce(authors, 0)) + 0.2 * ln(1 + coalesce(added, 0) + coalesce(deleted, 0)) + 0.1 * ln(2 + cx) AS score
    FROM (SELECT path, sum(cx) AS cx FROM fn GROUP BY 1) LEFT JOIN ch USING (path))"""
_RISK = f"""{_COV}, {_TE}, {_FT}, {_CH}, {_HS}, er AS (SELECT 'f' || (o_custkey % 97) || '.py' AS path, sum(CASE WHEN o_orderstatus = 'F' AND o_custkey % 97 % 3 = 0 THEN 1 ELSE 0 END) AS errors FROM orders GROUP BY 1),
    sc AS (SELECT fn.id, fn.path, cx, why, CASE WHEN cx <= 5 THEN 'low' WHEN cx <= 10 THEN 'medium' ELSE 'high' END AS bucket, coalesce(test_status, 'untested') AS test_status,
        coalesce(0.4 * (1 - r), 0.4) + CASE WHEN cx <= 5 THEN 0.0 WHEN cx <= 10 THEN 0.2 ELSE 0.4 END + CASE WHEN errors > 0 THEN 0.2 ELSE 0.0 END + CASE WHEN score > 0 THEN 0.1 ELSE 0.0 END AS x
        FROM fn JOIN cover USING (id) LEFT JOIN ft USING (id) LEFT JOIN er ON er.path = fn.path LEFT JOIN hs ON hs.path = fn.path),
    risk AS (SELECT *, CASE WHEN round(x, 9) >= 0.7 THEN 'high' WHEN round(x, 9) >= 0.4 THEN 'medium' ELSE 'low' END AS level FROM sc)"""
_PROFILE = """SELECT path, count(*) AS functions, round(avg(x), 8) AS mean_risk, round(max(x), 8) AS max_risk, CAST(sum(cx) AS BIGINT) AS complexity, count(*) FILTER (WHERE level = 'high') AS high_risk_functions,
    count(*) FILTER (WHERE level = 'medium') AS medium_risk_functions, count(*) FILTER (WHERE level = 'low') AS low_risk_functions, count(*) FILTER (WHERE test_status = 'untested') AS untested_functions FROM risk GROUP BY 1"""

ORACLES = {
    "function_coverage": f"WITH {_COV} SELECT path, id AS function_id, n AS executable_lines, c AS covered_lines, round(r, 8) AS coverage_ratio, why AS untested_reason FROM cover",
    "test_coverage_edges": f"WITH {_FN}, {_LN}, {_TE} SELECT test AS test_id, id AS function_id, k AS covered_lines, round(k / size::DOUBLE, 8) AS coverage_ratio FROM te",
    "function_tests": f"WITH {_FN}, {_LN}, {_TE}, {_FT} SELECT id AS function_id, * EXCLUDE (id) FROM ft",
    "file_churn": f"WITH {_CH} SELECT path AS rel_path, * EXCLUDE (path) FROM ch",
    "file_hotspots": f"WITH {_FN}, {_CH}, {_HS} SELECT path, round(score, 8) AS score FROM hs",
    "risk_factors": f"WITH {_RISK} SELECT id AS function_id, bucket AS complexity_bucket, round(x, 8) AS risk_score, level AS risk_level, test_status, why AS untested_reason FROM risk",
    "file_summary": f"WITH {_RISK} {_PROFILE}",
    "module_summary": f"""WITH {_RISK}, fp AS ({_PROFILE}), im AS (SELECT 'm' || (o_orderkey % 10) AS src, 'm' || (o_custkey % 10) AS dst FROM orders),
        o AS (SELECT src AS module, count(DISTINCT dst) AS fan_out, count(*) AS calls_out FROM im GROUP BY 1), i AS (SELECT dst AS module, count(DISTINCT src) AS fan_in, count(*) AS calls_in FROM im GROUP BY 1),
        m AS (SELECT 'm' || regexp_extract(path, '(\\d)\\.py', 1) AS module, count(*) AS files, CAST(sum(functions) AS BIGINT) AS functions, max(max_risk) AS max_risk, CAST(sum(high_risk_functions) AS BIGINT) AS high_risk_functions FROM fp GROUP BY 1)
        SELECT m.*, coalesce(fan_in, 0) AS fan_in, coalesce(fan_out, 0) AS fan_out, coalesce(calls_in, 0) AS calls_in, coalesce(calls_out, 0) AS calls_out FROM m LEFT JOIN o USING (module) LEFT JOIN i USING (module)""",
    "call_graph_enriched": f"""WITH {_RISK} SELECT coalesce(a.level, '-') AS caller_risk_level, coalesce(b.level, '-') AS callee_risk_level, count(*) AS calls, count(DISTINCT b.id) AS callees
        FROM lineitem LEFT JOIN risk a ON a.id = l_partkey LEFT JOIN risk b ON b.id = l_suppkey AND l_suppkey % 5 <> 0 GROUP BY 1, 2""",
    "affinity": """WITH im AS (SELECT 'n' || s_nationkey AS a, 'n' || c_nationkey AS b, 1.0::DOUBLE AS w FROM supplier JOIN customer ON s_suppkey = c_custkey),
        sh AS (SELECT 'n' || x.n_nationkey AS a, 'n' || y.n_nationkey AS b, 0.5::DOUBLE AS w FROM nation x JOIN nation y ON x.n_regionkey = y.n_regionkey AND 'n' || x.n_nationkey < 'n' || y.n_nationkey),
        u AS (SELECT DISTINCT l_partkey % 500 AS k, 'n' || s_nationkey AS m FROM lineitem JOIN supplier ON l_suppkey = s_suppkey), z AS (SELECT k, count(*) AS n FROM u GROUP BY 1),
        cf AS (SELECT x.m AS a, y.m AS b, 0.3::DOUBLE / (n - 1) AS w FROM u x JOIN u y ON x.k = y.k AND x.m < y.m JOIN z ON z.k = x.k)
        SELECT least(a, b) AS src, greatest(a, b) AS dst, round(sum(w), 6) AS weight FROM (FROM im UNION ALL FROM sh UNION ALL FROM cf) WHERE a <> b GROUP BY 1, 2""",
    "subsystem_agreement": """WITH m AS (SELECT s_nationkey AS s, s_suppkey, CASE WHEN s_suppkey % 11 <> 0 THEN s_suppkey % 4 END AS c FROM supplier),
        k AS (SELECT s, c AS main FROM (SELECT s, c, row_number() OVER (PARTITION BY s ORDER BY count(*) DESC, c) AS r FROM m WHERE c IS NOT NULL GROUP BY 1, 2) WHERE r = 1)
        SELECT s AS subsystem_id, count(*) AS modules, count(*) FILTER (WHERE c IS NOT NULL AND c <> main) AS disagreements, round(1 - count(*) FILTER (WHERE c IS NOT NULL AND c <> main) / count(*)::DOUBLE, 8) AS agreement
        FROM m LEFT JOIN k USING (s) GROUP BY 1""",
    "function_history": f"""WITH {_FN}, h AS (SELECT 'f' || (l_partkey % 97) || '.py' AS path, o_orderkey AS k, o_custkey AS a, CAST(o_orderdate AS DATE) AS ts, l_partkey // 97 * 20 + l_linenumber * 3 AS b,
            l_partkey // 97 * 20 + l_linenumber * 3 + l_linenumber % 3 AS z FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        g AS (SELECT id, s, e, count(DISTINCT k) AS commits, count(DISTINCT a) AS authors, CAST(coalesce(sum(CASE WHEN z IS NOT NULL THEN least(z, e) - greatest(b, s) + 1 END), 0) AS BIGINT) AS changed_lines, first(k ORDER BY ts, k) AS first_commit,
            first(k ORDER BY ts DESC, k DESC) AS last_commit, min(ts) AS t0 FROM fn LEFT JOIN h ON h.path = fn.path AND b <= e AND z >= s WHERE e IS NOT NULL GROUP BY 1, 2, 3),
        c AS (SELECT *, CAST(DATE '1998-09-01' - t0 AS INTEGER) AS age_days, least(changed_lines / greatest(e - s + 1, 1)::DOUBLE / 10, 1.0) AS churn FROM g)
        SELECT id AS function_id, commits, authors, changed_lines, coalesce(first_commit, -1) AS first_commit, coalesce(last_commit, -1) AS last_commit, coalesce(age_days, -1) AS age_days, round(churn, 8) AS churn_score,
            CASE WHEN age_days IS NULL THEN CASE WHEN churn > 0 THEN 'new_hot' ELSE 'unknown' END WHEN age_days <= 30 AND (churn >= 0.5 OR commits >= 5) THEN 'new_hot'
                WHEN NOT age_days <= 30 AND NOT (churn >= 0.5 OR commits >= 5) AND commits <= 2 THEN 'stable' WHEN churn >= 0.2 THEN 'churning'
                WHEN age_days > 365 AND (churn >= 0.5 OR commits >= 5) THEN 'legacy_hot' ELSE 'stable' END AS stability FROM c""",
    "tag_rules": """WITH f AS (SELECT p_partkey, lower(replace(p_type, ' ', '/')) || '/' || (p_partkey % 10) || '.py' AS path FROM part)
        SELECT p_partkey, concat_ws(',', CASE WHEN path GLOB '*/[02468].py' AND NOT path GLOB '*steel*' THEN 'even' END, CASE WHEN path = 'promo/steel/2.py' OR path GLOB 'economy*/1.py' THEN 'named' END,
            CASE WHEN path GLOB 'promo*' THEN 'promo' END) AS tags FROM f""",
    "changed_files": """WITH s AS (SELECT 'u' || user_id AS p, event_id AS m, event_type AS h FROM events), b AS (SELECT p, first(h ORDER BY m DESC, h DESC) AS h FROM s WHERE m % 2 = 0 GROUP BY 1),
        a AS (SELECT p, first(h ORDER BY m DESC, h DESC) AS h FROM s GROUP BY 1)
        SELECT coalesce(a.p, b.p) AS rel_path, CASE WHEN b.p IS NULL THEN 'added' WHEN a.p IS NULL THEN 'deleted' ELSE 'modified' END AS change FROM a FULL JOIN b ON a.p = b.p WHERE a.h IS DISTINCT FROM b.h""",
}
