"""Queries of profiles, architecture views and reads: parts are functions, lines of orders their calls and coverage, suppliers tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import metric_tables as T
from corvid.operators import profiles as P
from corvid.operators import relational as R
from corvid.operators import roles as roles_of
from corvid.plans import code_tables, source_text
from corvid.plans import roles as role_plans
from corvid.session import settle


def _t(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _calls(spark, d) -> DataFrame:
    return _t(spark, d, "lineitem").select(F.col("l_partkey").alias("caller_id"), F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("callee_id"))


def _shared(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Coverage and tests of functions, and the risks that are made of both: each worked out once."""
    coverage, tests = settle(code_tables._coverage(spark, d)), settle(code_tables._tests(spark, d))
    return coverage, tests, code_tables._risk(spark, d, coverage, tests)


def _profile(spark, d) -> DataFrame:
    f, (coverage, tests, risk) = code_tables.functions(spark, d), _shared(spark, d)
    fans = R.fan_counts(_calls(spark, d).where("callee_id is not null"), "caller_id", "callee_id").withColumnRenamed("node", "function_id")
    facts = role_plans.functions(spark, d)
    named = roles_of.function_roles(facts).select("function_id", "role", "role_framework", "role_confidence")
    history = code_tables.function_history(spark, d).select("function_id", "commits", "authors", "churn_score", "stability")
    effects = facts.where("function_id % 3 <> 1").select("function_id", "touches_db", "uses_io", (~F.col("touches_db") & ~F.col("uses_io")).alias("is_pure"))
    errors = risk.select(*P.FUNCTION, F.col("errors").alias("static_errors"))
    snap = code_tables._snap
    return settle(P.function_profile(
        f.withColumn("hotspot", F.lit(-1)), coverage=coverage, risk=risk.select(*P.FUNCTION, "risk_score", "risk_level", "hotspot"),
        tests=tests, diagnostics=errors, calls=snap(fans), roles=snap(named), effects=snap(effects), history=snap(history),
    ))


def function_profile(spark, d) -> DataFrame:
    """Profiles of all functions."""
    same = ("function_id", "path", "executable_lines", "covered_lines", "tested", "tests", "failing", "test_status", "static_errors", "risk_level", "fan_in", "fan_out", "calls_in", "calls_out", "call_is_leaf", "call_is_entrypoint", "role", "is_pure", "uses_io", "uses_time", "stability", "commits", "slow", "return_nullability")
    rounded = ("risk_score", "risk_from_coverage", "risk_from_complexity", "risk_from_errors", "risk_from_hotspot", "churn_score")
    return _profile(spark, d).select(*same, *[F.round(c, 8).alias(c) for c in rounded])


def function_architecture(spark, d) -> DataFrame:
    """Profiles beside measures of control flow and of call components."""
    flow = source_text.control_flow(spark, d).withColumnRenamed("part", "function_id").select("function_id", "blocks", "longest_path", "mean_distance")
    calls = settle(_calls(spark, d).where("callee_id is not null").select(F.col("caller_id").alias("src"), F.col("callee_id").alias("dst")).distinct())
    parts = T.component_metadata(calls, layers=False).withColumnRenamed("node", "function_id").select("function_id", "component_size", "scc_size", "in_cycle")
    out = P.star(_profile(spark, d), {"cfg": code_tables._snap(flow), "calls": code_tables._snap(parts)}, P.FUNCTION)
    some = lambda c: F.coalesce(c, F.lit(-1)).alias(c)
    return out.select("function_id", F.round("risk_score", 8).alias("risk_score"), "role", "fan_out", "cfg_blocks", "cfg_longest_path", "cfg_mean_distance", some("calls_component_size"), F.coalesce("calls_in_cycle", F.lit(False)).alias("in_cycle"))


def _modules(spark, d) -> tuple[DataFrame, DataFrame]:
    """Architecture of the modules by the last digit of files, and the files."""
    f = code_tables.functions(spark, d)
    files = f.select("repo", "commit", "path", F.concat(F.lit("m"), F.regexp_extract("path", r"(\d)\.py", 1)).alias("module")).distinct()
    modules = files.select("repo", "commit", "module").distinct()
    imports = _t(spark, d, "orders").where("o_orderkey % 10 < o_custkey % 10").select(F.concat(F.lit("m"), (F.col("o_orderkey") % 10).cast("string")).alias("src"), F.concat(F.lit("m"), (F.col("o_custkey") % 10).cast("string")).alias("dst"))
    layers = T.component_metadata(settle(imports.distinct())).select(F.col("node").alias("module"), "component_size", "scc_size", "layer")
    summary = code_tables.module_summary(spark, d).select("module", "functions", "max_risk", "fan_in", "fan_out")
    members = modules.where("module <> 'm7'").select("repo", "commit", "module", F.concat(F.lit("s"), (F.substring("module", 2, 1).cast("int") % 3).cast("string")).alias("subsystem_id"))
    subsystems = members.groupBy("repo", "commit", "subsystem_id").agg(F.count("*").alias("modules"), F.max("module").alias("name")).where("subsystem_id <> 's2'")
    snap = code_tables._snap
    return P.module_architecture(modules, {"import": snap(layers), "": snap(summary)}, members, subsystems), files


def module_architecture(spark, d) -> DataFrame:
    """Modules with measures of imports, risks and subsystems."""
    rows, _ = _modules(spark, d)
    none = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    return rows.select("module", none("import_component_size", -1), none("import_scc_size", -1), none("import_layer", -1), "functions", "max_risk", "fan_in", "fan_out", none("subsystem_id", "-"), none("subsystem_modules", -1), none("subsystem_name", "-"))


def file_hints(spark, d) -> DataFrame:
    """What is known of each file's module, and how many functions it has."""
    rows, files = _modules(spark, d)
    held = P.with_functions(files, _profile(spark, d))
    hints = P.file_hints(held.withColumnRenamed("functions", "held"), rows.withColumn("path", F.lit("none")))
    first = F.get("held", F.lit(0))
    return hints.select("path", "module", "fan_in", "max_risk", F.coalesce("subsystem_name", F.lit("-")).alias("subsystem_name"), F.size("held").cast("long").alias("n_functions"), first["function_id"].alias("first_function"), F.size(F.filter("held", lambda x: x["tested"])).cast("long").alias("n_tested"))


def high_risk_functions(spark, d) -> DataFrame:
    """Functions of high risk that tests reach."""
    coverage, _, risk = _shared(spark, d)
    profile = P.function_profile(code_tables.functions(spark, d), coverage=coverage, risk=risk.select(*P.FUNCTION, "risk_score"))
    return P.high_risk(profile, 0.7, True).select("function_id", F.round("risk_score", 8).alias("risk_score"))


def call_neighbours(spark, d) -> DataFrame:
    """Callers and callees of all functions."""
    return P.call_neighbours(_calls(spark, d), code_tables.functions(spark, d))


def tests_of_functions(spark, d) -> DataFrame:
    """Tests that reach functions, with their states; the tests of every seventh supplier aren't known."""
    known = code_tables.catalog(spark, d).where("cast(substr(test_id, 2) as int) % 7 <> 0")
    out = P.tests_of_functions(code_tables._edges(spark, d), known, code_tables.functions(spark, d))
    return out.select("function_id", "test_id", F.round("coverage_ratio", 8).alias("coverage_ratio"), F.coalesce("status", F.lit("-")).alias("status"))


def function_lookups(spark, d) -> DataFrame:
    """A request for each line of an order: by the part's id, by an urn, or by path and name."""
    key = F.col("l_partkey")
    f = code_tables.functions(spark, d).select("function_id", "path", F.concat(F.lit("u"), F.col("function_id").cast("string")).alias("urn"), F.concat(F.lit("q"), (F.col("function_id") % 500).cast("string")).alias("qualname"))
    n = F.col("l_linenumber") % 3
    asked = _t(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("request"), F.when(n == 0, key).alias("function_id"), F.when(n == 1, F.concat(F.lit("u"), (key * 2).cast("string"))).alias("urn"),
        code_tables._path(key).alias("path"), F.concat(F.lit("q"), (key % 500).cast("string")).alias("qualname"),
    )
    return P.find_functions(f, asked).groupBy("request", "found_by").agg(F.count("*").alias("rows"), F.min("function_id").alias("first"))


QUERIES = {f.__name__: f for f in (function_profile, function_architecture, module_architecture, file_hints, high_risk_functions, call_neighbours, tests_of_functions, function_lookups)}

_FANS = """ca AS (SELECT l_partkey AS a, l_suppkey AS b FROM lineitem WHERE l_suppkey % 5 <> 0), ou AS (SELECT a AS id, count(DISTINCT b) AS fan_out, count(*) AS calls_out FROM ca GROUP BY 1),
    ic AS (SELECT b AS id, count(DISTINCT a) AS fan_in, count(*) AS calls_in FROM ca GROUP BY 1)"""
_PROFILE = f"""WITH {code_tables._RISK}, {role_plans._ROLES}, {_FANS}, fh AS ({code_tables.ORACLES["function_history"]}),
    pr AS (SELECT fn.id AS function_id, fn.path, cover.n AS executable_lines, cover.c AS covered_lines, cover.c > 0 AS tested, coalesce(tests, 0) AS tests, coalesce(failing, 0) AS failing, risk.test_status, CAST(coalesce(errors, 0) AS BIGINT) AS static_errors,
        level AS risk_level, coalesce(fan_in, 0) AS fan_in, coalesce(fan_out, 0) AS fan_out, coalesce(calls_in, 0) AS calls_in, coalesce(calls_out, 0) AS calls_out, (ou.id IS NOT NULL OR ic.id IS NOT NULL) AND coalesce(fan_out, 0) = 0 AS call_is_leaf,
        (ou.id IS NOT NULL OR ic.id IS NOT NULL) AND coalesce(fan_in, 0) = 0 AS call_is_entrypoint, fr.role, fn.id % 3 <> 1 AND fr.k IS NOT NULL AND fn.cx % 9 <> 4 AND fn.cx % 5 <> 3 AS is_pure, fn.id % 3 <> 1 AND fn.cx % 5 = 3 AS uses_io, false AS uses_time,
        coalesce(stability, 'unknown') AS stability, coalesce(commits_f, 0) AS commits, 0::BIGINT AS slow, 'unknown' AS return_nullability, round(risk.x, 8) AS risk_score, round(coalesce(0.4 * (1 - r), 0.4), 8)::DOUBLE AS risk_from_coverage,
        CASE bucket WHEN 'high' THEN 0.4 WHEN 'medium' THEN 0.2 ELSE 0 END::DOUBLE AS risk_from_complexity, CASE WHEN errors > 0 THEN 0.2 ELSE 0 END::DOUBLE AS risk_from_errors, CASE WHEN score > 0 THEN 0.1 ELSE 0 END::DOUBLE AS risk_from_hotspot,
        coalesce(churn_score, 0)::DOUBLE AS churn_score, s AS start_line
        FROM fn JOIN cover USING (id) JOIN risk ON risk.id = fn.id LEFT JOIN ft ON ft.id = fn.id LEFT JOIN er ON er.path = fn.path LEFT JOIN hs ON hs.path = fn.path LEFT JOIN ou ON ou.id = fn.id LEFT JOIN ic ON ic.id = fn.id LEFT JOIN fr ON fr.k = fn.id
        LEFT JOIN (SELECT function_id AS id, stability, commits AS commits_f, churn_score FROM fh) hh ON hh.id = fn.id)"""
_MODULES = f"""WITH RECURSIVE ms AS ({code_tables.ORACLES["module_summary"]}), io AS (SELECT DISTINCT o_orderkey % 10 AS a, o_custkey % 10 AS b FROM orders WHERE o_orderkey % 10 < o_custkey % 10), nd AS (SELECT a AS v FROM io UNION SELECT b FROM io),
    lw AS (SELECT v, v AS low FROM nd UNION SELECT e.b, lw.low FROM lw JOIN (SELECT a, b FROM io UNION SELECT b, a FROM io) e ON e.a = lw.v), wk AS (SELECT v, min(low) AS c FROM lw GROUP BY 1), sz AS (SELECT v, count(*) OVER (PARTITION BY c) AS n FROM wk),
    ly AS (SELECT v, 0 AS l FROM nd UNION SELECT io.b, ly.l + 1 FROM ly JOIN io ON io.a = ly.v), dp AS (SELECT v, max(l) AS l FROM ly GROUP BY 1),
    mb AS (SELECT module, 's' || (CAST(substr(module, 2, 1) AS INTEGER) % 3) AS g FROM ms WHERE module <> 'm7'), ss AS (SELECT g, count(*) AS n, max(module) AS name FROM mb WHERE g <> 's2' GROUP BY 1),
    ma AS (SELECT ms.module, coalesce(sz.n, -1) AS import_component_size, CASE WHEN sz.n IS NULL THEN -1 ELSE 1 END::BIGINT AS import_scc_size, coalesce(l, -1) AS import_layer, functions, max_risk, fan_in, fan_out, coalesce(mb.g, '-') AS subsystem_id,
        coalesce(ss.n, -1) AS subsystem_modules, coalesce(name, '-') AS subsystem_name FROM ms LEFT JOIN sz ON 'm' || sz.v = ms.module LEFT JOIN dp ON 'm' || dp.v = ms.module LEFT JOIN mb ON mb.module = ms.module LEFT JOIN ss ON ss.g = mb.g)"""

ORACLES = {
    "function_profile": f"{_PROFILE} SELECT * EXCLUDE (start_line) FROM pr",
    "function_architecture": f"""WITH RECURSIVE {_PROFILE.removeprefix("WITH ")}, cf AS ({source_text.ORACLES["control_flow"]}), e AS (SELECT DISTINCT a, b FROM ca), nd AS (SELECT a AS v FROM e UNION SELECT b FROM e),
        lw AS (SELECT v, v AS low FROM nd UNION SELECT u.b, lw.low FROM lw JOIN (SELECT a, b FROM e UNION SELECT b, a FROM e) u ON u.a = lw.v WHERE lw.low < u.b), wk AS (SELECT v, min(low) AS c FROM lw GROUP BY 1), sz AS (SELECT v, count(*) OVER (PARTITION BY c) AS n FROM wk),
        rc AS (SELECT a AS x, b AS y FROM e UNION SELECT rc.x, e.b FROM rc JOIN e ON e.a = rc.y), cy AS (SELECT DISTINCT p.x AS v FROM rc p JOIN rc q ON q.x = p.y AND q.y = p.x WHERE p.x <> p.y)
        SELECT function_id, risk_score, role, fan_out, CAST(blocks AS BIGINT) AS cfg_blocks, CAST(longest_path AS BIGINT) AS cfg_longest_path, mean_distance AS cfg_mean_distance, coalesce(sz.n, -1) AS calls_component_size, cy.v IS NOT NULL AS in_cycle
        FROM pr LEFT JOIN cf ON cf.part = function_id LEFT JOIN sz ON sz.v = function_id LEFT JOIN cy ON cy.v = function_id""",
    "module_architecture": f"{_MODULES} SELECT * FROM ma",
    "file_hints": f"""{_MODULES}, px AS ({_PROFILE} SELECT * FROM pr) SELECT path, module, any_value(ma.fan_in) AS fan_in, any_value(max_risk) AS max_risk, any_value(subsystem_name) AS subsystem_name, count(*) AS n_functions,
        first(function_id ORDER BY start_line, function_id) AS first_function, count(*) FILTER (WHERE tested) AS n_tested FROM px JOIN ma ON module = 'm' || regexp_extract(path, '(\\d)\\.py', 1) GROUP BY path, module""",
    "high_risk_functions": f"WITH {code_tables._RISK} SELECT id AS function_id, round(x, 8) AS risk_score FROM risk JOIN cover USING (id) WHERE round(x, 9) >= 0.7 AND c > 0",
    "call_neighbours": """WITH c AS (SELECT l_partkey AS a, l_suppkey AS b, count(*) AS calls FROM lineitem WHERE l_suppkey % 5 <> 0 GROUP BY 1, 2)
        SELECT a AS function_id, 'out' AS direction, b AS other, calls FROM c JOIN part ON p_partkey = a UNION ALL SELECT b, 'in', a, calls FROM c JOIN part ON p_partkey = b""",
    "tests_of_functions": f"""WITH {code_tables._FN}, {code_tables._LN}, {code_tables._TE}, {code_tables._FT} SELECT id AS function_id, test AS test_id, round(k / size::DOUBLE, 8) AS coverage_ratio,
        coalesce(CASE WHEN CAST(substr(test, 2) AS INTEGER) % 7 <> 0 THEN st END, '-') AS status FROM te LEFT JOIN ct USING (test)""",
    "function_lookups": """WITH f AS (SELECT p_partkey AS id, 'f' || (p_partkey % 97) || '.py' AS path, 'q' || (p_partkey % 500) AS q FROM part), a AS (SELECT l_orderkey * 10 + l_linenumber AS request, l_partkey AS k, l_linenumber % 3 AS n FROM lineitem)
        SELECT request, CASE n WHEN 0 THEN 'function_id' WHEN 1 THEN 'urn' ELSE 'path' END AS found_by, count(*) AS rows, min(id) AS first
        FROM a JOIN f ON (n = 0 AND id = k) OR (n = 1 AND id = k * 2) OR (n = 2 AND path = 'f' || (k % 97) || '.py' AND q = 'q' || (k % 500)) GROUP BY ALL""",
}
