import datetime as dt

from pyspark.sql import functions as F

from corvid.operators import domain as D


def snap(spark, rows, columns):
    return spark.createDataFrame(rows, columns).withColumn("repo", F.lit("r")).withColumn("commit", F.lit("c"))


def tables(spark):
    functions = snap(spark, [("a.py", "f", "a.f", 1, 4, 3), ("a.py", "g", "a.g", 6, None, 12), ("b.py", "h", "b.h", 1, 2, 7)], "path string, function_id string, qualname string, start_line int, end_line int, complexity int")
    lines = snap(spark, [("a.py", i, True, i < 3) for i in (1, 2, 3, 4)] + [("b.py", 1, True, False), ("b.py", 2, False, False)], "path string, line int, is_executable boolean, is_covered boolean")
    contexts = snap(spark, [("a.py", 1, "t1"), ("a.py", 2, "t1"), ("a.py", 2, "t2"), ("b.py", 9, "t2")], "path string, line int, test_id string")
    catalog = snap(spark, [("t1", "passed", 10.0, ["flaky"], True), ("t2", "failed", 3000.0, [], None)], "test_id string, status string, duration_ms double, markers array<string>, uses_network boolean")
    return functions, lines, contexts, catalog


def test_coverage_tests_and_risk(spark):
    functions, lines, contexts, catalog = tables(spark)
    coverage = D.function_coverage(functions, lines)
    got = {r["function_id"]: (r["executable_lines"], r["covered_lines"], r["coverage_ratio"], r["untested_reason"]) for r in coverage.collect()}
    assert got == {"f": (4, 2, 0.5, ""), "g": (0, 0, None, "no_executable_code"), "h": (1, 0, 0.0, "no_tests")}
    edges = D.test_edges(functions, contexts)
    assert {(r["test_id"], r["function_id"]): (r["covered_lines"], r["coverage_ratio"]) for r in edges.collect()} == {("t1", "f"): (2, 0.5), ("t2", "f"): (1, 0.25)}
    tests = D.function_tests(edges, catalog)
    assert [(r["tests"], r["failing"], r["passing"], r["dominant_status"], r["test_status"]) for r in tests.collect()] == [(2, 1, 1, "failed", "some_failing")]
    diagnostics = spark.createDataFrame([("b.py", 2)], "path string, errors int")
    spots = D.hotspots(spark.createDataFrame([("a.py", 5), ("b.py", 1)], "path string, complexity int"), spark.createDataFrame([("a.py", 3, 2, 10, 1)], "rel_path string, commits int, authors int, added int, deleted int"))
    risk = D.risk_factors(functions, coverage, tests, diagnostics, spots)
    score = {r["function_id"]: (round(r["risk_score"], 6), r["risk_level"], r["test_status"]) for r in risk.collect()}
    assert score == {"f": (0.3, "low", "some_failing"), "g": (0.9, "high", "untested"), "h": (0.9, "high", "untested")}
    files = {r["path"]: (r["functions"], r["high_risk_functions"], r["untested_functions"]) for r in D.file_profile(risk).collect()}
    assert files == {"a.py": (2, 1, 1), "b.py": (1, 1, 1)}
    modules = snap(spark, [("a.py", "a", ["api"]), ("b.py", "b", []), ("c.py", "c", None)], "path string, module string, tags array<string>")
    imports = spark.createDataFrame([("a", "b"), ("a", "b")], "src string, dst string")
    got = {r["module"]: (r["functions"], r["fan_out"], r["calls_out"], r["fan_in"]) for r in D.module_profile(D.file_profile(risk), modules, imports).collect()}
    assert got == {"a": (2, 1, 2, 0), "b": (1, 0, 0, 1), "c": (0, 0, 0, 0)}
    calls = spark.createDataFrame([("f", "g"), ("f", None)], "caller_id string, callee_id string")
    rows = D.call_graph_enriched(calls, functions, risk).collect()
    assert sorted(str(r["callee_qualname"]) for r in rows) == ["None", "a.g"] and {r["caller_risk_level"] for r in rows} == {"low"}
    wide = catalog.withColumns({c: F.lit(None).cast("boolean") for c in ("uses_db", "uses_subprocess", "uses_fs")})
    profile = {r["test_id"]: (round(r["flakiness_score"], 6), round(r["importance_score"], 6)) for r in D.test_profile(wide, edges, risk).collect()}
    assert profile == {"t1": (0.75, 1.0), "t2": (0.1, round((1 + 0.5 + 1) / 3, 6))}


def test_subsystems(spark):
    e = lambda rows: spark.createDataFrame(rows, "src string, dst string")
    config = spark.createDataFrame([("k", "a"), ("k", "b"), ("k", "c"), ("only", "a")], "key string, module string")
    got = {(r["src"], r["dst"]): round(r["weight"], 6) for r in D.affinity_edges(e([("b", "a"), ("a", "a")]), e([("a", "c")]), config).collect()}
    assert got == {("a", "b"): 1.15, ("a", "c"): 0.65, ("b", "c"): 0.15}
    labels = snap(spark, [("a", "x"), ("b", "x"), ("c", "y")], "module string, label string")
    modules = snap(spark, [("a", ["api"]), ("b", ["db"]), ("c", [])], "module string, tags array<string>")
    rows = {r["name"]: r["modules"] for r in D.subsystems(labels, modules).collect()}
    assert rows == {"api": ["a", "b"], "y": ["c"]}
    members = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c")], "subsystem_id string, module string")
    communities = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "module string, community int")
    r = D.subsystem_agreement(members, communities).first()
    assert (r["modules"], r["disagreements"], round(r["agreement"], 6)) == (3, 1, round(2 / 3, 6))


def test_history_tags_policy(spark):
    functions = spark.createDataFrame([("a.py", "f", 1, 10), ("a.py", "g", 20, 21)], "path string, function_id string, start_line int, end_line int")
    day = lambda d: dt.datetime(2024, 1, d)
    hunks = spark.createDataFrame([("a.py", "c1", "x", day(1), 8, 12), ("a.py", "c2", "y", day(20), 1, 2), ("b.py", "c2", "y", day(20), 1, 2)], "path string, commit_id string, author string, ts timestamp, start int, end int")
    got = {r["function_id"]: (r["commits"], r["changed_lines"], r["first_commit"], r["last_commit"], r["stability"]) for r in D.function_history(functions, hunks, F.lit("2024-01-25").cast("timestamp")).collect()}
    assert got == {"f": (2, 5, "c1", "c2", "stable"), "g": (0, 0, None, None, "unknown")}
    files = spark.createDataFrame([("src/api/x.py",), ("src/api/test_x.py",), ("setup.py",)], "path string")
    rules = [{"tag": "api", "includes": ["src/api/*"], "excludes": ["*test_*"]}, {"tag": "build", "matches": ["setup.py"]}, {"tag": "all", "includes": ["*.py"]}]
    assert {r["path"]: r["tags"] for r in D.tags_for_paths(files, rules).collect()} == {"src/api/x.py": ["all", "api"], "src/api/test_x.py": ["all"], "setup.py": ["all", "build"]}
    assert D.incremental_or_full(10, 10, 0) == "incremental" and D.incremental_or_full(100, 60, 10) == "full" and D.incremental_or_full(100, 10, 10) == "incremental"
