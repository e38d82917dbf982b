import os

import pytest

from corvid.operators import profiles as P
from corvid.plans import code_tables, profiles


def _functions(spark):
    rows = [("r", "c", 1, "a.py", 1, 20, "u1", "f"), ("r", "c", 2, "a.py", 9, 3, "u2", "f"), ("r", "d", 1, "b.py", 1, 7, None, "g")]
    return spark.createDataFrame(rows, "repo string, commit string, function_id long, path string, start_line long, complexity int, urn string, qualname string")


def test_a_profile_without_tables_has_its_defaults(spark):
    rows = P.function_profile(_functions(spark)).collect()
    assert len(rows) == 3
    r = {(x["commit"], x["function_id"]): x for x in rows}["c", 1]
    assert (r["tests"], r["stability"], r["risk_score"], r["coverage_ratio"], r["tested"], r["call_is_leaf"]) == (0, "unknown", 0.0, None, False, False)
    assert (r["risk_from_coverage"], r["risk_from_complexity"], r["risk_from_errors"], r["risk_from_hotspot"]) == (0.4, 0.4, 0.0, 0.0)
    with pytest.raises(ValueError):
        P.function_profile(_functions(spark), cover=_functions(spark))


def test_parts_keep_snapshots_apart_and_names_of_their_own(spark):
    key = "repo string, commit string, function_id long"
    coverage = spark.createDataFrame([("r", "c", 1, 4, 1, 0.25, "x"), ("r", "d", 1, 4, None, None, "y"), (None, "c", 2, 9, 9, 1.0, "z")], f"{key}, executable_lines long, covered_lines long, coverage_ratio double, path string")
    calls = spark.createDataFrame([("r", "c", 1, 0, 2), ("r", "c", 2, 1, 0)], f"{key}, fan_in long, fan_out long")
    rows = P.function_profile(_functions(spark).selectExpr("*", "99 as tests"), coverage=coverage, calls=calls)
    got = {(x["commit"], x["function_id"]): x for x in rows.collect()}
    a, b, c = got["c", 1], got["c", 2], got["d", 1]
    assert a["path"] == "a.py" and a["tests"] == 0 and rows.columns.count("path") == 1  # tests is a name of the profile
    assert (a["tested"], a["risk_from_coverage"], a["call_is_leaf"], a["call_is_entrypoint"]) == (True, pytest.approx(0.3), False, True)
    assert (b["executable_lines"], b["call_is_leaf"], b["call_is_entrypoint"]) == (0, True, False)
    assert (c["executable_lines"], c["covered_lines"], c["call_is_leaf"]) == (4, 0, False)
    assert P.function_profile(_functions(spark).limit(0), coverage=coverage).count() == 0


def test_lookups(spark):
    wanted = spark.createDataFrame([(1, 2, "u1", None, None), (2, None, "u1", "a.py", "f"), (3, None, None, "a.py", "f"), (4, None, "none", None, None)], "request int, function_id long, urn string, path string, qualname string")
    got = sorted((r["request"], r["found_by"], r["function_id"]) for r in P.find_functions(_functions(spark), wanted).collect())
    assert got == [(1, "function_id", 2), (2, "urn", 1), (3, "path", 1), (3, "path", 2)]
    none = spark.createDataFrame([(1, None, None, "a.py", None), (2, None, None, None, "f")], wanted.schema)
    assert sorted((r["request"], r["found_by"], r["function_id"]) for r in P.find_functions(_functions(spark), none).collect()) == [(1, "invalid", None), (2, "invalid", None)]


def test_reads(spark):
    calls = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (2, 2), (1, None), (None, 2), (5, 6)], "caller_id long, callee_id long")
    wanted = spark.createDataFrame([(1,), (1,), (2,)], "function_id long")
    got = sorted(tuple(r) for r in P.call_neighbours(calls, wanted).collect())
    assert got == [(1, "in", 2, 1), (1, "out", 2, 2), (2, "in", 1, 2), (2, "in", 2, 1), (2, "out", 1, 1), (2, "out", 2, 1)]
    assert {r["direction"] for r in P.call_neighbours(calls, wanted, "in").collect()} == {"in"}
    with pytest.raises(ValueError):
        P.call_neighbours(calls, wanted, "up")
    profile = spark.createDataFrame([(1, 0.7, True), (2, 0.9, False), (3, 0.9, True), (4, 0.69, True), (5, None, True)], "function_id long, risk_score double, tested boolean")
    assert [r[0] for r in P.high_risk(profile, limit=2).collect()] == [2, 3] and sorted(r[0] for r in P.high_risk(profile, tested_only=True).collect()) == [1, 3]
    files = spark.createDataFrame([("r", "c", "a.py"), ("r", "c", "none.py")], "repo string, commit string, path string")
    held = {r["path"]: [x["function_id"] for x in r["functions"]] for r in P.with_functions(files, P.function_profile(_functions(spark))).collect()}
    assert held == {"a.py": [1, 2], "none.py": []}


def test_neighbours_send_no_table_to_every_task(spark):
    """The wanted functions have no bound, however small their files are."""
    calls = spark.createDataFrame([(1, 2), (1, 2), (3, 2)], "caller_id long, callee_id long")
    found = P.call_neighbours(calls, spark.range(4).withColumnRenamed("id", "function_id"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 4


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the test tables")
def test_shared_steps_of_profiles_run_once(spark, monkeypatch):
    """Edges of tests are made once for a profile, and functions of high risk need neither history nor roles."""
    made, real = [], code_tables._edges
    monkeypatch.setattr(code_tables, "_edges", lambda *a: made.append(1) or real(*a))
    profile = profiles._profile(spark, "/root/testdata/sf0.001")
    assert len(made) == 1
    want = {r["function_id"] for r in P.high_risk(profile, 0.7, True).collect()}
    monkeypatch.setattr(code_tables, "function_history", None)
    got = {r["function_id"] for r in profiles.high_risk_functions(spark, "/root/testdata/sf0.001").collect()}
    assert got == want and len(made) == 2
