import json

from corvid.sources import python_ast, reports, tables
from corvid.streaming import changes

CODE = '''
import os
from .util import helper as h
from pkg import util

class A:
    def m(self, x: int) -> int:
        """Doc."""
        if x and x > 1 or x == 0:
            return h(x)
        return self.n(x)

    def n(self, y):
        for i in range(y):
            raise ValueError(i)

async def free(a, *b):
    # note
    yield helper(a)
'''


def files(spark):
    return spark.createDataFrame([("pkg/mod.py", CODE), ("pkg/util.py", "def helper(x):\n    return x\n"), ("pkg/bad.py", "def ("), ("pkg/null.py", None)], "path string, text string")


def test_functions(spark):
    got = {r["qualname"]: r for r in python_ast.functions(files(spark)).collect()}
    assert set(got) == {"A.m", "A.n", "free", "helper"}
    m = got["A.m"]
    assert (m["kind"], m["n_params"], m["complexity"], m["typedness"], m["has_docstring"], m["n_returns"]) == ("method", 1, 4, "typed", True, 2)
    assert got["A.n"]["typedness"] == "untyped" and got["A.n"]["n_raises"] == 1 and got["free"]["is_async"] and got["free"]["logical_loc"] == 2


def test_imports_and_calls(spark):
    f = files(spark)
    edges = {(r["src"], r["dst"]) for r in python_ast.import_edges(f).collect()}
    assert edges == {("pkg.mod", "pkg.util")}
    got = {(r["caller"], r["callee"]): (r["callee_qualname"], r["resolved_via"]) for r in python_ast.resolve_calls(python_ast.calls(f), python_ast.functions(f), python_ast.imports(f)).collect()}
    assert got["A.m", "h"] == ("helper", "import_alias") and got["A.m", "self.n"] == ("A.n", "local_attr")
    assert got["free", "helper"] == ("helper", "global_name") and got["A.n", "range"] == (None, "unresolved")


def test_reports(spark, tmp_path):
    (tmp_path / "cov.json").write_text(json.dumps({"files": {"a.py": {"executed_lines": [1, 2], "missing_lines": [3]}, "b.py": {"executed_lines": [], "missing_lines": []}}}))
    assert sorted(map(tuple, reports.coverage_lines(spark, str(tmp_path / "cov.json")).collect())) == [("a.py", 1, True), ("a.py", 2, True), ("a.py", 3, False)]
    (tmp_path / "t.json").write_text(json.dumps({"tests": [{"nodeid": "t.py::f[1]", "outcome": "passed", "duration": 0.5, "keywords": {"flaky": True, "x": False}}]}))
    r = reports.test_catalog(spark, str(tmp_path / "t.json")).first()
    assert (r["duration_ms"], r["markers"], r["is_parametrized"], r["is_flaky"]) == (500.0, ["flaky"], True, True)
    lines = ["commit:c1:ann", "3\t1\ta.py", "-\t-\tb.bin", "commit:c2:bob", "2\t0\ta.py"]
    log = reports.numstat_rows(spark.createDataFrame([("l", i, x) for i, x in enumerate(lines)], "log string, n int, value string"))
    assert {tuple(r) for r in reports.churn(log).collect()} == {("a.py", 2, 2, 5, 1), ("b.bin", 1, 1, 0, 0)}


def test_config(spark):
    f = spark.createDataFrame([("a.json", '{"x": {"y": [1, true]}}'), ("b.toml", "[t]\nk = 'v'"), ("c.ini", "[s]\nk = 1"), (".env", "A=1\n#B=2"), ("bad.json", "{"), ("n.json", None)], "path string, text string")
    got = {(r["path"], r["key"]): r["value"] for r in reports.config_values(f).collect()}
    assert got == {("a.json", "x.y.0"): "1", ("a.json", "x.y.1"): "true", ("b.toml", "t.k"): "v", ("c.ini", "s.k"): "1", (".env", "A"): "1"}


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("r", "1", 1), ("r", "2", 2)], "repo string, commit string, v int")
    tables.write_snapshot(df, str(tmp_path / "t"))
    tables.write_snapshot(spark.createDataFrame([("r", "2", 5)], df.schema), str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert {(str(r["commit"]), r["v"]) for r in back.collect()} == {("1", 1), ("2", 5)}
    up = tables.upsert(df, spark.createDataFrame([("r", "2", 9), ("r", "3", 3)], df.schema), ["repo", "commit"])
    assert {r["v"] for r in up.collect()} == {1, 9, 3}
    first = tables.export(df, str(tmp_path / "e"), "d")
    assert not first["skipped"] and tables.export(df, str(tmp_path / "e"), "d", previous=first)["skipped"]
    assert tables.contract_issues(df, {"v": "string", "w": "int"}, ["repo"]) == ["missing column w", "column v is int, not string", "primary key repo repeats"]


def test_changes_and_stream(spark, tmp_path):
    schema = "rel_path string, mtime_ns long, content_hash string"
    old = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], schema)
    new = spark.createDataFrame([("a", 3, "q"), ("c", 1, "z")], schema)
    assert {tuple(r) for r in changes.changed_files(old, new).collect()} == {("a", "modified"), ("b", "deleted"), ("c", "added")}
    for i, df in enumerate((old, new)):
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        changes.follow_states(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        got = {r["rel_path"]: r["content_hash"] for r in spark.read.parquet(str(tmp_path / f"out/version={i}")).collect()}
    assert got == {"a": "q", "b": "z", "c": "z"}
