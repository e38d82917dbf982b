"""Symbol indexes, patch logs cut at any byte, tables brought up to date."""

import json
import random


from corvid.operators import incremental as I
from corvid.sources import patches, symbols


def _occ(symbol, roles=None, line=None):
    return {"symbol": symbol} | ({} if roles is None else {"symbol_roles": roles}) | ({} if line is None else {"range": [line, 0, 5]})


def test_symbols(spark):
    a = {"documents": [
        {"relative_path": "p\\a.py", "occurrences": [_occ("f", 1, 0), _occ("g", 9, 9), _occ("f", 8, 12), _occ("", 1, 1), {"symbol_roles": 1}]},
        {"relative_path": "p/b.py", "occurrences": [_occ("f", 8, 3), _occ("f", 2, 4), _occ("g", 4, 4), _occ("h", 8, 5), _occ("f", 1, 7)]},
        {"relative_path": "", "occurrences": [_occ("f", 8, 3)]}, {"relative_path": "p/none.py"},
    ]}
    b = [{"relative_path": "q/c.py", "occurrences": [_occ("g", 8, 30), _occ("f"), _occ("k", 1, 29), _occ("k", 8, 2)], "more": {"x": [1]}}]
    rows = symbols.occurrences(spark.createDataFrame([("1", json.dumps(a)), ("2", json.dumps(b)), ("3", "{no"), ("4", None), ("5", "[]")], "name string, text string")).cache()
    assert {(r["path"], r["symbol"], r["roles"], r["line"]) for r in rows.where("name = '2'").collect()} == {("q/c.py", "g", 8, 31), ("q/c.py", "f", 0, None), ("q/c.py", "k", 1, 30), ("q/c.py", "k", 8, 3)}
    assert rows.where("name = '1'").count() == 8
    assert {r["symbol"]: r["def_path"] for r in symbols.definition_paths(rows).collect()} == {"f": "p/a.py", "g": "p/a.py", "k": "q/c.py"}
    modules = spark.createDataFrame([("p/a.py", "p.a"), ("p/b.py", "p.a"), ("q/c.py", "q.c")], "path string, module string")
    uses = symbols.symbol_uses(rows, modules)
    assert {tuple(r) for r in uses.collect()} == {
        ("g", "p/a.py", "p/a.py", True, True), ("f", "p/a.py", "p/a.py", True, True), ("f", "p/a.py", "p/b.py", False, True), ("g", "p/a.py", "p/b.py", False, True),
        ("g", "p/a.py", "q/c.py", False, False), ("k", "q/c.py", "q/c.py", True, True),
    }
    assert {r["use_path"]: r["def_paths"] for r in symbols.use_definitions(uses).collect()}["q/c.py"] == ["p/a.py", "q/c.py"]
    assert [tuple(r) for r in symbols.module_edges(uses, modules).collect()] == [("p.a", "q.c", 1)]
    spans = spark.createDataFrame([("p/a.py", 1, 1, 20), ("p/a.py", 2, 10, 15), ("p/b.py", 3, 2, 700), ("q/c.py", 4, 30, None)], "path string, function_id long, first int, last int")
    assert {tuple(r) for r in symbols.function_edges(rows, spans.where("last is not null")).collect()} == {(2, 1, 1), (3, 1, 2), (3, 2, 1)}
    named = symbols.symbols_of_functions(rows, spans.select("path", spans["first"].alias("start_line")))
    assert {(r["path"], r["start_line"]): r["symbol"] for r in named.collect()} == {("p/a.py", 1): "f", ("p/a.py", 10): "g", ("p/b.py", 2): None, ("q/c.py", 30): "k"}


def _log(rng, commits):
    """A patch log, and its hunks by plain reading."""
    lines, want = [], []
    for c in range(commits):
        head = (f"c{c:04}", f"a{c % 3}@x", "2024-01-02T03:04:05+00:00") if c % 7 else (f"c{c:04}",)
        lines.append("@@@" + "\t".join(head))
        for f in range(rng.randint(0, 2)):
            path = f"dir/f {rng.randint(0, 4)}.py"
            lines += ["", f"diff --git a/{path} b/{path}", "index 1..2 100644"]
            gone = rng.random() < 0.2
            lines += [f"--- a/{path}", "+++ /dev/null"] if gone else ["--- /dev/null", f"+++ b/{path}"] if rng.random() < 0.2 else [f"--- a/{path}", f"+++ b/{path}"]
            for _ in range(rng.randint(0, 3)):
                o, on, n, nn = rng.randint(0, 90), rng.randint(0, 3), rng.randint(0, 90), rng.randint(0, 3)
                text = lambda at, k: str(at) if k == 1 else f"{at},{k}"
                lines.append(f"@@ -{text(o, on)} +{text(n, nn)} @@ def f(): ü")
                lines += [("--- a/old.py", "-@@@ old ü")[i % 2] for i in range(on)] + [("+++ b/new.py", "+@@ -1 +1 @@ ü")[i % 2] for i in range(nn)]
                want.append((head[0], head[1] if len(head) > 1 else None, path, o, on, n, nn))
            lines.append("Binary files differ")
    return "\n".join(lines) + "\n", want


def test_hunks_of_a_log_cut_at_any_byte(spark, tmp_path):
    text, want = _log(random.Random(1), 60)
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "one.log").write_text(text)
    other, more = _log(random.Random(2), 5)
    (tmp_path / "logs" / "two.log").write_text(other)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("61b", "997b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            rows = patches.hunks(spark, str(tmp_path / "logs"))
            cols = ("commit", "author", "path", "old_start", "old_len", "new_start", "new_len")
            assert sorted(map(str, (tuple(r[c] for c in cols) for r in rows.collect()))) == sorted(map(str, want + more))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    deltas = {(r["path"], r["commit"]): (r["lines_added"], r["lines_deleted"]) for r in patches.commit_deltas(rows.where("log like '%two.log'")).collect()}
    for path, commit in deltas:
        mine = [w for w in more if w[0] == commit and w[2] == path]
        assert deltas[path, commit] == (sum(w[6] for w in mine), sum(w[4] for w in mine))
    spans = patches.spans(rows.where("log like '%two.log'"))
    assert spans.where("change = 'added'").count() == sum(w[6] > 0 for w in more) and spans.where("end < start").count() == 0


def test_refresh_equals_a_full_rebuild(spark, tmp_path):
    rng = random.Random(4)
    target = "file://" + str(tmp_path / "t")
    schema = "path string, content_hash string, value long"
    uses = spark.createDataFrame([(f"f{k}", f"f{k // 2}") for k in range(1, 60)], "src string, dst string")
    files = {f"f{k}": k for k in range(60)}
    seen = {}

    def build(df):
        """A row for each file and each multiple; counts which files were asked for."""
        seen["paths"] = {r["path"] for r in df.select("path").collect()}
        return df.selectExpr("path", "explode(transform(sequence(1, 3), k -> k * value)) AS v")

    table = lambda d: spark.createDataFrame([(p, str(v), v) for p, v in d.items()], schema)
    assert I.read_current(spark, target) is None
    assert I.refresh(target, table({}), table(files), build, uses, 8)["mode"] == "full"
    for round_ in range(4):
        before = dict(files)
        for p in rng.sample(sorted(files), 3):
            files[p] = rng.randint(100, 999)
        if round_ == 1:
            del files["f59"], files["f31"]
            files["new"] = 7
        if round_ == 2:
            files = {p: v for p, v in files.items() if v % 5 == 0}
        said = I.refresh(target, table(before), table(files), build, uses, 8)
        got = sorted((r["path"], r["v"]) for r in I.read_current(spark, target).collect())
        assert got == sorted((p, k * v) for p, v in files.items() for k in (1, 2, 3))
        changed = {p for p in files if before.get(p) != files[p]} | (set(before) - set(files))
        up = {f"f{k}": f"f{k // 2}" for k in range(1, 60)}

        def climbs(p, changed=changed, up=up):
            while p is not None:
                if p in changed:
                    return True
                p = up.get(p)
            return False

        assert seen["paths"] == ({p for p in files if climbs(p)} if said["mode"] == "incremental" else set(files))
    quiet = I.refresh(target, table(files), table(files), build, uses, 8)
    assert quiet["buckets"] == 0 and I.read_current(spark, target).count() == 3 * len(files)
    broken = tmp_path / "t" / "manifest" / "n=99"
    broken.mkdir()  # a run that died before its manifest was whole
    assert I.read_current(spark, target).count() == 3 * len(files)
    assert {r["path"] for r in I.affected_paths(spark.createDataFrame([("f7",)], "path string"), uses, 1).collect()} == {"f7", "f14", "f15"}


def test_incremental_policy_is_kept():
    from corvid.operators.domain import incremental_or_full

    assert incremental_or_full(100, 5, 0) == "incremental" and incremental_or_full(100, 70, 0) == "full" and incremental_or_full(10, 10, 0) == "incremental"
