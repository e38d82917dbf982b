"""Calls inside functions and what they tell: side effects, uses of outside libraries, behaviour of tests.

One parse of a file gives its facts as rows; all rules are column expressions over them, and all sums are Spark's."""

from __future__ import annotations

import ast

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.functions import scores
from corvid.functions.ids import module_name
from corvid.sources.python_ast import _FUNCTION, _walk, parse_rows

FACTS = "path string, qualname string, first_line int, kind string, name string, base string, library string, plain boolean, text string, line int, end_line int"

# Calls by their effect; those of a module count by their last name wherever they are met.
APIS = {
    "io": {
        "builtins": ["open", "print"],
        "pathlib": ["Path.open", "Path.write_text", "Path.write_bytes"],
        "logging": ["debug", "info", "warning", "error", "exception", "critical", "log"],
        "requests": ["get", "post", "put", "delete", "patch", "head", "options"],
        "httpx": ["get", "post", "put", "delete", "patch", "head", "options"],
    },
    "db": {"sqlite3": ["connect"], "psycopg": ["connect"], "psycopg2": ["connect"], "asyncpg": ["connect", "create_pool"], "sqlalchemy": ["create_engine", "Session"]},
    "time": {"time": ["sleep", "time"], "asyncio": ["sleep"], "datetime": ["datetime.now", "datetime.utcnow", "date.today"]},
    "random": {"random": ["random", "randint", "choice", "randrange", "shuffle"], "secrets": ["token_hex", "token_urlsafe"], "uuid": ["uuid4", "uuid1"]},
    "threads": {"threading": ["Thread", "Timer"], "multiprocessing": ["Process", "Pool"], "asyncio": ["create_task", "ensure_future", "gather"], "concurrent.futures": ["ThreadPoolExecutor", "ProcessPoolExecutor"]},
}
EFFECTS = {"io": "uses_io", "db": "touches_db", "time": "uses_time", "random": "uses_randomness", "threads": "spawns_threads", "global": "modifies_globals", "nonlocal": "modifies_closure"}

# Libraries and last names of calls by what tests do with them; words of names and markers by tag.
TEST_IO = {
    "network": (("requests", "httpx", "urllib3", "aiohttp", "socket", "boto3", "paramiko"), ("get", "post", "put", "delete", "request", "send")),
    "db": (("sqlalchemy", "psycopg2", "asyncpg", "pymysql", "pymongo", "redis"), ("execute", "session", "commit", "query")),
    "filesystem": (("pathlib", "os", "shutil"), ("open", "unlink", "remove", "rmtree", "rename")),
    "subprocess": (("subprocess",), ("run", "popen", "call", "check_call")),
}
CONCURRENT = ("asyncio", "anyio", "trio", "threading", "concurrent", "multiprocessing")
NAME_TAGS = {"happy_path": ("happy", "ok", "success"), "error_paths": ("error", "fail", "invalid", "exception"), "edge_cases": ("edge", "boundary", "corner"), "concurrency": ("concurrent", "parallel", "thread", "async", "race")}
MARKER_TAGS = {"known_bug": ("xfail",), "integration_scenario": ("integration", "e2e"), "io_heavy": ("slow",), "network_interaction": ("network", "api", "http"), "db_interaction": ("db", "database")}
IO_TAGS = {"network": "network_interaction", "db": "db_interaction", "filesystem": "filesystem_interaction", "subprocess": "process_interaction"}

SEVERITY = {"critical": 4.0, "high": 3.0, "medium": 2.0, "low": 1.0, "info": 0.5}


def _spoken(node: ast.AST) -> tuple[str | None, bool]:
    """The dotted name of what is called, calls in between left out (`a.b().c` is a.b.c), and whether it is a plain chain from a name."""
    parts, plain = [], True
    while True:
        if isinstance(node, ast.Attribute):
            parts.append(node.attr)
            node = node.value
        elif isinstance(node, ast.Call):
            node, plain = node.func, False
        else:
            break
    if isinstance(node, ast.Name):
        parts.append(node.id)
    else:
        plain = False
    return ".".join(reversed(parts)) or None, plain


def _libraries(tree: ast.AST) -> dict[str, str]:
    """The package that a name was imported from; what comes from this tree's own packages by relative imports has none."""
    found = {}
    for n in ast.walk(tree):
        if isinstance(n, ast.Import):
            found |= {a.asname or a.name: a.name.split(".")[0] for a in n.names}
        elif isinstance(n, ast.ImportFrom):
            found |= {a.asname or a.name: "" if n.level else (n.module or "").split(".")[0] for a in n.names}
    return found


def _fact_rows(path: str, tree: ast.AST, text: str) -> list[tuple]:
    names, out = _libraries(tree), []
    for node, name, *_ in _walk(tree):
        if not isinstance(node, _FUNCTION):
            continue

        def add(n, kind, said=None, base=None, library=None, plain=None, source=None, line=None):
            out.append((path, name, node.lineno, kind, said, base, library, plain, source, line or n.lineno, n.end_lineno))  # noqa: B023

        add(node, "function")
        for n in ast.walk(node):
            if isinstance(n, ast.Call):
                said, plain = _spoken(n.func)
                if said:
                    base = said.split(".")[0] if isinstance(n.func, (ast.Name, ast.Attribute)) else None
                    add(n, "call", said, base, names.get(base, base), plain, ast.unparse(n))
            elif isinstance(n, (ast.Global, ast.Nonlocal)):
                for v in n.names:
                    add(n, type(n).__name__.lower(), v)
            elif isinstance(n, ast.Assert):
                bound = isinstance(n.test, ast.Compare) and any(isinstance(o, (ast.Lt, ast.LtE, ast.Gt, ast.GtE)) for o in n.test.ops)
                add(n, "assert", "boundary" if bound else None)
            elif isinstance(n, ast.Raise):
                add(n, "raise")
            elif isinstance(n, (ast.With, ast.AsyncWith)):
                if any(isinstance(i.context_expr, ast.Attribute) and _spoken(i.context_expr) == ("pytest.raises", True) for i in n.items):
                    add(n, "expects")
            elif isinstance(n, _FUNCTION) and any(a.arg not in ("self", "cls") for a in n.args.args):
                add(n, "parameters")
    return out


def facts(files: DataFrame) -> DataFrame:
    """What every function of files(path, text) holds, inner functions and decorators included: a row of kind `function` for itself and one
    for each call, global and nonlocal name, assert (name `boundary` if it compares by order), raise, and inner or own definition with
    parameters. Files that are no Python, and null texts, have none."""
    return parse_rows(files, _fact_rows, FACTS)


def _last(name: str = "name") -> Column:
    return F.substring_index(name, ".", -1)


def _is_api(modules: dict[str, list[str]]) -> Column:
    """A call of a listed last name, or a listed dotted name below its module."""
    simple = sorted({f for names in modules.values() for f in names if "." not in f})
    found = _last().isin(*simple) if simple else F.lit(False)
    for module, names in modules.items():
        if dotted := [f for f in names if "." in f]:
            found = found | (F.startswith("name", F.lit(f"{module}.")) & F.col("name").isin(*dotted))
    return found


def effects(rows: DataFrame, apis: dict[str, dict[str, list[str]]] = APIS) -> DataFrame:
    """path, qualname, effect, target, line of facts: calls by `apis`, and the names that functions bind elsewhere."""
    of_call = F.array(*[F.when(_is_api(modules), F.lit(effect)) for effect, modules in apis.items()])
    kinds = F.when(F.col("kind") == "call", F.filter(of_call, lambda e: e.isNotNull())).when(F.col("kind").isin("global", "nonlocal"), F.array("kind"))
    return rows.where("kind in ('call', 'global', 'nonlocal')").select("path", "qualname", F.explode(kinds).alias("effect"), F.col("name").alias("target"), "line")


def function_effects(rows: DataFrame, apis: dict[str, dict[str, list[str]]] = APIS) -> DataFrame:
    """path, qualname, first_line, a flag for each effect, is_pure (none is set) and the calls behind them: a row for each function."""
    flag = lambda test: F.coalesce(F.max(test & F.col("name").isNotNull()), F.lit(False))
    by_call = {EFFECTS[k]: (F.col("kind") == "call") & _is_api(m) for k, m in apis.items()}
    tests = by_call | {EFFECTS[k]: F.col("kind") == k for k in ("global", "nonlocal")}
    any_call = F.lit(False)
    for test in by_call.values():
        any_call = any_call | test
    out = rows.groupBy("path", "qualname", "first_line").agg(*[flag(t).alias(c) for c, t in tests.items()], F.count_if(any_call).alias("effect_calls"))
    impure = F.lit(False)
    for c in tests:
        impure = impure | F.col(c)
    return out.withColumn("is_pure", ~impure)


def external_calls(rows: DataFrame, patterns: dict[str, dict], samples: int = 5) -> DataFrame:
    """path, module, qualname, first_line, library, service, callsites, modes (sorted), evidence (the first calls by line): calls of each function
    into the libraries of `patterns`, {library: {service, category, severity, criticality, patterns: [{method | method_prefix | match,
    modes}]}}. The first pattern that fits a call gives its modes: its last name is the method, its text starts with the prefix or
    holds the match; without one it is `unknown`."""
    modes = F.lit(None).cast("array<string>")
    service = F.col("library")
    for library, spec in patterns.items():
        chosen = F.array(F.lit("unknown"))
        for p in reversed(spec.get("patterns", [])):
            tests = [(_last() == p["method"])] if p.get("method") else []
            tests += [F.startswith("text", F.lit(p["method_prefix"]))] if p.get("method_prefix") else []
            tests += [F.contains("text", F.lit(p["match"]))] if p.get("match") else []
            for test in tests:
                chosen = F.when(test, F.array(*[F.lit(m) for m in p["modes"]])).otherwise(chosen)
        modes = F.when(F.col("library") == library, chosen).otherwise(modes)
        service = F.when(F.col("library") == library, F.lit(spec.get("service") or library)).otherwise(service)
    met = rows.where((F.col("kind") == "call") & F.col("library").isin(*patterns)).withColumn("modes", modes)
    one = F.struct("line", "end_line", F.col("text").alias("target"), "modes")
    out = met.groupBy("path", "qualname", "first_line", "library").agg(F.count("*").alias("callsites"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("modes")))).alias("modes"), F.slice(F.sort_array(F.collect_list(one)), 1, samples).alias("evidence"))
    return out.select("path", module_name(F.col("path")).alias("module"), "qualname", "first_line", "library", service.alias("service"), "callsites", "modes", "evidence")


def external_dependencies(calls: DataFrame, patterns: dict[str, dict], config: DataFrame | None = None) -> DataFrame:
    """library, service, category, severity, risk_score, functions, callsites, modules, modes, config_keys, risk_level over
    external_calls; config(module, key) are the keys that modules read. A library's rows are added up before they are shuffled, and its keys are
    joined by distinct modules. Without a severity the level follows from modes and calls, and there is no score."""
    spec = lambda field, kind: F.coalesce(*[F.when(F.col("library") == k, F.lit(v.get(field)).cast(kind)) for k, v in patterns.items()])
    out = calls.groupBy("library", "service").agg(
        F.count("*").alias("functions"), F.sum("callsites").alias("callsites"), F.array_sort(F.collect_set("module")).alias("modules"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("modes")))).alias("modes")
    )
    if config is None:
        out = out.withColumn("config_keys", F.lit(None).cast("array<string>"))
    else:
        keys = calls.select("library", "module").distinct().join(config.select("module", "key").distinct(), "module").groupBy("library").agg(F.array_sort(F.collect_set("key")).alias("config_keys"))
        out = out.join(keys, "library", "left")
    writes, reads = F.arrays_overlap("modes", F.array(F.lit("admin"), F.lit("write"))), F.array_contains("modes", "read")
    mode = F.when(writes, "write").when(reads, "read")
    base = F.coalesce(*[F.when(F.lower("severity") == k, F.lit(v)) for k, v in SEVERITY.items()])
    wide = out.withColumns({"category": spec("category", "string"), "severity": spec("severity", "string"), "criticality": F.coalesce(spec("criticality", "double"), F.lit(1.0))})
    return wide.select(
        "library", "service", "category", "severity", (base * F.col("criticality")).alias("risk_score"), "functions", "callsites", "modules", "modes", "config_keys",
        scores.dependency_risk(F.col("severity"), mode, F.col("callsites")).alias("risk_level"),
    )


def test_facts(rows: DataFrame) -> DataFrame:
    """path, qualname, first_line, asserts, raises and flags of what functions named test... do, in the lines from `def` on (not in decorators)."""
    own = rows.where(F.startswith(_last("qualname"), F.lit("test")) & (F.col("line") >= F.col("first_line")))
    call, method = (F.col("kind") == "call") & F.col("plain"), F.lower(_last())
    flag = lambda test: F.coalesce(F.max(test), F.lit(False))
    io = [flag(call & (F.coalesce(F.col("library").isin(*libs), F.lit(False)) | method.isin(*names))).alias(f"uses_{k}") for k, (libs, names) in TEST_IO.items()]
    return own.groupBy("path", "qualname", "first_line").agg(
        F.count_if(F.col("kind") == "assert").alias("asserts"), F.count_if(F.col("kind") == "raise").alias("raises"),
        flag((F.col("kind") == "expects") | (call & (F.col("name") == "pytest.raises"))).alias("expects_error"), flag(call & F.coalesce(F.col("library").isin(*CONCURRENT), F.lit(False))).alias("uses_concurrency"),
        flag((F.col("kind") == "assert") & (F.coalesce("name", F.lit("")) == "boundary")).alias("bounds"), flag(F.col("kind") == "parameters").alias("uses_fixtures"), *io,
    )


def behaviour_tags(name: Column, markers: Column) -> Column:
    """Sorted tags of a test from its name, its markers and the flags of test_facts, each once; null names and markers say nothing."""
    low, marked = F.lower(name), F.transform(F.coalesce(markers, F.array().cast("array<string>")), lambda m: F.lower(m))
    tests: dict[str, list[Column]] = {}
    for tag, words in NAME_TAGS.items():
        tests.setdefault(tag, []).extend(F.contains(low, F.lit(w)) for w in words)
    for tag, words in MARKER_TAGS.items():
        tests.setdefault(tag, []).append(F.arrays_overlap(marked, F.array(*[F.lit(w) for w in words])))
    for kind, tag in IO_TAGS.items():
        tests.setdefault(tag, []).append(F.col(f"uses_{kind}"))
    tests["io_heavy"] += [F.col(f"uses_{kind}") for kind in IO_TAGS]
    for tag, column in (("error_paths", "expects_error"), ("concurrency", "uses_concurrency"), ("edge_cases", "bounds")):
        tests[tag].append(F.col(column))
    found = []
    for tag in sorted(tests):
        told = F.lit(False)
        for t in tests[tag]:
            told = told | F.coalesce(t, F.lit(False))
        found.append(F.when(told, F.lit(tag)))
    return F.filter(F.array(*found), lambda t: t.isNotNull())
