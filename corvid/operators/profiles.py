"""Profiles and architecture views: wide rows for each function, module and file, and the reads over them.

All tables that a view joins have one row at most for each key, so that a view is a chain of left joins on one key: its rows are shuffled
once and each further table meets them in place, or is sent to all tasks where Spark finds it small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions import scores
from corvid.operators import relational as R

SNAPSHOT = ["repo", "commit"]
FUNCTION = [*SNAPSHOT, "function_id"]
#: What a profile takes from each table, with the value where the table or its row is missing.
PARTS = {
    "coverage": {"executable_lines": 0, "covered_lines": 0, "coverage_ratio": None, "untested_reason": None},
    "tests": {"tests": 0, "failing": 0, "slow": 0, "test_status": "untested", "dominant_status": None},
    "diagnostics": {"static_errors": 0},
    "risk": {"risk_score": 0.0, "risk_level": None, "hotspot": None},
    "history": {"first_commit": None, "last_commit": None, "age_days": None, "commits": 0, "authors": 0, "changed_lines": 0, "churn_score": 0.0, "stability": "unknown"},
    "calls": {"fan_in": 0, "fan_out": 0, "calls_in": 0, "calls_out": 0},
    "effects": {"is_pure": False, "uses_io": False, "touches_db": False, "uses_time": False, "uses_randomness": False, "modifies_globals": False, "modifies_closure": False, "spawns_threads": False, "purity_confidence": None},
    "contracts": {"return_nullability": "unknown", "has_preconditions": False, "has_postconditions": False, "has_raises": False, "contract_confidence": None},
    "roles": {"role": None, "role_framework": None, "role_confidence": None, "role_signals": None},
    "docs": {"doc_short": None, "doc_long": None},
}


def star(base: DataFrame, tables: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """base with the columns of each table as `<name>_<column>`, null where the table has no row of the key; null keys meet nothing."""
    named = [t.select(*key, *[F.col(f"`{c}`").alias(f"{name}_{c}" if name else c) for c in t.columns if c not in key]) for name, t in tables.items()]
    return reduce(lambda a, b: a.join(b, key, "left"), named, base)


def function_profile(functions: DataFrame, **tables: DataFrame) -> DataFrame:
    """All columns of functions(repo, commit, function_id, complexity, ...) with those of PARTS from the tables given by name, what they are
    made of, and four components of risk. A missing row leaves the values of PARTS, and so does a table that isn't given: its columns are
    there all the same. A column that a table lacks or has null in is filled alike. Names in PARTS that functions have too are the tables'."""
    if unknown := set(tables) - set(PARTS):
        raise ValueError(f"no such parts: {sorted(unknown)}")
    wanted = [c for columns in PARTS.values() for c in columns]
    kept = [c for c in functions.columns if c not in wanted]
    rows = functions.select(*[F.col(f"`{c}`") for c in kept])
    held = {name: t.select(*FUNCTION, *[c for c in PARTS[name] if c in t.columns], F.lit(True).alias("__there")) for name, t in tables.items()}
    rows = star(rows, {f"__{name}": t for name, t in held.items()}, FUNCTION)
    filled = []
    for name, columns in PARTS.items():
        for c, default in columns.items():
            found = F.col(f"__{name}_{c}") if name in held and c in held[name].columns else F.lit(None)
            kind = {int: "long", float: "double", bool: "boolean"}.get(type(default))
            value = found if default is None else F.coalesce(found, F.lit(default))
            filled.append((value.cast(kind) if kind else value).alias(c))
    there = F.col("__calls___there").isNotNull() if "calls" in held else F.lit(False)
    wide = rows.select(*[F.col(f"`{c}`") for c in kept], *filled, there.alias("__called"))
    bucket = scores.complexity_bucket(F.col("complexity"))
    return wide.withColumns({
        "complexity_bucket": bucket, "tested": F.col("covered_lines") > 0, "call_is_leaf": F.col("__called") & (F.col("fan_out") == 0), "call_is_entrypoint": F.col("__called") & (F.col("fan_in") == 0),
        "risk_from_coverage": F.coalesce(0.4 * (1 - F.col("coverage_ratio")), F.lit(0.4)), "risk_from_complexity": F.when(bucket == "high", 0.4).when(bucket == "medium", 0.2).otherwise(0.0),
        "risk_from_errors": F.when(F.col("static_errors") > 0, 0.2).otherwise(0.0), "risk_from_hotspot": F.when(F.col("hotspot") > 0, 0.1).otherwise(0.0),
    }).drop("__called")


def module_architecture(modules: DataFrame, metrics: dict[str, DataFrame], membership: DataFrame, subsystems: DataFrame) -> DataFrame:
    """modules(repo, commit, module, ...) with metric tables by module, prefixed by their names, and the subsystem_id of membership(repo,
    commit, module, subsystem_id) with the columns of subsystems(repo, commit, subsystem_id, ...) prefixed by `subsystem`. A module of no
    subsystem has nulls there; one of several has a row for each."""
    rows = star(modules, metrics, [*SNAPSHOT, "module"]).join(membership.select(*SNAPSHOT, "module", "subsystem_id"), [*SNAPSHOT, "module"], "left")
    return star(rows, {"subsystem": subsystems}, [*SNAPSHOT, "subsystem_id"])


def file_hints(files: DataFrame, architecture: DataFrame) -> DataFrame:
    """files(repo, commit, path, module) with what is known of their modules; a file whose module is not known has nulls."""
    return files.join(architecture.drop("path"), [*SNAPSHOT, "module"], "left")


def with_functions(files: DataFrame, profile: DataFrame) -> DataFrame:
    """files(repo, commit, path, ...) with `functions`: their functions in the order of lines, empty without any. One file's functions are
    one value, as one file's text is."""
    one = F.struct("start_line", "function_id", "risk_level", "risk_score", "tested")
    held = profile.groupBy(*SNAPSHOT, "path").agg(F.sort_array(F.collect_list(one)).alias("functions"))
    none = F.array().cast(held.schema["functions"].dataType)
    return files.join(held, [*SNAPSHOT, "path"], "left").withColumn("functions", F.coalesce("functions", none))


def find_functions(functions: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of functions(function_id, urn, path, qualname, ...) that wanted(request, function_id, urn, path, qualname) ask for, with
    `request` and `found_by`: by id if one is given, else by urn, else by path and name together. A request of several rows takes
    each; one that gives none of the three has a row of nulls found by `invalid`, one that meets nothing has no row."""
    by = F.when(F.col("function_id").isNotNull(), "function_id").when(F.col("urn").isNotNull(), "urn").when(F.col("path").isNotNull() & F.col("qualname").isNotNull(), "path")
    asked = wanted.withColumn("found_by", F.coalesce(by, F.lit("invalid")))
    keys = {"function_id": ["function_id"], "urn": ["urn"], "path": ["path", "qualname"]}
    met = [functions.join(asked.where(F.col("found_by") == k).select("request", "found_by", *cols), cols).select("request", "found_by", *functions.columns) for k, cols in keys.items()]
    return reduce(DataFrame.unionByName, met).unionByName(asked.where("found_by = 'invalid'").select("request", "found_by"), allowMissingColumns=True)


def high_risk(profile: DataFrame, least: float = 0.7, tested_only: bool = False, limit: int | None = None) -> DataFrame:
    """Functions of at least that risk, those that tests reach alone if wished; the first `limit` by risk, then id."""
    rows = profile.where(F.col("risk_score") >= least)
    rows = rows.where("tested") if tested_only else rows
    return rows if limit is None else R.top_k(rows, limit, F.col("risk_score").desc(), F.col("function_id"))


def call_neighbours(calls: DataFrame, wanted: DataFrame, direction: str = "both") -> DataFrame:
    """function_id, direction (`in` for callers, `out` for callees), other, calls for each of wanted(function_id): every other end once, with
    how often it calls or is called; unknown callees are left out. Calls are counted before they meet the wanted ones."""
    if direction not in ("in", "out", "both"):
        raise ValueError(f"direction is in, out or both, not {direction}")
    ways: dict[str, tuple[str, str]] = {"in": ("callee_id", "caller_id"), "out": ("caller_id", "callee_id")}
    counted = calls.where("caller_id is not null and callee_id is not null").groupBy("caller_id", "callee_id").agg(F.count("*").alias("calls"))
    asked = wanted.select("function_id").distinct().hint("merge")  # its files are small for its rows: no copy of it in every task
    one = lambda d: counted.select(F.col(ways[d][0]).alias("function_id"), F.lit(d).alias("direction"), F.col(ways[d][1]).alias("other"), "calls").join(asked, "function_id", "left_semi")
    return reduce(DataFrame.unionByName, [one(d) for d in ways if direction in (d, "both")])


def tests_of_functions(edges: DataFrame, tests: DataFrame, wanted: DataFrame) -> DataFrame:
    """function_id, test_id, coverage_ratio, status of the tests that reach each of wanted(function_id); a test that is not known has a null status."""
    asked = wanted.select("function_id").distinct()
    return edges.join(asked, "function_id", "left_semi").join(tests.select(*SNAPSHOT, "test_id", "status"), [*SNAPSHOT, "test_id"], "left").select(*SNAPSHOT, "function_id", "test_id", "coverage_ratio", "status")
