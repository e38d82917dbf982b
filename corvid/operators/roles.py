"""Roles of functions and modules, from signals: names, paths, decorators, effects, contracts, calls and tags. Every signal is a column
expression, so that roles are a projection without a shuffle; modules add up the roles of their functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of signals, words of paths and starts of names.
THRESHOLD = 0.35
PATHS = {"api_handler": ("api", "route", "handler"), "cli_command": ("cli", "commands", "scripts"), "repository": ("repository", "repositories", "database", "db/"), "service": ("service", "use_case", "usecase"), "config_loader": ("config", "settings", "env")}
VERBS = ("get", "post", "put", "delete", "patch")
DATA_NAMES = ("get_", "fetch_", "save_", "update_", "delete_")
CHECK_NAMES = ("validate", "check", "ensure", "assert")
TAGS = {"api": ("api_handler", "tag:api"), "cli": ("cli_command", "tag:cli"), "command": ("cli_command", "tag:cli"), "repository": ("repository", "tag:repository"), "db": ("repository", "tag:repository"), "service": ("service", "tag:service")}
MODULE_TAGS = ("api", "cli", "repository", "db", "service")
MANY_CALLS = 5
SMALL_LOC = 20

_SIGNAL = "struct<role: string, weight: double, reason: string, framework: string>"


def _signal(role: str, weight: float, reason: str | Column, framework: str | None = None) -> Column:
    said = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(F.lit(role).alias("role"), F.lit(weight).alias("weight"), said.alias("reason"), F.lit(framework).cast("string").alias("framework"))


def _any(values, test) -> Column:
    found = F.lit(False)
    for v in values:
        found = found | test(v)
    return found


def _of_decorator(d: Column) -> Column:
    """What one decorator says: a web handler (a router or a verb before a plain route), and a command of either library."""
    low = F.lower(d)
    has = lambda text: F.contains(low, F.lit(text))
    reason = F.concat(F.lit("decorator:"), d)
    web = F.when(has("router.") | F.startswith(low, F.lit("get(")) | F.startswith(low, F.lit("post(")), _signal("api_handler", 0.7, reason, "fastapi"))
    return web.when(has(".route") | F.startswith(low, F.lit("route")), _signal("api_handler", 0.6, reason, "flask"))


def _of_tag(tag: Column) -> Column:
    out = F.lit(None).cast(_SIGNAL)
    for t, (role, reason) in TAGS.items():
        out = F.when(F.lower(tag) == t, _signal(role, 0.3, reason)).otherwise(out)
    return out


def _signals(c: dict[str, Column]) -> Column:
    """All signals of a function in their fixed order, which decides between roles of one score."""
    path, name, module = F.lower(c["path"]), F.substring_index(c["qualname"], ".", -1), F.lower(c["module"])
    starts = lambda words: _any(words, lambda w: F.startswith(name, F.lit(w)))
    on_path = lambda role: _any(PATHS[role], lambda w: F.contains(path, F.lit(w)))
    decorated = lambda test: F.exists(c["decorators"], test)
    when = lambda test, *signal: F.array(F.when(test, _signal(*signal)))
    command = lambda lib: F.transform(c["decorators"], lambda d: F.when(F.contains(F.lower(d), F.lit(f"{lib}.")), _signal("cli_command", 0.8, F.concat(F.lit("decorator:"), d), lib)))
    fixture = decorated(lambda d: F.startswith(d, F.lit("pytest.fixture")) | F.endswith(d, F.lit("fixture")))
    value_error = F.exists(c["raises"], lambda e: F.endswith(F.lower(e), F.lit("valueerror")))
    parts = [
        when(F.startswith(path, F.lit("tests")) | F.contains(path, F.lit("/tests/")), "test", 0.6, "path:tests"), when(starts(("test_",)), "test", 0.5, "name:test_prefix"),
        when(fixture, "test_helper", 0.9, "decorator:pytest.fixture"),
        F.transform(c["decorators"], _of_decorator), when(on_path("api_handler"), "api_handler", 0.4, "path:api"), when(F.substring_index(name, "_", 1).isin(*VERBS), "api_handler", 0.2, "name:http_verb"),
        command("click"), command("typer"), when(on_path("cli_command"), "cli_command", 0.4, "path:cli"), when(name.isin("main", "cli"), "cli_command", 0.3, "name:entrypoint"),
        when(c["touches_db"], "repository", 0.8, "effects:touches_db"), when(on_path("repository"), "repository", 0.5, "path:repository"), when(starts(DATA_NAMES), "repository", 0.2, "name:data_access"),
        when(on_path("service"), "service", 0.5, "path:service"), when(c["fan_in"] > MANY_CALLS, "service", 0.2, "graph:fan_in"), when(c["fan_out"] > MANY_CALLS, "service", 0.2, "graph:fan_out"),
        when(starts(CHECK_NAMES), "validator", 0.6, "name:validator"), when(value_error, "validator", 0.3, "raises:valueerror"), when(c["has_preconditions"], "validator", 0.2, "guards:preconditions"),
        when(on_path("config_loader"), "config_loader", 0.6, "path:config"), when(c["uses_io"], "config_loader", 0.2, "effects:uses_io"),
        when(~c["touches_db"] & ~c["uses_io"] & (c["loc"] <= SMALL_LOC), "helper", 0.4, "small_pure_helper"),
        F.transform(c["tags"], _of_tag), when(F.startswith(module, F.lit("tests")) & ~fixture, "test", 0.4, "module:tests"),
    ]
    return F.filter(F.concat(*parts), lambda s: s.isNotNull())


def function_roles(functions: DataFrame) -> DataFrame:
    """All columns of functions(path, qualname, module, decorators, tags, loc, touches_db, uses_io, raises, has_preconditions, fan_in,
    fan_out) with role, role_framework, role_confidence and role_signals. Nulls are read as empty texts and lists, no effect and no
    call. The role has the largest sum of weights, the first met among equals; below the threshold it is `other`, with nothing."""
    empty = {"path": "", "qualname": "", "module": "", "loc": 0, "fan_in": 0, "fan_out": 0, "touches_db": False, "uses_io": False, "has_preconditions": False}
    c = {k: F.coalesce(F.col(k), F.lit(v)) for k, v in empty.items()}
    c |= {k: F.filter(F.coalesce(F.col(k), F.array().cast("array<string>")), lambda x: x.isNotNull()) for k in ("decorators", "tags", "raises")}
    total = lambda role: F.aggregate(F.filter("__signals", lambda s: s["role"] == role), F.lit(0.0), lambda a, s: a + s["weight"])
    scored = F.transform(F.array_distinct(F.transform("__signals", lambda s: s["role"])), lambda r: F.struct(r.alias("role"), total(r).alias("score")))
    first = F.struct(F.lit("other").alias("role"), F.lit(0.0).alias("score"))
    best = F.aggregate("__scored", first, lambda a, x: F.when(x["score"] > a["score"], x).otherwise(a))
    rows = functions.withColumn("__signals", _signals(c)).withColumn("__scored", scored).withColumn("__best", best)
    told = F.col("__best.score") >= THRESHOLD
    own = F.filter("__signals", lambda s: s["role"] == F.col("__best.role"))
    named = F.get(F.filter(F.transform(own, lambda s: s["framework"]), lambda f: f.isNotNull()), F.lit(0))
    return rows.select(
        *[F.col(f"`{x}`") for x in functions.columns], F.when(told, F.col("__best.role")).otherwise("other").alias("role"), F.when(told, named).alias("role_framework"),
        F.when(told, F.least(F.col("__best.score"), F.lit(1.0))).otherwise(0.0).alias("role_confidence"),
        F.when(told, F.transform(own, lambda s: s["reason"])).otherwise(F.array().cast("array<string>")).alias("role_signals"),
    )


def module_roles(modules: DataFrame, roles: DataFrame) -> DataFrame:
    """module, role, confidence, scores (role to sum), tag_signals of modules(module, tags): the confidences of a module's functions
    (module, role, role_confidence) and 0.3 for what its tags say are added up by role. Sums are exact decimals; among equals the first
    by name wins. Every module has a row: `other`, with 0, where no sum reaches the threshold."""
    exact = "decimal(28,9)"
    tags = F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda t: F.lower(t))
    known = modules.groupBy("module").agg(F.array_distinct(F.flatten(F.collect_set(tags))).alias("tags"))
    signal = F.when(F.col("tag") == "db", "repository").otherwise(F.col("tag"))
    from_tags = known.select("module", F.explode(F.array_intersect("tags", F.array(*[F.lit(t) for t in MODULE_TAGS]))).alias("tag")).select("module", signal.alias("t")).distinct()
    renamed = F.when(F.col("t") == "api", "api_handler").when(F.col("t") == "cli", "cli_command").otherwise(F.col("t"))
    tagged = from_tags.select("module", renamed.alias("role"), F.lit(0.3).cast(exact).alias("x"), F.concat(F.lit("tag:"), "t").alias("signal"))
    summed = roles.where("role <> 'other' and module is not null").groupBy("module", "role").agg(F.sum(F.col("role_confidence").cast(exact)).cast(exact).alias("x")).withColumn("signal", F.lit(None).cast("string"))
    scores = tagged.unionByName(summed).groupBy("module", "role").agg(F.sum("x").cast("double").alias("x"), F.max("signal").alias("signal"))
    best = scores.groupBy("module").agg(
        F.min(F.struct((-F.col("x")).alias("x"), "role")).alias("b"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("role", "x")))).alias("scores"), F.sort_array(F.collect_list("signal")).alias("tag_signals")
    )
    told = -F.col("b.x") >= THRESHOLD
    return known.select("module").join(best, "module", "left").select(
        "module", F.when(told, F.col("b.role")).otherwise("other").alias("role"), F.when(told, F.least(-F.col("b.x"), F.lit(1.0))).otherwise(0.0).alias("confidence"),
        F.coalesce("scores", F.create_map().cast("map<string,double>")).alias("scores"), F.coalesce("tag_signals", F.array().cast("array<string>")).alias("tag_signals"),
    )
