"""Roles of functions and modules: parts are functions whose files, names, decorators and effects follow from their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import roles as R

_FOLDERS = ("src/api", "tests/unit", "src/config", "lib/db", "src/service", "lib/cli", "lib/math", "src/env_db")
_NAMES = ("get_item", "test_run", "validate_row", "main", "save_all", "Row.check", "step", "A.post")
_DECORATORS = ("", "router.get('/x')", "click.command()", "pytest.fixture", "app.route('/y')", "typer.run", "cache")
_TAGS = ("API", "db", "service", "", "cli", "other")


def _pick(values: tuple[str, ...], key) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def functions(spark, d) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    held = lambda c: F.when(c != "", F.array(c))
    calls = spark.read.parquet(f"{d}/lineitem.parquet").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.countDistinct("l_suppkey").alias("fan_in"), F.countDistinct("l_linenumber").alias("fan_out"))
    folder = _pick(_FOLDERS, F.floor(key / 8))
    rows = spark.read.parquet(f"{d}/part.parquet").join(calls, "p_partkey", "left")
    return rows.select(
        key.alias("function_id"), F.concat(folder, F.lit("/m"), (key % 30).cast("string"), F.lit(".py")).alias("path"), _pick(_NAMES, size).alias("qualname"),
        F.concat(F.replace(folder, F.lit("/"), F.lit(".")), F.lit(".m"), (key % 30).cast("string")).alias("module"), held(_pick(_DECORATORS, key)).alias("decorators"), held(_pick(_TAGS, F.floor(key / 3))).alias("tags"),
        (size * 2).alias("loc"), (size % 9 == 4).alias("touches_db"), (size % 5 == 3).alias("uses_io"), F.when(size % 4 == 1, F.array(F.lit("errors.ValueError"))).alias("raises"), (size % 3 == 0).alias("has_preconditions"), "fan_in", "fan_out",
    )


def function_roles(spark, d) -> DataFrame:
    """Roles of all functions with their signals."""
    return R.function_roles(functions(spark, d)).select("function_id", "role", F.coalesce("role_framework", F.lit("-")).alias("framework"), F.round("role_confidence", 8).alias("confidence"), F.array_join("role_signals", ",").alias("signals"))


def module_roles(spark, d) -> DataFrame:
    """Roles of all modules, from those of their functions and from their tags."""
    rows = functions(spark, d)
    return R.module_roles(rows.select("module", "tags"), R.function_roles(rows)).select("module", "role", F.round("confidence", 8).alias("confidence"), F.array_join("tag_signals", ",").alias("tag_signals"))


QUERIES = {f.__name__: f for f in (function_roles, module_roles)}


def _case(values: tuple[str, ...], key: str) -> str:
    return f"[{', '.join(repr(v) if chr(39) not in v else chr(39) + v.replace(chr(39), chr(39) * 2) + chr(39) for v in values)}][({key}) % {len(values)} + 1]"


#: (role, weight, reason, framework, condition) over path p, name n, decorator c, tag t, the module m
_RULES = [
    ("test", 0.6, "'path:tests'", "", "p LIKE 'tests%' OR p LIKE '%/tests/%'"), ("test", 0.5, "'name:test_prefix'", "", "n LIKE 'test\\_%' ESCAPE '\\'"), ("test_helper", 0.9, "'decorator:pytest.fixture'", "", "c LIKE 'pytest.fixture%' OR c LIKE '%fixture'"),
    ("api_handler", 0.7, "'decorator:' || c", "fastapi", "c LIKE '%router.%' OR c LIKE 'get(%' OR c LIKE 'post(%'"), ("api_handler", 0.6, "'decorator:' || c", "flask", "c LIKE '%.route%' AND NOT c LIKE '%router.%'"),
    ("api_handler", 0.4, "'path:api'", "", "regexp_matches(p, 'api|route|handler')"), ("api_handler", 0.2, "'name:http_verb'", "", "split_part(n, '_', 1) IN ('get', 'post', 'put', 'delete', 'patch')"),
    ("cli_command", 0.8, "'decorator:' || c", "click", "c LIKE '%click.%'"), ("cli_command", 0.8, "'decorator:' || c", "typer", "c LIKE '%typer.%'"), ("cli_command", 0.4, "'path:cli'", "", "regexp_matches(p, 'cli|commands|scripts')"),
    ("cli_command", 0.3, "'name:entrypoint'", "", "n IN ('main', 'cli')"), ("repository", 0.8, "'effects:touches_db'", "", "s % 9 = 4"), ("repository", 0.5, "'path:repository'", "", "regexp_matches(p, 'repository|repositories|database|db/')"),
    ("repository", 0.2, "'name:data_access'", "", "regexp_matches(n, '^(get|fetch|save|update|delete)_')"), ("service", 0.5, "'path:service'", "", "regexp_matches(p, 'service|use_case|usecase')"), ("service", 0.2, "'graph:fan_in'", "", "fi > 5"),
    ("service", 0.2, "'graph:fan_out'", "", "fo > 5"), ("validator", 0.6, "'name:validator'", "", "regexp_matches(n, '^(validate|check|ensure|assert)')"), ("validator", 0.3, "'raises:valueerror'", "", "s % 4 = 1"),
    ("validator", 0.2, "'guards:preconditions'", "", "s % 3 = 0"), ("config_loader", 0.6, "'path:config'", "", "regexp_matches(p, 'config|settings|env')"), ("config_loader", 0.2, "'effects:uses_io'", "", "s % 5 = 3"),
    ("helper", 0.4, "'small_pure_helper'", "", "s % 9 <> 4 AND s % 5 <> 3 AND s * 2 <= 20"), ("api_handler", 0.3, "'tag:api'", "", "t = 'API'"), ("cli_command", 0.3, "'tag:cli'", "", "t = 'cli'"), ("repository", 0.3, "'tag:repository'", "", "t = 'db'"),
    ("service", 0.3, "'tag:service'", "", "t = 'service'"), ("test", 0.4, "'module:tests'", "", "p LIKE 'tests%' AND NOT (c LIKE 'pytest.fixture%' OR c LIKE '%fixture')"),
]
_ROLES = f"""f AS (SELECT p_partkey AS k, {_case(_FOLDERS, "p_partkey // 8")} || '/m' || (p_partkey % 30) || '.py' AS p, replace({_case(_FOLDERS, "p_partkey // 8")}, '/', '.') || '.m' || (p_partkey % 30) AS m,
        regexp_extract({_case(_NAMES, "p_size")}, '[^.]+$') AS n, {_case(_DECORATORS, "p_partkey")} AS c, {_case(_TAGS, "p_partkey // 3")} AS t, p_size AS s, coalesce(fi, 0) AS fi, coalesce(fo, 0) AS fo
        FROM part LEFT JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) AS fi, count(DISTINCT l_linenumber) AS fo FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
    g AS ({" UNION ALL ".join(f"SELECT k, {i} AS i, '{r}' AS role, {w}::DOUBLE AS w, {why} AS why, nullif('{fw}', '') AS fw FROM f WHERE {on}" for i, (r, w, why, fw, on) in enumerate(_RULES))}),
    h AS (SELECT k, role, sum(w ORDER BY i) AS x, min(i) AS i, string_agg(why, ',' ORDER BY i) AS whys, first(fw ORDER BY i) FILTER (WHERE fw IS NOT NULL) AS fw FROM g GROUP BY 1, 2),
    b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY x DESC, i) AS r FROM h) WHERE r = 1 AND x >= 0.35),
    fr AS (SELECT f.k, m, t, coalesce(role, 'other') AS role, fw, least(coalesce(x, 0), 1) AS x, coalesce(whys, '') AS whys FROM f LEFT JOIN b USING (k))"""

ORACLES = {
    "function_roles": f"WITH {_ROLES} SELECT k AS function_id, role, coalesce(fw, '-') AS framework, round(x, 8) AS confidence, whys AS signals FROM fr",
    "module_roles": f"""WITH {_ROLES}, a AS (SELECT m, role, x, NULL AS g FROM fr WHERE role <> 'other' UNION ALL SELECT DISTINCT m, CASE t WHEN 'API' THEN 'api_handler' WHEN 'cli' THEN 'cli_command' WHEN 'db' THEN 'repository' ELSE t END, 0.3,
            'tag:' || CASE t WHEN 'API' THEN 'api' WHEN 'db' THEN 'repository' ELSE t END FROM fr WHERE t IN ('API', 'cli', 'db', 'service')),
        s AS (SELECT m, role, round(sum(x), 8) AS x FROM a GROUP BY 1, 2), z AS (SELECT m, first(role ORDER BY x DESC, role) AS role, max(x) AS x FROM s GROUP BY 1), y AS (SELECT m, string_agg(g, ',' ORDER BY g) AS g FROM a GROUP BY 1)
        SELECT DISTINCT fr.m AS module, CASE WHEN z.x >= 0.35 THEN z.role ELSE 'other' END AS role, CASE WHEN z.x >= 0.35 THEN least(z.x, 1.0::DOUBLE) ELSE 0 END AS confidence, coalesce(g, '') AS tag_signals FROM fr LEFT JOIN z USING (m) LEFT JOIN y USING (m)""",
}
