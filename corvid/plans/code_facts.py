"""Queries of facts of functions over files that Spark writes out of the parts: what their SQL says of a file was read off its text by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.session import settle
from corvid.sources import call_sites

#: Four kinds of files; % stands for the part's size.
_STORE = '''import redis
import boto3 as aws
from sqlalchemy import create_engine
def save(key, value=%):
    global LAST
    engine = create_engine("db")
    redis.set(key, value)
    s3 = aws.client('s3').put(key)
    LAST = redis.get(key)
    return redis.Redis().ping()
'''
_CLOCK = '''import time, random
from threading import Thread as T
from . import redis
def wait(n):
    seen = 0
    def tick():
        nonlocal seen
        seen += random.randint(1, %)
        redis.get("x")
    time.sleep(n)
    T(target=tick).start()
    return seen
'''
_TESTS = '''import pytest, threading
import requests as rq
@pytest.mark.parametrize("n", [%])
def test_invalid_edge(n):
    with pytest.raises(ValueError):
        rq.post("u", n)
    assert n <= %
    assert n
class TestRun:
    def test_ok(self):
        t = threading.Thread()
        if not t:
            raise ValueError(%)
        open("f").close()
'''
_PURE = '''def add(a, b):
    return a + b + %
def twice(a):
    return add(a, a)
'''
_KINDS = (_STORE, _CLOCK, _TESTS, _PURE)
PATTERNS = {
    "redis": {"service": "cache", "category": "cache", "patterns": [{"method": "get", "modes": ["read"]}, {"method": "set", "modes": ["write"]}]},
    "boto3": {"category": "cloud", "severity": "High", "criticality": 1.5, "patterns": [{"match": "client('s3')", "modes": ["read", "write"]}]},
    "requests": {"patterns": [{"method_prefix": "requests.", "modes": ["read"]}]},
}


def files(spark, d) -> DataFrame:
    """path, text: a file for each part, in one of seven folders, of a kind by its key."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = F.when(key % 4 == 0, _STORE).when(key % 4 == 1, _CLOCK).when(key % 4 == 2, _TESTS).otherwise(_PURE)
    path = F.concat(F.lit("d"), (key % 7).cast("string"), F.lit("/p"), key.cast("string"), F.lit(".py"))
    return spark.read.parquet(f"{d}/part.parquet").select(path.alias("path"), F.replace(text, F.lit("%"), size).alias("text"))


def _part(df: DataFrame) -> DataFrame:
    return df.withColumn("part", F.regexp_extract("path", r"p(\d+)\.py", 1).cast("long"))


def function_effects(spark, d) -> DataFrame:
    """Direct effects of all functions."""
    return _part(call_sites.function_effects(call_sites.facts(files(spark, d)))).drop("path", "first_line")


def effect_targets(spark, d) -> DataFrame:
    """Calls and names behind the effects of all files."""
    return call_sites.effects(call_sites.facts(files(spark, d))).groupBy("effect", "target").agg(F.count("*").alias("uses"), F.sum("line").alias("lines"))


def external_calls(spark, d) -> DataFrame:
    """Calls of all functions into outside libraries."""
    out = _part(call_sites.external_calls(call_sites.facts(files(spark, d)), PATTERNS))
    said = F.array_join(F.transform("evidence", lambda e: F.concat_ws(":", e["line"].cast("string"), e["target"])), ";")
    return out.select("part", "module", "qualname", "library", "service", "callsites", F.array_join("modes", ",").alias("modes"), said.alias("evidence"))


def external_dependencies(spark, d) -> DataFrame:
    """Outside libraries of all files, with the keys that the parts' brands stand for."""
    calls = settle(call_sites.external_calls(call_sites.facts(files(spark, d)), PATTERNS))
    part = spark.read.parquet(f"{d}/part.parquet")
    config = part.select(F.concat(F.lit("d"), (F.col("p_partkey") % 7).cast("string"), F.lit(".p"), F.col("p_partkey").cast("string")).alias("module"), F.col("p_brand").alias("key"))
    out = call_sites.external_dependencies(calls, PATTERNS, config)
    none = lambda c: F.coalesce(c, F.lit("-")).alias(c)
    return out.select("library", "service", none("category"), none("severity"), F.coalesce("risk_score", F.lit(-1.0)).alias("risk_score"), "functions", "callsites", F.size("modules").cast("long").alias("modules"), F.array_join("modes", ",").alias("modes"), F.array_join("config_keys", ",").alias("config_keys"), "risk_level")


def test_behaviour(spark, d) -> DataFrame:
    """Facts and tags of all tests; every third part's are marked."""
    rows = _part(call_sites.test_facts(call_sites.facts(files(spark, d))))
    markers = F.when(F.col("part") % 3 == 0, F.array(F.lit("XFail"), F.lit("db")))
    return rows.select("part", "qualname", "asserts", "raises", "expects_error", "uses_concurrency", "bounds", "uses_fixtures", F.array_join(call_sites.behaviour_tags(F.col("qualname"), markers), ",").alias("tags"))


QUERIES = {f.__name__: f for f in (function_effects, effect_targets, external_calls, external_dependencies, test_behaviour)}

_XC = """xc AS (SELECT p_partkey AS part, 'd' || (p_partkey % 7) || '.p' || p_partkey AS module, p_brand, v.* EXCLUDE (k) FROM part JOIN (VALUES
        (0, 'save', 'redis', 'cache', 4::BIGINT, 'read,unknown,write', '7:redis.set(key, value);9:redis.get(key);10:redis.Redis();10:redis.Redis().ping()'),
        (0, 'save', 'boto3', 'boto3', 2, 'read,write', '8:aws.client(''s3'');8:aws.client(''s3'').put(key)'),
        (2, 'test_invalid_edge', 'requests', 'requests', 1, 'unknown', '6:rq.post(''u'', n)'))
        v(k, qualname, library, service, callsites, modes, evidence) ON p_partkey % 4 = k)"""

ORACLES = {
    "function_effects": """SELECT p_partkey AS part, v.* EXCLUDE (k) FROM part JOIN (VALUES
        (0, 'save', true, true, false, false, false, true, false, 3::BIGINT, false), (1, 'wait', true, false, true, true, false, false, true, 3, false), (1, 'wait.tick', true, false, false, true, false, false, true, 2, false),
        (2, 'test_invalid_edge', true, false, false, false, false, false, false, 1, false), (2, 'TestRun.test_ok', true, false, false, false, true, false, false, 2, false),
        (3, 'add', false, false, false, false, false, false, false, 0, true), (3, 'twice', false, false, false, false, false, false, false, 0, true))
        v(k, qualname, uses_io, touches_db, uses_time, uses_randomness, spawns_threads, modifies_globals, modifies_closure, effect_calls, is_pure) ON p_partkey % 4 = k""",
    "effect_targets": """SELECT effect, target, CAST(sum(n) AS BIGINT) AS uses, CAST(sum(l) AS BIGINT) AS lines FROM part JOIN (VALUES
        (0, 'db', 'create_engine', 1, 6), (0, 'io', 'aws.client.put', 1, 8), (0, 'io', 'redis.get', 1, 9), (0, 'global', 'LAST', 1, 5), (1, 'io', 'redis.get', 2, 18), (1, 'random', 'random.randint', 2, 16),
        (1, 'nonlocal', 'seen', 2, 14), (1, 'time', 'time.sleep', 1, 10), (2, 'io', 'rq.post', 1, 6), (2, 'threads', 'threading.Thread', 1, 11), (2, 'io', 'open', 1, 14)) v(k, effect, target, n, l) ON p_partkey % 4 = k GROUP BY 1, 2""",
    "external_calls": f"WITH {_XC} SELECT * EXCLUDE (p_brand) FROM xc",
    "external_dependencies": f"""WITH {_XC} SELECT library, service, CASE library WHEN 'redis' THEN 'cache' WHEN 'boto3' THEN 'cloud' ELSE '-' END AS category, CASE library WHEN 'boto3' THEN 'High' ELSE '-' END AS severity,
        CASE library WHEN 'boto3' THEN 4.5::DOUBLE ELSE -1 END AS risk_score, count(*) AS functions, CAST(sum(callsites) AS BIGINT) AS callsites, count(DISTINCT module) AS modules, any_value(modes) AS modes,
        string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS config_keys, CASE library WHEN 'boto3' THEN 'High' WHEN 'redis' THEN 'high' ELSE CASE WHEN sum(callsites) > 10 THEN 'medium' ELSE 'low' END END AS risk_level FROM xc GROUP BY library, service""",
    "test_behaviour": """SELECT p_partkey AS part, v.* EXCLUDE (k, a, b), CASE WHEN p_partkey % 3 = 0 THEN b ELSE a END AS tags FROM part JOIN (VALUES
        (2, 'test_invalid_edge', 2::BIGINT, 0::BIGINT, true, false, true, true, 'edge_cases,error_paths,io_heavy,network_interaction', 'db_interaction,edge_cases,error_paths,io_heavy,known_bug,network_interaction'),
        (2, 'TestRun.test_ok', 0, 1, false, true, false, false, 'concurrency,filesystem_interaction,happy_path,io_heavy', 'concurrency,db_interaction,filesystem_interaction,happy_path,io_heavy,known_bug'))
        v(k, qualname, asserts, raises, expects_error, uses_concurrency, bounds, uses_fixtures, a, b) ON p_partkey % 4 = k""",
}
