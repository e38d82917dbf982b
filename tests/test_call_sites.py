from corvid.sources import call_sites as C

CODE = '''
import os.path, redis as r, asyncio
from . import redis
@r.cached
async def test_a(self, *, k=1):
    with pytest.raises:
        r.get("a").then()
    (lambda: x)().close()
    "a".join(k)
    assert 1 < k, "m"
    def test_b(v):
        asyncio.gather(v)
        os.path.remove(v)
    redis.unlink()
class K:
    def m(self):
        Path("x").write_text(1); datetime.now(); x.datetime.now()
def f(): pass
def f(a): print(a)
'''


def _files(spark):
    return spark.createDataFrame([("m.py", CODE), ("bad.py", "def ("), ("none.py", None), ("", "")], "path string, text string")


def test_effects_of_functions(spark):
    rows = {(r["qualname"], r["first_line"]): r for r in C.function_effects(C.facts(_files(spark))).collect()}
    assert rows["f", 18]["is_pure"] and rows["f", 19]["uses_io"]  # a name that is defined twice is two functions
    assert rows["test_a", 5]["spawns_threads"] and rows["test_a", 5]["uses_io"] and not rows["test_a", 5]["touches_db"]
    got = {(r["effect"], r["target"]) for r in C.effects(C.facts(_files(spark))).where("qualname = 'K.m'").collect()}
    assert got == {("time", "datetime.now")}  # neither x.datetime.now nor Path.write_text, whose dotted names start otherwise


def test_a_dotted_name_counts_below_its_module_only(spark):
    files = spark.createDataFrame([("a.py", "def f():\n    pathlib.Path.open()\n    datetime.now()\n    datetime.datetime.now()\n    date.today()\n")], "path string, text string")
    assert {(r["effect"], r["target"]) for r in C.effects(C.facts(files)).collect()} == {("io", "pathlib.Path.open"), ("time", "datetime.now")}
    own = {"x": {"datetime": ["datetime.now"], "m": ["go"]}}
    assert {r["target"] for r in C.effects(C.facts(files), own).collect()} == {"datetime.now"}


def test_facts_of_tests(spark):
    rows = {r["qualname"]: r for r in C.test_facts(C.facts(_files(spark))).collect()}
    assert set(rows) == {"test_a", "test_a.test_b"}
    a, b = rows["test_a"], rows["test_a.test_b"]
    assert (a["asserts"], a["raises"], a["expects_error"], a["bounds"], a["uses_concurrency"]) == (1, 0, True, True, True)
    assert a["uses_db"] and not b["uses_db"]  # r is redis; the own package's redis is not
    assert a["uses_network"] and b["uses_filesystem"] and b["uses_fixtures"] and not b["uses_network"]


def test_tags_without_markers_or_name(spark):
    tests = C.test_facts(C.facts(_files(spark))).where("qualname = 'test_a.test_b'")
    both = tests.selectExpr("*", "cast(null as array<string>) as markers", "cast(null as string) as name")
    assert both.select(C.behaviour_tags(both["name"], both["markers"]).alias("t")).first()["t"] == ["concurrency", "filesystem_interaction", "io_heavy"]


def test_outside_libraries(spark):
    patterns = {"redis": {"severity": "low", "patterns": [{"method": "get", "modes": ["read"]}, {"match": "get", "modes": ["admin"]}]}, "os": {"patterns": []}}
    calls = C.external_calls(C.facts(_files(spark)), patterns, samples=1)
    got = {(r["qualname"], r["library"]): (r["callsites"], r["modes"], len(r["evidence"])) for r in calls.collect()}
    assert got == {("test_a", "redis"): (2, ["admin", "read"], 1), ("test_a", "os"): (1, ["unknown"], 1), ("test_a.test_b", "os"): (1, ["unknown"], 1)}
    config = spark.createDataFrame([("m", "K"), ("m", "K"), ("n", "L")], "module string, key string")
    rows = {r["library"]: r for r in C.external_dependencies(calls, patterns, config).collect()}
    assert (rows["redis"]["risk_level"], rows["redis"]["risk_score"], rows["redis"]["config_keys"]) == ("low", 1.0, ["K"])
    assert (rows["os"]["risk_level"], rows["os"]["risk_score"], rows["os"]["functions"], rows["os"]["callsites"]) == ("low", None, 2, 2)
    assert C.external_dependencies(calls, patterns).first()["config_keys"] is None
