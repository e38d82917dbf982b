from corvid.operators import roles as R

COLUMNS = "path string, qualname string, module string, decorators array<string>, tags array<string>, loc int, touches_db boolean, uses_io boolean, raises array<string>, has_preconditions boolean, fan_in long, fan_out long"


def test_roles_by_signals(spark):
    rows = [
        ("tests/a.py", "test_x", "tests.a", [], None, 50, None, None, None, None, None, None),  # 0.6 + 0.5 + 0.4 is cut at 1
        ("tests/b.py", "db", "tests.b", ["pytest.fixture()"], None, 50, False, False, [], False, 0, 0),  # a fixture is no test by its module
        ("src/x.py", "C.get", "src.x", ["router.get('/')", "app.route('/')"], ["API", None], 90, False, False, [], False, 0, 0),
        ("src/y.py", "run", "src.y", ["click.command()", "typer.x"], [], 90, False, False, [], False, 0, 0),  # the first framework of the role
        ("src/z.py", "check_all", "src.z", [], [], 90, False, True, ["ValueError"], True, 9, 9),
        ("src/w.py", "run", "src.w", [], [], 90, True, True, [], False, 9, 9),
        ("src/v.py", "run", "src.v", [], [], 90, False, False, [], False, 6, 5),  # below the threshold
        ("src/u.py", "run", "src.u", [], ["db", "DB"], 20, False, False, [], False, 6, 6),  # tags count each time; helper and service have 0.4
        (None,) * 12,
    ]
    got = [tuple(r)[-4:] for r in R.function_roles(spark.createDataFrame(rows, COLUMNS).coalesce(1)).collect()]
    assert [(r, f, round(c, 9)) for r, f, c, _ in got] == [
        ("test", None, 1.0), ("test_helper", None, 0.9), ("api_handler", "fastapi", 1.0), ("cli_command", "click", 1.0), ("validator", None, 1.0), ("repository", None, 0.8), ("other", None, 0.0),
        ("repository", None, 0.6), ("helper", None, 0.4),
    ]
    assert got[4][3] == ["name:validator", "raises:valueerror", "guards:preconditions"] and got[6][3] == []


def test_equal_roles_go_to_the_first_signal(spark):
    row = ("src/a.py", "run", None, [], [], 20, False, False, [], False, 6, 6)  # service 0.2 + 0.2, helper 0.4
    assert R.function_roles(spark.createDataFrame([row], COLUMNS)).first()["role"] == "service"


def test_modules_add_up_their_functions(spark):
    modules = spark.createDataFrame([("a", ["API", "db"]), ("b", ["db", "repository"]), ("c", None), ("d", ["x"]), ("a", ["api"])], "module string, tags array<string>")
    roles = spark.createDataFrame([("a", "test", 0.9), ("a", "repository", 0.7), ("a", "other", 0.0), ("c", "helper", 0.4), ("c", "test", 0.4), (None, "test", 1.0)], "module string, role string, role_confidence double")
    got = {r["module"]: (r["role"], round(r["confidence"], 9), r["scores"], r["tag_signals"]) for r in R.module_roles(modules, roles).collect()}
    assert got["a"] == ("repository", 1.0, {"api_handler": 0.3, "repository": 1.0, "test": 0.9}, ["tag:api", "tag:repository"])
    assert got["b"][:2] == ("other", 0.0) and got["b"][2] == {"repository": 0.3}  # both tags are one signal
    assert got["c"][:2] == ("helper", 0.4) and got["d"] == ("other", 0.0, {}, [])
    assert R.module_roles(modules.limit(0), roles).count() == 0
