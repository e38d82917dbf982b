"""Contracts of functions, read off a file by hand."""

import pytest

from corvid.sources import contracts

CODE = '''
def plain(a, *rest, **more):
    pass

class C:
    def check(self, a: int, b: "str | None", c: Optional[int] = None, *, d=1) -> bool:
        assert a > 3
        assert not isinstance(b, str)
        assert isinstance(self.x, (int, float)), "kept"
        assert len(d) >= 2 and a
        assert len(c) > 0
        if b is None:
            raise ValueError("no b")
        if not a:
            raise errors.Bad
        if len(d) == 0:
            log()
            raise
        if a <= 0.5:
            raise KeyError(a)
        if a < d < 4:
            raise TypeError
        if other is None:
            raise X()
        if a:
            return None
        elif c == None:
            raise Y("z")

def is_it(x) -> int:
    return

def quiet(x):
    assert x != limit and x
    assert x != limit()
    assert x > "3"
    assert len(x) > True
    def inner():
        return None
    return 1

def has_no(x):
    return 1
'''


def test_contracts_by_hand(spark):
    files = spark.createDataFrame([("m.py", CODE), ("bad.py", "def ("), ("none.py", None)], "path string, text string")
    docs = spark.createDataFrame(
        [("m.py", "plain", {"a": "Required thing", "rest": "May be None", "more": "x"}, "None at all"), ("m.py", "has_no", {}, "a value"), ("m.py", "C.check", {"d": "optional", "a": ""}, None)],
        "path string, qualname string, param_docs map<string,string>, return_doc string",
    )
    got = {r["qualname"]: r for r in contracts.function_contracts(files, docs).collect()}
    assert set(got) == {"plain", "C.check", "is_it", "quiet", "quiet.inner", "has_no"}
    c = got["C.check"]
    pre = [(p["kind"], p["param"], p["value"], p["source"], p["line"]) for p in c["preconditions"]]
    assert pre == [
        ("ge", "a", "3", "assert", 7), ("instance_of", "x", "(int, float)", "assert", 9), ("len_gt", "c", "0", "assert", 11), ("non_null", "b", None, "guard", 12),
        ("truthy", "a", None, "assert", 14), ("len_gt", "d", "0", "guard", 16), ("ge", "a", "0.5", "guard", 19), ("non_null", "c", None, "guard", 27),
    ]
    assert [(r["exception"], r["message"], r["line"]) for r in c["raises"]] == [
        ("ValueError", "no b", 13), ("errors.Bad", None, 15), ("Exception", None, 18), ("KeyError", None, 20), ("TypeError", None, 22), ("X", None, 24), ("Y", "z", 28)
    ]
    assert c["param_nullability"] == {"a": "non_null", "b": "nullable", "c": "nullable", "d": "nullable"}
    assert [(p["kind"], p["line"]) for p in c["postconditions"]] == [("non_null", 28), ("returns_bool_predicate", 28)]
    assert (c["return_nullability"], c["confidence"]) == ("non_null", pytest.approx(0.9))
    assert got["plain"]["param_nullability"] == {"a": "non_null", "rest": "nullable", "more": "unknown"} and got["plain"]["return_nullability"] == "nullable"
    assert got["plain"]["confidence"] == pytest.approx(0.3) and got["has_no"]["return_nullability"] is None and got["has_no"]["postconditions"] == []
    assert [p["kind"] for p in got["is_it"]["postconditions"]] == ["non_null", "returns_bool_predicate"]
    assert got["quiet"]["return_nullability"] == "nullable" and got["quiet.inner"]["return_nullability"] == "nullable" and got["quiet.inner"]["confidence"] == 0
    assert [(p["kind"], p["value"]) for p in got["quiet"]["preconditions"]] == [("non_null", None), ("len_gt", "1")]  # what is no literal may be None
    assert contracts.function_contracts(files, most=2).where("qualname = 'C.check'").first()["preconditions"].__len__() == 2
