from corvid.sources import docstrings as D


def test_styles_of_docstrings():
    got = D.parsed("Do.\n\n:type a: int\n:param a: x defaults to 3.\n:param b:\n:raises: e\n:yields: y")
    assert got["params"] == [{"name": "a", "type": "int", "text": "x defaults to 3.", "default": "3"}, {"name": "b", "type": None, "text": None, "default": None}]
    assert got["returns"] == {"type": None, "text": "y"} and got["raises"] == [{"type": None, "text": "e"}]
    got = D.parsed("Do: it.\n\nReturns:\n    the sum\n\nExamples:\n    >>> f(1)\n    2\n\nNote:\n    x: y")
    assert got["returns"] == {"type": None, "text": "the sum"} and got["examples"][0].startswith(">>> f(1)\n2")
    got = D.parsed("Do.\n\nParameters\n----------\na : int\n    One.\n\n    Two.\n\nNotes\n-----\nb : no\n")
    assert [p["name"] for p in got["params"]] == ["a"] and got["params"][0]["text"] == "One.\n\nTwo."
    for empty in ("x", " ", ":", "Args:", "Args:\n", "A\n---", ":param"):
        got = D.parsed(empty)
        assert got["params"] == [] and got["returns"] is None
    assert D.parsed("One\ntwo\n\nthree")["long"] == "two\n\nthree"


def test_docstrings_of_files(spark):
    texts = [("a/m.py", '"""M."""\nclass A:\n    "A."\n    async def f(self):\n        """F."""\n        def g(x):\n            "G"\ndef h():\n    ""\n'), ("bad.py", "def ("), ("none.py", None), ("", "")]
    files = spark.createDataFrame(texts, "path string, text string")
    rows = {(r["module"], r["qualname"]): (r["kind"], r["short"], r["line"]) for r in D.docstrings(files).collect()}
    assert rows == {("a.m", ""): ("module", "M.", None), ("a.m", "A"): ("class", "A.", 2), ("a.m", "A.f"): ("method", "F.", 4), ("a.m", "A.f.g"): ("method", "G", 6)}
    assert D.docstrings(files.limit(0)).count() == 0


def test_repeated_parameters_keep_their_last_text(spark):
    files = spark.createDataFrame([("m.py", 'def f(a):\n    """F.\n\n    :param a: one\n    :param a: two\n    """\n')], "path string, text string")
    r = D.contract_docs(D.docstrings(files)).first()
    assert r["param_docs"] == {"a": "two"} and r["return_doc"] is None


def test_sizes_of_files(spark):
    texts = [("a.py", "x = 1\n"), ("b.py", "def f(self, a: int, *b, c=1) -> int:\n    if a:\n        pass\nasync def g(cls): pass\nclass C: pass\n"), ("bad.py", "def ("), ("none.py", None)]
    got = {r["path"]: r for r in D.file_metrics(spark.createDataFrame(texts, "path string, text string")).collect()}
    assert set(got) == {"a.py", "b.py", "none.py"}
    a, b, none = got["a.py"], got["b.py"], got["none.py"]
    assert (a["nodes"], a["max_depth"], a["avg_depth"], a["params_ratio"], a["returns_ratio"]) == (5, 4, 2.6, 1.0, 1.0)  # module, assignment, name, its context, 1
    assert (b["functions"], b["classes"], b["complexity"], b["params_ratio"], b["returns_ratio"], b["untyped_defs"]) == (2, 1, 1, 0.5, 0.5, 2)
    assert none["nodes"] == 1
