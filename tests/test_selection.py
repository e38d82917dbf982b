"""Operators that pick rows: odd values, and what the tables of the queries don't hold."""

import random

from pyspark.sql import functions as F

from corvid.operators import selection as S


def test_odd_values(spark):
    one = spark.range(1)
    names = lambda *n: F.array(*[F.lit(x) for x in n])
    got = one.select(
        S.common_prefix(names("a.b.c.d", "a.b.c.d.e")), S.common_prefix(names("a.b", "a.c.b")), S.common_prefix(names("x", "y")), S.common_prefix(names("a.b.c.d")),
        S.clamp_offset(F.lit(-3)), S.clamp_offset(F.lit(None).cast("int")), S.clamp_offset(F.lit(7)),
        S.known_or_all(names("a", "b"), names("b", "z")), S.known_or_all(names("a", "b"), names("z")),
        S.severity(F.lit("x"), F.lit("info"), {"*": "error", "y": "low"}), S.severity(F.lit("y"), F.lit("info"), {"*": "error", "y": "low"}), S.severity(F.lit("x"), F.lit("info"), {}),
        S.is_definition(F.lit(9)), S.is_reference(F.lit(9)), S.is_reference(F.lit(16)), S.is_definition(F.lit(None).cast("int")),
    ).first()
    assert list(got) == ["a.b.c", "a", "", "a.b.c", 0, 0, 7, ["b"], ["a", "b"], "error", "low", "info", True, True, False, False]


def test_steps_of_the_span_lookup(spark):
    """The first fitting step; a lookup may run past its span; names fit by their last part; a null end is the start."""
    spans = [("f", "s1", 1, 900, "m.g"), ("f", "s2", 3, 5, "h"), ("f", "s3", 3, 4, "m.C.k"), ("e", "s4", 1, 2, "g"), ("f", "s5", 10, 20, "m.g"), ("f", "s6", 700, None, "late"), ("f", "s7", 30, 30, "x.one")]
    asked = [
        ("f", 1, 3, 5, "h", ("s2", 1)), ("f", 2, 3, 5, "z", ("s2", 2)), ("f", 3, 12, 30, "g", ("s1", 3)), ("f", 4, 4, 4, "z", ("s1", 4)), ("f", 5, 700, 99, "z", ("s1", 4)),
        ("f", 6, 950, 960, "g", (None, None)), ("q", 7, 1, 2, "g", (None, None)), ("f", 8, None, 2, None, (None, None)), ("f", 9, 12, None, "C.k", ("s1", 4)), ("f", 10, 30, None, "a.one", ("s7", 1)),
        ("f", 11, 4, 4, "a.b.k", ("s3", 3)), ("f", 12, 30, None, "", ("s7", 2)),
    ]
    spans = spark.createDataFrame(spans, "path string, span_id string, first int, last int, span_name string")
    lookups = spark.createDataFrame([a[:5] for a in asked], "path string, lookup_id int, start int, end int, name string")
    for width in (2, 256):
        got = {r["lookup_id"]: (r["span_id"], r["step"]) for r in S.best_span(lookups, spans, ["path"], width).collect()}
        assert got == {a[1]: a[5] for a in asked}
    alone = S.best_span(lookups.where("lookup_id = 5"), spans.where("span_id = 's6'"), ["path"]).first()
    assert (alone["span_id"], alone["step"]) == ("s6", 5)


def test_trimmed_graph_rotates_nodes_and_edges(spark):
    rows = [(a, b, 1) for a in range(12) for b in range(12) if (a * b) % 5 == 1]
    edges = spark.createDataFrame(rows, "src long, dst long, weight long")
    nodes = sorted({v for a, b, _ in rows for v in (a, b)}, key=str)
    turn = lambda items, k: items[k % len(items) :] + items[: k % len(items)]
    keep = set(turn(nodes, 7)[:6])
    held = sorted([(a, b) for a, b, _ in rows if a in keep and b in keep], key=lambda e: (str(e[0]), str(e[1])))
    got, said = S.trimmed_graph(edges, 6, 4, 7)
    assert {(r["src"], r["dst"]) for r in got.collect()} == set(turn(held, 7)[:4])
    assert said == {"nodes_before": len(nodes), "edges_before": len(rows), "nodes_after": 6, "edges_after": min(4, len(held)), "truncated": True}
    whole, said = S.trimmed_graph(edges)
    assert whole.count() == len(rows) and not said["truncated"]


def test_long_spans_have_few_rows(spark):
    """A lookup in spans of very different lengths, one of ten billion lines, against plain comparison."""
    rng = random.Random(5)
    spans = [("f", f"s{i}", a, a + int(10 ** rng.uniform(0, 6)), "n") for i in range(60) for a in [rng.randrange(100_000)]] + [("f", "wide", 5, 10**10, "n")]
    asked = [("f", i, rng.randrange(150_000), None, None) for i in range(80)] + [("f", 80, 10**10, None, None), ("f", 81, 10**10 + 1, None, None)]
    want = {i: min([(2 if s == first == last else 4, first, n) for _, n, first, last, _ in spans if first <= s <= last], default=None) for _, i, s, _, _ in asked}
    got = S.best_span(
        spark.createDataFrame(asked, "path string, lookup_id int, start long, end long, name string"), spark.createDataFrame(spans, "path string, span_id string, first long, last long, span_name string"), ["path"], 2
    ).collect()
    assert {r["lookup_id"]: (r["step"], r["span_id"]) for r in got} == {i: (w[0], w[2]) if w else (None, None) for i, w in want.items()}
