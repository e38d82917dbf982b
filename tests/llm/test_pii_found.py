"""Discovered identifiers against a plain walk of the pattern graph, and planted cases."""

import math
import random

from pyspark.sql import functions as F

from corvid.llm import pii


def plain_discovery(mentions):
    edges = {(i, p) for i, _, ps in mentions for p in ps}
    seeds = {(i, k): 1.0 for i, k, _ in mentions if k is not None}
    scored = dict(seeds)
    while True:
        mass, support = {}, {}
        for i, p in edges:
            for (j, k), s in scored.items():
                if i == j:
                    mass[p, k], support[p, k] = mass.get((p, k), 0) + s, support.get((p, k), 0) + 1
        n = {p: sum(q == p for _, q in edges) for _, p in edges}
        good = {(p, k): m / (n[p] + 0.5) for (p, k), m in mass.items() if support[p, k] >= 3 and m / (n[p] + 0.5) >= 0.75}
        reached = {}
        for i, p in edges:
            for (q, k), w in good.items():
                if p == q:
                    reached[i, k] = reached.get((i, k), 0) + math.log(1 - w)
        reached = {x: 1 - math.exp(v) for x, v in reached.items() if 1 - math.exp(v) >= 0.7}
        had = {i for i, _ in scored}
        fresh = {x: v for x, v in reached.items() if x[0] not in had}
        scored |= fresh
        if not fresh:
            break
    known = {i for i, _ in seeds}
    secrets = {i for i, k in seeds if k == "secret"}
    out = {}
    for (i, _), v in [*((x, v) for x, v in scored.items() if x[0] not in known), *((x, v) for x, v in reached.items() if x[0] in secrets)]:
        out[i] = max(v, out.get(i, 0))
    return out


def test_discovery_against_a_plain_walk(spark):
    rnd = random.Random(6)
    mentions = []
    for i in range(120):
        group = i % 8
        kind = "email" if group < 3 and i < 108 else "secret" if group == 3 and i < 108 else None
        patterns = [group * 10 + rnd.randrange(3) for _ in range(2)] + ([group * 10 + 13] if i % 5 == 0 else [])
        mentions.append((i, kind, patterns))
    df = spark.createDataFrame(mentions, "instance long, kind string, patterns array<long>")
    want = plain_discovery(mentions)
    got = {r["instance"]: r["score"] for r in pii.discover(df.unionByName(df)).collect()}
    assert got.keys() == want.keys() and len(want) > 10 and all(abs(got[i] - want[i]) < 1e-9 for i in want)


HEX = "0123456789abcdef"


def test_keys_found_by_credentials_lead_to_values_of_other_forms(spark):
    rnd = random.Random(2)
    digest = lambda: "".join(rnd.choice(HEX) for _ in range(38)) + "a1"
    word = lambda: "".join(rnd.choice("aeiounrst") for _ in range(6))
    rows = [(i, f'{word()} {word()} token = "{digest()}" {word()}') for i in range(12)]
    rows += [(50, f'{word()} TOKEN = "Open-Sesame" {word()}'), (51, f"{word()} {digest()} alone"), (52, "Version 2.0, in 1999: an ordinary text = of words"), (53, None), (54, "")]
    rows += [(55, f'{word()} token = "{"x9" * 5000}" {word()}'), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.find_pii(df).select("doc_id", pii.spans_text(F.col("spans")).alias("s")).collect()
    by = {r["doc_id"]: r["s"] for r in got}
    assert len(got) == len(rows) and all(by[i].startswith("ctx:") and "," not in by[i] for i in range(12))
    at = dict(rows)[50].index("Open")
    assert by[50] == f"ctx:{at}:{at + 11}" and by[51] == by[52] == by[53] == by[54] == "" and by[55].startswith("ctx:")


def test_own_columns_stay(spark):
    df = spark.createDataFrame([(1, "x a@b.cc", 5, "m")], "doc_id long, text string, row_id int, mentions string")
    df = df.withColumns({"base": F.lit("b"), "spans": F.lit("s"), "instance": F.lit(3)})
    got = pii.mask_pii(df).collect()
    assert [r.asDict() for r in got] == [{"doc_id": 1, "text": "x <EMAIL>", "row_id": 5, "mentions": "m", "base": "b", "spans": "s", "instance": 3}]
    assert pii.find_pii(df).columns[-2:] == ["base", "spans"]


def test_columns_of_any_name_are_carried(spark):
    names = ["__row", "text", "__base", "__spans", "__mentions", "kept", "__more", "a.b", "base", "spans", "start", "none"]
    said = ["call +49 30 1234567 now", None, "", "x@y.de and x@y.de"]
    df = spark.createDataFrame([tuple(t if n == "text" else f"{n}{k}" for n in names) for k, t in enumerate(said)] * 2, ", ".join(f"`{n}` string" for n in names))
    got = pii.mask_pii(df)
    assert got.columns == names
    want = ["call <PHONE> now", None, "", "<EMAIL> and <EMAIL>"]
    assert sorted(map(str, got.collect())) == sorted(map(str, spark.createDataFrame([tuple(t if n == "text" else f"{n}{k}" for n in names) for k, t in enumerate(want)] * 2, df.schema).collect()))
    found = pii.find_pii(df).collect()
    assert len(found) == 8 and {(r["__row"], len(r["spans"])) for r in found} == {("__row0", 1), ("__row1", 0), ("__row2", 0), ("__row3", 2)}
    assert [len(r["base"]) for r in pii.find_pii(df.select("text").limit(1)).collect()] == [1]
