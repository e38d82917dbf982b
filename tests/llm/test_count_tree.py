"""The R-tree of count vectors and the bound against plain comparison of sets; short items of a benchmark; order of turns."""

import random

import numpy as np
from pyspark.sql import functions as F

from corvid.llm import chat_format, decontaminate, ngram_join


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, rng.integers(5, 200)).astype(np.uint64)) for _ in range(200)]
    tree = ngram_join.CountTree()
    for i, u in enumerate(sets):
        tree.add(i, u, ngram_join.point_of(u))
    depth, box = 1, tree.root
    while not box.leaf:
        assert 2 <= len(box.entries) <= tree.WIDTH
        for high, least, below in zip(box.high, box.least, box.entries):
            assert (below.high.max(0) == high).all() and below.least.min() == least
        depth, box = depth + 1, box.entries[0]
    assert depth >= 3
    for i, u in enumerate(sets):
        near = np.unique(np.concatenate((u[len(u) // 30 :], rng.integers(0, 1 << 63, 1).astype(np.uint64))))
        want = {j for j, v in enumerate(sets) if ngram_join.linked(ngram_join.overlap(near, v), len(near), len(v))}
        got = tree.find(near, ngram_join.point_of(near))
        assert (got in want) if want else got == -1
    far = np.unique(rng.integers(0, 1 << 63, 100).astype(np.uint64))
    assert tree.find(far, ngram_join.point_of(far)) == -1


def test_bound_keeps_all_linked_pairs(spark):
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 63, 100).astype(np.uint64))
    sets = [np.unique(np.concatenate((base[k:], rng.integers(0, 1 << 63, k).astype(np.uint64)))) for k in range(0, 60, 2)]
    points = spark.createDataFrame([(i, len(u), bytearray(ngram_join.point_of(u).tobytes())) for i, u in enumerate(sets)], "doc_id long, n long, point binary")
    every = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))]
    got = {(r["a"], r["b"]) for r in ngram_join.within_bound(points, spark.createDataFrame(every, "a long, b long"), ngram_join.RULE).collect()}
    want = {(i, j) for i, j in every if ngram_join.linked(ngram_join.overlap(sets[i], sets[j]), len(sets[i]), len(sets[j]))}
    assert want <= got < set(every) and want


def test_repeated_and_long_rows(spark):
    rnd = random.Random(1)
    long = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(60_000))
    rows = [(1, long), (2, long + " tail"), (2, long + " tail"), (3, "a b c d"), (3, "a b c d"), (4, "other words entirely here")]
    got = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1), (2, 1), (2, 1), (3, 3), (3, 3), (4, 4)]


def test_short_items_are_found_as_runs(spark):
    docs = [(1, "well, forty-two is it."), (2, "forty and two"), (3, None), (4, "It is: FORTY two"), (4, "It is: FORTY two"), (5, "two\nforty two"), (6, "forty"), (7, "two " * 50_000)]
    bench = [(9, "Forty two"), (8, "forty two"), (10, "absent words"), (11, ""), (12, None)]
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 8), (2, None), (3, None), (4, 8), (4, 8), (5, 8), (6, None), (7, None)] or sorted(
        (r["doc_id"], r["item_id"] or 0) for r in got
    ) == [(1, 8), (2, 0), (3, 0), (4, 8), (4, 8), (5, 8), (6, 0), (7, 0)]


def test_ties_of_a_turn_go_by_plain_text(spark):
    rows = [(1, 0, "user", "<s>b"), (1, 0, "user", "<sa"), (1, 0, "user", "<|end|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"turns": F.lit("clash"), "segments": F.lit(1)})
    got = chat_format.format_conversations(df).select(chat_format.read_back(F.col("formatted")).alias("t")).first()["t"]
    assert [x["text"] for x in got] == sorted(t for *_, t in rows)
