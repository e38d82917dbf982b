"""Sharding, segmentation, joins, leaks, toxicity, the pipeline."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corvid.llm import common, decontaminate, ngram_join, sentencepieces, sharding, toxicity


def test_word_hashes_match_a_regular_expression():
    texts = ["", " a  b\n", "one", "two words", "\x0b\x0c", "é ü 日本", "x" * 3000, "Tail Word"]
    data, at = common.utf8_parts(pa.array([*texts, None]))
    for most in (4, 1 << 20):
        got = []
        for i, j in common.chunks_of(at, most):
            h, start, end, rows = common.word_hashes(data, at[i : j + 1], lower=True)
            base = at[i]
            got += [[bytes(data[base + s : base + e]).decode() for s, e in zip(start[a:b], end[a:b])] for a, b in itertools.pairwise(rows)]
        assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in [*texts, ""]]
    same = common.word_hashes(*common.utf8_parts(pa.array(["Abc abc xabc abcx"])), lower=True)[0]
    assert same[0] == same[1] and len(set(same.tolist())) == 3


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 5, 24, 1000, 4097):
        p = sharding.permute(np.arange(n), n)
        assert sorted(p.tolist()) == list(range(n))
        assert (sharding.permute(p, n, back=True) == np.arange(n)).all()


def test_shards(spark):
    rows = [(i, "t" * (i % 7), "x") for i in range(500)] + [(None, None, "x"), (3, "t" * 3, "x"), (3, "t" * 3, "x")]
    got = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string, shard string")).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert len(got) == 503 and set(by) == set(range(24)) and {len(v) for v in by.values()} <= {20, 21}
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert next(r for r in got if r["doc_id"] == 8)["text_crc32"] == zlib.crc32(b"t")
    assert all(sharding.row_at(r["shard"], r["slot"], 503) == r["row_number"] for r in got[:50])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_rows(empty).count() == 0


def _reference(texts):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else [])

    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 90 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_similar_components_against_all_pairs(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(rnd.randrange(1, 4)))
    texts = {}
    for _ in range(14):
        base = [word() for _ in range(rnd.choice((12, 20, 33, 60, 150, 400)))]
        for _ in range(rnd.randrange(1, 9)):
            copy = list(base)
            for _ in range(rnd.randrange(0, max(2, len(base) // 40))):
                copy[rnd.randrange(len(copy))] = word()
            texts[len(texts)] = " ".join(copy)
    for t in (None, "", " ", "one", "ONE", "one two", "one two", "a b c", "A b c", "a b c d"):
        texts[len(texts)] = t
    df = spark.createDataFrame([*texts.items(), (None, "one two")], "doc_id long, text string").withColumn("component", F.lit("clash"))
    got = ngram_join.similar_components(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == _reference(texts)
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    kept = ngram_join.keep_one(df)
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in _reference(texts).values()} | {None} and kept.columns == df.columns


def test_hub_of_copies_that_are_far_from_each_other(spark):
    """Copies that resemble their source and not each other are one component, without all of their pairs being tried."""
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(300)]
    texts = {0: "lone text of no one else at all"}
    for i in range(1, 60):
        copy = list(base)
        for k in rnd.sample(range(0, 300, 4), 4):
            copy[k] = f"x{rnd.randrange(10**6)}"
        texts[i] = " ".join(copy)
    texts[60] = " ".join(base)
    got = ngram_join.similar_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in _reference(texts).items()}
    assert {c for _, c in _reference(texts).values()} == {0, 1}


def test_linked_sets_share_a_leading_shingle():
    rng = np.random.default_rng(2)
    for size in (1, 2, 10, 11, 19, 20, 21, 57, 300, 2000):
        for classes in (np.zeros(1 << ngram_join.SKETCH_BITS, np.uint8), rng.integers(0, 9, 1 << ngram_join.SKETCH_BITS).astype(np.uint8)):
            for _ in range(20):
                a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.int64).astype(np.uint64))
                drop = rng.integers(0, max(1, size // 10) + 1)
                b = np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 63, rng.integers(0, max(1, size // 20) + 1), dtype=np.int64).astype(np.uint64))))
                both = ngram_join.overlap(a, b)
                if both and ngram_join.linked(both, len(a), len(b)):
                    x, y = ngram_join.leading(a, classes).tolist(), ngram_join.leading(b, classes).tolist()
                    need = ngram_join.overlap_needed(len(a), len(b))
                    assert any(x.index(v) <= len(a) - need and y.index(v) <= len(b) - need for v in set(x) & set(y))


def test_empty_join(spark):
    assert ngram_join.similar_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


ODD = [None, "", " ", " a  b ", "\u2581x \u2581", "\n\t\x00z", "日本語😀 é", "x" * 3000, "end ", "The quick, brown fox!"]


def test_pieces_round_trip_and_repeat(spark):
    df = spark.createDataFrame([*enumerate(ODD), (None, "no id"), (9, ODD[9])], "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = sentencepieces.decode_pieces(sentencepieces.sample_pieces(df, k=3)).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        assert r["decoded"] == ("no id" if r["doc_id"] is None else ODD[r["doc_id"]] or "") and len(r["ids"]) == r["n_pieces"] and r["log_inclusion"] <= 0
    assert [len(by[i]) for i in (0, 1)] == [1, 1] and by[0][0]["n_pieces"] == 0
    assert len({tuple(r["ids"]) for r in by[9]}) == 3 and len(by[9]) == 6
    assert all(x["perturbed"] > y["perturbed"] for i in (7, 3) for x, y in itertools.pairwise(sorted(by[i], key=lambda r: r["sample"])))
    again = sentencepieces.sample_pieces(df.repartition(3), k=3).collect()
    assert sorted((str(r["doc_id"]), r["sample"], tuple(r["ids"])) for r in again) == sorted((str(r["doc_id"]), r["sample"], tuple(r["ids"])) for r in got)
    assert sentencepieces.sample_pieces(df.where("false")).count() == 0


def test_lcs():
    rnd = random.Random(1)
    for _ in range(50):
        a, b = ([rnd.randrange(5) for _ in range(rnd.randrange(1, 20))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.lcs_length(decontaminate.places_of(a), len(a), b) == t[-1][-1]


def test_leaks(spark):
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 8))) for _ in range(3000)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [prose(rnd.randrange(15, 50)) for _ in range(20)]
    docs = [prose(120) for _ in range(150)]
    for i, item in enumerate(items):
        words = item.split()
        if i % 2:  # a paraphrase: some words replaced
            for k in range(2, len(words) - 6, 6):
                words[k] = rnd.choice(vocabulary)
        docs[i * 3] = f"{prose(40)}, {' '.join(words).upper()}. {prose(50)}"
    rows = [*enumerate(docs), (900, None), (901, ""), (None, "short"), (902, items[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([*enumerate(items), (50, None), (None, "x"), (51, "tiny one")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.find_leaks(df, bench).collect()}
    assert len(got) == 154
    assert {i for i, r in got.items() if r["contaminated"]} == {i * 3 for i in range(20)} | {902}
    assert all(got[i * 3]["item_id"] == i for i in range(20))
    assert {r["contaminated"] for r in decontaminate.find_leaks(df, bench.where("false")).collect()} == {False}
    assert decontaminate.find_leaks(df.where("false"), bench).count() == 0


def test_toxicity(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randrange(2, 7))) for _ in range(400)]
    bad = ["zorgblat", "fwackling", "quizzlekrump"]
    rows, labels = [], []
    for i in range(600):
        text = [rnd.choice(words) for _ in range(60)]
        if i % 5 == 0:
            for _ in range(3):
                text.insert(rnd.randrange(len(text)), rnd.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    df = spark.createDataFrame([*rows, (None, None), (1000, "")], "doc_id long, text string").withColumn("toxic", F.lit("clash"))
    lab = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(df, lab)
    got = [r for r in toxicity.score_toxicity(df, model).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()]
    assert len(got) == 602 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["out"] and r["doc_id"] < 600]
    assert held and all((r["score"] >= 0.5) == (r["doc_id"] % 5 == 0) for r in held)
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    alone = toxicity.fit(df, lab.where("toxic = 0"))
    assert {round(r["score"], 6) for r in toxicity.score_toxicity(df, alone).collect()} == {round(float(1 / (1 + np.exp(-alone.bias))), 6)}


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for name, stage in p.STAGES[:2]:
        after = p.settle(stage(spark, docs, data))
        assert after.columns == docs.columns and 0 < after.count() <= docs.count(), name
        docs = after
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(i == c for i, (_, c) in _reference(texts).items())
