"""Near copies under the pipeline's rule (5 words, 80/100) and under op6's contract (3 words, 90/100)."""

import itertools
import random
import re

import corpus_pipeline
from corvid.llm import ngram_join


def _components(texts, rule):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return frozenset(tuple(w[i : i + rule.width]) for i in range(len(w) - rule.width + 1)) or frozenset([tuple(w)] if w else [])

    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and rule.denominator * both >= rule.numerator * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_pipeline_drops_copies_with_two_words_in_96_edited(spark):
    base = [f"w{i}" for i in range(96)]
    copy = list(base)
    copy[30], copy[60] = "x", "y"
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(copy)), (3, "another text")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == [1, 3]
    assert sorted(r["doc_id"] for r in ngram_join.keep_one(df).collect()) == [1, 2, 3], "op6's contract keeps them apart"


def test_rules_against_all_pairs(spark):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(rnd.randrange(1, 4)))
    texts = {}
    for _ in range(12):
        base = [word() for _ in range(rnd.choice((6, 12, 33, 60, 150, 400)))]
        for _ in range(rnd.randrange(1, 9)):
            copy = list(base)
            for _ in range(rnd.randrange(0, max(2, len(base) // 25))):
                copy[rnd.randrange(len(copy))] = word()
            texts[len(texts)] = " ".join(copy)
    for t in (None, "", "one", "ONE", "a b c d", "A b c d", "a b c d e", "a b c d e f"):
        texts[len(texts)] = t
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    for rule in (corpus_pipeline.NEAR_COPIES, ngram_join.Rule(1, 60, 100)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_components(df, rule).collect()}
        assert got == _components(texts, rule), rule
