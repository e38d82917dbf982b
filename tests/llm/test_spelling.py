"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvid.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, form string, root string"


def _words(docs):
    counts = Counter()
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _plain(words):
    near = {w: [u for u in words if _near(w, u)] for w in words}
    form = {}
    for w, us in near.items():
        best = min(us, key=lambda u: (-words[u], u), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def _got(df):
    return sorted([tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()], key=str)


def _vocabulary(rng, n):
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 10))): rng.choice([2, 3, 40, 900]) for _ in range(n)}
    return words | {"aaaaaaa" + "a" * k: 2 * 10**k for k in range(12)}  # a chain of forms


def _latin(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").withColumn("word", F.encode("word", "ISO-8859-1"))


@pytest.mark.parametrize("limit", [3, 20, 50_000])
def test_equals_all_pairs(spark, limit):
    words = _vocabulary(random.Random(limit), 500)
    out = spelling.spelling_variants(_latin(spark, words), limit=limit)
    text = {c: F.decode(c, "ISO-8859-1") for c in ("word", "form", "root")}
    assert _got(out.withColumns(text)) == _plain(words)


def test_query_on_whole_texts(spark, tmp_path):
    rng = random.Random(3)
    stems = ["variantes", "Größeres", "THROUGHOUT", "vari×ntes", "throughoutāb", "sevenle", "naïveté's", "throughput"]
    docs = [(i, " ".join(rng.choice(stems) for _ in range(60)) + "̀\n" + "x" * (i % 5), "w", 1, "f", "r") for i in range(200)]
    docs += [(None, "nullname nullname variantes", "", 0, "", ""), (5, None, "", 0, "", ""), (6, "", "", 0, "", ""), (7, "long" * 5000 + " " + "long" * 5000 + "x", "", 0, "", "")] * 2
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = _plain(_words(docs))
    assert _got(spelling.op12_spelling(spark, str(tmp_path))) == want
    assert any(w[1] for w in want) and any(len(w[0]) > 10_000 for w in want)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert spelling.op12_spelling(spark, str(tmp_path)).count() == 0


def test_segments_are_found_at_their_places_only():
    import numpy as np

    words = ["abcdefg", "abczzzz", "xxxdefg", "zzzabcz", "abcdefgh"]
    every = np.ones(5, bool)
    same, shorter = spelling.scan(words, np.zeros(5, np.int8), every, every)
    assert same.tolist() == [True, True, False, False, False] and shorter.tolist() == [False, False, False, False, True]
    same, _ = spelling.scan(words, np.ones(5, np.int8), every, every)
    assert same.tolist() == [True, False, True, False, False]
