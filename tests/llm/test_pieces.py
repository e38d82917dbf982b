"""Sampled segmentations against the list of all segmentations of short words."""

import collections
import itertools
import math

import numpy as np
import sentencepiece

from corvid.llm import common, sentencepieces

MARK = chr(sentencepieces.SPACE)


def all_segmentations(text):
    """The probability of each segmentation of a text in the vocabulary, by its piece numbers, from a plain recursion."""
    model = sentencepiece.SentencePieceProcessor(model_proto=sentencepieces.read_model())
    size = model.get_piece_size()
    weight = {}
    for i in range(size):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            weight[model.id_to_piece(i)] = (i, 1 / (min(-model.get_score(i), size) + 2))
    marked = MARK + text.replace(" ", MARK)
    found = {}

    def go(at, ids, mass):
        if at == len(marked):
            found[tuple(ids)] = mass
        for end in range(at + 1, len(marked) + 1):
            if marked[at:end] in weight:
                i, w = weight[marked[at:end]]
                go(end, [*ids, i], mass * w)

    go(0, [], 1.0)
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


def work(texts, keys, k):
    vocabulary = sentencepieces.Vocabulary(sentencepieces.read_model())
    return sentencepieces._work(sentencepieces.Lattices(vocabulary), texts, keys, k)


def test_all_segmentations_come_out_once_with_their_probabilities():
    for text in ("thee", "a cat", "ie  on", "x"):
        exact = all_segmentations(text)
        got = work([text], np.array([77], np.uint64), len(exact) + 5)
        assert {tuple(g[2].tolist()) for g in got} == set(exact) and len(got) == len(exact)
        assert all(abs(g[3] - math.log(exact[tuple(g[2].tolist())])) < 1e-6 for g in got)
        assert all(a[4] >= b[4] for a, b in itertools.pairwise(got)) and got[-1][5] == 0.0


def test_samples_follow_the_exact_probabilities():
    n = 6000
    exact = all_segmentations("thee")
    by = collections.defaultdict(list)
    for row, _, ids, *_ in work(["thee"] * n, common.mix64(np.arange(n, dtype=np.uint64)), 2):
        by[row].append(tuple(ids.tolist()))
    first, pairs = collections.Counter(x[0] for x in by.values()), collections.Counter(map(tuple, by.values()))
    assert all(a != b for a, b in by.values())
    for seg, p in exact.items():
        assert abs(first[seg] / n - p) < 0.025
    for a, b in itertools.permutations(sorted(exact, key=exact.get)[-4:], 2):
        assert abs(pairs[a, b] / n - exact[a] * exact[b] / (1 - exact[a])) < 0.025


def test_long_and_short_words_alike():
    """Words whose mass underflows take the way through logarithms; results depend on key and text alone."""
    texts = ["word \U0001f600" * 300 + "\U0001f600" * 90, "plain words", "\u0e01" * 400]
    keys = np.array([5, 6, 7], np.uint64)
    together = {(g[0], g[1]): (g[2].tolist(), g[3]) for g in work(texts, keys, 3)}
    for i, t in enumerate(texts):
        for g in work([t], keys[i : i + 1], 3):
            ids, log = together[i, g[1]]
            assert ids == g[2].tolist() and abs(log - g[3]) < 1e-9


def test_query_decodes_every_sample(spark):
    df = spark.createDataFrame([(1, "A  text\u2581with \U0001f600 \n odd marks"), (1, "x"), (1, "x"), (None, None), (3, " y " * 40000)], "doc_id long, text string")
    got = sentencepieces.sample_pieces(df, check=True).collect()
    assert all(r["decoded_equal"] for r in got) and sorted(str(r["doc_id"]) for r in got) == ["1"] * 6 + ["3", "3", "None"]
