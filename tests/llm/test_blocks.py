"""The benchmark in several blocks gives the rows that one block gives."""

import random

import numpy as np

from corvid.llm import decontaminate


def test_small_blocks_give_each_row_once(spark, monkeypatch):
    rnd = random.Random(6)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 8))) for _ in range(2000)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [prose(30) for _ in range(20)]
    leak = lambda i: f"{prose(40)} {items[i]} {prose(40)}"
    rows = [(i, prose(100)) for i in range(30)]
    rows += [(7, leak(3)), (7, leak(4)), (None, leak(5)), (None, prose(50)), (None, None), (8, f"{leak(1)} {leak(15)}"), rows[2], rows[2]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    space = decontaminate.fit_space(df, bench)
    got = []
    for block in (2048, 4):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        found = decontaminate.search(df, bench, space)
        assert found.columns == ["doc_id", "item_id", "lcs_share", "cosine", "answer_found"]
        got.append(sorted((str(r["doc_id"]), str(r["item_id"]), str(r["lcs_share"]), str(r["answer_found"])) for r in found.collect()))
    assert len(got[0]) == len(rows) and got[0] == got[1]
    assert [r[1] for r in got[1] if r[0] == "7"] == ["3", "4", "None"] and sorted(r[1] for r in got[1] if r[0] == "None") == ["5", "None", "None"]


def test_the_projection_knows_no_sample_of_documents(spark):
    """The same texts under other ids give the same space."""
    rows = [(i, f"w{i % 50} w{i % 7} w{i % 11} w{i % 13} w{i % 3} w{i % 17} more") for i in range(2600)]
    bench = spark.createDataFrame([(k, " ".join(f"w{(k * j) % 50}" for j in range(20))) for k in range(6)], "item_id long, text string")
    spaces = [decontaminate.fit_space(spark.createDataFrame([(i + shift, t) for i, t in rows], "doc_id long, text string"), bench, 4).vectors for shift in (0, 10**6)]
    assert np.allclose(abs(spaces[0]), abs(spaces[1]), atol=1e-4)
