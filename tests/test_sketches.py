"""Unions of sketches inside tasks against Spark's own, and what travels in a round."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.operators import measures as M
from corvid.operators.sketches import Sketches


@pytest.mark.parametrize("lg", [8, 12])
def test_unions_are_those_of_spark(spark, lg):
    """Sets of coupons, of registers, of both, and some that turn from coupons to registers: the registers are those of Spark."""
    spans = [(0, 1), (0, 6), (5, 30), (20, 400), (300, 700), (100, 9000)]
    images = [bytes(spark.range(a, b).agg(F.hll_sketch_agg("id", F.lit(lg))).first()[0]) for a, b in spans]
    groups = [[0], [0, 1], [1, 2], [2, 3], [3, 4], [0, 5], [4, 5], []]
    held = Sketches(lg, len(groups))
    for k, image in enumerate(images):
        held.add(image, np.array([i for i, g in enumerate(groups) if k in g], np.int32))
    found = list(held.images(np.arange(len(groups), dtype=np.int32)))
    rows = spark.createDataFrame([(i, found[i], images[k]) for i, g in enumerate(groups) for k in g], "i int, mine binary, one binary")
    got = rows.groupBy("i").agg(F.hll_union_agg("one").alias("theirs"), F.first("mine").alias("mine")).select("*", F.hll_sketch_estimate("mine").alias("n"), F.hll_sketch_estimate("theirs").alias("m"))
    for r in got.collect():
        assert r["n"] == pytest.approx(r["m"], rel=2 * 1.04 / 2 ** (lg / 2)), r["i"]
        if r["theirs"][7] & 3 == 2:
            assert r["mine"][40:] == r["theirs"][40:] and r["mine"][16:32] == r["theirs"][16:32]
        else:
            assert r["n"] == r["m"] and r["mine"][7] & 3 == r["theirs"][7] & 3


def test_a_sketch_goes_once_to_each_block(spark, monkeypatch):
    """A star of 300 leaves both ways: its centre's sketch is sent to each block, not along each of its edges."""
    monkeypatch.setattr(M, "BLOCK_NODES", 100)
    edges = spark.createDataFrame([(0, k) for k in range(1, 301)] + [(k, 0) for k in range(1, 301)], "src long, dst long")
    sent = []
    settle = M.settle
    monkeypatch.setattr(M, "settle", lambda df, *instead: [sent.append(df) if "sends" in df.columns and not instead else None, settle(df, *instead)][1])
    rows = {r["node"]: tuple(r)[1:] for r in M.neighbourhoods(edges).collect()}
    assert rows[0] == (300.0, 300.0, 300.0, 1) and rows[7] == (300.0, 1.0 + 2 * 299, 1.0 + 299 / 2, 2)
    assert sent[0].where("node = 0").select(F.size("sends")).first()[0] == 4
