"""Unseen identifiers whose noisy-or rounds to 1.0 are found like the others."""

from pyspark.sql import functions as F

from corvid.llm import pii


def _mentions(spark, patterns, seeds):
    """Instance -1 in all of `patterns` patterns, each with `seeds` seeds of its own; instance -2 in the first only."""
    rows = spark.range(patterns * seeds).select(F.col("id").alias("instance"), F.lit("email").alias("kind"), F.array(F.floor(F.col("id") / seeds)).alias("patterns"))
    unseen = [(-1, None, list(range(patterns))), (-2, None, [0])]
    return rows.unionByName(spark.createDataFrame(unseen, "instance long, kind string, patterns array<long>"))


def test_surest_finds_are_kept(spark):
    for patterns, seeds in ((25, 10), (9, 400), (6, 10_000)):
        got = {r["instance"]: r["score"] for r in pii.discover(_mentions(spark, patterns, seeds)).collect()}
        assert set(got) == {-1, -2}, (patterns, seeds)
        assert got[-1] == 1.0 and got[-2] < 1.0


def test_surest_finds_are_masked(spark):
    lead = [f"via{chr(97 + k)} contact" for k in range(25)]
    known = [(k * 20 + i, f"reach {lead[k]} user{k}x{i}@mail.com") for k in range(25) for i in range(20)]
    unseen = [(1000 + k, f"reach {lead[k]} usr-7788-zz") for k in range(25)]
    df = spark.createDataFrame(known + unseen, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.mask_pii(df).collect()}
    assert all(got[1000 + k] == f"reach {lead[k]} <CTX>" for k in range(25))
    spans = {r["doc_id"]: len(r["spans"]) for r in pii.find_pii(df).collect()}
    assert set(spans.values()) == {1}
