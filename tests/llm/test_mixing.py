"""Mixing: targets, quotas through the tree, and the words taken, against plain Python."""

import numpy as np
import pytest

from corvid.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, row int, start int, taken int"


def _docs():
    docs = []
    for k in range(300):
        source = "hot" if k % 3 else [None, "a", "b", "\U0001f600", "￮"][k % 5]
        docs.append((k, " ".join(f"w{j}" for j in range(k * 7 % 90)), source, 1, 2, 3, 4))
    return docs + [(300, "x " * 9000, "a", 0, 0, 0, 0), (301, None, "empty", 0, 0, 0, 0), (None, "no id", "b", 0, 0, 0, 0), (None, "no id", "b", 0, 0, 0, 0), (5, "again", "hot", 0, 0, 0, 0)]


def test_targets_share_what_is_cut_off():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == pytest.approx([50, 100, 150])
    assert mixing.targets([1, 1000, 1000], [1, 1, 2]) == pytest.approx([3, (2001 - 3) / 3, (2001 - 3) * 2 / 3])
    assert mixing.targets([10, 10, 580], [3, 3, 1]) == pytest.approx([30, 30, 540])
    assert mixing.targets([0, 0], [1, 2]) == [0, 0] and mixing.targets([], []) == []


@pytest.mark.parametrize("size,target,block", [(1000, 700, 64), (1000, 2999, 64), (37, 111, 64), (640, 640, 64), (641, 1, 64), (641, 1283, 64), (5, 0, 2)])
def test_draws_take_the_target_and_no_word_twice_in_a_pass(size, target, block):
    n = mixing.draws_of(size, target, block, 4)
    got = mixing.blocks_at(0, n, size, target, block, 4)
    assert got["take"].sum() == target and (got["take"] > 0).all()
    blocks = -(-size // block)
    for turn in range(-(-n // blocks) if n else 0):
        assert got[got.draw // blocks == turn]["block"].is_unique
    half = mixing.blocks_at(n // 2, n - n // 2, size, target, block, 4)
    assert half.values.tolist() == got.iloc[n // 2 :].values.tolist()


def test_shards_share_the_quotas_without_gaps():
    quotas = np.array([1000, 7, 0, 33, 4001])
    found = [mixing.shard_quotas(k, 13, quotas) for k in range(13)]
    at = np.zeros(5, np.int64)
    for first, n in found:
        assert (first == at).all()
        at += n
    assert (at == quotas).all()
    totals = np.array([n.sum() for _, n in found])
    assert totals.max() - totals.min() <= 4  # a block for each level at most


def test_splits_are_hypergeometric():
    """Over many seeds, a shard's blocks of a source have the mean and the variance of draws without replacement."""
    quotas = np.array([40, 60])
    got = np.array([mixing.shard_quotas(0, 2, quotas, seed)[1][0] for seed in range(4000)])
    assert abs(got.mean() - 20) < 0.2 and abs(got.var() - 50 * 0.4 * 0.6 * 50 / 99) < 0.4


def test_pieces_hold_the_targets(spark):
    docs = spark.createDataFrame(_docs(), SCHEMA)
    laid = mixing.lay_out(docs)
    plan = mixing.recipe(laid)
    pieces = mixing.mix(laid, plan, shards=5).toPandas()
    rows = laid.toPandas()
    assert len(rows) == len(_docs()) and rows.row.is_unique
    assert rows.sort_values("doc_id")["size"].sum() == sum(len((t or "").split()) for _, t, *_ in _docs())
    assert plan.source.tolist()[:3] == ["a", "b", "empty"] and plan.source.tolist()[3:] == ["hot", "￮", "\U0001f600", None]
    assert plan.weight.tolist() == [1, 2, 3, 1, 2, 3, 1]
    taken = pieces.fillna({"source": "~"}).groupby("source").words.sum()
    for r in plan.itertuples():
        assert taken.get(r.source or "~", 0) == int(r.target)
    spans = pieces.merge(rows[["row", "size"]], on="row")
    assert (spans["first"] + spans.words <= spans["size"]).all() and (spans["first"] >= 0).all()
    uses = np.zeros((len(rows), 9000), int)
    at = {r: k for k, r in enumerate(rows.row)}
    for p in pieces.itertuples():
        uses[at[p.row], p.first : p.first + p.words] += 1
    assert uses.max() <= 3
    by_shard = pieces.groupby("shard").words.sum()
    assert len(by_shard) == 5 and by_shard.max() < 1.6 * by_shard.min()


def test_layout_is_the_seeded_order(spark):
    """Positions are sums over each source's rows by (hash of id, id), counted in plain Python from the same hashes."""
    docs = spark.createDataFrame(_docs(), SCHEMA)
    order = {r.doc_id: r.h for r in docs.selectExpr("doc_id", f"xxhash64(doc_id, {mixing.SEED}) AS h").distinct().collect()}
    at = {}
    for source, _, doc_id, size in sorted(
        ((s, order[d], d, len((t or "").split())) for d, t, s, *_ in _docs()), key=lambda r: (r[0] or "", r[1], r[2] is not None, r[2] or 0, r[3])
    ):
        at.setdefault((source, doc_id), []).append((sum(x[1] for k, v in at.items() if k[0] == source for x in v), size))
    got = {}
    for r in mixing.lay_out(docs).collect():
        got.setdefault((r.source, r.doc_id), []).append((r.start, r["size"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in at.items()}


def test_query_and_texts(spark, tmp_path):
    docs = spark.createDataFrame(_docs(), SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op11_mixing(spark, str(tmp_path)).toPandas()
    again = mixing.op11_mixing(spark, str(tmp_path)).toPandas()
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(str, got[cols].values.tolist())) == sorted(map(str, again[cols].values.tolist()))
    assert (got.taken <= 3 * got["size"]).all() and len(got) == len(_docs())
    known = docs.where("doc_id is not null and doc_id <> 5")
    laid = mixing.lay_out(known)
    pieces = mixing.with_texts(mixing.mix(laid, mixing.recipe(laid), shards=3), known)
    texts = {d: (t or "").split() for d, t, *_ in _docs()}
    for p in pieces.collect():
        assert p.text == " ".join(texts[p.doc_id][p.first : p.first + p.words])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert mixing.op11_mixing(spark, str(tmp_path)).count() == 0
