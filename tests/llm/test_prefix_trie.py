"""The prefix trie against a plain one, with deep conversations and blocks of few depths."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corvid.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, turns int, depth int"


def _convs(rows):
    """Turns of each conversation in order; ties by the hash that the docstring names."""
    out = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            out.setdefault(conv, []).append((turn is not None, turn or 0, key, (role, text)))
    return {c: [t[3] for t in sorted(v)] for c, v in out.items()}


def _plain(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    leaves, saved, kids = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, who in members.items():
        worth = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += not kids[node]
    ends = {n: hashlib.sha256(",".join(map(str, sorted(c for c in who if len(convs[c]) == len(n)))).encode()).hexdigest() for n, who in members.items()}
    return sorted(
        (min(who), len(n), min(members[n[:-1]]) if n else -1, len(who), kids[n], leaves[n], saved[n], ends[n]) for n, who in members.items()
    )


def _rows(df):
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[c] is None else r[c] for c in cols) for r in df.collect())


def _made(rng, n):
    rows, shared = [], [("user", "éa" * rng.randint(0, 4)) for _ in range(40)]
    for c in range(n):
        depth = rng.choice([1, 2, 3, 5, 33 if c % 9 == 0 else 4])
        cut = rng.randint(0, depth)
        for t in range(depth):
            role, text = shared[t] if t < cut else ("assistant", rng.choice("abc"))
            rows.append((c * 3, t, role, text, "x", 1, 2))
    return rows


@pytest.mark.parametrize("fan", [2, 3, 32])
def test_equals_a_plain_trie(spark, fan, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 5)  # many chunks for one node
    rows = _made(random.Random(fan), 40)
    rows += [(7, 0, "user", "copy", "x", 0, 0), (8, 0, "user", "copy", "x", 0, 0), (10, 0, "user", "copy", "x", 0, 0)]
    convs = trie.gather_turns(spark.createDataFrame(rows, SCHEMA))
    assert _rows(trie.prefix_trie(convs, fan)) == _plain(_convs(rows))


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (1, None, "user", "first", None, None, None), (1, 0, None, None, None, None, None), (1, 0, "b", "tie", None, None, None), (1, 0, "a", "tie", None, None, None),
        (1, 0, "a", "tie", None, None, None), (None, 0, "user", "lost", None, None, None), (2, 5, "user", "é" * 300_000, None, None, None), (2, None, "user", "first", None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _rows(trie.prefix_trie(trie.gather_turns(df))) == _plain(_convs(rows))
    assert trie.prefix_trie(trie.gather_turns(df.limit(0))).count() == 0


def test_query_rebuilds_conversations(spark, tmp_path):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice("xyz"), "", 0, 0) for c in range(60) if c % 7 for t in range(rng.randint(1, 6))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    own = _convs(rows)
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    got = trie.op13_prefix_trie(spark, str(tmp_path))
    assert _rows(got) == _plain(made)
    assert any(not t for t in made.values()) and got.where("depth = 0").count() == 1


def test_lead_length_is_the_checksum_of_the_digits(spark):
    got = spark.range(50).select("id", trie.lead_length(F.col("id")).alias("h")).collect()
    assert all(r.h == zlib.crc32(str(r.id).encode()) % 9 for r in got)
