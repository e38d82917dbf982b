"""Call chains against a plain search over all simple paths."""

import random
from collections import defaultdict

from corvid.operators import chains


def _paths(after, v, goal, seen, left):
    if v == goal:
        yield (*seen, v)
        return
    if left:
        for w in sorted(after[v]):
            if w not in seen and w != v:
                yield from _paths(after, w, goal, (*seen, v), left - 1)


def _plain(rows, entries, targets, most, longest):
    after = defaultdict(set)
    for a, b in rows:
        after[a].add(b)
    out = {}
    for t in targets:
        found = sorted({p for e in entries if e != t for p in _paths(after, e, t, (), longest)}, key=lambda p: (len(p), p))[:most]
        out[t] = [list(p) for p in found] or [[t]]
    return out


def test_chains_equal_a_plain_search(spark):
    table = lambda nodes: spark.createDataFrame([(v,) for v in nodes], "node long")
    for seed, n, m, longest in ((1, 12, 20, 10), (2, 14, 40, 4), (3, 30, 36, 10)):
        rng = random.Random(seed)
        rows = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        entries, targets = rng.sample(range(n), 3), [*rng.sample(range(n), 6), 99]
        got = defaultdict(list)
        for r in sorted(chains.call_chains(spark.createDataFrame(rows, "src long, dst long"), table(entries), table(targets), 3, longest).collect(), key=lambda r: r["rank"]):
            got[r["target"]].append(r["chain"])
        assert got == _plain(rows, entries, targets, 3, longest)


def test_a_ladder_of_hubs_keeps_few_paths(spark):
    """2^5 shortest paths from 0 to 15: the best three, without listing the others."""
    rows = [(3 * k, 3 * k + d) for k in range(5) for d in (1, 2)] + [(3 * k + d, 3 * k + 3) for k in range(5) for d in (1, 2)]
    edges = spark.createDataFrame(rows, "src long, dst long")
    one = lambda v: spark.createDataFrame([(v,)], "node long")
    got = sorted(chains.call_chains(edges, one(0), one(15), 3, 10).collect(), key=lambda r: r["rank"])
    assert [r["chain"] for r in got] == [[0, 1, 3, 4, 6, 7, 9, 10, 12, x, 15] if y is None else [0, 1, 3, 4, 6, 7, 9, y, 12, 13, 15] for x, y in ((13, None), (14, None), (13, 11))]
    assert chains.call_chains(edges.limit(0), one(0), one(15)).collect()[0]["chain"] == [15]
