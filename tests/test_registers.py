"""Neighbourhoods by slices of registers against plain searches, and against sketches that travel."""

import random

import numpy as np
import pytest

from corvid.operators import measures as M
from corvid.operators import registers as R
from tests.test_measures import distances, drawn


@pytest.mark.parametrize("inbound", [True, False])
def test_slices_count_small_sets_and_estimate_large_ones(spark, monkeypatch, inbound):
    """Sets of up to 24 members are exact with 2^8 registers, larger ones within four of the errors of 6.5 %; hubs, chunks, long paths, loops,
    nodes without an edge."""
    for name, small in (("PLACES", 100), ("ROWS", 64), ("HUB", 8), ("SOURCES", 50), ("PACKED", 16)):
        monkeypatch.setattr(R, name, small)
    rng = random.Random(1)
    pairs = [(a, b) for a, b, _ in drawn(5, 400, 900)] + [(1000 + k, 1001 + k) for k in range(90)] + [(2000, 2000 + rng.randrange(1, 90)) for _ in range(80)]
    edges = spark.createDataFrame([*pairs, (5000, 5000), (None, 5001), (5002, None)], "src long, dst long")
    far = distances([(b, a, 1) if inbound else (a, b, 1) for a, b in pairs])
    rows = {r["node"]: r for r in R.sliced_neighbourhoods(edges, 8, inbound).collect()}
    assert set(rows) == set(far) | {5000, 5001, 5002} and all(rows[v]["reached"] == 0 for v in (5000, 5001, 5002))
    errors = []
    for v, d in far.items():
        r, steps = rows[v], [x for x in d.values() if x]
        if len(d) <= R.most_listed(8):
            assert (r["reached"], r["distance_sum"], r["last"]) == (len(steps), sum(steps), max(steps, default=0))
            assert r["harmonic"] == pytest.approx(sum(1 / x for x in steps))
        else:
            assert r["reached"] >= R.most_listed(8)
            errors.append(r["reached"] / len(steps) - 1)
    assert len(errors) > 100 and max(map(abs, errors)) < 0.26


def test_both_forms_of_neighbourhoods_agree(spark, monkeypatch):
    edges = spark.createDataFrame([(a, b) for a, b, _ in drawn(7, 120, 200)], "src long, dst long")
    take = lambda df: {r["node"]: (r["reached"], r["distance_sum"], round(r["harmonic"], 9), r["last"]) for r in df.collect()}
    assert take(R.sliced_neighbourhoods(edges, 12)) == take(M.neighbourhoods(edges, 12))
    monkeypatch.setattr(R, "MOST_EDGES", 199)
    assert R.sliced_neighbourhoods(edges, 12) is None or edges.distinct().count() <= 199


def test_no_sketch_travels_in_reach_and_path_stats(spark, monkeypatch):
    """Reach and mean path of a graph that a task can hold make no round of sketches."""
    monkeypatch.setattr(M, "neighbourhoods", None)
    edges = spark.createDataFrame([(0, k) for k in range(1, 30)], "src long, dst long")
    assert {r["node"]: (r["descendants"], r["ancestors"]) for r in M.sketched_reach(edges).collect()} == {0: (29, 0)} | {k: (0, 1) for k in range(1, 30)}
    assert M.path_stats(edges).first()["mean_path"] == pytest.approx((2 * 29 + 2 * 29 * 28) / (30 * 29))


def test_estimates_of_many_sizes():
    rng = np.random.default_rng(2)
    for n in (500, 3000, 10000, 12000, 50000, 400000):
        found = []
        for _ in range(10):
            state = np.zeros(4096, np.uint8)
            np.maximum.at(state, rng.integers(0, 4096, n), np.minimum(rng.geometric(0.5, n), 52).astype(np.uint8))
            found.append(R.estimate(np.array([R.POWERS[state].sum()]), np.array([(state == 0).sum()]), 4096)[0] / n - 1)
        assert abs(np.mean(found)) < 0.016 and max(map(abs, found)) < 0.065
