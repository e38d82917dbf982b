"""What the driver holds while it fits a model doesn't grow with steps over the whole sample."""

from __future__ import annotations

import tracemalloc

import numpy as np

from corvid.llm import toxicity


def test_gradient_steps_are_bounded():
    """Beside the features, five bytes or so for each one: not five arrays of eight."""
    rng = np.random.default_rng(1)
    lengths = rng.integers(0, 400, 10_000)
    flat = rng.integers(0, 4096, lengths.sum())
    y = (rng.random(10_000) < 0.3).astype(float)
    tracemalloc.start()
    toxicity._logistic(flat.astype(np.int32), lengths, y, np.ones(4096), steps=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * len(flat) + (8 << 20)


def test_blocks_give_the_gradient_of_all_rows():
    rng = np.random.default_rng(2)
    lengths = rng.integers(0, 300, 700)  # some texts without a feature
    flat, y, scale = rng.integers(0, 50, lengths.sum()), (rng.random(700) < 0.5).astype(float), rng.normal(size=50)
    assert len(flat) > toxicity.STEP_FEATURES
    row = np.repeat(np.arange(700), lengths)
    x = np.zeros((700, 50))
    np.add.at(x, (row, flat), scale[flat])
    w, b = toxicity._logistic(flat, lengths, y, scale, steps=1)
    rate = 4.0 / (np.bincount(row, scale[flat] ** 2, minlength=700).mean() + 1.0)
    assert np.allclose(w, -rate * (np.bincount(flat, (0.5 - y)[row] * scale[flat], minlength=50) / 700)) and np.isclose(b, -rate * (0.5 - y).mean())
