"""The weighted schedule: it ends, serves every queue whole, and holds the shares of those that are left."""

import time

import numpy as np
import pytest

from regolith.llm.packing import Schedule


def served(s, sequences, queues):
    """Tokens of each queue at each beginning of a sequence, and what the queues before it gave."""
    got = [s.at(sequences, k) for k in range(queues)]
    return np.array([g for g, _ in got]), np.array([e for _, e in got])


@pytest.mark.parametrize("totals, weights", [([1, 1000], [49.0, 1.0]), ([10**9, 10**9, 5], [1e-9, 1.0, 3.0]), ([500, 700, 900, 0], [0.0, 2.0, 0.0, 1.0]), ([7, 7, 7], [1.0, 1.0, 1.0]), ([5000], [0.1]), ([4000, 6000], [0.0, 0.0])])
def test_few_queues(totals, weights):
    s = Schedule(totals, weights, 64)
    at = np.unique(np.linspace(0, s.sequences, 400).astype(np.int64))
    own, earlier = served(s, at, len(totals))
    assert (own[:, 0] == 0).all() and (own[:, -1] == totals).all() and (np.diff(own, axis=1) >= 0).all()
    assert (own.sum(axis=0) == np.minimum(at * 64, sum(totals))).all()
    order = np.argsort(s.place)
    assert (earlier[order] == np.cumsum(own[order], axis=0) - own[order]).all()


def fair(totals, weights, x):
    """What each queue has given of the first x tokens, by real numbers: queues with weights run dry one after another."""
    t = np.array(totals, float)
    w = np.array(weights, float)
    late = np.where(w > 0, t / np.where(w > 0, w, 1), np.inf)
    given = lambda time: np.minimum(w * time, t)
    low, high = 0.0, float(late[w > 0].max())
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if given(middle).sum() < x else (low, middle)
    return given(high)


@pytest.mark.parametrize("n", [100, 10_000])
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_random_weights(n, seed):
    rng = np.random.default_rng(seed)
    totals, weights = rng.integers(1, 50_000, n), rng.random(n) ** 3
    began = time.time()
    s = Schedule(totals, weights, 2048)
    at = np.unique(rng.integers(0, s.sequences + 1, 60))
    some = rng.choice(n, 100, replace=False)
    for k in some.tolist():
        own, _ = s.at(at, k)
        assert (np.diff(own) >= 0).all() and own[at == s.sequences].tolist() == [totals[k]] * int((at == s.sequences).sum())
    assert time.time() - began < 10
    for x in at[:5].tolist():
        want = fair(totals, weights, min(x * 2048, s.total))
        assert max(abs(s.at(np.array([x]), k)[0][0] - want[k]) for k in some.tolist()) < 16 + 1e-6 * 50_000
    assert sum(v.nbytes for v in vars(s).values() if isinstance(v, np.ndarray)) <= 64 * n  # a few numbers for each queue


def test_pieces_of_a_weighted_schedule():
    rng = np.random.default_rng(9)
    totals, weights = rng.integers(1, 900, 60), rng.random(60)
    s = Schedule(totals, weights, 128)
    full = np.zeros((s.sequences, 128), int)
    for k in range(60):
        which, start, size, seq, offset = s.pieces(np.array([0]), np.array([totals[k]]), k)
        assert size.sum() == totals[k] and (np.sort(start)[1:] == np.cumsum(size[np.argsort(start)])[:-1]).all()
        for q, o, m in zip(seq.tolist(), offset.tolist(), size.tolist(), strict=True):
            full[q, o : o + m] += 1
    assert (full.ravel()[: s.total] == 1).all() and (full.ravel()[s.total :] == 0).all()


def test_weights_that_are_none():
    with pytest.raises(ValueError):
        Schedule([1, 2], [1.0, -1.0], 8)
    with pytest.raises(ValueError):
        Schedule([1, 2], [1.0, float("nan")], 8)
