"""Covers taken within blocks of cells."""

import random

import pytest

from regolith.operators import coverage

KIND = "id string, i int, j int, w double, g string"


def _greedy(cells, least):
    rows = {}
    for name, i, j, w, g in cells:
        rows.setdefault((g, name), {})[i, j] = w
    out = []
    for group in sorted({g for g, _ in rows}):
        left, n = {k: dict(v) for k, v in rows.items() if k[0] == group}, 0
        while left:
            best = min(left, key=lambda k: (-sum(left[k].values()), k))
            gain = sum(left[best].values())
            if gain < least:
                break
            n += 1
            out.append((group, best[1], n, gain))
            covered = set(left.pop(best))
            left = {k: {p: w for p, w in v.items() if p not in covered} for k, v in left.items()}
            left = {k: v for k, v in left.items() if v}
    return out


def _images(seed, n, width, large):
    r = random.Random(seed)
    out = []
    for k in range(n):
        a, b, w, h = r.randrange(width), r.randrange(-3, width), r.randint(1, 4), r.randint(1, 5)
        if k < large:
            w, h = r.randint(width // 2, width), r.randint(1, 3)
        name = f"m{r.randrange(10**6):06d}"
        out += [(name, i, j, float(1 + (i + j) % 2), "p" if k % 4 else "q") for i in range(a, a + w) for j in range(b, b + h)]
    return out


@pytest.mark.parametrize("seed,large,block,crowd", [(2, 6, 300, 10**6), (3, 5, 800, 500)])
def test_blocks_give_plain_greedy(spark, monkeypatch, seed, large, block, crowd):
    monkeypatch.setattr(coverage, "BLOCK", block)
    monkeypatch.setattr(coverage, "CROWD", crowd)
    cells = _images(seed, 200, 40, large)
    got = coverage.set_coverage(spark.createDataFrame(cells, KIND), 2.0, group="g").collect()
    assert sorted((r.g, r.id, r.round, r.gain) for r in got) == sorted(_greedy(cells, 2.0))


def test_a_chain_takes_few_passes(spark):
    """Each image shares a cell with the next, which adds one less: 24 passes if each waits for the one before it, fewer within blocks."""
    cells = [(f"m{k:02d}", 0, j, 1.0, "g") for k, (a, n) in enumerate(_chain(24)) for j in range(a, a + n)]
    got = coverage.set_coverage(spark.createDataFrame(cells, KIND).drop("g"), 1.0, max_rounds=8).collect()
    assert sorted(("g", r.id, r.round, r.gain) for r in got) == sorted(_greedy(cells, 1.0)) and len(got) == 24


def _chain(n):
    at = 0
    for k in range(n):
        size = n + 2 - k
        yield at, size
        at += size - 1
