"""Polygons of any shape against areas by sampling, and rings whose parts are known."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from regolith.functions import geometry
from regolith.operators import coverage, polygons

SCHEMA = f"k int, rings {polygons.RINGS}"


def star(rng, corners, cx=0.0, cy=0.0):
    """A concave ring around a point."""
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return [(cx + r * math.cos(t), cy + r * math.sin(t)) for t, r in ((t, rng.uniform(1, 5)) for t in turns)]


def table(spark, shapes):
    return spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in ring] for ring in s]) for k, s in shapes.items()], SCHEMA)


def winding(rings, x, y, odd):
    count = np.zeros(x.shape, int)
    for ring in rings:
        ring = list(ring)
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            up, down = (ay <= y) & (by > y), (by <= y) & (ay > y)
            at = ax + (y - ay) / (by - ay if by != ay else 1) * (bx - ax)
            count += np.where(up & (at > x), 1, 0) - np.where(down & (at > x), 1, 0) if not odd else np.where((up | down) & (at > x), 1, 0)
    return count % 2 != 0 if odd else count != 0


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(4)
    out = {k: [star(rng, rng.randrange(3, 14), rng.uniform(-4, 4), rng.uniform(-4, 4))] for k in range(12)}
    out |= {k: [[(rng.uniform(-6, 6), rng.uniform(-6, 6)) for _ in range(rng.randrange(4, 9))]] for k in range(12, 20)}  # borders cross
    out[20] = [[(-6, -6), (6, -6), (6, 6), (-6, 6)], [(-3, -3), (3, -3), (3, 3), (-3, 3)], [(-1, -1), (1, -1), (1, 1), (-1, 1)]]  # an island in a hole
    out[21] = [[(-6, -6), (-2, -6), (-2, 0), (-6, 0), (-6, -6)], [(1, 1), (5, 1), (5, 4)]]  # two parts, one of them closed
    out[22] = [[(0, 0), (4, 0), (4, 4), (0, 4)], [(2, 0), (6, 0), (6, 4), (2, 4)]]  # parts that overlap, with borders on one line
    return out


GRID = (np.arange(-800, 800) + 0.5) / 80


@pytest.mark.parametrize("rule", ["evenodd", "nonzero"])
def test_areas_are_those_of_fine_cells(spark, shapes, rule):
    got = {r.k: r.area for r in polygons.areas(polygons.trapezoids(table(spark, shapes), "k", rule=rule), "k").collect()}
    x, y = np.meshgrid(GRID, GRID)
    for k, rings in shapes.items():
        assert got.get(k, 0.0) == pytest.approx(winding(rings, x, y, rule == "evenodd").sum() / 6400, abs=0.05), k
    assert got[20] == pytest.approx(144 - 36 + 4 if rule == "evenodd" else 144) and got[22] == pytest.approx(16 if rule == "evenodd" else 24)


def test_common_areas_are_those_of_fine_cells(spark, shapes):
    traps = polygons.trapezoids(table(spark, shapes), "k").cache()
    got = {(r.l_k, r.r_k): r.area for r in polygons.pair_areas(traps, traps, "k", F.col("l_k") <= F.col("r_k")).collect()}
    x, y = np.meshgrid(GRID, GRID)
    inside = {k: winding(rings, x, y, True) for k, rings in shapes.items()}
    for a in shapes:
        for b in shapes:
            if a <= b:
                assert got.get((a, b), 0.0) == pytest.approx((inside[a] & inside[b]).sum() / 6400, abs=0.05), (a, b)
    whole = {r.k: r.area for r in polygons.areas(traps, "k").collect()}
    shared = polygons.overlaps(traps, traps, "k", F.col("l_k") == F.col("r_k")).collect()
    assert len(shared) == len(whole) and all(r.l_percent == pytest.approx(100) and r.contains for r in shared)


def test_cells_hold_the_centres(spark, shapes):
    got = {(r.id, r.i, r.j) for r in polygons.cells(polygons.trapezoids(table(spark, shapes), "k"), "k", 0.25).collect()}
    i, j = np.meshgrid(np.arange(-40, 40), np.arange(-40, 40))
    for k, rings in shapes.items():
        ok = winding(rings, (i + 0.5) / 4, (j + 0.5) / 4, True)
        assert {c[1:] for c in got if c[0] == k} == set(zip(i[ok].tolist(), j[ok].tolist(), strict=True)), k


def ring_area(ring):
    return sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(ring, ring[1:])) / 2


def test_make_valid(spark, shapes):
    more = dict(shapes)
    more[30] = [[(0, 0), (4, 4), (4, 0), (0, 4)]]  # a bow tie
    more[31] = [[(0, 0), (6, 0), (6, 6), (0, 6)], [(2, 2), (2, 4), (4, 4), (4, 2)]]  # a hole that runs the other way
    more[32] = [[(0, 0), (1, 1)]]
    more[33] = [[(0, 0), (2, 0), (1, 0)]]  # no area
    more[34] = [[(0, 0), (2, 0), (2, 0), (2, 2), (1, 2), (0, 2), (0, 0)]]  # a repeated and a needless corner
    got = {r.k: r.rings for r in polygons.make_valid(table(spark, more), "k").collect()}
    assert set(got) == set(more) and got[32] == [] and got[33] == []
    assert sorted(map(ring_area, got[30])) == pytest.approx([4, 4]) and all(len(r) == 4 for r in got[30])
    assert sorted(map(ring_area, got[31])) == pytest.approx([-4, 36])
    assert [len(r) for r in got[34]] == [5] and ring_area(got[34][0]) == pytest.approx(4)
    assert len(got[22]) == 1 and len(got[22][0]) == 5 and ring_area(got[22][0]) == pytest.approx(24)
    want = {r.k: r.area for r in polygons.areas(polygons.trapezoids(table(spark, more), "k", rule="nonzero"), "k").collect()}
    for k, rings in got.items():
        assert sum(map(ring_area, rings)) == pytest.approx(want.get(k, 0.0), abs=1e-5), k
    again = polygons.make_valid(table(spark, {k: [[(p["x"], p["y"]) for p in r] for r in v] for k, v in got.items() if v}), "k").collect()
    assert all(sum(map(ring_area, r.rings)) == pytest.approx(want[r.k], abs=1e-4) for r in again)


def test_no_polygons(spark):
    none = spark.createDataFrame([(1, None)], SCHEMA)
    assert polygons.trapezoids(none, "k").count() == 0 and polygons.make_valid(none, "k").first().rings == []
    assert polygons.make_valid(none.limit(0), "k").count() == 0
    with pytest.raises(ValueError):
        polygons.trapezoids(none, "k", rule="other")


def test_cover_of_concave_polygons(spark, shapes):
    """Greedy cover on the cells of concave polygons: as plain greedy on the same cells."""
    cells = polygons.cells(polygons.trapezoids(table(spark, shapes), "k"), "k", 0.5)
    got = [(r.id, r.gain) for r in coverage.set_coverage(cells, 2.0).orderBy("round").collect()]
    left = {}
    for r in cells.collect():
        left.setdefault(r.id, set()).add((r.i, r.j))
    want = []
    while left:
        best = min(left, key=lambda k: (-len(left[k]), k))
        if len(left[best]) * 0.25 < 2.0:
            break
        taken = left.pop(best)
        want.append((best, len(taken) * 0.25))
        left = {k: v - taken for k, v in left.items()}
    assert got == want


def test_ring_of_box_is_one_trapezoid(spark):
    ring = F.array(geometry.box_ring(*[F.lit(v) for v in (1.0, 2.0, 4.0, 8.0)]))
    rows = polygons.trapezoids(spark.range(1).select(F.lit(7).alias("k"), ring.alias("rings")), "k").collect()
    assert [(r.y0, r.y1, r.la, r.lb, r.ra, r.rb) for r in rows] == [(2, 8, 1, 1, 4, 4)]
