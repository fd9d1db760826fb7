"""Polygons of few corners, cut within batches of rows, against the joins that cut large ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from regolith.operators import polygons

CROSSED = [[(0.0, 0.0), (4.0, 3.0), (4.0, 0.0), (0.0, 3.0), (0.0, 0.0)]]


@pytest.fixture(scope="module")
def shapes(spark):
    rng = np.random.default_rng(15)
    made = [[[tuple(map(float, c)) for c in rng.integers(0, 9, (rng.integers(1, 8), 2))] for _ in range(rng.integers(0, 4))] for _ in range(60)]
    made += [[[tuple(map(float, c)) for c in rng.uniform(0, 9, (rng.integers(3, 9), 2))]] for _ in range(40)]
    rows = [*enumerate(made), (200, CROSSED), (201, None), (202, [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0)]]), (202, [[(1.0, -1.0), (3.0, 1.0), (1.0, 1.0)]]), (None, CROSSED)]
    return spark.createDataFrame(rows, f"k int, rings {polygons.RINGS}").cache()


def _rounded(df, *columns):
    """Rows but for slivers: where borders cross at one point up to rounding, ties may be told either way."""
    return sorted(tuple(round(v, 6) for v in r) for r in df.filter("(y1 - y0) * (ra - la + rb - lb) > 1e-9").select(*columns).collect())


@pytest.mark.parametrize("rule", ["evenodd", "nonzero"])
def test_both_ways_give_the_same(spark, shapes, rule, monkeypatch):
    columns = ["k", "y0", "y1", "la", "lb", "ra", "rb", "x0", "x1"]
    size = lambda df: {r["k"]: (r["n"], r["m"]) for r in df.select("k", F.size("rings").alias("n"), F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r)).alias("m")).collect()}
    one, valid = _rounded(polygons.trapezoids(shapes, "k", rule=rule), *columns), size(polygons.make_valid(shapes, "k", rule=rule))
    monkeypatch.setattr(polygons, "SMALL", 0)
    shared = shapes.filter("NOT k <=> 202")  # of a polygon in two rows, joins saw no crossings between them
    assert [r for r in one if r[0] != 202] == _rounded(polygons.trapezoids(shared, "k", rule=rule), *columns) and len(one) > 200
    assert {k: n for k, n in valid.items() if k != 202} == size(polygons.make_valid(shared, "k", rule=rule))


def test_no_join_and_no_group_for_each_small_polygon(spark, shapes):
    plan = polygons.make_valid(shapes.filter("k = 200"), "k")._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan and "Window" not in plan


def test_corners_that_are_not_finite_go_by_joins(spark):
    rows = spark.createDataFrame([(1, CROSSED), (2, [[(0.0, 0.0), (float("nan"), 3.0), (4.0, 0.0)]]), (3, [[(0.0, 0.0), None, (4.0, 0.0)]])], f"k int, rings {polygons.RINGS}")
    assert {r["k"]: r["small"] for r in polygons._whole(rows, "k", "rings").select(F.col("id").alias("k"), "small").collect()} == {1: True, 2: False, 3: False}
    assert {r["k"]: r["area"] for r in polygons.areas(polygons.trapezoids(rows.filter("k = 1"), "k"), "k").collect()} == {1: 6.0}


@pytest.mark.parametrize("pairs", [7, 200_000])
def test_pairs_of_polygons_of_many_trapezoids(spark, monkeypatch, pairs):
    """Two combs of teeth and a box: several blocks each, and few pairs of trapezoids at once."""
    comb = lambda x, y, n: [(x, y), *((x + 5 - 2 * (i % 2), y + 1 + i) for i in range(n)), (x, y + n)]
    rows = spark.createDataFrame([(1, [comb(0.0, 0.0, 50)]), (2, [comb(2.5, 3.25, 90)]), (3, [[(1.0, 1.0), (3.5, 1.0), (3.5, 40.0), (1.0, 40.0)]])], f"k int, rings {polygons.RINGS}")
    traps = polygons.trapezoids(rows, "k")
    monkeypatch.setattr(polygons, "PAIRS", pairs)
    several = polygons.overlaps(traps, traps, "k", F.col("l_k") < F.col("r_k"))
    plan = several._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate" in plan
    found = _pairs(several)
    monkeypatch.setattr(polygons, "BLOCK", 1000)
    assert _pairs(polygons.overlaps(traps, traps, "k", F.col("l_k") < F.col("r_k"))) == found and len(found) == 3
    monkeypatch.setattr(polygons, "BLOCK", 1)
    assert _pairs(polygons.overlaps(traps, traps, "k", F.col("l_k") < F.col("r_k"))) == found


def _pairs(df):
    return sorted((r["l_k"], r["r_k"], round(r["area"], 9), round(r["l_percent"], 6), round(r["r_percent"], 6)) for r in df.collect())
