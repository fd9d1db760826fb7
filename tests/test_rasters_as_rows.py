"""Rasters that are a row each are measured as their pixels are, and none of the queries on rasters without gaps deals a row for each pixel."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from regolith.operators import raster
from regolith.plans import fixtures, network

SF = "/root/testdata/sf0.001"


def _frames(rng: np.random.Generator) -> dict[int, np.ndarray]:
    """64 x 64: plain, striped, with missing pixels of all kinds, dark, half dark, and one without data."""
    y, x = np.mgrid[:64, :64]
    plain = 1 + rng.random((64, 64))
    gaps = plain.copy()
    gaps[::5, ::3], gaps[1::7, ::4] = raster.NODATA, np.nan
    half = np.where(x < 50, plain, 0.001)
    return {1: plain, 2: plain + np.cos(2 * np.pi * (10 * x + 12 * y) / 64), 3: gaps, 4: np.full((64, 64), 0.004), 5: half, 6: np.where(x < 40, plain, 0.0), 7: np.full((64, 64), np.nan), 8: -plain}


@pytest.mark.parametrize("least", [1, 900])
def test_measures_are_those_of_pixels(spark, least):
    frames = _frames(np.random.default_rng(3))
    rows = [(k, int(x), int(y), None if k == 3 and x % 9 == 4 else float(g[y, x])) for k, g in frames.items() for y in range(64) for x in range(64)]
    pixels = spark.createDataFrame(rows, "raster_id int, x int, y int, v double")
    want = {r.raster_id: (r.p, r.score) for r in raster.brightness(pixels, 2, 0.999, least).join(raster.stripe_score(pixels), "raster_id", "full").collect()}

    def grids(ids, which, x, y, v):
        out = np.full((len(ids), 64, 64), np.nan)
        out[which, y, x] = v
        return out

    found = raster.measures(raster.as_rows(pixels), grids, decimate_by=2, least=least)
    got = {r.raster_id: (r.p, r.score) for r in found.collect()}
    assert got.keys() == want.keys()
    for k in want:
        for a, b in zip(got[k], want[k], strict=True):
            assert (a is None) == (b is None), (k, got[k], want[k])
            assert a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (k, got[k], want[k])
    assert want[2][1] > 5 * want[1][1] and want[4][1] is None and want[7] == (None, None)


def test_small_frames_have_no_score(spark):
    pixels = spark.createDataFrame([(1, x, y, 1.0 + x * y) for x in range(64) for y in range(50)], "raster_id int, x int, y int, v double")
    assert raster.stripe_score(pixels).first().score is None

    def grids(ids, which, x, y, v):
        out = np.full((len(ids), 50, 64), np.nan)
        out[which, y, x] = v
        return out

    row = raster.measures(raster.as_rows(pixels), grids, decimate_by=1, least=1).first()
    assert row.score is None and row.p > 1


def test_pixels_by_raster_are_the_pixels(spark):
    own, dealt = fixtures.load(spark, SF, "pixels"), fixtures.load(spark, SF, "pixels", dealt_by="raster_id")
    assert own.exceptAll(dealt).isEmpty() and dealt.exceptAll(own).isEmpty()
    plan = raster.as_rows(dealt)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(raster_id") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_scores_of_frames_without_gaps_take_no_exchange(spark):
    """What follows the rasters' own pixels is narrow: no exchange holds the rasters without gaps."""
    plan = entry.queries()["dense_stripe_scores"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Scan parquet" in plan


def test_flags_of_frames_without_gaps(spark):
    """The flags are those of the same rasters as pixels, and come of one row for each raster."""
    pixels = fixtures.load(spark, SF, "pixels").localCheckpoint()
    means = {(r.x, r.y): r.m for r in pixels.groupBy("x", "y").agg(F.avg("v").alias("m")).collect()}
    whole = pixels.agg(F.avg("v")).first()[0]
    own = {}
    for r in pixels.collect():
        own.setdefault(r.raster_id, {})[r.x, r.y] = r.v
    stripe = lambda k, x, y: 0.2 * math.cos(2 * math.pi * (10 * x + 12 * y) / 64) if k % 3 == 0 else 0.0
    rows = [(k, x, y, 1 + v.get((x, y), means.get((x, y), whole)) + stripe(k, x, y)) for k, v in own.items() for x in range(64) for y in range(64)]
    want = network.flag_frames(spark.createDataFrame(rows, "raster_id int, x int, y int, v double"), {"p": (1.1, 0.05), "score": (1.2, 5.0)}, decimate_by=2, least=1)
    got = entry.queries()["flagged_striped_frames"](spark, SF)
    assert sorted(map(tuple, got.select("id", "reasons").collect())) == sorted(map(tuple, want.select("id", "reasons").collect())) and got.count()


def test_measuring_for_flags_stays_by_raster(spark, monkeypatch):
    plans = []
    flag = network.flag_measured
    monkeypatch.setattr(network, "flag_measured", lambda measured, rules: plans.append(measured._jdf.queryExecution().executedPlan().toString()) or flag(measured, rules))
    entry.queries()["flagged_striped_frames"](spark, SF)
    assert len(plans) == 1 and "Exchange" not in plans[0]
