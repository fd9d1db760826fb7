"""Pixels: what a task groups doesn't grow with the table."""

import pytest
from pyspark.sql import functions as F

from regolith import session
from regolith.operators import raster
from regolith.plans import fixtures, registry

SF = "/root/testdata/sf0.001"


def test_tasks_grow_with_the_rows(spark):
    rows, cores = spark.range(1000), spark.sparkContext.defaultParallelism
    assert session.tasks_for(rows, 10) == 100 and session.tasks_for(rows, 333) == 4 and session.tasks_for(rows, 10_000) == cores == 4


def test_pixels_are_grouped_where_they_are_dealt(spark):
    plan = fixtures.load(spark, SF, "pixels")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "partial_max" in plan and plan.count("hashpartitioning(raster_id") == 1


@pytest.mark.parametrize("chunk,split", [(3, 5), (2, 4), (7, 1)])
def test_levels_without_copies_of_every_row(spark, chunk, split):
    pixels = fixtures.load(spark, SF, "pixels").withColumn("v", F.when(F.col("x") % 7 == 0, F.lit(raster.NODATA)).otherwise(F.col("v")))
    positions = pixels.select("raster_id").distinct().withColumn("pos", F.col("raster_id").cast("long"))
    found = raster.chunked_max_lit(pixels, positions, chunk, split)
    want = raster._levels(pixels, positions, chunk, split).groupBy("level", "part", "x", "y").agg(F.max("v").alias("v"))
    assert found.columns == want.columns and found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
    assert "Expand" not in found._jdf.queryExecution().toString() and "Generate" not in found._jdf.queryExecution().toString()


def test_pixels_are_grouped_once_for_pruned_mosaics(spark):
    """What reads the mosaics reads no given table, and no row is copied for each level."""
    found = registry.queries()["pruned_mosaics"](spark, SF)
    plan = found._jdf.queryExecution().toString()
    assert "lineitem" not in plan and "Generate" not in plan and "Expand" not in plan


def test_chunks_that_lose_nothing_are_taken_over(spark):
    pixels = fixtures.load(spark, SF, "pixels")
    positions = pixels.select("raster_id").distinct().withColumn("pos", F.col("raster_id").cast("long"))
    before = raster.chunked_max_lit(pixels, positions, 3, 5)
    marked = before.withColumn("v", F.when(F.expr("level = 'chunk' AND part = 0"), 7.0).when(F.expr("level = 'chunk'"), 9.0).otherwise(F.col("v")))
    now = raster.prune_and_remosaic(marked, pixels, positions, positions.filter("raster_id >= 3"), 3, 5)
    places = before.filter("level = 'chunk' AND part = 0").count()
    assert {(r.level, r.part, r.v, r.n) for r in now.groupBy("level", "part", "v").agg(F.count("*").alias("n")).collect()} == {("chunk", 0, 7.0, places), ("half", 0, 7.0, places), ("all", 0, 7.0, places)}
