"""What the third review found: queries at size, bins at their edges, tiles of wide extents."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from regolith.functions import geometry
from regolith.operators import raster, spatial, windows
from regolith.plans import fixtures, registry

SF = "/root/testdata/sf0.001"


def _convex(rng) -> list:
    """A convex ring, anticlockwise and closed."""
    n, (x, y), r = rng.integers(3, 8), rng.uniform(0, 4, 2), rng.uniform(0.5, 3)
    corners = [(float(x + r * math.cos(a)), float(y + r * math.sin(a))) for a in np.sort(rng.uniform(0, 2 * math.pi, n))]
    return [*corners, corners[0]]


def test_common_parts_in_batches_equal_the_expression(spark):
    rng = np.random.default_rng(3)
    boxes = [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)], [(2.0, 1.0), (4.0, 1.0), (4.0, 3.0), (2.0, 3.0), (2.0, 1.0)]]
    rings = [*((_convex(rng), _convex(rng)) for _ in range(200)), (boxes[0], boxes[1]), (boxes[0], boxes[0]), ([], boxes[0]), (boxes[0], []), (None, boxes[0])]
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(rings)], f"i int, a {geometry.RING}, b {geometry.RING}")
    found = spatial.with_common(rows, "a", "b", "common").filter("a IS NOT NULL")
    clip = geometry.clip(F.col("a"), F.col("b"))
    wrong = found.select("i", "common", "common_area", clip.alias("e"), geometry.area(clip).alias("f")).filter("common <> e OR common_area <> f").collect()
    assert wrong == [] and found.count() == len(rings) - 1


def test_number_of_circular_pairs(spark):
    values = [(f"p{i % 37}", None if i % 29 == 0 else float(i * i % 97) * 3.75) for i in range(200)] + [("p1", 1.01), ("p2", 3.01), ("p3", 359.5), ("p3", 359.5), (None, 3.0), ("p4", math.nan)]
    rows = spark.createDataFrame(values, "p string, a double")
    one = spatial.count_circular_pairs(rows, "p", "a", 2.0)
    assert one.first()["n"] == spatial.circular_pairs(rows, "p", "a", 2.0).count() > 0
    assert spatial.count_circular_pairs(rows.limit(0), "p", "a", 2.0).first()["n"] == 0


def test_quantiles_between_equal_neighbours(spark):
    for v, n in ((108.3, 10), (252.6, 15), (108.3, 90), (252.6, 90)):
        rows = spark.createDataFrame([(1, v)] * n, "g int, v double")
        shares = [i / 10 for i in range(11)]
        assert windows.exact_quantiles(rows, "v", shares) == [v] * 11
        assert windows.group_quantile(rows, "g", "v", 0.3, "q").first()["q"] == v


@pytest.mark.parametrize("name", ["tiles_by_width", "tiles_as_geojson"])
def test_tiles_of_a_wide_extent(spark, tmp_path, name):
    spark.createDataFrame([(1,), (40000,), (400000,)], "c_custkey bigint").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    mine = registry.queries()[name](spark, str(tmp_path)).toPandas()
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    theirs = duck.execute(registry.oracle_sql()[name]).df()[list(mine.columns)]
    rows = lambda df: sorted(map(tuple, df.astype(float).to_numpy().tolist()))
    assert mine["j"].max() > 100 and rows(mine) == rows(theirs)


def test_images_are_dealt(spark):
    assert fixtures.load(spark, SF, "images").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("of", [geometry.make_valid, geometry.area, geometry.centroid, geometry.min_rotated_rect, lambda r: geometry.area(geometry.clip(r, r)), lambda r: geometry.cells_of(r, 1.0)])
def test_a_ring_is_made_once(of):
    """However deep, an expression names what it is of no more than a few times, since Spark makes it again at each place."""
    assert str(of(F.col("a_ring"))).count("a_ring") <= 2


def test_arrays_of_tiles_are_no_larger_than_their_pixels(spark):
    places = spark.range(64).select(F.lit("a").alias("raster_id"), (F.col("id") % 8).cast("int").alias("x"), F.floor(F.col("id") / 8).cast("int").alias("y"), F.lit(1.0).alias("v"))
    sizes = raster.on_tiles(places, 32, lambda g: np.full(g.shape, g.size)).select("v").distinct().collect()
    assert [r["v"] for r in sizes] == [64.0]
    wide = places.union(places.withColumn("x", F.col("x") + 252)).distinct()
    kernel = lambda g: np.where(np.isnan(g), np.nan, raster.edge_distance(g, 4))
    one, many = (raster.on_tiles(wide, 4, kernel, tile).orderBy("x", "y").collect() for tile in (1024, 3))
    assert one == many and len(one) == 128


def test_stripes_of_whole_rasters_in_two_passes(spark):
    places = spark.range(64 * 64).select(F.lit(1).alias("raster_id"), (F.col("id") % 64).cast("int").alias("x"), F.floor(F.col("id") / 64).cast("int").alias("y"), (1 + F.rand(1)).alias("v"))
    assert raster.stripe_score(places)._jdf.queryExecution().optimizedPlan().toString().count("Range (") <= 3
