"""Further queries over the image tables: sets, scalar functions, geometry, graphs, coverage and rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regolith.functions import angles, geometry, ids
from regolith.operators import aggregates, coverage, filters, graph, joins, lists, ordering, raster, spatial
from regolith.plans import cover as cover_plan
from regolith.plans import network
from regolith.plans.registry import _AZIMUTH, _SETS, _WALK, Load, _bounded, _sets, query, rounded

# Filters, joins, lists.


@query("images", sql="SELECT product_id FROM images WHERE abs(x0 - 9000) <= 2500")
def small_differences(t: Load) -> DataFrame:
    return filters.dem_diff_filter(t("images").withColumn("mean", F.col("x0") - 9000), "mean", 2500).select("product_id")


@query("images", sql="SELECT product_id FROM images WHERE resolution < 2.5 AND k % 41 <> 0")
def gsd_below(t: Load) -> DataFrame:
    return filters.gsd_below(t("images").withColumn("gsd", F.when(F.col("k") % 41 == 0, float("nan")).otherwise(F.col("resolution"))), 2.5).select("product_id")


_LINKS = ", li AS (SELECT a.product_id AS src, b.product_id AS dst FROM edges e JOIN images a ON a.k = e.src JOIN images b ON b.k = e.dst)" + _WALK.format("li")
_LIT = _LINKS + ", big AS (SELECT component FROM comp GROUP BY 1 ORDER BY count(*) DESC, component LIMIT 1) "


def _ranks(t: Load) -> DataFrame:
    name = lambda c: t("images").select(F.col("k").alias(c), F.col("product_id").alias(c + "_id"))
    linked = t("edges").join(name("src"), "src").join(name("dst"), "dst").select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"))
    return graph.component_ranks(graph.connected_components(linked))


@query("images", "edges", sql=_LIT + "SELECT product_id FROM images JOIN comp ON id = product_id WHERE component IN (SELECT component FROM big)")
def in_largest_component(t: Load) -> DataFrame:
    return joins.keep_component(t("images"), _ranks(t), 0).select("product_id")


@query("images", "edges", "registered_ids", sql=_LIT + """SELECT product_id FROM images JOIN comp ON id = product_id WHERE component IN (SELECT component FROM big)
 AND product_id NOT IN (SELECT product_id FROM registered_ids) AND x0 <= 18000 AND x1 >= 2000 AND y0 <= 18000 AND y1 >= 2000 AND roi_sub_solar_ground_azimuth >= 10 AND roi_sub_solar_ground_azimuth < 340""")
def lit_select(t: Load) -> DataFrame:
    listed = t("registered_ids").withColumnRenamed("product_id", "value")
    return coverage.lit_select(t("images"), _ranks(t), 0, listed, (2000, 2000, 18000, 18000), (10, 340)).select("product_id")


@query("images", sql="""SELECT 'run/' || product_id || '__' || left(product_id, 10) || 'RE-DEM.tif' AS file FROM images WHERE k % 2 = 0 AND abs(x0 - 9000) <= 5000 AND slew_angle <= 10""")
def downselected_dems(t: Load) -> DataFrame:
    pair = F.concat(F.lit("run/"), "product_id", F.lit("__"), F.substring("product_id", 1, 10), F.lit("RE-diff.tif"))
    files = t("images").filter("k % 2 = 0").select(pair.alias("file"), (F.col("x0") - 9000).alias("diff"), F.col("slew_angle").alias("error"))
    return network.downselect_dems(files.select("file"), files.withColumn("mean", F.col("diff")), files.withColumn("mean", F.col("error")), 10.0, 5000.0)


@query("images", sql="SELECT product_id FROM images ORDER BY x0 DESC, k DESC LIMIT 20")
def first_pairs_in_order(t: Load) -> DataFrame:
    return lists.order_pairs(t("images").select("product_id", F.col("x0").alias("roi_overlap_percent"), F.col("k").alias("overlap_percent"))).limit(20).select("product_id")


@query("images", sql="SELECT product_id FROM images ORDER BY (k * 37) % 1000003, k LIMIT 20")
def first_by_azimuth(t: Load) -> DataFrame:
    return lists.sort_by_azimuth(t("images").withColumn("a", F.col("k") * 37 % 1000003 + F.col("k") / 1e9), "a").limit(20).select("product_id")


@query("images", sql="SELECT product_id FROM images ORDER BY product_id LIMIT 30")
def capped_products(t: Load) -> DataFrame:
    return lists.cap_products(t("images"), 30, "product_id").select("product_id")


@query("images", "registered_ids", sql=_SETS + """SELECT NOT EXISTS (SELECT v FROM a EXCEPT SELECT v FROM b) AS subset, NOT EXISTS (SELECT v FROM b EXCEPT SELECT v FROM a) AS superset,
 NOT EXISTS (SELECT v FROM a INTERSECT SELECT v FROM b) AS disjoint, NOT EXISTS (SELECT v FROM a EXCEPT SELECT v FROM b) AND NOT EXISTS (SELECT v FROM b EXCEPT SELECT v FROM a) AS equal, true AS both_in_union""")
def set_relations(t: Load) -> DataFrame:
    a, b = _sets(t)
    both = a.union(b)
    told = {"subset": a.issubset(b), "superset": a.issuperset(b), "disjoint": a.isdisjoint(b), "equal": a.isequal(b), "both_in_union": a.issubset(both) and both.issuperset(b)}
    return t("images").sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in told.items()])


@query("images", "registered_ids", sql="SELECT product_id FROM images UNION ALL SELECT product_id FROM registered_ids")
def appended(t: Load) -> DataFrame:
    return lists.append(t("images").select("product_id"), t("registered_ids"))


# Scalar functions and geometry.

_ANGLE = "least(fmod(abs(a - 90), 360), 360 - fmod(abs(a - 90), 360))"


@query("images", sql=f""", w AS (SELECT *, roi_sub_solar_ground_azimuth AS a FROM images)
SELECT product_id, {_bounded('incidence_angle', 60.0, 60.0, 40.0, 90.0)} AS ideal, round(fmod(a + 350, 360), 6) AS azimuth,
 round(acos(greatest(-1, least(1, cos(radians(emission_angle)) * cos(radians(a)) * cos(radians(20)) * cos(radians(30)) + cos(radians(emission_angle)) * sin(radians(a)) * cos(radians(20)) * sin(radians(30)) + sin(radians(emission_angle)) * sin(radians(20))))), 6) AS apart,
 CAST(CASE WHEN {_ANGLE} - 2.5 <= 0 THEN 0.7 WHEN {_ANGLE} - 2.5 <= 2 THEN least(0.005, 0.7 * (1 - ({_ANGLE} - 2.5) / 2)) ELSE 0.005 END AS DOUBLE) AS opacity,
 round(greatest(center_latitude - degrees(10 / 1737.4), -90), 6) AS south, round(center_longitude - degrees(10 / 1737.4) / greatest(0.01, cos(radians(abs(center_latitude)))), 5) AS west FROM w""")
def more_angles(t: Load) -> DataFrame:
    c, a = F.col, F.col("roi_sub_solar_ground_azimuth")
    west, south, _, _ = angles.expand_bbox(c("center_longitude"), c("center_latitude"), c("center_longitude"), c("center_latitude"), 10.0)
    return t("images").select(
        "product_id", F.round(angles.quality_ideal(c("incidence_angle"), 60.0, 40.0, 90.0), 6).alias("ideal"), F.round(angles.normalize_azimuth(a - 10), 6).alias("azimuth"),
        F.round(angles.angular_distance(a, c("emission_angle"), F.lit(30.0), F.lit(20.0)), 6).alias("apart"), angles.opacity(a, F.lit(90.0)).alias("opacity"), F.round(south, 6).alias("south"), F.round(west, 5).alias("west"),
    )


@query("images", sql="SELECT product_id, CASE WHEN k % 2 = 0 THEN product_id ELSE 'M' || k END AS id FROM images")
def archive_ids(t: Load) -> DataFrame:
    label = F.when(F.col("k") % 2 == 0, F.concat(F.lower("product_id"), F.lit(".xml")))
    return t("images").select("product_id", ids.product_id_from_archive(label, F.concat(F.lit("nac.m"), F.col("k").cast("string"))).alias("id"))


@query("images", sql="SELECT product_id, CAST(CASE WHEN k % 5 > 0 THEN 5 ELSE 0 END AS INT) AS n, CASE WHEN k % 5 > 0 THEN round((x1 - x0) * (y1 - y0), 6) ELSE 0 END AS area FROM images")
def valid_rings(t: Load) -> DataFrame:
    """Rings that are open, run clockwise and repeat a point; every fifth has two points only."""
    p = [geometry.point(F.col(x), F.col(y)) for x, y in (("x0", "y0"), ("x0", "y1"), ("x0", "y1"), ("x1", "y1"), ("x1", "y0"))]
    ring = geometry.make_valid(F.when(F.col("k") % 5 > 0, F.array(*p)).otherwise(F.array(p[0], p[1])))
    return t("images").select("product_id", F.when(ring.isNotNull(), geometry.num_points(ring)).otherwise(0).alias("n"), F.when(ring.isNotNull(), F.round(geometry.signed_area(ring), 6)).otherwise(0.0).alias("area"))


@query("images", sql="""SELECT product_id, round(2 * 1737400 * cos(radians(center_latitude)) * sin(radians(center_longitude)) / (1 - sin(radians(center_latitude))), 3) + 0.0 AS x,
 round(2 * 1737400 * cos(radians(center_latitude)) * cos(radians(center_longitude)) / (1 - sin(radians(center_latitude))), 3) + 0.0 AS y FROM images""")
def polar_coordinates(t: Load) -> DataFrame:
    x, y = geometry.to_polar_stereographic(F.col("center_longitude"), F.col("center_latitude"), -90.0, 0.0)
    return t("images").select("product_id", (F.round(x, 3) + 0.0).alias("x"), (F.round(y, 3) + 0.0).alias("y"))


@query("images", sql="," + _AZIMUTH.strip().rsplit("\nSELECT", 1)[0] + """, az AS (SELECT product_id, round(CASE WHEN s > g THEN CASE WHEN glat < 0 THEN 180 - z ELSE z END ELSE CASE WHEN glat < 0 THEN 180 + z ELSE 360 - z END END, 4) AS azimuth FROM z)
SELECT product_id, azimuth, round(CASE WHEN center_longitude > 180 THEN center_longitude - 360 ELSE center_longitude END, 6) AS lon, CAST(5 AS INT) AS corners, round((x1 - x0) / 1000 * (y1 - y0) / 1000, 6) AS area FROM images JOIN az USING (product_id)""")
def prepared_index(t: Load) -> DataFrame:
    corners = {"lower_left": ("x0", "y0"), "lower_right": ("x1", "y0"), "upper_right": ("x1", "y1"), "upper_left": ("x0", "y1")}
    rows = t("images").withColumns({f"{p}_{n}": F.col(c) / 1000 for p, (x, y) in corners.items() for n, c in (("longitude", x), ("latitude", y))})
    out = cover_plan.prep_index(rows)
    return out.select("product_id", F.round("sub_solar_ground_azimuth", 4).alias("azimuth"), F.round("center_longitude", 6).alias("lon"), F.size("ring").alias("corners"), F.round(geometry.area(F.col("ring")), 6).alias("area"))


# Graphs, orders, coverage.


@query("edges", sql=_WALK.format("edges") + ", d(id, n) AS (SELECT 15, 0 UNION SELECT b, n + 1 FROM d JOIN sym ON id = a WHERE n < 14) SELECT coalesce(min(n) + 1, 0) AS n FROM d WHERE id = 29")
def shortest_path_length(t: Load) -> DataFrame:
    return graph.shortest_path(t("edges"), 15, 29, 14).agg(F.count(F.lit(1)).alias("n"))


@query("images", sql="SELECT count(*) AS n FROM images a JOIN images b ON a.product_id < b.product_id AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1")
def meeting_pairs(t: Load) -> DataFrame:
    return ordering.intersection_pairs(t("images")).agg(F.count(F.lit(1)).alias("n"))


@query("images")
def degree_order(t: Load) -> DataFrame:
    return ordering.ordered_groups(t("images").withColumn("g", F.floor(F.col("k") / 100)), "g", "degree").select("product_id", "g", "place")


@query("images", sql=""", c AS (SELECT product_id, resolution, unnest(range(CAST(ceil(x0 / 2000 - 0.5) AS BIGINT), CAST(ceil(x1 / 2000 - 0.5) AS BIGINT))) AS i, y0, y1 FROM images),
 e AS (SELECT product_id, resolution, i, unnest(range(CAST(ceil(y0 / 2000 - 0.5) AS BIGINT), CAST(ceil(y1 / 2000 - 0.5) AS BIGINT))) AS j FROM c), f AS (SELECT DISTINCT i, j FROM e WHERE resolution <= 1.0)
SELECT product_id FROM images WHERE resolution <= 5.5 OR product_id IN (SELECT product_id FROM e WHERE (i, j) NOT IN (SELECT (i, j) FROM f))""")
def gsd_guard(t: Load) -> DataFrame:
    return coverage.gsd_guard(t("images"), coverage.box_cells(t("images"), 2000.0), 1.0, 5.5).select("product_id")


@query("pixels")
def full_site(t: Load) -> DataFrame:
    azimuths = t("pixels").select("raster_id").distinct().withColumn("azimuth", (F.col("raster_id") * 37 % 360).cast("double"))
    return coverage.select_full_site(t("pixels"), azimuths, 0.05)


@query("pair_stats", "residual_stats", sql=""", good AS (SELECT image FROM residual_stats WHERE cnt > 0 AND median <= 1.25 AND cnt >= 1), net AS (SELECT * FROM pair_stats WHERE num >= 30 AND l_image IN (SELECT image FROM good) AND r_image IN (SELECT image FROM good)),
 ne AS (SELECT split_part(split_part(l_image, '/', 2), '.', 1) AS src, split_part(split_part(r_image, '/', 2), '.', 1) AS dst FROM net)
SELECT id, count(*) AS degree FROM (SELECT src AS id FROM ne UNION ALL SELECT dst FROM ne) GROUP BY 1""")
def inspected_degrees(t: Load) -> DataFrame:
    return network.inspect_network(t("pair_stats"), t("residual_stats"), min_matches=30)["degrees"]


# Rasters.

_SMALL = ", small AS (SELECT raster_id, CAST(floor(x / 8) AS INT) AS x, CAST(floor(y / 8) AS INT) AS y, avg(v) AS v FROM pixels GROUP BY 1, 2, 3)\n"


def _small(t: Load) -> DataFrame:
    return raster.downsample(t("pixels"))


@query("pixels", sql=_SMALL + ", o AS (SELECT a.raster_id, a.x, a.y, b.x - a.x AS ox, b.y - a.y AS oy, b.v FROM small a JOIN small b ON a.raster_id = b.raster_id AND abs(a.x - b.x) <= 3 AND abs(a.y - b.y) <= 3) SELECT raster_id, x, y, round(sum(exp(-0.5 * (ox * ox + oy * oy)) * v) / sum(exp(-0.5 * (ox * ox + oy * oy))), 6) AS v FROM o GROUP BY 1, 2, 3")
def blurred(t: Load) -> DataFrame:
    return raster.gaussian_blur(_small(t), 1.0).select("raster_id", "x", "y", *rounded("v"))


_SHADE = _SMALL + """, o AS (SELECT a.raster_id, a.x, a.y, b.x - a.x AS ox, b.y - a.y AS oy, 100 * b.v AS v FROM small a JOIN small b ON a.raster_id = b.raster_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
 g AS (SELECT raster_id, x, y, sum(sign(ox) * (2 - abs(oy)) * v) / 8 AS dx, sum(sign(oy) * (2 - abs(ox)) * v) / 8 AS dy FROM o GROUP BY 1, 2, 3 HAVING count(*) = 9),
 s AS (SELECT *, atan(sqrt(dx * dx + dy * dy)) AS slope, atan2(dy, -dx) AS aspect FROM g)
"""
_LIGHT = "greatest(0, least(255, 255 * (sin(radians(45)) * cos(slope) + cos(radians(45)) * sin(slope) * cos(radians({0}) - aspect))))"


def _dem(t: Load) -> DataFrame:
    return _small(t).withColumn("v", 100 * F.col("v"))


@query("pixels", sql=_SHADE + f"SELECT raster_id, x, y, round({_LIGHT.format('360 - 300 + 90')}, 5) AS v FROM s")
def hillshade(t: Load) -> DataFrame:
    return raster.hillshade(_dem(t), 300.0).filter(F.col("v").isNotNull()).select("raster_id", "x", "y", F.round("v", 5).alias("v"))


@query("pixels", sql=_SHADE + f", m AS (SELECT a AS azimuth, avg({_LIGHT.format('360 - a + 90')}) AS m FROM s, range(0, 360, 45) t(a) GROUP BY 1) SELECT CAST(arg_max(azimuth, (m, -azimuth)) AS DOUBLE) AS azimuth FROM m")
def best_azimuth(t: Load) -> DataFrame:
    return raster.best_azimuth(_dem(t))


@query("pixels", sql=""", kept AS (SELECT * FROM pixels WHERE v > 0.02), cell AS (SELECT raster_id, CAST(floor(x / 8) AS INT) AS x, CAST(floor(y / 8) AS INT) AS y FROM kept GROUP BY 1, 2, 3),
 gap AS (SELECT raster_id, i, j FROM (SELECT DISTINCT raster_id FROM cell), range(-1, 9) t(i), range(-1, 9) u(j) WHERE (raster_id, i, j) NOT IN (SELECT (raster_id, x, y) FROM cell))
SELECT raster_id, x, y, round(least(min(abs(x - i) + abs(y - j)), 4) / 4.0, 6)::DOUBLE AS v FROM cell JOIN gap USING (raster_id) GROUP BY 1, 2, 3""")
def edge_distance(t: Load) -> DataFrame:
    return raster.edge_distance_weight(raster.downsample(t("pixels").filter("v > 0.02")), 4).select("raster_id", "x", "y", *rounded("v"))


@query("pixels", sql="SELECT raster_id, x, y, CASE WHEN v > 0.02 THEN v ELSE -1e6 END::DOUBLE AS dx, CASE WHEN v > 0.02 THEN v / 2 ELSE -1e6 END::DOUBLE AS dy FROM pixels")
def disparity_bands(t: Load) -> DataFrame:
    bands = t("pixels").select("raster_id", "x", "y", F.col("v").cast("double").alias("dx"), (F.col("v").cast("double") / 2).alias("dy"), F.when(F.col("v") > 0.02, 1).otherwise(0).alias("valid"))
    return raster.extract_disparity(bands).select("raster_id", "x", "y", "dx", "dy")


@query("pixels", sql=""", d AS (SELECT x * 1.0::DOUBLE AS dx, y * 2.0::DOUBLE AS dy FROM pixels WHERE v > 0.02), m AS (SELECT median(dx) AS mx, median(dy) AS my FROM d)
SELECT any_value(mx) AS dx_median, any_value(my) AS dy_median, median(abs(dx - mx)) AS dx_mad, median(abs(dy - my)) AS dy_mad, greatest(median(abs(dx - mx)), median(abs(dy - my))) < 0.25 * sqrt(any_value(mx) ** 2 + any_value(my) ** 2) AS uniform FROM d, m""")
def disparity_summary(t: Load) -> DataFrame:
    return raster.disparity_summary(t("pixels").select(F.col("x").cast("double").alias("dx"), (F.col("y") * 2.0).alias("dy"), F.when(F.col("v") > 0.02, 1).otherwise(0).alias("valid")))


@query("pixels", sql="SELECT min(v) AS min_v, max(v) AS max_v FROM pixels")
def color_scale(t: Load) -> DataFrame:
    return raster.color_stretch_scale(t("pixels"))


@query("pixels", sql="SELECT raster_id, max(CASE WHEN raster_id % 2 = 0 THEN 1 ELSE 0 END) = 1 AS ok FROM pixels GROUP BY 1")
def raster_validity(t: Load) -> DataFrame:
    return raster.validity_check(t("pixels").withColumn("v", F.when(F.col("raster_id") % 2 == 0, F.col("v"))))


_EXTENT = ", b AS (SELECT min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM images)"


@query("images", sql=_EXTENT + """, w AS (SELECT *, ceil((x1 - x0) / 6) + 0.5 AS s FROM b)
SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, x0 + i * s AS minx, y1 - j * s AS maxy, x0 + i * s + s AS maxx FROM w, range(0, 1000) t(i), range(0, 1000) u(j) WHERE x0 + i * s < x1 AND y1 - j * s > y0""")
def tiles_by_count(t: Load) -> DataFrame:
    return raster.tiles_by_count(aggregates.extent(t("images")), 6).select("i", "j", "minx", "maxy", "maxx")


@query("images", sql=_EXTENT + "SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, x0 + i * 4500 AS minx, y1 - j * 4500 AS maxy, x0 + i * 4500 + 5000 AS maxx FROM b, range(0, 1000) t(i), range(0, 1000) u(j) WHERE x0 + i * 4500 < x1 AND y1 - j * 4500 > y0")
def tiles_with_overlap(t: Load) -> DataFrame:
    return raster.tiles_with_overlap(aggregates.extent(t("images")), 5000, 500).select("i", "j", "minx", "maxy", "maxx")


@query("images", sql="""SELECT product_id, CAST(10001 + i * 4 + j AS INT) AS tile, CAST(greatest(i * w - 10, 0) AS INT) AS x0, CAST(least((i + 1) * w + 10, x) AS INT) AS x1, CAST(greatest(j * h - 10, 0) AS INT) AS y0, CAST(least((j + 1) * h + 10, y) AS INT) AS y1
 FROM (SELECT product_id, 1000 + k % 7 * 3 AS x, 2000 + k % 3 * 4 AS y, (1000 + k % 7 * 3) // 3 AS w, (2000 + k % 3 * 4) // 4 AS h FROM images), range(0, 3) t(i), range(0, 4) u(j)""")
def padded_tiles(t: Load) -> DataFrame:
    sizes = t("images").select("product_id", (1000 + F.col("k") % 7 * 3).cast("int").alias("size_x"), (2000 + F.col("k") % 3 * 4).cast("int").alias("size_y"))
    kinds = sizes.select("size_x", "size_y").distinct()
    out = None
    for r in kinds.collect():  # 21 at most
        one = sizes.filter((F.col("size_x") == r["size_x"]) & (F.col("size_y") == r["size_y"]))
        tiles = raster.padded_tiles(one.select("size_x", "size_y").limit(1), 340, 500, 10)
        part = one.select("product_id").crossJoin(F.broadcast(tiles))
        out = part if out is None else out.unionAll(part)
    return out.select("product_id", *[F.col(c).cast("int").alias(c) for c in ("tile", "x0", "x1", "y0", "y1")])


@query("pixels")
def stripe_scores(t: Load) -> DataFrame:
    dense = t("pixels").withColumn("v", F.col("v") + 0.1)
    return raster.stripe_score(dense)


@query("pixels", sql=""", p AS (SELECT raster_id, quantile_cont(v, 0.999) AS p FROM pixels WHERE v > 1e-6 AND x % 2 = 0 AND y % 2 = 0 GROUP BY 1), m AS (SELECT median(p) AS m FROM p)
SELECT raster_id AS id, 'p' AS reasons FROM p, m WHERE p > greatest(0.99 * m, 0.05)""")
def flagged_frames(t: Load) -> DataFrame:
    return network.flag_frames(t("pixels"), {"p": (0.99, 0.05), "score": (3.0, 10.0)}, decimate_by=2, least=1)


_BLEND = """, top AS (SELECT x, y, max(v) AS v, avg(v) AS m FROM pixels GROUP BY 1, 2), dark AS (SELECT x, y, x * 1000 + y AS id FROM top WHERE v <= 0.02),
 near AS (SELECT a.id AS a, b.id AS b FROM dark a JOIN dark b ON abs(a.x - b.x) + abs(a.y - b.y) <= 1), part(id, root) AS (SELECT id, id FROM dark UNION SELECT near.b, part.root FROM part JOIN near ON near.a = part.id),
 named AS (SELECT id, min(root) AS root FROM part GROUP BY 1), large AS (SELECT root FROM named GROUP BY 1 HAVING count(*) >= 2), shadow AS (SELECT x, y FROM dark JOIN named USING (id) WHERE root IN (SELECT root FROM large)),
 gap AS (SELECT a.i AS x, b.j AS y FROM range(-1, 65) a(i), range(-1, 65) b(j) WHERE (a.i, b.j) NOT IN (SELECT (x, y) FROM top) UNION SELECT x, y FROM shadow),
 far AS (SELECT top.x, top.y, least(min(abs(top.x - gap.x) + abs(top.y - gap.y)), 4) / 4.0::DOUBLE AS w FROM top, gap GROUP BY 1, 2)
"""


@query("pixels", sql=_BLEND + "SELECT x, y, round(w * (100 * v + x) + (1 - w) * (50 * m - y), 6) AS v FROM top JOIN far USING (x, y)")
def blended_to_reference(t: Load) -> DataFrame:
    """A model of heights over a reference, both made of the images, where the brightest image is lit."""
    places = t("pixels").groupBy("x", "y").agg(F.max("v").cast("double").alias("v"), F.avg("v").alias("m"))
    reference, model = places.select("x", "y", (50 * F.col("m") - F.col("y")).alias("v")), places.select("x", "y", (100 * F.col("v") + F.col("x")).alias("v"))
    return raster.blend_to_reference(reference, model, places.select("x", "y", "v"), 0.02, 4, 2).select("x", "y", *rounded("v"))
