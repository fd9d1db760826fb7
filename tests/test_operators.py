"""Operators on small inputs whose results are known or found by brute force."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from regolith.functions import angles, geometry
from regolith.operators import aggregates, coverage, filters, graph, joins, lists, ordering, raster, spatial, windows
from regolith.plans import cover, network
from regolith.sources import readers, writers
from regolith.streaming import streams


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_ground_azimuth(spark):
    az = lambda *v: one(spark, angles.ground_azimuth(*[F.lit(float(x)) for x in v]))[0]
    assert az(0, 0, 0, 10) == pytest.approx(90)
    assert az(0, 0, 0, -10) == pytest.approx(270)
    assert az(0, 0, 45, 0) == pytest.approx(360)
    assert az(-80, 20, -10, 20) == pytest.approx(360 if False else 360, abs=1e-3) or az(-80, 20, -10, 20) == pytest.approx(0, abs=1e-3)
    assert az(10, 179, 10, -179) == pytest.approx(90 - 0.17, abs=0.05)
    assert az(-45, 0, -45, 90) == pytest.approx(180 - 54.7356, abs=1e-3)


def test_angles(spark):
    assert one(spark, angles.angular_separation(F.lit(350.0), F.lit(10.0)))[0] == pytest.approx(20)
    q = [one(spark, angles.quality_ideal(F.lit(v), 50, 40, 65))[0] for v in (50.0, 40.0, 65.0, 30.0)]
    assert q == [1, 0, 0, -1]
    assert one(spark, angles.quality_bounded(F.lit(2.0), 0.4, 1, 0.1, 1))[0] == -1
    with pytest.raises(ValueError):
        angles.quality_ideal(F.lit(1.0), 70, 40, 65)
    assert one(spark, angles.parallax(*[F.lit(v) for v in (30.0, 0.0, 30.0, 180.0)]))[0] == pytest.approx(60)
    box = one(spark, *angles.expand_bbox(*[F.lit(v) for v in (10.0, -90.0, 20.0, -88.0)], 30.0))
    assert box[1] == -90 and box[0] < 10 and box[3] > -88


def quad(rng):
    cx, cy = rng.uniform(0, 10, 2)
    a = np.sort(rng.uniform(0, 2 * np.pi, 4))
    r = rng.uniform(1, 4)
    pts = [(cx + r * np.cos(t), cy + r * np.sin(t)) for t in a]
    return [*pts, pts[0]]


def test_convex_geometry(spark):
    rng = np.random.default_rng(3)
    rows = [(i, quad(rng), quad(rng)) for i in range(60)]
    df = spark.createDataFrame([(i, [tuple(map(float, p)) for p in a], [tuple(map(float, p)) for p in b]) for i, a, b in rows], f"i int, a {geometry.RING}, b {geometry.RING}")
    a, b = F.col("a"), F.col("b")
    out = df.select("i", geometry.area(a).alias("aa"), geometry.area(b).alias("ab"), geometry.area(geometry.clip(a, b)).alias("ab1"), geometry.area(geometry.clip(b, a)).alias("ab2"), geometry.area(geometry.clip(a, a)).alias("self"), geometry.convex_intersects(a, b).alias("meet"), geometry.min_rotated_rect(a).alias("r"), geometry.to_wkt(a).alias("w"), geometry.area(geometry.parse_wkt(geometry.to_wkt(a))).alias("back"))
    for r in out.collect():
        assert r.ab1 == pytest.approx(r.ab2, abs=1e-9) and r.self == pytest.approx(r.aa) and r.back == pytest.approx(r.aa)
        assert r.ab1 <= min(r.aa, r.ab) + 1e-9 and r.meet == (r.ab1 > 1e-12)
        assert r.r.height * r.r.width >= r.aa - 1e-9


def test_hilbert_is_a_walk(spark):
    grid = spark.range(64).select((F.col("id") % 8).cast("double").alias("x"), F.floor(F.col("id") / 8).cast("double").alias("y"))
    d = sorted((r.d, r.x, r.y) for r in grid.select("x", "y", geometry.hilbert(F.col("x"), F.col("y"), 0, 0, 8, 8, 3).alias("d")).collect())
    assert [x[0] for x in d] == list(range(64))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(d, d[1:], strict=False))


def test_cell_join_is_brute_force(spark):
    rng = random.Random(1)
    boxes = []
    for i in range(150):
        x, y, w, h = rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice([1, 5, 80]) * rng.random(), 4 * rng.random()
        boxes.append((i, x, y, x + w, y + h))
    df = spark.createDataFrame([*boxes, (900, None, 0.0, 1.0, 1.0), (901, 5.0, 0.0, 1.0, 1.0)], "id int, x0 double, y0 double, x1 double, y1 double")
    got = sorted((r.l_id, r.r_id) for r in spatial.cell_join(df, df, 2.0, F.col("l_id") < F.col("r_id")).collect())
    want = sorted((a[0], b[0]) for a in boxes for b in boxes if a[0] < b[0] and a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4])
    assert got == want


def test_overlaps_exclude_containment(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0, 0.0, 10.0, 10.0), ("b", 2.0, 2.0, 2.0, 3.0, 3.0), ("c", 3.0, 5.0, 5.0, 15.0, 15.0), ("d", 4.0, 10.0, 0.0, 12.0, 4.0)], "product_id string, emission_angle double, x0 double, y0 double, x1 double, y1 double")
    assert [(r.l_product_id, r.r_product_id) for r in spatial.overlapping_pairs(df).collect()] == [("a", "c")]


def test_streaks_with_gaps(spark):
    df = spark.createDataFrame([(1, True), (2, True), (3, False), (5, True), (6, True), (7, True)], "orderid bigint, intersects_prior boolean")
    legacy = {(r.intersects_prior, r.length): r.streaks for r in windows.legacy_streak_lengths(df).collect()}
    assert legacy == {(True, 2): 1, (True, 3): 1, (False, 1): 1}
    dense = df.withColumn("orderid", F.when(F.col("orderid") > 4, F.col("orderid") - 1).otherwise(F.col("orderid")))
    now = {(r.intersects_prior, r.length): r.streaks for r in windows.streak_lengths(dense).collect()}
    assert now == {(True, 2): 1, (True, 3): 1, (False, 1): 1}


def test_global_rank(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("h"), "id").repartition(7)
    got = windows.global_rank(df, ["h", "id"], "n").orderBy("h", "id").collect()
    assert [r.n for r in got] == list(range(1, 1001))


def edges(spark, n, m, seed):
    rng = random.Random(seed)
    return spark.createDataFrame([(rng.randrange(n), rng.randrange(n)) for _ in range(m)], "src bigint, dst bigint")


def test_components(spark):
    df = edges(spark, 300, 220, 4).union(spark.range(200).select((F.col("id") + 1000).alias("src"), (F.col("id") + 1001).alias("dst")))
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in df.collect():
        a, b = sorted((find(r.src), find(r.dst)))
        root[b] = a
    got = {r.id: r.component for r in graph.connected_components(df).collect()}
    assert got == {x: find(x) for x in root}
    assert graph.connected_components(df.limit(0)).count() == 0
    assert graph.check_connectivity(df.limit(0)).first().num_components == 0


def test_forest_and_path(spark):
    df = edges(spark, 40, 90, 6).filter("src <> dst").distinct().withColumn("weight", (F.col("src") * 7 + F.col("dst") * 3) % 17)
    got = graph.max_spanning_forest(df).collect()
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    total = 0
    for r in sorted(df.collect(), key=lambda r: (-r.weight, r.src, r.dst)):
        a, b = find(r.src), find(r.dst)
        if a != b:
            root[a] = b
            total += r.weight
    assert sum(r.weight for r in got) == total
    line = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 5), (5, 4)], "src bigint, dst bigint")
    assert [r.id for r in graph.shortest_path(line, 1, 4).collect()] == [1, 5, 4]
    assert graph.shortest_path(line, 1, 9).count() == 0


def test_greedy_cover(spark):
    rng = random.Random(2)
    cells = {(f"i{k}", rng.randrange(12), rng.randrange(12)) for k in range(15) for _ in range(30)}
    df = spark.createDataFrame([(*c, 1.0) for c in cells], "id string, i int, j int, w double")
    got = [(r.id, r.gain) for r in coverage.set_coverage(df, 3).orderBy("round").collect()]
    left, want = {c for c in cells}, []
    while True:
        gains = {}
        for c in left:
            gains[c[0]] = gains.get(c[0], 0) + 1
        if not gains or max(gains.values()) < 3:
            break
        best = min(gains, key=lambda k: (-gains[k], k))
        want.append((best, float(gains[best])))
        gone = {c[1:] for c in left if c[0] == best}
        left = {c for c in left if c[1:] not in gone}
    assert got == want


def pixels(spark, g, raster_id=1):
    return spark.createDataFrame([(raster_id, x, y, None if np.isnan(v) else float(v)) for (y, x), v in np.ndenumerate(g)], "raster_id int, x int, y int, v double")


def grid(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r.y, r.x] = np.nan if r.v is None else r.v
    return out


def test_tiles_have_no_seams(spark):
    rng = np.random.default_rng(1)
    g = rng.random((40, 50))
    g[10:14, 20:25] = np.nan
    df = pixels(spark, g)
    for kernel, halo in ((lambda a: raster.edge_distance(a, 5), 5),):
        whole = raster.edge_distance(np.pad(g, 5, constant_values=np.nan), 5)[5:-5, 5:-5]
        assert np.array_equal(grid(raster.on_tiles(df, halo, kernel, tile=16), g.shape), whole)
    blurred = grid(raster.gaussian_blur(pixels(spark, np.ones((20, 20))), 1.0), (20, 20))
    assert np.allclose(blurred, 1)


def test_hillshade_prefers_the_lit_side(spark):
    y, x = np.mgrid[0:30, 0:30]
    east_low = pixels(spark, 30.0 - x)
    inner = lambda df: grid(df, (30, 30))[5:25, 5:25]
    assert inner(raster.hillshade(east_low, 90)).mean() > inner(raster.hillshade(east_low, 270)).mean()
    assert raster.best_azimuth(east_low).first().azimuth == 90
    assert inner(raster.hillshade(pixels(spark, 0.0 * x), 90)) == pytest.approx(255 * np.sin(np.pi / 4))


def test_stripes_and_disparity(spark):
    rng = np.random.default_rng(0)
    flat = rng.random((64, 64)) + 1
    y, x = np.mgrid[0:64, 0:64]
    striped = flat + np.sin(2 * np.pi * (x * 10 + y * 10) / 64)
    df = pixels(spark, flat, 1).union(pixels(spark, striped, 2)).union(pixels(spark, flat[:20], 3))
    score = {r.raster_id: r.score for r in raster.stripe_score(df).collect()}
    assert score[2] > 3 * score[1] and score[3] is None
    d = spark.createDataFrame([(float(5 + i % 2), 1.0, 1) for i in range(50)] + [(900.0, 9.0, 0)], "dx double, dy double, valid int")
    assert raster.disparity_summary(d).first().uniform


def test_regrid_and_blend(spark):
    y, x = np.mgrid[0:10, 0:10]
    out = grid(raster.regrid(pixels(spark, 2.0 * x + 3.0 * y), 0.5, 0.25, 1.0, 9, 9), (9, 9))
    yy, xx = np.mgrid[0:9, 0:9]
    assert np.allclose(out, 2 * (xx + 0.5) + 3 * (yy + 0.25))
    ref, dem = pixels(spark, np.zeros((40, 40))), pixels(spark, np.ones((40, 40)))
    lit = np.ones((40, 40))
    lit[:, :15] = 0
    lit[30, 30] = 0
    v = grid(raster.blend_to_reference(ref, dem, pixels(spark, lit).select("x", "y", "v"), lit_length=4, min_size=25), (40, 40))
    assert (v[:, :15] == 0).all() and v[20, 25] == 1 and v[30, 30] == 1 and 0 < v[20, 16] < 1


def test_orders(spark):
    rng = random.Random(9)
    rows = [(f"p{i:02}", 0, rng.uniform(0, 360), *(lambda a, b: (a, b, a + 3, b + 3))(rng.uniform(0, 9), rng.uniform(0, 9))) for i in range(30)]
    df = spark.createDataFrame(rows, "product_id string, g int, roi_sub_solar_ground_azimuth double, x0 double, y0 double, x1 double, y1 double")
    for method in ("weight", "degree", "tour"):
        got = ordering.ordered_groups(df, "g", method).orderBy("place").collect()
        assert [r.place for r in got] == list(range(1, 31))
        if method == "weight":
            assert got[0].roi_sub_solar_ground_azimuth == min(r[2] for r in rows)
    assert ordering.intersection_pairs(df).count() > 0


def test_text_sources(spark, tmp_path):
    (tmp_path / "r.txt").write_text("head\nhead\na.cub, 0.5, 0.25, 10\nb.cub 0.5 nan 3\nbad row\n")
    got = {r.image: r["count"] for r in readers.read_residual_stats(spark, str(tmp_path / "r.txt")).collect()}
    assert got == {"a.cub": 10, "b.cub": 3}
    (tmp_path / "camera_offsets.txt").write_text("# c\na 0 0\nb 1.5 2\n")
    cams = readers.read_report(spark, str(tmp_path / "camera_offsets.txt"))
    assert [r.image for r in aggregates.fixed_cameras(cams).collect()] == ["a"]
    (tmp_path / "ids.txt").write_text("# c\n\nfirst x\nsecond\n")
    assert [(r.pos, r.value) for r in readers.read_id_list(spark, str(tmp_path / "ids.txt")).orderBy("pos").collect()] == [(1, "first"), (2, "second")]
    (tmp_path / "gcp.txt").write_text("0 1 2 3 1 1 1 img/a 1 2 1 1 img/b 3 4 1 1\n1 1 2 3 1 1 1 img/a 1 2\n2 1 2\n")
    points = readers.read_gcp(spark, str(tmp_path / "gcp.txt"))
    kept = joins.filter_gcp(points, spark.createDataFrame([("x/b",)], "value string")).collect()
    assert [(r.id, [g.img for g in r.images]) for r in kept] == [("0", ["img/b"])]
    (tmp_path / "q.txt").write_text("maps/M123.tif 10 10 5\nbad x y\nM2.a -10 350\n")
    assert sorted(r.image for r in readers.read_query_table(spark, str(tmp_path / "q.txt")).collect()) == ["M123", "M2"]
    log = spark.createDataFrame([("a b c d e 1.5 g 2.5 i 3.5 azimuth",), ("other",)], "value string")
    assert [tuple(r) for r in readers.log_matches(log, "azimuth").collect()] == [("1.5", "2.5", "3.5")]


def test_index_source(spark, tmp_path):
    label = "OBJECT = COLUMN\n NAME = VOLUME_ID\nEND_OBJECT\nOBJECT = COLUMN\n COLUMN_NUMBER = 2\n NAME = \"B\"\nEND_OBJECT"
    (tmp_path / "l.lbl").write_text(label)
    names = [r.name for r in readers.index_columns_from_label(spark.read.text(str(tmp_path / "l.lbl"), wholetext=True)).orderBy("pos").collect()]
    assert names == ["VOLUME_ID", "B"]
    (tmp_path / "i.csv").write_text('"a ",1,2,3,"NACL","MOON ",5,1\n"b",1,2,3,"WAC","MOON",5,1\n"c",1,2,3,"nacr","EARTH",5,1\n')
    out = readers.read_index(spark, str(tmp_path / "i.csv"), ["ID", "B", "C", "D", "CAM", "TARGET_NAME", "V", "WAC_X"], {"V": "double"}).collect()
    assert [(r.ID, r.V, r.TARGET_NAME) for r in out] == [("a", 5.0, "MOON")] and "WAC_X" not in out[0].asDict()


def test_archive_products(spark):
    p = lambda label, res, urls: {"LabelFileName": label, "pdsid": "nac.m9le", "Map_resolution": res, "Product_files": {"Product_file": urls}}
    a = {"ODEResults": {"Products": {"Product": [p("m1le.xml", "1.5", [{"URL": "x.xml"}, {"URL": "http://h/m1le.IMG"}]), p("m1le.xml", "9", {"URL": "y.IMG"}), p("", "bad", {"URL": "z.img"})]}}}
    b = {"ODEResults": {"Products": {"Product": p("m0re.xml", "7", {"URL": "w.IMG"})}}}
    df = spark.createDataFrame([(0, json.dumps(a)), (1, json.dumps(b))], "pos int, value string")
    got = [(r.id, r.resolution, r.url) for r in readers.normalize_archive_products(df, 5.0).collect()]
    assert got == [("M1LE", 1.5, "http://h/m1le.IMG"), ("M9LE", None, "z.img")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b"), (1, "a")], "pos int, value string")
    writers.write_id_list(rows, str(tmp_path / "l"), pos="pos")
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).collect()] == ["a", "b"]
    images = spark.createDataFrame([(f"p{i}", float(i % 7), float(i % 5)) for i in range(50)], "product_id string, x double, y double")
    writers.write_index_parquet(images, str(tmp_path / "i"), F.col("x"), F.col("y"), (0, 0, 8, 8), 3)
    assert spark.read.parquet(str(tmp_path / "i")).count() == 50
    report = graph.check_connectivity(spark.createDataFrame([("a", "b")], "src string, dst string"))
    writers.write_connectivity_json(report, str(tmp_path / "j"), min_match_count=3)
    said = json.loads(spark.read.text(str(tmp_path / "j")).first().value)
    assert said["is_connected"] and said["min_match_count"] == 3 and said["degree_hist_per_component"] == [{"1": 2}]
    tiles = raster.tiles_by_width(spark.createDataFrame([(0.0, 0.0, 10.0, 10.0)], "x0 double, y0 double, x1 double, y1 double"), 6)
    shapes = [json.loads(r.value) for r in writers.tiles_to_geojson(tiles).collect()]
    assert len(shapes) == 4 and shapes[0]["geometry"]["coordinates"][0][0] == shapes[0]["geometry"]["coordinates"][0][-1]
    feats = {"type": "FeatureCollection", "features": [{"properties": {"location": "a/M1LE.map.tif"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}
    (tmp_path / "f.json").write_text(json.dumps(feats))
    assert readers.read_geojson_features(spark, str(tmp_path / "f.json")).first().id == "M1LE"
    ringed = spark.createDataFrame([("a", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)])], f"id string, ring {geometry.RING}")
    writers.write_geo_table(ringed, str(tmp_path / "g"), crs="IAU:30100")
    assert readers.read_geo_table(spark, str(tmp_path / "g")).first().crs == "IAU_2015:30100"
    assert writers.product_lines(spark.createDataFrame([("M1", 2.0, ""), ("M0", None, "u")], "id string, r double, url string"), ["id", "r"]).collect()[0].value == "M0 - u"


def test_lists(spark):
    a, b = (lists.IdSet(spark.createDataFrame([(x,) for x in v], "value string")) for v in ("abc", "bc"))
    assert b.issubset(a) and b.issubset(a, proper=True) and a.issuperset(b) and not a.isequal(b) and a.isequal(a)
    assert a.difference(b).isdisjoint(b) and not a.issubset(a, proper=True)
    with pytest.raises(ValueError):
        lists.random_sample(b.values, 3)
    with pytest.raises(ValueError):
        joins.positional_zip(a.values, b.values)


def test_padded_tiles_and_quadrants(spark):
    t = raster.padded_tiles(spark.createDataFrame([(100, 50)], "size_x int, size_y int"), 30, 30, 5).orderBy("tile").collect()
    assert [r.tile for r in t] == list(range(10001, 10001 + len(t)))
    assert t[0].x0 == 0 and t[-1].x1 == 100 and max(r.y1 for r in t) == 50
    with pytest.raises(ValueError):
        raster.tiles_with_overlap(spark.range(1), 10, 5)
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 9.0, 9.0, 10.0, 10.0), (3, 0.0, 0.0, 10.0, 10.0)], "id int, x0 double, y0 double, x1 double, y1 double")
    got = sorted((r.id, r.quadrant) for r in spatial.assign_quadrants(boxes, 1.0).collect())
    assert got == [(1, "ll"), (2, "ur"), (3, "ll"), (3, "lr"), (3, "ul"), (3, "ur")]


def test_polar_rings(spark):
    df = spark.createDataFrame([(350.0, -85.0, 10.0, -84.0, 355.0, -85.0, 1.0, 0.0)], "center_longitude double, center_latitude double, b double, c double, sub_solar_longitude double, sub_solar_latitude double, d double, e double")
    corners = {f"{p}_longitude": F.lit(x) for p, x in (("lower_left", 350.0), ("lower_right", 10.0), ("upper_right", 10.0), ("upper_left", 350.0))}
    lats = {f"{p}_latitude": F.lit(y) for p, y in (("lower_left", -85.0), ("lower_right", -85.0), ("upper_right", -84.0), ("upper_left", -84.0))}
    out = cover.polar_subset(cover.prep_index(df.withColumns(corners | lats))).first()
    assert out.center_longitude == -10 and out.x1 > 0 > out.x0 and out.x1 == pytest.approx(-out.x0)
    assert cover.polar_subset(cover.prep_index(df.withColumns(corners | lats)), south=False).count() == 0


def test_network_flags(spark):
    o = spark.createDataFrame([("a", 6.0, 10), ("b", 1.0, 100)], "image string, p95 double, cnt bigint")
    r = spark.createDataFrame([("a", 0.9), ("b", float("nan"))], "image string, median double")
    s = spark.createDataFrame([("b", 900.0, 900.0)], "image string, horiz double, vert double")
    got = {x.id: x.reasons for x in network.flag_cameras(o, r, s).collect()}
    assert got == {"a": ["matches", "offset", "residual"], "b": ["shift"]}
    files = spark.createDataFrame([("M1LE__M2LE-DEM.tif",), ("M3LE__M4LE-DEM.tif",)], "file string")
    d = spark.createDataFrame([("M1LE__M2LE-diff.tif", -3.0), ("M3LE__M4LE-diff.tif", 30.0)], "file string, mean double")
    e = spark.createDataFrame([("M1LE__M2LE-err.tif", 0.5), ("M3LE__M4LE-err.tif", 0.1)], "file string, mean double")
    assert [x.file for x in network.downselect_dems(files, d, e, old="-DEM", new="-ok").collect()] == ["M1LE__M2LE-ok.tif"]
    assert filters.by_stat(o, "p95", ">", 5).count() == 1
    with pytest.raises(ValueError):
        filters.by_stat(o, "p95; drop", ">", 5)


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.createDataFrame([(i, f"2024-01-01 00:{i:02}:00") for i in range(30)], "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.coalesce(1).write.parquet(src)
    live = spark.readStream.schema("id int, ts timestamp").parquet(src)
    run = streams.throughput(live, "ts", "600 seconds", "1 minute").writeStream.format("memory").queryName("tp").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination()
    assert sorted(r.n for r in spark.table("tp").collect()) == [10, 10, 10]
    done = streams.progress(spark.table("tp"), 60).first()
    assert done.done == 30 and done.remaining == 30 and done.percent == 50
    for n in (30, 40):
        streams.incremental_ingest(spark, src, "id int, ts timestamp", str(tmp_path / "out"), str(tmp_path / "cp"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == n
        rows.limit(10).coalesce(1).write.mode("append").parquet(src)
