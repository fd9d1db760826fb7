"""Queries that write through a sink and read back through a reader, or parse text built from the image tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regolith.functions import geometry, ids
from regolith.operators import aggregates, raster, spatial
from regolith.plans import cover as cover_plan
from regolith.plans.registry import _COVER, Load, query, rounded
from regolith.session import new_folder
from regolith.sources import readers, writers
from regolith.streaming import streams

#: Lines in a text file of these queries.
BLOCK = 500


def text_files(rows: DataFrame, line: Column, name: str, head: int = 0, order: str = "k") -> str:
    """A folder of text files of BLOCK lines each, in order, after ``head`` header lines."""
    blocks = rows.select(F.floor(F.col(order) / BLOCK).alias("block"), F.struct(F.col(order), line.alias("line")).alias("x"))
    lines = blocks.groupBy("block").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"]).alias("lines"))
    path = new_folder(rows.sparkSession, name)
    text = F.array_join(F.concat(F.array_repeat(F.lit("# head"), head), "lines"), "\n")
    lines.select("block", text.alias("value")).repartition("block").write.partitionBy("block").text(path)
    return path


def json_files(rows: DataFrame, value: Column, name: str, each: int = 100) -> str:
    """A folder with one JSON object for each ``each`` rows, in a file of its own; value aggregates the rows."""
    path = new_folder(rows.sparkSession, name)
    rows.groupBy(F.floor(F.col("k") / each).alias("block")).agg(value).repartition("block").write.partitionBy("block").json(path)
    return path


def fields(*columns: str) -> Column:
    return F.concat_ws(" ", *[F.col(c).cast("string") for c in columns])


def numbered(rows: DataFrame) -> DataFrame:
    """With k, the number in the image's id."""
    return rows.withColumn("k", F.substring("image", 6, 9).cast("long"))


@query("images", sql="SELECT product_id AS \"PRODUCT_ID\", resolution AS \"RES\" FROM images WHERE k % 5 <> 0 AND k % 7 <> 0")
def index_from_csv(t: Load) -> DataFrame:
    names = ["PRODUCT_ID", "VOLUME", "A", "B", "INSTRUMENT", "TARGET_NAME", "RES", "WAC_FILTER"]
    camera, target = F.when(F.col("k") % 5 == 0, "WAC").otherwise("NACL"), F.when(F.col("k") % 7 == 0, "MARS").otherwise("MOON")
    path = new_folder(t("images").sparkSession, "index")
    t("images").select("product_id", F.lit("v"), F.lit(1), F.lit(" b"), camera, target, "resolution", F.lit("x")).write.csv(path, quoteAll=True)
    return readers.read_index(t("images").sparkSession, path, names, {"RES": "double"}).select("PRODUCT_ID", "RES")


@query("customer", sql="SELECT CAST(row_number() OVER (PARTITION BY c_nationkey, c_custkey // 100 ORDER BY c_custkey) - 1 AS INT) AS pos, 'C_' || c_custkey AS name FROM customer")
def label_columns(t: Load) -> DataFrame:
    block = F.format_string("OBJECT = COLUMN\n  COLUMN_NUMBER = 1\n  NAME = \"C_%d\"\nEND_OBJECT\n", F.col("c_custkey"))
    x = F.array_sort(F.collect_list(F.struct("c_custkey", block.alias("b"))))
    label = t("customer").groupBy("c_nationkey", F.floor(F.col("c_custkey") / 100)).agg(F.array_join(F.transform(x, lambda y: y["b"]), "").alias("value"))
    return readers.index_columns_from_label(label).select("pos", "name")


@query("images", sql="SELECT product_id, x0, y1 FROM images")
def footprints_from_parquet(t: Load) -> DataFrame:
    path = new_folder(t("images").sparkSession, "footprints")
    writers.write_index_parquet(t("images"), path, F.col("x0"), F.col("y0"), (0.0, 0.0, 32768.0, 32768.0), 4)
    return readers.read_footprints(t("images").sparkSession, path).select("product_id", "x0", "y1")


@query("images", sql="SELECT product_id, round((x1 - x0) * (y1 - y0), 6) AS area, 'IAU_2015:30135' AS crs FROM images")
def geo_table(t: Load) -> DataFrame:
    path = new_folder(t("images").sparkSession, "geo")
    writers.write_geo_table(t("images").select("product_id", geometry.box_ring(*spatial.box()).alias("ring")), path, crs="IAU:30135")
    rows = readers.read_geo_table(t("images").sparkSession, path)
    return rows.select("product_id", F.round(geometry.area(geometry.parse_wkt(F.col("geometry"))), 6).alias("area"), "crs")


@query("pair_stats", sql="SELECT l_image AS \"left\", r_image AS \"right\", p25, num FROM pair_stats")
def pair_stats_from_text(t: Load) -> DataFrame:
    rows = t("pair_stats").withColumn("k", F.substring("l_image", 6, 9).cast("long"))
    path = text_files(rows, fields("l_image", "r_image", "p25", "p50", "p75", "p85", "p95", "num"), "pairs", 2)
    return readers.read_pair_stats(rows.sparkSession, path).select("left", "right", "p25", "num")


@query("residual_stats", sql="SELECT image, mean, median, cnt AS count FROM residual_stats")
def residual_stats_from_text(t: Load) -> DataFrame:
    rows = numbered(t("residual_stats"))
    path = text_files(rows, F.concat_ws(", ", "image", "mean", "median", "cnt"), "residuals", 2)
    return readers.read_residual_stats(rows.sparkSession, path).select("image", "mean", "median", "count")


@query("residual_stats", sql="SELECT image, mean, cnt AS count FROM residual_stats")
def report_by_name(t: Load) -> DataFrame:
    rows = numbered(t("residual_stats"))
    path = text_files(rows, fields("image", "mean", "median", "cnt"), "residuals_stats", 2)
    return readers.read_report(rows.sparkSession, path).select("image", "mean", "count")


@query("offset_stats", sql="SELECT image, p25, p85, cnt AS count FROM offset_stats")
def match_offsets_from_text(t: Load) -> DataFrame:
    rows = numbered(t("offset_stats"))
    path = text_files(rows, fields("image", "p25", "p50", "p75", "p85", "p95", "cnt"), "offsets", 1)
    return readers.read_match_offset_stats(rows.sparkSession, path).select("image", "p25", "p85", "count")


@query("convergence", sql="SELECT l_image AS \"left\", r_image AS \"right\", p75, num_matches FROM convergence")
def convergence_from_text(t: Load) -> DataFrame:
    rows = t("convergence").withColumn("k", F.substring("l_image", 6, 9).cast("long"))
    path = text_files(rows, fields("l_image", "r_image", "p25", "p50", "p75", "num_matches"), "angles", 2)
    return readers.read_convergence_angles(rows.sparkSession, path).select("left", "right", "p75", "num_matches")


@query("camera_offsets", sql="SELECT image, horiz, vert FROM camera_offsets")
def camera_offsets_from_text(t: Load) -> DataFrame:
    rows = numbered(t("camera_offsets"))
    return readers.read_camera_offsets(rows.sparkSession, text_files(rows, fields("image", "horiz", "vert"), "cameras"))


@query("images", sql="SELECT product_id AS id FROM images WHERE k % 2 = 1")
def components_from_report(t: Load) -> DataFrame:
    part = lambda n: F.collect_list(F.when(F.col("k") % 2 == n, F.col("product_id")))
    path = json_files(t("images"), F.array(part(0), part(1)).alias("components"), "components")
    return readers.read_components(t("images").sparkSession, path, 1)


@query("images", sql="SELECT product_id, x0, slew_angle FROM images")
def images_from_json_lines(t: Load) -> DataFrame:
    path = new_folder(t("images").sparkSession, "lines")
    t("images").write.json(path)
    return readers.read_json_lines(t("images").sparkSession, path, "product_id string, x0 double, slew_angle double")


@query("images", sql="SELECT product_id AS id, 'maps/' || product_id || '.tif' AS location, round((x1 - x0) * (y1 - y0), 6) AS area FROM images")
def features_from_geojson(t: Load) -> DataFrame:
    points = F.transform(geometry.box_ring(*spatial.box()), lambda p: F.array(p["x"], p["y"]))
    place = F.concat(F.lit("maps/"), "product_id", F.lit(".tif"))
    feature = F.struct(F.struct(place.alias("location")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(points).alias("coordinates")).alias("geometry"))
    rows = readers.read_geojson_features(t("images").sparkSession, json_files(t("images"), F.collect_list(feature).alias("features"), "features"))
    return rows.select("id", "location", F.round(geometry.area(F.col("ring")), 6).alias("area"))


@query("images", sql="SELECT row_number() OVER (PARTITION BY k // 500 ORDER BY k) AS pos, product_id AS value FROM images")
def id_list_from_text(t: Load) -> DataFrame:
    line = F.concat(F.when(F.col("k") % 3 == 0, "# note\n\n").otherwise(""), "product_id", F.lit(" more"))
    return readers.read_id_list(t("images").sparkSession, text_files(t("images"), line, "list"))


@query("images", sql="SELECT product_id AS id, resolution, 'u/' || product_id || '.IMG' AS url FROM images WHERE resolution <= 4")
def archive_products(t: Load) -> DataFrame:
    even = F.col("k") % 2 == 0
    files = F.array(F.struct(F.lit("u/a.xml").alias("URL")), F.struct(F.concat(F.lit("u/"), "product_id", F.lit(".IMG")).alias("URL")))
    product = F.struct(
        F.when(even, F.concat("product_id", F.lit(".xml"))).alias("LabelFileName"), F.concat(F.lit("nac."), F.lower("product_id")).alias("pdsid"),
        F.col("resolution").cast("string").alias("Map_resolution"), F.struct(files.alias("Product_file")).alias("Product_files"),
    )
    whole = F.to_json(F.struct(F.struct(F.struct(F.collect_list(product).alias("Product")).alias("Products")).alias("ODEResults")))
    answers = t("images").groupBy(F.floor(F.col("k") / 50).alias("pos")).agg(whole.alias("value"))
    return readers.normalize_archive_products(answers, 4.0).select("id", "resolution", "url")


@query("images", sql="SELECT product_id AS image, emission_angle AS raw_azimuth, CASE WHEN k % 3 <> 0 THEN incidence_angle END AS elevation FROM images")
def query_table_from_text(t: Load) -> DataFrame:
    line = F.concat_ws(" ", F.concat(F.lit("x/"), "product_id", F.lit(".cub")), F.col("emission_angle").cast("string"), F.lit("1.5"), F.when(F.col("k") % 3 != 0, F.col("incidence_angle").cast("string")))
    return readers.read_query_table(t("images").sparkSession, text_files(t("images"), line, "table")).select("image", "raw_azimuth", "elevation")


@query("images", sql="SELECT count(DISTINCT k // 500) AS n, true AS sized FROM images")
def assets_in_folder(t: Load) -> DataFrame:
    found = readers.list_assets(t("images").sparkSession, text_files(t("images"), F.col("product_id"), "assets"), "*.txt")
    return found.agg(F.count(F.lit(1)).alias("n"), F.every(F.col("length") > 0).alias("sized"))


@query("images", sql="SELECT product_id AS token2, CAST(k AS VARCHAR) AS token4 FROM images WHERE k % 2 = 0")
def logged_tokens(t: Load) -> DataFrame:
    line = F.concat_ws(" ", F.when(F.col("k") % 2 == 0, "Found:").otherwise("Lost:"), "product_id", F.lit("at"), F.col("k").cast("string"))
    return readers.log_matches(t("images").select(line.alias("value")), "Found:", (2, 4))


@query("images", "roi", sql=_COVER + "SELECT product_id, round(incidence_angle, 6) AS incidence_angle, round(fraction_area, 6) AS fraction_area FROM p")
def cover_csv(t: Load) -> DataFrame:
    path = new_folder(t("images").sparkSession, "cover")
    writers.write_cover_csv(cover_plan.cover(t("images"), t("roi")), path)
    rows = t("images").sparkSession.read.csv(path, header=True, schema="product_id string, incidence_angle double, fraction_area double, roi_sub_solar_ground_azimuth double, resolution double")
    return rows.select("product_id", *rounded("incidence_angle", "fraction_area"))


@query("images", sql="SELECT min(x0) AS x0, max(y1) AS y1, 'box' AS kind FROM images")
def report_as_json(t: Load) -> DataFrame:
    value = writers.report_json(aggregates.extent(t("images")), kind="box")
    return value.select(*[F.get_json_object("value", f"$.{c}").cast("double").alias(c) for c in ("x0", "y1")], F.get_json_object("value", "$.kind").alias("kind"))


@query("images", sql="SELECT DISTINCT left(product_id, 8) AS value FROM images")
def id_lines(t: Load) -> DataFrame:
    path = new_folder(t("images").sparkSession, "ids")
    writers.write_id_list(t("images").select(F.substring("product_id", 1, 8).alias("value")), path, unique=True)
    return t("images").sparkSession.read.text(path)


@query("images", sql="SELECT product_id || ' ' || k || ' -' || CASE WHEN k % 2 = 0 THEN ' u/' || k ELSE '' END AS value FROM images")
def product_lines(t: Load) -> DataFrame:
    rows = t("images").select("product_id", "k", F.lit(None).cast("string").alias("time"), F.when(F.col("k") % 2 == 0, F.concat(F.lit("u/"), "k")).otherwise("").alias("url"))
    return writers.product_lines(rows, ["product_id", "k", "time"])


@query("images", sql=""", b AS (SELECT min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM images)
SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, x0 + i * 4000 AS minx, y1 - j * 4000 AS maxy FROM b, range(0, (SELECT CAST(ceil((x1 - x0) / 4000) AS BIGINT) FROM b)) t(i), range(0, (SELECT CAST(ceil((y1 - y0) / 4000) AS BIGINT) FROM b)) u(j)""")
def tiles_as_geojson(t: Load) -> DataFrame:
    value = writers.tiles_to_geojson(raster.tiles_by_width(aggregates.extent(t("images")), 4000))
    part = lambda path, kind: F.get_json_object("value", path).cast(kind)
    return value.select(part("$.properties.i", "int").alias("i"), part("$.properties.j", "int").alias("j"), part("$.geometry.coordinates[0][0][0]", "double").alias("minx"), part("$.geometry.coordinates[0][2][1]", "double").alias("maxy"))


@query("images", sql="SELECT product_id, x0 FROM images")
def ingested_files(t: Load) -> DataFrame:
    """Two runs of the stream: the second takes only the files that the first did not see."""
    rows, spark = t("images").select("k", "product_id", "x0"), t("images").sparkSession
    source, target, state = (new_folder(spark, n) for n in ("arrivals", "ingested", "progress"))
    for odd in (0, 1):
        rows.filter(F.col("k") % 2 == odd).write.mode("append").parquet(source)
        streams.incremental_ingest(spark, source, "k bigint, product_id string, x0 double", target, state)
    return spark.read.parquet(target).select("product_id", "x0")


@query("images", sql="SELECT product_id, CAST(1 AS INT) AS n FROM images WHERE k % 3 <> 2")
def filtered_control_points(t: Load) -> DataFrame:
    from regolith.operators import joins

    line = F.concat_ws(" ", "k", F.lit("1 2 3 1 1 1"), F.concat(F.lit("img/"), "product_id"), F.lit("1 2 1 1"), F.concat(F.lit("other/"), "product_id", F.lit("-b 1 2 1 1")))
    points = readers.parse_gcp(t("images").select(F.col("k").alias("pos"), line.alias("value")))
    listed = t("images").filter("k % 3 <> 2").select(F.concat(F.lit("else/"), "product_id").alias("value"))
    kept = joins.filter_gcp(points, listed)
    return kept.select(ids.basename(F.get("images", F.lit(0))["img"]).alias("product_id"), F.size("images").alias("n"))
