"""Readers of index files, solver statistics, lists and archive answers, all with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regolith.functions import ids

#: Fields of the statistics files (fixed formats): separator, header lines, names and types.
FORMATS = {
    "pair_stats": (r"\s+", 2, "left string, right string, p25 double, p50 double, p75 double, p85 double, p95 double, num bigint"),
    "residual_stats": (r"\s*,\s*|\s+", 2, "image string, mean double, median double, count bigint"),
    "match_offsets": (r"\s+", 1, "image string, p25 double, p50 double, p75 double, p85 double, p95 double, count bigint"),
    "convergence": (r"\s+", 2, "left string, right string, p25 double, p50 double, p75 double, num_matches bigint"),
    "camera_offsets": (r"\s+", 0, "image string, horiz double, vert double"),
}
#: File names of the solver's reports and what they hold (fixed values).
REPORTS = {"match_offsets_by_pair": "pair_stats", "mapproj_match_offset_stats": "pair_stats", "residuals_stats": "residual_stats", "match_offsets": "match_offsets", "convergence_angles": "convergence", "camera_offsets": "camera_offsets"}


def lines(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """(file, pos, value): the lines of text files without the first ``skip`` of each file, pos from 0.

    Files of this kind are small; each is read whole so that the order of its lines is known.
    """
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_replace("value", r"\r?\n$", "").alias("text"))
    rows = whole.select("file", F.posexplode(F.split("text", r"\r?\n")).alias("at", "value"))
    return rows.filter(F.col("at") >= skip).select("file", (F.col("at") - skip).alias("pos"), "value")


def parse(rows: DataFrame, separator: str, schema: str, value: str = "value") -> DataFrame:
    """Typed fields of delimited lines; comments, blank lines and rows that don't fit the schema are dropped."""
    fields = T.StructType.fromDDL(schema).fields
    parts = F.split(F.trim(value), separator)
    out = rows.filter((F.trim(value) != "") & ~F.startswith(F.trim(value), F.lit("#"))).withColumn("__p", parts).filter(F.size("__p") >= len(fields))
    typed = [F.expr(f"try_cast(__p[{i}] AS {f.dataType.simpleString()})").alias(f.name) for i, f in enumerate(fields)]
    return out.select(*typed).filter(" AND ".join(f"`{f.name}` IS NOT NULL" for f in fields))


def read_stats(spark: SparkSession, path: str, kind: str) -> DataFrame:
    separator, skip, schema = FORMATS[kind]
    return parse(lines(spark, path, skip), separator, schema)


def read_pair_stats(spark: SparkSession, path: str) -> DataFrame:
    return read_stats(spark, path, "pair_stats")


def read_residual_stats(spark: SparkSession, path: str) -> DataFrame:
    """Commas or white space between fields."""
    return read_stats(spark, path, "residual_stats")


def read_match_offset_stats(spark: SparkSession, path: str) -> DataFrame:
    return read_stats(spark, path, "match_offsets")


def read_convergence_angles(spark: SparkSession, path: str) -> DataFrame:
    return read_stats(spark, path, "convergence")


def read_camera_offsets(spark: SparkSession, path: str) -> DataFrame:
    return read_stats(spark, path, "camera_offsets")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The reader that the file's name asks for; other files are CSV with a header."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    for part, kind in REPORTS.items():
        if part in name:
            return read_stats(spark, path, kind)
    return spark.read.csv(path, header=True)


def index_columns_from_label(label: DataFrame, value: str = "value") -> DataFrame:
    """(pos, name): the NAME of each COLUMN block of a label read as one text."""
    blocks = F.regexp_extract_all(F.col(value), F.lit(r"(?s)OBJECT\s*=\s*COLUMN\b.*?\bNAME\s*=\s*\"?([A-Za-z0-9_]+)\"?"), F.lit(1))
    return label.select(F.posexplode(blocks).alias("pos", "name"))


def read_index(spark: SparkSession, path: str, names: list[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """A headerless quoted CSV whose columns are named by position.

    Rows whose fifth column names the narrow camera and whose target is the Moon stay; strings are trimmed; columns of the
    wide camera go. ``kinds`` gives types of columns other than string.
    """
    rows = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(path, quote='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return clean_index(rows, kinds)


def clean_index(rows: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    rows = rows.filter(F.col(rows.columns[4]).ilike("%nac%"))
    if "TARGET_NAME" in rows.columns:
        rows = rows.filter(F.col("TARGET_NAME").ilike("%moon%"))
    typed = lambda n: F.expr(f"try_cast(trim(`{n}`) AS {(kinds or {}).get(n, 'string')})").alias(n)
    return rows.select(*[typed(n) for n in rows.columns if "wac" not in n.lower()])


def read_footprints(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def normalize_crs(crs: Column) -> Column:
    return F.regexp_replace(crs, r"^IAU:", "IAU_2015:")


def read_geo_table(spark: SparkSession, path: str, crs: str = "crs") -> DataFrame:
    """A Parquet table of ids, attributes and geometry; the authority of its CRS column, if there, is normalised."""
    rows = spark.read.parquet(path)
    return rows.withColumn(crs, normalize_crs(F.col(crs))) if crs in rows.columns else rows


def read_components(spark: SparkSession, path: str, component: int) -> DataFrame:
    """(id) of the component of that index in a connectivity report."""
    report = spark.read.schema("components array<array<string>>").json(path, multiLine=True)
    return report.select(F.explode(F.get("components", F.lit(component))).alias("id"))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """(id, location, ring) of all features of all files; the id is the location's product id."""
    schema = "features array<struct<properties:struct<location:string>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>>"
    one = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    ring = F.transform(F.get("f.geometry.coordinates", F.lit(0)), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return one.select(ids.filename_to_pid(F.col("f.properties.location")).alias("id"), F.col("f.properties.location").alias("location"), ring.alias("ring"))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos, value): the first token of each line, in order from 1; comments and blank lines are skipped."""
    rows = lines(spark, path).filter((F.trim("value") != "") & ~F.startswith(F.trim("value"), F.lit("#")))
    return rows.select(F.row_number().over(Window.partitionBy("file").orderBy("pos")).cast("long").alias("pos"), F.split(F.trim("value"), r"\s+")[0].alias("value"))


def normalize_archive_products(answers: DataFrame, max_resolution: float | None = None, max_products: int | None = None, value: str = "value") -> DataFrame:
    """(id, resolution, time, url, ...) of the products in archive answers, one JSON answer per row in the order of ``pos``.

    Objects where arrays are expected count as arrays of one; the first product of an id wins; a resolution that can't be
    read is null and passes the limit; the first file that ends in .IMG gives the URL; sorted by id, at most max_products.
    """
    answers = answers if "pos" in answers.columns else answers.withColumn("pos", F.monotonically_increasing_id())

    def listed(text: Column) -> Column:
        return F.when(F.startswith(F.ltrim(text), F.lit("[")), F.from_json(text, "array<string>")).when(text.isNotNull(), F.array(text))

    products = answers.select("pos", F.posexplode(listed(F.get_json_object(value, "$.ODEResults.Products.Product"))).alias("at", "product"))
    fields = "LabelFileName string, pdsid string, Map_resolution string, Observation_time string, Incidence_angle string, Emission_angle string, Phase_angle string, Center_latitude string, Center_longitude string"
    products = products.withColumn("p", F.from_json("product", fields))
    files = listed(F.get_json_object("product", "$.Product_files.Product_file"))
    urls = F.filter(F.transform(files, lambda f: F.get_json_object(f, "$.URL")), lambda u: F.endswith(F.upper(u), F.lit(".IMG")))
    number = lambda c: F.expr(f"try_cast(p.{c} AS double)")
    rows = products.select(
        "pos", "at", ids.product_id_from_archive(F.col("p.LabelFileName"), F.col("p.pdsid")).alias("id"), number("Map_resolution").alias("resolution"), F.col("p.Observation_time").alias("time"),
        number("Incidence_angle").alias("incidence"), number("Emission_angle").alias("emission"), number("Phase_angle").alias("phase"), number("Center_latitude").alias("lat"), number("Center_longitude").alias("lon"), F.get(urls, F.lit(0)).alias("url"),
    )
    if max_resolution is not None:
        rows = rows.filter(F.coalesce(F.col("resolution") <= max_resolution, F.lit(True)))
    first = rows.withColumn("__n", F.row_number().over(Window.partitionBy("id").orderBy("pos", "at"))).filter("__n = 1").drop("__n")
    if max_products is not None:
        first = first.orderBy("pos", "at").limit(max_products)
    return first.drop("pos", "at").orderBy("id")


def parse_gcp(rows: DataFrame, value: str = "value") -> DataFrame:
    """(pos, id, lat, lon, height, sx, sy, sz, images) of control-point lines: seven fields, then groups of five.

    Lines with fewer than seven fields or an incomplete group are dropped.
    """
    parts = rows.filter(~F.startswith(F.trim(value), F.lit("#"))).withColumn("__p", F.split(F.trim(value), r"\s+")).filter("size(__p) >= 7 AND (size(__p) - 7) % 5 = 0")
    number = lambda i: F.expr(f"try_cast(__p[{i}] AS double)")
    images = "transform(filter(sequence(7, size(__p)), i -> (i - 7) % 5 = 0 AND i < size(__p)), i -> named_struct('img', __p[i], 'px', try_cast(__p[i + 1] AS double), 'py', try_cast(__p[i + 2] AS double), 'sx', try_cast(__p[i + 3] AS double), 'sy', try_cast(__p[i + 4] AS double)))"
    return parts.select("pos", F.col("__p")[0].alias("id"), *[number(i + 1).alias(n) for i, n in enumerate(("lat", "lon", "height", "sx", "sy", "sz"))], F.expr(images).alias("images"))


def read_gcp(spark: SparkSession, path: str) -> DataFrame:
    return parse_gcp(lines(spark, path))


def read_query_table(spark: SparkSession, path: str) -> DataFrame:
    """(image, raw_azimuth, azimuth_0_360, elevation); elevation may be missing; unreadable rows are skipped."""
    parts = lines(spark, path).withColumn("__p", F.split(F.trim("value"), r"\s+")).filter("size(__p) >= 3")
    out = parts.select(ids.filename_to_pid(F.col("__p")[0]).alias("image"), *[F.expr(f"try_cast(get(__p, {i}) AS double)").alias(n) for i, n in ((1, "raw_azimuth"), (2, "azimuth_0_360"), (3, "elevation"))])
    return out.filter("raw_azimuth IS NOT NULL AND azimuth_0_360 IS NOT NULL")


def list_assets(spark: SparkSession, folder: str, glob: str = "*", prefix: str = "") -> DataFrame:
    """(id, path, length) of files, without reading them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    name = F.regexp_replace(ids.basename(F.col("path")), f"^{prefix}", "") if prefix else F.col("path")
    return files.select(ids.filename_to_pid(name).alias("id"), "path", "length")


def log_matches(rows: DataFrame, contains: str, tokens: tuple[int, ...] = (6, 8, 10), value: str = "value") -> DataFrame:
    """The given tokens (from 1) of the lines with a fixed text."""
    parts = rows.filter(F.contains(F.col(value), F.lit(contains))).withColumn("__p", F.split(F.trim(value), r"\s+"))
    return parts.select(*[F.get("__p", F.lit(t - 1)).alias(f"token{t}") for t in tokens])
