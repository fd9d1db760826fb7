"""Sinks: each has a function that shapes the rows, and one that writes them where that says more than ``df.write``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regolith.functions import geometry, ids

COVER_COLUMNS = ["product_id", "incidence_angle", "fraction_area", "roi_sub_solar_ground_azimuth", "resolution"]


def write_cover_csv(cover: DataFrame, path: str) -> None:
    cover.select(*COVER_COLUMNS).write.csv(path, header=True)


def curve_ordered(rows: DataFrame, x: Column, y: Column, extent: tuple[float, float, float, float], files: int) -> DataFrame:
    """Rows in the order of a Hilbert curve over the extent, in range partitions: near in the plane, near on disk."""
    keyed = rows.withColumn("__curve", geometry.hilbert(x, y, *extent))
    return keyed.repartitionByRange(files, "__curve").sortWithinPartitions("__curve").drop("__curve")


def write_index_parquet(rows: DataFrame, path: str, x: Column, y: Column, extent: tuple[float, float, float, float], files: int = 8, block_mb: int = 16) -> None:
    """ZSTD Parquet in the curve's order, so that row groups' box statistics prune reads of a region."""
    ordered = curve_ordered(rows, x, y, extent, files)
    ordered.write.option("compression", "zstd").option("parquet.block.size", block_mb << 20).parquet(path)


def pair_lines(pairs: DataFrame, left: str, right: str, prefix: str = "", postfix: str = "") -> DataFrame:
    """(value): ``left right`` with prefix and postfix on both."""
    full = lambda c: F.concat(F.lit(prefix), F.col(c), F.lit(postfix))
    return pairs.select(F.concat_ws(" ", full(left), full(right)).alias("value"))


def write_pair_list(pairs: DataFrame, path: str, left: str, right: str, prefix: str = "", postfix: str = "") -> None:
    pair_lines(pairs, left, right, prefix, postfix).write.text(path)


def report_json(report: DataFrame, **parameters) -> DataFrame:
    """(value): the report's row as JSON with the parameters of the query."""
    extra = [F.lit(v).alias(k) for k, v in parameters.items()]
    return report.select(F.to_json(F.struct(*[F.col(c) for c in report.columns], *extra)).alias("value"))


def write_connectivity_json(report: DataFrame, path: str, **parameters) -> None:
    report_json(report, **parameters).write.text(path)


def id_lines(rows: DataFrame, value: str = "value", pos: str | None = None, unique: bool = False) -> DataFrame:
    """(value) ordered by position if given, else sorted; once each if unique."""
    if unique:
        return rows.select(F.col(value).alias("value")).distinct().orderBy("value")
    return rows.orderBy(pos or value).select(F.col(value).alias("value"))


def write_id_list(rows: DataFrame, path: str, value: str = "value", pos: str | None = None, unique: bool = False) -> None:
    id_lines(rows, value, pos, unique).write.text(path)


def product_lines(products: DataFrame, columns: list[str], url: str = "url") -> DataFrame:
    """(value): fields joined by spaces, in the order of their ids; the URL last where there is one."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
    return products.orderBy(columns[0]).select(F.concat_ws(" ", *text, F.when(F.coalesce(F.col(url), F.lit("")) != "", F.col(url))).alias("value"))


def write_product_table(products: DataFrame, path: str, columns: list[str], url: str = "url") -> None:
    header = products.sparkSession.range(1).select(F.lit("# " + " ".join(columns)).alias("value"))
    header.unionAll(product_lines(products, columns, url)).coalesce(1).write.text(path)


def tiles_to_geojson(tiles: DataFrame) -> DataFrame:
    """(value): a Polygon feature for each tile with i and j."""
    ring = F.array(*[F.array(F.col(x), F.col(y)) for x, y in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny"))])
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return tiles.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct("i", "j").alias("properties"), shape.alias("geometry"))).alias("value"))


def write_geo_table(rows: DataFrame, path: str, ring: str = "ring", crs: str | None = None) -> None:
    """Parquet with the ring as WKT in ``geometry``."""
    out = rows.withColumn("geometry", geometry.to_wkt(F.col(ring))).drop(ring)
    (out.withColumn("crs", F.lit(crs)) if crs else out).write.parquet(path)


def catalog_items(images: DataFrame, assets: DataFrame) -> DataFrame:
    """(id, item): item JSON for images with exactly one asset and a box; view angles as the catalogue names them."""
    single = assets.groupBy("id").agg(F.count(F.lit(1)).alias("__n"), F.first("path").alias("href")).filter("__n = 1").drop("__n")
    rows = images.join(single, images["product_id"] == single["id"]).filter("x0 <= x1 AND y0 <= y1")
    properties = F.struct(
        F.col("start_time").cast("string").alias("datetime"), F.col("resolution").alias("gsd"), F.col("emission_angle").alias("view:incidence_angle"),
        F.col("roi_sub_solar_ground_azimuth").alias("view:sun_azimuth"), (90 - F.col("incidence_angle")).alias("view:sun_elevation"),
    )
    item = F.struct(F.lit("Feature").alias("type"), F.col("product_id").alias("id"), F.array("x0", "y0", "x1", "y1").alias("bbox"), properties.alias("properties"), F.struct(F.struct(F.col("href")).alias("image")).alias("assets"))
    return rows.select(F.col("product_id").alias("id"), F.to_json(item).alias("item"))


def catalog_collections(images: DataFrame, size: int = 20, azimuth: str = "roi_sub_solar_ground_azimuth") -> DataFrame:
    """One row for each near-equal chunk of the images by azimuth: name, n, box, azimuth range, and time range if there.

    Chunks follow from counts of distinct azimuths and ids only through ntile over the whole table, which is a report of
    thousands of rows; the images themselves may be many, so only the two sort columns are ranked.
    """
    from regolith.operators.windows import global_rank

    total = images.count()
    chunks = max(1, -(-total // size))
    ranked = global_rank(images, [azimuth, "product_id"], "__rank")
    small, more = total // chunks, total % chunks
    head = more * (small + 1)
    chunk = F.when(F.col("__rank") <= head, F.floor((F.col("__rank") - 1) / (small + 1))).otherwise(more + F.floor((F.col("__rank") - 1 - head) / max(1, small)))
    extra = [F.min("start_time").alias("t0"), F.max("start_time").alias("t1")] if "start_time" in images.columns else []
    grouped = ranked.groupBy(chunk.cast("int").alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.min(azimuth).alias("az0"), F.max(azimuth).alias("az1"), *extra)
    return grouped.withColumn("name", F.format_string("collection_%03d", F.col("chunk")))


def attribute_table(rows: DataFrame, value: str = "value", pos: str = "pos") -> DataFrame:
    """(index, name): the base name of the first token of each line."""
    return rows.select(F.col(pos).alias("index"), ids.basename(F.split(F.trim(value), r"\s+")[0]).alias("name"))


def flag_lines(flags: DataFrame, key: str = "id", reasons: str = "reasons") -> DataFrame:
    """(value): ``id : reason; reason``, sorted by id."""
    return flags.orderBy(key).select(F.concat(F.col(key), F.lit(" : "), F.array_join(reasons, "; ")).alias("value"))


def write_flag_report(flags: DataFrame, path: str, key: str = "id", reasons: str = "reasons") -> None:
    flag_lines(flags, key, reasons).write.text(path)


def fingerprint(rows: DataFrame) -> DataFrame:
    """(n, fingerprint): the count and an order-free hash of all rows."""
    return rows.select(F.xxhash64(*rows.columns).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor("h"), F.lit(0).cast("long")).alias("fingerprint"))


def provenance(rows: DataFrame, source: str) -> DataFrame:
    return fingerprint(rows).select(F.lit(source).alias("source"), F.current_timestamp().alias("made"), "n", "fingerprint")


def gsd_rows(tiles: DataFrame) -> DataFrame:
    """(image_id, native_gsd_m) from each raster's own pixel size."""
    return tiles.groupBy(F.col("raster_id").alias("image_id")).agg(F.first("res").alias("native_gsd_m"))


def write_gsd_csv(tiles: DataFrame, path: str) -> None:
    gsd_rows(tiles).write.csv(path, header=True)


