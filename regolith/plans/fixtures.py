"""Image tables derived from the given tables, in SQL that Spark and DuckDB run alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regolith.session import tasks_for

#: In order: each may use those before it and the given tables.
VIEWS = {
    "images": """
SELECT k, 'M' || lpad(CAST(103000000 + CAST(FLOOR(k / 2) AS BIGINT) AS STRING), 9, '0') || CASE WHEN k % 2 = 0 THEN 'LE' ELSE 'RE' END AS product_id,
  CAST(k % 5000 AS INT) AS orbit_number,
  CAST(k * 37 % 4500 AS DOUBLE) / 100 AS emission_angle, 40 + CAST(k * 53 % 6000 AS DOUBLE) / 100 AS incidence_angle,
  CAST(k * 71 % 12000 AS DOUBLE) / 100 AS phase_angle, CAST((k * k * 7 + k * 97) % 36000 AS DOUBLE) / 100 AS roi_sub_solar_ground_azimuth,
  CAST(k * 61 % 36000 AS DOUBLE) / 100 AS sub_spacecraft_ground_azimuth, 0.5 + CAST(k * 13 % 600 AS DOUBLE) / 100 AS resolution,
  CAST(k * 29 % 2000 AS DOUBLE) / 100 AS slew_angle, CAST(k * 17 % 300 AS DOUBLE) / 100 - 1.5 AS sub_solar_latitude,
  CAST(k * 101 % 36000 AS DOUBLE) / 100 AS sub_solar_longitude, -90 + CAST(k * 41 % 1000 AS DOUBLE) / 100 AS center_latitude,
  CAST(k * 89 % 36000 AS DOUBLE) / 100 AS center_longitude,
  CAST(20000 * (field % 8) + k * 7919 % 20011 AS DOUBLE) AS x0, CAST(20000 * CAST(FLOOR(field / 8) AS BIGINT) + (k * k * 31 + k * 104729) % 20021 AS DOUBLE) AS y0,
  CAST(20000 * (field % 8) + k * 7919 % 20011 + 1200 + k * 11 % 2000 AS DOUBLE) AS x1, CAST(20000 * CAST(FLOOR(field / 8) AS BIGINT) + (k * k * 31 + k * 104729) % 20021 + 2000 + k * 19 % 4000 AS DOUBLE) AS y1
FROM (SELECT CAST(c_custkey AS BIGINT) AS k, CAST(FLOOR(c_custkey / 1500) AS BIGINT) AS field FROM customer) t""",
    "sizes": """
SELECT greatest(1, CAST(FLOOR((SELECT count(*) FROM customer) / 15) AS BIGINT)) AS blocks, (SELECT count(*) FROM supplier) AS rasters""",
    "roi": "SELECT CAST(4000 AS DOUBLE) AS x0, CAST(4000 AS DOUBLE) AS y0, CAST(16000 AS DOUBLE) AS x1, CAST(16000 AS DOUBLE) AS y1",
    "pair_stats": """
SELECT 'img/' || a.product_id || '.cal.echo.cub' AS l_image, 'img/' || b.product_id || '.cal.echo.cub' AS r_image, p25, p50, p75, p85, p95, num
FROM (SELECT CAST(l_orderkey % blocks * 15 + l_partkey % 15 AS BIGINT) AS i, CAST(l_orderkey % blocks * 15 + l_suppkey * 7 % 15 AS BIGINT) AS j,
       MIN(l_quantity) / 10 AS p25, MIN(l_quantity) / 10 + 0.5 AS p50, MAX(l_quantity) / 20 AS p75, MAX(l_quantity) / 16 AS p85, MAX(l_quantity) / 10 AS p95,
       CAST(COUNT(*) * 10 AS BIGINT) AS num
     FROM lineitem, sizes GROUP BY 1, 2) p JOIN images a ON a.k = p.i JOIN images b ON b.k = p.j WHERE p.i < p.j""",
    "residual_stats": """
SELECT 'img/' || product_id || '.cal.echo.cub' AS image, CAST(k * 67 % 300 AS DOUBLE) / 100 AS mean,
  CASE WHEN k % 41 = 40 THEN CAST('NaN' AS DOUBLE) ELSE CAST(k * 73 % 250 AS DOUBLE) / 100 END AS median, CAST(k * 31 % 500 AS BIGINT) AS cnt FROM images""",
    "offset_stats": """
SELECT 'img/' || product_id || '.cal.echo.cub' AS image, CAST(k * 7 % 100 AS DOUBLE) / 100 AS p25, CAST(k * 7 % 100 AS DOUBLE) / 100 + 0.2 AS p50,
  CAST(k * 7 % 100 AS DOUBLE) / 100 + 0.5 AS p75, CAST(k * 7 % 100 AS DOUBLE) / 100 + 0.8 AS p85, CAST(k * 7 % 100 AS DOUBLE) / 15 AS p95, CAST(k * 31 % 500 AS BIGINT) AS cnt FROM images""",
    "camera_offsets": """
SELECT 'img/' || product_id || '.cal.echo.cub' AS image, CASE WHEN k % 9 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(k * 43 % 1500 AS DOUBLE) END AS horiz,
  CASE WHEN k % 9 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(k * 47 % 900 AS DOUBLE) END AS vert FROM images""",
    "convergence": "SELECT l_image, r_image, p25 * 4 AS p25, p50 * 4 AS p50, p75 * 6 AS p75, num AS num_matches FROM pair_stats",
    "edges": """
SELECT DISTINCT i AS src, j AS dst FROM (SELECT CAST(l_orderkey % blocks * 15 + l_partkey % 15 AS BIGINT) AS i,
  CAST(l_orderkey % blocks * 15 + l_suppkey * 7 % 15 AS BIGINT) AS j FROM lineitem, sizes) t WHERE i < j AND (i * 31 + j * 17) % 11 = 0""",
    "pixels": """
SELECT CAST(l_suppkey % rasters AS INT) AS raster_id, CAST(l_orderkey % 64 AS INT) AS x, CAST(l_partkey % 64 AS INT) AS y, MAX(l_discount) AS v
FROM lineitem, sizes GROUP BY 1, 2, 3""",
    "registered_ids": "SELECT product_id FROM images WHERE k % 3 = 0",
    "id_list": "SELECT k + 1 AS pos, 'img/' || product_id || '.cal.echo.cub' AS value FROM images WHERE k % 2 = 0",
}
#: How the views put the one row of sizes beside lineitem, and how Spark does: a join would become a nested loop under the views' filters.
BESIDE = "FROM lineitem, sizes"
IN_SPARK = "FROM (SELECT *, (SELECT blocks FROM sizes) AS blocks, (SELECT rasters FROM sizes) AS rasters FROM lineitem) s"
#: How Spark reads the images: the table is a few MB for a million rows, and so one task of the scan; dealt by key, what queries make of each image is spread.
IMAGES = "FROM (SELECT CAST(c_custkey AS BIGINT) AS k,"
DEALT = "FROM (SELECT /*+ REPARTITION({0}, k) */ CAST(c_custkey AS BIGINT) AS k,"
#: How Spark groups the pixels: nearly every row of lineitem is a pixel of its own, so rows are dealt by pixel, a bounded number to a task, and grouped there.
PIXELS = """SELECT raster_id, x, y, MAX(l_discount) AS v FROM (SELECT /*+ REPARTITION({0}, {1}) */
  CAST(l_suppkey % rasters AS INT) AS raster_id, CAST(l_orderkey % 64 AS INT) AS x, CAST(l_partkey % 64 AS INT) AS y, l_discount FROM lineitem, sizes) p GROUP BY 1, 2, 3"""
#: What each view needs.
NEEDS = {
    "images": ["customer"], "roi": [], "sizes": ["customer", "supplier"], "pair_stats": ["lineitem", "images", "sizes"], "residual_stats": ["images"], "offset_stats": ["images"], "camera_offsets": ["images"],
    "convergence": ["pair_stats"], "edges": ["lineitem", "sizes"], "pixels": ["lineitem", "sizes"], "registered_ids": ["images"], "id_list": ["images"],
}


def _closure(names: tuple[str, ...]) -> list[str]:
    wanted: set[str] = set()

    def add(n: str) -> None:
        if n not in wanted:
            wanted.add(n)
            for m in NEEDS.get(n, []):
                add(m)

    for n in names:
        add(n)
    return [n for n in VIEWS if n in wanted] + sorted(n for n in wanted if n not in VIEWS)


def with_views(*names: str) -> str:
    """``WITH`` clause of the views for SQL over the given tables."""
    own = [n for n in _closure(names) if n in VIEWS]
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in own) + "\n"


def load(spark: SparkSession, sf_dir: str, name: str, dealt_by: str = "raster_id, x, y") -> DataFrame:
    """A view, or a given table, over the tables of a folder. Pixels are dealt over tasks by ``dealt_by``: with "raster_id", where rasters
    are small, what is grouped by raster needs no other exchange."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    whole = _closure((name,))
    given = [f"{n} AS (SELECT * FROM parquet.`{sf_dir}/{n}.parquet`)" for n in whole if n not in VIEWS]
    dealt = DEALT.format(spark.conf.get("spark.sql.shuffle.partitions"))
    view = dict(VIEWS)
    if "pixels" in whole:
        view["pixels"] = PIXELS.format(tasks_for(spark.read.parquet(f"{sf_dir}/lineitem.parquet")), dealt_by)
    own = [f"{n} AS ({view[n].replace(BESIDE, IN_SPARK).replace(IMAGES, dealt)})" for n in whole if n in VIEWS]
    return spark.sql("WITH " + ", ".join(given + own) + f"\nSELECT * FROM {name}")
