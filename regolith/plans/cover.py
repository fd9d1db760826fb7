"""Images over a region: the cover query and the index behind it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regolith.functions import angles, geometry
from regolith.operators import filters, spatial, windows
from regolith.sources import readers, writers


def covering(images: DataFrame, roi: DataFrame, restrict: DataFrame | None = None, **limits: float) -> DataFrame:
    """Images over the region with ``fraction_area``, the covered part of the region's area, before numbering."""
    rows = images if restrict is None else images.join(restrict.select("product_id"), "product_id", "left_semi")
    rows = filters.cover_filter(spatial.meeting_roi(rows, roi), **limits)
    common = geometry.box_intersection(spatial.box(), spatial.box("roi_"))
    share = geometry.box_area(*common) / geometry.box_area(*spatial.box("roi_"))
    return rows.withColumn("fraction_area", share).drop(*["roi_" + c for c in spatial.BOX])


def cover(images: DataFrame, roi: DataFrame, least_fraction: float = 0.0025, legacy_gaps: bool = False, extent: tuple[float, float, float, float] = (0.0, 0.0, 32768.0, 32768.0), **limits: float) -> DataFrame:
    """Covering images in the order of their illumination, with orderid and whether each meets the one before.

    Numbers follow the fraction filter; ``legacy_gaps`` numbers first, so that numbers have gaps.
    """
    rows = covering(images, roi, **limits)
    if legacy_gaps:
        numbered = filters.min_fraction_filter(windows.order_images(rows, extent), least_fraction)
        boxed = windows.global_rank(numbered, ["orderid"], "__n")
        return windows.intersects_prior(boxed, "__n").drop("__n")
    return windows.intersects_prior(windows.order_images(filters.min_fraction_filter(rows, least_fraction), extent))


def with_ground_azimuths(index: DataFrame) -> DataFrame:
    """Bearings from the centre of each image to the sub-solar and sub-spacecraft points."""
    at = lambda p: angles.ground_azimuth(F.col("center_latitude"), F.col("center_longitude"), F.col(f"{p}_latitude"), F.col(f"{p}_longitude"))
    known = [p for p in ("sub_solar", "sub_spacecraft") if f"{p}_latitude" in index.columns]
    return index.withColumns({f"{p}_ground_azimuth": at(p) for p in known})


def prep_index(index: DataFrame) -> DataFrame:
    """Longitudes to [-180, 180], ground azimuths, and the footprint ring of the corner columns."""
    rows = with_ground_azimuths(filters.normalize_longitude(index))
    corner = lambda p: (F.col(f"{p}_longitude"), F.col(f"{p}_latitude"))
    if "lower_left_longitude" in rows.columns:
        rows = rows.withColumn("ring", geometry.footprint_from_corners(*[corner(p) for p in ("lower_left", "lower_right", "upper_right", "upper_left")]))
    return rows


def polar_subset(index: DataFrame, south: bool = True, edge: float = 80.0) -> DataFrame:
    """Images beyond the latitude with polar stereographic rings and boxes, ready for the index writer."""
    lat0 = -90.0 if south else 90.0
    meets = F.exists("ring", lambda p: p["y"] <= -edge if south else p["y"] >= edge)

    def project(p):
        x, y = geometry.to_polar_stereographic(p["x"], p["y"], lat0, 0.0)
        return geometry.point(x, y)

    rows = index.filter(meets).withColumn("ring", F.transform("ring", project))
    return rows.withColumns(dict(zip(spatial.BOX, geometry.bounds(F.col("ring")), strict=True)))


def make_index(spark, csv: str, names: list[str], kinds: dict[str, str], target: str, extent: tuple[float, float, float, float]) -> None:
    """From index CSV to a curve-ordered Parquet table."""
    rows = prep_index(readers.read_index(spark, csv, names, kinds).toDF(*[n.lower() for n in names if "wac" not in n.lower()]))
    writers.write_index_parquet(rows, target, F.col("center_longitude"), F.col("center_latitude"), extent)
