"""Stereo and overlap pairs of images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regolith.functions import angles as a
from regolith.functions import geometry
from regolith.operators import filters, joins, spatial


def scored(pairs: DataFrame) -> DataFrame:
    """With the qualities of viewing and illumination, and ``overall_quality``."""
    l, r = lambda c: F.col("l_" + c), lambda c: F.col("r_" + c)  # noqa: E731, E741
    az, sun = "sub_spacecraft_ground_azimuth", "roi_sub_solar_ground_azimuth"
    rows = pairs.withColumns({
        "parallax": a.parallax(l("emission_angle"), l(az), r("emission_angle"), r(az)),
        "dp": a.parallax_height_ratio(l("emission_angle"), l(az), r("emission_angle"), r(az)),
        "dsh": a.shadow_tip_distance(l("incidence_angle"), l(sun), r("incidence_angle"), r(sun)),
        "gsd_ratio": a.gsd_ratio(l("resolution"), r("resolution")),
    })
    qualities = {
        "l_incidence_quality": a.incidence_quality(l("incidence_angle")), "r_incidence_quality": a.incidence_quality(r("incidence_angle")),
        "l_emission_quality": a.emission_quality(l("emission_angle")), "r_emission_quality": a.emission_quality(r("emission_angle")),
        "l_phase_quality": a.phase_quality(l("phase_angle")), "r_phase_quality": a.phase_quality(r("phase_angle")),
        "gsd_quality": a.gsd_quality(l("resolution"), r("resolution")), "stereo_quality": a.stereo_strength_quality(F.col("dp")),
        "illumination_quality": a.illumination_quality(F.col("dsh")), "sun_quality": a.delta_solar_az_quality(l(sun), r(sun)),
    }
    rows = rows.withColumns(qualities)
    return rows.withColumn("overall_quality", a.overall_quality(*[F.col(c) for c in qualities]))


def with_coverage(pairs: DataFrame, roi: DataFrame, roi_predicate: str = "overlaps") -> DataFrame:
    """With the common box px0 .., its percent of the left image, and the pair's percent of the region, where it meets the region so."""
    names = ("px0", "py0", "px1", "py1")
    common = geometry.box_intersection(spatial.box("l_"), spatial.box("r_"))
    # generated, so that it is made once for each pair, after the join, and not again in every condition on it
    once = F.inline(F.array(F.struct(*[c.alias(n) for n, c in zip(names, common, strict=True)])))
    rows = spatial.with_roi(pairs.select("*", once), roi)
    part, region = [F.col(c) for c in names], spatial.box("roi_")
    test = {"overlaps": geometry.box_overlaps, "intersects": geometry.box_intersects}[roi_predicate]
    rows = rows.filter(test(part, region))
    return rows.withColumns({
        "overlap_percent": geometry.pair_coverage(geometry.box_area(*part), geometry.box_area(*spatial.box("l_"))),
        "roi_overlap_percent": geometry.pair_coverage(geometry.box_area(*geometry.box_intersection(part, region)), geometry.box_area(*region)),
    }).drop(*["roi_" + c for c in spatial.BOX])


def raw_pairs(images: DataFrame, min_emission: float = 6, max_emission: float = 30) -> DataFrame:
    return spatial.overlapping_pairs(images, filters.emission_band(min_emission, max_emission))


def find_stereo(images: DataFrame, roi: DataFrame, roi_predicate: str = "overlaps", min_emission: float = 6, max_emission: float = 30, max_separation: float = 30, **limits: float) -> DataFrame:
    """Compatible overlapping pairs over the region, scored and ordered by what they cover.

    Images that miss the region leave before the self-join: a pair's common part can't meet it otherwise.
    """
    near = spatial.meeting_roi(images, roi).drop(*["roi_" + c for c in spatial.BOX])
    pairs = with_coverage(raw_pairs(near, min_emission, max_emission), roi, roi_predicate)
    kept = filters.sliver_filter(filters.pair_filters(pairs, **limits), max_separation=max_separation)
    return scored(kept).orderBy(F.desc("roi_overlap_percent"), F.desc("overlap_percent"))


def find_overlaps(images: DataFrame, max_separation: float = 2.0, exclude_same_observation: bool = True) -> DataFrame:
    """Pairs for bundle adjustment: meeting boxes, close azimuths."""
    return spatial.intersecting_pairs(images, max_separation, exclude_same_observation)


def missed(images: DataFrame, pairs: DataFrame) -> DataFrame:
    return joins.missed_ids(images, pairs, "l_product_id", "r_product_id")
