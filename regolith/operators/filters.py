"""Predicates and filters on images, pairs and statistics."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regolith.functions import angles, ids

#: Columns of longitudes in the index (fixed values).
LONGITUDES = ["center_longitude", "sub_solar_longitude", "sub_spacecraft_longitude", "lower_left_longitude", "lower_right_longitude", "upper_left_longitude", "upper_right_longitude"]
_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq, "!=": operator.ne}


def normalize_longitude(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = columns or [c for c in rows.columns if c.lower() in LONGITUDES]
    return rows.withColumns({c: angles.normalize_longitude(F.col(c)) for c in names})


def cover_filter(rows: DataFrame, incidence: float = 95, resolution: float = 5, emission: float = 20, slew: float = 10) -> DataFrame:
    return rows.filter((F.col("incidence_angle") < incidence) & (F.col("resolution") <= resolution) & (F.col("emission_angle") <= emission) & (F.col("slew_angle") <= slew))


def min_fraction_filter(rows: DataFrame, least: float = 0.0025) -> DataFrame:
    return rows.filter(F.col("fraction_area") > least)


def pair_filters(pairs: DataFrame, max_gsd_ratio: float = 2.25, min_roi_percent: float = 0.00005, min_overlap_percent: float = 25, min_extent: float = 1000) -> DataFrame:
    """On pairs with the columns of ``plans.stereo``: ground sampling, coverage of the region, overlap and extents."""
    return pairs.filter(
        (angles.gsd_ratio(F.col("l_resolution"), F.col("r_resolution")) < max_gsd_ratio) & (F.col("roi_overlap_percent") > min_roi_percent)
        & (F.col("overlap_percent") > min_overlap_percent) & (F.col("px1") - F.col("px0") >= min_extent) & (F.col("py1") - F.col("py0") >= min_extent)
    )


def emission_band(least: float = 6, most: float = 30) -> Column:
    return F.abs(F.col("r_emission_angle") - F.col("l_emission_angle")).between(least, most)


def sliver_filter(pairs: DataFrame, max_aspect: float = 5, max_separation: float = 30) -> DataFrame:
    """Common parts that aren't too long, and azimuths strictly closer than the limit."""
    w, h = F.col("px1") - F.col("px0"), F.col("py1") - F.col("py0")
    apart = angles.angular_separation(F.col("l_roi_sub_solar_ground_azimuth"), F.col("r_roi_sub_solar_ground_azimuth"))
    return pairs.filter((F.greatest(w, h) <= max_aspect * F.least(w, h)) & (apart < max_separation))


def residual_filter(rows: DataFrame, max_median: float = 1.25, min_count: int = 1, mode: str = "verify") -> DataFrame:
    """``verify``: median below, count at least; ``inspect``: median up to, over counts above 0; ``stereo``: finite, count above."""
    m, n = F.col("median"), F.col("cnt")
    if mode == "verify":
        return rows.filter((m < max_median) & (n >= min_count))
    if mode == "inspect":
        return rows.filter((n > 0) & (m <= max_median) & (n >= min_count))
    if mode == "stereo":
        return rows.filter(~F.isnan(m) & (F.abs(m) < float("inf")) & (m < max_median) & (n > min_count))
    raise ValueError(mode)


def match_filter(pairs: DataFrame, min_count: int) -> DataFrame:
    return pairs.filter(F.col("num") >= min_count)


def offset_filter(rows: DataFrame, min_count: int, max_p85: float) -> DataFrame:
    return rows.filter((F.col("cnt") >= min_count) & (F.col("p85") <= max_p85))


def convergence_filter(rows: DataFrame, least: float = 10, most: float = 22, matches: int = 20) -> DataFrame:
    return rows.filter((F.col("num_matches") > matches) & (F.col("p75") >= least) & (F.col("p75") < most))


def by_stat(rows: DataFrame, column: str, compare: str, value: float) -> DataFrame:
    """Rows whose column compares so with the value, in the column's order; only the six comparisons are taken."""
    if compare not in _COMPARE or column not in rows.columns:
        raise ValueError(f"no such comparison: {column} {compare}")
    return rows.filter(_COMPARE[compare](F.col(column), F.lit(value))).orderBy(column)


def by_id_substring(rows: DataFrame, column: str, part: str, order: str = "p95") -> DataFrame:
    return rows.filter(F.contains(F.col(column), F.lit(part))).orderBy(order)


def between_left_inclusive(rows: DataFrame, column: str, least: float, most: float) -> DataFrame:
    if column not in rows.columns:
        raise ValueError(f"no column {column}")
    return rows.filter((F.col(column) >= least) & (F.col(column) < most))


def bbox_filter(rows: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    return rows.filter((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0))


def archive_filter(rows: DataFrame, incidence: tuple[float, float], emission: tuple[float, float], max_resolution: float) -> DataFrame:
    """A null resolution passes."""
    return rows.filter(F.col("incidence_angle").between(*incidence) & F.col("emission_angle").between(*emission) & F.coalesce(F.col("resolution") <= max_resolution, F.lit(True)))


def dem_diff_filter(rows: DataFrame, column: str, limit: float, absolute: bool = True) -> DataFrame:
    return rows.filter((F.abs(F.col(column)) if absolute else F.col(column)) <= limit)


def gsd_below(rows: DataFrame, limit: float, column: str = "gsd") -> DataFrame:
    return rows.filter(~F.isnan(column) & (F.col(column) < limit))


def keep_lit(images: DataFrame, stats: DataFrame, least: float = 0.005, valid_percent: float = 0.2, key: str = "raster_id") -> DataFrame:
    """Listed images with known statistics that are bright and valid enough; a missing percent counts as 100; in order."""
    ok = stats.filter((F.col("max_v") >= least) & (F.coalesce("valid_percent", F.lit(100.0)) >= valid_percent))
    return images.join(ok, key).orderBy("pos")


def shift_magnitude_gate(rows: DataFrame, dx: str = "dx", dy: str = "dy", limit: float = 2.0) -> DataFrame:
    return rows.filter(F.hypot(dx, dy) < limit)


def substring_filter(lines: DataFrame, patterns: DataFrame, keep: bool = True, value: str = "value") -> DataFrame:
    """Lines with (or without) any of the fixed strings in them."""
    from regolith.operators.joins import containing

    found = containing(lines, patterns, value, value).select(F.col("text").alias(value)).distinct()
    return lines.join(found, value, "left_semi" if keep else "left_anti")


def asset_substring_match(names: DataFrame, parts: list[str], column: str = "name") -> DataFrame:
    """Names that hold any of a few texts, whatever the case; distinct and sorted."""
    hit = F.lit(False)
    for p in parts:
        hit |= F.contains(F.lower(column), F.lit(p.lower()))
    return names.filter(hit).select(column).distinct().orderBy(column)


def missing_assets(images: DataFrame, assets: DataFrame, key: str = "id") -> DataFrame:
    """Listed images without a non-empty file."""
    return images.join(assets.filter("length > 0"), key, "left_anti")


def pose_change_severity(rows: DataFrame, column: str, drop: float = 250, severe: float = 1000) -> DataFrame:
    c = F.col(column)
    return rows.withColumn("severity", F.when(c > severe, "severe").when(c > drop, "drop").otherwise("keep"))
