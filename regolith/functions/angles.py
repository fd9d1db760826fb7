"""Expressions on angles, viewing geometry and pair quality. Angles are degrees; a null argument gives null."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MOON_RADIUS_KM = 1737.4


def quality_ideal(v: Column, ideal: float, low: float, high: float) -> Column:
    """1 at the ideal, falling in a line to 0 at the limits and below 0 beyond."""
    if not low <= ideal <= high:
        raise ValueError("the ideal must lie between the limits")
    return quality_bounded(v, ideal, ideal, low, high)


def quality_bounded(v: Column, low_ideal: float, high_ideal: float, low: float, high: float) -> Column:
    """1 between the ideals, falling in a line to 0 at the limits; where a limit is an ideal, -1 beyond it."""
    if not low <= low_ideal <= high_ideal <= high:
        raise ValueError("limits and ideals must be in order")
    below = (v - low) / (low_ideal - low) if low_ideal > low else F.lit(-1.0)
    above = (high - v) / (high - high_ideal) if high > high_ideal else F.lit(-1.0)
    return F.when(v < low_ideal, below).when(v > high_ideal, above).when(v.isNotNull(), 1.0)


def incidence_quality(v: Column) -> Column:
    return quality_ideal(v, 50, 40, 65)


def emission_quality(v: Column) -> Column:
    return quality_ideal(v, 22.5, 0, 45)


def phase_quality(v: Column) -> Column:
    return quality_ideal(v, 60, 5, 120)


def gsd_ratio(a: Column, b: Column) -> Column:
    return F.greatest(a, b) / F.least(a, b)


def gsd_quality(a: Column, b: Column) -> Column:
    return quality_ideal(gsd_ratio(a, b), 1, 1, 2.5)


def stereo_strength_quality(dp: Column) -> Column:
    return quality_bounded(dp, 0.4, 0.6, 0.1, 1)


def illumination_quality(dsh: Column) -> Column:
    return quality_ideal(dsh, 0, 0, 2.58)


def delta_solar_az_quality(a: Column, b: Column, wrap: bool = False) -> Column:
    """Without ``wrap``, 350 and 10 degrees are 340 apart."""
    return quality_bounded(angular_separation(a, b) if wrap else F.abs(a - b), 0, 20, 0, 100)


def stereo_overlap_quality(share: Column) -> Column:
    return quality_bounded(share, 0.5, 1, 0.3, 1)


def parallax(e1: Column, a1: Column, e2: Column, a2: Column) -> Column:
    """Degrees between two look vectors given by emission and ground azimuth."""
    e1, a1, e2, a2 = map(F.radians, (e1, a1, e2, a2))
    dot = F.sin(e1) * F.sin(e2) * F.cos(a1 - a2) + F.cos(e1) * F.cos(e2)
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))))


def _between_tips(i1: Column, a1: Column, i2: Column, a2: Column) -> Column:
    x1, y1 = F.tan(F.radians(i1)) * F.cos(F.radians(a1)), F.tan(F.radians(i1)) * F.sin(F.radians(a1))
    x2, y2 = F.tan(F.radians(i2)) * F.cos(F.radians(a2)), F.tan(F.radians(i2)) * F.sin(F.radians(a2))
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def parallax_height_ratio(e1: Column, a1: Column, e2: Column, a2: Column) -> Column:
    """Distance of the ground displacements of a point of unit height in two looks."""
    return _between_tips(e1, a1, e2, a2)


def shadow_tip_distance(i1: Column, s1: Column, i2: Column, s2: Column) -> Column:
    """Distance of the shadow tips of a post of unit height."""
    return _between_tips(i1, s1, i2, s2)


def angular_separation(a: Column, b: Column) -> Column:
    """0 to 180 degrees around the circle."""
    m = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(m, 360.0 - m)


def ground_azimuth(glat: Column, glon: Column, slat: Column, slon: Column, equal_longitude_zero: bool = False) -> Column:
    """Bearing from a ground point to a sub-spacecraft or sub-solar point.

    The angle at the ground point comes from the spherical triangle with the pole of its hemisphere; the side is east where
    the other longitude, seen the short way round, is larger. ``equal_longitude_zero`` gives 0 for equal longitudes.
    """
    south = glat < 0
    a = F.radians(F.when(south, 90.0 + slat).otherwise(90.0 - slat))
    b = F.radians(F.when(south, 90.0 + glat).otherwise(90.0 - glat))
    far = F.abs(slon - glon) > 180.0
    s = F.when(far & (slon > glon), slon - 360.0).otherwise(slon)
    g = F.when(far & (glon > slon), glon - 360.0).otherwise(glon)
    clip = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))
    c = F.acos(clip(F.cos(a) * F.cos(b) + F.sin(a) * F.sin(b) * F.cos(F.radians(F.abs(g - s)))))
    low = F.sin(b) * F.sin(c)
    at_ground = F.degrees(F.acos(F.when(low == 0, 0.0).otherwise(clip((F.cos(a) - F.cos(b) * F.cos(c)) / F.when(low != 0, low)))))
    bearing = F.when(s > g, F.when(south, 180.0 - at_ground).otherwise(at_ground)).otherwise(F.when(south, 180.0 + at_ground).otherwise(360.0 - at_ground))
    return F.when(s == g, 0.0).otherwise(bearing) if equal_longitude_zero else bearing


def angular_distance(az1: Column, el1: Column, az2: Column, el2: Column) -> Column:
    """Great-circle angle in radians of two directions."""
    x1, y1, z1 = spherical_to_cartesian(az1, el1)
    x2, y2, z2 = spherical_to_cartesian(az2, el2)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x1 * x2 + y1 * y2 + z1 * z2)))


def spherical_to_cartesian(az: Column, el: Column) -> tuple[Column, Column, Column]:
    az, el = F.radians(az), F.radians(el)
    return F.cos(el) * F.cos(az), F.cos(el) * F.sin(az), F.sin(el)


def normalize_azimuth(az: Column) -> Column:
    return F.pmod(az, F.lit(360.0))


def normalize_longitude(lon: Column) -> Column:
    return F.when(lon > 180, lon - 360).otherwise(lon)


def overall_quality(*qualities: Column) -> Column:
    """0 if any is negative, else 1; nulls are passed over."""
    return F.when(reduce(lambda a, b: F.least(a, b), qualities) < 0, 0).otherwise(1)


def opacity(angle: Column, center: Column, visible: float = 5.0, taper: float = 2.0, most: float = 0.7, least: float = 0.005) -> Column:
    """Weight by distance from the centre; the taper never exceeds ``least``, as in the original figures."""
    away = angular_separation(angle, center) - visible / 2
    return F.when(away <= 0, most).when(away <= taper, F.least(F.lit(least), most * (1 - away / taper))).otherwise(least)


def expand_bbox(west: Column, south: Column, east: Column, north: Column, margin_km: float) -> tuple[Column, Column, Column, Column]:
    """The box with a margin on a sphere."""
    lat = math.degrees(margin_km / MOON_RADIUS_KM)
    s, n = F.greatest(south - lat, F.lit(-90.0)), F.least(north + lat, F.lit(90.0))
    lon = lat / F.greatest(F.lit(0.01), F.cos(F.radians(F.greatest(F.abs(south), F.abs(north)))))
    return west - lon, s, east + lon, n
