"""Planar geometry as expressions: boxes (x0, y0, x1, y1), and convex rings as array<struct<x, y>>, first point repeated last."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def footprint_from_corners(ll: tuple, lr: tuple, ur: tuple, ul: tuple) -> Column:
    """A closed ring from four (x, y) corners: LR, UR, UL, LL, LR."""
    return F.array(*[point(*c) for c in (lr, ur, ul, ll, lr)])


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The box as a ring, anticlockwise."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def parse_wkt(text: Column) -> Column:
    """The outer ring of a POLYGON text."""
    inner = F.regexp_extract(text, r"(?i)POLYGON\s*\(\(([^()]*)\)", 1)
    parts = F.transform(F.split(inner, r"\s*,\s*"), lambda p: F.split(F.trim(p), r"\s+"))
    return F.when(inner != "", F.transform(parts, lambda p: point(p[0], p[1])))


def to_wkt(ring: Column) -> Column:
    return F.concat(F.lit("POLYGON (("), F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit("))"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value made once, however often the body names it: expressions on arrays are else made again at each place."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _edges(ring: Column) -> Column:
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def signed_area(ring: Column) -> Column:
    doubled = lambda r: F.aggregate(_edges(r), F.lit(0.0), lambda t, e: t + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    return let(ring, lambda r: F.when(F.size(r) >= 4, doubled(r) / 2).otherwise(0.0))


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def centroid(ring: Column) -> Column:
    """Of the area; struct<x, y>, null without area."""
    start = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(t, e):
        cross = e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]
        return F.struct((t["x"] + (e["a"]["x"] + e["b"]["x"]) * cross).alias("x"), (t["y"] + (e["a"]["y"] + e["b"]["y"]) * cross).alias("y"))

    both = lambda r: F.struct(F.aggregate(_edges(r), start, add).alias("total"), signed_area(r).alias("whole"))
    return let(let(ring, both), lambda s: F.when(s["whole"] != 0, point(s["total"]["x"] / (6 * s["whole"]), s["total"]["y"] / (6 * s["whole"]))))


def bounds(ring: Column) -> tuple[Column, Column, Column, Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def num_points(ring: Column) -> Column:
    return F.size(ring)


def make_valid(ring: Column) -> Column:
    """Without repeated points, closed and anticlockwise; null with fewer than three corners."""
    empty = F.array().cast(RING)
    apart = F.aggregate(ring, empty, lambda t, p: F.when((F.size(t) > 0) & (F.element_at(t, -1) == p), t).otherwise(F.array_append(t, p)))
    closed = let(apart, lambda a: F.when(F.element_at(a, 1) == F.element_at(a, -1), a).otherwise(F.array_append(a, F.element_at(a, 1))))
    return let(closed, lambda c: F.when(F.size(c) >= 4, F.when(signed_area(c) < 0, F.reverse(c)).otherwise(c)))


def clip(subject: Column, clipper: Column) -> Column:
    """The common part of two convex anticlockwise rings, cut by one half-plane after another; empty if none."""

    def side(e, p):
        return (e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (p["x"] - e["a"]["x"])

    def cut(ring, e):
        def piece(f):
            return let(F.struct(side(e, f["a"]).alias("a"), side(e, f["b"]).alias("b")), lambda s: kept_of(f, s["a"], s["b"]))

        def kept_of(f, sa, sb):
            t = sa / (sa - sb)
            cross = point(f["a"]["x"] + t * (f["b"]["x"] - f["a"]["x"]), f["a"]["y"] + t * (f["b"]["y"] - f["a"]["y"]))
            none = F.array().cast(RING)
            return F.when((sa >= 0) & (sb >= 0), F.array(f["b"])).when((sa >= 0) & (sb < 0), F.array(cross)).when((sa < 0) & (sb >= 0), F.array(cross, f["b"])).otherwise(none)

        kept = F.flatten(F.transform(_edges(ring), piece))
        return let(kept, lambda k: F.when(F.size(k) > 0, F.concat(F.array(F.element_at(k, -1)), k)).otherwise(F.array().cast(RING)))

    return F.aggregate(let(clipper, _edges), subject, cut)


def convex_intersects(a: Column, b: Column) -> Column:
    """Whether two convex rings meet, borders included: no edge of either separates them."""

    def separated(r, s):
        return F.exists(_edges(r), lambda e: ~F.exists(s, lambda p: (e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (p["x"] - e["a"]["x"]) >= 0))

    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: ~(separated(s["a"], s["b"]) | separated(s["b"], s["a"])))


def convex_overlaps(a: Column, b: Column) -> Column:
    """Whether the interiors meet and neither ring holds the other."""
    return let(area(clip(a, b)), lambda both: (both > 0) & (both < area(a)) & (both < area(b)))


def box_intersection(a: list[Column], b: list[Column]) -> tuple[Column, Column, Column, Column]:
    return F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])


def box_area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(x1 - x0, F.lit(0.0)) * F.greatest(y1 - y0, F.lit(0.0))


def box_intersects(a: list[Column], b: list[Column]) -> Column:
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def box_within(a: list[Column], b: list[Column]) -> Column:
    return (a[0] >= b[0]) & (a[1] >= b[1]) & (a[2] <= b[2]) & (a[3] <= b[3])


def box_overlaps(a: list[Column], b: list[Column]) -> Column:
    """Interiors meet and neither box holds the other."""
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3]) & ~box_within(a, b) & ~box_within(b, a)


def min_rotated_rect(ring: Column) -> Column:
    """struct<height, width> of the smallest rectangle with a side along an edge of the convex ring; null without area."""

    def fit(r, e):
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        return let(F.struct(dx.alias("x"), dy.alias("y"), F.sqrt(dx * dx + dy * dy).alias("d")), lambda d: along_edge(r, d["x"], d["y"], d["d"]))

    def along_edge(r, dx, dy, d):
        span = lambda of: let(F.transform(r, of), lambda a: F.array_max(a) - F.array_min(a))
        spans = F.struct(span(lambda p: (p["x"] * dx + p["y"] * dy) / d).alias("u"), span(lambda p: (p["y"] * dx - p["x"] * dy) / d).alias("v"))
        return let(spans, lambda s: F.struct((s["u"] * s["v"]).alias("area"), F.greatest(s["u"], s["v"]).alias("height"), F.least(s["u"], s["v"]).alias("width")))

    real = lambda r: F.filter(_edges(r), lambda e: (e["a"]["x"] != e["b"]["x"]) | (e["a"]["y"] != e["b"]["y"]))
    best = let(ring, lambda r: F.array_min(F.transform(real(r), lambda e: fit(r, e))))
    return let(best, lambda b: F.when(b["area"] > 0, F.struct(b["height"].alias("height"), b["width"].alias("width"))))


def hilbert(x: Column, y: Column, x0: float, y0: float, x1: float, y1: float, bits: int = 16) -> Column:
    """Index of a point on a Hilbert curve over the extent; neighbours on the curve are neighbours in the plane."""
    top = (1 << bits) - 1
    cell = lambda v, a, b: F.least(F.greatest(F.floor((v - a) / (b - a) * (1 << bits)), F.lit(0)), F.lit(top)).cast("long")
    start = F.struct(cell(x, x0, x1).alias("x"), cell(y, y0, y1).alias("y"), F.lit(0).cast("long").alias("d"))

    def step(t, k):
        s = F.lit(1).cast("long") * F.pow(F.lit(2.0), k).cast("long")
        rx = F.when(t["x"].bitwiseAND(s) > 0, 1).otherwise(0)
        ry = F.when(t["y"].bitwiseAND(s) > 0, 1).otherwise(0)
        d = t["d"] + s * s * (3 * rx).bitwiseXOR(ry)
        fx, fy = F.when((ry == 0) & (rx == 1), s - 1 - t["x"].bitwiseAND(s - 1)).otherwise(t["x"].bitwiseAND(s - 1)), F.when((ry == 0) & (rx == 1), s - 1 - t["y"].bitwiseAND(s - 1)).otherwise(t["y"].bitwiseAND(s - 1))
        return F.struct(F.when(ry == 0, fy).otherwise(fx).cast("long").alias("x"), F.when(ry == 0, fx).otherwise(fy).cast("long").alias("y"), d.cast("long").alias("d"))

    return F.aggregate(F.reverse(F.sequence(F.lit(0), F.lit(bits - 1))), start, step, lambda t: t["d"])


def buffer_box(box: list[Column], size: float) -> tuple[Column, Column, Column, Column]:
    return box[0] - size, box[1] - size, box[2] + size, box[3] + size


def round_out_bounds(box: list[Column]) -> tuple[Column, Column, Column, Column]:
    """Outward to half units."""
    return F.floor(box[0]) - 0.5, F.floor(box[1]) - 0.5, F.ceil(box[2]) + 0.5, F.ceil(box[3]) + 0.5


def bounds_minmax(box: list[Column]) -> Column:
    return F.concat_ws(" ", *[c.cast("string") for c in box])


def bounds_ullr(box: list[Column]) -> Column:
    """Upper left, lower right."""
    return F.concat_ws(" ", *[c.cast("string") for c in (box[0], box[3], box[2], box[1])])


def to_polar_stereographic(lon: Column, lat: Column, lat0: float, lon0: float, radius: float = 1737400.0) -> tuple[Column, Column]:
    """Spherical stereographic coordinates about (lat0, lon0); the pole itself for lat0 = +-90."""
    f, f0, d = F.radians(lat), F.radians(F.lit(float(lat0))), F.radians(lon - lon0)
    k = 2 * radius / (1 + F.sin(f0) * F.sin(f) + F.cos(f0) * F.cos(f) * F.cos(d))
    return k * F.cos(f) * F.sin(d), k * (F.cos(f0) * F.sin(f) - F.sin(f0) * F.cos(f) * F.cos(d))


def _crossings(x: Column, y: Column, edges: Column) -> Column:
    crossed = F.filter(edges, lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]))
    return F.size(crossed)


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """By the parity of crossed edges; for rings of any shape."""
    return _crossings(x, y, let(ring, _edges)) % 2 == 1


def cells_of(ring: Column, size: float) -> Column:
    """array<struct<i, j>> of the grid cells whose centres lie in the ring; exact to the cell size."""
    span = lambda a, b: F.sequence(F.floor(a / size).cast("long"), F.floor(b / size).cast("long"))

    def parts(r):
        x0, y0, x1, y1 = bounds(r)
        return F.struct(span(x0, x1).alias("i"), span(y0, y1).alias("j"), _edges(r).alias("edges"))

    every = lambda s: F.flatten(F.transform(s["i"], lambda i: F.transform(s["j"], lambda j: F.struct(i.alias("i"), j.alias("j")))))
    return let(let(ring, parts), lambda s: F.filter(every(s), lambda c: _crossings((c["i"] + 0.5) * size, (c["j"] + 0.5) * size, s["edges"]) % 2 == 1))


def pair_coverage(pair_area: Column, left_area: Column) -> Column:
    """Percent."""
    return 100.0 * pair_area / left_area
