"""Spatial joins of footprints by grid cells. Boxes are x0, y0, x1, y1; rows with a null or inverted box meet nothing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType, _parse_datatype_string

from regolith.functions import angles, geometry, ids
from regolith.session import stage

BOX = ["x0", "y0", "x1", "y1"]
#: Cells that a footprint may cover on its level; larger footprints go to coarser levels.
MAX_CELLS = 16
#: Levels of cell edges, each LEVEL_STEP times the one before.
LEVELS, LEVEL_STEP = 16, 4
#: Rows of a cell that one task joins; the rows of a fuller cell are dealt over several.
HOT_CELL = 4096
_KEYS = ["__at", "__i", "__j", "__key"]


def box(prefix: str = "") -> list[Column]:
    return [F.col(prefix + c) for c in BOX]


def cell_size(images: DataFrame) -> float:
    """The median of the boxes' longer sides: most footprints then cover a few cells."""
    side = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    found = images.select(F.percentile_approx(side, 0.5, 1000).alias("m")).first()["m"]
    return float(found) if found and found > 0 else 1.0


def _levelled(rows: DataFrame, size: float) -> DataFrame:
    """With ``__level``, the first on which the box covers at most MAX_CELLS cells (the last takes all others)."""
    cells = lambda s: (F.floor(F.col("x1") / s) - F.floor(F.col("x0") / s) + 1) * (F.floor(F.col("y1") / s) - F.floor(F.col("y0") / s) + 1)
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(cells(size * LEVEL_STEP**k) <= MAX_CELLS, k).otherwise(level)
    return rows.filter("x0 <= x1 AND y0 <= y1").withColumn("__level", level)


def _edge(size: float) -> Column:
    return F.lit(size) * F.pow(F.lit(float(LEVEL_STEP)), F.col("__at"))


def _covered(rows: DataFrame, size: float, p: str, columns: list[str]) -> DataFrame:
    """A row for each cell of the grid of level ``__at`` that the box covers."""
    place = lambda a: F.floor(F.col(a) / _edge(size)).cast("long")
    cells = rows.withColumn("__i0", place("x0")).withColumn("__j0", place("y0"))
    cells = cells.withColumn("__i", F.explode(F.sequence("__i0", place("x1")))).withColumn("__j", F.explode(F.sequence("__j0", place("y1"))))
    return cells.select(*[F.col(c).alias(p + c) for c in columns], F.col("__i0").alias(p + "__i0"), F.col("__j0").alias(p + "__j0"), *_KEYS)


def cell_sides(left: DataFrame, right: DataFrame, size: float, key: tuple[Column, Column] | None = None) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The two pairs of sides that ``cell_join`` joins by equality of level, cell and key.

    Every pair of boxes meets on the coarser of their levels. First the left boxes stay on their own level and the right ones
    go up to those levels that left boxes have; then the right ones stay, and the left ones go up to strictly coarser levels.
    A box is on few cells of its own level and on no more of a coarser one, so rows grow by a bounded factor.
    """
    a, b = _levelled(left, size), _levelled(right, size)
    a = a.withColumn("__key", F.lit(0) if key is None else key[0])
    b = b.withColumn("__key", F.lit(0) if key is None else F.explode(key[1]))
    levels = lambda rows: sorted(r[0] for r in rows.select("__level").distinct().collect())  # noqa: E731  (at most LEVELS)
    in_a, in_b = levels(a), levels(b)
    up = lambda rows, of, least: rows.withColumn("__at", F.explode(F.filter(F.array(*map(F.lit, of)), lambda x: x >= F.col("__level") + least)))
    own = lambda rows: rows.withColumn("__at", F.col("__level"))
    if in_a and in_b:
        yield _covered(own(a), size, "l_", left.columns), _covered(up(b, in_a, 0), size, "r_", right.columns)
        coarser = [x for x in in_b if x > in_a[0]]
        if coarser:
            yield _covered(up(a, coarser, 1), size, "l_", left.columns), _covered(own(b), size, "r_", right.columns)


def _dealt(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """The sides with a salt where cells hold more than HOT_CELL left rows: those are dealt out, the right ones copied."""
    hot = a.groupBy(_KEYS).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > HOT_CELL)
    hot = stage(hot.select(*_KEYS, F.ceil(F.col("__n") / HOT_CELL).cast("int").alias("__salts")), "hot_cells")
    if hot.isEmpty():
        return a, b, _KEYS
    salts = F.coalesce("__salts", F.lit(1))
    salted = a.join(hot, _KEYS, "left").withColumn("__salt", F.pmod(F.xxhash64(*[c for c in a.columns if c not in _KEYS]), salts).cast("int")).drop("__salts")
    copied = b.join(hot, _KEYS, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    return salted, copied, [*_KEYS, "__salt"]


def cell_join(left: DataFrame, right: DataFrame, size: float, condition: Column | None = None, key: tuple[Column, Column] | None = None) -> DataFrame:
    """All pairs of a left and a right box that meet, borders included; columns get the prefixes ``l_`` and ``r_``.

    An equi-join on grid cells (see ``cell_sides``); a pair is kept only in the cell that holds the lower left corner of the
    common part, so it comes once without a distinct. ``key`` narrows it: a left row's key (a column) must be among the right
    row's keys (an array without repetitions). Cells with very many rows are dealt over tasks (``HOT_CELL``). The left side is
    dealt to a set number of partitions, since few bytes of boxes can mean many pairs.
    """
    keep = (F.greatest("l___i0", "r___i0") == F.col("__i")) & (F.greatest("l___j0", "r___j0") == F.col("__j")) & geometry.box_intersects(box("l_"), box("r_"))
    keep = keep if condition is None else keep & condition
    out, places = None, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for a, b in cell_sides(left, right, size, key):
        a, b, on = _dealt(a, b)
        part = a.repartition(places, *on).join(b.repartition(places, *on), on).filter(keep).drop(*on, "l___i0", "l___j0", "r___i0", "r___j0")
        out = part if out is None else out.unionAll(part)
    if out is None:  # one side is empty
        named = lambda rows, p: rows.select(*[F.col(c).alias(p + c) for c in rows.columns]).limit(0)
        out = named(left, "l_").join(named(right, "r_"))
    return out


def overlapping_pairs(images: DataFrame, condition: Column | None = None, size: float | None = None) -> DataFrame:
    """Pairs whose boxes overlap (interiors meet, neither holds the other), oriented by strictly smaller emission on the left."""
    size = size or cell_size(images)
    rule = (F.col("l_emission_angle") < F.col("r_emission_angle")) & (F.col("l_product_id") != F.col("r_product_id"))
    rule = rule if condition is None else rule & condition
    return cell_join(images, images, size, rule & geometry.box_overlaps(box("l_"), box("r_")))


def _buckets(azimuth: str, width: float) -> tuple[Column, Column]:
    """(a row's bucket of angles, the buckets around the circle that hold all angles less than ``width`` away)."""
    n = max(1, int(360 // width))
    edge = 360.0 / n  # at least the width, so neighbours hold all partners
    bucket = F.floor(F.pmod(F.col(azimuth), F.lit(360.0)) / edge).cast("int") % n
    return bucket, F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(bucket + d, F.lit(n))))


def intersecting_pairs(images: DataFrame, max_separation: float | None = 2.0, exclude_same_observation: bool = True, azimuth: str = "roi_sub_solar_ground_azimuth", size: float | None = None) -> DataFrame:
    """Pairs (l_id < r_id) whose boxes meet and whose azimuths are less than ``max_separation`` apart around the circle.

    The azimuth is part of the join key: buckets of at least the separation's width, the right rows also in the two next to theirs.
    """
    size = size or cell_size(images)
    rule = F.col("l_product_id") < F.col("r_product_id")
    if exclude_same_observation:
        rule &= ids.observation_id(F.col("l_product_id")) != ids.observation_id(F.col("r_product_id"))
    if max_separation is None:
        return cell_join(images, images, size, rule)
    apart = angles.angular_separation(F.col(f"l_{azimuth}"), F.col(f"r_{azimuth}"))
    return cell_join(images, images, size, rule & (apart < max_separation), _buckets(azimuth, max_separation)).withColumn("separation", apart)


def circular_pairs(rows: DataFrame, key: str, azimuth: str, width: float) -> DataFrame:
    """(l_key, r_key) of rows whose azimuths are less than ``width`` degrees apart, by buckets around the circle."""
    bucket, near = _buckets(azimuth, width)
    one = rows.select(F.col(key).alias("l"), F.col(azimuth).alias("la"), bucket.alias("b"))
    two = rows.select(F.col(key).alias("r"), F.col(azimuth).alias("ra"), F.explode(near).alias("b"))
    return one.join(two, "b").filter((F.col("l") < F.col("r")) & (angles.angular_separation(F.col("la"), F.col("ra")) < width)).select(F.col("l").alias(f"l_{key}"), F.col("r").alias(f"r_{key}"))


def count_circular_pairs(rows: DataFrame, key: str, azimuth: str, width: float) -> DataFrame:
    """(n): how many rows ``circular_pairs`` gives, exactly, without making the pairs, whose number grows with the square of the rows.

    Rows with one azimuth are a number beside it, and azimuths meet by the same buckets and test. That counts every pair in both orders,
    and also rows beside others of their own key, which are taken away. Work grows with the rows and with the pairs of near different azimuths.
    """
    known = rows.select(F.col(key).alias("k"), F.col(azimuth).alias("a")).filter("k IS NOT NULL AND a IS NOT NULL").groupBy("k", "a").agg(F.count(F.lit(1)).alias("n"))
    apart = angles.angular_separation(F.col("la"), F.col("ra")) < width
    bucket, near = _buckets("a", width)
    values = known.groupBy("a").agg(F.sum("n").alias("n"))
    one = values.select(F.col("a").alias("la"), F.col("n").alias("ln"), bucket.alias("b"))
    two = values.select(F.col("a").alias("ra"), F.col("n").alias("rn"), F.explode(near).alias("b"))
    every = one.join(two, "b").filter(apart).select((F.col("ln") * F.col("rn")).alias("m"))
    own = known.select("k", F.col("a").alias("la"), F.col("n").alias("ln")).join(known.select("k", F.col("a").alias("ra"), F.col("n").alias("rn")), "k")
    own = own.filter(apart).select((-F.col("ln") * F.col("rn")).alias("m"))
    return every.union(own).agg(F.expr("coalesce(sum(m), 0) div 2").alias("n"))


def _padded(rings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(N x M x 2 corners, N numbers of corners) of a column of rings; a null ring has none."""
    n = np.asarray(pc.fill_null(pc.list_value_length(rings), 0)).astype(np.int64)
    flat = rings.flatten()
    out = np.full((len(n), max(int(n.max(initial=0)), 1), 2), np.nan)
    there = np.arange(out.shape[1]) < n[:, None]
    for k, c in enumerate("xy"):
        out[..., k][there] = pc.struct_field(flat, c).to_numpy(zero_copy_only=False)
    return out, n


def clip_rings(subject: np.ndarray, n: np.ndarray, clipper: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``geometry.clip`` of many pairs at once, operation by operation; rings as ``_padded`` gives them."""
    ring, n, rows = subject, n.copy(), np.arange(len(n))[:, None]
    for k in range(clipper.shape[1] - 1):
        p, q = clipper[:, k, None], clipper[:, k + 1, None]
        side = (q[..., 0] - p[..., 0]) * (ring[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (ring[..., 0] - p[..., 0])
        a, b, sa, sb = ring[:, :-1], ring[:, 1:], side[:, :-1], side[:, 1:]
        real = np.arange(a.shape[1]) < n[:, None] - 1
        with np.errstate(divide="ignore", invalid="ignore"):
            cross = a + (sa / (sa - sb))[..., None] * (b - a)
        crossed = real & ((sa >= 0) & (sb < 0) | (sa < 0) & (sb >= 0))
        stays = real & (sb >= 0) & ((sa >= 0) | (sa < 0))
        kept = np.stack([crossed, stays], 2).reshape(len(n), -1)
        corners = np.stack([cross, b], 2).reshape(len(n), -1, 2)
        place = np.cumsum(kept, 1)
        size = place[:, -1] if place.shape[1] else np.zeros(len(n), np.int64)
        cut = np.full((len(n), max(int(size.max(initial=0)) + 1, ring.shape[1]), 2), np.nan)
        cut[np.broadcast_to(rows, kept.shape)[kept], place[kept]] = corners[kept]
        some = size > 0
        cut[some, 0] = cut[some, size[some]]
        on = k + 1 < m  # this pair's clipper has the edge
        cut[~on, : ring.shape[1]] = ring[~on]
        n = np.where(on, np.where(some, size + 1, 0), n)
        ring = cut[:, : max(int(n.max(initial=0)), 1)]
    return ring, n


def ring_areas(ring: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``geometry.area`` of rings as ``_padded`` gives them."""
    total = np.zeros(len(n))
    for k in range(ring.shape[1] - 1):
        a, b = ring[:, k], ring[:, k + 1]
        total = np.where(k + 1 < n, total + a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1], total)
    return np.where(n >= 4, np.abs(total / 2), 0.0)


def with_common(pairs: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Pairs with the common part of two convex rings, empty if none, and ``{name}_area``: ``geometry.clip`` and ``area`` on Arrow batches."""
    kind = _parse_datatype_string(geometry.RING)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ring, n = clip_rings(*_padded(batch.column(left)), *_padded(batch.column(right)))
            there = np.arange(ring.shape[1]) < n[:, None]
            corners = pa.StructArray.from_arrays([pa.array(ring[..., k][there]) for k in range(2)], ["x", "y"])
            common = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), corners)
            yield pa.RecordBatch.from_arrays([*batch.columns, common, pa.array(ring_areas(ring, n))], [*batch.schema.names, name, f"{name}_area"])

    return pairs.mapInArrow(run, StructType([*pairs.schema.fields, StructField(name, kind), StructField(f"{name}_area", DoubleType())]))


def polygon_pairs(left: DataFrame, right: DataFrame, ring: str, size: float, predicate: str = "intersects", condition: Column | None = None) -> DataFrame:
    """Pairs of convex rings by ``intersects`` or ``overlaps``, with the ``common`` part of the rings and its ``common_area``: cells by bounds, then exact tests."""

    def bounded(rows: DataFrame) -> DataFrame:
        return rows.withColumns(dict(zip(BOX, geometry.bounds(F.col(ring)), strict=True)))

    test = {"intersects": geometry.convex_intersects, "overlaps": geometry.convex_overlaps}[predicate]
    pairs = cell_join(bounded(left), bounded(right), size, condition)
    pairs = with_common(pairs, f"l_{ring}", f"r_{ring}", "common")
    met = F.size("common") > 0
    return pairs.filter(met & test(F.col(f"l_{ring}"), F.col(f"r_{ring}")) if predicate == "overlaps" else met | test(F.col(f"l_{ring}"), F.col(f"r_{ring}")))


def with_roi(rows: DataFrame, roi: DataFrame) -> DataFrame:
    """Every row with the region's box as roi_x0 ..; the region is one row."""
    one = roi.limit(1).select(*[F.col(c).alias("roi_" + c) for c in BOX])
    return rows.crossJoin(F.broadcast(one))


def meeting_roi(rows: DataFrame, roi: DataFrame) -> DataFrame:
    return with_roi(rows, roi).filter(geometry.box_intersects(box(), box("roi_")))


def assign_quadrants(rows: DataFrame, overlap_m: float = 1000.0) -> DataFrame:
    """(…, quadrant) of the four overlapping quarters of the rows' extent that each box shares inner points with."""
    mx, my = (F.col("ex0") + F.col("ex1")) / 2, (F.col("ey0") + F.col("ey1")) / 2
    extent = rows.agg(F.min("x0").alias("ex0"), F.min("y0").alias("ey0"), F.max("x1").alias("ex1"), F.max("y1").alias("ey1"))
    quarter = lambda n, a, b, c, d: F.struct(F.lit(n).alias("q"), a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"))
    four = extent.select(F.explode(F.array(
        quarter("ll", F.col("ex0"), F.col("ey0"), mx + overlap_m, my + overlap_m), quarter("lr", mx - overlap_m, F.col("ey0"), F.col("ex1"), my + overlap_m),
        quarter("ul", F.col("ex0"), my - overlap_m, mx + overlap_m, F.col("ey1")), quarter("ur", mx - overlap_m, my - overlap_m, F.col("ex1"), F.col("ey1")),
    )).alias("quad"))
    inside = (F.col("x0") < F.col("quad.c")) & (F.col("quad.a") < F.col("x1")) & (F.col("y0") < F.col("quad.d")) & (F.col("quad.b") < F.col("y1"))
    return rows.crossJoin(F.broadcast(four)).filter(inside).withColumn("quadrant", F.col("quad.q")).drop("quad")
