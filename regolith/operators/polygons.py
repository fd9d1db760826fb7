"""Polygons of any shape: concave, with holes, of several parts, or with borders that cross. A polygon is an array of rings.

A sweep cuts each polygon at the heights of its corners and crossings; between two of them its borders don't meet, and what lies
between every other pair of them is a trapezoid. Trapezoids of a polygon don't overlap, so areas, common parts and cells of polygons are sums
over trapezoids, found by equi-joins. Polygons of few corners are cut within batches of rows, larger ones by joins of their edges. ``rule`` says what is inside: ``evenodd`` (rings inside others are holes, however they run) or
``nonzero`` (where the borders wind around). Null polygons, and rings of fewer than three corners, have no inside.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType, _parse_datatype_string

from regolith.functions import geometry
from regolith.operators.spatial import cell_join, cell_size
from regolith.session import stage

RINGS = f"array<{geometry.RING}>"
_TRAPEZOID = ["y0", "y1", "la", "lb", "ra", "rb"]
#: Corners up to which polygons are cut within a batch of rows.
SMALL = 64
#: Trapezoids of a polygon, next to each other, that meet others as one row.
BLOCK = 16
#: Pairs of trapezoids that are in memory at once.
PAIRS = 200_000


def _whole(polygons: DataFrame, key: str, rings: str) -> DataFrame:
    """(id, rings, small): a polygon a row, and whether it has at most SMALL corners, all finite. Staged, since both kinds are read from it."""
    one = polygons.select(F.col(key).alias("id"), F.col(rings).cast(RINGS).alias("rings")).filter("id IS NOT NULL AND rings IS NOT NULL")
    one = one.groupBy("id").agg(F.flatten(F.collect_list("rings")).alias("rings"))
    known = F.forall("rings", lambda r: F.forall(r, lambda c: (F.abs(c["x"]) < math.inf) & (F.abs(c["y"]) < math.inf)))
    corners = F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r))
    return stage(one.withColumn("small", F.coalesce((corners <= SMALL) & known, F.lit(False))), "polygons")


def _edges_in(rings: pa.Array) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(rows, [ax, ay, bx, by]) for rows with one number of edges, an array being rows by edges; as ``_edges`` gives them."""
    ring = rings.flatten()
    size = pc.list_value_length(ring).to_numpy(zero_copy_only=False).astype(np.int64)
    a = np.stack([pc.struct_field(ring.flatten(), c).to_numpy(zero_copy_only=False) for c in "xy"])
    owner = np.repeat(np.repeat(np.arange(len(rings)), pc.list_value_length(rings).to_numpy(zero_copy_only=False)), size)
    some, last = size > 0, np.cumsum(size) - 1
    following = np.arange(a.shape[1]) + 1
    following[last[some]] = (last - size + 1)[some]
    b = a[:, following]
    real = np.repeat(size >= 3, size) & (a != b).any(0)
    owner, ends = owner[real], np.concatenate([a[:, real], b[:, real]])
    edges = np.bincount(owner, minlength=len(rings))
    begin = np.cumsum(edges) - edges
    for n in np.unique(edges[edges > 0]).tolist():
        rows = np.flatnonzero(edges == n)
        for part in np.array_split(rows, math.ceil(len(rows) * n**3 / 4e6)):
            at = begin[part][:, None] + np.arange(n)
            yield part, [e[at] for e in ends]


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    return np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], 0)]) if len(columns[0]) else np.zeros(0, bool)


def _sides_in(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, rule: str) -> dict[str, np.ndarray]:
    """What ``_sides`` makes of ``_pieces``, operation by operation, for polygons as ``_edges_in`` gives them; ``p`` is the polygon's place, NaN no next piece."""
    x0, x1, y0, y1 = np.minimum(ax, bx), np.maximum(ax, bx), np.minimum(ay, by), np.maximum(ay, by)
    i, j = np.triu_indices(ax.shape[1], 1)
    rx, ry, sx, sy = (bx - ax)[:, i], (by - ay)[:, i], (bx - ax)[:, j], (by - ay)[:, j]
    qx, qy, d = ax[:, j] - ax[:, i], ay[:, j] - ay[:, i], rx * sy - ry * sx
    with np.errstate(all="ignore"):
        t, u = (qx * sy - qy * sx) / d, (qx * ry - qy * rx) / d
        near = (x0[:, i] <= x1[:, j]) & (x0[:, j] <= x1[:, i]) & (y0[:, i] <= y1[:, j]) & (y0[:, j] <= y1[:, i])
        crossed = near & (d != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        every = np.sort(np.concatenate([ay, by, np.where(crossed, ay[:, i] + t * ry, np.nan)], 1), 1)
    new = np.concatenate([np.ones((len(every), 1), bool), every[:, 1:] > every[:, :-1]], 1)
    ys = np.full((len(every), int(new.sum(1).max(initial=1))), np.nan)
    ys[np.nonzero(new)[0], (np.cumsum(new, 1) - 1)[new]] = every[new]
    up, low, high = ay < by, ys[:, :-1], ys[:, 1:]
    xl, xh = np.where(up, ax, bx), np.where(up, bx, ax)
    p, e, k = np.nonzero((y0[..., None] <= low[:, None]) & (high[:, None] <= y1[..., None]))
    below, above, begin, end, left, right = low[p, k], high[p, k], y0[p, e], y1[p, e], xl[p, e], xh[p, e]
    at = lambda y: np.where(y == begin, left, np.where(y == end, right, left + (y - begin) / (end - begin) * (right - left)))
    xa, xb = at(below), at(above)
    order = np.lexsort((xb, xa, k, p))
    p, k, xa, xb, below, above, turn = (c[order] for c in (p, k, xa, xb, below, above, np.where(up, 1, -1)[p, e]))
    first = np.flatnonzero(_runs(p, k, xa, xb))
    own = np.diff(first, append=len(p)) if rule == "evenodd" else np.add.reduceat(turn, first) if len(p) else turn
    p, k, xa, xb, below, above = (c[first] for c in (p, k, xa, xb, below, above))
    order = np.lexsort((xa, xa + xb, k, p))
    p, k, xa, xb, below, above, own = (c[order] for c in (p, k, xa, xb, below, above, own))
    begins = _runs(p, k)
    total = np.cumsum(own)
    count = total - (total - own)[begins][np.cumsum(begins) - 1]
    inside = (lambda c: c % 2 != 0) if rule == "evenodd" else (lambda c: c != 0)
    last = np.append(begins[1:], True)[: len(p)]
    following = lambda c: np.where(last, np.nan, np.append(c[1:], np.nan)[: len(c)])
    return {"p": p, "y0": below, "y1": above, "xa": xa, "xb": xb, "ra": following(xa), "rb": following(xb), "before": inside(count - own), "after": inside(count)}


def _edges(polygons: DataFrame, key: str, rings: str) -> DataFrame:
    """(id, e, ax, ay, bx, by) and the edge's box; rings are closed, edges without length are left out."""
    ring = polygons.select(F.col(key).alias("id"), F.posexplode(rings).alias("r", "ring")).filter(F.size("ring") >= 3)
    ring = ring.withColumn("ring", F.when(F.element_at("ring", 1) == F.element_at("ring", -1), F.col("ring")).otherwise(F.concat("ring", F.slice("ring", 1, 1))))
    ends = F.zip_with(F.slice("ring", F.lit(1), F.size("ring") - 1), F.slice("ring", F.lit(2), F.size("ring") - 1), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    each = ring.select("id", "r", F.posexplode(ends).alias("k", "s")).select("id", (F.col("r").cast("long") * (1 << 32) + F.col("k")).alias("e"), "s.*").filter("ax <> bx OR ay <> by")
    return each.withColumns({"x0": F.least("ax", "bx"), "y0": F.least("ay", "by"), "x1": F.greatest("ax", "bx"), "y1": F.greatest("ay", "by")})


def _crossing_heights(edges: DataFrame) -> DataFrame:
    """(id, y) of the points where two edges of a polygon cross."""
    pairs = cell_join(edges, edges, cell_size(edges), F.col("l_e") < F.col("r_e"), (F.col("id"), F.array("id")))
    rx, ry, sx, sy = (F.col(b) - F.col(a) for a, b in (("l_ax", "l_bx"), ("l_ay", "l_by"), ("r_ax", "r_bx"), ("r_ay", "r_by")))
    qx, qy, d = F.col("r_ax") - F.col("l_ax"), F.col("r_ay") - F.col("l_ay"), rx * sy - ry * sx
    t, u = F.when(d != 0, (qx * sy - qy * sx) / d), F.when(d != 0, (qx * ry - qy * rx) / d)
    return pairs.filter((t > 0) & (t < 1) & (u > 0) & (u < 1)).select(F.col("l_id").alias("id"), (F.col("l_ay") + t * ry).alias("y"))


def _pieces(polygons: DataFrame, key: str, rings: str) -> DataFrame:
    """(id, k, y0, y1, xa, xb, turn, n): borders in slab k, from (xa, y0) to (xb, y1); coinciding ones are one piece, with the sum of their
    directions and their number."""
    edges = stage(_edges(polygons, key, rings), "edges")
    heights = edges.select("id", F.explode(F.array("ay", "by")).alias("y")).union(_crossing_heights(edges))
    cuts = heights.groupBy("id").agg(F.sort_array(F.collect_set("y")).alias("ys"))
    up = F.col("ay") < F.col("by")
    ends = {"xl": F.when(up, F.col("ax")).otherwise(F.col("bx")), "xh": F.when(up, F.col("bx")).otherwise(F.col("ax")), "turn": F.when(up, 1).otherwise(-1)}
    first = F.array_position("ys", F.col("y0")).cast("int")
    spans = F.transform(F.sequence(first, F.array_position("ys", F.col("y1")).cast("int") - 1), lambda k: F.struct(k.alias("k"), F.element_at("ys", k).alias("a"), F.element_at("ys", k + 1).alias("b")))
    each = edges.filter("ay <> by").withColumns(ends).join(cuts, "id").withColumn("s", F.explode(spans))
    at = lambda y: F.when(y == F.col("y0"), F.col("xl")).when(y == F.col("y1"), F.col("xh")).otherwise(F.col("xl") + (y - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("xh") - F.col("xl")))
    each = each.select("id", "s.k", F.col("s.a").alias("y0"), F.col("s.b").alias("y1"), at(F.col("s.a")).alias("xa"), at(F.col("s.b")).alias("xb"), "turn")
    return each.groupBy("id", "k", "y0", "y1", "xa", "xb").agg(F.sum("turn").alias("turn"), F.count(F.lit(1)).alias("n"))


def _sides(pieces: DataFrame, rule: str) -> DataFrame:
    """Pieces with whether it is inside before and after each, from left to right, and the next piece's ends."""
    w = Window.partitionBy("id", "k").orderBy(F.col("xa") + F.col("xb"), "xa")
    count = F.sum("n" if rule == "evenodd" else "turn").over(w)
    inside = lambda c: c % 2 != 0 if rule == "evenodd" else c != 0
    own = F.col("n") if rule == "evenodd" else F.col("turn")
    return pieces.withColumns({"__c": count, "ra": F.lead("xa").over(w), "rb": F.lead("xb").over(w)}).withColumns({"before": inside(F.col("__c") - own), "after": inside(F.col("__c"))}).drop("__c")


def _known(rule: str) -> None:
    if rule not in ("evenodd", "nonzero"):
        raise ValueError(f"no rule {rule}")


def trapezoids(polygons: DataFrame, key: str, rings: str = "rings", rule: str = "evenodd") -> DataFrame:
    """(key, y0, y1, la, lb, ra, rb, x0, x1): between heights y0 and y1, from la to ra below and from lb to rb above; x0 and x1 are its bounds.

    The table is staged, since areas, pairs and cells read it more than once.
    """
    _known(rule)
    whole = _whole(polygons, key, rings)
    fields = StructType([StructField(key, whole.schema["id"].dataType), *[StructField(c, DoubleType()) for c in [*_TRAPEZOID, "x0", "x1"]]])
    kinds = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, edges in _edges_in(batch.column("rings")):
                s = _sides_in(*edges, rule)
                on = s["after"] & ((s["ra"] > s["xa"]) | (s["rb"] > s["xb"]))
                s = {c: v[on] for c, v in s.items()}
                columns = [s["y0"], s["y1"], s["xa"], s["xb"], s["ra"], s["rb"], np.minimum(s["xa"], s["xb"]), np.maximum(s["ra"], s["rb"])]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows[s["p"]])), *map(pa.array, columns)], schema=kinds)

    found = whole.filter("small").select("id", "rings").mapInArrow(run, fields)
    large = whole.filter("NOT small")
    if not large.isEmpty():
        cut = _sides(_pieces(large, "id", "rings"), rule).filter("after AND (ra > xa OR rb > xb)")
        found = found.union(cut.select(F.col("id").alias(key), "y0", "y1", F.col("xa").alias("la"), F.col("xb").alias("lb"), "ra", "rb", F.least("xa", "xb").alias("x0"), F.greatest("ra", "rb").alias("x1")))
    return stage(found, "trapezoids")


def areas(traps: DataFrame, key: str) -> DataFrame:
    """(key, area)."""
    return traps.groupBy(key).agg(F.sum((F.col("y1") - F.col("y0")) * (F.col("ra") - F.col("la") + F.col("rb") - F.col("lb")) / 2).alias("area"))


def common_areas(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The areas that pairs of trapezoids share (columns of y0, y1, la, lb, ra, rb): a pair's common width is linear between the heights where its sides cross."""
    y0, y1 = np.maximum(p[0], q[0]), np.minimum(p[1], q[1])
    sides = {s: (t[i], (t[i + 1] - t[i]) / (t[1] - t[0]), t[0]) for s, t, i in (("pl", p, 2), ("pr", p, 4), ("ql", q, 2), ("qr", q, 4))}
    x = lambda s, y: sides[s][0] + (y - sides[s][2]) * sides[s][1]

    def meet(s: str, t: str) -> np.ndarray:
        apart = sides[s][1] - sides[t][1]
        with np.errstate(all="ignore"):
            y = np.where(apart != 0, y0 + (x(t, y0) - x(s, y0)) / apart, y0)
        return np.minimum(np.maximum(y, y0), y1)

    heights = [meet(s, t) for s, t in (("pl", "ql"), ("pr", "qr"), ("pl", "qr"), ("ql", "pr")) if (sides[s][1] != sides[t][1]).any()]
    heights = np.sort(np.stack([y0, *heights, y1]), 0)
    width = np.maximum(np.minimum(x("pr", heights), x("qr", heights)) - np.maximum(x("pl", heights), x("ql", heights)), 0.0)
    return np.where(y1 > y0, ((heights[1:] - heights[:-1]) * (width[:-1] + width[1:]) / 2).sum(0), 0.0)


def _blocks(traps: DataFrame, key: str) -> DataFrame:
    """(key, traps, area, n, x0, y0, x1, y1): at most BLOCK trapezoids of a polygon, from the lowest up, in one array of numbers, with
    their bounds, and the area and number of all the polygon's. Staged, since a join reads it several times."""
    every = Window.partitionBy(key)
    area = (F.col("y1") - F.col("y0")) * (F.col("ra") - F.col("la") + F.col("rb") - F.col("lb")) / 2
    rows = traps.withColumns({"__b": F.floor((F.row_number().over(every.orderBy("y0", "la")) - 1) / BLOCK), "__area": F.sum(area).over(every), "__n": F.count(F.lit(1)).over(every)})
    bounds = [f(c).alias(c) for c, f in (("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max))]
    numbers = F.flatten(F.collect_list(F.array(*_TRAPEZOID))).alias("traps")
    return stage(rows.groupBy(key, "__b").agg(numbers, F.first("__area").alias("area"), F.first("__n").alias("n"), *bounds).drop("__b"), "blocks")


def _with_common(pairs: DataFrame) -> DataFrame:
    """Pairs of blocks, without their trapezoids, with the common area of all of them; pairs without one are left out."""
    fields = StructType([*[f for f in pairs.schema.fields if f.name not in ("l_traps", "r_traps")], StructField("area", DoubleType())])

    def side(numbers: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = pc.list_value_length(numbers).to_numpy(zero_copy_only=False).astype(np.int64) // 6
        return numbers.flatten().to_numpy(zero_copy_only=False).reshape(-1, 6).T, n, np.cumsum(n) - n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (p, n, begin_p), (q, m, begin_q) = side(batch.column("l_traps")), side(batch.column("r_traps"))
            total = np.zeros(len(n))
            ends = np.cumsum(n * m)
            for first in np.flatnonzero(np.diff(ends // PAIRS, prepend=-1)).tolist():
                rows = np.arange(first, np.searchsorted(ends, (ends[first] // PAIRS + 1) * PAIRS))
                row = np.repeat(rows, (n * m)[rows])
                k = np.arange(len(row)) - (ends - n * m)[row] + (ends - n * m)[first]
                i, j = begin_p[row] + k // m[row], begin_q[row] + k % m[row]
                on = np.minimum(p[1, i], q[1, j]) > np.maximum(p[0, i], q[0, j])
                total += np.bincount(row[on], common_areas(p[:, i[on]], q[:, j[on]]), len(n))
            kept = batch.select([f.name for f in fields[:-1]])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(total)], [*kept.schema.names, "area"]).filter(pa.array(total > 0))

    return pairs.mapInArrow(run, fields)


def _meeting(left: DataFrame, right: DataFrame, key: str, condition: Column | None, size: float | None) -> DataFrame:
    """(l_key, r_key, l_area, r_area, area) of the pairs of polygons, given as trapezoids, whose insides meet."""
    a = _blocks(left, key)
    b = a if right is left else _blocks(right, key)
    pairs = cell_join(a, b, size or cell_size(a), condition)
    found = _with_common(pairs.select(*[s + c for s in ("l_", "r_") for c in (key, "area", "traps")]))
    if all(blocks.filter(F.col("n") > BLOCK).isEmpty() for blocks in {id(a): a, id(b): b}.values()):
        return found  # every polygon is one block, so a pair is one row
    return found.groupBy(f"l_{key}", f"r_{key}").agg(F.first("l_area").alias("l_area"), F.first("r_area").alias("r_area"), F.sum("area").alias("area"))


def pair_areas(left: DataFrame, right: DataFrame, key: str, condition: Column | None = None, size: float | None = None) -> DataFrame:
    """(l_key, r_key, area) of the pairs of polygons, given as trapezoids, whose insides meet.

    ``condition`` is on l_key and r_key. Blocks of trapezoids meet by an equi-join on grid cells that deals out full cells.
    """
    return _meeting(left, right, key, condition, size).drop("l_area", "r_area")


def overlaps(left: DataFrame, right: DataFrame, key: str, condition: Column | None = None) -> DataFrame:
    """(l_key, r_key, area, l_percent, r_percent, contains): pairs with the common area as a share of either; ``contains`` if it is all of one."""
    whole = F.least("l_area", "r_area")
    return _meeting(left, right, key, condition, None).select(f"l_{key}", f"r_{key}", "area", geometry.pair_coverage(F.col("area"), F.col("l_area")).alias("l_percent"), geometry.pair_coverage(F.col("area"), F.col("r_area")).alias("r_percent"), (F.col("area") >= whole * (1 - 1e-12)).alias("contains"))


def cells(traps: DataFrame, key: str, size: float) -> DataFrame:
    """(id, i, j, w): the grid cells whose centres lie inside, with the cell's area; a cell comes once, since trapezoids are half open."""
    span = lambda a, b: F.sequence(F.ceil(a / size - 0.5).cast("long"), F.ceil(b / size - 0.5).cast("long") - 1)
    some = lambda a, b: F.ceil(a / size - 0.5) < F.ceil(b / size - 0.5)
    rows = traps.filter(some(F.col("y0"), F.col("y1"))).withColumn("j", F.explode(span(F.col("y0"), F.col("y1"))))
    t = ((F.col("j") + 0.5) * size - F.col("y0")) / (F.col("y1") - F.col("y0"))
    rows = rows.select(F.col(key).alias("id"), "j", (F.col("la") + t * (F.col("lb") - F.col("la"))).alias("a"), (F.col("ra") + t * (F.col("rb") - F.col("ra"))).alias("b"))
    return rows.filter(some(F.col("a"), F.col("b"))).select("id", F.explode(span(F.col("a"), F.col("b"))).alias("i"), "j", F.lit(float(size * size)).alias("w"))


def _borders(pieces: DataFrame, rule: str) -> DataFrame:
    """(id, ax, ay, bx, by): the pieces with inside on one side only, with the inside on their left."""
    sides = _sides(pieces, rule)
    down, level = F.col("after"), Window.partitionBy("id", "y").orderBy("x")
    slanted = sides.filter("before <> after").select(
        "id", F.when(down, F.col("xb")).otherwise(F.col("xa")).alias("ax"), F.when(down, F.col("y1")).otherwise(F.col("y0")).alias("ay"),
        F.when(down, F.col("xa")).otherwise(F.col("xb")).alias("bx"), F.when(down, F.col("y0")).otherwise(F.col("y1")).alias("by"),
    )
    # along the heights: where there is inside either above or below
    end = lambda y, x, above, below: F.struct(F.col(y).alias("y"), F.col(x).alias("x"), F.lit(above).alias("above"), F.lit(below).alias("below"))
    ends = sides.filter("after").select("id", F.inline(F.array(end("y0", "xa", 1, 0), end("y0", "ra", -1, 0), end("y1", "xb", 0, 1), end("y1", "rb", 0, -1))))
    marks = ends.groupBy("id", "y", "x").agg(F.sum("above").alias("above"), F.sum("below").alias("below"))
    runs = marks.select("id", "y", "x", (F.sum("above").over(level) > 0).alias("above"), (F.sum("below").over(level) > 0).alias("below"), F.lead("x").over(level).alias("to"))
    flat = runs.filter("above <> below AND to > x").select("id", F.when(F.col("above"), F.col("x")).otherwise(F.col("to")).alias("ax"), F.col("y").alias("ay"), F.when(F.col("above"), F.col("to")).otherwise(F.col("x")).alias("bx"), F.col("y").alias("by"))
    return slanted.union(flat)


def _borders_in(s: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, a, b): what ``_borders`` makes of sides as ``_sides_in`` gives them, segments from a to b in the order of polygons."""
    on = s["before"] != s["after"]
    p, y0, y1, xa, xb, down = (s[c][on] for c in ("p", "y0", "y1", "xa", "xb", "after"))
    low, high = np.stack([xa, y0], 1), np.stack([xb, y1], 1)
    slanted = p, np.where(down[:, None], high, low), np.where(down[:, None], low, high)
    q, y0, y1, xa, xb, ra, rb = (s[c][s["after"]] for c in ("p", "y0", "y1", "xa", "xb", "ra", "rb"))
    one, none = np.ones(len(q), int), np.zeros(len(q), int)
    q, y, x = np.tile(q, 4), np.concatenate([y0, y0, y1, y1]), np.concatenate([xa, ra, xb, rb])
    marks = np.stack([np.concatenate([one, -one, none, none]), np.concatenate([none, none, one, -one])])
    order = np.lexsort((x, y, q))
    q, y, x, marks = q[order], y[order], x[order], marks[:, order]
    # at every height the marks add up to nothing, so sums over all are sums from its first one
    last = np.append(_runs(q, y, x)[1:], True)[: len(q)]
    above, below = np.cumsum(marks, 1)[:, last] > 0
    q, y, x = q[last], y[last], x[last]
    to = np.where(np.append(_runs(q, y)[1:], True)[: len(q)], np.nan, np.append(x[1:], np.nan)[: len(x)])
    flat = (above != below) & (to > x)
    q, y, x, to, above = (c[flat] for c in (q, y, x, to, above))
    here, there = np.stack([x, y], 1), np.stack([to, y], 1)
    p, a, b = (np.concatenate(c) for c in zip(slanted, (q, np.where(above[:, None], here, there), np.where(above[:, None], there, here)), strict=True))
    order = np.argsort(p, kind="stable")
    return p[order], a[order], b[order]


def _linked(a: np.ndarray, b: np.ndarray, near: float) -> list[np.ndarray]:
    """Rings of directed segments from ``a`` to ``b``: each goes on with the sharpest turn to the left, so that rings part where they touch.

    Ends less than ``near`` apart are one. Corners on a straight line are left out, and so are rings without area.
    """
    ends = np.concatenate([a, b])
    known: dict[tuple[int, int], int] = {}
    node = []
    for x, y in np.round(ends / near).astype(np.int64).tolist():
        at = next((known[x + i, y + j] for i in (0, -1, 1) for j in (0, -1, 1) if (x + i, y + j) in known), len(known))
        known.setdefault((x, y), at)
        node.append(at)
    start, stop = node[: len(a)], node[len(a) :]
    out: dict[int, list[int]] = {}
    for s in range(len(a)):
        if start[s] != stop[s]:
            out.setdefault(start[s], []).append(s)
    angle = np.arctan2(b[:, 1] - a[:, 1], b[:, 0] - a[:, 0])
    rings, used = [], set()
    for first in sorted(range(len(a)), key=lambda s: (a[s, 1], a[s, 0], angle[s])):
        if first in used or start[first] == stop[first]:
            continue
        path, now = [], first
        while now not in used:
            used.add(now)
            path.append(a[now])
            free = [s for s in out.get(stop[now], []) if s not in used]
            if not free:
                break
            back = angle[now] + math.pi
            now = min(free, key=lambda s: (back - angle[s] - 1e-9) % (2 * math.pi))
            if start[now] == start[first]:
                break
        p = np.array(path)
        before, after = np.roll(p, 1, axis=0), np.roll(p, -1, axis=0)
        cross = (p[:, 0] - before[:, 0]) * (after[:, 1] - p[:, 1]) - (p[:, 1] - before[:, 1]) * (after[:, 0] - p[:, 0])
        reach = np.hypot(*(p - before).T) * np.hypot(*(after - p).T)
        p = p[np.abs(cross) > 1e-9 * reach]
        if len(p) >= 3:
            rings.append(np.vstack([p, p[:1]]))
    return rings


def make_valid(polygons: DataFrame, key: str, rings: str = "rings", rule: str = "nonzero", near: float = 1e-6) -> DataFrame:
    """(key, rings): the same insides by rings that don't cross: outer ones anticlockwise, holes clockwise; no rings without an inside.

    Borders are cut where they cross, those with inside on both sides or neither go, and the rest are linked, a polygon at a time. Ends closer than ``near`` are one. Rings begin at their lowest corner.
    """
    _known(rule)
    whole = _whole(polygons, key, rings)
    fields = StructType([whole.schema["id"], StructField("rings", _parse_datatype_string(RINGS))])
    kinds = to_arrow_schema(fields)
    as_rows = lambda found: [[{"x": x, "y": y} for x, y in ring.tolist()] for ring in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, edges in _edges_in(batch.column("rings")):
                p, a, b = _borders_in(_sides_in(*edges, rule))
                some, begin = np.unique(p, return_index=True)
                found = [_linked(x, y, near) for x, y in zip(np.split(a, begin[1:]), np.split(b, begin[1:]), strict=True)] if len(p) else []
                each = [ring for one in found for ring in one]
                corners = np.concatenate(each) if each else np.zeros((0, 2))
                corners = pa.StructArray.from_arrays([pa.array(corners[:, 0]), pa.array(corners[:, 1])], fields=list(kinds.field("rings").type.value_type.value_type))
                place = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                made = pa.ListArray.from_arrays(place([len(one) for one in found]), pa.ListArray.from_arrays(place([len(ring) for ring in each]), corners))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows[some])), made.cast(kinds.field("rings").type)], schema=kinds)

    def of_group(p: pd.DataFrame) -> pd.DataFrame:
        found = _linked(p[["ax", "ay"]].to_numpy(float), p[["bx", "by"]].to_numpy(float), near)
        return pd.DataFrame({"id": [p["id"].iloc[0]], "rings": [as_rows(found)]})

    linked = whole.filter("small").select("id", "rings").mapInArrow(run, fields)
    large = whole.filter("NOT small")
    if not large.isEmpty():
        linked = linked.union(_borders(_pieces(large, "id", "rings"), rule).groupBy("id").applyInPandas(of_group, fields))
    return polygons.select(key).join(linked.withColumnRenamed("id", key), key, "left").select(key, F.coalesce("rings", F.array().cast(RINGS)).alias("rings"))
