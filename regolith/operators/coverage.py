"""Small subsets of images that cover the most: greedy cover on cells, in few passes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from regolith.operators import filters, raster
from regolith.operators.windows import azimuth_groups, global_rank
from regolith.session import stage

#: Rows that a block of cells has on average where images are taken within blocks, and the most that a block may have for that.
BLOCK, CROWD = 50_000, 400_000


def box_cells(images: DataFrame, size: float, key: str = "product_id", weight: float | None = None) -> DataFrame:
    """(id, i, j, w): the grid cells whose centres lie in each box; w is the cell's area."""
    span = lambda a, b: F.sequence(F.ceil(F.col(a) / size - 0.5).cast("long"), F.ceil(F.col(b) / size - 0.5).cast("long") - 1)
    able = images.filter((F.ceil(F.col("x0") / size - 0.5) < F.ceil(F.col("x1") / size - 0.5)) & (F.ceil(F.col("y0") / size - 0.5) < F.ceil(F.col("y1") / size - 0.5)))
    return able.select(F.col(key).alias("id"), F.explode(span("x0", "x1")).alias("i"), "y0", "y1").select("id", "i", F.explode(span("y0", "y1")).alias("j"), F.lit(weight or size * size).alias("w"))


def set_coverage(cells: DataFrame, least: float = 100.0, max_rounds: int = 10_000, group: str | None = None) -> DataFrame:
    """(group, id, round, gain): greedy cover, as if every round took the image that adds the most uncovered weight (the smallest
    id of equals) and ended where that is below ``least``. Groups are covered each on their own; a null group is left out.

    ``cells`` is (id, i, j, w) and the group column, if any. An image that adds more than every other image with which it shares an
    uncovered cell comes before those in any case, and what it adds doesn't change until then: all such images are taken at once.
    Where many images lie within a square block of cells, a pass takes all that can be taken within blocks, one after another (``_in_block``), and the next pass has
    other blocks. A pass over all follows where that left more than nine tenths of the images. So there are at most about twice as many passes
    as the longest chain of images that wait for one another, and some that each left nine tenths at most; far fewer where images are small.
    Gains never grow, so the order of greedy is that of gains, then ids. More than ``max_rounds`` passes are an error. Cells and
    images stay in tables, and cells of images that add less than ``least`` leave them.
    """
    rows = cells.withColumn("__g", F.col(group) if group else F.lit(0)).select("__g", "id", "i", "j", F.col("w").cast("double").alias("w")).filter("__g IS NOT NULL")
    left, chosen = stage(rows.distinct(), "cells"), None
    image, place, square = ["__g", "id"], ["__g", "i", "j"], ["__g", "__bi", "__bj"]
    size = left.groupBy(*place).count().agg(F.count(F.lit(1)).alias("places"), F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    side = max(1, math.isqrt(BLOCK * size["places"] // (size["rows"] or 1)))
    within, before = False, 0
    for turn in range(max_rounds):
        block = lambda c: F.floor((F.col(c) + turn % 3 * side // 3) / side)  # noqa: B023, E731
        bounds = [f(c).alias(n + c) for n, f in (("__a", F.min), ("__b", F.max)) for c in "ij"]
        inner = (block("__ai") == block("__bi")) & (block("__aj") == block("__bj"))
        gains = stage(left.groupBy(*image).agg(F.sum("w").alias("gain"), *bounds).filter(F.col("gain") >= least).select(*image, "gain", inner.alias("inner")), "gains")
        found = gains.agg(F.count(F.lit(1)).alias("n"), F.count_if("inner").alias("inner")).first()
        if not found["n"]:
            break
        able = left.join(gains, image)
        within = 10 * found["inner"] >= found["n"] and not (within and 10 * found["n"] > 9 * before)
        before = found["n"]
        if within:
            able = able.withColumns({"__bi": block("i"), "__bj": block("j")})
            best, left = _within_blocks(able, left.withColumns({"__bi": block("i"), "__bj": block("j")}) if size["most"] * side * side > CROWD else None, square, least)
        else:
            first = able.groupBy(*place).agg(F.min(F.struct((-F.col("gain")).alias("less"), "id")).alias("first"))
            beaten = able.join(first, place).filter("first.id <> id").select(*image).distinct()
            best = stage(gains.join(beaten, image, "left_anti").select(*image, "gain"), "chosen")
            covered = left.join(best, image, "left_semi").select(*place).distinct()
            left = stage(able.drop("gain", "inner").join(covered, place, "left_anti"), "cells")
        chosen = best if chosen is None else chosen.union(best)
    else:
        raise RuntimeError(f"the cover is not done after {max_rounds} passes")
    chosen = gains.select(*image, "gain") if chosen is None else chosen
    ranked = global_rank(chosen, ["__g", -F.col("gain"), "id"], "__r")
    first = ranked.groupBy("__g").agg(F.min("__r").alias("__first"))
    out = ranked.join(first, "__g").select(F.col("__g").alias(group or "__g"), "id", (F.col("__r") - F.col("__first") + 1).cast("int").alias("round"), F.col("gain").cast("double").alias("gain"))
    return out if group else out.drop("__g")


def _in_block(rows: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows left, a row of each image taken, their gains): greedy within a block, as far as it goes there.

    An image all of whose uncovered cells are in the block (``inner``) is taken if none of those with which it shares one adds more. What other images add is known
    only as it was before, which is no less than it is now. So they hold back whatever might come after them, and are not taken.
    """
    names = rows["id"].combine_chunks().dictionary_encode()
    n = len(names.dictionary)
    rank = np.empty(n, np.int64)
    rank[pc.array_sort_indices(names.dictionary).to_numpy()] = np.arange(n)
    image, weight = rank[names.indices.to_numpy()], rows["w"].fill_null(0.0).to_numpy()
    at, gain, inner, taken = np.empty(n, np.int64), np.empty(n), np.zeros(n, bool), np.full(n, np.nan)
    at[image], gain[image], inner[image] = np.arange(len(image)), rows["gain"].to_numpy(), rows["inner"].to_numpy()
    (_, i), (columns, j) = (np.unique(rows[c].to_numpy(), return_inverse=True) for c in "ij")
    places, place = np.unique(i * len(columns) + j, return_inverse=True)
    left = np.arange(len(image))
    while True:
        p, q = image[left], place[left]
        gain = np.where(inner, np.bincount(p, weight[left], n), gain)
        order = np.empty(n, np.int64)
        order[np.lexsort((np.arange(n), -gain))] = np.arange(n)
        first = np.full(len(places), n)
        np.minimum.at(first, q, order[p])
        best = inner & (gain >= least) & (np.bincount(p, minlength=n) > 0)
        best[p[first[q] < order[p]]] = False
        if not best.any():
            return left, at[~np.isnan(taken)], taken[~np.isnan(taken)]
        taken[best] = gain[best]
        covered = np.zeros(len(places), bool)
        covered[q[best[p]]] = True
        left = left[~covered[q]]


def _within_blocks(able: DataFrame, every: DataFrame | None, square: list[str], least: float) -> tuple[DataFrame, DataFrame]:
    """(images taken with their gains, cells left) of a pass within blocks. ``every`` has all cells where blocks may be crowded: crowded ones are passed over."""
    cells = able.select("__g", "id", "i", "j", "w")
    kinds = to_arrow_schema(cells.withColumn("gain", F.lit(None).cast("double")).schema)

    def run(rows: pa.Table) -> pa.Table:
        left, at, gains = _in_block(rows, least)
        stay, none = rows.select(cells_of).take(pa.array(left)), pa.nulls
        best = {c: rows[c].take(pa.array(at)) if c in ("__g", "id") else none(len(at), kinds.field(c).type) for c in cells_of}
        return pa.concat_tables([stay.append_column("gain", none(len(left), pa.float64())).cast(kinds), pa.table({**best, "gain": gains}).cast(kinds)])

    cells_of = cells.columns
    crowded = None if every is None else stage(every.groupBy(*square).count().filter(F.col("count") > CROWD).select(*square), "crowded")
    over = crowded is not None and not crowded.isEmpty()
    dealt = able.join(crowded, square, "left_anti") if over else able
    done = dealt.groupBy(*square).applyInArrow(run, from_arrow_schema(kinds))
    if over:
        done = done.union(able.join(crowded, square, "left_semi").select(*cells_of, F.lit(None).cast("double").alias("gain")))
    done = stage(done, "cells")
    return done.filter("gain IS NOT NULL").select("__g", "id", "gain"), done.filter("gain IS NULL").drop("gain")


def lit_select(images: DataFrame, components: DataFrame | None = None, component: int = 0, excluded: DataFrame | None = None, bbox: tuple | None = None, azimuth: tuple[float, float] = (0, 361), cover: bool = False, cell: float = 500.0, least: float = 100.0) -> DataFrame:
    """Images of a box, a component, not excluded, within azimuths; and of these a greedy cover if asked for."""
    from regolith.operators import joins

    rows = filters.bbox_filter(images, *bbox) if bbox else images
    rows = joins.keep_component(rows, components, component) if components is not None else rows
    rows = joins.exclude_ids(rows, excluded) if excluded is not None else rows
    rows = filters.between_left_inclusive(rows, "roi_sub_solar_ground_azimuth", *azimuth)
    if not cover:
        return rows
    chosen = set_coverage(box_cells(rows, cell), least)
    return rows.join(chosen.select(F.col("id").alias("product_id"), "round"), "product_id")


def pixel_cells(pixels: DataFrame, limit: float, group: str | None = None) -> DataFrame:
    lit = pixels.filter(F.col("v") >= limit)
    return lit.select(F.col("raster_id").alias("id"), F.col("x").alias("i"), F.col("y").alias("j"), F.lit(1.0).alias("w"), *([group] if group else []))


def image_subset(pixels: DataFrame, limit: float = 0.01, projwin: tuple[int, int, int, int] | None = None, least: float = 1.0, group: str | None = None) -> DataFrame:
    """Greedy cover of the lit pixels, within a window (x0, y0, x1, y1) if given."""
    if projwin:
        pixels = pixels.filter(F.col("x").between(projwin[0], projwin[2]) & F.col("y").between(projwin[1], projwin[3]))
    return set_coverage(pixel_cells(pixels, limit, group), least, group=group)


def image_subset_2x(pixels: DataFrame, limit: float = 0.01, least: float = 1.0, group: str | None = None) -> DataFrame:
    """A cover, and a cover by the images that the first left out; ``pass`` tells them apart."""
    first = image_subset(pixels, limit, None, least, group)
    keys = ["raster_id", *([group] if group else [])]
    rest = pixels.join(first.withColumnRenamed("id", "raster_id").select(*keys), keys, "left_anti")
    second = image_subset(rest, limit, None, least, group)
    return first.withColumn("pass", F.lit(1)).unionByName(second.withColumn("pass", F.lit(2)))


def select_full_site(pixels: DataFrame, azimuths: DataFrame, limit: float = 0.01, factor: int = 8, least: float = 1.0) -> DataFrame:
    """Double covers of the downsampled images, apart for each azimuth group; azimuths is (raster_id, azimuth)."""
    grouped = azimuth_groups(azimuths, "azimuth")
    small = raster.downsample(pixels, factor).join(grouped.select("raster_id", "azimuth_group"), "raster_id")
    return image_subset_2x(small, limit, least, "azimuth_group")


def gsd_guard(images: DataFrame, cells: DataFrame, fine: float = 1.75, coarse: float = 2.0) -> DataFrame:
    """Images without those coarser than ``coarse``, but for those with a cell that nothing up to ``fine`` covers."""
    graded = cells.join(images.select(F.col("product_id").alias("id"), "resolution"), "id")
    covered = graded.filter(F.col("resolution") <= fine).select("i", "j").distinct()
    sole = graded.join(covered, ["i", "j"], "left_anti").select(F.col("id").alias("product_id")).distinct().withColumn("__sole", F.lit(True))
    return images.join(sole, "product_id", "left").filter((F.col("resolution") <= coarse) | F.col("__sole")).drop("__sole")
