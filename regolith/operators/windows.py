"""Numbering, streaks, bins and chunks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regolith.session import stage


def global_rank(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``rows`` with their number (from 1) in the order of the keys, without one task that sorts everything.

    Rows are range-partitioned and sorted; a number is the row's place in its partition plus the sizes of the partitions
    before it. The sorted rows are staged, so that numbers and sizes come from the same partitions. Ties should be broken
    by a unique last key.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    named = rows.withColumns({f"__k{i}": k for i, k in enumerate(keys)})
    cols = [f"__k{i}" for i in range(len(keys))]
    sorted_rows = named.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__m", F.monotonically_increasing_id())
    staged = stage(sorted_rows.withColumn("__p", F.shiftright("__m", 33)).withColumn("__i", F.col("__m").bitwiseAND((1 << 33) - 1)), "ranked")
    sizes = staged.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))  # a row for each partition
    numbered = staged.join(F.broadcast(before), "__p")
    return numbered.withColumn(name, F.col("__before") + F.col("__i") + 1).select(*rows.columns, name)


def global_lag(ranked: DataFrame, rank: str, columns: list[str], prefix: str = "prev_") -> DataFrame:
    """The columns of the row before by rank, by an equi-join on rank, so that no task sees all rows."""
    shifted = ranked.select((F.col(rank) + 1).alias(rank), *[F.col(c).alias(prefix + c) for c in columns])
    return ranked.join(shifted, rank, "left")


def order_images(images: DataFrame, extent: tuple[float, float, float, float], name: str = "orderid") -> DataFrame:
    """Numbered by azimuth, incidence, place on the curve, and covered fraction."""
    from regolith.functions.geometry import hilbert

    curve = hilbert((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, *extent)
    return global_rank(images, ["roi_sub_solar_ground_azimuth", "incidence_angle", curve, "fraction_area", "product_id"], name)


def intersects_prior(ordered: DataFrame, rank: str = "orderid") -> DataFrame:
    """Whether each box meets the one before it; false for the first."""
    boxes = ["x0", "y0", "x1", "y1"]
    with_prior = global_lag(ordered, rank, boxes)
    meets = (F.col("x0") <= F.col("prev_x1")) & (F.col("prev_x0") <= F.col("x1")) & (F.col("y0") <= F.col("prev_y1")) & (F.col("prev_y0") <= F.col("y1"))
    return with_prior.withColumn("intersects_prior", F.coalesce(meets, F.lit(False))).drop(*["prev_" + c for c in boxes])


def intersects_next(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Whether each box meets the next of its group; the last one's next is the first."""
    w = Window.partitionBy(group).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    box = F.struct("x0", "y0", "x1", "y1")
    out = rows.withColumn("__n", F.coalesce(F.lead(box).over(w), F.first(box).over(whole)))
    meets = (F.col("x0") <= F.col("__n.x1")) & (F.col("__n.x0") <= F.col("x1")) & (F.col("y0") <= F.col("__n.y1")) & (F.col("__n.y0") <= F.col("y1"))
    return out.withColumn("intersects_next", meets).drop("__n")


def streak_numbers(rows: DataFrame, order: str, flag: str) -> DataFrame:
    """Place of each row among those of its flag, and ``streak``, equal along a run of equal flags.

    A run begins where the flag differs from the row before; runs are counted by the global rank of their beginnings.
    """
    lagged = global_lag(rows, order, [flag])
    begins = lagged.filter(F.coalesce(F.col(flag) != F.col("prev_" + flag), F.lit(True))).select(order)
    return rows.join(_starts(begins, rows.select(order), order), order)


#: Rows of a block of a scan, and blocks of a block of blocks.
BLOCK = 4096


def _starts(begins: DataFrame, orders: DataFrame, order: str) -> DataFrame:
    """(order, streak): the last beginning at or before each order, by a scan in three levels.

    Orders are scanned in blocks, the blocks' last beginnings in blocks of blocks, and these in one window of a row for each 16 million
    orders; each level hands the last beginning before a block down to it.
    """
    marked = orders.join(begins.withColumn("__b", F.col(order)), order, "left").withColumn("__block", F.floor(F.col(order) / BLOCK))
    blocks = marked.groupBy("__block").agg(F.max("__b").alias("__last")).withColumn("__group", F.floor(F.col("__block") / BLOCK))
    groups = blocks.groupBy("__group").agg(F.max("__last").alias("__last"))
    before = lambda w: F.max("__last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    handed = groups.select("__group", before(Window.orderBy("__group")).alias("__far"))
    carried = blocks.withColumn("__near", before(Window.partitionBy("__group").orderBy("__block"))).join(handed, "__group").select("__block", F.coalesce("__near", "__far").alias("__carry"))
    inside = marked.withColumn("__in", F.max("__b").over(Window.partitionBy("__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    return inside.join(carried, "__block").select(order, F.coalesce("__in", "__carry").alias("streak"))


def streak_lengths(rows: DataFrame, order: str = "orderid", flag: str = "intersects_prior") -> DataFrame:
    """(flag, length, streaks): how many runs of each length there are."""
    runs = streak_numbers(rows, order, flag)
    lengths = runs.groupBy("streak", flag).agg(F.count(F.lit(1)).alias("length"))
    return lengths.groupBy(flag, "length").agg(F.count(F.lit(1)).alias("streaks"))


def legacy_streak_lengths(rows: DataFrame, order: str = "orderid", flag: str = "intersects_prior") -> DataFrame:
    """The same where numbers have gaps that split runs: a run is consecutive numbers of one flag."""
    place = global_rank(rows, [flag, order], "__place")
    lengths = place.groupBy(flag, (F.col(order) - F.col("__place")).alias("__run")).agg(F.count(F.lit(1)).alias("length"))
    return lengths.groupBy(flag, "length").agg(F.count(F.lit(1)).alias("streaks"))


#: Bins that one pass cuts a range of values into.
BINS = 4096


def order_statistics(values: DataFrame, targets: DataFrame) -> DataFrame:
    """(g, rank, v): for each (g, rank) of ``targets``, the value of ``values`` (g, v) that ``rank`` others of its group come before.

    Values are counted, never sorted: a pass counts those of each range in BINS bins, and a target goes on in the bin that
    holds it, between the least and the greatest value there, until these are one. The ends of a range have bins of their own, so every pass
    narrows it, and equal values are one count, however many they are. Neither NaN nor null values may be among them.
    """
    bounds = values.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    state = targets.join(bounds, "g").select("g", "rank", F.lit(0).cast("long").alias("below"), "lo", "hi")
    width = F.col("hi") / 2 - F.col("lo") / 2
    place = F.floor((F.col("v") / 2 - F.col("lo") / 2) / width * BINS)
    bin_of = F.when(F.col("v") == F.col("lo"), -1).when(F.col("v") == F.col("hi"), BINS).otherwise(F.coalesce(F.least(place, F.lit(BINS - 1)), F.lit(0))).cast("int")
    span = ["g", "lo", "hi"]
    done = None
    while True:
        state = stage(state, "targets")
        found, wide = state.filter("lo = hi"), state.filter("lo < hi")
        done = found if done is None else done.union(found)
        if wide.isEmpty():
            return done.select("g", "rank", F.col("lo").alias("v"))
        inside = values.join(wide.select(*span).distinct(), "g").filter("v BETWEEN lo AND hi")
        counts = inside.groupBy(*span, bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        before = counts.withColumn("before", F.sum("n").over(Window.partitionBy(*span).orderBy("bin")) - F.col("n"))  # at most BINS + 2 rows for each range
        held = wide.join(before, span).filter("below + before <= rank AND rank < below + before + n")
        state = held.select("g", "rank", (F.col("below") + F.col("before")).alias("below"), F.col("least").alias("lo"), F.col("most").alias("hi"))


def _values(rows: DataFrame, group: Column, column: str) -> DataFrame:
    return stage(rows.select(group.alias("g"), F.col(column).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)"), "values")


def exact_quantiles(rows: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """The quantiles of the column's values (linear between neighbours), by ``order_statistics``: only the neighbours reach the driver.

    Between equal neighbours it is their value to the last bit, so that as an edge of bins it keeps them in one.

    Nulls and NaN are passed over; without values the quantiles are None.
    """
    values = _values(rows, F.lit(0), column)
    n = values.count()
    if not n:
        return [None] * len(shares)
    low, high = math.floor, math.ceil
    places = [s * (n - 1) for s in shares]
    targets = rows.sparkSession.createDataFrame([(0, e) for e in sorted({int(f(p)) for p in places for f in (low, high)})], "g int, rank bigint")
    at = {r["rank"]: r["v"] for r in order_statistics(values, targets).collect()}
    return [at[low(p)] + (p - low(p)) * (at[high(p)] - at[low(p)]) if at[low(p)] < at[high(p)] else at[low(p)] for p in places]


def group_quantile(rows: DataFrame, group: str, column: str, share: float, name: str) -> DataFrame:
    """(group, name): each group's exact quantile (linear between neighbours), by ``order_statistics``; groups without values have none."""
    values = _values(rows, F.col(group), column)
    places = values.groupBy("g").agg(((F.count(F.lit(1)) - 1) * F.lit(float(share))).alias("p"))
    targets = places.select("g", "p", F.explode(F.array_distinct(F.array(F.floor("p"), F.ceil("p")))).alias("rank"))
    found = order_statistics(values, targets.select("g", "rank")).join(places, "g").groupBy("g", "p").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    between = F.col("a") + (F.col("p") - F.floor("p")) * (F.col("b") - F.col("a"))
    return found.select(F.col("g").alias(group), F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(between).alias(name))


def quantile_bins(rows: DataFrame, column: str, bins: int, name: str = "bin") -> DataFrame:
    """Equal-frequency bins by quantile edges (linear between values); equal values share a bin; numbered from 0.

    The edges are one small row; bin k holds values above edge k and up to edge k + 1, the first bin its lower edge too.
    """
    edges = [e for e in dict.fromkeys(exact_quantiles(rows, column, [i / bins for i in range(bins + 1)])) if e is not None]
    above = F.size(F.filter(F.array(*map(F.lit, edges)) if edges else F.array().cast("array<double>"), lambda e: e < F.col(column)))
    return rows.withColumn(name, F.greatest(above - 1, F.lit(0)).cast("int"))


def chunk_rows(rows: DataFrame, order: list[str], size: int, name: str = "chunk") -> DataFrame:
    """Consecutive chunks of ``size`` rows by order, numbered from 0."""
    return global_rank(rows, order, "__r").withColumn(name, F.floor((F.col("__r") - 1) / size).cast("long")).drop("__r")


def batch_ranges(rows: DataFrame, pos: str, width: int, name: str = "batch") -> DataFrame:
    """Slices [i * width, (i + 1) * width) of a position."""
    return rows.withColumn(name, F.floor(F.col(pos) / width).cast("long"))


def azimuth_groups(rows: DataFrame, azimuth: str, name: str = "azimuth_group") -> DataFrame:
    """Below 180, [180, 270), and from 270; the outer two split at their medians (up to it goes first).

    A side with at most one member splits at 90 or 315.
    """
    a = F.col(azimuth)
    low, high = F.when(a < 180, a), F.when(a >= 270, a)
    n = rows.agg(F.count(low).alias("low"), F.count(high).alias("high")).first()
    cut_low = exact_quantiles(rows.filter(a < 180), azimuth, [0.5])[0] if n["low"] > 1 else 90.0
    cut_high = exact_quantiles(rows.filter(a >= 270), azimuth, [0.5])[0] if n["high"] > 1 else 315.0
    group = (
        F.when(a < 180, F.when(a <= cut_low, "low1").otherwise("low2"))
        .when(a >= 270, F.when(a <= cut_high, "high1").otherwise("high2"))
        .when(a.isNotNull(), "mid")
    )
    return rows.withColumn(name, group)


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("__n", place).filter("__n = 1").drop("__n")
