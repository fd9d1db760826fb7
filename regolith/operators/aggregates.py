"""Counts, flags and summaries of statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regolith.operators.windows import exact_quantiles, group_quantile


def count_stages(**stages: DataFrame) -> DataFrame:
    """(stage, n): the row count after each step of a query."""
    out = None
    for name, rows in stages.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        out = one if out is None else out.unionAll(one)
    return out


def distinct_ids(pairs: DataFrame, left: str, right: str, name: str = "id") -> DataFrame:
    return pairs.select(F.explode(F.array(left, right)).alias(name)).distinct()


def degree(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def degree_histogram(edges: DataFrame, components: DataFrame) -> DataFrame:
    """(component, degree, vertices)."""
    return degree(edges).join(components, "id").groupBy("component", "degree").agg(F.count(F.lit(1)).alias("vertices"))


def residual_summary(rows: DataFrame, group: str, column: str = "median", limit: float = 5.0) -> DataFrame:
    """(group, n, median, max, over) without NaN."""
    ok = rows.filter(~F.isnan(column))
    counts = ok.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.max(column).alias("max"), F.count_if(F.col(column) > limit).alias("over"))
    return counts.join(group_quantile(ok, group, column, 0.5, "__median"), group, "left").select(group, "n", F.col("__median").alias("median"), "max", "over")


def fixed_cameras(offsets: DataFrame) -> DataFrame:
    return offsets.filter("horiz = 0 AND vert = 0").select("image").distinct()


def anchor_verdict(residuals: DataFrame, fixed: DataFrame, limit: float = 5.0) -> DataFrame:
    """(n, bad, verdict): FAIL when more than max(2, a tenth) of the fixed cameras have a median above the limit."""
    rows = residuals.join(fixed, "image", "left_semi").filter(~F.isnan("median"))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("median") > limit).alias("bad"))
    return counts.withColumn("verdict", F.when(F.col("bad") > F.greatest(F.lit(2.0), 0.1 * F.col("n")), "FAIL").otherwise("PASS"))


def flag_cameras(offsets: DataFrame, residuals: DataFrame, shifts: DataFrame, max_p95: float = 5.0, min_matches: int = 50, max_median: float = 0.75, max_shift: float = 1000.0) -> DataFrame:
    """(id, reasons): why an image's camera is suspect; reasons are sorted. An image has at most four."""
    reason = lambda rows, test, why: rows.filter(test).select(F.col("image").alias("id"), F.lit(why).alias("reason"))
    every = (
        reason(offsets, F.col("p95") > max_p95, "offset")
        .unionAll(reason(offsets, F.col("cnt") < min_matches, "matches"))
        .unionAll(reason(residuals, ~F.isnan("median") & (F.col("median") > max_median), "residual"))
        .unionAll(reason(shifts, F.hypot("horiz", "vert") > max_shift, "shift"))
    )
    return every.groupBy("id").agg(F.sort_array(F.collect_set("reason")).alias("reasons"))


def robust_outliers(rows: DataFrame, rules: dict[str, tuple[float, float]], key: str = "id") -> DataFrame:
    """(key, reasons): columns above max(factor times the column's median, floor), joined by ``+``; nulls and NaN are no outliers."""
    limits = {c: max(f * (exact_quantiles(rows, c, [0.5])[0] or 0.0), float(low)) for c, (f, low) in rules.items()}
    why = [F.when(~F.isnan(c) & (F.col(c) > limit), c) for c, limit in limits.items()]
    return rows.select(key, F.concat_ws("+", *why).alias("reasons")).filter("reasons <> ''")


def wild_ids(offsets: DataFrame, limit: float = 50.0) -> DataFrame:
    from regolith.functions.ids import filename_to_pid

    return offsets.filter(F.col("p95") > limit).select(filename_to_pid(F.col("image")).alias("product_id"))


def extent(rows: DataFrame, time: str | None = None) -> DataFrame:
    """One row: total box, and first and last time."""
    more = [F.min(time).alias("t0"), F.max(time).alias("t1")] if time else []
    return rows.agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), *more)


def incidence_bins(rows: DataFrame, column: str = "incidence_angle") -> DataFrame:
    """(bin, n) of half-open bins of one degree; ten bins across the range if all fall in one."""
    limits = rows.agg(F.floor(F.min(column)).alias("a"), F.floor(F.max(column)).alias("b"), F.min(column).alias("lo"), F.max(column).alias("hi"))
    tenth = F.least(F.floor((F.col(column) - F.col("lo")) / F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / 10)), F.lit(9))
    narrow = F.col("lo") + F.coalesce(tenth, F.lit(0)) * (F.col("hi") - F.col("lo")) / 10
    bin_ = F.when(F.col("a") == F.col("b"), narrow).otherwise(F.floor(column).cast("double"))
    return rows.filter(F.col(column).isNotNull()).crossJoin(F.broadcast(limits)).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def counts_agree(a: DataFrame, b: DataFrame, at_least: bool = False) -> DataFrame:
    """(n_a, n_b, agree)."""
    both = a.agg(F.count(F.lit(1)).alias("n_a")).crossJoin(b.agg(F.count(F.lit(1)).alias("n_b")))
    return both.withColumn("agree", F.col("n_a") >= F.col("n_b") if at_least else F.col("n_a") == F.col("n_b"))
