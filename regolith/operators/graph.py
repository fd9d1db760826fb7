"""Graph operators over edge tables (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regolith.session import cut, stage


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(id, component) for every vertex of ``edges``; component is the smallest id reachable.

    Alternating large-star and small-star: every round is two grouped minima and two joins, so no neighbourhood is
    ever gathered in one row, and a hub's neighbours stay rows that a skewed join may split. Rounds end at a forest of
    stars, which both steps leave as it is. Null endpoints and self-loops link nothing; a vertex that has only self-loops
    is its own component; no edges give no rows.
    """
    clean = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    vertices = clean.select(F.explode(F.array("u", "v")).alias("u")).distinct()
    now = cut(clean.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        if _are_stars(now):
            break
        now = cut(_small_star(_large_star(now)))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return vertices.join(now, "u", "left").select(F.col("u").alias("id"), F.coalesce("v", "u").alias("component"))


def _both_ways(u: str, v: str, x: str, y: str):
    """Two rows (u, v) and (x, y) for each row."""
    return F.inline(F.array(F.struct(F.col(u).alias("u"), F.col(v).alias("v")), F.struct(F.col(x).alias("u"), F.col(y).alias("v"))))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every u has one edge only and is no v."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("out")), F.struct(F.col("v").alias("id"), F.lit(0).alias("out")))))
    odd = ends.groupBy("id").agg(F.sum("out").alias("outs"), F.min("out").alias("least")).filter("outs > 1 OR (outs = 1 AND least = 0)")
    return odd.agg(F.count(F.lit(1))).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(_both_ways("u", "v", "v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select(_both_ways("v", "m", "u", "m")).filter("u <> v").distinct()


def component_ranks(components: DataFrame) -> DataFrame:
    """(id, component, component_rank, size): components by size, largest first, the smallest id first of equals; from 0."""
    from regolith.operators.windows import global_rank

    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    ranked = global_rank(sizes, [-F.col("size"), "component"], "__r").select("component", "size", (F.col("__r") - 1).alias("component_rank"))
    return components.join(ranked, "component").select("id", "component", "component_rank", "size")


def component_summary(edges: DataFrame, components: DataFrame) -> DataFrame:
    """(component, size, pairs), a row for each component."""
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    pairs = edges.join(components, F.col("src") == F.col("id")).groupBy("component").agg(F.count(F.lit(1)).alias("pairs"))
    return sizes.join(pairs, "component", "left").select("component", "size", F.coalesce("pairs", F.lit(0).cast("long")).alias("pairs"))


def check_connectivity(edges: DataFrame) -> DataFrame:
    """One row: is_connected, num_pairs, num_components, component_sizes, num_pairs_per_component and degree_hist_per_component,
    largest component first. No edges give 0 components. Members stay in ``connected_components``' rows: they may be many.
    """
    from regolith.operators.aggregates import degree_histogram

    components = cut(connected_components(edges))
    summary = component_summary(edges, components)
    degrees = degree_histogram(edges, components).groupBy("component").agg(F.array_sort(F.collect_list(F.struct("degree", "vertices"))).alias("hist"))
    rows = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("s"), "component", "pairs", "hist")))
    report = summary.join(degrees, "component").agg(rows.alias("r"), F.coalesce(F.sum("pairs"), F.lit(0).cast("long")).alias("num_pairs"))
    return report.select(
        (F.size("r") == 1).alias("is_connected"), "num_pairs", F.size("r").cast("long").alias("num_components"),
        F.transform("r", lambda x: -x["s"]).alias("component_sizes"), F.transform("r", lambda x: x["pairs"]).alias("num_pairs_per_component"), F.transform("r", lambda x: F.map_from_entries(F.transform(x["hist"], lambda h: F.struct(h["degree"].cast("string"), h["vertices"])))).alias("degree_hist_per_component"),
    )


def max_spanning_forest(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """(src, dst, weight): the heaviest forest (Borůvka's rounds); of equal weights the smaller (src, dst)."""
    rest = stage(edges.select("src", "dst", F.col(weight).alias("weight")).filter("src <> dst").distinct(), "edges")
    vertices = rest.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    label = vertices.withColumn("component", F.col("id"))
    forest = None
    while True:
        named = rest.join(label.select(F.col("id").alias("src"), F.col("component").alias("cs")), "src").join(label.select(F.col("id").alias("dst"), F.col("component").alias("cd")), "dst").filter("cs <> cd")
        both = named.select(F.explode(F.array("cs", "cd")).alias("c"), "src", "dst", "weight")
        lightest = Window.partitionBy("c").orderBy(F.desc("weight"), "src", "dst")
        best = stage(both.withColumn("n", F.row_number().over(lightest)).filter("n = 1").select("src", "dst", "weight").distinct(), "lightest")
        if best.isEmpty():
            return rest.limit(0) if forest is None else forest
        forest = best if forest is None else stage(forest.union(best), "forest")
        label = vertices.join(connected_components(forest), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def neighbors(edges: DataFrame, vertex) -> DataFrame:
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return both.filter(F.col("src") == vertex).select(F.col("dst").alias("id")).distinct()


def shortest_path(edges: DataFrame, start, end, max_length: int = 1000) -> DataFrame:
    """(step, id) of the path with the fewest edges, of equals the one with the smallest ids from the start on; empty if there is none
    of at most ``max_length`` edges.

    The search goes from both ends, always on from the smaller front. Rows carry the least path to them, so the two halves of the
    answer meet in one join. Neighbours of a front are in it, in the front before or in the next, so only these are left out.
    """
    spark = edges.sparkSession
    kind = edges.schema["src"].dataType.simpleString()
    if start == end:
        return spark.createDataFrame([(0, start)], f"step int, id {kind}")
    known = edges.filter("src IS NOT NULL AND dst IS NOT NULL")
    both = stage(known.select("src", "dst").union(known.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    at = lambda v: spark.createDataFrame([(v, [v])], f"id {kind}, path array<{kind}>")
    fronts, earlier, sizes = [at(start), at(end)], [None, None], [1, 1]
    grow = [lambda: F.concat("path", F.array("dst")), lambda: F.concat(F.array("dst"), "path")]
    for _ in range(max_length):
        k = 0 if sizes[0] <= sizes[1] else 1
        old = fronts[k].select("id") if earlier[k] is None else fronts[k].select("id").union(earlier[k].select("id"))
        grown = fronts[k].join(both, F.col("id") == F.col("src")).groupBy("dst").agg(F.min(grow[k]()).alias("path")).select(F.col("dst").alias("id"), "path")
        fronts[k], earlier[k] = cut(grown.join(old, "id", "left_anti")), fronts[k]
        sizes[k] = fronts[k].count()
        if not sizes[k]:
            break
        ahead, behind = fronts[0].select("id", "path"), fronts[1].select("id", F.col("path").alias("rest"))
        met = ahead.join(behind, "id").select(F.concat("path", F.slice("rest", F.lit(2), F.size("rest"))).alias("path")).agg(F.min("path").alias("path"))
        met = met.filter("path IS NOT NULL").select(F.posexplode("path").alias("step", "id"))
        if not met.isEmpty():
            return met
    return spark.createDataFrame([], f"step int, id {kind}")


def subgraph(edges: DataFrame, ranked: DataFrame, index: int) -> DataFrame:
    """Edges whose ends are in the component of that rank."""
    inside = ranked.filter(F.col("component_rank") == index).select("id")
    return edges.join(inside.withColumnRenamed("id", "src"), "src", "left_semi").join(inside.withColumnRenamed("id", "dst"), "dst", "left_semi")
