"""The network of images after a solve: verification, inspection, stereo pairs and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regolith.functions import ids
from regolith.operators import aggregates, filters, graph, joins, lists, raster
from regolith.session import cut, stage


def network_pairs(pair_stats: DataFrame, residuals: DataFrame, min_matches: int = 1, max_residual: float = 1.25, offsets: DataFrame | None = None, min_offset_matches: int = 1, max_p85: float = 5.0, mode: str = "verify") -> DataFrame:
    """Pairs with enough matches between two images with small residuals, and good offsets if given."""
    pairs = filters.match_filter(pair_stats, min_matches)
    pairs = joins.pairs_with(pairs, filters.residual_filter(residuals, max_residual, 1, mode))
    return pairs if offsets is None else joins.pairs_with(pairs, filters.offset_filter(offsets, min_offset_matches, max_p85))


def edges_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(ids.filename_to_pid(F.col("l_image")).alias("src"), ids.filename_to_pid(F.col("r_image")).alias("dst"))


def verify_network(pair_stats: DataFrame, residuals: DataFrame, **limits) -> DataFrame:
    """The connectivity report of the good pairs."""
    return graph.check_connectivity(stage(edges_of(network_pairs(pair_stats, residuals, **limits)), "edges"))


def stereo_from_network(convergence: DataFrame, pair_stats: DataFrame, residuals: DataFrame, component: DataFrame, footprints: DataFrame | None = None, matches: int = 100, max_residual: float = 1.25, least: float = 10, most: float = 22, top: int = 500) -> DataFrame:
    """The largest stereo pairs of a component with good convergence; without footprints those with most matches."""
    good = filters.convergence_filter(convergence, least, most, matches)
    pairs = joins.stereo_pair_join(good, component, pair_stats.filter("p25 > 0"), filters.residual_filter(residuals, max_residual, 0, "stereo"))
    if footprints is None:
        return lists.largest_pairs(pairs, top, "num", ("l_image", "r_image"))
    named = pairs.withColumns({"l_id": ids.filename_to_pid(F.col("l_image")), "r_id": ids.filename_to_pid(F.col("r_image"))})
    return lists.largest_pairs(joins.pair_geometry_join(named, footprints), top)


def component_of(pair_stats: DataFrame, residuals: DataFrame, index: int, **limits) -> DataFrame:
    """(id) of the component of that rank."""
    found = cut(graph.connected_components(edges_of(network_pairs(pair_stats, residuals, **limits))))
    return graph.component_ranks(found).filter(F.col("component_rank") == index).select("id")


def inspect_network(pair_stats: DataFrame, residuals: DataFrame, vertex: str | None = None, other: str | None = None, index: int = 0, **limits) -> dict[str, DataFrame]:
    """What one asks of a network: its pairs and degrees, the pairs of the component of that rank, a vertex' neighbours, and
    a shortest path from it to another."""
    pairs = network_pairs(pair_stats, residuals, mode="inspect", **limits)
    edges = stage(edges_of(pairs), "edges")
    ranked = graph.component_ranks(cut(graph.connected_components(edges)))
    out = {"pairs": pairs, "degrees": aggregates.degree(edges), "component": graph.subgraph(edges, ranked, index)}
    if vertex is not None:
        out["neighbors"] = graph.neighbors(edges, vertex)
        if other is not None:
            out["path"] = graph.shortest_path(edges, vertex, other)
    return out


def flag_frames(pixels: DataFrame, rules: dict[str, tuple[float, float]], decimate_by: int = 8, least: int = 500) -> DataFrame:
    """(id, reasons) of rasters whose brightness ``p`` or stripe ``score`` is an outlier by the rules (factor of the median, floor)."""
    return flag_measured(raster.brightness(pixels, decimate_by, 0.999, least).join(raster.stripe_score(pixels), "raster_id", "full"), rules)


def flag_measured(measured: DataFrame, rules: dict[str, tuple[float, float]]) -> DataFrame:
    """The same from what was measured of each raster (raster_id, p, score)."""
    return aggregates.robust_outliers(stage(measured.withColumnRenamed("raster_id", "id"), "frames"), rules)


def flag_cameras(offsets: DataFrame, residuals: DataFrame, shifts: DataFrame, **limits) -> DataFrame:
    return aggregates.flag_cameras(offsets, residuals, shifts, **limits)


def fixed_check(camera_offsets: DataFrame, residuals: DataFrame, limit: float = 5.0) -> DataFrame:
    return aggregates.anchor_verdict(residuals, aggregates.fixed_cameras(camera_offsets), limit)


def downselect_dems(files: DataFrame, diffs: DataFrame, errors: DataFrame, max_error: float = 1.0, max_diff: float = 10.0, old: str = "-diff", new: str = "-DEM") -> DataFrame:
    """Names of the models whose height difference and triangulation error are small."""
    good = filters.dem_diff_filter(diffs, "mean", max_diff)
    sure = filters.dem_diff_filter(errors, "mean", max_error, absolute=False)
    return joins.good_dems(files, good, sure, old, new)
