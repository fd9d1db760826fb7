"""Orders of images by illumination inside bounded groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regolith.operators import windows
from regolith.operators.spatial import cell_join, cell_size

AZIMUTH = "roi_sub_solar_ground_azimuth"
#: Images that one task orders; a larger group is ordered in chunks of so many by azimuth, one after another.
MAX_GROUP = 2000


def illumination_edge_weights(rows: DataFrame, group: str, azimuth: str = AZIMUTH) -> DataFrame:
    """(group, l_id, r_id, weight) of all pairs inside bounded groups.

    The azimuth difference of the first to the second by id, twice its square if negative, plus 100 if the boxes don't meet.
    """
    side = lambda p: rows.select(group, *[F.col(c).alias(p + c) for c in ("product_id", azimuth, "x0", "y0", "x1", "y1")])
    pairs = side("l_").join(side("r_"), group).filter("l_product_id < r_product_id")
    d = F.col("l_" + azimuth) - F.col("r_" + azimuth)
    meet = F.expr("l_x0 <= r_x1 AND r_x0 <= l_x1 AND l_y0 <= r_y1 AND r_y0 <= l_y1")
    weight = F.when(d < 0, 2 * d * d).otherwise(d) + F.when(meet, 0.0).otherwise(100.0)
    return pairs.select(group, F.col("l_product_id").alias("l_id"), F.col("r_product_id").alias("r_id"), weight.alias("weight"))


def intersection_pairs(rows: DataFrame) -> DataFrame:
    """(l_product_id, r_product_id): the adjacency of boxes that meet."""
    return cell_join(rows, rows, cell_size(rows), F.col("l_product_id") < F.col("r_product_id")).select("l_product_id", "r_product_id")


def _meeting(p: pd.DataFrame) -> np.ndarray:
    x0, y0, x1, y1 = (p[c].to_numpy(dtype=float) for c in ("x0", "y0", "x1", "y1"))
    meet = (x0[:, None] <= x1) & (x0 <= x1[:, None]) & (y0[:, None] <= y1) & (y0 <= y1[:, None])
    np.fill_diagonal(meet, False)
    return meet


def by_weight(p: pd.DataFrame, azimuth: str) -> list[int]:
    """From the least weight on to the nearest not smaller that meets the last image, else the nearest not smaller, else the nearest."""
    w, meet = p[azimuth].to_numpy(dtype=float), _meeting(p)
    order = [int(np.argmin(w))]
    free = np.ones(len(w), bool)
    free[order[0]] = False
    while free.any():
        last = order[-1]
        gap = np.abs(w - w[last])
        for able in (free & meet[last] & (w >= w[last]), free & (w >= w[last]), free):
            if able.any():
                order.append(int(np.argmin(np.where(able, gap, np.inf))))
                break
        free[order[-1]] = False
    return order


def by_degree(p: pd.DataFrame) -> list[int]:
    """From the most connected on to the most connected free neighbour, else to the first free image."""
    meet = _meeting(p)
    degree = meet.sum(axis=1)
    order = [int(np.argmax(degree))]
    free = np.ones(len(p), bool)
    free[order[0]] = False
    while free.any():
        near = free & meet[order[-1]]
        order.append(int(np.argmax(np.where(near, degree, -1))) if near.any() else int(np.argmax(free)))
        free[order[-1]] = False
    return order


def by_tour(p: pd.DataFrame, azimuth: str) -> list[int]:
    """A nearest-neighbour path on the illumination weights, improved by exchanges of two edges."""
    w, meet = p[azimuth].to_numpy(dtype=float), _meeting(p)
    d = w[:, None] - w
    d = np.where(np.arange(len(w))[:, None] < np.arange(len(w)), d, d.T)
    cost = np.where(d < 0, 2 * d * d, d) + np.where(meet, 0, 100.0)
    order, free = [int(np.argmin(w))], np.ones(len(w), bool)
    free[order[0]] = False
    while free.any():
        order.append(int(np.argmin(np.where(free, cost[order[-1]], np.inf))))
        free[order[-1]] = False
    path, better = np.array(order), True
    while better:
        better = False
        for i in range(1, len(path) - 2):
            now = cost[path[i - 1], path[i]] + cost[path[i + 1 : -1], path[i + 2 :]]
            then = cost[path[i - 1], path[i + 1 : -1]] + cost[path[i], path[i + 2 :]]
            k = int(np.argmin(then - now)) if len(now) else -1
            if k >= 0 and then[k] < now[k] - 1e-9:
                path[i : i + k + 2] = path[i : i + k + 2][::-1].copy()
                better = True
    return path.tolist()


def ordered_groups(rows: DataFrame, group: str, method: str = "weight", azimuth: str = AZIMUTH, key: str = "product_id") -> DataFrame:
    """``rows`` with ``place`` from 1 in each group; ties go to the smaller id. Chunks of a group beyond MAX_GROUP follow each other."""
    orders = {"weight": lambda p: by_weight(p, azimuth), "degree": by_degree, "tour": lambda p: by_tour(p, azimuth)}
    kinds = {c: rows.schema[c].dataType.simpleString() for c in (group, key)}

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(key, ignore_index=True)
        place = np.empty(len(p), np.int64)
        place[orders[method](p)] = np.arange(1, len(p) + 1) + p["__chunk"].iloc[0] * MAX_GROUP
        return pd.DataFrame({group: p[group], key: p[key], "place": place})

    chunk = F.floor((F.row_number().over(Window.partitionBy(group).orderBy(azimuth, key)) - 1) / MAX_GROUP)
    needed = rows.select(group, key, azimuth, "x0", "y0", "x1", "y1", chunk.alias("__chunk"))
    return rows.join(needed.groupBy(group, "__chunk").applyInPandas(run, f"{group} {kinds[group]}, {key} {kinds[key]}, place bigint"), [group, key])


def reorder_by_illumination_bins(rows: DataFrame, bins: int = 90, azimuth: str = AZIMUTH) -> DataFrame:
    """Quantile bins by azimuth, each ordered by weight; with whether each image meets the next of its bin."""
    placed = ordered_groups(windows.quantile_bins(rows, azimuth, bins), "bin", "weight", azimuth)
    return windows.intersects_next(placed, "bin", "place")


def reorder_by_illumination_tour(rows: DataFrame, chunk: int = 50, azimuth: str = AZIMUTH) -> DataFrame:
    """Chunks by azimuth, each ordered by a tour."""
    return ordered_groups(windows.chunk_rows(rows, [azimuth, "product_id"], chunk), "chunk", "tour", azimuth)
