"""Orders, samples and sets of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regolith.functions import ids
from regolith.operators.windows import chunk_rows, global_rank


def order_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.orderBy(F.desc("roi_overlap_percent"), F.desc("overlap_percent"))


def largest_pairs(pairs: DataFrame, n: int = 500, by: str = "pair_area", ties: tuple[str, ...] = ("l_id", "r_id")) -> DataFrame:
    return pairs.orderBy(F.desc(by), *ties).limit(n)


def worst_cameras(rows: DataFrame, n: int = 10, by: str = "median", key: str = "image") -> DataFrame:
    """The largest medians; NaN is none."""
    return rows.filter(~F.isnan(by)).orderBy(F.desc(by), key).limit(n)


def sort_by_azimuth(rows: DataFrame, azimuth: str) -> DataFrame:
    return rows.orderBy(azimuth)


def random_sample(rows: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows, the same for a seed: those with the least hashes; more than there are is an error.

    Only rows with a hash below about the n-th are ranked, by tasks for ranges of hashes; the bound grows until it holds n rows.
    """
    total = rows.count()
    if n > total:
        raise ValueError("the list is shorter than the sample")
    if not n:
        return rows.limit(0)
    marked, share = rows.withColumn("__h", F.xxhash64(F.lit(seed), *rows.columns)), (n + 5 * n**0.5 + 5) / total
    while True:
        near = marked if share >= 1 else marked.filter(F.col("__h") <= int((share - 0.5) * 2**64))
        if share >= 1 or near.count() >= n:
            break
        share *= 2
    return global_rank(near, ["__h", *rows.columns], "__r").filter(F.col("__r") <= n).select(*rows.columns)


def cap_products(rows: DataFrame, n: int, key: str) -> DataFrame:
    return rows.orderBy(key).limit(n)


def rank_quality(rows: DataFrame, order: list[str], size: int = 100) -> DataFrame:
    """In batches of about ``size`` by the quality keys."""
    return chunk_rows(rows, order, size, "batch")


class IdSet:
    """Distinct values of a column with the set operations; results are lazy DataFrames of ``value``."""

    def __init__(self, values: DataFrame):
        self.values = values.select(F.col(values.columns[0]).alias("value")).filter("value IS NOT NULL").distinct()

    @classmethod
    def of(cls, rows: DataFrame, index: int = 0, by_pid: bool = False) -> IdSet:
        """Column ``index``; with ``by_pid`` the first product id of each value, if any."""
        value = F.col(f"`{rows.columns[index]}`").cast("string")
        return cls(rows.select((ids.extract_pid(value) if by_pid else value).alias("value")))

    def union(self, other: IdSet) -> IdSet:
        return IdSet(self.values.union(other.values))

    def intersection(self, other: IdSet) -> IdSet:
        return IdSet(self.values.intersect(other.values))

    def difference(self, other: IdSet) -> IdSet:
        return IdSet(self.values.join(other.values, "value", "left_anti"))

    def symmetric_difference(self, other: IdSet) -> IdSet:
        return self.difference(other).union(other.difference(self))

    def issubset(self, other: IdSet, proper: bool = False) -> bool:
        return self.difference(other).values.isEmpty() and not (proper and other.difference(self).values.isEmpty())

    def issuperset(self, other: IdSet, proper: bool = False) -> bool:
        return other.issubset(self, proper)

    def isdisjoint(self, other: IdSet) -> bool:
        return self.intersection(other).values.isEmpty()

    def isequal(self, other: IdSet) -> bool:
        return self.issubset(other) and other.issubset(self)

    def sorted(self) -> DataFrame:
        return self.values.orderBy("value")


def list_complement(rows: DataFrame, primary: DataFrame, key: str) -> DataFrame:
    return rows.join(primary.select(key), key, "left_anti")


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def sort_unique_merge(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct().orderBy(a.columns[0])
