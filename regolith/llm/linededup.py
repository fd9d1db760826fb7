"""Lines that too many pages of a host share, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regolith.session import stage

#: Parts that the pages of one host are dealt to where hosts' lines are too many to broadcast.
SALTS = 64


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b"))


def boilerplate(docs: DataFrame, ratio: float, min_pages: int, host: Column, text: Column, copies: bool = True) -> DataFrame:
    """(host, keys): the 128-bit keys of each host's lines on at least ``min_pages`` pages and more than ``ratio`` of them.

    A host's pages have m distinct lines on average, so at most m / ratio lines pass: the array stays as small as a page.
    Without ``copies``, a host's rows with one text (by a 128-bit key) are one page.
    """
    pages = docs.select(host.alias("host"), text.alias("text"))
    if not copies:
        pages = pages.groupBy("host", _key(F.col("text")).alias("key")).agg(F.first("text").alias("text"))
    pages = pages.select("host", F.array_distinct(F.split("text", "\n", -1)).alias("lines"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = pages.select("host", F.explode("lines").alias("line")).filter(F.trim("line") != "")
    counts = lines.select("host", _key(F.col("line")).alias("key")).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    common = counts.join(totals, "host").filter(F.col("n") > F.lit(ratio) * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list("key").alias("keys"))


def drop_common_lines(
    docs: DataFrame, ratio: float = 0.02, min_pages: int = 5, host: Column | None = None, text_col: str = "text", n_dropped: str | None = None, copies: bool = True
) -> DataFrame:
    """``docs`` without the lines that a host's pages share too often; other columns and the row count stay.

    The frequency of a line is the number of the host's pages with it divided by the number of the host's pages. Lines are
    what single \\n separate, compared exactly (by 128-bit keys); blank lines are never counted or dropped. A null host is
    a host of its own; a null text stays null; a text of common lines alone becomes empty; repeated rows count as pages
    each, or, without ``copies``, rows of a host with one text as one page, so that a group of exact copies doesn't make its
    own lines common; an empty table stays empty. ``n_dropped`` names a column for the number of lines dropped (replaced if there).
    """
    host = F.coalesce(F.col("source").cast("string") if host is None else host, F.lit("\0"))
    text = F.col(text_col).cast("string")
    bad = boilerplate(docs, ratio, min_pages, host, text, copies).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # staged, so that Spark knows its size: it is broadcast if small, and pages stay where they are
    bad = stage(bad, "common_lines").select(F.col("host").alias("__host"), F.col("salt").alias("__salt"), F.col("keys").alias("__keys"))
    names = [c for c in docs.columns if c != n_dropped]
    salt = F.pmod(F.xxhash64(text, F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
    joined = docs.withColumn("__own", host).withColumn("__part", salt)
    joined = joined.join(bad, (F.col("__own") == F.col("__host")) & (F.col("__part") == F.col("__salt")), "left")
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains("__keys", _key(x)), F.lit(False)) | (F.trim(x) == ""))
    clean = F.when(F.col("__keys").isNull(), text).otherwise(F.array_join(kept, "\n"))
    out = [clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in names]
    if n_dropped:
        out.append(F.when(F.col("__keys").isNull() | text.isNull(), 0).otherwise(F.size(lines) - F.size(kept)).cast("long").alias(n_dropped))
    return joined.select(*out)
