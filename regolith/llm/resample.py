"""Importance resampling towards a target: documents that look like it in hashed words and word pairs are likelier to be drawn."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from regolith.llm import text as tx
from regolith.operators.windows import global_rank
from regolith.session import stage

#: What stands between words, for Arrow's regular expressions, after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that one dictionary of words covers; a longer document has its own.
SLICE = 4 << 20
RESULTS = ("n_words", "n_features", "weight", "score", "rank")


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, buckets of all words in order, buckets of all pairs in order) of Arrow texts.

    Words are indices into the slice's dictionary, pairs are the indices and the same shifted by one, and the checksum is taken
    once for each distinct word and pair: that of a pair goes on from that of its first word.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    encoded = pc.list_flatten(lists).dictionary_encode()
    known = [x.encode() for x in encoded.dictionary.to_pylist()]
    index = encoded.indices.to_numpy().astype(np.int64)
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    blank = known.index(b"") if b"" in known else -1
    index, of = index[index != blank], of[index != blank]
    first = np.array([zlib.crc32(x) for x in known] or [0], np.int64)
    pair = (index[:-1] * max(len(known), 1) + index[1:])[of[:-1] == of[1:]]
    distinct, at = np.unique(pair, return_inverse=True)
    with_blank = [zlib.crc32(b" ", int(c)) for c in first]
    both = np.array([zlib.crc32(known[b], with_blank[a]) for a, b in zip(*(x.tolist() for x in np.divmod(distinct, max(len(known), 1))), strict=True)] or [0], np.int64)
    return np.bincount(of, minlength=len(texts)), (first % buckets)[index], (both % buckets)[at] if len(at) else np.zeros(0, np.int64)


def _texts(column: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    """(first row, end row, texts) of slices of a text column; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = tx.column(column)[1]
    for i, j in tx.slices(offsets, SLICE):
        yield i, j, column.slice(i, j - i)


def bucket_counts(docs: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """How many features of all texts lie in each bucket; one row for each bucket and partition is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, texts in _texts(batch.column(0)):
                _, one, two = features(texts, buckets)
                total += np.bincount(one, minlength=buckets) + np.bincount(two, minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["bucket", "n"])

    counted = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray, buckets: int) -> np.ndarray:
    """floor(1000 ln of how much likelier a bucket is in the target), each count raised by one."""
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, keep: list[str], text_col: str, gain: np.ndarray) -> DataFrame:
    """``keep`` columns, n_words, n_features and weight: the floored mean of gains over a text's features, 0 without any."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.columns[:-1]
            for i, j, texts in _texts(batch.column(len(own))):
                n, one, two = features(texts, buckets)
                pairs = np.maximum(n - 1, 0)
                total = np.zeros(j - i, np.int64)
                for size, buckets_of in ((n, one), (pairs, two)):  # sums of segments by differences of running sums
                    sums = np.concatenate([[0], np.cumsum(gain.take(buckets_of))])
                    ends = np.cumsum(size)
                    total += sums[ends] - sums[ends - size]
                yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in own], pa.array(n), pa.array(n + pairs), pa.array(total // np.maximum(n + pairs, 1))], [*keep, *RESULTS[:3]])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text"))
    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], *[StructField(c, LongType()) for c in RESULTS[:3]]]))


def resample(docs: DataFrame, target: DataFrame, keep: list[str], percent: int = 25, buckets: int = 10_000, min_words: int = 20, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row of ``docs`` with n_words, n_features, weight, score and rank (long).

    Features are words and pairs of neighbouring words, repeats counted, hashed to ``buckets``. A document's weight says how
    likely its features are in ``target`` rather than in ``docs``; score adds Gumbel noise from a hash of ``seed`` and the id,
    so that the highest scores are a sample without replacement with those odds. Of the documents with ``min_words`` words or more,
    ``percent`` in a hundred are drawn; rank is their place by score, ties to the smaller id; the others have a null rank.

    Both tables are read once for counts of buckets and ``docs`` once more for weights; only the ``keep`` columns and numbers are
    sorted. Null texts have no words; repeated rows count and compete each; a null id is hashed as an empty one; empty tables
    are fine on either side; a null id comes before others in ties; other columns are ignored, and ``keep`` may name no result.
    """
    if clash := set(keep) & set(RESULTS):
        raise ValueError(f"columns named like results: {sorted(clash)}")
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets), buckets)
    named = keep if id_col in keep else [*keep, id_col]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    even = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(even)))
    rows = stage(weigh(docs, named, text_col, gain).withColumn("score", F.col("weight") + noise), "weights")
    able = rows.filter(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    ranked = global_rank(able, [-F.col("score"), F.col(f"`{id_col}`")], "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    out = ranked.unionByName(rows.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select(*[F.col(f"`{c}`") for c in keep], *RESULTS)
