"""From raw documents to packed training sequences: each stage is one operator of regolith.llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regolith.llm import decontam, linededup, minhash, quality, queries
from regolith.session import stage


def _judged(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], stays: Column) -> DataFrame:
    """The rows of ``docs`` that ``stays`` holds for after ``judge`` has added its columns, with the columns of ``docs`` alone.

    While they are judged, other columns than the text have names of their own, so that none is taken for a result.
    """
    names = {c: "text" if c == "text" else f"__own{k}" for k, c in enumerate(docs.columns)}
    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return judge(named).filter(stays).select(*[F.col(n).alias(c) for c, n in names.items()])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model scores at least queries.ACCEPT, with all their columns.

    A null or empty text is judged as one without lines, a long one by all its lines, repeated rows each; columns of any other name
    are left as they are; an empty table stays empty. Labels are read by doc_id, for training only.
    """
    model = queries.line_model(docs, queries.read(spark, sf_dir, "labels"))
    return _judged(docs, lambda d: quality.score(d, model, score_col="__score"), F.col("__score") >= queries.ACCEPT)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their source's common lines; n_chars follows.

    Exact copies are one page here: they are the next stage's work, which needs the text of one of them. A null text stays
    null, with a null n_chars; a null source is a source of its own; a text of common lines alone becomes empty; other columns
    stay; an empty table stays empty.
    """
    clean = linededup.drop_common_lines(docs, queries.LINE_RATIO, queries.LINE_PAGES, copies=False)
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, that with the smallest id (nulls last): five-word shingles, similarity 0.8.

    Null and empty texts are in no group and stay; repeated ids are rows like others; other columns stay; an empty table stays empty.
    """
    return minhash.first_rows(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows.

    Null and empty texts have no words and stay; repeated rows are judged each; columns stay, also those that are
    named like the operator's results; an empty table, or an empty benchmark, changes nothing.
    """
    benchmark = queries.read(spark, sf_dir, "benchmark")
    return _judged(docs, lambda d: decontam.contamination(d, benchmark), ~F.col("contaminated"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset); other columns are left out.

    A null or empty text is its end id alone, a long one is cut over sequences, repeated rows are packed each, a null source is a
    source of its own, and an empty table gives no pieces.
    """
    return queries.packed(docs)


STAGES = [
    ("quality", keep_good),
    ("lines", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]
#: The stages fit models and hash by functions that SQL doesn't have; tests/llm compares them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.read(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
