"""Benchmark decontamination with a stored positional inverted index over the documents.

The index holds, for each word and block of documents, the positions of the word in the block. It is written once, dealt by
word (in buckets, a row for each bucket and block), and holds all words, so it serves any benchmark. A benchmark's windows start from their rarest word: its list meets the
next rarest one, shifted by their distance, by joins on the index, and what is left is compared with the document's own words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regolith.llm import text as tx
from regolith.session import stage

#: Bytes of text in a block of the index; a longer document is a block of its own.
BLOCK = 16 * tx.SLICE
#: Words fall into 2**BUCKET_BITS buckets, and a bucket's blocks into SHARES parts, each written by one task.
BUCKET_BITS, SHARES = 10, 64


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the lower-cased texts, first word of each text)."""
    data = tx.LOWER[data]
    starts, ends, first = tx.words(data, offsets, tx.NON_WORDS)
    return tx.word_hashes(data, starts, ends), first


def words_of(text: str) -> list[bytes]:
    data, offsets = tx.column(pa.array([text], pa.string()))
    data = tx.LOWER[data[offsets[0] : offsets[1]]]
    starts, ends, _ = tx.words(data, np.array([0, len(data)]), tx.NON_WORDS)
    return [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


@dataclass
class Index:
    """``buckets`` (bucket, block, terms, counts, gaps): sorted words as 64-bit hashes, how often each is there, and the gaps
    between its positions, all little-endian; ``bounds`` (block, rows, first): the documents of a block and the numbers of their
    first words, with the number of all words last."""

    buckets: DataFrame
    bounds: DataFrame

    def lists(self, terms: DataFrame, positions: bool = True) -> DataFrame:
        """(term, block, n, positions: 32-bit numbers of the block's words, null if not asked for) of the distinct ``terms``."""
        wanted = terms.select("term").distinct().groupBy(_bucket(F.col("term")).alias("bucket")).agg(F.sort_array(F.collect_list("term")).alias("wanted"))

        def pick(batches):
            for batch in batches:
                term, at_block, n, found = [], [], [], []
                for wanted, block, terms, counts, gaps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    own, want = np.frombuffer(terms, "<u8"), np.array(wanted, np.int64).view(np.uint64)
                    at = np.minimum(np.searchsorted(own, want), len(own) - 1)
                    hit = own[at] == want
                    count = np.frombuffer(counts, "<u4").astype(np.int64)
                    term.append(want[hit].view(np.int64))
                    n.append(count[at[hit]])
                    at_block.append(np.full(int(hit.sum()), block))
                    if positions:
                        gap, ends = np.frombuffer(gaps, "<u4"), np.cumsum(count)
                        found += [np.cumsum(gap[ends[k] - count[k] : ends[k]]).astype("<u4").tobytes() for k in at[hit].tolist()]
                whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (term, at_block, n)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, whole), pa.array(found, pa.binary()) if positions else pa.nulls(len(whole[0]), pa.binary())], ["term", "block", "n", "positions"])

        gaps = F.col("gaps") if positions else F.lit(None).cast("binary").alias("gaps")
        return self.buckets.join(wanted, "bucket").select("wanted", "block", "terms", "counts", gaps).mapInArrow(pick, "term bigint, block bigint, n bigint, positions binary")


def _bucket(term):
    """The first bits of the hash."""
    return F.shiftrightunsigned(term, 64 - BUCKET_BITS).cast("int")


def build_index(docs: DataFrame, row: str, text_col: str) -> Index:
    """The index of ``docs``, whose ``row`` numbers are distinct; written to the shared folder, dealt by bucket and part of the blocks."""

    def run(batches):
        for batch in batches:
            rows = batch.column(0)
            for i, j, data, offsets in tx.parts(batch.column(1), BLOCK):
                hashes, first = hashed_words(data, offsets)
                order = np.argsort(hashes, kind="stable")
                by_term = hashes[order]
                new = np.ones(len(order), bool)
                new[1:] = by_term[1:] != by_term[:-1]
                gaps = np.where(new, order, np.diff(order, prepend=0)).astype("<u4")
                head = np.flatnonzero(new)
                counts = np.diff(np.append(head, len(order))).astype("<u4")
                terms = by_term[head].astype("<u8")
                bucket = (terms >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
                used, begin = np.unique(bucket, return_index=True)
                cuts, words = np.append(begin, len(terms)), np.append(head, len(order))
                parts = [
                    (int(b), terms[x:y].tobytes(), counts[x:y].tobytes(), gaps[words[x] : words[y]].tobytes(), None, None)
                    for b, x, y in zip(used.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                ]
                parts.append((None, None, None, None, rows.slice(i, j - i).to_pylist(), first.tolist()))
                block = rows[i].as_py()
                columns = [pa.array([p[k] for p in parts], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(parts), pa.int64()), *columns], ["block", "bucket", "terms", "counts", "gaps", "rows", "first"])

    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    made = docs.select(F.col(row).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "block bigint, bucket int, terms binary, counts binary, gaps binary, rows array<bigint>, first array<bigint>")
    # with a part of the blocks in the key, so that the bucket of a very common word is written by many tasks
    place = F.xxhash64("bucket", F.pmod(F.xxhash64("block"), F.lit(SHARES)))
    index = stage(made.withColumn("place", place).repartition("place").drop("place"), "index", "zstd")
    return Index(index.filter("bucket IS NOT NULL").select("bucket", "block", "terms", "counts", "gaps"), index.filter("bucket IS NULL").select("block", "rows", "first"))


def benchmark_windows(benchmark: DataFrame, length: int, item_col: str, text_col: str) -> DataFrame:
    """(wid, item, words, terms) of every window of every item, staged; null items are passed over."""

    def run(batches):
        for batch in batches:
            items, words, terms = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = words_of(text)
                hashes, _ = hashed_words(*tx.column(pa.array([text], pa.string())))
                for s in range(max(len(own) - length, 0) + 1 if own else 0):
                    items.append(item)
                    words.append(b" ".join(own[s : s + length]))
                    terms.append(hashes[s : s + length].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(words, pa.binary()), pa.array(terms, pa.list_(pa.int64()))], ["item", "words", "terms"])

    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).filter("item IS NOT NULL AND text IS NOT NULL")
    made = rows.mapInArrow(run, "item string, words binary, terms array<bigint>")
    return stage(made.select(F.monotonically_increasing_id().alias("wid"), "item", "words", "terms"), "windows")


def _ranked(index: Index, windows: DataFrame) -> DataFrame:
    """(wid, size, ends): each window's words as (n, off, term), the rarest in the documents first."""
    each = windows.select("wid", F.posexplode("terms").alias("off", "term"))
    often = index.lists(each, positions=False).groupBy("term").agg(F.sum("n").alias("n"))
    known = each.join(stage(often, "frequencies"), "term", "left").select("wid", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term").alias("end"))
    return stage(known.groupBy("wid").agg(F.count(F.lit(1)).alias("size"), F.array_sort(F.collect_list("end")).alias("ends")), "ranked")


def _documents(index: Index, found: DataFrame) -> DataFrame:
    """(row, wid, start, kind) of places (wid, block, start, size, kind) that lie in one document; start counts its words."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        if not right.num_rows or not left.num_rows:
            return pa.table({"row": pa.array(none), "wid": pa.array(none), "start": pa.array(none), "kind": pa.array([], pa.string())})
        rows, first = np.array(right.column("rows")[0].as_py(), np.int64), np.array(right.column("first")[0].as_py(), np.int64)
        start, size = left.column("start").to_numpy(), left.column("size").to_numpy()
        doc = np.searchsorted(first, start, "right") - 1
        inside = (start >= 0) & (start < first[-1])
        doc = np.clip(doc, 0, len(rows) - 1)
        exact = np.array(left.column("kind").to_pylist()) == "phrase"
        inside &= ~exact | (start + size <= first[doc + 1])
        keep = pa.array(np.flatnonzero(inside))
        return pa.table({"row": pa.array(rows[doc[inside]]), "wid": left.column("wid").take(keep), "start": pa.array((start - first[doc])[inside]), "kind": left.column("kind").take(keep)})

    return found.groupBy("block").cogroup(index.bounds.groupBy("block")).applyInArrow(run, "row bigint, wid bigint, start bigint, kind string")


def _exact_places(index: Index, ranked: DataFrame) -> DataFrame:
    """Places where a window's two rarest words stand at their distance; of a single word, where it stands."""
    able = ranked.filter("ends[0].n > 0").select("wid", "size", *[F.get("ends", F.lit(k))[c].alias(f"{c}{k}") for k in (0, 1) for c in ("off", "term")])
    lists = lambda k: index.lists(able.select(F.col(f"term{k}").alias("term")).filter("term IS NOT NULL")).select(F.col("term").alias(f"term{k}"), "block", F.col("positions").alias(f"p{k}"))
    one = able.join(lists(0), "term0")
    two = one.filter("size > 1").join(lists(1), ["term1", "block"])
    columns = ["wid", "size", "block", "off0", "p0", "off1", "p1"]
    both = two.select(*columns).unionAll(one.filter("size = 1").withColumn("p1", F.lit(None).cast("binary")).select(*columns))

    def meet(batches):
        for batch in batches:
            wid, size, block, off0, p0, off1, p1 = (batch.column(k).to_pylist() for k in range(7))
            starts = []
            for a, x, b, y in zip(off0, p0, off1, p1, strict=True):
                s = np.frombuffer(x, "<u4").astype(np.int64) - a
                starts.append(s if y is None else np.intersect1d(s, np.frombuffer(y, "<u4").astype(np.int64) - b, assume_unique=True))
            n = np.array([len(s) for s in starts], np.int64)
            repeat = lambda v: pa.array(np.repeat(np.array(v, np.int64), n))
            yield pa.RecordBatch.from_arrays([repeat(wid), repeat(size), repeat(block), pa.array(np.concatenate(starts) if starts else np.zeros(0, np.int64))], ["wid", "size", "block", "start"])

    return both.mapInArrow(meet, "wid bigint, size bigint, block bigint, start bigint").withColumn("kind", F.lit("phrase"))


def _near_places(index: Index, ranked: DataFrame, slop: int, missing: int) -> DataFrame:
    """Places within ``slop`` of where one of the missing + 1 rarest words puts the window: one of them must be there."""
    ends = ranked.select("wid", "size", F.explode(F.slice("ends", 1, missing + 1)).alias("end")).select("wid", "size", "end.off", "end.term")
    lists = ends.join(index.lists(ends), "term")

    def spread(batches):
        for batch in batches:
            wid, size, off, block, p = (batch.column(k).to_pylist() for k in range(5))
            starts = [np.unique(np.add.outer(np.frombuffer(x, "<u4").astype(np.int64) - a, np.arange(-slop, slop + 1))) for a, x in zip(off, p, strict=True)]
            n = np.array([len(s) for s in starts], np.int64)
            repeat = lambda v: pa.array(np.repeat(np.array(v, np.int64), n))
            yield pa.RecordBatch.from_arrays([repeat(wid), repeat(size), repeat(block), pa.array(np.concatenate(starts) if starts else np.zeros(0, np.int64))], ["wid", "size", "block", "start"])

    made = lists.select("wid", "size", "off", "block", "positions").mapInArrow(spread, "wid bigint, size bigint, block bigint, start bigint")
    return made.distinct().withColumn("kind", F.lit("proximity"))


def _candidates(keyed: DataFrame, benchmark: DataFrame, length: int, text_col: str, item_col: str, slop: int | None = None, missing: int = 0) -> DataFrame:
    """(__row, __found): for each document with any, the places to compare, as array<struct<start, kind, item, words>>, staged."""
    index = build_index(keyed, "__row", text_col)
    windows = benchmark_windows(benchmark, length, item_col, text_col)
    ranked = _ranked(index, windows)
    places = _exact_places(index, ranked)
    if slop is not None:
        places = places.unionByName(_near_places(index, ranked, slop, missing))
    found = _documents(index, places).join(windows.select("wid", "item", "words"), "wid")
    return stage(found.groupBy(F.col("row").alias("__row")).agg(F.collect_list(F.struct("start", "kind", "item", "words")).alias("__found")), "places")


def match_phrases(docs: DataFrame, benchmark: DataFrame, length: int = 13, slop: int | None = None, missing: int = 2, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(id_col, item_col, start, length, kind, n_terms) of each occurrence of a benchmark window in a document.

    kind is ``phrase`` for exact occurrences and, if ``slop`` is given, ``proximity`` for places where all but ``missing``
    words of a window of ``length`` lie within ``slop`` words of where the phrase has them. start counts words. Null texts
    and items match nothing; repeated rows match each.
    """
    keyed = stage(docs.select(id_col, text_col, F.monotonically_increasing_id().alias("__row")), "documents")
    found = keyed.join(_candidates(keyed, benchmark, length, text_col, item_col, slop, missing), "__row")
    doc_kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc", "item", "start", "length", "kind", "n_terms")}
            for doc, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = words_of(text)
                for p in places:
                    want, s = p["words"].split(b" "), p["start"]
                    if p["kind"] == "phrase":
                        n = len(want) if own[s : s + len(want)] == want else 0
                    else:
                        n = sum(w in own[max(0, s + k - slop) : max(0, s + k + slop + 1)] for k, w in enumerate(want))
                    if n >= len(want) - (0 if p["kind"] == "phrase" else missing) and n:
                        for k, v in zip(out, (doc, p["item"], s, len(want), p["kind"], n), strict=True):
                            out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (batch.column(0).type, pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()), strict=True)], list(out))

    made = found.select(id_col, text_col, "__found").mapInArrow(run, f"doc {doc_kind}, item string, start bigint, length bigint, kind string, n_terms bigint")
    return made.select(F.col("doc").alias(id_col), F.col("item").cast(item_kind).alias(item_col), "start", "length", "kind", "n_terms")


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = 13, per_hit: int = 20, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` with n_words, n_hit (long), items (array of the item ids with occurring windows, sorted as strings), contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated if n_hit > 0 and per_hit * n_hit >= n_words.
    Documents are staged with row numbers, indexed, and compared with the places that the index finds; nothing of the
    documents or the benchmark goes through the driver. Null and empty texts have no words; repeated rows are judged each;
    with an empty benchmark nothing is hit; columns of these names are replaced; null items are passed over.
    """
    added = ["n_words", "n_hit", "items", "contaminated"]
    docs = docs.drop(*added, "__row", "__found", "__hit")
    keyed = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "documents", "zstd")
    # the places grow with the documents: one plan at every size, without a broadcast that would do for small tables only
    places = _candidates(keyed, benchmark, length, text_col, item_col).hint("merge")
    joined = keyed.join(places, "__row", "left").select(*[F.col(f"`{c}`") for c in docs.columns], "__found")
    place, n_cols = docs.columns.index(text_col), len(docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType()))])

    def run(batches):
        for batch in batches:
            found = batch.column(n_cols)
            total, hits, items = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), [[] for _ in range(len(batch))]
            for i, j, data, offsets in tx.parts(batch.column(place)):
                total[i:j] = np.diff(tx.words(tx.LOWER[data], offsets, tx.NON_WORDS)[2])
            for r in np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False)).tolist():
                own = words_of(batch.column(place)[r].as_py())
                covered, names = np.zeros(len(own) + 1, np.int64), set()
                for p in found[r].as_py():
                    want, s = p["words"].split(b" "), p["start"]
                    if own[s : s + len(want)] == want:
                        covered[s] += 1
                        covered[s + len(want)] -= 1
                        names.add(p["item"])
                hits[r], items[r] = int((np.cumsum(covered) > 0).sum()), sorted(names)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_cols], pa.array(total), pa.array(hits), pa.array(items, pa.list_(pa.string()))], [*batch.schema.names[:n_cols], "n_words", "n_hit", "items"])

    out = joined.mapInArrow(run, schema)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (per_hit * F.col("n_hit") >= F.col("n_words"))).select(*[F.col(f"`{c}`") for c in docs.columns], *added)
