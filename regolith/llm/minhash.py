"""Near-duplicate documents: MinHash signatures, banding, verification and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regolith.llm import text as tx
from regolith.operators.graph import connected_components
from regolith.session import stage

#: Universal hash functions, in bands of ROWS. At a similarity of 0.85 a pair is missed with probability 4e-7, at 0.8 with 5e-5.
HASHES, ROWS = 125, 5
#: Members of a bucket whose pairs are formed at once; a larger one is resolved around pivots.
SMALL = 12
#: By how much that number grows in each round: pivots have then parted the groups that are large by many copies.
GROWTH = 8
#: Rounds at most: buckets of SMALL * GROWTH ** ROUNDS classes are beyond any table.
ROUNDS = 24
#: Standard errors below the limit at which a signature still passes to the full comparison.
SLACK = 5.0

_A, _B = tx.constants(HASHES, 77), tx.constants(HASHES, 78)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Each document's sorted distinct shingles of ``size`` words as 64-bit hashes; of fewer words, the whole sequence."""
    data = tx.LOWER[data]
    starts, ends, first = tx.words(data, offsets, tx.SPACES)
    hashes = tx.word_hashes(data, starts, ends)
    grams = tx.windows(hashes, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        else:
            out.append(tx.windows(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper halves of the minima of HASHES universal functions."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        least = np.minimum(least, (np.multiply.outer(shingles[i : i + 1024], _A) + _B).min(axis=0))
    return (least >> np.uint64(32)).astype("<u4")


def features(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, n, key, sig) of every row; rows with the same key have the same shingle set."""

    def run(batches):
        from hashlib import blake2b

        for batch in batches:
            for i, j, data, offsets in tx.parts(batch.column(1)):
                sets = shingle_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([blake2b(s, digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc", "n", "key", "sig"],
                )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc bigint, n bigint, key binary, sig binary")


def band_keys(reps: DataFrame) -> DataFrame:
    """(bucket, doc): a row for each band of each signature."""

    def run(batches):
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(n, HASHES).astype(np.uint64)
            bands = HASHES // ROWS
            keys = np.stack([tx.windows(np.ascontiguousarray(sig[:, b * ROWS : b * ROWS + ROWS]).ravel(), ROWS, b)[::ROWS] for b in range(bands)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), batch.column(0).take(pa.array(np.repeat(np.arange(n), bands)))], ["bucket", "doc"])

    return reps.select("doc", "sig").mapInArrow(run, "bucket bigint, doc bigint")


def verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, pivot, linked, lacks, adds, whole) of pairs (a, b, pivot): signatures first, then full shingle sets.

    Where one of the two is named as pivot, ``adds`` has the other's shingles that the pivot lacks, ``lacks`` is the number
    of the pivot's that the other lacks, and ``whole`` the pivot's number.
    """
    left = texts.select(F.col("doc").alias("a"), F.col("text").alias("ta"), F.col("sig").alias("sa"))
    right = texts.select(F.col("doc").alias("b"), F.col("text").alias("tb"), F.col("sig").alias("sb"))
    limit = percent / 100
    least = limit - SLACK * (limit * (1 - limit) / HASHES) ** 0.5

    def run(batches):
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            a, b, pivot = (batch.column(k).to_pylist() for k in range(3))
            if not a:
                continue
            sa, sb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u4").reshape(len(a), HASHES) for k in (5, 6))
            asked = np.array([p is not None for p in pivot])
            likely = np.flatnonzero(((sa == sb).mean(axis=1) >= least) | asked)
            linked = np.zeros(len(a), bool)
            lacks, whole = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
            adds: list[np.ndarray | None] = [None] * len(a)
            if sum(map(len, known.values())) > 4_000_000:
                known.clear()
            for ids, k in ((a, 3), (b, 4)):
                rows = {ids[r]: int(r) for r in likely.tolist() if ids[r] not in known}
                if rows:
                    for i, j, data, offsets in tx.parts(batch.column(k).take(pa.array(list(rows.values())))):
                        known.update(zip(list(rows)[i:j], shingle_sets(data, offsets, size), strict=True))
            for r in likely.tolist():
                x, y = known[a[r]], known[b[r]]
                if asked[r]:
                    if pivot[r] == a[r]:
                        x, y = y, x
                    new = np.setdiff1d(x, y, assume_unique=True)
                    both = len(x) - len(new)
                    adds[r], lacks[r], whole[r] = new.view(np.int64), len(y) - both, len(y)
                else:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                linked[r] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(linked), pa.array(lacks), pa.array(adds, pa.list_(pa.int64())), pa.array(whole)], ["a", "b", "pivot", "linked", "lacks", "adds", "whole"])

    full = pairs.join(left, "a").join(right, "b").select("a", "b", "pivot", "ta", "tb", "sa", "sb")
    return full.mapInArrow(run, "a bigint, b bigint, pivot bigint, linked boolean, lacks bigint, adds array<bigint>, whole bigint")


def _groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc, n, key, component, links) of every row of ``docs`` (row, text), whose row keys are distinct and not null; doc is the row key.

    Documents are linked when 100 * intersection >= percent * union of their sets of ``size``-word shingles; a component
    is all that links reach, named by its smallest row key. Copies of one set are one class from the
    start, so a group of exact copies costs one row per band. Pairs inside a bucket of at most SMALL classes are all
    compared. A larger bucket is compared with a pivot, the member with the fullest buckets. Two members that the pivot's
    links don't join can only be linked if they share enough shingles that the pivot lacks (found by their rarest ones), or
    if the numbers of shingles that they lack and add allow it (see ``_compatible``): such groups are the next round's buckets, if they hold several
    components. Each is smaller, as its pivot has left, and in groups of edited copies hardly any are left after the first
    round. No bucket is capped. Where later rounds leave a group open, its pairs from different components are all compared if it has no more than
    SMALL * GROWTH ** round classes; so rounds end after the logarithm of the largest bucket, and more than ROUNDS are an error.
    """
    rows = stage(features(docs, size, "row", "text"), "shingles")
    sets = rows.filter("key IS NOT NULL")
    classes = sets.groupBy("key").agg(F.min("doc").alias("rep"))
    reps = sets.join(classes, (sets["key"] == classes["key"]) & (sets["doc"] == F.col("rep"))).select("doc", "sig")
    buckets = stage(band_keys(reps), "bands")
    sizes = stage(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes")
    members = stage(buckets.join(sizes, "bucket"), "members")

    wanted = members.select("doc").distinct()
    signed = reps.join(wanted, "doc", "left_semi")
    texts = docs.select(F.col("row").alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = stage(texts.join(signed, "doc"), "candidates")

    pairs = _pairs(members.filter(F.col("size") <= SMALL))
    weight = members.groupBy("doc").agg(F.sum("size").alias("weight"))
    state = members.filter(F.col("size") > SMALL).select("bucket", "doc")
    links, whole, small = None, None, SMALL
    for _ in range(ROUNDS):
        pivots = stage(state.join(weight, "doc").groupBy("bucket").agg(F.max_by("doc", F.struct("weight", -F.col("doc"))).alias("pivot")), "pivots")
        spokes = state.join(pivots, "bucket").filter("doc <> pivot").select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b"), "pivot")
        asked = spokes.union(pairs.select("a", "b", F.lit(None).cast("long").alias("pivot"))).distinct()
        found = stage(verify(asked, texts, size, percent), "verified")
        fresh = found.filter("linked").select("a", "b")
        links = fresh if links is None else links.union(fresh)
        whole = _merged(whole, fresh)
        spokes = found.filter("pivot IS NOT NULL")
        if spokes.isEmpty():
            break
        members = stage(_unresolved(spokes, whole, percent), "members")
        if members.isEmpty():
            break
        small *= GROWTH
        pairs = _pairs(members.filter(F.col("size") <= small), "component")
        state = members.filter(F.col("size") > small).select("bucket", "doc")
    else:
        raise RuntimeError(f"near duplicates did not settle in {ROUNDS} rounds")
    degree = links.distinct().select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    named = classes.join(whole, F.col("rep") == whole["id"], "left").drop("id").join(degree, F.col("rep") == degree["id"], "left")
    named = named.select("key", F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0).cast("long")).alias("links"))
    # one row for each class in a table of its own: Spark knows its size, and splits the many copies of a class in the join
    out = rows.join(stage(named, "classes"), "key", "left")
    return out.select("doc", "n", "key", F.coalesce("component", "doc").alias("component"), F.coalesce("links", F.lit(0).cast("long")).alias("links"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id_col, n_shingles, component_id, kept, n_links.

    Components are those of ``_groups``, named by their smallest id, and that document is kept. n_links counts the classes
    of other sets found linked to the row's class. A null or empty text has no shingles and is linked with nothing; a null
    id has a null component, but its text links others; repeated ids give a row each, and each of their texts is linked;
    an empty table gives no rows.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed = stage(keyed.withColumn("row", F.monotonically_increasing_id()), "rows")
    groups = stage(_groups(keyed.select("row", "text"), size, percent), "groups").join(keyed.select(F.col("row").alias("doc"), "id"), "doc")
    names = stage(groups.groupBy("component").agg(F.min("id").alias("least")), "names")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("least")))
    out = groups.join(names, "component").select("id", "n", component.alias("name"), "links")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("name").alias("component_id"), (F.col("id") == F.col("name")).alias("kept"), F.col("links").alias("n_links"))


def first_rows(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of ``_groups``: that with the smallest id, nulls last, then the first in order.

    Rows are told apart by a key of their own, so repeated ids are copies like others, and a row without an id is kept if
    it is linked with nothing or all its component has none. A null or empty text is linked with nothing and always kept.
    """
    keyed = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = _groups(keyed.select(F.col("__row").alias("row"), F.col(text_col).alias("text")), size, percent)
    ids = keyed.select(F.col("__row").alias("doc"), F.col(id_col).alias("id"))
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("doc"))
    kept = groups.join(ids, "doc").groupBy("component").agg(F.min_by("doc", order).alias("__row")).select("__row")
    return keyed.join(kept, "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def _pairs(members: DataFrame, apart: str | None = None) -> DataFrame:
    """All pairs (a, b) inside small buckets, repeated where buckets share them, of different ``apart`` if given."""
    pairs = members.alias("x").join(members.alias("y"), "bucket").filter("x.doc < y.doc")
    if apart:
        pairs = pairs.filter(F.col(f"x.{apart}") != F.col(f"y.{apart}"))
    return pairs.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"))


def _merged(whole: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, component) of all links so far: earlier components are single vertices to ``links``, so little is left of them."""
    if whole is None:
        return stage(connected_components(links, "a", "b"), "components")
    name = whole.select(F.col("id").alias("a"), F.col("component").alias("ca")), whole.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    across = links.join(name[0], "a", "left").join(name[1], "b", "left").select(F.coalesce("ca", "a").alias("src"), F.coalesce("cb", "b").alias("dst"))
    across = stage(across.filter("src <> dst").distinct(), "across")
    if across.isEmpty():
        return whole
    moved = stage(connected_components(across), "moved")
    known = whole.join(moved.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return stage(known.union(moved.join(whole, "id", "left_anti")), "components")


def _compatible(percent: int):
    """Whether x and y could be linked without sharing a shingle that the pivot lacks, judged by counts.

    Of the pivot's shingles, x and y have at most whole - max(lacks) in common; their union then has at least
    whole - min(lacks) + adds of both.
    """
    most = F.col("x.whole") - F.greatest("x.lacks", "y.lacks")
    return 100 * most >= percent * (F.col("x.whole") - F.least("x.lacks", "y.lacks") + F.col("x.added") + F.col("y.added"))


def _unresolved(spokes: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """(bucket, doc, component, size): the groups around each pivot that may still hold links between components."""
    doc = F.when(F.col("pivot") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    known = spokes.select("pivot", doc.alias("doc"), "linked", "whole", "lacks", "adds", F.size("adds").alias("added"))
    known = known.join(whole, F.col("doc") == F.col("id"), "left").withColumn("component", F.coalesce("component", "doc")).drop("id")
    known = stage(known, "spokes")

    # a pair that needs t common added shingles has one among each side's added - t + 1 rarest (in one order for all)
    needed = F.greatest(F.ceil((F.col("added") + F.col("whole") - F.col("lacks")) * percent / 100) - (F.col("whole") - F.col("lacks")), F.lit(1))
    each = known.select("pivot", "doc", "component", (F.col("added") - needed + 1).alias("prefix"), F.explode("adds").alias("add"))
    often = each.groupBy("pivot", "add").agg(F.count(F.lit(1)).alias("often"))
    place = F.row_number().over(Window.partitionBy("pivot", "doc").orderBy("often", "add"))
    sharing = each.join(often, ["pivot", "add"]).withColumn("place", place).filter("place <= prefix AND often > 1")
    sharing = sharing.select(F.xxhash64("pivot", "add").alias("bucket"), "doc", "component")
    classes = known.groupBy("pivot", "whole", "lacks", "added").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count_if(~F.col("linked")).alias("odd"))
    fits = classes.filter("odd > 0").alias("x").join(classes.alias("y"), "pivot").filter(_compatible(percent) & F.expr("NOT (x.c0 = x.c1 AND y.c0 = y.c1 AND x.c0 = y.c0)"))
    both = F.explode(F.array(F.struct("x.lacks", "x.added"), F.struct("y.lacks", "y.added"))).alias("k")
    fits = fits.select("pivot", both).select("pivot", "k.lacks", "k.added").distinct()
    counted = known.join(fits, ["pivot", "lacks", "added"]).select(F.xxhash64("pivot", F.lit("counts")).alias("bucket"), "doc", "component")
    groups = sharing.union(counted)
    open_groups = groups.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 <> c1")
    return groups.join(open_groups.select("bucket", "size"), "bucket").select("bucket", "doc", "component", "size")
