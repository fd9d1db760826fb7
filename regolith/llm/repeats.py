"""Runs of tokens that an earlier document holds too: routing of windows to shards, shared by two operators.

A window is ``length`` consecutive tokens (bytes or words) of one document. Each window has an anchor, the run of ``gram``
tokens in it with the smallest hash (the rightmost of equals), so equal windows have equal anchors, and consecutive windows
mostly have the same one. A segment is made of windows that share an anchor and a side: in some the anchor has at least half of what is
left of the window before it, in the others more than half after it, so all windows of a segment share those tokens too. Their hash (with
the anchor) is the segment's mark: what large corpora repeat by chance is some anchors, but hardly a mark. A first exchange moves
marks alone, some three bytes for many windows, and tells each block of documents
which of them occur in other places too; only the segments of those move in a second exchange to the operator's own
solver, by their anchor and both sides of one as one run, which tells where a window occurs first. Inside a block equal segments are sent once, with the first document
that has them, so what many documents share costs a shard a row for each block, not for each document. An anchor of very many
different segments (a passage's edge in a third of all documents) is split further: its windows go by their own hashes.
Texts that are a copy of an earlier document's whole text take no part, since all their windows are covered. What is sent is compressed (Zstandard).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from regolith.llm import text as tx
from regolith.session import checkpoint_dir, delete_on_exit, stage

#: Segments of one anchor, in the blocks that have a mark, from which its windows go to shards by their own hashes.
HOT = 4096
#: The same, if all blocks had as many of them as those with the mark have on average.
HOT_EVERYWHERE = 16 * HOT
#: Bytes of a mark that are sent, besides what its shard tells. A false match only sends a segment for nothing.
SENT = 4
#: In place of a shard: rows that tell a block which of its texts are copies.
COPIES = -1
#: Blocks that an input partition is dealt to.
SPLIT = 4


_ZSTD = pa.Codec("zstd", 3)


def pack(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def unpack(blob: bytes) -> bytes:
    return _ZSTD.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers of 32 bits, as the bytes of their differences, the highest of all first."""
    return pack(np.diff(values, prepend=values[:1] * 0).astype("<u4").view(np.uint8).reshape(-1, SENT).T[::-1].tobytes())


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(blob), np.uint8).reshape(SENT, -1)[::-1]
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint64)


class Tokens:
    """The tokens of a run of documents: hashes, bounds, and the bytes of any range of tokens."""

    def __init__(self, values, outside: np.ndarray | None):
        self.data, offsets = tx.column(values)
        self.data = self.data[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.bytes = outside is None
        if self.bytes:
            self.first = self.offsets
        else:
            starts, ends, first = [], [], [np.zeros(1, np.int64)]
            for i, j in tx.slices(self.offsets):
                a, b, f = tx.words(self.data[self.offsets[i] : self.offsets[j]], self.offsets[i : j + 1] - self.offsets[i], outside)
                starts.append(a + self.offsets[i])
                ends.append(b + self.offsets[i])
                first.append(f[1:] + first[-1][-1])
            self.starts = np.concatenate(starts or [np.zeros(0, np.int64)])
            self.ends = np.concatenate(ends or [np.zeros(0, np.int64)])
            self.first = np.concatenate(first)
            self.hashes = tx.word_hashes(self.data, self.starts, self.ends)

    def grams(self, size: int, seed: int, a: int, b: int) -> np.ndarray:
        """Hashes of the runs of ``size`` tokens that lie in the tokens a .. b - 1."""
        return tx.byte_windows(self.data[a:b], size, seed) if self.bytes else tx.windows(self.hashes[a:b], size, seed)

    def runs(self, begin: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the runs of ``size`` tokens from ``begin``, which ascends."""
        if self.bytes:
            return tx.word_hashes(self.data, begin, begin + size)
        total = np.zeros(len(begin), tx.U64)
        for k, c in enumerate(tx.constants(size, 47)):
            total += self.hashes[begin + k] * c
        return tx.mix(total + tx.U64(size))

    def text(self, a: int, b: int) -> bytes:
        """Bytes of the tokens a .. b - 1, words joined by single spaces."""
        if self.bytes:
            return self.data[a:b].tobytes()
        return b" ".join([self.data[x:y].tobytes() for x, y in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True)])


def segments(tokens: Tokens, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, mark, first window, number of windows) of all segments, in the order of the tokens."""
    anchors, marks, begins, counts = [], [], [], []
    first = tokens.first
    width = length - gram + 1
    before = width // 2  # tokens before the anchor that windows of the one side share; those of the other share the rest after it, and one more
    for i, j in tx.slices(first):
        a, b = int(first[i]), int(first[j])
        if b - a < length:
            continue
        keys = tokens.grams(gram, 5, a, b)
        n = b - a - length + 1
        # sliding minimum with the rightmost of equals: keep the place in the low bits of what is compared
        low = 1 << 21
        if len(keys) < low:
            packed = (keys & ~tx.U64(low - 1)) | (tx.U64(low - 1) - np.arange(len(keys), dtype=tx.U64))
            least, span = packed, 1
            while span < width:
                step = min(span, width - span)
                least = np.minimum(least[: len(least) - step], least[step:])
                span += step
            place = (low - 1 - (least & tx.U64(low - 1)).astype(np.int64))[:n]
        else:
            place = _slow_minimum(keys, width)[:n]
        start = np.arange(n)
        doc_end = np.repeat(first[i + 1 : j + 1] - a, np.diff(first[i : j + 1]))[:n]
        valid = start + length <= doc_end
        new = np.ones(n, bool)
        early = place - start >= before
        new[1:] = (place[1:] != place[:-1]) | (early[1:] != early[:-1]) | ~valid[:-1]
        new &= valid
        head = np.flatnonzero(new)
        if not len(head):
            continue
        stop = np.flatnonzero(valid & np.concatenate([new[1:] | ~valid[1:], [True]]))
        at, side = place[head], early[head]
        anchors.append(tx.mix(keys[at]))
        mark = np.empty(len(head), tx.U64)
        mark[side] = tokens.runs(at[side] + a - before, before + gram)
        mark[~side] = tokens.runs(at[~side] + a, length - before + 1)
        marks.append(tx.mix(mark ^ tx.mix(side.astype(tx.U64))))
        begins.append(head + a)
        counts.append(stop - head + 1)
    if not anchors:
        return np.zeros(0, tx.U64), np.zeros(0, tx.U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(anchors), np.concatenate(marks), np.concatenate(begins), np.concatenate(counts)


def _slow_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """The same for a document of millions of tokens, in overlapping parts."""
    out, step, low = [], (1 << 21) - width - 1, 1 << 21
    for a in range(0, len(keys) - width + 1, step):
        part = keys[a : a + step + width - 1]
        packed = (part & ~tx.U64(low - 1)) | (tx.U64(low - 1) - np.arange(len(part), dtype=tx.U64))
        least, span = packed, 1
        while span < width:
            move = min(span, width - span)
            least = np.minimum(least[: len(least) - move], least[move:])
            span += move
        out.append(low - 1 - (least & tx.U64(low - 1)).astype(np.int64) + a)
    return np.concatenate(out)


class Block:
    """One block of documents, in the order of their ids, with its distinct segments."""

    def __init__(self, table: pa.Table, outside: np.ndarray | None, length: int, gram: int, text: str):
        self.table = table
        self.tokens = Tokens(table.column(text), outside)
        self.anchor, self.mark, self.begin, self.count = segments(self.tokens, length, gram)
        self.row = np.searchsorted(self.tokens.first, self.begin, "right") - 1
        self.length = length
        self.unique, self.at = np.unique(self.mark, return_inverse=True)

    def _hash(self, begin: np.ndarray, size: int) -> np.ndarray:
        values = np.zeros(len(begin), tx.U64)
        if self.tokens.bytes:
            up, _ = tx.powers(size)
            for k in range(size):
                values += tx._BYTE[self.tokens.data[begin + k]] * up[k]
        else:
            for k, c in enumerate(tx.constants(size, 31)):
                values += self.tokens.hashes[begin + k] * c
        return tx.mix(values + tx.U64(size))

    def runs(self, seen: bytes, split: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first window, number of windows, row, shard key) of what is sent, given bits for the distinct marks: seen elsewhere, split."""
        n = len(self.unique)
        shared = np.unpackbits(np.frombuffer(seen, np.uint8), count=n).astype(bool)[self.at]
        single = np.unpackbits(np.frombuffer(split, np.uint8), count=n).astype(bool)[self.at]
        whole = np.flatnonzero(shared & ~single)
        one = np.flatnonzero(shared & single)
        which, window = tx.repeat_ranges(self.begin[one], self.count[one])
        end = self.begin[whole] + self.count[whole]
        new = np.ones(len(whole), bool)  # both sides of an anchor are one run
        new[1:] = (self.begin[whole][1:] != end[:-1]) | (self.anchor[whole][1:] != self.anchor[whole][:-1]) | (self.row[whole][1:] != self.row[whole][:-1])
        head = np.flatnonzero(new)
        own = whole[head]
        begin = np.concatenate([self.begin[own], window])
        count = np.concatenate([end[np.append(head[1:], len(whole))[: len(head)] - 1] - self.begin[own], np.ones(len(window), np.int64)])
        row = np.concatenate([self.row[own], self.row[one][which]])
        key = np.concatenate([self.anchor[own], self._hash(window, self.length)])
        return begin, count, row, key


def kinds(block: Block, begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each kind, kind of each) of runs of windows with the same tokens."""
    key = np.empty(len(begin), tx.U64)
    for size in np.unique(count).tolist():
        own = np.flatnonzero(count == size)
        key[own] = block._hash(begin[own], size + block.length - 1)
    _, first, kind = np.unique(key, return_index=True, return_inverse=True)
    return first, kind.ravel()


Solver = Callable[[list[bytes], np.ndarray, np.ndarray], list[tuple[int, int, int, int]]]


def removed_runs(docs: DataFrame, length: int, gram: int, outside: np.ndarray | None, solve: Solver, finish: Callable, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row of ``docs``: what ``finish(text as bytes, Tokens, row, covered)`` returns after the id, where
    ``covered`` marks the tokens under a window that also starts in a document with a smaller id.

    ``solve(texts, windows, documents)`` gets a shard's distinct segments (their bytes, numbers of windows and first documents) and
    returns (segment, window from, window to, first document with it) for windows in more than one segment.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    order = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    whole = docs.select(F.col(id_col).alias("doc"), order.alias("ord"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    shards = max(1, whole.rdd.getNumPartitions()) * SPLIT
    name = f"blocks_{uuid.uuid4().hex}"
    place = F.spark_partition_id() * SPLIT + F.pmod(F.xxhash64("ord", F.length("text")), F.lit(SPLIT)).cast("int")
    whole.withColumn("block", place).write.bucketBy(shards, "block").option("compression", "zstd").option("path", f"{checkpoint_dir(spark)}/{name}").saveAsTable(name)
    delete_on_exit(spark, f"{checkpoint_dir(spark)}/{name}")
    blocks = spark.table(name)
    same = blocks.groupBy("digest").agg(F.min("ord").alias("first"), F.max("ord").alias("last"), F.collect_set("block").alias("blocks")).filter("first < last")
    copies = stage(same.select(F.explode("blocks").alias("block"), F.lit(COPIES).alias("shard"), F.col("digest").alias("a"), F.col("first").cast("string").cast("binary").alias("b"), F.lit(None).cast("binary").alias("c")), "copies")

    def block_of(table: pa.Table, answers: pa.Table) -> tuple[Block, pa.Table]:
        """The block without copies of earlier texts, and the rows of these."""
        told = answers.filter(pc.equal(answers.column("shard"), COPIES))
        first = {a: int(b) for a, b in zip(told.column("a").to_pylist(), told.column("b").to_pylist(), strict=True)}
        table = table.sort_by([("ord", "ascending")])
        later = pa.array([first.get(d, o) < o for d, o in zip(table.column("digest").to_pylist(), table.column("ord").to_pylist(), strict=True)], pa.bool_())
        return Block(table.filter(pc.invert(later)), outside, length, gram, "text"), table.filter(later)

    def send_anchors(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return empty_anchors
        block, _ = block_of(table, answers)
        shard = (block.unique % tx.U64(shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[by], np.arange(shards + 1))
        several = np.zeros(len(block.unique), bool)
        if len(block.unique):
            lowest, highest = np.full(len(block.unique), (1 << 63) - 1), np.full(len(block.unique), -(1 << 63))
            order = block.table.column("ord").to_numpy()[block.row]
            np.minimum.at(lowest, block.at, order)
            np.maximum.at(highest, block.at, order)
            several = lowest < highest
        _, anchor, times = np.unique(block.anchor, return_inverse=True, return_counts=True)
        doublings = np.zeros(len(block.unique), np.uint8)
        doublings[block.at] = np.ceil(np.log2(times[anchor] + 1)).astype(np.uint8)
        sent = block.unique >> tx.U64(64 - 8 * SENT)
        out = [(s, by[cuts[s] : cuts[s + 1]]) for s in range(shards) if cuts[s + 1] > cuts[s]]
        number = table.column("block")[0].as_py()
        return pa.table({
            "shard": pa.array([s for s, _ in out], pa.int32()), "block": pa.array([number] * len(out), pa.int32()),
            "anchors": pa.array([pack_sorted(sent[x]) for _, x in out], pa.binary()),
            "several": pa.array([pack(np.packbits(several[x]).tobytes()) for _, x in out], pa.binary()),
            "many": pa.array([pack(doublings[x].tobytes()) for _, x in out], pa.binary()),
        })

    empty_anchors = pa.table({"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in ("anchors", "several", "many")}})

    def judge_anchors(table: pa.Table) -> pa.Table:
        anchors = [unpack_sorted(x) for x in table.column("anchors").to_pylist()]
        _, place, count = np.unique(np.concatenate(anchors), return_inverse=True, return_counts=True)
        several = np.concatenate([np.unpackbits(np.frombuffer(unpack(x), np.uint8), count=len(a)) for x, a in zip(table.column("several").to_pylist(), anchors, strict=True)])
        seen = count > 1
        np.logical_or.at(seen, place, several.astype(bool))
        doublings = np.frombuffer(b"".join([unpack(x) for x in table.column("many").to_pylist()]), np.uint8)
        many = np.bincount(place, np.exp2(doublings) - 1, len(count))
        hot = (many > HOT) | (many / count * shards > HOT_EVERYWHERE)
        cuts = np.cumsum([0] + [len(a) for a in anchors])
        bits = lambda x: [pack(np.packbits(x[place[a:b]]).tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table({"block": table.column("block"), "shard": table.column("shard"), "a": pa.array(bits(seen), pa.binary()), "b": pa.array(bits(hot), pa.binary()), "c": pa.array([None] * len(anchors), pa.binary())})

    def bits_of(block: Block, answers: pa.Table) -> tuple[bytes, bytes]:
        shard = (block.unique % tx.U64(shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[by], np.arange(shards + 1))
        out = np.zeros((2, len(by)), bool)
        answers = answers.filter(pc.and_(pc.is_valid(answers.column("a")), pc.not_equal(answers.column("shard"), COPIES)))
        for s, a, b in zip(*(answers.column(c).to_pylist() for c in ("shard", "a", "b")), strict=True):
            own = by[cuts[s] : cuts[s + 1]]
            out[0, own] = np.unpackbits(np.frombuffer(unpack(a), np.uint8), count=len(own))
            out[1, own] = np.unpackbits(np.frombuffer(unpack(b), np.uint8), count=len(own))
        return np.packbits(out[0]).tobytes(), np.packbits(out[1]).tobytes()

    def placed(block: Block, answers: pa.Table):
        begin, count, row, key = block.runs(*bits_of(block, answers))
        first, kind_of = kinds(block, begin, count)
        shard = (key[first] % tx.U64(shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        return begin, count, row, first, kind_of, by, np.searchsorted(shard[by], np.arange(shards + 1))

    def send_segments(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return empty_segments
        block, _ = block_of(table, answers)
        begin, count, row, first, _, by, cuts = placed(block, answers)
        order = block.table.column("ord").to_numpy()
        used = [s for s in range(shards) if cuts[s + 1] > cuts[s]]
        texts, sizes, numbers, lens = [], [], [], []
        for s in used:
            own = first[by[cuts[s] : cuts[s + 1]]]
            parts = [block.tokens.text(b, b + c + length - 1) for b, c in zip(begin[own].tolist(), count[own].tolist(), strict=True)]
            texts.append(pack(b"".join(parts)))
            lens.append(pack(np.array([len(p) for p in parts], np.int32).tobytes()))
            sizes.append(pack(count[own].astype(np.int32).tobytes()))
            numbers.append(pack(order[row[own]].astype(np.int64).tobytes()))
        number = table.column("block")[0].as_py()
        return pa.table({
            "shard": pa.array(used, pa.int32()), "block": pa.array([number] * len(used), pa.int32()), "texts": pa.array(texts, pa.binary()),
            "lens": pa.array(lens, pa.binary()), "sizes": pa.array(sizes, pa.binary()), "docs": pa.array(numbers, pa.binary()),
        })

    empty_segments = pa.table({"shard": pa.array([], pa.int32()), "block": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in ("texts", "lens", "sizes", "docs")}})

    def judge_segments(table: pa.Table) -> pa.Table:
        texts, owner = [], []
        for k, (blob, lens) in enumerate(zip(table.column("texts").to_pylist(), table.column("lens").to_pylist(), strict=True)):
            ends, blob = np.cumsum(np.frombuffer(unpack(lens), np.int32)).tolist(), unpack(blob)
            texts += [blob[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            owner.append(np.full(len(ends), k))
        sizes = np.concatenate([np.frombuffer(unpack(x), np.int32) for x in table.column("sizes").to_pylist()]).astype(np.int64)
        order = np.concatenate([np.frombuffer(unpack(x), np.int64) for x in table.column("docs").to_pylist()])
        owner = np.concatenate(owner)
        number: dict[bytes, int] = {}
        kind_of = np.array([number.setdefault(x, len(number)) for x in texts], np.int64)
        least = np.full(len(number), (1 << 63) - 1)
        np.minimum.at(least, kind_of, order)
        size_of = np.zeros(len(number), np.int64)
        size_of[kind_of] = sizes
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, a, b, d in solve(list(number), size_of, least):
            found.setdefault(k, []).append((a, b, d))
        inside = np.arange(len(owner)) - np.searchsorted(owner, owner)
        answers: list[list[tuple[int, int, int, int]]] = [[] for _ in range(table.num_rows)]
        for o, i, k, own in zip(owner.tolist(), inside.tolist(), kind_of.tolist(), order.tolist(), strict=True):
            if k in found:
                answers[o] += [(i, a, b, d) for a, b, d in found[k]]
            elif least[k] < own:
                answers[o].append((i, 0, int(size_of[k]), int(least[k])))
        blobs = [pack(np.array(x, np.int64).reshape(-1, 4).T.tobytes()) for x in answers]
        none = pa.array([None] * table.num_rows, pa.binary())
        return pa.table({"block": table.column("block"), "shard": table.column("shard"), "a": none, "b": none, "c": pa.array(blobs, pa.binary())})

    def conclude(table: pa.Table, answers: pa.Table) -> pa.Table:
        out_schema = conclude_schema
        if not table.num_rows:
            return out_schema.empty_table()
        block, later = block_of(table, answers)
        begin, count, row, first, kind_of, by, cuts = placed(block, answers)
        order = block.table.column("ord").to_numpy()
        tokens = block.tokens
        hits = np.zeros(int(tokens.first[-1]) + 1, np.int16 if len(begin) < 1 << 14 else np.int32)
        pieces = [np.zeros((0, 4), np.int64)]
        told = answers.filter(pc.is_valid(answers.column("c")))
        for s, blob in zip(told.column("shard").to_pylist(), told.column("c").to_pylist(), strict=True):
            x = np.frombuffer(unpack(blob), np.int64).reshape(4, -1).T.copy()
            x[:, 0] = by[cuts[s] : cuts[s + 1]][x[:, 0]]
            pieces.append(x)
        told = np.concatenate(pieces)
        silent = np.setdiff1d(np.arange(len(first)), told[:, 0])  # the first document with these is the block's own
        told = np.concatenate([told, np.stack([silent, np.zeros(len(silent), np.int64), count[first[silent]], order[row[first[silent]]]], axis=1)])
        told = told[np.argsort(told[:, 0], kind="stable")]
        low = np.searchsorted(told[:, 0], kind_of)
        which, at = tx.repeat_ranges(low, np.searchsorted(told[:, 0], kind_of, "right") - low)
        over = order[row[which]] > told[at, 3]
        which, at = which[over], at[over]
        np.add.at(hits, begin[which] + told[at, 1], 1)
        np.add.at(hits, begin[which] + told[at, 2] + length - 1, -1)
        covered = np.cumsum(hits[:-1]) > 0
        rows = [finish(tokens, int(a), int(b), covered[a:b]) for a, b in zip(tokens.first[:-1].tolist(), tokens.first[1:].tolist(), strict=True)]
        copy = Tokens(later.column("text"), outside)
        rows += [finish(copy, int(a), int(b), np.full(b - a, b - a >= length)) for a, b in zip(copy.first[:-1].tolist(), copy.first[1:].tolist(), strict=True)]
        return pa.Table.from_arrays([pa.chunked_array([*block.table.column("doc").chunks, *later.column("doc").chunks], later.schema.field("doc").type), *[pa.array([r[k] for r in rows], out_schema.types[k + 1]) for k in range(len(out_schema) - 1)]], schema=out_schema)

    full = T.StructType.fromDDL(f"`{id_col}` {kind}, {schema}")
    conclude_schema = to_arrow_schema(full)
    answer = "block int, shard int, a binary, b binary, c binary"
    anchors = blocks.groupBy("block").cogroup(copies.groupBy("block")).applyInArrow(send_anchors, "shard int, block int, anchors binary, several binary, many binary")
    shared = copies.union(stage(anchors.groupBy("shard").applyInArrow(judge_anchors, answer), "anchors"))
    sent = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(send_segments, "shard int, block int, texts binary, lens binary, sizes binary, docs binary")
    judged = sent.groupBy("shard").applyInArrow(judge_segments, answer)
    return blocks.groupBy("block").cogroup(shared.union(judged).groupBy("block")).applyInArrow(conclude, full)

