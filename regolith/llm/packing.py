"""Mixture-controlled packing of token sequences by deficit round-robin over source queues."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regolith.llm import text as tx
from regolith.operators.windows import global_rank
from regolith.session import stage

#: Sources at most: each is one number on the driver and in the tasks. With more, ``pack`` raises.
MAX_SOURCES = 10_000_000
#: How byte-level BPE splits texts (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """ids of texts as the ``tokenizers`` library makes them from its JSON file.

    For a byte-level BPE the same file is also loaded into ``tiktoken``, which is several times as fast, if ``agrees`` has
    shown that both give the same ids for every text. A text that holds an added token's content, or that the faster
    library refuses, is left to ``tokenizers``.
    """

    def __init__(self, path: str, fast: bool):
        import json

        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.fast = self._ranked(path) if fast else None
        with open(path, encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f).get("added_tokens", ())]

    @staticmethod
    def agrees(path: str) -> bool:
        """Whether merging any two neighbours whose joint bytes are a token, lowest number first, is what the merges do.

        It is if every token has one merge, merges are numbered in their order, and the bytes of each token alone become
        that token. Say the two ways part at neighbours a, b that form token t other than by its merge: no merge below t's is
        open between the borders of a and b, and none has crossed them, so a and b are what those merges make of
        t's bytes alone. But alone they end in t, so its merge must be (a, b). How texts are split before is
        compared by a test over all code points.
        """
        from tokenizers import Tokenizer

        ranked = Encoder._ranked(path)
        if ranked is None:
            return False
        alone = Tokenizer.from_file(path).model
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        return all([x.id for x in alone.tokenize(t)] == [i] for t, i in spec["model"]["vocab"].items() if t not in special)

    @staticmethod
    def _ranked(path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer") and not model.get("dropout")
        if not plain:
            return None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level BPE writes as themselves
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        numbers = [model["vocab"][a + b] for a, b in pairs]
        if numbers != sorted(set(numbers)) or any(i > numbers[0] for t, i in ranks.items() if len(t) == 1):
            return None
        return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _sure(self, text: str) -> list[int]:
        return self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or any(x in text for x in self.added):
            return self._sure(text)
        try:
            ids = self.fast.encode_ordinary(text)
        except BaseException as refused:  # its panics aren't Exceptions
            if isinstance(refused, (KeyboardInterrupt, SystemExit)):
                raise
            return self._sure(text)
        return ids


def tokenize(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, group_col: str, end_id: int) -> DataFrame:
    """(doc, source, ids, n, block, inside) for every row; ids are stored in two bytes where the vocabulary allows.

    A block is an input partition; ``inside`` is the number of tokens of the same source before the row in its block.
    """
    fast = Encoder.agrees(tokenizer)

    def run(batches):
        from pyspark import TaskContext

        encode = Encoder(tokenizer, fast)
        block = TaskContext.get().partitionId()
        small = encode.model.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        sums: dict = {}
        for batch in batches:
            offsets = tx.column(batch.column(1))[1]
            for i, j in tx.slices(offsets):
                ids = [np.array([*encode(x or ""), end_id], "<u2" if small else "<u4") for x in batch.column(1).slice(i, j - i).to_pylist()]
                inside = []
                for source, x in zip(batch.column(2).slice(i, j - i).to_pylist(), ids, strict=True):
                    inside.append(sums.get(source, 0))
                    sums[source] = inside[-1] + len(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64()), pa.array([block] * (j - i), pa.int32()), pa.array(inside, pa.int64())],
                    ["doc", "source", "ids", "n", "block", "inside"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string"), F.col(group_col).cast("string")).mapInArrow(run, f"doc {kind}, source string, ids binary, n bigint, block int, inside bigint")


def _equal_runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of more than one value, sorted ones, that are equal or next to it."""
    same = np.concatenate([[False], np.diff(values) <= 1e-12 * np.abs(values[1:]), [False]])
    edges = np.flatnonzero(np.diff(same.astype(int)))
    return [(int(i), int(j) + 1) for i, j in zip(edges[0::2], edges[1::2], strict=True)]


def part_of(a: np.ndarray, b: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """floor(a * b / whole) for b <= whole and a below 2**50, though a * b may not fit: the quotient of floats is off by
    one at most, which the remainder modulo 2**64 shows."""
    q = (a * (b / whole)).astype(np.int64)
    with np.errstate(over="ignore"):
        rest = a * b - q * whole
    return q + (rest >= whole) - (rest < 0)


#: What weights are rounded to: the largest is this, and none that isn't 0 becomes 0.
WEIGHT = 1 << 30


class Schedule:
    """How far each queue has been served when a sequence begins: deficit round-robin in closed form.

    Queues are leaves of a balanced tree. Of the first x tokens that a node gets, its left half gets floor(x * its
    share), the right half the rest; so a queue gets its share of every sequence within a few tokens. What it misses by
    rounding is its deficit, and it is carried to the next sequences, in whatever task they are packed, because the rule is a
    function of x alone, grows with x, and needs only sums on the way down to the queue. A queue that runs dry leaves, and the
    others' shares grow: with given weights the queues stand in the order in which they run dry, so those that are left of a node are the end of
    its range, and running sums of totals and of weights tell all shares at any time. The state is a few numbers for each queue, and
    every sum and comparison is one of whole numbers. Queues without weight follow when the others are dry, each with its part of their
    tokens. Every queue is served whole.
    """

    def __init__(self, totals, weights: list[float] | None, length: int):
        totals = np.asarray(totals, np.int64)
        self.length, self.total, self.queues = length, int(totals.sum()), len(totals)
        if self.total >= 1 << 50:
            raise ValueError("more than 2**50 tokens")
        self.sequences = -(-self.total // length)
        order, self.weighted = np.arange(len(totals)), 0
        given = np.asarray([] if weights is None else weights, float)
        if not (np.isfinite(given) & (given >= 0)).all():
            raise ValueError("a weight is negative or not a number")
        if given.max(initial=0) > 0:
            whole = np.where(given > 0, np.maximum(np.round(given / given.max() * WEIGHT), 1), 0).astype(np.int64)
            first = whole > 0
            late = totals / np.maximum(whole, 1)  # when each runs dry; of floats that are equal, exact fractions tell
            order = np.lexsort((late, ~first))
            self.weighted = int(first.sum())
            for i, j in _equal_runs(late[order[: self.weighted]]):
                order[i:j] = sorted(order[i:j].tolist(), key=lambda k: Fraction(int(totals[k]), int(whole[k])))
            totals, whole = totals[order], whole[order]
            self.own, self.weight = totals, whole
            self.weights = np.concatenate([[0], np.cumsum(whole)])
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.sums = np.concatenate([[0], np.cumsum(totals)])  # of the queues before

    def _dry(self, x: np.ndarray, low: int, high: int) -> np.ndarray:
        """How many queues up to which place are dry when those from ``low`` to ``high`` have given x tokens."""
        a, b = np.full(len(x), low), np.full(len(x), high)
        while (a < b).any():
            k = np.minimum((a + b) // 2, high - 1)
            left = x - (self.sums[k] - self.sums[low])  # what it and those after it have given, if it has run dry
            rest = self.weights[high] - self.weights[k]
            one, two = left.astype(float) * self.weight[k], self.own[k].astype(float) * rest
            dry = one >= two
            for i in np.flatnonzero(np.abs(one - two) <= 1e-9 * np.abs(two)).tolist():
                dry[i] = int(left[i]) * int(self.weight[k[i]]) >= int(self.own[k[i]]) * int(rest[i])
            dry &= a < b
            b = np.where(dry | (a >= b), b, k)
            a = np.where(dry, k + 1, a)
        return a

    def _gives(self, x: np.ndarray, low: int, middle: int, high: int) -> np.ndarray:
        """What those from ``low`` to ``middle`` give of the first x tokens of those from ``low`` to ``high``."""
        whole = self.sums[high] - self.sums[low]
        if low >= self.weighted:
            return part_of(x, self.sums[middle] - self.sums[low], np.maximum(whole, 1))
        p = self._dry(x, low, high)
        before = self.sums[np.minimum(p, middle)] - self.sums[low]
        active = p < middle
        q = np.minimum(p, middle)
        share = part_of(np.where(active, x - before, 0), self.weights[middle] - self.weights[q], np.maximum(self.weights[high] - self.weights[q], 1))
        return before + share

    def at(self, sequence: np.ndarray, queue: int) -> tuple[np.ndarray, np.ndarray]:
        """(tokens that this queue, tokens that the queues before it in the tree have given) when the sequence begins."""
        rest = np.minimum(sequence.astype(np.int64) * self.length, self.total)
        earlier, low, high, queue = np.zeros(len(rest), np.int64), 0, self.queues, int(self.place[queue])
        while high - low > 1:
            if low < self.weighted < high:  # those with weights come first
                middle = self.weighted
                gave = np.minimum(rest, self.sums[middle] - self.sums[low])
            else:
                middle = (low + high) // 2
                gave = self._gives(rest, low, middle, high)
            if queue < middle:
                rest, high = gave, middle
            else:
                rest, earlier, low = rest - gave, earlier + gave, middle
        return rest, earlier

    def find(self, token: np.ndarray, queue: int) -> np.ndarray:
        """The sequence that holds each token of the queue."""
        low, high = np.zeros(len(token), np.int64), np.full(len(token), self.sequences, np.int64)
        while (high - low > 1).any():
            middle = (low + high) // 2
            below = self.at(middle, queue)[0] <= token
            low, high = np.where(below, middle, low), np.where(below, high, middle)
        return low

    def pieces(self, begin: np.ndarray, count: np.ndarray, queue: int) -> tuple[np.ndarray, ...]:
        """(document, start in it, length, sequence, offset in it) of the pieces of documents at ``begin`` of the queue."""
        first, last = self.find(begin, queue), self.find(begin + count - 1, queue)
        wide = last - first > 2 * count  # a rare source: tokens lie many sequences apart
        which, seq = tx.repeat_ranges(first, np.where(wide, 0, last - first + 1))
        if wide.any():
            rare = np.flatnonzero(wide)
            of, token = tx.repeat_ranges(begin[rare], count[rare])
            pair = np.unique(np.stack([rare[of], self.find(token, queue)]), axis=1)
            which, seq = np.concatenate([which, pair[0]]), np.concatenate([seq, pair[1]])
        a, skipped_a = self.at(seq, queue)
        b, skipped_b = self.at(seq + 1, queue)
        start, end = np.maximum(a, begin[which]), np.minimum(b, begin[which] + count[which])
        keep = end > start
        offset = skipped_b - skipped_a + start - a
        return which[keep], (start - begin[which])[keep], (end - start)[keep], seq[keep], offset[keep]


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 2048,
    weights: dict[str, float] | None = None,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_col: str = "source",
) -> DataFrame:
    """Every token of every document in exactly one piece of one sequence.

    Sources are queues of documents in the order of the staged token table. Each sequence takes from every queue its
    share of ``length`` tokens: its weight (to a billionth of the largest; 0 where ``weights`` has no such source; they follow when the others are dry),
    or its part of all tokens where ``weights`` is None, and documents are cut there; only the last sequence may be short.
    Two passes: ids are made once and staged with running sums of their partition, then cut where the schedule says, from
    sums by (source, partition): no queue is gathered, however hot, and ids are not sorted.

    Returns id_col, start, length, doc_tokens, sequence_id, offset (long) and ids (binary, little-endian unsigned
    32-bit). Null and empty texts are the end id alone; a null source is a queue of its own; repeated rows are packed
    each; an empty table gives no rows; other columns are ignored.
    """
    tokens = stage(tokenize(docs, tokenizer, id_col, text_col, group_col, end_id), "tokens")
    blocks = stage(tokens.groupBy("source", "block").agg(F.sum("n").alias("n")), "token_sums")
    totals = blocks.groupBy("source").agg(F.sum("n").alias("n"))
    if totals.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    ranked = stage(global_rank(totals, ["source"], "queue").withColumn("queue", F.col("queue") - 1), "queues")
    totals = ranked.select("queue", "n").toPandas().sort_values("queue")["n"].to_numpy()
    named = None
    if weights:
        rows = ranked.filter(F.col("source").isin(list(weights))).select("queue", "source").collect()
        named = np.zeros(len(totals))
        for r in rows:
            named[r["queue"]] = float(weights[r["source"]])
    schedule = Schedule(totals, named, length)

    base = F.sum("n").over(Window.partitionBy("source").orderBy("block")) - F.col("n")
    before = stage(blocks.withColumn("base", base).join(ranked.select(F.col("source").alias("s"), "queue"), F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("s"), F.col("block").alias("b"), "queue", "base"), "token_bases")
    placed = tokens.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).select("doc", "queue", (F.col("base") + F.col("inside")).alias("begin"), "n", "ids")

    def run(batches):
        for batch in batches:
            queue = batch.column(1).to_numpy().astype(np.int64)
            begin, count = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3))
            ids = batch.column(4)
            for q in np.unique(queue):
                rows = np.flatnonzero(queue == q)
                for part in np.array_split(rows, max(1, int(count[rows].sum() >> 20))):
                    if not len(part):
                        continue
                    which, start, size, seq, offset = schedule.pieces(begin[part], count[part], int(q))
                    if not len(which):
                        continue
                    raw = [ids[int(r)].as_buffer() for r in part]
                    wide = [np.frombuffer(x, f"<u{len(x) // int(n)}").astype("<u4") for x, n in zip(raw, count[part], strict=True)]
                    own = part[which]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(own)), pa.array(start), pa.array(size), pa.array(count[own]), pa.array(seq), pa.array(offset),
                            pa.array([wide[w][s : s + k].tobytes() for w, s, k in zip(which.tolist(), start.tolist(), size.tolist(), strict=True)], pa.binary()),
                        ],
                        [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                    )

    kind = docs.schema[id_col].dataType.simpleString()
    return placed.mapInArrow(run, f"`{id_col}` {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
