"""Phrases whose words stand together more than their parts' counts suggest: level-wise mining with double-array tries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regolith.llm import text as tx
from regolith.operators.windows import global_rank
from regolith.session import stage

#: Bytes that end pieces, and those that end words.
PIECE_ENDS = tx.byte_table(*[(ord(c), ord(c)) for c in ".,;:!?"], (0x0A, 0x0D))
WORD_ENDS = PIECE_ENDS | tx.byte_table((0x20, 0x20), (0x09, 0x09))
#: Phrases in one trie (about 60 MB as built); more phrases make more tries, each with a pass of its own over the texts.
MOST = 1 << 19
#: Bits of a word's number that one step of a trie takes.
BITS = 5
#: Bytes of text that are worked on at a time; a longer document is worked on alone.
SLICE = 2 << 20
#: Parts that a language's phrases are dealt to before the first of them all are sought.
PARTS = 32


class Words:
    """The words of a slice of texts: distinct ones, the index of each word in order, its language, and whether the next word
    goes on in the same piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, offsets = tx.column(texts)
        base = offsets[0]
        data, offsets = tx.LOWER[data[base : offsets[-1]]], offsets - base
        starts, ends, first = tx.words(data, offsets, WORD_ENDS)
        n = len(starts)
        chars = np.concatenate([[0], np.cumsum(ends - starts)])
        inside = ~WORD_ENDS[data]
        packed = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(chars.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside]))])
        coded = packed.dictionary_encode()
        self.known: pa.Array = coded.dictionary
        self.at = coded.indices.to_numpy().astype(np.int64) if n else np.zeros(0, np.int64)
        langs = langs.dictionary_encode()
        self.langs: pa.Array = langs.dictionary
        of = np.repeat(np.arange(len(texts)), np.diff(first))
        self.lang = langs.indices.to_numpy().astype(np.int64)[of] if n else np.zeros(0, np.int64)
        breaks = np.flatnonzero(PIECE_ENDS[data])
        self.goes_on = np.zeros(n, bool)
        if n:
            self.goes_on[:-1] = (of[1:] == of[:-1]) & (np.searchsorted(breaks, starts[1:]) == np.searchsorted(breaks, ends[:-1]))

    def runs(self, k: int) -> np.ndarray:
        """The places where ``k`` words of one piece begin."""
        n = len(self.at) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        whole = np.ones(n, bool)
        for j in range(k - 1):
            whole &= self.goes_on[j : j + n]
        return np.flatnonzero(whole)

    def hashes(self, places: np.ndarray, k: int) -> np.ndarray:
        """A 64-bit hash of the language and the ``k`` words from each place."""
        word, lang = (_hashes(x) for x in (self.known, self.langs))
        total = lang[self.lang[places]]
        for j, c in enumerate(tx.constants(k, 77)):
            total = total + word[self.at[places + j]] * c
        return tx.mix(total + tx.U64(k))

    def phrases(self, places: np.ndarray, k: int) -> tuple[pa.Array, pa.Array]:
        """(languages, phrases) of the ``k`` words from each place."""
        parts = [self.known.take(pa.array(self.at[places + j])) for j in range(k)]
        return self.langs.take(pa.array(self.lang[places])), parts[0] if k == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))


def _hashes(strings: pa.Array) -> np.ndarray:
    data, offsets = tx.column(strings)
    return tx.word_hashes(data, offsets[:-1], offsets[1:])


def _place(parent: np.ndarray, symbol: np.ndarray, nodes: int, first: int) -> tuple[np.ndarray, int]:
    """Bases of nodes so that ``base[parent] + symbol`` is a slot of its own for every edge, from slot ``first`` on; the number of slots.

    Nodes with more edges are placed first. All nodes of a class try a random base at once; those whose slots are free, and
    wanted by no other, stay, and the rest try again, in a table with two and a half slots for each edge.
    """
    rng = np.random.default_rng(len(parent))
    size = first + int(2.5 * len(parent)) + (2 << BITS)
    base, owner = np.zeros(nodes, np.int64), np.full(size, -1, np.int64)
    order = np.argsort(parent, kind="stable")
    parent, symbol = parent[order], symbol[order]
    count = np.bincount(parent, minlength=nodes)
    begin = np.concatenate([[0], np.cumsum(count)])
    for most, least in ((1 << BITS, 17), (16, 9), (8, 5), (4, 3), (2, 2), (1, 1)):
        left = np.flatnonzero((count <= most) & (count >= least))
        while len(left):
            tried = rng.integers(first, size - (1 << BITS), len(left))
            which, edge = tx.repeat_ranges(begin[left], count[left])
            slot = tried[which] + symbol[edge]
            free = owner[slot] < 0
            owner[slot[free]] = which[free] + nodes  # the last one that wants it
            mine = free & (owner[slot] == which + nodes)
            good = np.logical_and.reduceat(mine, np.concatenate([[0], np.cumsum(count[left])[:-1]]))
            owner[slot[free]] = np.where(good[owner[slot[free]] - nodes], owner[slot[free]], -1)
            base[left[good]] = tried[good]
            left = left[~good]
    return base, size


class Trie:
    """A double-array trie of phrases of k words in their languages: from state s, a step c leads to slot base[s] + c if check there is s.

    The first states are the languages. A word is its number in the trie's own vocabulary, taken in steps of BITS bits, so that
    no state has more than 2 ** BITS successors. ``accept`` has the number of the phrase at the last states, -1 elsewhere.
    """

    def __init__(self, langs: list[str], phrases: list[str]):
        self.size = len(phrases)
        self.langs = sorted(set(langs))
        split = [p.split(" ") for p in phrases]
        self.k = len(split[0])
        self.words = sorted({w for p in split for w in p})
        number = {w: i for i, w in enumerate(self.words)}
        self.steps = max(1, -(-max(1, len(self.words) - 1).bit_length() // BITS))
        lang = {x: i for i, x in enumerate(self.langs)}
        node = np.array([lang[x] for x in langs], np.int64)
        words = np.array([[number[w] for w in p] for p in split], np.int64)
        nodes, edges = len(self.langs), []
        for j in range(self.k):
            for step in range(self.steps - 1, -1, -1):
                symbol = (words[:, j] >> (BITS * step)) & ((1 << BITS) - 1)
                distinct, node = np.unique((node << BITS) | symbol, return_inverse=True)
                edges.append((distinct >> BITS, distinct & ((1 << BITS) - 1), nodes + np.arange(len(distinct))))
                node = node + nodes
                nodes += len(distinct)
        parent, symbol, child = (np.concatenate(x) for x in zip(*edges, strict=True))
        base, slots = _place(parent, symbol, nodes, len(self.langs))
        slot = np.arange(nodes)
        slot[child] = base[parent] + symbol
        self.base, self.check, self.accept = (np.full(slots, -1, np.int32) for _ in range(3))
        self.base[slot] = base
        self.check[slot[child]] = slot[parent]
        self.accept[slot[node]] = np.arange(self.size)

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(places, numbers) of the phrases in a slice: all places advance at once, step by step, and those without a next state leave."""
        number = pc.index_in(words.known, pa.array(self.words, pa.large_string())).fill_null(-1).to_numpy().astype(np.int64)
        lang = pc.index_in(words.langs, pa.array(self.langs, words.langs.type)).fill_null(-1).to_numpy().astype(np.int64)
        places = words.runs(self.k)
        state = lang[words.lang[places]] if len(places) else places
        places, state = places[state >= 0], state[state >= 0]
        for j in range(self.k):
            word = number[words.at[places + j]] if len(places) else places
            known = word >= 0
            places, state, word = places[known], state[known], word[known]
            for step in range(self.steps - 1, -1, -1):
                slot = self.base[state] + ((word >> (BITS * step)) & ((1 << BITS) - 1))
                there = self.check[slot] == state
                places, state, word = places[there], slot[there], word[there]
        return places, self.accept[state].astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        texts = pc.fill_null(batch.column(0), "").cast(pa.large_string())
        langs = batch.column(1).cast(pa.large_string())
        for i, j in tx.slices(tx.column(texts)[1], SLICE):
            yield Words(texts.slice(i, j - i), langs.slice(i, j - i))


def _counted(hashes: np.ndarray) -> pa.RecordBatch:
    """A row for each distinct hash, with its count."""
    distinct, n = np.unique(hashes, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), pa.array(distinct.view(np.int64)), pa.array(n)], ["id", "hash", "n"])


_COUNTS = "id bigint, hash bigint, n bigint"


def words_and_pairs(texts: DataFrame) -> DataFrame:
    """(lang, phrase, hash, n) by slice: counts of words, which have no hash, of hashed pairs, which have no phrase, and of all words, with neither."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "phrase", "hash", "n"]
        for words in _slices(batches):
            key, n = np.unique(words.lang * max(len(words.known), 1) + words.at, return_counts=True)
            lang, word = np.divmod(key, max(len(words.known), 1))
            yield pa.RecordBatch.from_arrays([words.langs.take(pa.array(lang)).cast(pa.string()), words.known.take(pa.array(word)).cast(pa.string()), pa.nulls(len(n), pa.int64()), pa.array(n)], names)
            every = np.bincount(words.lang, minlength=len(words.langs))
            yield pa.RecordBatch.from_arrays([words.langs.cast(pa.string()), pa.nulls(len(every), pa.string()), pa.nulls(len(every), pa.int64()), pa.array(every)], names)
            distinct, n = np.unique(words.hashes(words.runs(2), 2), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.string()), pa.nulls(len(n), pa.string()), pa.array(distinct.view(np.int64)), pa.array(n)], names)

    return texts.mapInArrow(run, "lang string, phrase string, hash bigint, n bigint")


def _tries(spark, rows: DataFrame, total: int, most: int) -> Iterator:
    """A broadcast trie of each ``most`` phrases of a table of (id from 1, lang, phrase), with the id before its first."""
    for first in range(0, total, most):
        part = rows.filter((F.col("id") > first) & (F.col("id") <= first + most)).select("id", "lang", "phrase").toPandas().sort_values("id")
        yield first, spark.sparkContext.broadcast(Trie(part["lang"].tolist(), part["phrase"].tolist()))


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """With ``id`` from 1 by language and phrase, and their number."""
    out = stage(global_rank(rows, ["lang", "phrase"], "id"), "phrases")
    return out, out.count()


def candidates(texts: DataFrame, common: DataFrame, hashes: DataFrame, k: int, most: int) -> DataFrame:
    """(lang, phrase): the distinct phrases of ``k`` words whose hash is among ``hashes``, and whose first and last k - 1 words are in ``common``.

    The hashes' counts are never below the phrases' own, so no phrase that is frequent is missed.
    """
    spark = texts.sparkSession
    numbered = stage(global_rank(hashes, ["hash"], "id"), "hashes")
    total, at_once, out = numbered.count(), 4 * most, common.select("lang", "phrase").limit(0)
    for first in range(0, total, at_once):
        part = numbered.filter((F.col("id") > first) & (F.col("id") <= first + at_once)).select("hash").toPandas()["hash"].to_numpy(np.int64)
        known = spark.sparkContext.broadcast(np.sort(part))  # 8 bytes for each of at most ``at_once``

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            wanted = known.value
            for words in _slices(batches):
                places = words.runs(k)
                h = words.hashes(places, k).view(np.int64)
                own = places[wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h]
                ids = np.zeros(len(own), np.int64)
                for j in range(k):  # numbers of the distinct phrases, word by word
                    _, ids = np.unique(ids * max(len(words.known), 1) + words.at[own + j], return_inverse=True)
                _, one = np.unique(ids * max(len(words.langs), 1) + words.lang[own], return_index=True)
                lang, phrase = words.phrases(own[one], k)
                yield pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase.cast(pa.string())], ["lang", "phrase"])

        out = out.union(stage(texts.mapInArrow(run, "lang string, phrase string").distinct(), "candidates"))
        known.destroy()
    for part in (F.substring_index("phrase", " ", k - 1), F.substring_index("phrase", " ", 1 - k)):
        known = common.select(F.col("lang").alias("l"), F.col("phrase").alias("p"))
        out = out.join(known, (F.col("lang") == F.col("l")) & (part == F.col("p")), "left_semi")
    return out


def count_phrases(texts: DataFrame, phrases: DataFrame, min_count: int, following: int | None, most: int) -> tuple[DataFrame, DataFrame | None]:
    """((lang, phrase, n) of the phrases with at least ``min_count`` occurrences, (hash, n) of runs of ``following`` words that go on from one).

    A pass over the texts for each trie: every task counts the accepting states of all its places; the tasks' counts are summed.
    """
    numbered, total = _numbered(phrases)
    parts = []
    for first, trie in _tries(texts.sparkSession, numbered, total, most):

        def run(batches: Iterator[pa.RecordBatch], first=first, trie=trie) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(trie.value.size, np.int64)
            for words in _slices(batches):
                places, ids = trie.value.found(words)
                counts += np.bincount(ids, minlength=len(counts))
                if following:
                    begins = np.zeros(len(words.at), bool)
                    begins[places] = True
                    longer = words.runs(following)
                    yield _counted(words.hashes(longer[begins[longer]], following))
            full = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(full + first + 1), pa.nulls(len(full), pa.int64()), pa.array(counts[full])], ["id", "hash", "n"])

        parts.append(stage(texts.mapInArrow(run, _COUNTS).repartition("id", "hash").groupBy("id", "hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "phrase_counts"))
        trie.destroy()
    if not parts:
        return numbered.select("lang", "phrase", F.lit(0).cast("long").alias("n")).limit(0), None
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.union(p)
    frequent = numbered.join(counts.filter("id IS NOT NULL").select("id", "n"), "id").select("lang", "phrase", "n")
    more = None
    if following:  # a longer phrase is met by one trie only, that of its first words
        more = counts.filter("hash IS NOT NULL").groupBy("hash").agg(F.sum("n").alias("n")).select("hash", "n")
    return stage(frequent, "frequent"), more


def mine(
    docs: DataFrame,
    longest: int = 4,
    min_count: int = 30,
    first: int | None = 2000,
    inside: int = 80,
    text_col: str = "text",
    lang_col: str = "lang",
    most: int = MOST,
) -> DataFrame:
    """The collocations of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and these into words at spaces and tabs. A candidate is
    a phrase of 2 to ``longest`` words with a >= ``min_count`` occurrences in pieces of its language, overlaps included. Cut after
    its first words, its parts have l and r occurrences, and it scores floor(2000000 a / (l + r)), at its worst cut. A candidate
    inside a longer one that has ``inside`` in a hundred of its occurrences is dropped. ``first`` of each language are returned
    (all, if None), by score, then a, then the phrase; n is the language's words.

    Level by level: words are counted; of longer runs whose first words are a candidate, hashes are counted, and those that are frequent
    name the next candidates, which hold all frequent phrases and whose parts are frequent themselves. Candidates are counted exactly by a double-array trie that is broadcast, with at most ``most`` phrases; beyond that, tries follow one another with
    a pass each. Null texts are empty, null languages ``und``; repeated rows count each; an empty table gives no rows; other columns are
    ignored.
    """
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    # slices have summed already, so rows are dealt out as they are, and tasks that read texts keep no table of them
    words = stage(words_and_pairs(texts).repartition("lang", "phrase", "hash").groupBy("lang", "phrase", "hash").agg(F.sum("n").alias("n")).filter((F.col("n") >= min_count) | F.col("hash").isNull() & F.col("phrase").isNull()), "words")
    totals = words.filter("phrase IS NULL AND hash IS NULL").select("lang", F.col("n").alias("total"))
    levels = [stage(words.filter("phrase IS NOT NULL").select("lang", "phrase", "n"), "frequent")]
    hashes = words.filter("hash IS NOT NULL").select("hash")
    for k in range(2, longest + 1):
        chosen = candidates(texts, levels[-1], hashes, k, most)
        frequent, more = count_phrases(texts, chosen, min_count, k + 1 if k < longest else None, most)
        levels.append(frequent)
        if more is None:
            break
        hashes = more.filter(F.col("n") >= min_count).select("hash")
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)

    found = every.withColumn("w", F.split("phrase", " ")).withColumn("k", F.size("w")).filter("k > 1")
    cuts = found.select("lang", "phrase", F.col("n").alias("a"), "w", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice("w", F.lit(1), F.col("cut")), " "), "right": F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ")})
    side = lambda name, n: every.select(F.col("lang").alias(f"lang_{name}"), F.col("phrase").alias(name + "_"), F.col("n").alias(n))
    for name, n in (("left", "l"), ("right", "r")):
        cuts = cuts.join(side(name, n), (F.col("lang") == F.col(f"lang_{name}")) & (F.col(name) == F.col(name + "_"))).drop(f"lang_{name}", name + "_")
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("CAST((2000000BD * CAST(a AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.score", "x.l", "x.r")

    longer = found.filter("k > 2").select("lang", "n", F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " ")))))).alias("part"))
    holders = longer.groupBy("lang", "part").agg(F.max("n").alias("most"))
    kept = scored.join(holders.withColumnRenamed("lang", "lang_"), (F.col("lang") == F.col("lang_")) & (F.col("phrase") == F.col("part")), "left")
    kept = kept.filter(F.col("most").isNull() | (100 * F.col("most").cast("decimal(19,0)") < inside * whole("a"))).select("lang", "phrase", "a", "l", "r", "score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if first is not None:  # the first of each part hold the first of all, so no task sees all phrases of a language
        part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
        kept = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= first).drop("part", "rank")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if first is not None:
        ranked = ranked.filter(F.col("rank") <= first)
    return ranked.join(totals.withColumnRenamed("lang", "lang_"), F.col("lang") == F.col("lang_")).select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
