"""Approximate nearest neighbours: a robust-pruned directed graph in each shard, searched by beams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regolith.llm.text import repeat_ranges

#: Vectors in a shard, on average, at every size of the table: recall of a beam falls in larger graphs.
SHARD = 8192


def search(vectors: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, distances) of the ``beam`` nearest found for each query, nearest first, by greedy beam search in step.

    ``graph`` has a row of neighbours for each vector, padded with the vector itself.
    """
    n, m = len(queries), len(vectors)
    beam = min(beam, m)
    seen = np.zeros((n, m), bool)
    place = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf, np.float32)
    done = np.ones((n, beam), bool)
    place[:, 0] = entry
    far[:, 0] = -(queries @ vectors[entry])
    done[:, 0] = False
    seen[:, entry] = True
    live = np.arange(n)
    while len(live):
        best = np.argmin(np.where(done[live], np.inf, far[live]), axis=1)
        done[live, best] = True
        near = graph[place[live, best]]
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        distance = np.where(fresh, -np.einsum("qd,qkd->qk", queries[live], vectors[near]), np.inf).astype(np.float32)
        near_sorted = np.sort(np.where(fresh, near, -1), axis=1)  # a padded neighbour may come twice
        if near.shape[1] > 1 and ((near_sorted[:, 1:] == near_sorted[:, :-1]) & (near_sorted[:, 1:] >= 0)).any():
            for r in range(len(live)):
                _, first = np.unique(near[r], return_index=True)
                twice = np.ones(near.shape[1], bool)
                twice[first] = False
                distance[r, twice] = np.inf
        all_far = np.concatenate([far[live], distance], axis=1)
        pick = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        place[live] = np.take_along_axis(np.concatenate([place[live], near], axis=1), pick, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros(near.shape, bool)], axis=1), pick, 1)
        far[live] = np.take_along_axis(all_far, pick, 1)
        done[live] |= ~np.isfinite(far[live])
        live = live[~done[live].all(axis=1)]
    return np.where(np.isfinite(far), place, -1), far


def robust_prune(vectors: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each vector ``of``: the nearest candidate stays and removes those that are
    alpha times nearer to it than to the vector (squared distances of unit vectors). Candidates of -1 are none."""
    own = vectors[of]
    cand = np.where(candidates < 0, 0, candidates)
    to_own = 2 - 2 * np.einsum("qd,qkd->qk", own, vectors[cand])
    gone = (candidates < 0) | (candidates == of[:, None])
    order = np.argsort(np.where(gone, np.inf, to_own), axis=1, kind="stable")
    cand, to_own, gone = (np.take_along_axis(x, order, 1) for x in (cand, to_own, gone))
    gone[:, 1:] |= cand[:, 1:] == cand[:, :-1]
    out = np.repeat(of[:, None], degree, axis=1)
    count = np.zeros(len(of), np.int64)
    rows = np.arange(len(of))
    while True:
        open_rows = rows[(~gone).any(axis=1) & (count < degree)]
        if not len(open_rows):
            return out
        first = np.argmin(gone[open_rows], axis=1)
        chosen = cand[open_rows, first]
        out[open_rows, count[open_rows]] = chosen
        count[open_rows] += 1
        between = 2 - 2 * np.einsum("qd,qkd->qk", vectors[chosen], vectors[cand[open_rows]])
        gone[open_rows] |= alpha * alpha * between <= to_own[open_rows]
        gone[open_rows, first] = True


def build(vectors: np.ndarray, degree: int = 24, beam: int = 48, alpha: float = 1.2, seed: int = 7) -> tuple[np.ndarray, int]:
    """(graph, entry): vectors join in growing batches, each found by a greedy search of the graph so far.

    A vector's list may grow by half over ``degree`` with edges from later ones before it is pruned again.
    """
    n = len(vectors)
    room = degree + degree // 2
    entry = int(np.argmax(vectors @ vectors.mean(axis=0)))
    graph = np.repeat(np.arange(n)[:, None], room, axis=1)
    count = np.zeros(n, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])

    def put(of: np.ndarray, near: np.ndarray) -> None:
        graph[of] = of[:, None]
        graph[of, :degree] = near
        count[of] = (near != of[:, None]).sum(axis=1)

    for slack in (1.0, alpha):
        at = 1 if slack == 1.0 else 0
        while at < n:
            batch = order[at : at + min(256, max(1, at if slack == 1.0 else 256))]
            at += len(batch)
            found, _ = search(vectors, graph, entry, vectors[batch], beam)
            near = robust_prune(vectors, batch, np.concatenate([found, graph[batch]], axis=1), degree, slack)
            put(batch, near)
            source, target = np.repeat(batch, degree), near.ravel()
            keep = (source != target) & ~(graph[target] == source[:, None]).any(axis=1)
            by = np.argsort(target[keep], kind="stable")
            source, target = source[keep][by], target[keep][by]
            changed, first, more = np.unique(target, return_index=True, return_counts=True)
            place = count[target] + np.arange(len(target)) - np.repeat(first, more)
            fits = np.repeat(count[changed] + more <= room, more)
            graph[target[fits], place[fits]] = source[fits]
            full = np.flatnonzero(count[changed] + more > room)
            count[changed] += np.where(count[changed] + more <= room, more, 0)
            for low in range(0, int(more[full].max(initial=0)), 64):
                some = full[more[full] > low]
                which, k = repeat_ranges(first[some] + low, np.minimum(more[some] - low, 64))
                extra = np.full((len(some), 64), -1, np.int64)
                extra[which, k - first[some][which] - low] = source[k]
                of = changed[some]
                put(of, robust_prune(vectors, of, np.concatenate([graph[of], extra], axis=1), degree, slack))
    return graph, entry


class Shard:
    """The vectors of a shard, with a graph for each length of vectors, built when the first query of that length comes."""

    def __init__(self, degree: int, beam: int, k: int):
        self.degree, self.beam, self.k = degree, beam, k
        self.ids: list[np.ndarray] = []
        self.vectors: list[tuple[np.ndarray, np.ndarray]] = []  # components, numbers of them
        self.graphs: dict[int, tuple | None] = {}

    def add(self, ids: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.ids.append(ids)
        self.vectors.append((flat, sizes))

    def _graph(self, d: int):
        if d not in self.graphs:
            own, whole = [], []
            for ids, (flat, sizes) in zip(self.ids, self.vectors, strict=True):
                at = np.flatnonzero(sizes == d)
                starts = np.cumsum(sizes) - sizes
                own.append(ids[at])
                whole.append(flat[starts[at][:, None] + np.arange(d)])
            own, whole = np.concatenate(own or [np.zeros(0, np.int64)]), np.concatenate(whole or [np.zeros((0, d))])
            if len(own):
                unique, group = np.unique(whole, axis=0, return_inverse=True)
                by = np.lexsort((own, group.ravel()))
                first = np.searchsorted(group.ravel()[by], np.arange(len(unique) + 1))
                unit = _unit(unique)
                single = unit.astype(np.float32)
                self.graphs[d] = (unit, single, own[by], first, *build(single, self.degree, max(self.degree, self.beam // 2)))
            else:
                self.graphs[d] = None
        return self.graphs[d]

    def answer(self, ids: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, float]]:
        """(query, found, cosine) of up to 2 k found for each query."""
        out, starts = [], np.cumsum(sizes) - sizes
        for d in np.unique(sizes).tolist():
            graph = self._graph(d)
            if graph is None:
                continue
            unit, single, own, first, edges, entry = graph
            them = np.flatnonzero(sizes == d)
            most = max(1, min(512, (64 << 20) // len(unit)))  # what a search marks as seen stays below 64 MB
            for low in range(0, len(them), most):
                part = them[low : low + most]
                q = _unit(flat[starts[part][:, None] + np.arange(d)])
                place, _ = search(single, edges, entry, q.astype(np.float32), max(self.beam, 4 * self.k))
                for r, row in enumerate(part.tolist()):
                    found = place[r][place[r] >= 0]
                    best = []
                    for c, f in zip((unit[found] @ q[r]).tolist(), found.tolist(), strict=True):
                        best += [(c, x) for x in own[first[f] : first[f + 1]][: self.k + 1].tolist() if x != ids[row]]
                    best.sort(key=lambda x: (-x[0], x[1]))
                    out += [(int(ids[row]), x, c) for c, x in best[: 2 * self.k]]
        return out


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def nearest(
    table: DataFrame, query: DataFrame, k: int = 5, degree: int = 32, beam: int = 128, shard: int = SHARD, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest by cosine found for each row of ``query`` among all rows of ``table``.

    Rows fall into shards by a hash of id and vector, of ``shard`` vectors on average whatever the table's size; each shard holds a graph over
    its distinct vectors. Every query is searched in every shard: a task reads a shard's vectors, builds the graph, and then
    lets the queries stream through it, so that it never holds more than one shard and one batch of queries, however many
    there are. The shards' best are merged by a window per query. Copies of a vector are one vertex of the graph whose ids are
    listed up to k + 1, which is all that a list of k can need. Scores are cosines in double precision of the original
    vectors; ties go to the smaller id; a query's own id is no answer. Vectors that are null, zero, or hold null or non-finite
    components, or null ids take no part; repeated ids count once, in the table by their best vector and among queries
    by the best answers of all their vectors; vectors of another length than the query's aren't compared.
    """

    def valid(df):
        v = F.col(vector_col).cast("array<double>")
        ok = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
        return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(ok)

    base, asked = valid(table), valid(query)
    n = base.count()
    shards = max(1, -(-n // shard))
    rows = base.select("id", "v", F.pmod(F.xxhash64("v", "id"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("ask"))
    asks = asked.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("ask"))

    def run(batches):
        number, now = None, None
        for batch in batches:
            key = batch.column("shard").to_numpy().astype(np.int64) * 2 + batch.column("ask").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if key[a] // 2 != number:
                    number, now = key[a] // 2, Shard(degree, beam, k)
                part = batch.slice(a, b - a)
                lists = part.column("v")
                ids, flat, sizes = part.column("id").to_numpy(), lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
                if key[a] % 2 == 0:
                    now.add(ids, flat, sizes)
                    continue
                out = now.answer(ids, flat, sizes)
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.float64())], ["query_id", "vec_id", "near"])

    dealt = rows.union(asks).repartition(shards, "shard").sortWithinPartitions("shard", "ask")
    found = dealt.mapInArrow(run, "query_id bigint, vec_id bigint, near double").groupBy("query_id", "vec_id").agg(F.max("near").alias("near"))
    order = Window.partitionBy("query_id").orderBy(F.desc("near"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("near").alias("score"))
