"""Removal of long byte strings that an earlier document has, found with suffix arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from regolith.llm.repeats import Tokens, removed_runs
from regolith.llm.text import byte_windows, repeat_ranges

#: Bytes in one suffix array; a larger shard has several, merged by binary search.
MOST = 4 << 20
#: Bytes of an anchor.
GRAM = 16


class SuffixArray:
    """All suffixes of some strings (each ends with its string), by Larsson and Sadakane's refinement, and common prefixes by Kasai's rule."""

    def __init__(self, texts: list[bytes], cap: int):
        self.cap = cap
        size = np.array([len(x) for x in texts], np.int64)
        self.data = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
        self.n = int(size.sum())
        self.begin = np.concatenate([[0], np.cumsum(size)])
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), size)
        self.rest = (self.begin[1:][self.text] - np.arange(self.n)).astype(np.int32)
        self.order = self._sorted()
        self.common = self._kasai(size)

    def _sorted(self) -> np.ndarray:
        n, rest = self.n, self.rest
        key = np.zeros(n, np.uint64)
        for k in range(7):
            key = key << np.uint64(8) | np.where(rest > k, self.data[k : k + n], 0).astype(np.uint64)
        key = key << np.uint64(8) | np.minimum(rest, 7).astype(np.uint64)
        order = np.argsort(key)
        head = np.ones(n, bool)
        sorted_key = key[order]
        head[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.int64)  # the place of the first suffix of its group
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        reach, longest = 7, int(rest.max(initial=0))
        while reach < longest:
            slot = np.flatnonzero(~(head & np.append(head[1:], True)))  # only groups of several suffixes are sorted further
            if not len(slot):
                break
            own = order[slot]
            both = rank[own] * (n + 1) + np.where(rest[own] > reach, rank[np.minimum(own + reach, n - 1)] + 1, 0)
            by = np.argsort(both)
            own, both = own[by], both[by]
            order[slot] = own
            new = np.ones(len(own), bool)
            new[1:] = both[1:] != both[:-1]
            head[slot] = new
            rank[own] = slot[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
            reach *= 2
        slot = np.flatnonzero(~(head & np.append(head[1:], True)))  # equal to their ends: the earlier string comes first
        own = order[slot]
        order[slot] = own[np.argsort(rank[own] * (n + 1) + own)]
        return order

    def _kasai(self, size: np.ndarray) -> np.ndarray:
        """Common prefix of each suffix with the one before it, up to ``cap``: when a suffix shares l bytes, the suffix one
        byte on shares l - 1 at least. All strings advance together."""
        n = self.n
        before = np.full(n, -1, np.int64)
        before[self.order[1:]] = self.order[:-1]
        out = np.zeros(n, np.int32)
        by = np.argsort(-size, kind="stable")
        begin, size = self.begin[:-1][by], size[by]
        shared = np.zeros(len(by), np.int32)
        for j in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -j, "left"))
            at = begin[:live] + j
            past = before[at]
            now = np.where(past >= 0, np.maximum(shared[:live] - 1, 0), 0)
            limit = np.where(past >= 0, np.minimum(np.minimum(self.rest[at], self.rest[past]), self.cap), 0)
            go = np.flatnonzero(now < limit)
            while len(go):
                go = go[self.data[at[go] + now[go]] == self.data[past[go] + now[go]]]
                now[go] += 1
                go = go[now[go] < limit[go]]
            out[at] = shared[:live] = now
        return out[self.order]

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """(windows of ``cap`` bytes in order, class of each); equal windows have one class."""
        group = np.cumsum(self.common < self.cap)
        full = self.rest[self.order] >= self.cap
        window, group = self.order[full], group[full]
        return window, np.unique(group, return_inverse=True)[1] if len(group) else group

    def words(self, at: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8 k .. 8 k + 7 of the windows as numbers that sort alike."""
        value = np.zeros(len(at), np.uint64)
        for b in range(8 * k, min(8 * k + 8, self.cap)):
            value = value << np.uint64(8) | self.data[at + b].astype(np.uint64)
        return value


def locate(a: SuffixArray, wanted: np.ndarray, b: SuffixArray, sorted_windows: np.ndarray) -> np.ndarray:
    """The place in ``sorted_windows`` of b of each wanted window of a, or -1, by binary search."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(sorted_windows), np.int64)
    steps = -(-a.cap // 8)
    keys = [a.words(wanted, k) for k in range(steps)]
    theirs = [b.words(sorted_windows, k) for k in range(steps)]
    while (low < high).any():
        middle = np.minimum((low + high) // 2, len(sorted_windows) - 1)
        less, equal = np.zeros(len(wanted), bool), np.ones(len(wanted), bool)
        for mine, other in zip(keys, theirs, strict=True):
            x = other[middle]
            less |= equal & (x < mine)
            equal &= x == mine
        open_ = low < high
        low = np.where(open_ & less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)
    at = np.minimum(low, max(0, len(sorted_windows) - 1))
    same = low < len(sorted_windows)
    for mine, other in zip(keys, theirs, strict=True):
        same &= other[at] == mine if len(other) else False
    return np.where(same, at, -1)


def first_documents(texts: list[bytes], sizes: np.ndarray, docs: np.ndarray, length: int) -> list[tuple[int, int, int, int]]:
    """(text, window from, window to, first document) for the texts with a window that occurs elsewhere too."""
    lens = np.array([len(x) for x in texts], np.int64)
    text, at = repeat_ranges(np.cumsum(lens) - lens, sizes)
    _, kind, times = np.unique(byte_windows(np.frombuffer(b"".join(texts), np.uint8), length)[at], return_inverse=True, return_counts=True)
    able = np.unique(text[times[kind.ravel()] > 1])  # equal windows have equal fingerprints: no other text can share one
    texts, sizes, docs, lens = [texts[i] for i in able.tolist()], sizes[able], docs[able], lens[able]
    part = (np.cumsum(lens) - lens) // MOST
    arrays = []
    for p in np.unique(part).tolist():
        own = np.flatnonzero(part == p)
        sa = SuffixArray([texts[i] for i in own.tolist()], length)
        window, group = sa.classes()
        first = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else np.zeros(0, np.int64)
        least = np.minimum.reduceat(docs[own[sa.text[window]]], first) if len(group) else np.zeros(0, np.int64)
        arrays.append((own, sa, window, group, window[first], least))
    for i in range(len(arrays)):
        for j in range(i + 1, len(arrays)):
            _, a, _, _, heads, least = arrays[i]
            _, b, _, _, others, theirs = arrays[j]
            if len(heads) and len(others):
                at = locate(a, heads, b, others)
                both = np.flatnonzero(at >= 0)
                low = np.minimum(least[both], theirs[at[both]])
                least[both] = low
                theirs[at[both]] = low
    out = []
    for own, sa, window, group, _, least in arrays:
        first = np.empty(sa.n, np.int64)
        first[window] = least[group]
        changed = np.unique(sa.text[window[least[group] < docs[own[sa.text[window]]]]])
        where, at = repeat_ranges(sa.begin[changed], sizes[own[changed]])
        value = first[at]
        new = np.ones(len(at), bool)
        new[1:] = (where[1:] != where[:-1]) | (value[1:] != value[:-1])
        head = np.flatnonzero(new)
        stop = np.append(head[1:], len(at))
        base = sa.begin[changed][where[head]]
        out += zip(able[own[changed[where[head]]]].tolist(), (at[head] - base).tolist(), (at[stop - 1] - base + 1).tolist() if len(head) else [], value[head].tolist(), strict=True)
    return out


def drop_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept): every byte under a ``length``-byte string that also starts in a document
    with a smaller id is removed.

    Strings are judged on the input. kept (binary) is what stays, concatenated; n_spans counts maximal removed runs. Null
    and empty texts have no bytes; equal ids are not smaller than each other, and a null id counts as larger than all; an
    empty table gives no rows; other columns are ignored.
    """

    def solve(texts, sizes, first):
        return first_documents(texts, sizes, first, length)

    def finish(tokens: Tokens, a: int, b: int, covered: np.ndarray):
        edges = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum()) if b > a else 0
        return b - a, int(covered.sum()), edges, tokens.data[a:b][~covered].tobytes()

    return removed_runs(docs, length, GRAM, None, solve, finish, "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary", id_col, text_col)
