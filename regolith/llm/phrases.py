"""Removal of passages that an earlier document has, located with Aho-Corasick automata."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from regolith.llm import text as tx
from regolith.llm.repeats import Tokens, removed_runs

#: Words of an anchor.
GRAM = 5


def first_documents(texts: list[bytes], sizes: np.ndarray, docs: np.ndarray, length: int) -> list[tuple[int, int, int, int]]:
    """(text, window from, window to, first document) for the texts with a window that occurs elsewhere too.

    Windows that recur are confirmed by counts of their hashes and compiled into an automaton over the shard's words; all
    texts then stream through it, and what it reports is exact.
    """
    import ahocorasick

    number: dict[bytes, int] = {}
    words = [[number.setdefault(w, len(number)) for w in x.split(b" ")] for x in texts]
    flat = np.concatenate([np.array(x, np.int64) for x in words]) if words else np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.cumsum([len(x) for x in words])])
    text, at = tx.repeat_ranges(begin[:-1], sizes)
    keys = tx.windows(tx.mix(flat.astype(np.uint64)), length)[at]
    _, first, inverse, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count > 1)
    if not len(again):
        return []
    phrases = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    total = 0
    for i in first[again].tolist():
        phrases.add_word(tuple(flat[at[i] : at[i] + length].tolist()), total)
        total += 1
    phrases.make_automaton()
    touched = np.unique(text[np.isin(inverse.ravel(), again)])
    found = [(k, end - length + 1, p) for k in touched.tolist() for end, p in phrases.iter(tuple(words[k]))]
    hit = np.array(found, np.int64).reshape(-1, 3)
    least = np.full(total, (1 << 63) - 1)
    np.minimum.at(least, hit[:, 2], docs[hit[:, 0]])
    out = []
    bounds = np.searchsorted(hit[:, 0], touched)
    for k, a, b in zip(touched.tolist(), bounds.tolist(), np.append(bounds[1:], len(hit)).tolist(), strict=True):
        value = np.full(int(sizes[k]), docs[k])
        value[hit[a:b, 1]] = least[hit[a:b, 2]]
        if (value < docs[k]).any():
            head = np.flatnonzero(np.diff(value, prepend=value[0] - 1))
            out += [(k, x, y, int(value[x])) for x, y in zip(head.tolist(), np.append(head[1:], len(value)).tolist(), strict=True)]
    return out


def drop_passages(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_removed, kept): every word under ``length`` consecutive words that also start in a document with
    a smaller id is removed.

    Passages are judged on the input. kept (string) has the words that stay, joined by one space. Null and empty texts have
    no words; equal ids are not smaller than each other, and a null id counts as larger than all; an empty table gives no
    rows; other columns are ignored.
    """

    def solve(texts, sizes, first):
        return first_documents(texts, sizes, first, length)

    def finish(tokens: Tokens, a: int, b: int, covered: np.ndarray):
        keep = np.flatnonzero(~covered) + a
        kept = b" ".join([tokens.data[x:y].tobytes() for x, y in zip(tokens.starts[keep].tolist(), tokens.ends[keep].tolist(), strict=True)])
        return b - a, int(covered.sum()), kept.decode("utf-8", "replace")

    return removed_runs(docs, length, GRAM, tx.SPACES, solve, finish, "n_words bigint, n_removed bigint, kept string", id_col, text_col)
