"""What the removal of repeated runs sends: marks instead of anchors, and no copies of whole texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from regolith.llm import phrases, repeats, suffix, text
from tests.llm import brute


def _noise(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))


def test_runs_shorter_than_a_window_are_not_sent():
    """Texts that share 30 bytes may have anchors in common, but no mark; those that share a window of 50 bytes have its mark, wherever its anchor lies."""
    rng = random.Random(4)
    for k in range(200):
        shared = _noise(rng, 30 if k % 2 else 50)
        rows = pa.table({"text": [_noise(rng, 60) + shared + _noise(rng, 60) for _ in range(2)]})
        block = repeats.Block(rows, None, 50, 16, "text")
        common = lambda keys: set(keys[block.row == 0].tolist()) & set(keys[block.row == 1].tolist())  # noqa: B023, E731
        assert bool(common(block.mark)) == (k % 2 == 0)


def test_both_sides_of_an_anchor_go_as_one_run():
    rng = random.Random(5)
    block = repeats.Block(pa.table({"text": [_noise(rng, 3000)]}), None, 50, 16, "text")
    bits = np.ones(len(block.unique), bool)
    begin, count, _, key = block.runs(np.packbits(bits).tobytes(), np.packbits(~bits).tobytes())
    assert len(begin) == len(np.unique(block.anchor)) and count.sum() == block.count.sum() == 2951 and set(key.tolist()) == set(block.anchor.tolist())


def test_packed_marks_come_back():
    values = np.sort(text.constants(1000, 3)) >> text.U64(32)
    assert (repeats.unpack_sorted(repeats.pack_sorted(values)) == values).all()


def test_copies_of_whole_texts(spark):
    """Copies are removed whole if they have a window, and stay if they have none; of equal and null ids none is earlier than the other."""
    rng = random.Random(6)
    words = [_noise(rng, 5).replace(" ", "x") for _ in range(300)]
    page = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, short, other = page(80), "few words", page(60)
    rows = [(5, long), (2, long), (2, long), (9, long), (1, short), (3, short), (4, other), (None, other), (None, other), (7, other[40:] + long[:90]), (8, ""), (10, None), (11, page(5) + long[60:200])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    count = lambda found: sorted(found, key=str)
    got = [(r.doc_id, r.n_bytes, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in suffix.drop_repeats(df).collect()]
    spans = [(r.doc_id, r.n_words, r.n_removed) for r in phrases.drop_passages(df).collect()]
    covered = lambda units, i, n: _covered(units, rows, i, n)
    want, want_spans = [], []
    for i, (k, x) in enumerate(rows):
        data = (x or "").encode()
        hit = covered([(y or "").encode() for _, y in rows], i, 50)
        want.append((k, len(data), sum(hit), hashlib.sha256(bytes(b for b, h in zip(data, hit, strict=True) if not h)).hexdigest()))
        hit = covered([(y or "").split() for _, y in rows], i, 13)
        want_spans.append((k, len(hit), sum(hit)))
    assert count(got) == count(want) and count(spans) == count(want_spans)


def _covered(units: list, rows: list, i: int, n: int) -> list[bool]:
    order = lambda k: (1 << 63) - 1 if k is None else k
    grams = lambda u: [tuple(u[a : a + n]) for a in range(len(u) - n + 1)]
    earlier = {g for j, (k, _) in enumerate(rows) if order(k) < order(rows[i][0]) for g in grams(units[j])}
    hit = [False] * len(units[i])
    for a, g in enumerate(grams(units[i])):
        if g in earlier:
            hit[a : a + n] = [True] * n
    return hit


def test_many_copies_of_a_table(spark):
    """Six times the same texts under other ids: all later ones are removed, the first ones are as they were alone."""
    rng = random.Random(7)
    rows = [(k, _noise(rng, 400)) for k in range(20)]
    six = spark.createDataFrame([(k + 100 * c, x) for c in range(6) for k, x in rows], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffix.drop_repeats(six).collect()}
    assert got == brute.drop_repeats([{"doc_id": k + 100 * c, "text": x} for c in range(6) for k, x in rows], 50)
