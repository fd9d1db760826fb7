"""Collocations against plain Python, the trie against a dictionary, and awkward inputs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from regolith.llm import collocations as co
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, n string, phrase int"


def plain(rows, least, longest=4, first=2000):
    counts, totals, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items())
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:first])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(None, "en"), ("", None), (" \t\n.,", "fr"), ("A", "en"), ("a a a a a a a a a a", "en"), ("New  York\tcity, new york city: NEW YORK CITY." * 4, "en")]
    zipf = lambda n: " ".join(f"w{int(rng.paretovariate(0.9))}" for _ in range(n))
    for i in range(120):
        text = re.sub(r"(\S+) (\S+)", lambda m: m[0] + rng.choice(["", "", ".", "\n", ",", "  é ß", "\x0b"]), zipf(rng.randrange(1, 120)))
        out.append((text + rng.choice(["", " in spite of", " in spite of it all", " as well as", "\x00 \x1c"]), rng.choice(["en", "en", "en", "de", None, "und"])))
    out += [("the same text again and again, the same text", "fr")] * 40 + [(zipf(30_000), "es")]
    return out


def got(out):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out.collect())


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "n", 1) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(5).cache()


def test_mine(rows, docs):
    want = plain(rows, 6)
    assert len(want) > 200 and {2, 3, 4} == {len(r[2].split(" ")) for r in want}
    assert got(co.mine(docs, min_count=6)) == want


def test_mine_with_many_tries_and_few_ranks(rows, docs):
    assert got(co.mine(docs, min_count=20, first=7, most=37)) == plain(rows, 20, first=7)
    assert got(co.mine(docs, min_count=20, longest=3, first=None)) == plain(rows, 20, longest=3, first=10**9)


def test_mine_without_phrases(docs):
    assert co.mine(docs.limit(0)).count() == 0
    assert co.mine(docs, min_count=10**7).count() == 0


def test_trie_finds_what_a_dictionary_finds():
    rng = random.Random(2)
    texts = [" ".join(f"{rng.choice('abé')}{rng.randrange(60)}" for _ in range(400)) + rng.choice([".", ""]) for _ in range(20)] + [None, ""]
    langs = [rng.choice(["x", "y"]) for _ in texts]
    words = co.Words(pa.array(texts, pa.large_string()).fill_null(""), pa.array(langs, pa.large_string()))
    for k in (1, 2, 3):
        lang, phrase = words.phrases(words.runs(k), k)
        every = list(zip(lang.to_pylist(), phrase.to_pylist(), strict=True))
        chosen = sorted(set(rng.sample(every, 700)) | {("z", " ".join(["none"] * k))})
        trie = co.Trie(*map(list, zip(*chosen, strict=True)))
        places, ids = trie.found(words)
        at = dict(zip(places.tolist(), ids.tolist(), strict=True))
        number = {p: i for i, p in enumerate(chosen)}
        assert at == {int(i): number[p] for i, p in zip(words.runs(k), every, strict=True) if p in number}
        assert (np.bincount(trie.check[trie.check >= 0]) <= 1 << co.BITS).all()


def test_bases_give_every_edge_a_slot_of_its_own():
    rng = np.random.default_rng(1)
    edges = np.unique(np.concatenate([rng.integers(0, 3000, 9000), rng.integers(0, 40, 4000)]) * 32 + rng.integers(0, 32, 13_000))
    base, size = co._place(edges >> 5, edges & 31, 3000, 10)
    slots = base[edges >> 5] + (edges & 31)
    assert len(np.unique(slots)) == len(edges) and slots.min() >= 10 and slots.max() < size
