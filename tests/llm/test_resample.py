"""Importance resampling against plain Python, and awkward inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from regolith.llm import resample
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, score string, weight int"


def plain(docs, target, percent=25):
    feats = lambda t: (w := re.findall(brute.WORD, brute.lower(t))) + [f"{a} {b}" for a, b in zip(w, w[1:])]
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for x in xs for f in feats(x)) for xs in ([x for _, x in docs], target))
    total_s, total_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * total_s / ((s[b] + 1.0) * total_t)))
    rows = []
    for k, x in docs:
        own = feats(x)
        weight = sum(gain(bucket(f)) for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append([k, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 39), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(repr, map(tuple, rows)))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    some = lambda n, k: " ".join(rng.choice(["W", "w", "é", "Ü"]) + str(rng.randrange(k)) for _ in range(n))
    texts = [None, "", " ,;", "one", "One one ONE", "a\x00b\x7fc É", some(40_000, 9000), "x" * 5000, "x " * 5000]
    texts += [some(rng.randrange(1, 90), rng.choice([5, 300])) for _ in range(90)]
    return list(enumerate(texts)) + [(30, texts[30]), (30, texts[30]), (None, texts[31])]


def got(out):
    return sorted(repr((r.doc_id, r.n_features, r.weight, r.score, r["rank"])) for r in out.collect())


def test_resample(spark, rows):
    target = [None, "", "w1 w2 w3", "w4 w4 é1 ü2 " * 50]
    t = spark.createDataFrame([(x,) for x in target], "text string")
    d = spark.createDataFrame([(k, x, "z", 1) for k, x in rows], SCHEMA)
    assert got(resample.resample(d.repartition(5), t, ["doc_id"])) == plain(rows, target)
    assert got(resample.resample(d, t.limit(0), ["doc_id"], percent=100)) == plain(rows, [], 100)
    assert resample.resample(d.limit(0), t, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        resample.resample(d, t, ["doc_id", "score"])


def test_keeps_other_columns(spark):
    d = spark.createDataFrame([(i, "a b c " * 10, {"k": i}) for i in range(8)], "doc_id int, text string, meta map<string,int>")
    out = resample.resample(d, d, ["meta", "text"], percent=50).collect()
    assert sorted(r.meta["k"] for r in out) == list(range(8)) and sorted(r["rank"] for r in out if r["rank"]) == [1, 2, 3, 4]
