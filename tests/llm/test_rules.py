"""Quality rules against plain Python, and awkward inputs."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regolith.llm import rules
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, n_words string, votes int, features string"


def plain(text):
    text = text or ""
    w = re.findall(brute.SPACE, text)
    lines = [x for x in text.split("\n") if re.search(brute.SPACE, x)]
    runs = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
    letters = re.sub(r"[\x00-\x40\x5B-\x60\x7B-\x7F]", "", text)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), len(letters), len(lines), len(re.findall(r"[.!?]", text)))


def steps(votes):
    """Expectation-maximisation over the rows themselves."""
    m = len(votes[0])
    share, a, b = rules.SHARE, [rules.RIGHT_IF_GOOD] * m, [rules.RIGHT_IF_BAD] * m
    good = lambda v: 1 / (1 + math.exp(-math.log(share / (1 - share)) - sum(math.log(a[j] / (1 - b[j])) if x == 1 else math.log((1 - a[j]) / b[j]) for j, x in enumerate(v) if x)))
    for _ in range(rules.STEPS):
        p = [good(v) for v in votes]
        rate = lambda right, wrong, start: (right + start * rules.PRIOR_VOTES) / (right + wrong + rules.PRIOR_VOTES)
        of = lambda f, j, x: sum(f(y) for y, v in zip(p, votes, strict=True) if v[j] == x)
        own, other = (lambda y: y), (lambda y: 1 - y)
        share, a, b = rate(sum(p), len(p) - sum(p), rules.SHARE), [rate(of(own, j, 1), of(own, j, -1), rules.RIGHT_IF_GOOD) for j in range(m)], [rate(of(other, j, -1), of(other, j, 1), rules.RIGHT_IF_BAD) for j in range(m)]
    return share, a, b, [good(v) for v in votes]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    some = lambda n, k: [f"w{rng.randrange(k)}" for _ in range(n)]
    texts = [None, "", " \n\t\r\x0b\x0c ", "one", "a b a b a b a b", "é ü é ü é ü", "a\nb\na\n a\n\n\nb", "#$ % <|> a", "a b c a b c", "x " * 5000, "a\x1cb\x85c d e", " ".join(some(60_000, 30_000)), "a b\nc" * 4]
    for _ in range(60):
        w = some(rng.randrange(1, 300), rng.choice([3, 40, 4000]))
        texts.append("".join(x + rng.choice([" ", "  ", "\n", ". ", "&&& ", "\t"]) for x in w))
    return [(i, t, "n", 1, "f") for i, t in enumerate(texts)] + [(7, "again a b", "n", 1, "f"), (None, "no id", None, None, None)]


def test_features(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA)
    got = d.select("text", rules.features(F.col("text")).alias("f")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r.f) == plain(r.text), repr(r.text)[:200]


def test_votes_are_weighed(spark):
    """Worth and posteriors equal those of the same steps over single rows; rules that agree outweigh one that errs."""
    rng = random.Random(8)
    votes = []
    for _ in range(400):
        y = 1 if rng.random() < 0.75 else -1
        votes.append([y if rng.random() < p else rng.choice([0, -y]) for p in (0.95, 0.9, 0.9, 0.6)])
    d = spark.createDataFrame([(v,) for v in votes], "v array<int>")
    worth = rules.fit(d, "v", 4)
    share, a, b, good = steps(votes)
    assert abs(worth.share - share) < 1e-9
    assert max(abs(x - y) for x, y in zip(worth.right_if_good + worth.right_if_bad, a + b, strict=True)) < 1e-9
    got = {tuple(r.v): r.p for r in d.select("v", worth.posterior(F.col("v")).alias("p")).collect()}
    assert all(abs(got[tuple(v)] - p) < 1e-9 for v, p in zip(votes, good, strict=True))
    assert min(worth.right_if_good[:3]) > worth.right_if_good[3] and got[(1, 1, 1, -1)] > 0.5 > got[(-1, -1, -1, 1)]


def test_judge(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA)
    out = rules.judge(d, ["doc_id"]).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((r[0] is None, r[0] or 0) for r in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed and r.posterior >= 0.5) for r in out)
    assert rules.judge(d.filter("doc_id < 0"), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        rules.judge(d, ["n_words"])


def test_verdict_follows_labels(spark):
    """On the given tables, without having seen a label."""
    sf = "/root/testdata/sf0.01"
    out = rules.judge(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id"]).filter("NOT base_failed")
    rates = {r.quality: (r.n, r.kept) for r in out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").groupBy("quality").agg(F.count("kept").alias("n"), F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1][0] > 100 and rates[1][1] > 0.99 and rates[0][1] < 0.1
