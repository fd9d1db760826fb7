"""The queries against brute force on the smallest given tables."""

from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from regolith.llm import queries as q
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no given tables")


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return table("documents")


def test_packing(spark, docs):
    sequences = brute.check_packing(docs, [r.asDict() for r in q.op1_packing(spark, SF).collect()])
    source = {d["doc_id"]: d["source"] for d in docs}
    total, full = {}, [ps for ps in sequences.values() if sum(p["length"] for p in ps) == 2048]
    for ps in sequences.values():
        for p in ps:
            total[source[p["doc_id"]]] = total.get(source[p["doc_id"]], 0) + p["length"]
    whole = sum(total.values())
    for ps in full:  # every full sequence holds each source's share, within rounding
        for s, n in total.items():
            assert abs(sum(p["length"] for p in ps if source[p["doc_id"]] == s) - 2048 * n / whole) <= 4


def test_minhash(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in q.op2_minhash(spark, SF).collect()}
    assert got == brute.near_duplicates(docs, 3, 85)


def test_quality(spark, docs):
    labels = {r["doc_id"]: r["quality"] for r in table("labels")}
    got = {r.doc_id: r for r in q.op3_quality(spark, SF).collect()}
    assert set(got) == {d["doc_id"] for d in docs}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    known = [(got[k].predicted, y) for k, y in labels.items() if k in got]
    assert np.mean([p == y for p, y in known]) > 0.9
    unseen = [(got[k].predicted, y) for k, y in labels.items() if k in got and got[k].held_out]
    assert len(unseen) > 5 and np.mean([p == y for p, y in unseen]) > 0.9


def test_secrets(spark, docs):
    import hashlib

    for r in q.op4_secrets(spark, SF).collect():
        text = next(d["text"] for d in docs if d["doc_id"] == r.doc_id)
        want = brute.secret_spans(text)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))
        assert set(want) <= set(r.spans.split(","))


def test_ann(spark):
    rows = table("embeddings")
    v = np.array([r["embedding"] for r in rows], np.float64)
    ids = np.array([r["vec_id"] for r in rows])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = {}
    for r in q.op6_ann(spark, SF).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for i in np.flatnonzero(ids % 50 == 0):
        s = u @ u[i]
        s[i] = -np.inf
        best = ids[np.lexsort((ids, -s))[:5]]
        mine = [got[ids[i]][k] for k in range(1, 6)]
        assert all(abs(x - s[list(ids).index(j)]) < 1e-12 for j, x in mine)
        hits += len({j for j, _ in mine} & set(best.tolist()))
    assert hits / 5 / len(got) >= 0.9


def test_substrings(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in q.op8_substrings(spark, SF).collect()}
    assert got == brute.drop_repeats(docs, 50)


def test_decontamination(spark, docs):
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in q.op9_decontam(spark, SF).collect()}
    assert got == brute.contamination(docs, table("benchmark"))
    assert any(x[4] for x in got.values())


def test_phrases(spark, docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in q.op10_phrases(spark, SF).collect()}
    assert got == brute.drop_passages(docs, 13)
