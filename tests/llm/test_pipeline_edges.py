"""Every stage of the pipeline on nulls, empty and long texts, repeated ids, clashing columns and empty tables."""

import random
from pathlib import Path

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no given tables")
#: Columns with the names of what the operators make.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, items string, n_words int, contaminated string, component bigint, row string, host string, ids string, `a.b` string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    words = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    long = "\n".join(words(40) for _ in range(2500))
    same = words(60)
    texts = [(0, None), (1, ""), (2, "  \n "), (3, words(30)), (4, long), (5, same), (5, same), (6, same), (None, words(40)), (None, same), (7, words(9) + "\n" + words(9))]
    return [(k, t, "en", [None, "a", "b"][i % 3], None if t is None else len(t), 0.5, "k", "z", 7, "c", 1, "r", "h", "i", f"x{i}") for i, (k, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def found(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("k", range(len(pipeline.STAGES) - 1))
def test_stage(spark, docs, rows, k):
    """Columns and their values stay, but for what the stage is there to change."""
    name, step = pipeline.STAGES[k]
    out = step(spark, docs, SF)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    got = {r["a.b"]: r for r in out.collect()}
    before = {r["a.b"]: r for r in docs.collect()}
    for key, r in got.items():
        changed = {"text", "n_chars"} if name == "lines" else set()
        assert {c: v for c, v in r.asDict().items() if c not in changed} == {c: v for c, v in before[key].asDict().items() if c not in changed}
    if name in ("lines", "decontamination"):
        assert set(got) == set(before)
    if name == "lines":
        assert got["x0"].text is None and got["x0"].n_chars is None and got["x4"].text == before["x4"].text
    if name == "near_duplicates":
        assert set(before) - set(got) in ({"x6", "x7", "x9"}, {"x5", "x7", "x9"})  # the copies of one text under three ids, one of them null
    empty = step(spark, docs.filter("doc_id < 0"), SF)
    assert empty.columns == docs.columns and empty.count() == 0


def test_packing(spark, docs, rows):
    name, step = pipeline.STAGES[-1]
    assert name == "packing"
    pieces = step(spark, docs, SF).collect()
    assert sum(r.length for r in pieces) == sum({(r.sequence_id, r.offset): r.length for r in pieces}.values())
    whole = {}
    for r in pieces:
        whole.setdefault(r.doc_id, []).append(r)
    assert [(r.start, r.length, r.doc_tokens) for r in whole[0]] == [(0, 1, 1)] == [(r.start, r.length, r.doc_tokens) for r in whole[1]]
    assert len(whole[4]) > 1 and sum(r.length for r in whole[4]) == whole[4][0].doc_tokens
    assert sum(r.length for r in whole[5]) == 2 * whole[5][0].doc_tokens and len({r.doc_id for r in pieces}) == 9
    assert step(spark, docs.filter("doc_id < 0"), SF).count() == 0
