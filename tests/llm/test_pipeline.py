"""The pipeline's stages, each against plain Python on what its predecessor kept."""

from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from regolith.llm import queries as q
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no given tables")


def test_stages(spark, tmp_path):
    docs = q.read(spark, SF, "documents")
    kept = [docs]
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, kept[-1], SF)
        out.write.parquet(str(tmp_path / str(k)))
        kept.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < 4:
            assert out.columns == docs.columns
    rows = [[r.asDict() for r in df.collect()] for df in kept]
    texts = [{r["doc_id"]: r for r in x} for x in rows[:5]]

    quality = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    gone = set(texts[0]) - set(texts[1])
    assert gone and all(quality.get(d) != 1 for d in gone) and not any(quality.get(d) == 0 for d in texts[1])

    pages, lines = Counter(r["source"] for r in rows[1]), defaultdict(int)
    for r in rows[1]:
        for x in set(r["text"].split("\n")):
            lines[r["source"], x] += 1
    for r in rows[1]:
        bad = lambda x, s=r["source"]: x.strip(" ") and lines[s, x] >= q.LINE_PAGES and lines[s, x] > q.LINE_RATIO * pages[s]
        want = "\n".join(x for x in r["text"].split("\n") if not bad(x))
        assert texts[2][r["doc_id"]]["text"] == want and texts[2][r["doc_id"]]["n_chars"] == len(want)

    near = brute.near_duplicates(rows[2], 5, 80)
    assert set(texts[3]) == {k for k, (_, _, kept_) in near.items() if kept_} and len(texts[3]) < len(texts[2])

    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    assert set(texts[4]) == {k for k, v in brute.contamination(rows[3], items).items() if not v[4]}

    brute.check_packing(rows[4], rows[5])
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.select(*sorted(whole.columns)).collect())) == sorted(map(tuple, kept[-1].select(*sorted(whole.columns)).collect()))


def test_pipeline_takes_an_empty_table(spark):
    docs = q.read(spark, SF, "documents").filter(F.lit(False))
    for _, step in corpus_pipeline.STAGES[:4]:
        docs = step(spark, docs, SF)
        assert docs.count() == 0


def test_copies_keep_their_lines(spark):
    rows = [(i, "first line\nsecond line", "en", "a", 22) for i in range(30)] + [(i, f"own {i}\nthe footer", "en", "a", 9) for i in range(30, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_lines(spark, docs, SF).collect()}
    assert got == {i: ("first line\nsecond line", 22) if i < 30 else (f"own {i}", 6) for i in range(60)}


def test_null_and_repeated_ids_in_near_duplicates(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(None, a), (1, b), (1, b), (1, c), (None, b), (None, d), (None, d), (2, c + " more"), (3, ""), (3, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 9) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert out.columns == docs.columns
    assert got == Counter([(None, a), (1, b), (1, c), (None, d), (3, ""), (3, ""), (None, None)])
