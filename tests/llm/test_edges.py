"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every corpus operator."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from regolith.llm import ann, decontam, html, linededup, minhash, packing, phrases, quality, secrets, suffix
from regolith.llm import queries as q
from regolith.llm import text as tx
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, items string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    shared = words(rng, 60)
    base = words(rng, 300)
    out = [(0, None), (1, ""), (2, "   \n\t"), (3, "one"), (4, "One two"), (5, "é" * 40 + " ü"), (6, words(rng, 6000)), (7, shared)]
    for i in range(8, 40):
        t = words(rng, rng.randrange(5, 200))
        if i % 3 == 0:
            t = t + "\n" + shared + " " + words(rng, 9)
        if i % 5 == 0:
            t = t + "\npassword = 'hunter2hunter2' \U0001f600 deadbeefdeadbeef01 AKIAABCDEFGHIJKLMN1\n"
        out.append((i, t))
    for i in range(40, 75):  # a large group of near copies of one text, and exact copies
        w = base.split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append((i, " ".join(w)))
    out += [(i, base) for i in range(75, 110)]
    return [dict(zip(SCHEMA.replace(",", "").split()[::2], (i, t, "en", ["a", "b", None, "c"][i % 4] if i % 2 else "a", 1, 0.5, "k", "z"), strict=True)) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("doc_id < 0")


def test_hashes_are_of_the_bytes_alone():
    data, offsets = tx.column(__import__("pyarrow").array(["ab cd ab", "", "cd\x00 ab", None, "é ab"]))
    starts, ends, first = tx.words(data, offsets, tx.SPACES)
    h = tx.word_hashes(data, starts, ends)
    assert first.tolist() == [0, 3, 3, 5, 5, 7]
    assert h[0] == h[2] == h[4] == h[6] and h[1] != h[3]


def test_packing(spark, rows, docs, empty):
    pieces = [r.asDict() for r in q.packed(docs).collect()]
    brute.check_packing(rows, pieces)
    assert q.packed(empty).count() == 0


def test_packing_weights(spark, docs):
    out = packing.pack(docs, q.tokenizer(), 64, {"a": 3, "b": 1, "c": 1}).collect()
    seqs = {}
    for r in out:
        assert len(r.ids) == 4 * r.length
        seqs.setdefault(r.sequence_id, []).append(r)
    for k, ps in seqs.items():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [sum(x.length for x in ps[:i]) for i in range(len(ps))]
        assert sum(p.length for p in ps) == 64 or k == max(seqs)


def test_schedule_serves_all_exactly():
    for totals in ([5], [1, 1_000_003], [7, 0, 900, 13, 100_000], [10**15, 3, 10**14]):
        s = packing.Schedule(totals, None, 2048)
        ends = np.array([0, s.sequences // 2, s.sequences])
        for k, n in enumerate(totals):
            own, _ = s.at(ends, k)
            assert own[0] == 0 and own[2] == n and own[1] <= n


def test_encoder_equals_the_tokenizer():
    texts = ["a  b\n\n c\td ", "don't  stop\r\n\r\n", "<|endoftext|> x", "é\xa0ü　z 1234abc", "  ", "\n", "x\x1cy \x85 z", "\U0001f600 \U0001f600"]
    assert packing.Encoder.agrees(q.tokenizer())
    encode = packing.Encoder(q.tokenizer(), True)
    assert [[*encode(x), 1] for x in texts] == brute.encode(texts)
    rng = random.Random(1)
    more = texts + ["".join(rng.choice("ab Z09.'\n\t é\u3000\u0301\u4e2d\U0001f600\x1c\x85_-") for _ in range(300)) for _ in range(200)] + [" " * 50_000 + "x", "a" * 50_000]
    assert [[*encode(x), 1] for x in more] == brute.encode(more) and encode.fast is not None
    encode = packing.Encoder(q.tokenizer(), False)
    assert [[*encode(x), 1] for x in texts] == brute.encode(texts)
    assert 50256 in encode("hello <|endoftext|> bye")  # an added token is one id, as the tokenizer makes it


def test_encoder_splits_at_the_same_code_points():
    """Both libraries class every code point alike: beside a letter, a digit, a mark, a space and itself."""
    encode = packing.Encoder(q.tokenizer(), True)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4096):
        text = "".join(f"a{c}1{c}!{c} {c}{c} " for c in points[i : i + 4096])
        assert encode(text) == encode._sure(text)


def test_schedule_of_many_queues_holds_shares():
    rng = np.random.default_rng(5)
    totals = rng.integers(1, 400, 5000)
    s = packing.Schedule(totals, None, 2048)
    seq = np.arange(s.sequences + 1)
    before = np.zeros(len(seq), np.int64)
    for k in range(0, 5000, 7):
        own, _ = s.at(seq, k)
        assert (np.diff(own) >= 0).all() and own[-1] == totals[k]
        assert np.abs(own - np.minimum(seq * 2048, s.total) * totals[k] / s.total).max() < 3
    for k in range(40):
        own, earlier = s.at(seq, k)
        assert (earlier == before).all()
        before += own


def test_schedule_part_of():
    rng = np.random.default_rng(6)
    whole = rng.integers(1, 1 << 50, 2000)
    a, b = rng.integers(0, 1 << 50, 2000), (rng.random(2000) * whole).astype(np.int64)
    assert packing.part_of(a, b, whole).tolist() == [int(x) * int(y) // int(z) for x, y, z in zip(a, b, whole)]


def test_packing_holds_given_weights(spark):
    docs = spark.createDataFrame([(i, "a", "word " * 200) for i in range(40)] + [(100 + i, "b", "word " * 200) for i in range(40)], "doc_id bigint, source string, text string")
    out = packing.pack(docs, q.tokenizer(), 64, {"a": 3, "b": 1}).groupBy("sequence_id").agg(F.sum(F.when(F.col("doc_id") < 100, F.col("length"))).alias("a")).collect()
    early = [r.a for r in out if r.sequence_id < 100]
    assert all(abs(x - 48) <= 2 for x in early)


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, rows, docs, empty, size, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, size, percent).collect()}
    assert got == brute.near_duplicates(rows, size, percent)
    assert minhash.near_duplicates(empty, size, percent).count() == 0


def test_near_duplicates_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f")], "doc_id bigint, text string")
    got = sorted((r.doc_id or -1, r.component_id) for r in minhash.near_duplicates(df, 3, 85).collect())
    assert got == [(-1, None), (1, 1), (1, 1), (2, 1)]


def test_near_duplicates_of_two_texts_under_one_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    df = spark.createDataFrame([(1, a), (1, b), (2, a + " more"), (3, b + " more")], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.component_id, r.kept, r.n_links) for r in minhash.near_duplicates(df, 3, 85).collect())
    assert got == [(1, 1, True, 1), (1, 1, True, 1), (2, 1, False, 1), (3, 1, False, 1)]


def test_quality(spark, docs, empty):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = quality.train(docs, labels)
    out = quality.score(docs, model)
    assert out.columns == [*[c for c in docs.columns if c != "score"], "score"]
    assert out.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0 and out.count() == docs.count()
    assert quality.train(docs, labels.filter("quality = 1")) is None
    assert quality.score(docs, None).filter("score = 0.5").count() == docs.count()
    assert quality.score(empty, model).count() == 0


def test_line_crf_follows_neighbours():
    rng = np.random.default_rng(1)
    texts = ["\n".join("plain words of a text" if good else "*** ### !!!" for _ in range(rng.integers(1, 9))) for good in rng.integers(0, 2, 200)]
    label = np.array([int(t.startswith("plain")) for t in texts])
    x, length, first = quality.line_features(*tx.column(__import__("pyarrow").array(texts)))
    crf = quality.fit(x, length, first, label)
    assert ((crf.documents(x, length, first) >= 0.5) == label).mean() > 0.98


def test_secrets(spark, rows, docs, empty):
    for r in secrets.find_secrets(docs).select("doc_id", secrets.joined(["assign", "access", "hex"]).alias("s")).collect():
        text = next(x["text"] for x in rows if x["doc_id"] == r.doc_id)
        assert r.s == ",".join(brute.secret_spans(text))
    assert secrets.find_secrets(empty).count() == 0


def test_secrets_by_randomness(spark):
    import base64

    rng = random.Random(3)
    rand = [base64.b64encode(rng.randbytes(30)).decode().rstrip("=") for _ in range(60)]
    plain = ["aaaaaaaaaa1111111111aaaaaaaaaa111111111", "abcdefghijklmnopqrst0123456789uvwxyz" * 2, "version1version1version1version1version1"]
    df = spark.createDataFrame([(i, f"x {t} y") for i, t in enumerate(rand + plain * 10)], "doc_id bigint, text string")
    found = {r.doc_id: [x.s for x in r.random] for r in secrets.find_secrets(df).collect()}
    assert sum(found[i] == [t] for i, t in enumerate(rand)) >= 50
    assert not any(found[i] for i in range(60, 90))


def test_secrets_after_names_and_in_paths(spark):
    rng = random.Random(4)
    make = lambda n, more="": "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + more) for _ in range(n))
    frames = [("AWS_SECRET_KEY={}", "", 40), ("x &sig={}&y=1", "", 26), ("example/v1_a/{}", "", 26), ("example/v1/{}", "_-", 30), ("my_old-name_{}", "+/", 30), ("q={}", "", 18)]
    rows = []
    for frame, more, n in frames * 20:
        token = make(n, more) + ("==" if n == 18 else "")
        rows.append((len(rows), frame.format(token), token, frame.index("{")))
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    found = {r.doc_id: r.random for r in secrets.find_secrets(df).collect()}
    for k in range(6):
        hits = [any(x.a <= at and x.b >= at + len(token) for x in found[i]) for i, _, token, at in rows[k::6]]
        assert sum(hits) >= 14, frames[k]
    for i, text, *_ in rows:
        assert all(x.s == text[x.a : x.b] for x in found[i])
        assert all(x.b <= y.a for x, y in zip(found[i], found[i][1:], strict=False))


def test_lines(spark, rows, docs, empty):
    shared = "the common line"
    df = docs.withColumn("text", F.when(F.col("doc_id") > 5, F.concat("text", F.lit(f"\n{shared}\n\n"))).otherwise(F.col("text")))
    out = {r.doc_id: r for r in linededup.drop_common_lines(df, 0.2, 5, n_dropped="kept").collect()}
    before = {r.doc_id: r.text for r in df.collect()}
    lines = {}
    source = {r["doc_id"]: r["source"] for r in rows}
    for k, t in before.items():
        for x in set(t.split("\n")) if t is not None else ():
            lines.setdefault((source[k], x), set()).add(k)
    pages = {s: sum(v == s for v in source.values()) for s in set(source.values())}
    for k, t in before.items():
        want = None if t is None else "\n".join(x for x in t.split("\n") if not x.strip(" ") or not (len(lines[source[k], x]) >= 5 and len(lines[source[k], x]) > 0.2 * pages[source[k]]))
        assert out[k].text == want
    assert linededup.drop_common_lines(empty, 0.2, 5).count() == 0
    assert linededup.drop_common_lines(docs).columns == docs.columns


def test_substrings(spark, rows, docs, empty):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffix.drop_repeats(docs).collect()}
    assert got == brute.drop_repeats(rows, 50)
    assert suffix.drop_repeats(empty).count() == 0


def test_suffix_array():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab\0") for _ in range(rng.randrange(1, 60))).encode() for _ in range(40)] + [b"abab" * 10] * 3
    sa = suffix.SuffixArray(texts, 50)
    suffixes = [t[i:] for t in texts for i in range(len(t))]
    assert [suffixes[i] for i in sa.order] == sorted(suffixes)
    for k in range(1, len(suffixes)):
        a, b = suffixes[sa.order[k - 1]], suffixes[sa.order[k]]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert sa.common[k] == min(n, 50)


def test_suffix_arrays_are_merged(monkeypatch):
    rng = random.Random(4)
    texts = list({"".join(rng.choice("ab") for _ in range(rng.randrange(8, 20))).encode() for _ in range(60)})
    docs = np.arange(len(texts))[::-1].copy()
    sizes = np.array([len(t) - 7 for t in texts])
    whole = suffix.first_documents(texts, sizes, docs, 8)
    monkeypatch.setattr(suffix, "MOST", 100)
    assert sorted(suffix.first_documents(texts, sizes, docs, 8)) == sorted(whole) and whole


def test_phrases(spark, rows, docs, empty):
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in phrases.drop_passages(docs).collect()}
    assert got == brute.drop_passages(rows, 13)
    assert phrases.drop_passages(empty).count() == 0


def test_repeated_ids_are_not_smaller(spark):
    t = words(random.Random(8), 30)
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (2, t)], "doc_id bigint, text string")
    for out in (suffix.drop_repeats(df), phrases.drop_passages(df)):
        assert sorted((r.doc_id or 9, r.n_removed > 0) for r in out.collect()) == [(1, False), (1, False), (2, True), (9, True)]


def test_contamination(spark, rows, docs, empty):
    items = [{"item_id": 1, "text": rows[7]["text"][:200]}, {"item_id": 2, "text": "one"}, {"item_id": 3, "text": None}, {"item_id": 4, "text": "..."}, {"item_id": 5, "text": rows[20]["text"]}]
    bench = spark.createDataFrame([tuple(x.values()) for x in items], "item_id bigint, text string")
    out = decontam.contamination(docs, bench)
    got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in out.collect()}
    assert got == brute.contamination(rows, items)
    assert decontam.contamination(empty, bench).count() == 0
    assert decontam.contamination(docs, bench.limit(0)).filter("n_hit > 0 OR contaminated").count() == 0


def test_phrase_and_proximity_matches(spark):
    w = [f"t{i}" for i in range(13)]
    far = w[:5] + ["new"] + w[5:9] + ["other"] + w[10:]
    df = spark.createDataFrame([(1, "x y " + " ".join(w)), (2, " ".join(far)), (3, "t0 t5 t9")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, " ".join(w))], "item_id bigint, text string")
    exact = decontam.match_phrases(df, bench).collect()
    assert [(r.doc_id, r.item_id, r.start, r.kind) for r in exact] == [(1, 7, 2, "phrase")]
    near = decontam.match_phrases(df, bench, slop=2, missing=2).filter("kind = 'proximity'").select("doc_id").distinct().collect()
    assert {r.doc_id for r in near} == {1, 2}


def test_nearest_with_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7 + 1), float(i % 5), 1.0]) for i in range(60)]
    odd = [(100, None), (150, []), (200, [0.0, 0.0, 0.0]), (250, [nan, 1.0, 1.0]), (300, [inf, 1.0, 1.0]), (350, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(good + odd, "vec_id bigint, embedding array<float>")
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 50 = 0"), 5, shard=16).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    u = {i: np.array(v) / np.linalg.norm(v) for i, v in good}
    assert set(got) == {0, 50}
    for k, mine in got.items():
        want = sorted(((round(-float(u[k] @ u[i]), 9), i) for i in u if i != k))[:5]
        assert [(round(-s, 9), i) for _, i, s in sorted(mine)] == want
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x("</p>")</script></head><body><header>Site name</header><nav><ul><li><a href=x>Home</a></ul></nav>
<div class="ad">Buy this now</div><div id=cookie-notice>We use cookies</div><article><h1>Head &amp; line</h1><p>First <b>bold</b> text&nbsp;here.<br>More
 text.<p>Second &lt;para&gt;<aside>side</aside><form>Name <input name=q></form><div class=comments><p>Nice post!</p></div></article><aside>links</aside><footer>&copy; me</footer></body></html>"""


def test_html(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "old"), (2, "u", None, ""), (3, "u", "", ""), (4, "u", "<p>unclosed <b>text", ""), (5, "u", "<nav>menu</nav>", ""), (6, "u", "a < b && c > d", "")], "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in html.main_text(df).collect()}
    assert got[1] == "Head & line\n\nFirst bold text here. More text.\n\nSecond <para>"
    assert got[2] == got[3] == got[5] == "" and got[4] == "unclosed text"
    assert html.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("wrapper", ['<div class="layout has-sidebar">', '<div class="container no-sidebar">', '<div class="sidebar">', '<form id="search">'])
def test_html_keeps_articles_in_named_wrappers(wrapper):
    body = "<article><h1>Title</h1><section class=social-history><p>" + "The history of a town. " * 9 + "</p></section><section class=search-results><p>What the search found.</p></section>"
    page = f"<body><div class=main-nav>Home About</div>{wrapper}{body}<div class=share-buttons>Share this</div></article></{wrapper[1:].split()[0]}><div class=site-footer>Us</div></body>"
    want = "Title\n\n" + ("The history of a town. " * 9).strip() + "\n\nWhat the search found."
    assert html.extract(page, html.Weights()) == want


def test_html_keeps_most_of_a_page_without_article():
    text = "A long story about the sea. " * 20
    page = f"<body><nav>Home</nav><div class='page search'><p>{text}</p></div><div class=related>Other stories</div></body>"
    assert html.extract(page, html.Weights()) == text.strip()


def test_crc_matches_zlib(spark):
    assert spark.range(1).select(F.crc32(F.lit("7"))).first()[0] == zlib.crc32(b"7")


def test_html_best_region_is_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(50):
        tokens = [html.Token("p", "", False, False, False, False) if x < 0.5 else html.Token("", "word " * int(9 * x), False, False, x > 0.9, False) for x in rng.random(30)]
        w = html.Weights(tags={("free", ""): -float(rng.integers(1, 8)), ("content", ""): 0.0, ("out", ""): 0.0})
        score = [w.score(t) for t in tokens]
        best = max(sum(score[i:j]) for i in range(31) for j in range(i, 31))
        a, b = html.best_region(tokens, w)
        assert abs(sum(score[a:b]) - best) < 1e-9


def test_html_region_follows_the_weights():
    page = "<body><div>beside it</div><article><h1>T</h1><p>one two three</p><p>four <b>five</b></p></article><div>more</div></body>"
    learned = html.learn(html.counts(page))
    assert html.extract(page, learned) == html.extract(page, html.Weights()) == "T\n\none two three\n\nfour five"
    absurd = html.Weights(words={k: 0.1 for k in learned.words}, tags={k: -50.0 for k in learned.tags})
    assert html.extract(page, absurd) == "one two three"


def test_html_learns_from_hidden_labels():
    page = "<body><ul><li><a>Home</a></li><li><a>News</a></li></ul>{}<h1>Title</h1><p>one two three</p><p>four</p>{}<ul><li><a>Next</a></li></ul></body>"
    w = html.learn(html.counts(page.format("<article>", "</article>")))
    assert html.extract(page.format("", ""), w) == html.extract(page.format("<article>", "</article>"), w) == "Title\n\none two three\n\nfour"


@pytest.mark.parametrize("inner", ['<div class="share-price">1 2</div>', '<section class="notice-of-results">1 2</section>', "<header><p>1 2</p></header>"])
def test_html_drops_nothing_else_inside_articles(inner):
    page = f"<nav>menu</nav><article><h1>T</h1>{inner}<aside>no</aside><div class='comments'><p>Nice</p></div><p>end</p></article><footer>x</footer>"
    assert html.extract(page, html.Weights()) == "T\n\n1 2\n\nend"


def test_html_short_articles_and_pages_without_one():
    assert html.extract("<nav>a b c</nav><article><h1>T</h1><p><b>T<br></article><footer>long foot of many words</footer>", html.Weights()) == "T\n\nT"
    assert html.extract("<h1>A heading</h1><p>First para words words words words.</p><p>Second one</p>", html.Weights()) == "A heading\n\nFirst para words words words words.\n\nSecond one"
    assert html.extract("<header class=site><a href=/>Home</a><nav>x</nav></header><div class=post><header><h1>T</h1></header><p>Body text</p></div>", html.Weights()) == "T\n\nBody text"


def test_html_long_and_repeated_pages(spark):
    long = "<nav>x</nav><article>" + "<p>word &amp; word</p>" * 60_000 + "</article>"
    got = [r.text for r in html.main_text(spark.createDataFrame([(1, long), (1, long), (2, "<article>a</article>")], "page_id bigint, html string")).collect()]
    assert sorted(got) == sorted(["\n\n".join(["word & word"] * 60_000)] * 2 + ["a"])


def test_nearest_over_many_shards(spark):
    rng = np.random.default_rng(11)
    v = rng.normal(size=(1200, 24))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(7, v[8].tolist())], "vec_id bigint, embedding array<double>")
    got = ann.nearest(df, df.filter("vec_id % 20 = 0"), k=5, shard=100).collect()
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    for i in range(0, 1200, 20):
        s = u @ u[i]
        s[i] = -2
        s[7] = max(s[7], s[8]) if i != 7 else s[7]
        hits += len({r.vec_id for r in got if r.query_id == i} & set(np.lexsort((np.arange(1200), -s))[:5].tolist()))
    assert len(got) == 300 and hits / 300 >= 0.9


def test_nearest_takes_repeated_queries_with_other_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.1])], "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(9, [1.0, 0.0]), (9, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.score for r in ann.nearest(df, asked, k=3).collect()}
    assert got[1] == got[2] == 1.0 and len(got) == 3


def test_secrets_reported_are_seldom_false(spark):
    """Structured strings far outnumber random ones; hardly any is reported, and most random ones are."""
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    real = ["".join(rng.choice(letters) for _ in range(24)) for _ in range(200)]
    words = ["item", "page", "View", "Model", "data", "Index", "file", "Name", "user", "Test"]
    false = ["".join(rng.choice(words) for _ in range(6))[:22] + f"{rng.randrange(100):02}" for _ in range(2000)]
    rows = [(i, x) for i, x in enumerate(real + false)]
    got = {r.doc_id for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() if r.random}
    wrong = len([i for i in got if i >= 200])
    assert len(got) - wrong >= 170 and wrong <= 0.15 * len(got)


def _names(rng, n):
    """Names of methods with two digits, 20 to 31 characters."""
    words = "User Order Item By Identifier Account Name From Config Request Handler Value Manager Index Client Session Update Response Service Factory".split()
    out = []
    while len(out) < n:
        name = rng.choice(["get", "set", "find", "load", "make"]) + "".join(rng.choice(words) for _ in range(rng.choice([2, 3, 3, 4]))) + str(rng.randrange(10, 99))
        out += [name] if 20 <= len(name) < 32 else []
    return out


@pytest.mark.parametrize(("false", "real"), [(300, 0), (1500, 0), (1500, 150), (0, 3)])
def test_secrets_among_names(spark, false, real):
    """No table of names alone reports more than a few; most random strings among ten times as many names are found, with few names beside them."""
    rng = random.Random(false + real)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = [(-1 - i, "".join(rng.choice(letters) for _ in range(22)) + "a1") for i in range(real)] + list(enumerate(_names(rng, false)))
    got = [r.doc_id for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() if r.random]
    wrong = sum(i >= 0 for i in got)
    assert wrong <= (3 if not real else 0.1 * len(got)) and len(got) - wrong >= 0.5 * real


def test_secrets_ignore_other_columns(spark):
    rows = [(1, "token=abcdefghijkl012345", [3], "x", 2), (2, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, hex array<int>, strings string, tested int")
    got = {r.doc_id: r for r in secrets.find_secrets(df).collect()}
    assert [len(got[1][k]) for k in ("assign", "access", "hex", "random")] == [1, 0, 0, 0] and not any(got[2][k] for k in ("assign", "hex", "random"))


def test_secrets_in_long_texts_take_time_near_their_length(spark):
    """Base spans and candidates beside each other, and one string of many parts, in more than one block of every fold."""
    import time

    rng = random.Random(6)
    make = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    lower = "abcdefghijklmnopqrstuvwxyz0123456789"
    tokens = [make(24, lower + lower[:26].upper()) for _ in range(3000)]
    mixed = " ".join(make(20, "0123456789abcdef") + " " + t for t in tokens)
    path = "/".join(make(24, lower + "_") for _ in range(3000))
    began = time.time()
    got = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame([(1, mixed), (2, path), (3, "a1B2" * 50_000)], "doc_id bigint, text string")).collect()}
    assert time.time() - began < 60
    assert len(got[1].hex) == 3000 and len(got[1].random) > 2700
    for text, r in ((mixed, got[1]), (path, got[2])):
        assert all(text[x.a : x.b] == x.s for x in [*r.hex, *r.random])
        assert all(x.b <= y.a for x, y in zip(r.random[:-1], r.random[1:], strict=True))
    assert len(got[2].random) > 1000 and not got[3].random


def test_secrets_in_a_long_text_of_many_matches(spark):
    text = "token=abcdefghijkl012345 0123456789abcdef0123 " * 3000
    r = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [len(r[k]) for k in ("assign", "access", "hex")] == [3000, 0, 3000]


def test_contamination_of_random_words_is_brute_force(spark):
    """Few words, so that rare and frequent terms, repeats, short items and overlaps all come; also proximity."""
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("ABCdef") for _ in range(n))
    rows = [{"doc_id": i, "text": text(rng.randrange(0, 60))} for i in range(60)] + [{"doc_id": 60, "text": None}]
    items = [{"item_id": i, "text": text(rng.choice([0, 1, 2, 4, 5, 6]))} for i in range(12)] + [{"item_id": 12, "text": "a zz b"}]
    docs, bench = (spark.createDataFrame([tuple(r.values()) for r in x], f"{k} bigint, text string") for x, k in ((rows, "doc_id"), (items, "item_id")))
    got = {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), r.contaminated) for r in decontam.contamination(docs, bench, length=4).collect()}
    want = brute.contamination(rows, items, length=4)
    assert got == {k: (a, b, c, e) for k, (a, b, c, _, e) in want.items()}

    near = {(r.doc_id, r.item_id, r.start, r.n_terms) for r in decontam.match_phrases(docs, bench, length=4, slop=1, missing=1).collect() if r.kind == "proximity"}
    told = set()
    for d in rows:
        own = brute.lower(d["text"]).split()
        for b in items:
            words = brute.lower(b["text"]).split()
            for i in range(max(len(words) - 4, 0) + 1 if words else 0):
                w = words[i : i + 4]
                for s in range(len(own)):
                    n = sum(x in own[max(0, s + k - 1) : max(0, s + k + 2)] for k, x in enumerate(w))
                    if n and n >= len(w) - 1:
                        told.add((d["doc_id"], b["item_id"], s, n))
    assert near == told


def test_quality_with_null_and_conflicting_labels_and_long_texts(spark):
    good, bad = "A plain line of words, as people write them.\n" * 8, "$$$ !!! ### 1234\n@@@ %%% ^^^\n" * 8
    rows = [(i, good if i % 2 else bad) for i in range(60)] + [(60, good * 4000), (61, None), (None, good)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (2, None), (None, 1), (60, 1)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert len(got) == 63 and all(0 <= x <= 1 for x in got.values())
    assert all((got[i] > 0.5) == bool(i % 2) for i in range(40, 60)) and got[60] > 0.5


def test_one_word_in_every_position_is_dealt_out(spark):
    """The positions of a word that is everywhere are written by many tasks, and its windows are found."""
    text = "same " * 40
    docs = spark.createDataFrame([(i, text if i % 2 else f"{text} other{i}") for i in range(300)], "doc_id bigint, text string").repartition(150)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = decontam.build_index(docs, "doc_id", "text")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    placed = index.buckets.select("bucket", F.input_file_name().alias("file"))
    hot = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files")).orderBy(F.desc("rows")).first()
    assert hot.rows > 100 and hot.files > 4
    bench = spark.createDataFrame([("x", "same " * 13), ("y", "same other2")], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontam.contamination(docs, bench).collect()}
    assert got == {i: (40, 40, ["x"]) if i % 2 else (41, 41 if i == 2 else 40, ["x", "y"] if i == 2 else ["x"]) for i in range(300)}


def test_neighbours_in_a_shard_of_full_size():
    """Vectors without any clusters, asked by others that the graph doesn't hold, as most shards are: recall at the query's own parameters."""
    import inspect

    given = {k: v.default for k, v in inspect.signature(ann.nearest).parameters.items()}
    rng = np.random.default_rng(5)
    v = rng.normal(size=(given["shard"] + 100, 64))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    held, asked = v[100:], v[:100]
    graph, entry = ann.build(held, given["degree"], given["beam"] // 2)
    found, _ = ann.search(held, graph, entry, asked, given["beam"])
    true = np.argsort(-(asked @ held.T), axis=1)[:, :5]
    assert np.mean([len(set(a[:5]) & set(b)) / 5 for a, b in zip(found.tolist(), true.tolist(), strict=True)]) >= 0.95
