"""The corpus operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regolith.llm import ann, collocations, decontam, html, linededup, minhash, packing, phrases, quality, resample, rules, secrets, suffix

LINE_RATIO, LINE_PAGES = 0.02, 5
ACCEPT = 0.3


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer() -> str:
    """The path of the public vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def packed(docs: DataFrame) -> DataFrame:
    out = packing.pack(docs, tokenizer(), length=2048, end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), size=3, percent=85)


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def line_model(docs: DataFrame, labels: DataFrame) -> quality.LineCrf | None:
    """Fitted on rows that aren't held out."""
    return quality.train(docs.select("doc_id", "text"), labels.filter(~held_out()))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, line_model(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents"))
    base = [k for k, *_ in secrets.FORMATS]
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined([*base, "random"]).alias("spans"),
    )


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings")
    return ann.nearest(table, table.filter(F.col("vec_id") % 50 == 0), k=5)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linededup.drop_common_lines(docs, LINE_RATIO, LINE_PAGES, n_dropped="n_dropped").select("doc_id", "text", "n_dropped")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.drop_repeats(read(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.contamination(docs, read(spark, sf_dir, "benchmark"), length=13, per_hit=20)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrases.drop_passages(read(spark, sf_dir, "documents"), length=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.judge(read(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return out.select("doc_id", *rules.FEATURES[:5], "base_failed", "kept")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (read(spark, sf_dir, t) for t in ("documents", "benchmark"))
    out = resample.resample(docs.select("doc_id", "text"), target.select("text"), ["doc_id"], percent=25)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents").select("text", "lang"), longest=4, min_count=30, first=2000, inside=80)


def queries() -> dict:
    import corpus_pipeline

    own = (op1_packing, op2_minhash, op3_quality, op4_secrets, op5_html, op6_ann, op7_lines, op8_substrings, op9_decontam, op10_phrases, op11_rules, op12_resample, op13_collocations)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


_LINES = f"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS h, text, string_split(text, chr(10)) AS lines FROM documents),
pages AS (SELECT h, count(*) AS pages FROM d GROUP BY h),
l AS (SELECT h, unnest(list_distinct(lines)) AS line FROM d),
bad AS (SELECT l.h, line FROM l JOIN pages USING (h) WHERE trim(line) <> '' GROUP BY l.h, line, pages
        HAVING count(*) >= {LINE_PAGES} AND count(*) > {LINE_RATIO}::DOUBLE * pages),
lists AS (SELECT h, list(line) AS bad FROM bad GROUP BY h),
kept AS (SELECT doc_id, text, lines, CASE WHEN bad IS NULL THEN lines ELSE list_filter(lines, lambda x: trim(x) = '' OR NOT list_contains(bad, x)) END AS k
         FROM d LEFT JOIN lists USING (h))
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(k, chr(10)) END AS text,
  CAST(coalesce(len(lines) - len(k), 0) AS BIGINT) AS n_dropped FROM kept
"""


def _votes_sql() -> str:
    """Features, base and votes by the same conditions as the operator's, then its steps as a recursion over one row."""
    n, prior = len(rules.RULES), rules.PRIOR_VOTES
    rate = lambda right, wrong, start: f"({right} + {start * prior}) / ({right} + {wrong} + {prior})"
    total = lambda x, j, v: f"coalesce(sum({x}) FILTER (v[{j}] = {v}), 0)"
    each = lambda x, right, start: ", ".join(rate(total(x, j, right), total(x, j, -right), start) for j in range(1, n + 1))
    start = lambda x: f"[{', '.join([str(x)] * n)}]::DOUBLE[]"
    good = "1 / (1 + exp(-(ln(share / (1 - share)) + list_sum(list_transform(v, lambda x, i: CASE WHEN x = 1 THEN ln(a[i] / (1 - b[i])) WHEN x = -1 THEN ln((1 - a[i]) / b[i]) ELSE 0 END)))))"
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
w AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM l WHERE len(words) >= 3),
again AS (SELECT r, unnest(list(i)) AS i FROM w GROUP BY r, words[i], words[i + 1], words[i + 2] HAVING count(*) > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(3) t(k) GROUP BY r),
f AS (SELECT l.r, doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(regexp_extract_all(text, '{rules.SYMBOL}')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
  length(regexp_replace(text, '{rules.NO_LETTER}', '', 'g')) AS n_letters, len(lines) AS n_lines, len(regexp_extract_all(text, '[.!?]')) AS n_ends
  FROM l LEFT JOIN repeated USING (r)),
b AS (SELECT *, {rules.BASE} AS base_failed, [{", ".join(r.sql() for r in rules.RULES)}] AS v FROM f),
entries AS (SELECT v, count(*)::DOUBLE AS n FROM b WHERE NOT base_failed GROUP BY v),
em AS (SELECT 0 AS k, {rules.SHARE}::DOUBLE AS share, {start(rules.RIGHT_IF_GOOD)} AS a, {start(rules.RIGHT_IF_BAD)} AS b
  UNION ALL
  SELECT k + 1, {rate("sum(g)", "sum(h)", rules.SHARE)}, [{each("g", 1, rules.RIGHT_IF_GOOD)}], [{each("h", -1, rules.RIGHT_IF_BAD)}]
  FROM (SELECT k, v, n * p AS g, n * (1 - p) AS h FROM (SELECT k, v, n, {good} AS p FROM em, entries WHERE k < {rules.STEPS})) GROUP BY k),
last AS (SELECT share, a, b FROM em ORDER BY k DESC LIMIT 1)
SELECT doc_id, {", ".join(f"{x}::BIGINT AS {x}" for x in rules.FEATURES[:5])}, base_failed, NOT base_failed AND {good.replace("b[", "last.b[")} >= 0.5 AS kept FROM b, last
"""



#: The checksum's table is made from its polynomial, and every distinct feature's bytes are folded through it.
_RESAMPLE = r"""
WITH slot AS (SELECT list(list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) s(i)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT r, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS x FROM d),
ef AS (SELECT unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS x FROM e),
x AS (SELECT x, hex(x) AS h FROM (SELECT x FROM df UNION SELECT x FROM ef)),
bytes AS (SELECT x, list_transform(range(1, len(h), 2), lambda i: (16 * (instr('0123456789ABCDEF', h[i]) - 1) + instr('0123456789ABCDEF', h[i + 1]) - 1)::UBIGINT) AS b FROM x),
bucket AS (SELECT x, xor(list_reduce(list_prepend(4294967295::UBIGINT, b), lambda c, y: xor(c >> 8, t[((xor(c, y) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 10000 AS k FROM bytes, slot),
s AS (SELECT k, count(*) AS s FROM df JOIN bucket USING (x) GROUP BY k), t AS (SELECT k, count(*) AS t FROM ef JOIN bucket USING (x) GROUP BY k),
gain AS (SELECT k, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000) / ((coalesce(s, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS g FROM s FULL JOIN t USING (k)),
w AS (SELECT r, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN bucket USING (x) JOIN gain USING (k) GROUP BY r),
scored AS (SELECT r, doc_id, len(w) AS n, 2 * len(w) - CASE WHEN len(w) > 0 THEN 1 ELSE 0 END AS n_features, coalesce(weight, 0) AS weight,
  list_reduce(list_transform(range(1, 9), lambda i: (instr('0123456789abcdef', sha256('7:' || doc_id)[i]) - 1)::BIGINT), lambda a, b: 16 * a + b) AS h FROM d LEFT JOIN w USING (r)),
ranked AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
able AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS many FROM ranked WHERE n >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * many // 100 THEN place END AS rank FROM ranked LEFT JOIN able USING (r)
"""

_COLLOCATIONS = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase FROM w, range(1, 5) t(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
cuts AS (SELECT lang, k, phrase, a, j, array_to_string(string_split(phrase, ' ')[1 : j], ' ') AS head, array_to_string(string_split(phrase, ' ')[j + 1 : k], ' ') AS tail FROM f, range(1, 4) t(j) WHERE j < k),
scored AS (SELECT c.*, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score FROM cuts c JOIN f x ON c.lang = x.lang AND c.head = x.phrase JOIN f y ON c.lang = y.lang AND c.tail = y.phrase),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_parts AS (SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(string_split(phrase, ' ')[i : i + m - 1], ' '))) AS phrase FROM f, range(2, 4) t(m) WHERE m < k),
most AS (SELECT lang, phrase, max(a) AS most FROM inner_parts GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN most USING (lang, phrase) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return {"op7_lines": _LINES, "op11_rules": _votes_sql(), "op12_resample": _RESAMPLE, "op13_collocations": _COLLOCATIONS} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
