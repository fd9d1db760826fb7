"""Secrets in texts: fixed formats and a battery of randomness tests, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regolith.session import stage

#: Formats (fixed values): kind, pattern, group whose length counts, least length.
FORMATS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),  # the maximal runs of [0-9a-f] with 16 or more
)
#: Strings that the tests look at, with = only as padding (of 20 characters with it; 14 of an encoding hold enough bits).
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}+(?:=++(?![A-Za-z0-9+/_-]))?|(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{14,19}+=++(?![A-Za-z0-9+/_-])"
#: Where a string that fits no encoding is also cut: it has + or / together with _ or -, and either kind may be between words.
CUTS = (r"/", r"[_-]")
#: Encodings by the first pattern that fits: name, pattern, alphabet.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("base36", r"^[a-z0-9]+$", _LOWER + _DIGITS),
    ("BASE36", r"^[A-Z0-9]+$", _UPPER + _DIGITS),
    ("base62", r"^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    ("base64", r"^[A-Za-z0-9+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: Level of the false-discovery control; bits that a string must be able to hold; bins of -log p.
LEVEL, MIN_BITS, BINS_PER_UNIT, BINS = 0.05, 80.0, 10, 600
#: The last bins of p above 0.5, 0.1 and 0.01: the first tell how many strings are random, the others how fast structured ones thin out.
HALF, TENTH, HUNDREDTH = 6, 22, 45


SPANS = "array<struct<a:bigint,b:bigint,s:string>>"
#: Elements that one fold appends to; a longer array is folded in blocks of so many, so that the time stays near its length.
BLOCK = 512


def let(value: Column, use) -> Column:
    """``use`` of the value, which is computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blocks(values: Column, size: int = BLOCK) -> Column:
    """The array cut into arrays of ``size`` elements, the last one shorter; none of an empty array."""
    cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / size).cast("int")), lambda i: F.slice(v, i * size + 1, F.lit(size)))
    return let(values, lambda v: F.filter(cut(v), lambda x: F.size(x) > 0))


def scan(values: Column, state: Column, step) -> Column:
    """struct<state, out>: the state after all elements and the spans that the steps gave on the way.

    ``step`` maps a state and an element to the next state, whether a span comes out, and that span.
    """
    none = F.array().cast(SPANS)

    def one(acc, x):
        after, gives, span = step(acc["state"], x)
        return F.struct(after.alias("state"), F.when(gives, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def block(acc, part):
        done = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return let(done, lambda d: F.struct(d["state"].alias("state"), F.array_append(acc["out"], d["out"]).alias("out")))

    start = F.struct(state.alias("state"), F.array().cast(f"array<{SPANS}>").alias("out"))
    return F.aggregate(blocks(values), start, block, lambda acc: F.struct(acc["state"].alias("state"), F.flatten(acc["out"]).alias("out")))


def spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<a, b, s>> of the matches, left to right without overlap, whose ``group`` has ``least`` characters.

    A match begins where the text before it ends: the pieces between matches and the matches give all places in code points.
    """
    regex = F.lit(pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    value = F.regexp_extract_all(text, regex, F.lit(group))
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    zipped = F.zip_with(F.arrays_zip(pieces.alias("p"), whole.alias("w")), value, lambda x, v: F.struct(F.length(x["p"]).alias("p"), x["w"].alias("w"), v.alias("v")))

    def step(at, x):
        a = at + x["p"]
        b = a + F.length(x["w"])
        return b, F.length(x["v"]) >= least, F.struct(a.alias("a"), b.alias("b"), x["w"].alias("s"))

    return F.when(text.rlike(pattern), scan(zipped, F.lit(0).cast("long"), step)["out"]).otherwise(F.array().cast(SPANS))


def _erfc(x: Column) -> Column:
    """Complementary error function for x >= 0 (Abramowitz and Stegun 7.1.26; the constants are fixed values)."""
    t = 1 / (1 + 0.3275911 * x)
    return t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x)


def parts(x: Column) -> Column:
    """The array of a string and, if it fits no encoding, its parts of 20 characters between cuts of either kind."""

    def cut(pattern: str) -> Column:
        def step(at, piece):
            b = at + F.length(piece)
            return b + 1, F.length(piece) >= 20, F.struct(at.alias("a"), b.alias("b"), piece.alias("s"))

        return scan(F.split(x["s"], pattern, -1), x["a"], step)["out"]

    odd = x["s"].rlike("[+/]") & x["s"].rlike("[_-]")
    return F.when(odd, F.concat(F.array(x), *[cut(p) for p in CUTS])).otherwise(F.array(x))


def union(found: Column) -> Column:
    """The array of spans with those that overlap as one, in order."""

    def step(last, x):
        more = F.when(x["b"] > last["b"], F.concat(last["s"], F.substr(x["s"], (last["b"] - x["a"] + 1).cast("int")))).otherwise(last["s"])
        one = F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"), more.alias("s"))
        apart = last["a"].isNull() | (x["a"] >= last["b"])
        return F.when(apart, x).otherwise(one), apart & last["a"].isNotNull(), last

    none = F.lit(None).cast("bigint")
    start = F.struct(none.alias("a"), none.alias("b"), F.lit(None).cast("string").alias("s"))
    whole = let(scan(F.array_sort(found), start, step), lambda d: F.array_append(d["out"], d["state"]))
    return F.when(F.size(found) > 0, whole).otherwise(F.array().cast(SPANS))


def apart(found: Column, others: Column) -> Column:
    """The array of those spans that overlap none of the others, which are in order and disjoint.

    A span asks the blocks of others that it may reach, then the spans of those.
    """
    ranges = let(blocks(others, 64), lambda v: F.transform(v, lambda x: F.struct(F.get(x, F.lit(0))["a"].alias("a"), F.element_at(x, -1)["b"].alias("b"), x.alias("x"))))
    meets = lambda x, y: (y["a"] < x["b"]) & (x["a"] < y["b"])
    return F.flatten(F.transform(F.array(ranges), lambda v: F.filter(found, lambda x: ~F.exists(v, lambda r: meets(x, r) & F.exists(r["x"], lambda y: meets(x, y))))))


def battery(token: Column) -> Column:
    """struct<encoding, n, p>: p is the probability that random characters of the encoding look as odd as the string.

    Four scores: a chi-squared sum over capitals, small letters and the rest (short strings fill these cells, if not those of
    single characters), the chi-squared sum of single characters within these, runs above and below the alphabet's middle,
    and the correlation of neighbours. The last three are about standard normal for random strings; their squares and the
    first sum add up to a chi-squared sum of three degrees of freedom and one less than there are classes in the alphabet.
    encoding is null for a string without both a letter and a digit, or one that holds too few bits.
    """
    body = F.regexp_replace(token, "=+$", "")
    name, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, pattern, letters in reversed(ENCODINGS):
        fits = token.rlike(pattern)
        name, alphabet = F.when(fits, kind).otherwise(name), F.when(fits, letters).otherwise(alphabet)
    able = token.rlike("[0-9]") & token.rlike("[A-Za-z]")

    def total(values, f):
        return F.aggregate(values, F.lit(0.0), lambda t, v: t + f(v))

    def scores(s):
        codes = F.transform(F.split(s["body"], ""), lambda c: F.call_function("instr", s["alphabet"], c).cast("double"))
        codes = F.filter(codes, lambda c: c > 0)
        squares = total(F.filter(F.split(s["alphabet"], ""), lambda c: c != ""), lambda c: F.pow((F.length(s["body"]) - F.length(F.replace(s["body"], c, F.lit("")))).cast("double"), F.lit(2.0)))
        size = lambda x, p: F.length(F.regexp_replace(x, p, "")).cast("double")
        classes = F.array(*[F.struct(size(s["body"], p).alias("n"), size(s["alphabet"], p).alias("k")) for p in ("[^a-z]", "[^A-Z]", "[A-Za-z]")])
        return F.struct(
            F.length(s["body"]).cast("double").alias("n"), F.length(s["alphabet"]).cast("double").alias("k"), s["name"].alias("name"),
            codes.alias("x"), squares.alias("squares"), F.filter(classes, lambda c: c["k"] > 0).alias("classes"),
        )

    def sums(s):
        k, x = s["k"], s["x"]
        pairs = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return F.struct(
            s["n"].alias("n"), k.alias("k"), s["name"].alias("name"), s["squares"].alias("squares"),
            F.size(s["classes"]).cast("double").alias("c"),
            total(s["classes"], lambda c: F.pow(c["n"] - s["n"] * c["k"] / k, F.lit(2.0)) * k / (s["n"] * c["k"])).alias("pooled"),
            total(x, lambda c: F.when(c > k / 2, 1.0).otherwise(0.0)).alias("high"),
            (1 + total(pairs, lambda q: F.when((q["a"] > k / 2) != (q["b"] > k / 2), 1.0).otherwise(0.0))).alias("runs"),
            (total(x, lambda c: c) / s["n"]).alias("mean"), total(x, lambda c: c * c).alias("xx"), total(pairs, lambda q: q["a"] * q["b"]).alias("xy"),
            (F.get(x, F.lit(0)) + F.element_at(x, -1)).alias("ends"),
        )

    def finish(s):
        n, k, c, high, mean = s["n"], s["k"], s["c"], s["high"], s["mean"]
        chi = (k / n * s["squares"] - n - s["pooled"] - (k - c) * (n - 1) / n) / F.sqrt(2 * (k - c) * (n - 1) / n)
        expected = 2 * high * (n - high) / n + 1
        spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
        # all characters in one half of the alphabet: the number of characters above the middle is itself the oddity
        run_score = F.when((high == 0) | (high == n), F.sqrt(n)).otherwise((s["runs"] - expected) / spread)
        around = s["xx"] - n * mean * mean
        beside = s["xy"] - mean * (2 * n * mean - s["ends"]) + (n - 1) * mean * mean
        serial = F.when(around > 1e-9 * s["xx"], (beside / around + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
        return F.struct(s["name"].alias("encoding"), n.cast("long").alias("n"), c.alias("c"), (s["pooled"] + chi * chi + run_score * run_score + serial * serial).alias("t"))

    def chance(s):
        t = s["t"]
        odd = _erfc(F.sqrt(t / 2)) + F.sqrt(2 * t / 3.141592653589793) * F.exp(-t / 2) * (1 + t / 3)
        return F.struct(s["encoding"].alias("encoding"), s["n"].alias("n"), F.when(s["c"] == 3, odd).otherwise(F.exp(-t / 2) * (1 + t / 2)).alias("p"))

    first = F.array(F.struct(body.alias("body"), alphabet.alias("alphabet"), name.alias("name")))
    usable = lambda s: s["alphabet"].isNotNull() & (F.length(s["body"]) >= 8) & (F.length(s["body"]) * F.log2(F.length(s["alphabet"]).cast("double")) >= MIN_BITS)
    done = F.filter(first, usable)
    for use in (scores, sums, finish, chance):
        done = F.transform(done, use)
    return F.when(able, F.get(done, F.lit(0)))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: float = LEVEL) -> DataFrame:
    """One row for each row of ``docs``: id_col, assign, access, hex, random (arrays of struct<a, b, s>: code points, text).

    The first three are the fixed formats. ``random`` holds strings of 20 and more characters, outside them, whose encoding
    can be inferred and that the battery finds random, and parts of those that fit no encoding (``parts``); overlapping
    ones are one span. At most a share of ``level`` of those reported is false, as estimated from all strings of the table by
    ``last_bins``, apart for each doubling of length, since short strings give weak evidence. That step runs over counts in a
    fixed number of bins, so it needs one small aggregate however many strings there are. A text takes time near its length,
    however many matches it has. Null texts are empty and have none; ties are rejected together; repeated rows
    give a row each; an empty table gives none; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kinds = [k for k, *_ in FORMATS]
    found = docs.select(F.col(id_col).alias("__id"), *[spans(text, p, g, n).alias(k) for k, p, g, n in FORMATS], spans(text, CANDIDATE, 0, 20).alias("strings"))
    whole = F.transform(apart(F.flatten(F.transform("strings", parts)), union(F.concat(*kinds))), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["s"].alias("s"), battery(x["s"]).alias("t")))
    tested = F.when(F.size("strings") > 0, F.filter(whole, lambda x: x["t"].isNotNull())).otherwise(F.filter(whole, lambda x: F.lit(False)))
    rows = stage(found.withColumn("tested", tested).drop("strings"), "secrets")

    each = rows.select(F.explode("tested").alias("x")).select(_group(F.col("x.t.n")).alias("g"), _bin(F.col("x.t.p")).alias("bin"))
    counts = each.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("n"))  # at most 60 groups of BINS + 1
    limits = last_bins(counts, level).agg(F.map_from_entries(F.collect_list(F.struct("g", "last"))).alias("__limits"))
    stays = lambda x: _bin(x["t"]["p"]) <= F.col("__limits")[_group(x["t"]["n"])]
    kept = F.transform(F.filter("tested", stays), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["s"].alias("s")))
    return rows.crossJoin(F.broadcast(limits)).select(F.col("__id").alias(id_col), *kinds, union(kept).alias("random"))


def _group(n: Column) -> Column:
    return F.floor(F.log2(n.cast("double"))).cast("int")


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log(F.greatest(p, F.lit(1e-300))) * BINS_PER_UNIT), F.lit(BINS)).cast("int")


def last_bins(counts: DataFrame, level: float) -> DataFrame:
    """(g, last): the last bin of -log p whose strings are reported, of (g, bin, n); -1 if none is.

    Random strings have p spread evenly; structured ones are the rarer, the higher p. So the number above 0.5 tells how many
    random ones there are at any p, and more than that further down are structured. Structured ones above 0.5 are
    estimated too, by going on upwards as their density falls from 0.01 .. 0.1 to 0.1 .. 0.5, where they exceed the random ones by more
    than two standard errors. Strings are reported down to where the structured ones first pass ``level`` of all. Where
    nothing below 0.1 speaks of structured ones, two standard errors are allowed above it, so that a table of a few random strings reports them.
    """
    limits = counts.groupBy("g").agg(F.collect_list(F.struct(F.col("bin").cast("int").alias("bin"), "n")).alias("bins"))
    up_to = lambda last: F.aggregate("bins", F.lit(0).cast("long"), lambda t, y: t + F.when(y["bin"] <= last, y["n"]).otherwise(0))
    share = lambda last: 1 - F.exp(-(last + 1) / F.lit(float(BINS_PER_UNIT)))  # noqa: E731  (of random strings with p in bins up to the last)
    limits = limits.select("g", "bins", *[up_to(F.lit(b)).cast("double").alias(f"n{b}") for b in (HALF, TENTH, HUNDREDTH)])
    limits = limits.withColumn("even", F.col(f"n{HALF}") / share(F.lit(HALF)))
    limits = limits.withColumn("error", 2 * F.sqrt(0.72 * F.col("even") + 1))  # of the number from 0.1 to 0.5, less what is random of it
    more = lambda a, b: F.col(f"n{b}") - F.col(f"n{a}") - F.col("even") * (share(F.lit(b)) - share(F.lit(a)))
    near, far = (more(HALF, TENTH) - F.col("error")) / (TENTH - HALF), F.greatest(more(TENTH, HUNDREDTH), F.lit(1.0)) / (HUNDREDTH - TENTH)
    steep = F.greatest(F.log(far / near), F.lit(0.0)) / ((HUNDREDTH - HALF) / 2)
    limits = limits.withColumn("false", F.when(near > 0, near * F.exp(-steep * (TENTH + 1) / 2) * (HALF + 1)).otherwise(0.0))
    limits = limits.withColumn("random", F.greatest(F.col(f"n{HALF}") - F.col("false"), F.lit(0.0)) / share(F.lit(HALF)))
    tried = F.concat(F.array(F.lit(HALF)), F.filter(F.transform("bins", lambda b: b["bin"]), lambda b: b > HALF))
    clean = (F.col("false") == 0) & (more(TENTH, HUNDREDTH) <= 2 * F.sqrt(0.11 * F.col("even") + 1))
    slack = lambda b: F.when((b > HALF) & (b <= TENTH) & clean, F.col("error")).otherwise(0.0)
    bad = F.array_min(F.filter(tried, lambda b: up_to(b) - F.col("random") * share(b) > level * up_to(b) + slack(b) + 1e-9))
    return limits.select("g", F.when(bad == HALF, -1).otherwise(F.coalesce(bad - 1, F.lit(BINS))).cast("int").alias("last"))


def joined(kinds: list[str]) -> Column:
    """``kind:start:end`` of all spans of these columns, by start, then kind in the order given."""

    def named(i: int, kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(x["a"].alias("a"), F.lit(i).alias("i"), F.concat_ws(":", F.lit(kind), x["a"].cast("string"), x["b"].cast("string")).alias("s")))

    every = F.concat(*[named(i, k) for i, k in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(every), lambda x: x["s"]), ",")
