"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation weighs their votes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regolith.session import stage

#: Characters between words, for a pattern.
BLANK = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
NO_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]"
#: The numbers that rules vote on, in order.
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letters", "n_lines", "n_ends")


@dataclass(frozen=True)
class Rule:
    """``bad`` and ``good`` are SQL conditions on FEATURES; where neither holds, the rule abstains."""

    name: str
    bad: str
    good: str

    def sql(self) -> str:
        """The vote: -1 bad, 1 good, 0 abstains."""
        return f"CASE WHEN {self.bad} THEN -1 WHEN {self.good} THEN 1 ELSE 0 END"


#: Thresholds are those of published filters for web text where they have one, and half or less of it for a good vote.
RULES = (
    Rule("length", "n_words < 50", "n_words >= 100"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words", "10 * word_chars >= 35 * n_words AND word_chars <= 8 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("letters", "100 * n_letters < 80 * word_chars", "100 * n_letters >= 90 * word_chars"),
    Rule("lines", "100 * n_dup_lines > 30 * n_lines", "n_lines >= 2 AND 100 * n_dup_lines <= 5 * n_lines"),
    Rule("repeats", "100 * n_repeat_words > 50 * n_words", "n_words >= 50 AND 100 * n_repeat_words <= 20 * n_words"),
    Rule("sentences", "n_words >= 50 AND 100 * n_ends < n_words", "100 * n_ends >= 3 * n_words AND 100 * n_ends <= 30 * n_words"),
)
#: A document that fails this is out whatever the votes.
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
#: Steps of expectation-maximisation, and what they start from: the share of good documents, and the probabilities that a vote is
#: right on a good document (which seldom breaks a rule) and on a bad one (which breaks few of them). That counts for so many votes.
STEPS, SHARE, RIGHT_IF_GOOD, RIGHT_IF_BAD, PRIOR_VOTES = 20, 0.8, 0.98, 0.3, 20.0


def bound(value: Column, f) -> Column:
    """``f`` of the value, which is computed once for each row however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANK}+", -1))


def _beside(xs: Column, same) -> Column:
    """The elements of a sorted array that are the ``same`` as the one before or after."""
    return F.filter(xs, lambda x, i: same(x, F.get(xs, i - 1)) | same(x, F.get(xs, i + 1)))


def repeated_words(words: Column, size: int = 3) -> Column:
    """How many words lie in runs of ``size`` words that the array has twice or more, overlaps included; ``words`` is read often.

    Runs are sorted by a number of 33 bits of their hash and 31 of their place; those with a neighbour of equal bits are
    compared as strings, so that the count is exact. The work for n words is that of sorting n numbers.
    """
    run = lambda i: [F.get(words, i + k) if k else F.get(words, i) for k in range(size)]
    keys = F.transform(words, lambda _, i: F.shiftleft(F.xxhash64(*run(i)), 31).bitwiseOR(i.cast("long")))
    keys = F.sort_array(F.slice(keys, F.lit(1), F.size(words) - size + 1))
    likely = bound(keys, lambda ks: _beside(ks, lambda x, y: F.shiftright(x.bitwiseXOR(y), 31) == 0))
    texts = F.transform(likely, lambda x: bound(x.bitwiseAND((1 << 31) - 1).cast("int"), lambda i: F.struct(F.concat_ws(" ", *run(i)).alias("t"), i.alias("i"))))
    again = bound(F.sort_array(texts), lambda ts: _beside(ts, lambda x, y: x["t"] == y["t"]))
    starts = F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(at, i + 1) - x, F.lit(size))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x)

    return F.when(F.size(words) > size, bound(starts, covered)).otherwise(F.lit(0).cast("long"))


def features(text: Column) -> Column:
    """A struct of FEATURES of a text: words, characters in them, symbols, lines equal to an earlier one, words in repeated runs,
    letters, lines with a word, sentence ends. Null has none of anything."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    with_word = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = lambda pattern: F.size(F.split(text, pattern, -1)) - 1

    def of(ws: Column, lines: Column) -> Column:
        counts = {
            "n_words": F.size(ws),
            "word_chars": F.length(F.array_join(ws, "")),
            "n_symbols": cut(SYMBOL),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": repeated_words(ws),
            "n_letters": F.length(F.regexp_replace(text, f"{NO_LETTER}+", "")),
            "n_lines": F.size(lines),
            "n_ends": cut("[.!?]"),
        }
        return F.struct(*[counts[k].cast("long").alias(k) for k in FEATURES])

    return bound(words(text), lambda ws: bound(with_word, lambda lines: of(ws, lines)))


@dataclass(frozen=True)
class Votes:
    """What the rules' votes are worth: the share of good documents, and for each rule the probability that its vote is right on a
    good document and on a bad one, if it doesn't abstain."""

    share: float
    right_if_good: tuple[float, ...]
    right_if_bad: tuple[float, ...]

    def posterior(self, votes: Column) -> Column:
        """The probability that a document with this array of votes is good."""
        ends = [F.lit([float(x) for x in xs]) for xs in (self.right_if_good, self.right_if_bad)]
        return _good(votes, F.lit(float(self.share)), *ends)


def _good(votes: Column, share: Column, a: Column, b: Column) -> Column:
    """The probability by the odds of the share times those of each vote: a / (1 - b) if good, (1 - a) / b if bad."""
    odds = lambda v, a, b: F.when(v == 1, F.log(a / (1 - b))).when(v == -1, F.log((1 - a) / b)).otherwise(0.0)
    each = F.transform(votes, lambda v, i: odds(v, F.get(a, i), F.get(b, i)))
    return 1 / (1 + F.exp(-F.aggregate(each, F.log(share / (1 - share)), lambda t, x: t + x)))


def fit(votes: DataFrame, column: str, rules: int, steps: int = STEPS) -> Votes:
    """Estimated by expectation-maximisation from a column of arrays of votes, one for each rule, without any label.

    Rows with the same votes are one row with a count: at most 3 ** rules, which is the size of the array that the steps run
    over. The start counts for PRIOR_VOTES votes throughout: that holds what good and bad mean, and an empty table leaves the start.
    """
    patterns = votes.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    entries = patterns.agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("entries"))
    rate = lambda right, wrong, start: (right + start * PRIOR_VOTES) / (right + wrong + PRIOR_VOTES)
    total = lambda rows, f: F.aggregate(rows, F.lit(0.0), lambda t, x: t + f(x))

    def step(now: Column, entries: Column) -> Column:
        rows = F.transform(entries, lambda x: bound(_good(x["v"], now["share"], now["a"], now["b"]), lambda p: F.struct(x["v"].alias("v"), (x["n"] * p).alias("good"), (x["n"] * (1 - p)).alias("bad"))))

        def maximum(rows: Column) -> Column:
            of = lambda name, j, vote: total(rows, lambda x: F.when(F.get(x["v"], j) == vote, x[name]).otherwise(0.0))
            each = F.sequence(F.lit(0), F.lit(rules - 1))
            return F.struct(
                rate(total(rows, lambda x: x["good"]), total(rows, lambda x: x["bad"]), SHARE).alias("share"),
                F.transform(each, lambda j: rate(of("good", j, 1), of("good", j, -1), RIGHT_IF_GOOD)).alias("a"),
                F.transform(each, lambda j: rate(of("bad", j, -1), of("bad", j, 1), RIGHT_IF_BAD)).alias("b"),
            )

        return bound(rows, maximum)

    start = F.struct(F.lit(SHARE).alias("share"), F.lit([RIGHT_IF_GOOD] * rules).alias("a"), F.lit([RIGHT_IF_BAD] * rules).alias("b"))
    found = entries.select(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda now, _: step(now, F.col("entries"))).alias("x")).first()["x"]
    return Votes(found["share"], tuple(found["a"]), tuple(found["b"]))


def judge(docs: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``keep`` columns of each row of ``docs``, FEATURES, a column ``vote_<rule>`` for each rule, base_failed, posterior, kept.

    A document fails the base if it has fewer than 50 words, or more than half of them in repeated runs of three. Of the others, those
    stay whose posterior probability of being good is ``least`` or more. The votes' worth is estimated from all of those. Features are made
    once and staged without the texts. Null texts are empty; repeated rows count each; an empty table stays empty; columns of ``docs``
    that aren't in ``keep`` are ignored, and those in ``keep`` may have no name that is returned here.
    """
    votes = [f"vote_{r.name}" for r in rules]
    if clash := set(keep) & {*FEATURES, *votes, "base_failed", "posterior", "kept"}:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], features(F.col(f"`{text_col}`")).alias("features"))
    rows = stage(rows, "features").select(*keep, "features.*").withColumns({v: F.expr(r.sql()) for v, r in zip(votes, rules, strict=True)})
    rows = rows.withColumn("base_failed", F.expr(BASE))
    each = F.array(*votes)
    worth = fit(rows.filter(~F.col("base_failed")).select(each.alias("votes")), "votes", len(rules))
    rows = rows.withColumn("posterior", worth.posterior(each))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))
