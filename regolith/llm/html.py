"""Main text of web pages: the maximum-scoring run of words and tags.

Elements that never belong to an article (menus, page headers and footers, sidebars, notices, adverts, forms, scripts,
styles, comments) leave the page first. Of what remains, words and tags score by weights that labelled pages gave to the
places where they stand, and one linear scan finds the best contiguous region.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regolith.session import some

#: Labelled pages at most that the weights are learned from.
MAX_PAGES = 2000
#: Kinds of elements, as HTML defines them (fixed values).
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "canvas", "object", "textarea", "select", "button", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
AROUND = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "header"}
CONTENT = {"article", "main"}
#: Where a token stands: in an element that holds an article, beside one, or on a page without one.
CONTENT_PLACE, OUT, FREE = "content", "out", "free"
#: Words in class, id or role that name what surrounds an article, or its readers' comments.
SIDE = re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice|popup|modal|newsletter|subscri\w*|share|sharing|social|related|recommend\w*|sidebar|side|menu|nav\w*|breadcrumbs?|footer|masthead|toolbar|comments?|replies|disqus|respond|login|signup|paywall|pagination|pager|skip|complementary|contentinfo|search", re.I)
#: Words after which a name is still of what stands before them, and words before which it says only that something is there or not.
HOLDER = re.compile(r"\d+|areas?|bars?|blocks?|box(?:es)?|buttons?|container|forms?|icons?|inner|items?|links?|list|outer|panel|posts?|section|slot|stories|thread|top|bottom|left|right|unit|widgets?|wrap(?:per)?", re.I)
ABOUT = {"has", "no", "not", "with", "without", "hide", "show"}
#: Names that are told apart in the weights: those above and HTML's other usual blocks.
NAMES = VOID | INLINE | AROUND | CONTENT | set("address blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 html legend li ol p pre section summary table tbody td tfoot th thead tr ul".split())
_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I | re.S)
_SPACE = re.compile(r"[\s ]+")
_CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "html", "nav", "aside", "footer", "header", "form", "blockquote"}


@dataclass
class Token:
    """A tag or a stretch of text with where it stands."""

    tag: str  # "" for text
    text: str
    side: bool  # inside an element that surrounds articles
    content: int  # the outermost element that holds them around it, by number; 0 if there is none
    link: bool
    raw: bool  # not shown as text at all
    block: str = ""  # the innermost block around a text
    place: str = FREE


@dataclass(frozen=True)
class Weights:
    """Scores of a word by (place, block, whether in a link), and of a tag by (place, name); "" stands for any block or name."""

    words: dict[tuple[str, str, bool], float] = field(default_factory=lambda: {
        (CONTENT_PLACE, "", False): 1.0, (CONTENT_PLACE, "", True): 1.0, (OUT, "", False): -1.0, (OUT, "", True): -1.0, (FREE, "", False): 1.0, (FREE, "", True): -0.5,
    })
    tags: dict[tuple[str, str], float] = field(default_factory=lambda: {(CONTENT_PLACE, ""): -0.05, (OUT, ""): -0.5, (FREE, ""): -0.2})

    def score(self, t: Token) -> float:
        if t.tag:
            name = t.tag.lstrip("/")
            return self.tags.get((t.place, name), self.tags[t.place, ""])
        return len(t.text.split()) * self.words.get((t.place, t.block, t.link), self.words[t.place, "", t.link])


def names_side(names: str) -> bool:
    """Whether one of the names means something beside an article: its last word does, but for words like "box".

    "main-nav" and "share-buttons" do; "social-history", "search-results", "has-sidebar" and "sidebar-layout" don't.
    """
    for name in names.split():
        words = [x for x in re.split("[_-]+", name) if x]
        while len(words) > 1 and HOLDER.fullmatch(words[-1]):
            words.pop()
        if words and SIDE.fullmatch(words[-1]) and not any(x.lower() in ABOUT for x in words[:-1]):
            return True
    return False


class _Open:
    """The open elements, and where those of a name, those that bound a scope and paragraphs stand, so that no tag walks them all."""

    def __init__(self):
        self.items: list[tuple[str, bool, int, int, str]] = []  # tag, side, content, innermost doubtful element, innermost block
        self.of: dict[str, list[int]] = {}
        self.scopes: list[int] = []

    def top(self) -> tuple[bool, int, int, str]:
        return self.items[-1][1:] if self.items else (False, 0, 0, "")

    def push(self, name: str, side: bool, content: int, own: int) -> None:
        self.of.setdefault(name, []).append(len(self.items))
        if name in _SCOPE:
            self.scopes.append(len(self.items))
        self.items.append((name, side, content, own, self.top()[3] if name in INLINE else name))

    def last(self, names) -> int:
        return max((self.of[x][-1] for x in names if self.of.get(x)), default=-1)

    def scope(self) -> int:
        return self.scopes[-1] if self.scopes else -1

    def cut(self, at: int) -> None:
        for name, *_ in reversed(self.items[at:]):
            self.of[name].pop()
            if name in _SCOPE:
                self.scopes.pop()
        del self.items[at:]


def scan(page: str) -> list[Token]:
    """The page's tags and texts in order, in one pass; unclosed and misnested tags do no harm.

    A name, or a form, condemns an element only if it holds less than half of the words of the page's articles, and a
    name only if it holds less than half of the page's words as well; inside an article it does unless nearly all words are in it.
    """
    out: list[Token] = []
    stack = _Open()
    doubtful: list[list] = [[0, False, 0, 0, False]]  # the one around it, whether by name, words, words in articles, whether inside one
    holders = 0  # elements that hold articles, so far
    unclosed: set[str] = set()  # names of elements that nothing further on closes
    titled = set()  # headers that hold a page's title and no menu
    opened: list[int] = []  # headers outside articles
    inside: list[int] = []  # innermost doubtful element of each token
    at, n = 0, len(page)

    def emit(text: str) -> None:
        if text:
            side, content, own, block = stack.top()
            out.append(Token("", text, side, content, any(t[0] == "a" for t in stack.items[-4:]), False, block))
            inside.append(own)
            if not side:
                count = len(text.split())
                doubtful[own][2] += count
                doubtful[own][3] += count if content else 0

    while at < n:
        m = _TAG.search(page, at)
        if not m:
            emit(page[at:])
            break
        emit(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            k = stack.last([name])
            if k >= 0 and (name not in INLINE or k > max(stack.scope(), stack.last(["p"]))):
                stack.cut(k)
            side, content, own, _ = stack.top()
            out.append(Token("/" + name, "", side, content, False, False))
            inside.append(own)
            continue
        if name in RAW and name not in unclosed:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)[^>]*>?", re.I).search(page, at)
            if not end:
                unclosed.add(name)
            at = end.end() if end else (n if name in ("script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe") else at)
            if end or name in ("script", "style"):
                out.append(Token(name, "", False, 0, False, True))
                inside.append(0)
                continue
        side, content, own, _ = stack.top()
        if name in VOID:
            out.append(Token(name, "", side, content, False, False))
            inside.append(own)
            continue
        for closed in (_CLOSES.get(name, ()), () if name in INLINE else ("p",)):  # a block ends an open paragraph
            if (k := stack.last(closed)) > stack.scope():
                stack.cut(k)
        side, content, own, _ = stack.top()
        attrs = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(m[3] or "")}
        hidden = "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I)
        named = name not in ("html", "body", "article", "main") and names_side(" ".join(attrs.get(k, "") for k in ("class", "id", "role")))
        around = name in AROUND and name != "header"
        if name == "header" and not content and not side:
            doubtful.append([own, False, 0, 0, False])
            own = len(doubtful) - 1
            opened.append(own)
        elif opened and own == opened[-1]:
            if name == "h1":
                titled.add(own)
            elif name in ("nav", "ul", "form", "menu"):
                titled.discard(own)
                opened.pop()
        within = bool(content)
        if not content and (name in CONTENT or attrs.get("role", "").lower() in ("main", "article")):
            holders += 1
            content = holders
        side = side or bool(around and name != "form" or hidden)
        if not side and (named or name == "form"):
            doubtful.append([own, name != "form", 0, 0, within])
            own = len(doubtful) - 1
        out.append(Token(name, "", side, content, False, False))
        inside.append(own)
        if not (m[3] or "").rstrip().endswith("/") or name not in VOID:
            stack.push(name, side, content, own)
    for around, _, words, own_words, _ in reversed(doubtful[1:]):  # what is inside comes after what is around
        doubtful[around][2] += words
        doubtful[around][3] += own_words
    total, most = doubtful[0][2:4]
    beside = [False]
    for k, (around, by_name, words, own_words, within) in enumerate(doubtful[1:], 1):
        share = 10 * own_words >= 9 * most if within else 2 * own_words >= most or by_name and 2 * words >= total
        beside.append(beside[around] or not (k in titled and not most or (share if most else by_name and 2 * words >= total)))
    for t, own in zip(out, inside, strict=True):
        t.side = t.side or beside[own]
    marked = any(t.content and not t.side and not t.tag and t.text.strip() for t in out)
    for t in out:
        t.place = FREE if not marked else CONTENT_PLACE if t.content else OUT
    return out


def counts(page: str | None) -> Counter:
    """Of a page whose markup labels its article: numbers of words and tags as (place or "", kind, name, link, inside).

    Each is counted where it stands, and once more with the label hidden (place FREE), for pages without such markup.
    """
    out: Counter = Counter()
    for t in scan(page or ""):
        if t.place == FREE:
            break
        if t.side or t.raw:
            continue
        inside = t.place == CONTENT_PLACE
        for place in (t.place, FREE):
            if t.tag:
                out[place, "tag", t.tag.lstrip("/"), False, inside] += 1
            elif n := len(t.text.split()):
                out[place, "word", t.block, t.link, inside] += n
    return out


def learn(seen: Counter) -> Weights:
    """Weights from the summed ``counts`` of labelled pages: log odds of being inside, by frequency inside and outside.

    Words in articles always score above zero and words beside them below, tags never above zero; on pages without labels
    words score by their blocks, links below zero. Without labelled pages the weights are the standard ones.
    """
    total = {side: sum(n for (place, *_, inside), n in seen.items() if place == FREE and inside == side) for side in (True, False)}
    if not total[True]:
        return Weights()

    def odds(place: str, kind: str, name: str | None = None, link: bool | None = None) -> float:
        n = {side: sum(n for (p, k, b, a, inside), n in seen.items() if p == place and k == kind and name in (None, b) and link in (None, a) and inside == side) for side in (True, False)}
        return math.log((n[True] + 1) / (total[True] + 2)) - math.log((n[False] + 1) / (total[False] + 2))

    words, tags = dict(Weights().words), dict(Weights().tags)
    for link in (False, True):
        words[CONTENT_PLACE, "", link] = max(0.5, odds(CONTENT_PLACE, "word"))
        words[OUT, "", link] = min(-0.5, odds(OUT, "word"))
    tags[CONTENT_PLACE, ""], tags[OUT, ""] = min(-0.05, odds(CONTENT_PLACE, "tag")), min(-0.5, odds(OUT, "tag"))
    for place, kind, name, link, _ in seen:
        if place == FREE:
            if kind == "tag":
                tags[FREE, name] = max(-0.5, min(-0.05, odds(FREE, "tag", name)))
            else:
                value = odds(FREE, "word", name, link)
                words[FREE, name, link] = min(-0.1, value) if link else max(0.2, value)
    return replace(Weights(), words=words, tags=tags)


def regions(tokens: list[Token], w: Weights) -> list[tuple[int, int, float]]:
    """(first, end, sum) of all maximal-scoring runs of tokens, in order, by one scan.

    No part of a run, and no longer run around it that holds no other, has a larger sum; runs don't overlap, and the best one
    is among them. A run is kept with the sums before it and up to its end; a new one joins those back to the last with a smaller sum before it, if
    that ends below. Each run is joined once, and links to that last one are kept, so the work is linear.
    """
    runs: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum up to the end, the run before it with a smaller sum before
    total = 0.0
    for i, t in enumerate(tokens):
        score = w.score(t)
        before, total = total, total + score
        if score <= 0:
            continue
        first, at = i, len(runs) - 1
        while True:
            while at >= 0 and runs[at][2] >= before:
                at = runs[at][4]
            if at < 0 or runs[at][3] >= total:
                break
            first, before = runs[at][0], runs[at][2]
            del runs[at:]
            at = len(runs) - 1
        runs.append((first, i + 1, before, total, at))
    return [(a, b, end - begin) for a, b, begin, end, _ in runs]


def best_region(tokens: list[Token], w: Weights) -> tuple[int, int]:
    """The run of tokens with the largest sum (the first of equals)."""
    found = regions(tokens, w)
    return max(found, key=lambda r: r[2])[:2] if found else (0, 0)


def _ends_block(t: Token) -> bool:
    return bool(t.tag) and t.tag.lstrip("/") not in INLINE


def extract(page: str | None, w: Weights) -> str:
    """The main text of a page: the text blocks of the best region of what is left without surrounding elements.

    A block that the region cuts is taken whole. On a page whose markup names several articles, the best region of each is taken, so
    that none is lost.
    """
    tokens = [t for t in scan(page or "") if not t.side and not t.raw or _ends_block(t)]
    places = [i for i, t in enumerate(tokens) if not t.side and not t.raw]
    shown = [tokens[i] for i in places]
    found = sorted(regions(shown, w), key=lambda r: -r[2])
    best = {shown[r[0]].content: r for r in reversed(found)}  # the first of equals
    blocks, done = [], 0
    for a, b, _ in sorted({*found[:1], *(r for article, r in best.items() if article)}):
        first, last = places[a], places[b - 1]
        while first > done and not _ends_block(tokens[first - 1]):
            first -= 1
        while last + 1 < len(tokens) and not _ends_block(tokens[last + 1]):
            last += 1
        now: list[str] = []
        for t in tokens[max(first, done) : last + 1]:
            if t.tag == "br":
                now.append(" ")
            elif _ends_block(t) and not t.raw:
                blocks.append("".join(now))
                now = []
            elif not t.tag and not t.side:
                now.append(t.text)
        blocks.append("".join(now))
        done = max(done, last + 1)
    clean = (_SPACE.sub(" ", _html.unescape(x)).strip() for x in blocks)
    return "\n\n".join(x for x in clean if x)


def main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text", max_pages: int = MAX_PAGES, labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``out_col`` (replaced if there): the main text, "" if a page has none or its html is null.

    The weights come from ``labelled`` pages, or from pages of the table itself, whose markup names the article: at most
    ``max_pages`` of any length, spread by a hash of the page; tasks count their words and tags, and only sums by place
    and name reach the driver (names of elements beyond the standard's count as one). Pages are independent rows of one
    pass; long and empty pages, repeated rows and empty tables need no special case.
    """
    if out_col != html_col:
        pages = pages.drop(out_col)
    known = (pages if labelled is None else labelled).select(F.col(html_col).cast("string").alias("h")).filter("h IS NOT NULL")

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for x in batch.column(0).to_pylist():
                seen.update({(p, k, n if n in NAMES else "", a, i): c for (p, k, n, a, i), c in counts(x).items()})
        keys = list(seen)
        kinds = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([*[pa.array([k[i] for k in keys], kinds[i]) for i in range(5)], pa.array(list(seen.values()), pa.int64())], ["place", "kind", "name", "link", "inside", "n"])

    seen = some(known, max_pages, "h").mapInArrow(count, "place string, kind string, name string, link boolean, inside boolean, n bigint")
    seen = seen.groupBy("place", "kind", "name", "link", "inside").agg(F.sum("n").alias("n")).collect()  # 3 places x 2 kinds x NAMES x 4 at most
    weights = learn(Counter({(r["place"], r["kind"], r["name"], r["link"], r["inside"]): r["n"] for r in seen}))
    place = pages.columns.index(html_col)

    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.slice(i, 256)
                text = pa.array([extract(x, weights) for x in part.column(place).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, "__out"])

    out = pages.mapInArrow(run, pages.withColumn("__out", F.lit("")).schema)
    if out_col == html_col:
        return out.select(*[F.col("__out").alias(c) if c == html_col else F.col(f"`{c}`") for c in pages.columns])
    return out.withColumnRenamed("__out", out_col)
