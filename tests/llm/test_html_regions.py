"""Regions against their recursive definition, articles that must not be lost, and pages that are hard on a parser."""

import html as stdlib
import random
import re
import time

import pyarrow.parquet as pq
import pytest

from regolith.llm import html


class Scores:
    """Weights whose score of a token is the number in it."""

    def score(self, t):
        return t


def recursive(xs, at=0):
    """The best stretch (the first, then the shortest of equals), and those on either side of it."""
    best = max(((sum(xs[i:j]), -i, -j) for i in range(len(xs)) for j in range(i + 1, len(xs) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[1], -best[2]
    return [*recursive(xs[:i], at), (at + i, at + j, best[0]), *recursive(xs[j:], at + j)]


def test_regions_are_the_recursive_ones():
    rng = random.Random(1)
    for n in range(120):
        xs = [rng.choice([-7, -3, -1, 1, 2, 5]) + rng.random() for _ in range(rng.randrange(0, 22))]
        got = html.regions(xs, Scores())
        assert [g[:2] for g in got] == [w[:2] for w in recursive(xs)], xs
        assert [g[2] for g in got] == pytest.approx([w[2] for w in recursive(xs)])


def test_long_scores_are_linear():
    rng = random.Random(2)
    xs = [rng.choice([-1.0, 1.0]) for _ in range(400_000)]
    began = time.time()
    assert html.regions(xs, Scores()) and html.regions(xs[::-1] + [9.0] * 9, Scores())
    assert time.time() - began < 10


W = html.Weights()


def test_no_article_is_lost():
    one, two = "one " * 50, "two " * 40
    page = f"<nav>menu</nav><article><p>{one}</p></article><div>{'between ' * 200}</div><article><p>{two}</p></article>"
    assert html.extract(page, W) == f"{one.strip()}\n\n{two.strip()}"
    near = f"<article><p>{one}</p></article><p>{'x ' * 45}</p><article><p>{two}</p></article>"
    assert one.strip() in html.extract(near, W) and two.strip() in html.extract(near, W)


def test_adverts_in_an_article_go():
    assert html.extract('<article><div class="ad">buy now</div><p>text body</p></article>', W) == "text body"
    assert html.extract('<article><div class="social"><p>all of the text is in here</p></div></article>', W) == "all of the text is in here"
    assert html.extract('<div class="sidebar-wrap"><article><p>the text</p></article></div>', W) == "the text"


def plain(page):
    """For pages of flat blocks: the blocks of the article alone, by a regular expression."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    inner = re.sub(r"<(nav|aside|script|footer)>.*?</\1>", "", inner, flags=re.S)
    blocks = re.findall(r"<(?:p|h1|li)>(.*?)</(?:p|h1|li)>", inner, re.S)
    clean = (re.sub(r"\s+", " ", stdlib.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in blocks)
    return "\n\n".join(b for b in clean if b)


def built(rng, marked):
    words = lambda n: " ".join(rng.choice(["text", "a&amp;b", "<b>bold</b>", "é", "3 &lt; 4", "line\n end"]) for _ in range(n))
    menu = "<div>" + "".join(f'<div><a href="/{i}">go {i}</a></div>' for i in range(rng.randrange(4, 30))) + "</div>"
    body = f"<h1>{words(5)}</h1>" + "".join(rng.choice([f"<p>{words(rng.randrange(8, 60))}</p>", f"<ul><li>{words(9)}</li></ul>"]) for _ in range(rng.randrange(2, 9)))
    inside = "<aside>see also this</aside><script>var x = '<p>no</p>';</script>" if rng.random() < 0.5 else ""
    page = f"<html><body><header>site name</header>{menu}<article>{body}{inside}</article>{menu}<footer>all rights</footer></body></html>"
    return page, page if marked else re.sub("</?article>", "", page)


@pytest.mark.parametrize("marked", [True, False])
def test_extraction_is_brute_force(marked):
    """Pages with menus in plain elements: where no markup names the article, the scan has to find it."""
    rng = random.Random(5)
    for _ in range(150):
        page, shown = built(rng, marked)
        assert html.extract(shown, W) == plain(page), shown


def test_given_pages_without_their_labels():
    """With learned weights the scan gives the same text for nearly all given pages whose markup no longer names the article.

    Those that differ have an advert longer than their article, which could then be either.
    """
    pages = [x for x in pq.read_table("/root/testdata/sf0.001/pages.parquet")["html"].to_pylist() if x]
    seen = sum((html.counts(x) for x in pages), start=html.Counter())
    w = html.learn(seen)
    same = [html.extract(x, w) == html.extract(re.sub(r"</?(?:article|main)\b[^>]*>", "", x), w) for x in pages]
    assert sum(same) >= 0.9 * len(same)


@pytest.mark.parametrize(
    "page",
    ["<p>some text</p>" + "<button>x " * 60_000, "<b>y " * 60_000, "<i><p>" + "<b>z " * 30_000 + "</i>" * 30_000, "<b>" + "<div>q " * 30_000 + "</b>" * 30_000, "<b>" * 30_000 + "<li>x" * 30_000, "<div>" * 30_000 + "</p>x" * 30_000, "<script>" * 60_000, "<select><option>x" * 30_000, "<!--" * 60_000, '<a href="' * 60_000, "<" * 200_000],
    ids=["button", "b", "closing inline", "closing over blocks", "items", "paragraphs", "script", "options", "comments", "quotes", "less"],
)
def test_no_page_takes_long(page):
    began = time.time()
    html.extract(page, W)
    assert time.time() - began < 15
