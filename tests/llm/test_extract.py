import itertools
import random

import pytest
from pyspark.sql import functions as F

from candlewick.llm import extract as X


def cut_cost(costs, edges, keep):
    return sum(c for c, k in zip(costs, keep) if c > 0 and not k) - sum(c for c, k in zip(costs, keep) if c < 0 and k) + sum(
        w for a, b, w in edges if keep[a] != keep[b])


def test_minimum_cut_against_all_labellings():
    rng = random.Random(8)
    for _ in range(150):
        n = rng.randrange(1, 9)
        costs = [rng.choice([-3, -1, -0.5, 0, 0.5, 1, 4]) * rng.random() for _ in range(n)]
        edges = [(a, b, rng.random() * 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        got = X.minimum_cut(costs, edges)
        best = min(cut_cost(costs, edges, keep) for keep in itertools.product([False, True], repeat=n))
        assert cut_cost(costs, edges, got) == pytest.approx(best, abs=1e-9)


PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style></head><body class="has-sidebar">
<header><a href="/">Home</a> Site slogan that is long enough to look like a paragraph of text, if one did not know better.</header>
<nav><ul><li><a href="a">One</a><li><a href="b">Two</a></ul></nav>
<div class="cookie-notice">We use cookies and other means in order to make this site as good as it can be for you.</div>
<article><h1>A &amp; B</h1><p>First   paragraph with
 enough text, &lt;marked&gt; and <a href="x">linked</a>, to be a paragraph.<p>Short one.</p>
<script>var x = "<p>not text</p>";</script><!-- nor <p>this</p> -->
<ul><li>item one</li><li>item two</li></ul><form>Mail <input name=m><button>Send</button></form>
<div class="advert">Buy now, and then buy some more of it, since it is cheap, and cheap things must be bought at once.</div>
<p>Last&nbsp;paragraph<br>of the article.</p></article>
<section id="comments"><p>I have read all of it and found it good, thank you very much for writing it down here for us.</p></section>
<aside><p>Related: other articles that are as good as this one and have as many words in their first lines.</p></aside>
<footer>&copy; 2020 by all</footer></body></html>"""


def test_a_page():
    text, total, kept = X.main_text(PAGE.encode())
    assert text == ("A & B First paragraph with enough text, <marked> and linked, to be a paragraph. Short one. item one item two "
                    "Last paragraph of the article.")
    assert kept < total


@pytest.mark.parametrize("page, text", [
    (None, ""), (b"", ""), (b"<html></html>", ""), (b"<article><p>only</article>", "only"), (b"<article>unclosed <b>bold", "unclosed bold"),
    (b"<article><p>a</p></b></i><p>b <", "a b <"), (b"<article><p a='<p>' b=\">\">x</p>", "x"), (b"<article>&#x41;&#65;&bogus;&lt", "AA&bogus;<"),
    (b"<article>\xff\xfe bytes", "�� bytes"), (b"<nav>menu</nav>", ""), (b"<article><textarea>no</textarea>yes", "yes"),
    (b"<article><script>never closed <p>text", ""), ("<article>" + "<div>" * 3000 + "deep", "deep")])
def test_odd_pages(page, text):
    assert X.main_text(page.encode() if isinstance(page, str) else page)[0] == text


def test_very_long_pages():
    page = "<article>" + "<p>word word word</p>" * 20_000 + "</article><footer>" + "<p><a>x</a></p>" * 5_000
    text, total, kept = X.main_text(page.encode())
    assert (total, kept) == (25_000, 20_000) and len(text) == 20_000 * 15 - 1
    assert X.main_text(("<article>" + "x" * 2_000_000).encode())[0] == "x" * 2_000_000


def test_frames(spark):
    df = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "")], "page_id long, url string, html string")
    df = df.withColumns({n: F.lit(n) for n in ("id", "text", "n_chars", "n_blocks")})
    rows = X.extract(df).collect()
    assert sorted((r["page_id"] or 0, r["url"] or "", r["n_chars"]) for r in rows) == [(0, "v", 0), (1, "u", 140), (1, "u", 140), (2, "", 0)] or \
        all(r["n_chars"] == len(r["text"]) for r in rows)
    assert len(rows) == 4 and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert X.extract(df.limit(0)).count() == 0


def test_articles_of_the_tables(spark):
    """All the article's text and nothing else, told by the markers of the tables' pages."""
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in X.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = (" ".join(html.unescape(p).split()) for p in re.split(r"<[^>]+>", re.sub("</?b>", "", inner)))
        assert r["text"] == " ".join(p for p in parts if p)


@pytest.mark.parametrize("page, text", [
    ("<article><p>before</p><svg class='icon' viewBox=\"0 0 9 9\"/><p>after</p></article>", "before after"),
    ("<article><p>one <math/> two <svg /> three</p><svg><path d='x'/>no</svg><p>four</p></article>", "one two three four"),
    ("<article><p>a</p><svg href=x/>no</svg><p>b</p></article>", "a b"), ("<article><p>a</p><script src='x'/>no</script><p>b</p>", "a b")])
def test_self_closed_svg_and_math_swallow_no_text(page, text):
    assert X.main_text(page.encode())[0] == text


LONG = "A paragraph of plain prose with enough words in it to look like the text of an article to any reader at all."


@pytest.mark.parametrize("page, text", [
    (f'<p title="the hidden truth">{LONG}</p>', LONG), (f'<article data-state="not hidden here"><p>{LONG}</article>', LONG),
    (f"<article><p hidden>no</p><p hidden=''>no</p><p HIDDEN>no</p><p>{LONG}</article>", LONG)])
def test_only_the_attribute_hides(page, text):
    assert X.main_text(page.encode())[0] == text


@pytest.mark.parametrize("around", [
    '<div class="layout has-sidebar"><article>', '<div class="content-sidebar-wrap"><main>', '<div class="site no-sidebar"><article>',
    '<div class="ad-free"><article>', '<div class="left side"><article>', '<div class="site no-sidebar">', '<div class="ad-free">',
    '<form id="aspnetForm"><article>', '<div id="page" class="social popular"><div><main>', '<body class="sidebar"><div class="page">'])
def test_words_of_the_layout_do_not_count_inside(around):
    page = f"<nav><a href=a>Menu</a></nav>{around}<h1>Title</h1><p>{LONG}</p><p>Short.</p>"
    assert X.main_text(page.encode())[0] == f"Title {LONG} Short."


@pytest.mark.parametrize("inner, text", [
    ('<section class="legal"><p>The law says that.</section>', " The law says that."), (f'<p class="share">{LONG}', f" {LONG}"),
    ('<h2 id="related-work">Related work</h2>', " Related work"), ('<section id="discussion"><p>Talk</section>', " Talk"),
    ('<div class="share"><a href=x>Tell</a> <a href=y>a friend</a></div>', ""), (f'<div class="advert"><p>{LONG}</div>', ""),
    (f'<div class="newsletter-box"><p>{LONG}</div>', ""), (f'<div id="comments"><p>{LONG}</div>', "")])
def test_parts_of_an_article(inner, text):
    assert X.main_text(f"<article><p>{LONG}</p>{inner}</article>".encode())[0] == LONG + text


@pytest.mark.parametrize("page", [
    f'<div class="comments"><article><p>{LONG}</article></div>', f'<aside><article><p>{LONG}</article></aside>',
    f'<div class="sidebar"><p>{LONG}</div>', f'<article class="comment"><p>{LONG}</article>', f'<form><p>{LONG}</form>'])
def test_articles_that_are_none(page):
    assert X.main_text(f"<article><p>yes</article>{page}".encode())[0] == "yes"


@pytest.mark.parametrize("page, text", [
    ("<body><p>Hello world.</p></body>", "Hello world."), (f"<div>{LONG}</div><div>Short one.</div>", f"{LONG} Short one."),
    (f"<p>{LONG}</p><nav><a href=x>One</a></nav>", LONG), ("plain text", "plain text")])
def test_plain_pages(page, text):
    assert X.main_text(page.encode())[0] == text


@pytest.mark.parametrize("k", [2, 3, 5, 20, 8000])
def test_link_paragraphs_do_not_draw_text_away(k):
    page = '<div class="content">' + f"<p>{LONG}</p><p><a href=x>Another story here</a></p>" * k
    assert X.main_text(page.encode())[1:] == (2 * k, k)


@pytest.mark.parametrize("page", [
    "<div>word" * 8000, "<div>" * 8000 + "a</div>" * 8000, "<div>word" * 8000 + "a</div>" * 8000, "<div>" * 8000 + "</i>x" * 8000,
    "<div><b>" * 8000 + "</i>x</span>" * 8000, "<b>" * 8000 + "<li>x" * 8000, "<!" * 100_000, "<body><head>" * 8000])
def test_broken_and_deep_pages_take_linear_time(page):
    import time
    start = time.process_time()
    X.main_text(page.encode())
    assert time.process_time() - start < 2


def test_lowest_common_elements():
    rng = random.Random(3)
    _, elements = X.blocks_of("".join(rng.choice(["<div>", "<div>", "</div>"]) for _ in range(600)))

    def path(a):
        return [a] + path(elements[a].parent) if a else [0]

    for _ in range(500):
        a, b = rng.randrange(len(elements)), rng.randrange(len(elements))
        common = max(elements[e].depth for e in set(path(a)) & set(path(b)))
        assert X._near(a, b, elements) == max(elements[a].depth, elements[b].depth) - common
