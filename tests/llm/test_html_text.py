from __future__ import annotations

import random

import pytest

from tallyframe.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no</p>";</script></head><body>
<div id="cookie-notice"><p>We use cookies for all sorts of things, as every page does.</p></div>
<header class="site-header"><h1>Name of the site</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="ad">Buy this excellent thing now, it is cheaper than it was before.</div>
{open}<h1>Head &amp; line</h1><p>First  paragraph of the article,
 with <b>bold</b> words &lt;here&gt;.<p>Short.</p><div class="ad"><p>Another advert inside.</p></div>
<p>Second paragraph of the article, which is long enough to be one.</p><aside>Beside the point.</aside><ul><li>An item of a list that belongs</li></ul>{close}
<form><p>Your name and your address please, for our letters.</p></form>
<section id="comments"><p>A reader says that this was a good article, or a bad one.</p></section>
<footer>&copy; all of it reserved, and so on and so forth, for ever.</footer></body></html>"""
TEXT = "Head & line\nFirst paragraph of the article, with bold words <here>.\nShort.\nSecond paragraph of the article, which is long enough to be one.\nAn item of a list that belongs"


@pytest.mark.parametrize("tags", [("<article>", "</article>"), ('<main id="x">', "</main>"), ('<div itemprop="articleBody">', "</div>"), ("<div>", "</div>"), ("", "")])
def test_main_text(tags):
    assert H.main_text(PAGE.format(open=tags[0], close=tags[1])) == TEXT


def test_cut_pages_keep_what_is_there():
    page = PAGE.format(open="<article>", close="</article>")
    for end in range(0, len(page), 7):
        text = H.main_text(page[:end])
        assert "cookies" not in text or "<article>" not in page[:end]
        if end > page.index("</article>"):
            assert text == TEXT


@pytest.mark.parametrize("page", ["", "<", "<p", "<!--", "<script>", "<a " * 9, "<div>" * 50, "<nav><p>only a menu</p></nav>"])
def test_pages_without_text(page):
    assert H.main_text(page) in ("", "<")


def test_surge_and_dive():
    assert H.surge_and_dive([]) == [] and H.surge_and_dive([0, 0]) == []
    assert H.surge_and_dive([0, 5, 0, 0, 0, 200, 3, 300, 0, 0, 0, 90, 0, 0, 0]) == [(5, 8), (11, 12)]


def test_frame(spark):
    rows = [(1, "u", PAGE.format(open="<article>", close="</article>")), (2, None, None), (2, None, ""), (None, "v", "<article>x</article>")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.extract(frame).collect()), key=str)
    assert got == sorted([(1, "u", TEXT, len(TEXT)), (2, None, "", 0), (2, None, "", 0), (None, "v", "x", 1)], key=str)
    assert H.extract(frame.limit(0)).count() == 0


def test_any_bytes_give_text():
    rng = random.Random(1)
    for _ in range(500):
        H.main_text("".join(rng.choice(["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "text ", "&amp", "<", ">", "\"", "<!--", "-->", "<script>"]) for _ in range(40)))


WORDS = "A paragraph of the article that is long enough to be a surge by itself, number {} of them."
LIST = "<ul>" + "".join(f'<li><a href="/{k}">Another page of ours</a></li>' for k in range(3)) + "</ul>"


@pytest.mark.parametrize("page", [
    "<main><h1>Head</h1><article><p>{0}</p></article></main>",
    "<article><h1>Head</h1><div itemprop='articleBody'><p>{0}</p></div></article>",
    "<main><article><h1>Head</h1></article><div role='main'><p>{0}</p></div></main>",
])
def test_nested_articles_are_one(page):
    text = WORDS.format(1)
    assert H.main_text(page.format(text)) == f"Head\n{text}"


def test_surge_and_dive_run_inside_a_named_article():
    """Whatever is in it stays but for what is marked, a list of links too; what is around it goes."""
    ads = "<div class='ad'><p>One.</p><p>Two.</p><p>Three.</p></div>"
    page = f"<p>{WORDS}</p><article><h1><a href='/'>Head</a></h1><p>By me</p>{ads}<p>Short.</p>{LIST}<p>{WORDS}</p><p><a href='/s'>Source</a></p></article>"
    links = "\n".join(["Another page of ours"] * 3)
    assert H.main_text(page) == f"Head\nBy me\nShort.\n{links}\n{WORDS}\nSource"


@pytest.mark.parametrize("page, text", [
    ("<article><p>A<p class='share'>Share<p>B<p>C</article><p>out", "A\nB\nC"),
    ("<article><ul><li class='ad'>Ad<li>one<li>two</ul><p>end</article>", "one\ntwo\nend"),
    ("<article><div><form><input><p>Name</div><p>after</article>", "after"),
    ("<article><p>one</p></article><article><p>two, longer</p></article>", "one\ntwo, longer"),
    ("<article><p class='market-share'>The share</p><p class='share'>Share</p><span class='ad'>Buy <b>it</b></span> rest</article>", "The share\nrest"),
    ("<article><table><tr><td>a<td class='ad'>Ad<td>b<tr><td>c</table><dl><dt>t<dd class='promo'>p<dd>d</dl></article>", "a b\nc\nt\nd"),
    ("<article><div class='ad'><div><p>Ad</div></div></div><p>x</article>", "x"),
    ("<article><b>bold <i>both</b> italic</i><p>x</p></article>", "bold both italic\nx"),
])
def test_elements_without_end_tags_and_marks_of_several_words(page, text):
    assert H.main_text(page) == text


def test_a_wrapper_that_has_a_sidebar_is_none():
    page = f"<div class='content has-sidebar'><h1>Head</h1><p>{WORDS}</p><p>{WORDS}</p></div><div class='main-sidebar'><p>{WORDS}</p></div>"
    assert H.main_text(page) == f"Head\n{WORDS}\n{WORDS}"


def test_very_long_and_deep_pages():
    deep = "<div>" * 50_000 + "<article><p>" + "word " * 400_000 + "</article>"
    assert len(H.main_text(deep)) == 5 * 400_000 - 1
    assert H.main_text("<article>" + "<li>item<p>" * 20_000 + "</article>").count("\n") == 19_999


@pytest.mark.parametrize("between", ["<aside><p>One.</p><p>Two.</p><p>Three.</p></aside>", "<div class='share'><p>One.</p><p>Two.</p><p>Three.</p><p>Four.</p></div>", LIST])
def test_ranges_of_one_article_are_all_kept(between):
    """Pages that name no article: a dive amid the article takes away no part of it."""
    first, last = WORDS.format(1), " ".join(WORDS.format(k) for k in (2, 3))
    page = f"<nav><a href='/'>Home</a></nav><div><h1>Head</h1><p>{first}</p>{between}<p>Short.</p>{between}<p>{last}</p></div><footer>&copy; all of it</footer>"
    assert H.main_text(page) == f"Head\n{first}\nShort.\n{last}"


def test_a_paragraph_that_is_a_link_stays():
    texts = [WORDS.format(k) for k in range(3)]
    page = f"<div><p>{texts[0]}</p><p><a href='/x'>{texts[1]}</a></p><p>{texts[2]}</p></div>"
    assert H.main_text(page) == "\n".join(texts)
