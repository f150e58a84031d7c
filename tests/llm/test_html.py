import html as entities
import re
import time

import pytest

from strata.llm import html as H


@pytest.fixture(scope="module")
def tree(spark):
    return H.train(spark)


PAGES = [
    ("""<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a> <a>x</a></nav>
        <article><h1>Title &amp; more</h1><p>One.<p>Two <b>bo</b>ld<br>line&nbsp;end</p><ul><li>item<li>next</ul></article>
        <footer>&copy; me</footer></body></html>""", "Title & more\n\nOne.\n\nTwo bold line end\n\nitem\n\nnext"),
    ("""<body><div class="cookie-notice">We use cookies</div><header><h1>Site</h1></header><main><article>
        <header><h1>Story</h1></header><p>Body text here.</p><aside>Also read</aside><div class="ad">Buy</div>
        <form><label>Mail</label><input></form><section id="comments"><p>First!</p><article class="comment"><p>I agree
        with every word of it and more</p></article></section><p>End.</p></article><div class=sidebar>Side</div></main>""",
     "Story\n\nBody text here.\n\nEnd."),
    ("<script>var t='</p><article>x';</script><article><!-- <p>no</p> --><p title='a>b'>caf&eacute; &#8212; &#x41;</p>"
     "<p style='display: none'>hid</p><p hidden>hid</p><p>last", "café — A\n\nlast"),
    ("<article><p>cut off here <a hre", "cut off here"),
    ("<form id=aspnetForm><div id=menu>m e n u</div><article><p>Inside.</p></article></form>", "Inside."),
    ("<article><p>x</p><script>unclosed", "x"), ("", ""), (None, ""),
    ("<nav>only</nav>", ""), ("<p>" + "word " * 50 + "</p>", ("word " * 50).strip()),
    ("<ul><li><a>a b</a><li><a>c d</a></ul><p>" + "w " * 40 + "</p><h2>Short</h2><p>" + "v " * 40 + "</p>",
     ("w " * 40).strip() + "\n\nShort\n\n" + ("v " * 40).strip()),
    ("<article><p>1 &lt; 2 < 3 && x</p></article>", "1 < 2 < 3 && x"),
    # names of classes that only speak of a sidebar, sharing or search
    ("<div class='content with-sidebar'><article><p>Kept.</p></article><div class='sidebar-left'>no</div></div>", "Kept."),
    ("<div class='content sidebar'><article><p>Kept.</p></article></div>", "Kept."),
    ("<article class='post share-enabled'><p>Kept.</p><div class='share-buttons'>no</div></article>", "Kept."),
    ("<article><p>One.</p><p class='search-history'>Two.</p><div class='post-search'>no</div></article>", "One.\n\nTwo."),
    ("<article><p>One.</p><div class=siteFooter>no</div><div class=related-posts>no</div></article>", "One."),
    ("<div id=sidebar><article class=teaser><p>no</p></article></div><article><p>Yes.</p></article>", "Yes."),
    # quotes that open no value, and one that never closes
    ("<article><p><a href='x' title=it's>One</a></p><p>Two</p><p>don't</p></article>", "One\n\nTwo\n\ndon't"),
    ("<article><p \"x>One</p><p title=\"a>Two</p></article>", "One\n\nTwo"),
    ("<article><p a = 'x>y' b=\"c>d\"/>One<!--> <!---> two --></article>", "One two -->"),
    # a head, paragraphs and items that are not closed; inline ends across blocks
    ("<html><head><title>T</title><body><article><p>One<div>Two</div><ul><li><p>a<li>b</ul></article>",
     "One\n\nTwo\n\na\n\nb"),
    ("<a name=top><article><p>One</a> more</p></b></article>", "One more"),
    ("<article><p>One<noscript><p>no</p></noscript> more<svg><title>no</title></svg></p></article>", "One more"),
    ("<form id=f><main><p>" + "w " * 40 + "</p></main></form>", ("w " * 40).strip()),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\n\nb\n\nc"),
]


@pytest.mark.parametrize("k", range(len(PAGES)))
def test_pages(tree, k):
    assert H.main_text(PAGES[k][0], tree) == PAGES[k][1]


def test_labelled_table_is_learnt(tree):
    rows = H.labelled_table()
    assert sum(H.is_main(tree, r[:-1]) == bool(r[-1]) for r in rows) >= 0.99 * len(rows)


def test_given_pages_against_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in H.extract(pages).collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        parts = re.split(r"</?(?:p|h1|article)>", re.sub(r"<[^>]*$", "", body))
        parts = [" ".join(entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts]
        assert r.text == "\n\n".join(p for p in parts if p), r.page_id
        assert r.n_chars == len(r.text)


def test_columns_and_rows(spark):
    rows = [(1, "u", PAGES[0][0], "clash"), (1, "u", PAGES[0][0], "clash"), (None, None, None, None)]
    out = H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert [x.text for x in out] == [PAGES[0][1], PAGES[0][1], ""] and out[2].n_chars == 0
    assert H.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


@pytest.mark.parametrize("page", [
    "<a \"" * 250_000, "<div>" * 100_000 + "</b>" * 100_000, "<p title=it's>" * 70_000, "<b>" * 150_000 + "</div>" * 100_000,
    "<a x='" * 150_000, "<!--" * 200_000, "<b><div></b>" * 60_000, "<script>" * 100_000, "</" * 300_000, "<a " + "=" * 500_000])
def test_hostile_pages_take_linear_time(page):
    start = time.process_time()
    H.blocks(page)
    assert time.process_time() - start < 10


def test_long_page(tree):
    page = "<article>" + "<p>some words here</p>" * 20000 + "<div>" * 5000
    assert H.main_text(page, tree).count("\n\n") == 19999
