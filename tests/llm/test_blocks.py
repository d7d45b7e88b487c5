"""op13: the given pages against their article elements, and pages of other shapes."""

import re
import time
from html import unescape

import pytest

from tessella.llm.blocks import extract, main_text

LONG = "The cat sat on the mat and it was not at all sure that this was the right place to be, so it went to the door and waited for her. "


def test_given_pages_are_their_articles(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(rows).collect()}
    assert len(got) == rows.count()
    for page in rows.collect():
        article = re.search("<article>(.*)</article>", page.html, re.S)[1]
        want = " ".join(unescape(re.sub("<[a-zA-Z/][^>]*>", " ", article)).split())
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want) and got[page.page_id].url == page.url


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>One <b>t</b>wo&nbsp;&amp&lt;three<br>four</article>", "One two &<three four"),
        ("<nav><p>Menu</nav><article><header><h1>Head</h1></header><p>Text.</p><aside>Side</aside><form>Name <input></form><section id='comments'>First!</section></article><footer>End</footer>", "Head Text."),
        ("<div class='cookie-notice'>We use it</div><main><p>A</p><div class=\"ad\"><div>Buy</div></div><p>B</main>", "A B"),
        ("<article><p>A<ul><li><a href=x>one</a><li><a href=y>two</a></ul><p>See <a href=z>this whole long link</a></article>", "A See this whole long link"),
        ("<article>2 < 3 <!-- no --><script>if (a < b) { '</p>' }</script><style>p{}</style> and <3</article>", "2 < 3 and <3"),
        ("<div class='page has-sidebar'><article>Kept</article><div class='sidebar'>Gone</div></div>", "Kept"),
        ("<form action=/all><article>Kept</article>Gone</form>", "Kept"),
        ("<article><p hidden>Gone<p title='a > b'>Kept<p title=it's>too</article>", "Kept too"),
        ("<article>Open at the end", "Open at the end"),
        ("<article>Kept<!-- open at the end", "Kept"),
        ("<article>Kept<p title='open at the end", "Kept"),
        ("", ""),
        ("<div></div>", ""),
        ("<article></article>", ""),
    ],
)
def test_shapes(page, text):
    assert main_text(page) == text


def test_two_passes_without_an_article():
    page = f"<div><a href=/>Home</a> <a href=/x>News</a></div><h2>Cats</h2><p>{LONG * 2}</p><p>Short one.</p><p>{LONG * 2}</p><p>Menu and stuff</p><div>© All rights reserved by the people of this site and all of the others who wrote for it.</div>"
    assert main_text(page) == f"Cats {(LONG * 2).strip()} Short one. {(LONG * 2).strip()}"
    assert main_text(f"<p>{LONG}</p>") == LONG.strip()  # nearly good, and nothing better


def test_bad_rows_and_clashing_columns(spark):
    kind = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "y"), (None, "u", "", "x", "y"), (2, "u", "<article>a  b</article>", "x", "y"), (2, "u", "<article>a  b</article>", "x", "y")]
    got = sorted((tuple(r) for r in extract(spark.createDataFrame(rows, kind)).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (None, "u", "", 0), (2, "u", "a b", 3), (2, "u", "a b", 3)], key=str)
    assert extract(spark.createDataFrame([], kind)).count() == 0


@pytest.mark.parametrize("piece", ["<", "<!--", "<p title='", "<a href=\"x", "<div>", "</div>", "<p>a", "&amp", "<script>", "<b <", "= '", "<div></p></b>"])
def test_long_pages_take_linear_time(piece):
    began = time.time()
    main_text("<article>" + piece * 100_000)
    assert time.time() - began < 20
