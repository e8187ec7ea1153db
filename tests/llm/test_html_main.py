import html
import os
import re

import numpy as np
import pytest

from oracle import DATA
from stratalake.llm import html_main

LONG = "This sentence is part of the article and long enough to carry weight."
CASES = {
    "": "",
    "plain text only": "plain text only",
    "<p>a<br>b</p><p>unfinished <a hre": "a b\nunfinished",
    f"<nav><a href=x>Home</a></nav><article><h1>T</h1><p>{LONG}</p><p>Short.</p></article><footer>&copy; x</footer>": f"T\n{LONG}\nShort.",
    f"<header>Site</header><main><h1>T</h1><p>{LONG}<p>a &amp; b &#39;c&#x27; d&nbsp;e<form><label>Name</label></form></main>": f"T\n{LONG}\na & b 'c' d e",
    f"<div class='menu'><a href=a>One</a> <a href=b>Two</a></div><div id=content><p>{LONG}</p><ul><li>item</ul></div><div class='site-footer footer'>F</div>": f"{LONG}\nitem",
    f"<article><p>{LONG}</p><div class='ad'>Buy</div><aside>See</aside><p>End</p></article><section id=comments><article class=comment><p>{LONG} {LONG}</p></article></section>": f"{LONG}\nEnd",
    f"<article><p>{LONG}<script>var t='</p>';</script><style>p{{}}</style></p><!-- <p>no</p> --><div role=alert>Notice</div></article>": LONG,
    f"<div class='cookie-notice'><p>{LONG}</p></div><article><p><b>Bold<br><p>{LONG}</article>": f"Bold\n{LONG}",
    "<nav><a href=x>only a menu</a></nav>": "",
    "<script>alert(1)</script>": "",
    f"<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table><pre>x   y</pre><p>{LONG}</article>": f"one\ntwo\nc1\nc2\nx y\n{LONG}",
}


@pytest.mark.parametrize("page", CASES)
def test_cases(page):
    assert html_main.main_text(page) == CASES[page]


def test_smoothing_and_threshold():
    flat = html_main.smoothed(np.full(9, 5.0))
    assert np.allclose(flat, 5.0)
    assert html_main.threshold(np.array([1.0, 2.0, 1.5, 40.0, 42.0])) == 40.0
    assert html_main.threshold(np.array([3.0])) == 3.0
    assert np.isclose(html_main.smoothed(np.array([0.0, 10.0, 0.0])).argmax(), 1)


def test_deep_and_long_pages_end():
    deep = "<div>" * 3000 + LONG + "</div>" * 3000
    assert html_main.main_text(deep) == LONG
    many = "<article>" + "".join(f"<p>{LONG} {i}</p>" for i in range(5000)) + "</article>"
    assert html_main.main_text(many).count("\n") == 4999


def test_table(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, "u", f"<article><p>{LONG}</article>", "x", 1), (1, "u", f"<article><p>{LONG}</article>", "x", 1), (2, None, None, "x", 1), (None, "v", "", None, None)]
    got = sorted(((r.page_id or -1), r.url, r.text, r.n_chars) for r in html_main.extract(spark.createDataFrame(rows, schema)).collect())
    assert got == [(-1, "v", "", 0), (1, "u", LONG, len(LONG)), (1, "u", LONG, len(LONG)), (2, None, "", 0)]
    assert html_main.extract(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.skipif(not os.path.isdir(f"{DATA}/sf0.01"), reason="driver tables not present")
def test_pages_against_their_article_element(spark):
    rows = html_main.extract(spark.read.parquet(f"{DATA}/sf0.01/pages.parquet")).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/sf0.01/pages.parquet").collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1).replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|ul|li)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


PARAGRAPH = f"<p>{' '.join([LONG] * 3)}</p>"


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "with-banner", "no-comments"])
def test_names_of_wrappers_do_not_hide_the_content(name):
    menu, side = "<nav><a href=x>Home</a></nav>", "<div class=sidebar><p>Side</p></div>"
    for tag in ("article", "main", "section"):
        page = f"{menu}<div class='{name}'><{tag}><h1>T</h1>{PARAGRAPH * 4}</{tag}></div>{side}"
        assert html_main.main_text(page).split("\n") == ["T"] + [" ".join([LONG] * 3)] * 4


def test_region_covers_all_content_with_headings_and_links():
    body = " ".join([LONG] * 3)
    page = f"<div><h1>title</h1><div>{PARAGRAPH * 4}</div><div>{PARAGRAPH}</div></div>"
    assert html_main.main_text(page).split("\n") == ["title"] + [body] * 5
    page = f"<nav><a href=x>Home</a></nav><div><h1>title</h1><div>{PARAGRAPH * 4}</div><h2><a href=x>linked</a></h2><div>{PARAGRAPH * 2}</div></div>"
    assert html_main.main_text(page).split("\n") == ["title", *[body] * 4, "linked", *[body] * 2]
