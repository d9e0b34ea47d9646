import itertools
import random
import re

import pytest

from isochron.llm import html_text
from isochron.llm.html_text import content_side, extract, main_text

PAGES = {
    # tables' own template
    """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
    <body><nav><ul><li><a href="/a">One</a></li></ul></nav><!-- ad --><div class="ad">Buy this now.</div><article><h1>Head&amp;</h1>
    <p><b>First   line &lt;x&gt;.<br><p>Second.</p><p>Third.</article><footer>&copy; site</footer></body></html>""":
        "Head&\nFirst line <x>.\nSecond.\nThird.",
    # a page without article: nested divisions, side bar, notice, comments
    """<body><div id="header"><h1>The Daily Site</h1></div><div class="cookie-notice"><p>We use cookies to make this site work
    better for you and for everybody else who reads it.</p><button>Accept</button></div><div id="content"><h2>A long way home</h2>
    <p>It was a long way home that evening, and nobody on the road had seen the lights of the town for hours.</p><p>So they went on.</p>
    <p>When the bridge came in sight, the oldest of them stopped, <a href="#">looked back</a> and began to laugh without a word.</p></div>
    <div class="sidebar"><ul><li><a href="/1">Most read</a></li><li><a href="/2">Weather</a></li></ul></div>
    <div id="comments"><h3>2 comments</h3><p>What a wonderful story, I have not read anything as good as this in years, thank you.</p></div>
    <form><label>Your mail</label><input type=text></form><div class="footer">All rights reserved 2020</div></body>""":
        "A long way home\nIt was a long way home that evening, and nobody on the road had seen the lights of the town for hours.\n"
        "So they went on.\nWhen the bridge came in sight, the oldest of them stopped, looked back and began to laugh without a word.",
    # header and aside inside the article, comments as articles
    """<main><article><header><h1>Title here</h1></header><p>Some text of the article that is long enough to count as such.</p>
    <aside>Related: other things</aside><div class="ad-slot"><p>Sponsored words about a product that nobody needs at all.</p></div>
    <p>More &eacute;t&eacute;.</p></article><section class="comments"><article class="comment"><p>I do not agree with what was said
    here, and would like to say so at length, if I may.</p></article></section></main>""":
        "Title here\nSome text of the article that is long enough to count as such.\nMore été.",
    # embedded elements without an end tag, and one in another
    """<article><h1>Frames</h1><p>Before the frame.</p><iframe src="x"><p>After the frame comes more text.</p><select><option>a
    <p>And a list of choices that never ends.</p><svg><path d=""><p>Drawings end nothing either.</p><noscript>x<noscript>y</noscript>
    z</noscript><p>Last.</p><select><option>one</select><video>no sound</video><textarea>typed <p></textarea></article>""":
        "Frames\nBefore the frame.\nAfter the frame comes more text.\na\nAnd a list of choices that never ends.\n"
        "Drawings end nothing either.\nLast.",
    # words of page furniture as names of what is in the article
    """<main><article><h1>The guild</h1><p class="notice">The guild gave notice to the town in the spring of that year.</p>
    <div class="social-history"><p>Its social history has been told by several hands, and at some length.</p></div>
    <section id="trade-related-rules"><p>Trade was ruled by the seven elders of the guild.</p></section>
    <div class="share"><a href="#">Tweet</a></div><div class="cookie-notice"><p>This site sets cookies, as every site does.</p></div>
    <ul class="social links"><li><a href="/a">On the other network</a></li></ul></article></main>""":
        "The guild\nThe guild gave notice to the town in the spring of that year.\n"
        "Its social history has been told by several hands, and at some length.\nTrade was ruled by the seven elders of the guild.",
    "": "", "   ": "", "<p": "", "<!-- only <p>this</p>": "",
    "<article><p>cut off in the mid": "cut off in the mid",
    "<article><p>a < b and c &am": "a < b and c &am",
    "<article><p title='x > y'>quoted</p></article>": "quoted",
}


@pytest.mark.parametrize("page", PAGES, ids=range(len(PAGES)))
def test_pages(page):
    assert main_text(page) == PAGES[page]


@pytest.mark.parametrize("seed", range(40))
def test_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    cost = [rng.randint(-9, 9) for _ in range(n)]
    ties = [(a, b, rng.randint(0, 6)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4]

    def total(side):
        own = sum(-c if s and c < 0 else c if not s and c > 0 else 0 for c, s in zip(cost, side, strict=True))
        return own + sum(c for a, b, c in ties if side[a] != side[b])

    assert total(content_side(cost, ties)) == min(map(total, itertools.product([False, True], repeat=n)))


def test_long_page_without_structure():
    page = "<body>" + "".join(f"<div><div>{'word ' * (i % 9)}{i}</div></div>" for i in range(4000))
    main_text(page)
    assert main_text("<article>" + "<p>x y." * 20_000).count("\n") == 19_999


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r for r in extract(pages).collect()}
    for p in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.S)
        lines = re.split(r"<(?:br|/?p|/?h1)>", article[1]) if article else []
        wanted = [html_text.html.unescape(re.sub(r"<[^>]*>", "", x)) for x in lines]
        wanted = "\n".join(x for x in (" ".join(w.split()) for w in wanted) if x)
        r = rows.pop(p.page_id)
        assert r.text == wanted and r.n_chars == len(wanted) and r.url == p.url
    assert not rows


def test_nulls_repeats_clashing_names(spark):
    rows = [(1, None, None, "x"), (None, "u", "<article><p>a b c", "x"), (1, None, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract(pages).collect()), key=str)
    assert found == [(1, None, "", 0), (1, None, "", 0), (None, "u", "a b c", 5)]
    assert extract(pages.limit(0)).count() == 0
