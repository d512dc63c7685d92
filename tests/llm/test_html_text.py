"""Main text of pages: hand-made pages of several makes, damaged markup, the given pages against a plain cut of their article."""

import html
import re
import time

import pytest

from termwright.llm import html_text, queries
from termwright.llm.html_text import main_text

SF = "/root/testdata/sf0.001"
A = "The first paragraph is long enough to count, with a comma, and another one."
B = "A second paragraph, which goes on for some time, says more of the same thing."
C = "Thirdly, and last, this paragraph ends the article in a calm and orderly way."

PAGES = {
    "article": (f"<body><header><h1>Site</h1><p>{A}</p></header><nav><a href=/>Home</a></nav><main><article><header><h1>Title</h1></header><p>{A}</p><aside>{B}</aside><p>{B}</p><footer>Tags: x</footer></article></main><footer>&copy; us</footer>", ["Title", A, B]),
    "divs": (f"<div id=header>Our site, the best there is, of course, in the whole world</div><div class='top-menu'><a href=a>A</a></div><div class=wrap><div class='post-content'><h1>Title</h1><div><p>{A}</p><p>{B}</p></div><p>Short.</p></div><div class='sidebar'><p>{C}</p></div></div><div id=comments><p>{C}</p></div>", ["Title", A, B, "Short."]),
    "siblings": (f"<body><h2>Title</h2><div><p>{A}</p><p>{B} {B} {B}</p></div><div><p>{C}</p></div><div><a href=1>one link here and there</a> <a href=2>another link of this kind</a></div></body>", ["Title", A, f"{B} {B} {B}", C]),
    "notice": (f"<div class='cookie-consent'>{C}</div><article><p>{A}</p><div class=ad>{C}</div><div class='newsletter-box'><form>{C}</form></div><p>{B}</p><ul class=share><li>Share this</ul></article>", [A, B]),
    "wrapper": (f"<form id=aspnet><div class='page sidebar'><div class='has-sidebar'><article><p>{A}</p></article></div></div></form>", [A]),
    "lists": (f"<article><p>{A}</p><ul><li>one<li>two <b>bold</b><ol><li>deep</ol></ul><table><tr><td>x<td>y<tr><td>z</table><ul><li><a href=1>Read more</a><li><a href=2>and more</a><li><a href=3>and more</a></ul></article>", [A, "one", "two bold", "deep", "x", "y", "z"]),
    "blocks": (f"<article>loose  text\n<p>{A}<br>after a break<p>{B}<div>in a div</div>tail &lt;b&gt; &amp;amp; &#8364; &nbsp; x</article>", ["loose text", f"{A} after a break", B, "in a div", "tail <b> &amp; € x"]),
    "short": (f"<nav>{A}</nav><div class=ad>{B}</div><article><h1>Yes</h1><p>No.</p></article><article></article>", ["Yes", "No."]),
    "teasers": (f"<main><article><h1>T</h1><p>{A} {B}</p><p>{C}</p></article><article><p>Another story, in short, to be read</p></article></main>", ["T", f"{A} {B}", C]),
    "hidden": (f"<article><p>{A}</p><p hidden>{B}</p><div style='display: none'>{B}</div><p aria-hidden=true>{B}</p><script>var t='</p>'; \"<p>{C}</p>\"</script><style>p{{}}</style><noscript><p>{C}</p></noscript><!-- <p>{C}</p> --></article>", [A]),
    "damage": (f"<article><p><b>{A}<p><a href='x' title=\"a > b\">{B}</p></i></b></article><p>{C[:20]}", [A, B]),
    "open": (f"<article><p>{A}</p><p>{B}", [A, B]),
    "cut": (f"<article><p>{A}</p><a href=\"never ends", [A]),
    "comment": (f"<article><p>{A}</p><!-- never ends <p>{B}</p>", [A]),
    "joined words": (f"<article><ul class=mainnav><li>{B}</li></ul><p class=commentary>{A}</p><ol class=commentlist><li>{B}</li></ol><div id=topBanner2>{C}</div><p class=threads>{C}</p></article>", [A, C]),
    "signs": ("<p>1 < 2 and 3 > 2 &am x</p>", ["1 < 2 and 3 > 2 &am x"]),
    "plain": ("only text\n  here", ["only text here"]),
    "nothing": ("<html><body><nav>menu</nav></body></html>", []),
    "empty": ("", []),
}


@pytest.mark.parametrize("name", PAGES)
def test_made_pages(name):
    source, want = PAGES[name]
    assert html_text.main_blocks(source) == want


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.QUERIES["op13_html_text"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        article = re.search(r"(?s)<article>(.*?)</article>", pages[r.page_id].html)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_nulls_repeats_and_names(spark):
    page = f"<article><p>{A}</p></article>"
    df = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (3, page, "x", 1), (3, page, "x", 1), (None, page, None, None)], "page_id long, html string, Text string, `a.b` int")
    rows = html_text.extracted(df).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in rows) == [(0, A, len(A)), (1, "", 0), (2, "", 0), (3, A, len(A)), (3, A, len(A))]
    assert html_text.extracted(df).columns == ["page_id", "a.b", "text", "n_chars"]
    assert html_text.extracted(df.limit(0)).count() == 0


@pytest.mark.parametrize("part", ["<b>", "<div>", "<p>x", "<a href='", "<!--", "<", "</b>", "<li>", "<b><p>", "<td><p>", "&", "<a x=\"", "<script>", "<p><b></p>"])
def test_time_grows_with_length(part):
    """Hostile pages: twice the length takes about twice the time."""
    main_text(part * 1000)
    took = []
    for n in (20_000, 80_000):
        began = time.perf_counter()
        main_text(part * n)
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 0.3


def test_long_page():
    assert main_text(f"<article>{f'<p>{A}</p>' * 20_000}</article>").count(A) == 20_000
