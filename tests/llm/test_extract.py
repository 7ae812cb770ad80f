"""Main text of pages: templates with a known article, odd markup, and the driver's pages by a plain reading."""

import html as entities
import re

import pytest

from shopflow.llm import extract
from shopflow.llm.common import col

LONG = "A sentence of the article that is long enough to count as running text, number {}."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>Site</title>{head}</head><body>{body}</body></html>"


def texts(spark, pages, **kw):
    df = spark.createDataFrame([(i, u, h, 1, "x") for i, (u, h) in enumerate(pages)],
                               "page_id long, url string, html string, n_chars int, text string")
    out = extract.extract(df, **kw)
    assert out.columns == ["page_id", "url", "html", "n_chars", "text", "text_", "n_chars_"]
    rows = out.orderBy("page_id").collect()
    assert all(r["n_chars_"] == len(r["text_"]) for r in rows)
    return [r["text_"] for r in rows]


PARTS = "\n".join(LONG.format(i) for i in range(3))
BODY = "".join(f"<p>{LONG.format(i)}</p>" for i in range(3))
JUNK = ('<nav class="top"><ul><li><a href="/">Home</a></li></ul></nav><header id="masthead">Site name</header>'
        '<div class="cookie-notice">We use cookies, and this text is long enough to look like running text.</div>'
        '<form><p>Your name and a long explanation why we need it on this page</p></form>')
TAIL = ('<aside>Read on: more and more text that lies beside the article itself</aside>'
        '<section id="comments"><article><p>' + LONG.format("of a reader") * 9 + '</p></article></section>'
        '<footer>&copy; all of it</footer>')

TEMPLATES = {
    "article": (f"{JUNK}<article><h1>T</h1>{BODY}</article>{TAIL}", "T\n" + PARTS),
    "div": (f'{JUNK}<div class="wrap"><div id="post-17" class="entry"><h1>T</h1>{BODY}</div>'
            f'<div class="sidebar">x</div></div>{TAIL.replace("article", "div")}', "T\n" + PARTS),
    "body": (f"<h1>T</h1>{BODY}{JUNK}", "T\n" + PARTS),
    "table": (f"<table><tr><td class=menu>menu<td class=text><h1>T</h1>{BODY}</table>", "T\n" + PARTS),
    "form around all": (f'<form id="aspnet">{JUNK.replace("form", "div class=search")}<main><h1>T</h1>{BODY}</main></form>',
                        "T\n" + PARTS),
    "inner header": (f"<article><header><h1>T</h1><span>by someone</span></header>{BODY}"
                     '<div class="share-buttons">tell all</div><script>if (a<b) x("</p>")</script></article>', "T\n" + PARTS),
}


@pytest.mark.parametrize("name", TEMPLATES)
def test_templates(spark, name):
    body, want = TEMPLATES[name]
    assert texts(spark, [("http://a.example/1", page(body))]) == [want]


def test_blocks_and_references():
    cases = {
        "<p>a <b>b</b>c<br>d<p>e": "a bc d\ne",
        "<ul><li>one<li>two</ul>three": "one\ntwo\nthree",
        "<p>AT&T &lt;b&gt; &amp;amp; &copy &#233; &eacute;x": "AT&T <b> &amp; © é éx",
        "x<!-- <p>no</p> -->y": "xy",
        "<p hidden>no</p><p style='display: none'>no</p><p>yes \n\t yes</p>": "yes yes",
        "<p>5 < 6 and <unknown>tag</unknown></p>": "5 < 6 and tag",
        "<p title='a>b'>t</p><![CDATA[ x ]]><?php y ?>": "t",
        "<div><p>a</div>b</p>c": "a\nb\nc",
        "": "",
    }
    for markup, want in cases.items():
        assert "\n".join(extract.blocks_of(extract.parse(markup))) == want, markup


def test_host_consensus_beats_one_page(spark):
    """On its own, the short page's box is its best container; its host says where articles are."""
    usual = [("http://h.example/%d" % i, page(f'<div class="box7"><p>{LONG.format("x")}</p></div><div class="story">{BODY}</div>'))
             for i in range(8)]
    short = page(f'<div class="box7"><p>{LONG.format("x") * 3}</p></div><div class="story"><p>Short.</p></div>')
    alone = texts(spark, [("http://other.example/", short)])
    assert alone == [LONG.format("x") * 3]
    found = texts(spark, [*usual, ("http://u@H.example:80/short", short), (None, short)])
    assert found == [PARTS] * 8 + ["Short.", LONG.format("x") * 3]


def test_digits_in_classes_are_folded(spark):
    pages = [(f"http://h.example/{i}", page(f'<div class="box"><p>{LONG.format("x") * (3 if i == 5 else 0)}</p></div>'
                                            f'<div class="post-{i}"><p>{LONG.format(i)}</p></div>')) for i in range(6)]
    assert texts(spark, pages) == [LONG.format(i) for i in range(6)]


def test_edges(spark):
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    pages = [(None, None), ("", ""), ("no url", "plain words"), ("http://e.example", "<html></html>"),
             ("http://e.example", deep), ("http://e.example", "<p>" + "long " * 200_000 + "</p>"),
             ("http://e.example", "<nav>only a menu</nav>"), ("http://e.example", "<nav>only a menu</nav>")]
    assert texts(spark, pages) == ["", "", "plain words", "", "deep text", " ".join(["long"] * 200_000), "", ""]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract.extract(empty).count() == 0


def test_driver_pages(spark):
    """The driver's pages are well enough formed for a plain reading of their article element."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = extract.extract(pages).select("page_id", "html", "text", col("n_chars")).collect()
    assert len(rows) == pages.count()
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        cut = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\0", article)))
        blocks = (" ".join(entities.unescape(b).split()) for b in cut.split("\0"))
        assert r["text"] == "\n".join(b for b in blocks if b)
