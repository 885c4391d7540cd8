import html
import re
import time

import pytest

from pagemill.llm.html_paths import Page, extract_pages, main_text, path_scores


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p></p><script>var x = '<p>no, no</p>';</script>", ""),
        ("just, text", "just, text"),
        ("a < b, &amp;amp; c&nbsp;&#100;&#x65;", "a < b, &amp; c de"),
        ("<body><article><h1>T</h1><p>One,\n two <b>bo</b>ld.<br>line<p>Three, four.</article><footer>f, f</footer>", "T\n\nOne, two bold. line\n\nThree, four."),
        ("<main><header><h1>Title</h1></header><p>Body, text.</main><div id='cookie-notice'>We, use.</div>", "Title\n\nBody, text."),
        ("<div class=post><h2>H</h2><p>Long, long text here.</p><p>More, text here.</p></div><div class='sideBar'>x, y</div><ul class=comments><li>c, c</ul>", "H\n\nLong, long text here.\n\nMore, text here."),
        ("<article><p>Yes, this.</p><div class='ad'>Buy, now.</div><form><p>Name, please</p></form><!-- no --><aside>No.</aside><p>And, that.</article>", "Yes, this.\n\nAnd, that."),
        ("<article><ul><li>one, 1<li>two, 2</ul><table><tr><td>a<td>b</table></article>", "one, 1\n\ntwo, 2\n\na\n\nb"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


def test_article_of_every_page(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in extract_pages(rows).collect()}
    for r in rows.collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", b))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert got[r["page_id"]]["text"] == "\n\n".join(filter(None, blocks))
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_prose_scores_over_links():
    tree = Page("<ul><li>a<li>b<li>c</ul><div>" + "<p>Some, prose: with marks." * 9 + "</div>")
    scores = path_scores([(tree.path[e], t) for e, t in tree.pieces])
    low, high = (scores[tree.path[e]] for e, _ in (tree.pieces[0], tree.pieces[-1]))
    assert high > 2 * low


@pytest.mark.parametrize("page", ["<div>" * 60_000 + "x, y", "<p " * 60_000, "<!--" * 60_000, "<a b='\"" * 60_000, "<script>" * 60_000, "<ul><li>" * 30_000, "</div>" * 60_000])
def test_broken_pages_take_linear_time(page):
    began = time.time()
    main_text(page)
    assert time.time() - began < 8


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    rows = [(1, None, None, "t", 1), (None, "u", "<p>a, b", None, None), (1, "u", "", "t", 2), (1, "u", "", "t", 2)]
    got = extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in got) == [("1", "", 0), ("1", "", 0), ("1", "", 0), ("None", "a, b", 4)]
    assert extract_pages(spark.createDataFrame([], schema)).count() == 0


LONG, SHORT = "Long text, with marks. " * 45, "Short text, with marks. " * 4


def parted(*blocks):
    return "\n\n".join(" ".join(b.split()) for b in blocks)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div><p>{LONG}</p><p>{SHORT}</p></div>", parted(LONG, SHORT)),
        (f"<h1>Title</h1><div><p>{LONG}</p></div><p>{SHORT}</p>", parted("Title", LONG, SHORT)),
        (f"<div><p>{SHORT}</p></div><section><div><p>{SHORT}</p></div></section><div><p>{SHORT}</p></div>", parted(SHORT, SHORT, SHORT)),
        (f"<div class='layout has-sidebar'><p>{LONG}</p><div class=sidebar><p>{SHORT}</p></div></div>", parted(LONG)),
        (f"<div class='layout has-sidebar'><article><p>{SHORT}</p></article></div><ul><li>x, y</ul>", parted(SHORT)),
        (f"<main><div id=nav-content><p>{LONG}</p></div><div class=related><p>{SHORT}</p></div></main>", parted(LONG)),
        (f"<main><article><p>{LONG}</p></article><div id=comments><article class='comment-body'><p>{SHORT}</p></article></div></main>", parted(LONG)),
        (f"<div class=has-sidebar><p>{LONG}</p></div><article><p>{SHORT}</p></article>", parted(LONG)),
        ("<div class=ad>Buy, this or that, and now, quickly.</div><article><p>Small, text.</p><p>And, more text.</p></article>", parted("Small, text.", "And, more text.")),
        (f"<div><button>Menu<p>{LONG}</p><p>{SHORT}</p></div>", parted(LONG, SHORT)),
        (f"<div><p>{LONG}</p><svg/><canvas /><iframe src=x /><p>{SHORT}</p></div>", parted(LONG, SHORT)),
        (f"<div><div><template><p>no, no</div><p>{LONG}</p></div><p>{SHORT}</p>", parted(LONG, SHORT)),
        (f"<p>a <svg><title>no</title><svg>no</svg><p>no</svg> {LONG}</p><select><option>no<option>no</select><p>{SHORT}</p>", parted("a " + LONG, SHORT)),
        (f"<p>{SHORT} <a><math><mi>no</a> end.</p><div><select><option>no, no</div><p>{LONG}</p>", parted(SHORT + " end.", LONG)),
        (f"<title>T<p>{LONG}</p><div><script>var no = 1</div><textarea>no<p>{SHORT}</p><script/>", parted(LONG, SHORT)),
        (f"<div><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><blockquote>Quoted</blockquote><h4>Small</h4><pre>x = 1</pre><p>{LONG}</p></div>", parted(LONG, "one", "two", "a", "b", "Quoted", "Small", "x = 1", LONG)),
        (f"<body><p>{LONG}</p><ul><li>one</ul><p>{LONG}</p><ul><li>after</ul></body>", parted(LONG, "one", LONG)),
        (f"<body><div><h4>Before</h4><p>{LONG}</p><ul><li>after</ul></div><div>else</div></body>", parted("Before", LONG, "after")),
        (f"<article><p>{LONG}</p></article><article><p>{SHORT}</p></article>", parted(LONG, SHORT)),
        (f"<div><article><p>{SHORT}</p></article><article><p>{LONG}</p></article><article><ul><li>list</ul></article></div><p>x</p>", parted(SHORT, LONG, "list")),
        (f"<article><p>{LONG}</p></article><article><p>{LONG}</p></article><article><p>{LONG}</p></article>", parted(LONG, LONG, LONG)),
        (f"<object><p>no</p></div><p>no</p></object><p>{LONG}</p><button>no<button>no</button><p>{SHORT}</p>", parted(LONG, SHORT)),
    ],
)
def test_whole_article(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", ["<svg>" * 60_000, "<object><div>" * 30_000 + "</p>" * 30_000 + "</object>", "<div><button>x" * 30_000, "<div><script>" * 30_000, "<p><script>x</p>" * 30_000, "<title>" * 60_000, "<div class=ad>" * 60_000 + "x, y"])
def test_broken_silent_elements_take_linear_time(page):
    began = time.time()
    main_text(page)
    assert time.time() - began < 8
