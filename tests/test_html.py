import pytest
from pyspark.sql import functions as F

from pagemill.functions import html
from pagemill.operators.pages import not_found_score, paragraph_chunks, with_html_fields

PAGES = [
    ("null", None, "", [], []),
    ("empty", "", "", [], []),
    ("no title", "<html><body><p>a</p></body></html>", "", [], ["a"]),
    ("two titles", "<title>one</title><title>two</title>", "one", [], []),
    ("empty title", "<title></title><h2></h2>", "", [""], []),
    ("upper case", "<TITLE>T</TITLE><H1 CLASS=x>Head</H1><P ID=1>Par</P>", "T", ["Head"], ["Par"]),
    ("pre is no paragraph", "<pre>code</pre><p>x</p>", "", [], ["x"]),
    ("hidden tags", "<script>var t='<p>no</p>';</script><style>p{}</style><!-- <h1>no</h1> --><p>yes</p>", "", [], ["yes"]),
    ("nested paragraph", "<p><b>one<br><p>two</p>", "", [], ["one", "two"]),
    ("block ends paragraph", "<p>a<div>b</div><p>c<ul><li>d</li></ul>", "", [], ["a", "c"]),
    ("inline tags", "<h3>a <em>b</em> c</h3><p>x<a href='y'>z</a></p>", "", ["a b c"], ["xz"]),
    ("entities", "<title>a &amp;lt; &#65;&#x42; &eacute;&nope; &bad</title>", "a &lt; AB é&nope; &bad", [], []),
    ("common entities", "<p>&lt;b&gt; &amp;lt; &quot;&#39;&nbsp;</p>", "", [], ["<b> &lt; \"'\u00a0"]),
    ("escaped twice", "<p>&#38;amp; &amp;amp; &copy;</p>", "", [], ["&amp; &amp; ©"]),
    ("bad code points", "<title>&#0;&#xD800;&#x110000;&#x1F600;</title>", "���😀", [], []),
    ("long numbers", "<title>&#00000065;&#x0000000042;&#67 &#x44! &#99999999999999999999999;&#;</title>", "ABC D! �&#;", [], []),
    ("limits", "<h1>h</h1>" * 11 + "<p>p</p>" * 11, "", ["h"] * 10, ["p"] * 10),
]


@pytest.fixture(scope="module")
def fields(spark):
    pages = spark.createDataFrame([(name, content) for name, content, *_ in PAGES], "name string, content string")
    return {row["name"]: row for row in with_html_fields(pages).collect()}


@pytest.mark.parametrize("name,content,title,headings,paragraphs", PAGES, ids=[p[0] for p in PAGES])
def test_fields(fields, name, content, title, headings, paragraphs):
    row = fields[name]
    assert (row["title"], row["title_content"], row["body_content"]) == (title, headings, paragraphs)


def test_all_paragraphs(spark):
    pages = spark.createDataFrame([(1, "<p>a</p>" * 12), (2, None)], "id int, content string")
    rows = paragraph_chunks(pages, "id").collect()
    assert [(r["id"], r["chunk_no"], r["text"]) for r in rows] == [(1, i, "a") for i in range(12)]


def test_page_is_cleaned_once(spark):
    plan = with_html_fields(spark.createDataFrame([("<p>",)], "content string"))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("regexp_replace(content") == 1


def test_title_is_cut_out_once(spark):
    clean = spark.createDataFrame([("<title>",)], "c string").select(html.html_title(F.col("c")).alias("x"))
    assert clean._jdf.queryExecution().executedPlan().toString().count("regexp_extract(c") == 1


def test_not_found_score(spark):
    rows = spark.createDataFrame([("404 Not Found ",), ("Page not found!",), ("Home",)], "t string")
    scores = [r[0] for r in rows.select(not_found_score(F.col("t"))).collect()]
    assert scores[0] == 1.0 and 0.9 < scores[1] < 1.0 and scores[2] < 0.5


def test_fields_on_a_stream(spark, tmp_path):
    pages = spark.createDataFrame([(1, "<title>t</title><p>a</p>")], "id int, content string")
    pages.write.parquet(str(tmp_path / "in"))
    stream = with_html_fields(spark.readStream.schema("id int, content string").parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("html_stream").trigger(availableNow=True).start()
    query.awaitTermination(60)
    row = spark.table("html_stream").first()
    assert (row["title"], row["body_content"]) == ("t", ["a"])


def test_decode_leaves_plain_text(spark):
    row = spark.range(1).select(html.decode_entities(F.lit("a; b#c")).alias("x")).first()
    assert row["x"] == "a; b#c"
