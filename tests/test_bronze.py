import hashlib
import html as stdlib_html
import json
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import html as h
from shelfmark.functions import records
from shelfmark.operators import bronze
from shelfmark.plans import inputs

PAGE = """<html><head><script>var css = ".price_color { }";</script></head><body>
<ul class="breadcrumb"><li><a href="/">Home</a></li><li><a>Books</a></li><li><a href="x">Travel &amp; more</a></li></ul>
<article class="product_page"><div class="item active"> <img src="../../media/c/a.jpg" alt="x"/></div>
<div class="product_main"><h1>It&#39;s <b>only</b> &#x48;&eacute;</h1><p class="big price_color">&pound;45.17</p>
<p class="instock availability"><i class="icon-ok"></i> In stock (19 available)</p><p class="star-rating Two"></p></div>
<div id="product_description" class="sub-header"><h2>Description</h2></div><p>Itâs a Âgood one</p>
<table class="table table-striped"><tr><th>UPC</th><td>a22</td></tr><tr><th>Number of reviews</th><td>7</td></tr>
<tr><th>Availability</th><td>In stock (19 available)</td></tr><tr><th>UPC</th><td>a23</td></tr></table></article></body></html>"""


def bronze_table(spark, *pages):
    rows = [(url, content, 200, "2024-01-01T10:00:00") for url, content in pages]
    return spark.createDataFrame(rows, "source_url string, raw_content string, http_status int, ingested_at string")


URL = "http://s.com/catalogue/its_1/index.html"


def test_product_page(spark):
    row = bronze.parse_pages(bronze_table(spark, (URL, PAGE))).collect()[0]
    assert row.title == "It's only Hé" and row.price_current == 45.17 and row.currency == "GBP"
    assert row.availability == "in_stock" and row.rating == 2.0 and row.num_reviews == 7
    assert row.description == "It's a good one" and row.category == "Travel & more"
    assert row.upc == "a23" and row.authors == ["Unknown Author"]
    assert row.product_info == {"upc": "a23", "number_of_reviews": "7", "availability": "In stock (19 available)"}
    assert row.image_url == "http://s.com/media/c/a.jpg" and row.source_url == URL and row.http_status == 200


def test_author_rows(spark):
    inside = PAGE.replace("<th>UPC</th><td>a22</td>", "<th>Author(s)</th><td>Ann A, Bob B</td>")
    outside = PAGE.replace("<table", "<table><tr><th> The AUTHOR </th><td>Zoe</td></tr></table><table")
    pages = bronze_table(spark, (URL + "1", inside), (URL + "2", outside))
    assert {tuple(r.authors) for r in bronze.parse_pages(pages).collect()} == {("Ann A", "Bob B"), ("Zoe",)}


def test_second_place_of_the_description(spark):
    page = PAGE.replace("product_description", "x").replace(
        '<div id="x"', '<div>a</div><br><div><p>nested</p></div><p>short <b>one</b></p><p>later</p><div id="x"'
    )
    assert bronze.parse_pages(bronze_table(spark, (URL, page))).collect()[0].description == "short one"


def test_incomplete_pages(spark):
    no_price = PAGE.replace("&pound;45.17", "free")
    zero = PAGE.replace("&pound;45.17", "&pound;0.00")
    no_title = PAGE.replace("h1", "h2")
    pages = bronze_table(
        spark, ("http://s.com/catalogue/1", no_price), ("http://s.com/catalogue/2", zero), ("http://s.com/catalogue/3", no_title),
        ("http://s.com/catalogue/category/4", PAGE), ("http://s.com/other/5", PAGE), ("http://s.com/catalogue/6", "junk"),
    )
    assert bronze.parse_pages(pages).count() == 0
    out = {r.source_url[-1]: r.missing_fields for r in bronze.rejected_pages(pages).collect()}
    assert out == {"1": "price_current", "2": "price_current", "3": "title", "6": "title,price_current"}


def test_currency_order(spark):
    df = spark.createDataFrame([("£1$",), ("$1",), ("1€",), ("1",), (None,)], "t string")
    assert [r[0] for r in df.select(bronze.currency(F.col("t"))).collect()] == ["GBP", "USD", "EUR", "GBP", "GBP"]


def test_long_pages_do_not_overflow(spark):
    long = PAGE.replace("Description</h2>", "x" * 200_000 + "<b>y</b>" * 3000 + "</h2>")
    assert bronze.parse_pages(bronze_table(spark, (URL, long))).collect()[0].description == "It's a good one"


@pytest.mark.parametrize("text", ["a &amp;lt; b", "&lt;b&gt; &#38;lt; &#x26;amp;", "&eacute;&#233;&#xe9;", "no refs", "&unknown; &", "&amp;amp;"])
def test_unescape(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(h.unescape(F.col("t"))).collect()[0][0] == stdlib_html.unescape(text)


def test_resolve_url(spark):
    bases = ["http://a.com/x/y/z.html", "http://a.com/x/y/z?p=1/2#t", "http://a.com", "https://a.com/", "http://a.com/x/y/"]
    refs = ["b.html", "../b", "../../../b", "./b/./c", "/b", "//c.com/d", "?q=1", "#f", "", "mailto:x", "..", ".", "b?x=../y", "b/../c#k/.."]
    rows = [(b, r) for b in bases for r in refs]
    df = spark.createDataFrame(rows, "b string, r string")
    out = df.select("b", "r", h.resolve_url(F.col("b"), F.col("r")).alias("u")).collect()
    assert [(r.b, r.r, r.u) for r in out if r.u != urljoin(r.b, r.r)] == []


def test_links_and_next_page(spark):
    listing = '<h3><a href="../../../one_1/index.html">1</a></h3><H3 class="x"><a title="t" href="two.html">2</a></h3><a href="no">n</a><li class="next"><a href="page-2.html">next</a></li>'
    pages = bronze_table(spark, ("http://s.com/catalogue/category/books/travel_2/index.html", listing), ("http://s.com/x", "<p>none</p>"))
    links = bronze.catalogue_links(pages, "http://s.com").orderBy("position").collect()
    assert [r.link for r in links] == ["http://s.com/catalogue/one_1/index.html", "http://s.com/catalogue/two.html"]
    assert bronze.page_links(pages).count() == 4
    out = [r[0] for r in pages.select(bronze.next_page(F.col("raw_content"), F.col("source_url"))).collect()]
    assert out == ["http://s.com/catalogue/category/books/travel_2/page-2.html", None]


def test_category_from_url(spark):
    df = spark.createDataFrame([("http://s/catalogue/category/books/science_fiction/index.html",), ("http://s/a",), ("http://s/category/x",)], "u string")
    assert [r[0] for r in df.select(bronze.category_from_url(F.col("u"))).collect()] == ["Science Fiction", "Unknown", "Unknown"]


def test_hashes(spark):
    df = spark.createDataFrame([("http://u", "é" * 1500)], "u string, c string")
    expected = hashlib.md5(("http://u_" + "é" * 1000).encode()).hexdigest()
    assert df.select(records.raw_hash(F.col("u"), F.col("c"))).collect()[0][0] == expected


def test_api_records(spark):
    good = {"title": "T", "subtitle": "", "authors": "A, B ", "price": "$9.99", "isbn13": "9781234567890", "year": "2020", "language": "", "url": "http://b", "desc": "D"}
    bad_price = {**good, "price": "free", "authors": ""}
    pages = bronze_table(spark, ("1", json.dumps(good)), ("2", json.dumps(bad_price)), ("3", "{'title': 'repr'"), ("4", "[]x"))
    rows = bronze.parse_api_records(pages).orderBy("price_current", "title").collect()
    assert len(rows) == 2
    free, paid = rows
    assert free.price_current is None and free.authors == []
    assert paid.price_current == 9.99 and paid.authors == ["A", "B"] and paid.category == "Technology"
    assert paid.currency == "USD" and paid.availability == "in_stock" and paid.rating is None and paid.num_reviews is None
    assert paid.product_info == {"isbn13": "9781234567890", "year": "2020"} and paid.upc == "9781234567890"
    assert paid.ingested_at == "2024-01-01T10:00:00" and paid.http_status == 200


def test_hydrate(spark):
    listed = spark.createDataFrame([("1", "list", 1.0), ("2", "only", 2.0), (None, "x", 3.0), ("", "y", 4.0)], "isbn13 string, title string, price double")
    details = spark.createDataFrame([("1", None, "pub"), ("", "z", "p")], "isbn13 string, title string, publisher string")
    row = bronze.hydrate(listed, details).collect()
    assert [(r.isbn13, r.title, r.price, r.publisher) for r in row] == [("1", "list", 1.0, "pub")]
    assert bronze.hydrate(listed, details, null_detail_wins=True).collect()[0].title is None


def test_first_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "g string, i int")
    assert sorted((r.g, r.i) for r in bronze.first_per_group(df, "g", ["i"], 2).collect()) == [("a", 0), ("a", 1), ("b", 9)]


def _plain(spark, *pages):
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    return [r[0] for r in df.select(h.normalized(F.col("html"))).collect()]


def test_plain_markup_is_left_alone(spark):
    page = '<html><p class="a b" id="x">1 &lt; 2, it\'s</p><br/><!DOCTYPE x></html>'
    assert _plain(spark, page, "", None, "no tags < at all") == [page, "", None, "no tags < at all"]


def test_token_pass(spark):
    pages = {
        "<!-- <h1>old</h1> --><h1>new</h1>": "<h1>new</h1>",
        "a<!-- never ended <b>": "a",
        "<a href='x y' rel=next>t</a>": '<a href="x y" rel="next">t</a>',
        "<a href=\"it's\" title='say \"hi\"'>t</a>": '<a href="it&#39;s" title="say &quot;hi&quot;">t</a>',
        '<a title="1 > 0" href = c/d.html disabled>': '<a title="1 &gt; 0" href="c/d.html" disabled>',
        # a slash belongs to a bare value
        "<img src=a.png/><IMG SRC='b'/>": '<img src="a.png/"/><IMG SRC="b"/>',
        "<script>if (a < b) { x = '<h1>' }</script><style a=b>p > q {}</style><p>y": "<p>y",
        '<a href="unended>text <b>': '<a href="unended>text <b>',
        "x = 'y' <b>": "x = 'y' <b>",
    }
    assert _plain(spark, *pages) == list(pages.values())
    assert _plain(spark, *pages.values()) == list(pages.values())  # once is enough


def test_long_attributes_and_pages(spark):
    page = "<p class=x>" + "<a href='" + "y" * 100_000 + "'>" + "<b title=t>z</b>" * 20_000
    assert len(_plain(spark, page)[0]) == len('<p class="x">') + len('<a href="">') + 100_000 + len('<b title="t">z</b>') * 20_000


def test_references_without_a_semicolon(spark):
    texts = {"&pound51.77": "£51.77", "&eacute ": "é ", "&#163 5 &#1634; &#163;": "£ 5 ٢ £", "&notit; &notin; &not": "¬it; ∉ ¬", "&ampamp; &amp;lt;": "&amp; &lt;", "&nosuch &nosuch; a & b &": "&nosuch &nosuch; a & b &", "&#x41&#x42;": "AB"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(h.unescape(F.col("t"))).collect()] == list(texts.values())
    refs = {"?a=1&copy=2&amp;b": "?a=1&copy=2&b", "it&#39;s": "it's", "&#163 &eacute": "&#163 &eacute"}
    df = spark.createDataFrame([(t,) for t in refs], "t string")
    assert [r[0] for r in df.select(h.unescape(F.col("t"), attribute=True)).collect()] == list(refs.values())


@pytest.mark.parametrize("pages", [inputs.product_pages, inputs.nested_pages, inputs.rough_pages])
def test_pages_of_one_file_are_spread(spark, tmp_path, pages):
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    assert pages(spark, str(tmp_path)).rdd.getNumPartitions() == 4


def test_inner_with_much_behind_it(spark):
    tail = "<p>y</p>" * 2000
    cases = {
        "<p>x</p>": "x", "<P class='a'>x</p >": "x", "<p>x<pre>y</pre></p>": "x<pre>y</pre>", "<div>a<div>b</div>c</div>d": "a<div>b</div>c",
        "<p/>x</p>": None, "<p></p>": None, "<div>open": "open", "<p>x<p>y</p>z</p>w": "x<p>y</p>z", "no tag": "no tag", "<li>a<br/>b</li><li>c": "a<br/>b",
    }
    rows = spark.createDataFrame([(k, k + (tail if k.startswith(("<p", "<P")) else "")) for k in cases], "case string, rest string")
    got = {r["case"]: r["inside"] for r in rows.select("case", h.inner(F.col("rest")).alias("inside")).collect()}
    assert got == cases
