"""The given tables, and catalogue views derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import shuffle_partitions

SIDE_A, SIDE_B = "catalogue_a", "catalogue_b"
RUN_TS = "2024-01-31 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def catalogue(spark: SparkSession, folder: str, side: int) -> DataFrame:
    """Silver-like rows of every part with an even (side 0) or odd (side 1) key."""
    half = F.floor(F.col("p_partkey") / 2)
    return (
        table(spark, folder, "part")
        .where(F.col("p_partkey") % 2 == side)
        .select(
            F.lit((SIDE_A, SIDE_B)[side]).alias("source"),
            F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("source_id"),
            F.when(half % 10 == 0, F.concat(F.lit("978"), F.lpad(half.cast("string"), 10, "0"))).alias("isbn13"),
            F.concat_ws(" ", "p_name", "p_brand").alias("title"),
            F.split("p_name", " ").alias("authors"),
            F.concat_ws(" > ", F.lit("Books"), "p_type").alias("category_path"),
            F.col("p_retailprice").alias("price_current"),
            F.when(F.col("p_partkey") % 3 == 0, F.round(F.col("p_retailprice") * 1.25, 2)).alias("price_original"),
            F.lit("USD").alias("currency"),
            F.concat(F.lit("http://example.com/part/"), F.col("p_partkey").cast("string")).alias("product_url"),
            F.to_timestamp(F.lit(RUN_TS)).alias("ingested_at"),
        )
    )


def parsed_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as a parsed record, with fields missing here and there."""
    key, size = F.col("p_partkey"), F.col("p_size")
    name = key.cast("string")

    def missing(every: int, value):
        return F.when(key % every != 0, value)

    return table(spark, folder, "part").select(
        missing(13, F.concat_ws(" ", "p_name", "p_brand")).alias("title"),
        missing(7, F.split("p_name", " ")).alias("authors"),
        missing(11, F.col("p_retailprice")).alias("price_current"),
        F.lit(None).cast("double").alias("price_original"),
        missing(5, F.lit("USD")).alias("currency"),
        F.when(size % 3 == 0, "Out of stock").when(size % 3 == 1, "In stock").otherwise("in_stock").alias("availability"),
        (size / 10.0).alias("rating"),
        size.alias("num_reviews"),
        F.lit(None).cast("string").alias("description"),
        missing(17, F.col("p_type")).alias("category"),
        missing(
            4,
            F.create_map(
                F.lit("availability"), F.concat(F.lit("In stock ("), size.cast("string"), F.lit(" available)")), F.lit("brand"), F.col("p_brand")
            ),
        ).alias("product_info"),
        missing(
            10, F.when(key % 2 == 1, F.concat(F.lit("978"), F.lpad(name, 10, "0"))).otherwise(F.concat(F.lit("u"), name))
        ).alias("upc"),
        F.lit(None).cast("string").alias("image_url"),
        F.concat(F.lit("http://example.com/part/"), name).alias("source_url"),
        F.lit("2024-01-31T10:00:00").alias("ingested_at"),
        F.lit(200).alias("http_status"),
    )


def product_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A product page per part, as a bronze table.

    The narrow rows are spread before they become pages: parsing is bound by CPU, and
    the parts are few bytes in few splits. A real bronze table has splits enough.
    """
    html = """concat(
      '<!DOCTYPE html><html><head><title>', p_name, '</title></head><body><ul class="breadcrumb">',
      '<li><a href="../index.html">Home</a></li><li><a href="../books.html">Books</a></li><li>', p_type, '</li></ul>',
      '<article class="product_page"><div class="item active">\\n<img src="../../media/', p_partkey, '.jpg" alt=""/></div>',
      '<div class="product_main"><h1> ', p_name, ' &amp; <i>', p_brand, '</i></h1>',
      if(p_partkey % 50 = 0, '', concat('<p class="price_color">', element_at(array('&pound;', '$', '&#8364;'), cast(p_partkey % 3 as int) + 1),
        format_string('%.2f', p_retailprice), '</p>')),
      '<p class="instock availability"><i class="icon-ok"></i> ', if(p_size % 3 = 0, 'Out of stock', concat('In stock (', p_size, ' available)')), ' </p>',
      '<p class="star-rating ', element_at(array('One', 'Two', 'Three', 'Four', 'Five'), cast(p_partkey % 5 as int) + 1), '"></p></div>',
      '<div id="product_description" class="sub-header"><h2>Description</h2></div><p>It\\u00e2s the ', p_name, '</p>',
      '<table class="table table-striped"><tr><th>UPC</th><td>', if(p_partkey % 6 = 0, '', concat('u', cast(p_partkey as string))), '</td></tr>',
      '<tr><th>Universal Product Code</th><td>x', p_partkey, '</td></tr>',
      if(p_partkey % 2 = 0, concat('<tr><th>Authors</th><td>', replace(p_name, ' ', ', '), '</td></tr>'), ''),
      '<tr><th>Number of reviews</th><td>', if(p_partkey % 9 = 0, 'none', cast(p_size as string)), '</td></tr></table></article></body></html>')"""
    url = (
        "concat('http://shop.example.com/catalogue/', if(p_size = 50, 'category/', ''), 'part-', p_partkey, '/index.html')"
    )
    return table(spark, folder, "part").repartition(shuffle_partitions(spark)).selectExpr(
        f"{url} as source_url", f"{html} as raw_content", "200 as http_status", f"timestamp '{RUN_TS}' as ingested_at"
    )


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listing pages of up to twenty parts each, with a link to the next page."""
    item = F.concat(F.lit('<h3><a href="../../../part-'), F.col("p_partkey").cast("string"), F.lit('/index.html">'), "p_name", F.lit("</a></h3>"))
    pages = (
        table(spark, folder, "part")
        .groupBy(F.floor(F.col("p_partkey") / 20).alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("item")))).alias("items"), F.count(F.lit(1)).alias("n"))
    )
    number = F.col("page").cast("string")
    following = F.when(
        F.col("n") == 20, F.concat(F.lit('<li class="next"><a href="page-'), (F.col("page") + 1).cast("string"), F.lit('.html">next</a></li>'))
    ).otherwise("")
    return pages.select(
        F.concat(
            F.lit("http://shop.example.com/catalogue/category/books/shelf_"), (F.col("page") % 7).cast("string"),
            F.lit("/page-"), number, F.lit(".html"),
        ).alias("source_url"),
        F.concat(F.lit("<html><body>"), F.array_join(F.col("items.item"), ""), F.lit("<ul>"), following, F.lit("</ul></body></html>")).alias("raw_content"),
    )


def api_records(spark: SparkSession, folder: str) -> DataFrame:
    """An API answer per part as JSON text; some are cut short."""
    body = """to_json(named_struct(
      'title', concat(p_name, ' ', p_brand), 'subtitle', if(p_partkey % 4 = 0, '', p_type), 'authors', replace(p_name, ' ', ', '),
      'publisher', p_brand, 'language', if(p_partkey % 3 = 0, '', 'English'), 'isbn10', cast(p_partkey as string),
      'isbn13', concat('978', lpad(cast(p_partkey as string), 10, '0')), 'pages', cast(p_size as string), 'year', '2020',
      'desc', concat('About "', p_name, '"'), 'price', if(p_partkey % 8 = 0, 'free', concat('$', format_string('%.2f', p_retailprice))),
      'image', concat('http://example.com/', p_partkey, '.png'), 'url', concat('http://example.com/book/', p_partkey)))"""
    return table(spark, folder, "part").selectExpr(
        f"if(p_partkey % 25 = 0, substr({body}, 1, 30), {body}) as raw_content"
    )


def nested_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listing-like pages whose elements nest, whose classes stand in any order, and whose texts hold many characters.

    Rows are spread before they become pages, as in ``product_pages``.
    """
    html = """concat(
      '<div class="next"><a href="wrong.html">no</a></div><div class="breadcrumb"><div>x</div><ul><li>Home<ul><li>Books</li></ul></li>',
      '<li><b>', p_type, '</b> &Eacute;&frac12;&#x00000E9;&NotEqualTilde;</li></ul></div>',
      '<div class="active big item"><div><span><img alt="" src="../pic/', p_partkey, '.jpg"></span></div></div>',
      '<h3><b>New</b> <a href="one-', p_partkey, '.html">1</a> or <a href="two-', p_partkey, '.html">2</a></h3><a href="none.html">n</a>',
      '<div class="price_color"><div>was</div> $', p_partkey, '</div>',
      if(p_partkey % 4 = 0, '', concat('<ul><li class="page next"><a href="page-', p_partkey + 1, '.html">next</a></li></ul>')))"""
    url = "concat('http://shop.example.com/catalogue/category/books/p_1/page-', p_partkey, '.html')"
    return table(spark, folder, "part").repartition(shuffle_partitions(spark)).selectExpr("p_partkey", f"{url} as source_url", f"{html} as raw_content")


def rough_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as they are found: comments, scripts, bare and single-quoted values, marks inside quotes, open references.

    Rows are spread before they become pages, as in ``product_pages``.
    """
    html = """concat(
      '<html><!-- <h1>old</h1> <li class="next"><a href="old.html">x</a></li> --><script>var s = "<h1>no</h1>";</script>',
      '<h1 title="a > b">', p_name, ' &eacute &notin; &AMP &#163 x</h1><p class=price_color>&pound', format_string('%.2f', p_retailprice), '</p>',
      '<p class=\\'star-rating ', element_at(array('One', 'Two', 'Three', 'Four', 'Five'), cast(p_partkey % 5 as int) + 1), '\\'></p>',
      '<div class="item active"><img alt="it\\'s" src=pic_', p_partkey, '.jpg></div><p class=availability>In stock</p>',
      '<h3><a href="it\\'s_', p_partkey, '/index.html?a=1&copy=2&amp;b">1</a></h3><h3><a class=x href=c_', p_partkey, '/index.html>2</a></h3>',
      '<ul class=pager><li class=next><a href=page-', p_partkey + 1, '.html>next</a></ul></html>')"""
    url = "concat('http://shop.example.com/catalogue/part-', p_partkey, '/index.html')"
    return table(spark, folder, "part").repartition(shuffle_partitions(spark)).selectExpr("p_partkey", f"{url} as source_url", f"{html} as raw_content", "200 as http_status", f"timestamp '{RUN_TS}' as ingested_at")


def home_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A home page for each size, with the types of its parts as the category list."""
    entry = F.concat(F.lit('<li><a href="catalogue/category/books/'), "p_type", F.lit('_1/index.html">\n  '), "p_type", F.lit(" &amp; more</a></li>"))
    return (
        table(spark, folder, "part")
        .groupBy("p_size")
        .agg(F.array_sort(F.collect_set(F.struct("p_type", entry.alias("entry")))).alias("e"))
        .select(
            F.concat(F.lit("http://shop.example.com/"), F.col("p_size").cast("string"), F.lit("/index.html")).alias("source_url"),
            F.concat(
                F.lit('<a href="top.html">top</a><div class="side_categories"><ul class="nav"><li><a href="all.html">Books</a><ul>'),
                F.array_join("e.entry", ""), F.lit('</ul></li></ul></div><a href="end.html">end</a>'),
            ).alias("raw_content"),
        )
    )
