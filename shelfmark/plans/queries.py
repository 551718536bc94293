"""The registered queries: each operator on the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.functions import records
from shelfmark.functions import html as h
from shelfmark.operators import assignment, bronze, clusters, dedupe, dimension, facts, matching, ordered, profiles, quality, silver
from shelfmark.plans.inputs import (
    RUN_TS,
    api_records,
    catalogue,
    home_pages,
    listing_pages,
    nested_pages,
    parsed_parts,
    product_pages,
    rough_pages,
    table,
)
from shelfmark.schemas import AVAILABILITY_HISTORY, CANONICAL, CATEGORY_DIMENSION, PARSED, PRICE_HISTORY, RULE_RESULT, RUN_REPORT, SILVER
from shelfmark.session import work_folder
from shelfmark.sources import keyed, tables
from shelfmark.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Arrays, maps, times and whole numbers that may be null leave a query as text, floats
# rounded, other whole numbers as long.


def _joined(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def _pairs(name: str) -> Column:
    entries = F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(entries, "|").alias(name)


def _time(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _round(name: str, digits: int = 6) -> Column:
    return F.round(name, digits).alias(name)


def _long(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


# ---- bronze ----------------------------------------------------------------------


@query
def extract_fields(spark, folder):
    pages = table(spark, folder, "pages")
    page = F.col("html")
    return pages.select(
        "page_id",
        bronze.title(page).alias("title"),
        h.first_match(page, r"(?is)<html\b[^>]*\blang\s*=\s*[\"']([^\"']*)[\"']").alias("lang"),
        bronze.is_detail_page(F.col("url")).alias("is_detail"),
    )


@query
def extract_links(spark, folder):
    pages = table(spark, folder, "pages").select(F.col("url").alias("source_url"), F.col("html").alias("raw_content"))
    return bronze.page_links(pages).select("source_url", _long("position"), "link")


@query
def raw_hash(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.select(
        "page_id",
        records.raw_hash(F.col("url"), F.col("html")).alias("record_hash"),
        F.md5("html").alias("content_hash"),
    )


def _parsed_text(parsed: DataFrame, *more: str | Column) -> DataFrame:
    return parsed.select(
        "title", _joined("authors"), "price_current", "currency", "availability", "rating", _text("num_reviews"),
        "description", "category", _pairs("product_info"), "upc", "image_url", "source_url", *more,
    )


@query
def parse_product_pages(spark, folder):
    return _parsed_text(bronze.parse_pages(product_pages(spark, folder)), "price_original", _text("http_status"), "ingested_at")


@query
def page_selectors(spark, folder):
    page = F.col("raw_content")
    return nested_pages(spark, folder).select(
        "p_partkey",
        bronze.category_from_breadcrumb(page).alias("category"),
        bronze.image_source(page).alias("image"),
        bronze.price_text(page).alias("price"),
        bronze.next_page(page, F.col("source_url")).alias("next_url"),
    )


@query
def rough_markup(spark, folder):
    """Fields of pages with comments, scripts, bare values and open references."""
    parsed = bronze.page_fields(rough_pages(spark, folder))
    return parsed.select("source_url", "title", "price_current", "currency", "availability", "rating", "image_url")


@query
def rough_links(spark, folder):
    pages = rough_pages(spark, folder)
    following = pages.select("source_url", F.lit(-1).alias("position"), bronze.next_page(h.normalized(F.col("raw_content")), F.col("source_url")).alias("link"))
    return bronze.page_links(pages, "h3").unionByName(following).select("source_url", _long("position"), "link")


@query
def links_inside_headings(spark, folder):
    return bronze.page_links(nested_pages(spark, folder), "h3").select("source_url", _long("position"), "link")


@query
def category_list(spark, folder):
    return bronze.category_links(home_pages(spark, folder)).select("source_url", _long("position"), "name", "link")


@query
def rejected_api_json(spark, folder):
    return bronze.rejected_api_records(api_records(spark, folder))


@query
def rejected_pages(spark, folder):
    return bronze.rejected_pages(product_pages(spark, folder))


@query
def listing_links(spark, folder):
    pages = listing_pages(spark, folder)
    return bronze.catalogue_links(pages, "http://shop.example.com/").select("source_url", _long("position"), "link")


@query
def next_pages(spark, folder):
    pages = listing_pages(spark, folder)
    return pages.select(
        "source_url",
        bronze.next_page(F.col("raw_content"), F.col("source_url")).alias("next_url"),
        bronze.category_from_url(F.col("source_url")).alias("category"),
    )


@query
def parse_api_json(spark, folder):
    return _parsed_text(bronze.parse_api_records(api_records(spark, folder)))


@query
def parse_event_json(spark, folder):
    events = table(spark, folder, "events")
    props = F.from_json("props", "k INT")
    return events.select("event_id", props["k"].cast("bigint").alias("k"))


@query
def enrich_join(spark, folder):
    listed = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    details = table(spark, folder, "labels").select("doc_id", _long("quality"), _long("toxic"))
    return bronze.hydrate(listed, details, key="doc_id")


@query
def first_per_category(spark, folder):
    parts = table(spark, folder, "part").select("p_type", "p_partkey", "p_name")
    return bronze.first_per_group(parts, "p_type", ["p_partkey"], 5)


# ---- silver ----------------------------------------------------------------------


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver.clean(parsed_parts(spark, folder), "catalogue_a")


def _silver_text(rows: DataFrame) -> DataFrame:
    return rows.select(
        "source", "source_id", "isbn13", "title", _joined("authors"), "category_path", "price_current", "price_original",
        "currency", "availability", _text("stock_quantity"), "rating", _text("num_reviews"), _pairs("specs"), "product_url",
        _time("ingested_at"), "content_hash", "data_quality_score",
    )


@query
def silver_clean(spark, folder):
    return _silver_text(_silver(spark, folder))


@query
def schema_nulls(spark, folder):
    return silver.null_violations(_silver(spark, folder))


@query
def dedupe_latest(spark, folder):
    """The latest row of each text; some rows have no time."""
    day = F.when(F.col("doc_id") % 7 != 0, F.timestamp_add("DAY", (F.col("doc_id") % 28).cast("int"), F.lit(RUN_TS).cast("timestamp")))
    rows = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("content_hash"), day.alias("ingested_at"))
    return dedupe.dedupe_latest(rows, ["content_hash"], ties=["doc_id"]).select("doc_id", "lang", "source", "n_chars", "content_hash", _time("ingested_at"))


@query
def mapped_fields(spark, folder):
    """Source columns under their canonical names, and author lists without blanks."""
    rows = table(spark, folder, "part").select(
        F.col("p_name").alias("title"), F.col("p_retailprice").alias("price"), F.lit("in_stock").alias("availability"),
        (F.col("p_size") / 10.0).alias("rating"), F.concat(F.lit("http://example.com/"), F.col("p_partkey").cast("string")).alias("url"),
        F.array_append(F.transform(F.split("p_name", " "), lambda n: F.concat(F.lit("  "), n, F.lit(" "))), F.lit("  ")).alias("authors"),
    )
    done = silver.with_clean_authors(silver.rename_fields(rows))
    return done.select("title", "price_current", "availability", "rating", "product_url", _joined("authors"))


@query
def mapped_by_source(spark, folder):
    """Each kind of source has a map of its own: a page's url is no product_url."""
    rows = table(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("title"), F.col("p_retailprice").alias("price"), F.concat(F.lit("http://example.com/"), F.col("p_partkey").cast("string")).alias("url")
    )
    page = silver.rename_fields(rows.where("p_partkey % 2 = 0"), kind="page").withColumn("product_url", F.lit(None).cast("string"))
    api = silver.rename_fields(rows.where("p_partkey % 2 = 1"), kind="api").withColumn("url", F.lit(None).cast("string"))
    return page.unionByName(api).select("p_partkey", "title", "price_current", "url", "product_url")


@query
def silver_coercion(spark, folder):
    """Authors given as one text, and times that are no times."""
    rows = parsed_parts(spark, folder).withColumns(
        {"authors": F.when(F.col("upc").isNotNull(), F.col("title")), "ingested_at": F.when(F.col("upc").isNull(), "soon").otherwise(F.col("ingested_at"))}
    )
    return silver.clean(rows, "catalogue_a").select("product_url", _joined("authors"), _time("ingested_at"))


@query
def change_detect(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", F.md5("text").alias("content_hash"))
    stored = documents.join(table(spark, folder, "labels"), "doc_id", "left_semi")
    return dedupe.new_or_changed(documents, stored, ["lang", "content_hash"])


@query
def category_map(spark, folder):
    names = {"economy": "Budget", "promo": "Offers", "large": "Oversize"}
    return table(spark, folder, "part").select("p_partkey", silver.standard_category(F.col("p_type"), names).alias("category"))


@query
def category_map_table(spark, folder):
    mapping = table(spark, folder, "nation").selectExpr("concat('brand#', n_nationkey) as name", "n_name as standard_name")
    mapped = silver.map_categories(table(spark, folder, "part"), mapping, "p_brand")
    return mapped.select("p_partkey", "category_standard")


# ---- matching --------------------------------------------------------------------


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return catalogue(spark, folder, 0), catalogue(spark, folder, 1)


def _matches(spark: SparkSession, folder: str, one_to_one: bool = False) -> DataFrame:
    return matching.match(*_sides(spark, folder), one_to_one=one_to_one)


def _match_text(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "source1_id", "source2_id", "source1_title", "source2_title", _joined("source1_authors"), _joined("source2_authors"),
        "source1_price", "source2_price", "isbn_match_score", _round("title_similarity"), _round("title_match_score"),
        _round("author_match_score"), _round("confidence_score"), "match_type",
    )


@query
def match_books(spark, folder):
    return _match_text(_matches(spark, folder))


@query
def match_one_to_one(spark, folder):
    return _match_text(_matches(spark, folder, one_to_one=True))


@query
def match_stable(spark, folder):
    """One to one, and who loses a partner gets the next one."""
    return assignment.stable_match(*_sides(spark, folder)).select("source1_id", "source2_id", _round("confidence_score"))


@query
def match_repeated_ids(spark, folder):
    """One pair per id of side 1, though three rows share an id and some have no authors."""

    def side(n: int) -> DataFrame:
        key = F.substring("source_id", 2, 20).cast("bigint")
        authors = F.when(key % 5 != 0, F.col("authors"))
        return catalogue(spark, folder, n).withColumns({"authors": authors, "source_id": F.concat(F.lit("q"), F.floor(key / 6).cast("string"))})

    return matching.match(side(0), side(1)).select("source1_id", "source2_id", _round("confidence_score"))


@query
def match_best_titles(spark, folder):
    a, b = _sides(spark, folder)
    titles = a.select(F.lower("title").alias("title")).distinct()
    others = b.groupBy(F.lower("title").alias("title")).agg(F.min("source_id").alias("id"))
    best = matching.best_titles(titles, others)
    return best.selectExpr(
        "title", "best.title as best_title", "best.id as best_id", "round(-best.loss, 6) as similarity"
    )


@query
def match_distinct_titles(spark, folder):
    """No two titles of a side are equal, so every pair of titles is a pair to rule out."""
    title = F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type", "p_size", "p_partkey"))
    parts = table(spark, folder, "part").select("p_partkey", title.alias("title"))
    titles, others = parts.where("p_partkey % 2 = 0").select("title"), parts.where("p_partkey % 2 = 1").selectExpr("title", "p_partkey as id")
    return matching.best_titles(titles, others).selectExpr("title", "best.title as best_title", "best.id as best_id", "round(-best.loss, 6) as similarity")


@query
def match_summary(spark, folder):
    summary = matching.match_summary(_matches(spark, folder))
    return summary.select("match_type", "pairs", _round("avg_confidence", 4), _round("min_confidence"), _round("max_confidence"))


@query
def unmatched_rows(spark, folder):
    a, b = _sides(spark, folder)
    pairs = matching.match(a, b, one_to_one=True)
    both = dimension.unmatched(a, pairs, 1).unionByName(dimension.unmatched(b, pairs, 2))
    return both.select("source", "source_id", "title")


# ---- gold ------------------------------------------------------------------------


def _gold_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    a, b = _sides(spark, folder)
    return a.unionByName(b), matching.match(a, b, one_to_one=True)


@query
def canonical_books(spark, folder):
    rows, pairs = _gold_inputs(spark, folder)
    books = dimension.build_dimension(rows, pairs, RUN_TS)
    entry = F.transform(
        F.array_sort(F.map_entries("source_ids")), lambda e: F.concat_ws("=", e["key"], F.array_join(e["value"], ","))
    )
    return books.select(
        "book_id", "source_key", "isbn13", F.array_join(entry, "|").alias("source_ids"), "title", _joined("authors"),
        "primary_category", _joined("category_hierarchy"), _time("valid_from"), _time("valid_to"), "is_current",
        _long("version"), _round("confidence_score"), _round("match_score"), _long("source_count"),
    )


@query
def price_history(spark, folder):
    prices = facts.price_history(*_gold_inputs(spark, folder))
    return prices.select("book_id", "source", "price", "currency", _time("effective_date"), "is_discount", _round("discount_percentage"))


@query
def prices_per_source(spark, folder):
    return facts.prices_per_source(facts.price_history(*_gold_inputs(spark, folder)))


def _three_sources(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows of three sources, and links between the first and second and the second and third only."""
    key = F.col("p_partkey")
    rows = table(spark, folder, "part").select(
        F.concat(F.lit("shop_"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (key % 3 + 1).cast("int"))).alias("source"),
        F.concat(F.lit("p"), key).alias("source_id"),
        F.when(key % 7 == 0, F.lpad(key.cast("string"), 13, "9")).alias("isbn13"),
        F.concat_ws(" ", "p_name", "p_brand").alias("title"),
        F.when(key % 4 != 0, F.split("p_name", " ")).alias("authors"),
        F.when(key % 5 != 0, F.concat_ws(" > ", F.lit("Books"), "p_type")).alias("category_path"),
        "p_name", "p_size",
    )

    def linked(one: str, two: str, same: list[str], score: float) -> DataFrame:
        left = rows.where(F.col("source") == one).select(F.col("source").alias("source_a"), F.col("source_id").alias("id_a"), *same)
        right = rows.where(F.col("source") == two).groupBy(*same).agg(F.min("source_id").alias("id_b")).withColumn("source_b", F.lit(two))
        return left.join(right, same).select("source_a", "id_a", "source_b", "id_b", F.lit(score).alias("score"))

    links = linked("shop_a", "shop_b", ["title"], 0.95).unionByName(linked("shop_b", "shop_c", ["p_name", "p_size"], 0.75))
    return rows.drop("p_name", "p_size"), links


@query
def canonical_many_sources(spark, folder):
    """Books of three sources, chains over the middle one included."""
    rows, links = _three_sources(spark, folder)
    books = clusters.build_clusters(rows, clusters.book_clusters(links), RUN_TS)
    entry = F.transform(F.array_sort(F.map_entries("source_ids")), lambda e: F.concat_ws("=", e["key"], F.array_join(e["value"], ",")))
    return books.select(
        "book_id", "source_key", "isbn13", F.array_join(entry, "|").alias("source_ids"), "title", _joined("authors"), "primary_category",
        _round("confidence_score"), _round("match_score"), _long("source_count"),
    )


@query
def prices_many_sources(spark, folder):
    """Price events of three sources under the ids of their books."""
    rows, links = _three_sources(spark, folder)
    found = clusters.with_cluster_ids(rows.select("source", "source_id"), clusters.book_clusters(links))
    return found.groupBy("book_id").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("source").alias("sources"))


@query
def source_split(spark, folder):
    rows, pairs = _gold_inputs(spark, folder)
    split = dimension.source_split(dimension.build_dimension(rows, pairs, RUN_TS))
    return split.select("multi_source", "books", _round("avg_confidence", 4))


@query
def gold_profile(spark, folder):
    rows, pairs = _gold_inputs(spark, folder)
    found = profiles.gold_profile(dimension.build_dimension(rows, pairs, RUN_TS))
    return found.select(_round("avg_confidence", 4), "total_books", "books_with_isbn")


def _cents(amount: Column) -> Column:
    """Whole cents, cut off: engines round halves of binary floats differently."""
    return F.floor(amount * 100) / 100


def _price_log(spark: SparkSession, folder: str) -> DataFrame:
    unit = _cents(F.col("l_extendedprice") / F.col("l_quantity"))
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("book_id"),
        F.col("l_suppkey").alias("source"),
        _cents(unit * (1 - F.col("l_discount"))).alias("price"),
        unit.alias("price_original"),
        F.col("l_shipdate").alias("effective_date"),
        "l_orderkey",
        "l_linenumber",
    )


@query
def price_facts(spark, folder):
    log = _price_log(spark, folder)
    return log.select(
        "l_orderkey", _long("l_linenumber"), "book_id", "price",
        *facts.discount_columns(F.col("price"), F.col("price_original")),
    ).withColumn("discount_percentage", F.round("discount_percentage", 4))


@query
def price_changes(spark, folder):
    log = _price_log(spark, folder).drop("price_original")
    steps = facts.price_changes(log, ties=["l_orderkey", "l_linenumber", "price"], keys=["book_id"])
    return steps.select(
        "book_id", _time("effective_date"), "l_orderkey", _long("l_linenumber"), "price", "previous_price",
        _round("price_change", 2), _round("change_percentage", 4),
    )


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    return dimension.versions_from_log(
        table(spark, folder, "orders"), ["o_custkey"], ["o_orderpriority"], "o_orderdate", ["o_orderkey"]
    )


@query
def scd2_from_log(spark, folder):
    return _versions(spark, folder).select(
        "o_custkey", "o_orderpriority", _time("valid_from"), _time("valid_to"), "is_current", _long("version")
    )


def _burst(rows: DataFrame, key: str, time: str) -> DataFrame:
    """A third of all rows on one key and one day."""
    burst = F.col(key.replace("custkey", "orderkey").replace("book_id", "l_orderkey")) % 3 == 0
    day = F.lit("1997-01-01").cast(rows.schema[time].dataType)
    return rows.withColumns({time: F.when(burst, day).otherwise(F.col(time)), key: F.when(burst, -1).otherwise(F.col(key))})


@query
def burst_price_changes(spark, folder):
    log = _burst(_price_log(spark, folder).drop("price_original"), "book_id", "effective_date")
    steps = facts.price_changes(log, ties=["l_orderkey", "l_linenumber", "price"], keys=["book_id"])
    return steps.select("book_id", _time("effective_date"), "l_orderkey", _long("l_linenumber"), "price", "previous_price", _round("price_change", 2))


@query
def burst_versions(spark, folder):
    log = _burst(table(spark, folder, "orders"), "o_custkey", "o_orderdate")
    versions = dimension.versions_from_log(log, ["o_custkey"], ["o_orderpriority"], "o_orderdate", ["o_orderkey"])
    return versions.select("o_custkey", "o_orderpriority", _time("valid_from"), _time("valid_to"), "is_current", _long("version"))


@query
def burst_asof(spark, folder):
    """The last status of the key before each order: for a burst, that of the order just before."""
    orders = _burst(table(spark, folder, "orders"), "o_custkey", "o_orderdate")
    known = ordered.with_last_known(
        orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")), "last_finished"
    )
    return known.select("o_orderkey", "o_custkey", _text("last_finished"))


@query
def valid_at(spark, folder):
    state = dimension.valid_at(_versions(spark, folder), "1997-06-30 00:00:00")
    return state.select("o_custkey", "o_orderpriority", _long("version"))


@query
def asof_lookup(spark, folder):
    asked = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_orderdate") - F.expr("interval 60 days")).alias("asked_at")
    )
    found = dimension.as_of(asked, _versions(spark, folder), ["o_custkey"], "asked_at", ["o_orderpriority"])
    return found.select("o_orderkey", "o_custkey", _time("asked_at"), "o_orderpriority")


@query
def scd2_merge(spark, folder):
    orders = table(spark, folder, "orders")
    latest = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("o_orderpriority")
    before = orders.where("o_orderdate < timestamp_ntz '1997-01-01 00:00:00'")
    current = before.groupBy("o_custkey").agg(latest).select(
        "o_custkey", "o_orderpriority", F.lit("1997-01-01").cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"), F.lit(1).alias("version"),
    )
    incoming = orders.groupBy("o_custkey").agg(latest)
    merged = dimension.merge_versions(current, incoming, RUN_TS, key="o_custkey", tracked=["o_orderpriority"])
    return merged.select("o_custkey", "o_orderpriority", _time("valid_from"), _time("valid_to"), "is_current", _long("version"))


@query
def merge_touched_buckets(spark, folder):
    """A stored dimension after a batch of one key in a hundred has come twice."""
    orders = table(spark, folder, "orders")
    latest = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("o_orderpriority")
    before = orders.where("o_orderdate < timestamp_ntz '1997-01-01 00:00:00'").groupBy("o_custkey").agg(latest)
    batch = orders.where("o_custkey % 100 = 7").groupBy("o_custkey").agg(latest)
    schema = StructType.fromDDL("o_custkey bigint, o_orderpriority string, valid_from timestamp, valid_to timestamp, is_current boolean, version int")
    path = work_folder(spark, "dimension")
    for rows, moment in ((before, "1997-01-01 00:00:00"), (batch, RUN_TS), (batch, "2024-02-29 00:00:00")):
        dimension.merge_into(spark, path, schema, rows, moment, key="o_custkey", tracked=["o_orderpriority"])
    stored = keyed.read(spark, path, schema)
    return stored.select("o_custkey", "o_orderpriority", _time("valid_from"), _time("valid_to"), "is_current", _long("version"))


@query
def availability_timeline(spark, folder):
    names = F.create_map(*[F.lit(x) for x in ("F", "in_stock", "O", "out_of_stock", "P", "pre_order")])
    log = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("book_id"), F.lit("orders").alias("source"), names[F.col("o_orderstatus")].alias("status"),
        F.col("o_orderdate").alias("effective_date"), "o_orderkey",
    )
    history = facts.availability_history(log, ties=["o_orderkey"])
    return history.select("book_id", "source", "status", _time("effective_date"), "previous_status")


@query
def category_dim(spark, folder):
    paths = table(spark, folder, "part").select(F.concat_ws(" > ", F.lit("Books"), "p_type", "p_brand").alias("category_path"))
    return dimension.category_dimension(paths).withColumn("level", F.col("level").cast("bigint"))


# ---- quality ---------------------------------------------------------------------

_CUSTOMER_RULES = [
    quality.Rule("key_present", quality.NOT_NULL, "c_custkey"),
    quality.Rule("key_unique", quality.UNIQUE, "c_custkey"),
    quality.Rule("nation_unique", quality.UNIQUE, "c_nationkey"),
    quality.Rule("balance_range", quality.RANGE, "c_acctbal", {"min": 0.0, "max": 10000.0}, tolerance=0.5),
    quality.Rule("name_form", quality.REGEX, "c_name", {"pattern": "^Customer#[0-9]{9}$"}),
    quality.member_rule("segment_listed", "c_mktsegment", ["HOUSEHOLD", "MACHINERY", "BUILDING"]),
]


@query
def dq_rules(spark, folder):
    results = quality.check_rules(table(spark, folder, "customer"), _CUSTOMER_RULES, "run-1", RUN_TS)
    return results.select("run_id", "rule_name", "status", "field_name", "actual_value", "error_message", _time("timestamp"))


@query
def dq_split(spark, folder):
    rules = [
        quality.Rule("price_range", quality.RANGE, "unit_price", {"min": 0.0, "max": 50000.0}),
        quality.Rule("ship_rule", quality.CUSTOM, "l_returnflag", {"test": "l_returnflag <> 'R' OR l_quantity < 40"}),
    ]
    rows = table(spark, folder, "lineitem").withColumn("unit_price", _cents(F.col("l_extendedprice") / F.col("l_quantity")))
    checked = quality.with_reasons(rows.select("l_orderkey", "l_linenumber", "l_partkey", "unit_price", "l_returnflag", "l_quantity"), rules)
    return checked.groupBy(F.array_join("reasons", "|").alias("reasons")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("unit_price"), 2).alias("price_sum")
    )


@query
def dq_silver(spark, folder):
    rules = [*quality.silver_rules(["catalogue_a"]), quality.url_rule("product_url")]
    _, rejected = quality.split_rows(_silver(spark, folder), rules)
    return rejected.select("source_id", "product_url", _joined("reasons"))


@query
def dq_pages(spark, folder):
    results = quality.check_rules(table(spark, folder, "pages"), [quality.url_rule("url"), quality.Rule("https", quality.REGEX, "url", {"pattern": "^https://"}, 0.9)], "run-1", RUN_TS)
    return results.select("rule_name", "status", "expected_value", "actual_value")


@query
def profile_nulls(spark, folder):
    return profiles.null_profile(_silver(spark, folder), ["title", "price_current", "source_id", "isbn13"])


@query
def profile_price(spark, folder):
    return profiles.number_profile(table(spark, folder, "lineitem"), "l_extendedprice", 2)


@query
def profile_rating(spark, folder):
    return profiles.number_profile(_silver(spark, folder), "rating")


@query
def profile_score(spark, folder):
    return profiles.number_profile(_silver(spark, folder), "data_quality_score")


@query
def profile_groups(spark, folder):
    return profiles.group_profile(table(spark, folder, "documents"), "lang")


@query
def run_report(spark, folder):
    checked = quality.with_reasons(_silver(spark, folder), quality.silver_rules())
    report = profiles.run_metrics(checked, "run-1", "catalogue_a", RUN_TS, "2024-01-31 00:05:00")
    return report.select(
        "run_id", "source", "status", _time("start_time"), _time("end_time"), "records_ingested", "records_cleaned", "records_deduplicated",
        "records_rejected", "data_quality_failures", F.round("success_rate", 4).alias("success_rate"), _joined("errors"),
    )


# ---- storage and streams ---------------------------------------------------------


@query
def roundtrip_partitioned(spark, folder):
    path = work_folder(spark, "silver")
    accepted, _ = quality.split_rows(_silver(spark, folder), quality.silver_rules())
    for batch in ("b1", "b2", "b2"):  # a repeated batch replaces itself
        tables.write_batch(accepted, path, batch)
    back = tables.read_layer(spark, path, SILVER, source="catalogue_a")
    return back.select("batch_id", "source_id", "title", "price_current", "content_hash")


@query
def json_roundtrip(spark, folder):
    """Parsed records as JSON lines and back with their types."""
    path = work_folder(spark, "bronze")
    tables.write_json(bronze.parse_api_records(api_records(spark, folder)), path)
    return _parsed_text(tables.read_json(spark, path, PARSED))


@query
def sample_file(spark, folder):
    path = work_folder(spark, "sample")
    tables.write_sample(_silver(spark, folder), path, ["product_url"], 25)
    return spark.read.schema("source_id string, title string, product_url string").json(path)


@query
def files_by_name(spark, folder):
    path = work_folder(spark, "silver")
    tables.write_batch(_silver(spark, folder).select("source", "source_id", "title"), path, "b1")
    return tables.read_matching_files(spark, path).select("source_id", "title")


@query
def gold_roundtrip(spark, folder):
    """Price facts written by source and read with the schema of the layer."""
    path = work_folder(spark, "gold")
    log = _price_log(spark, folder).select(
        F.col("book_id").cast("string").alias("book_id"), F.lit("orders").alias("source"), "price", F.lit("USD").alias("currency"),
        F.col("effective_date").cast("timestamp").alias("effective_date"), *facts.discount_columns(F.col("price"), F.col("price_original")),
    )
    tables.write_batch(log, path, partitions=("source",))
    back = tables.read_layer(spark, path, PRICE_HISTORY, source="orders", partitions=("source",))
    return back.groupBy("source", "currency", "is_discount").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("price"), 2).alias("price_sum"))


@query
def report_roundtrip(spark, folder):
    path = work_folder(spark, "report")
    checked = quality.with_reasons(_silver(spark, folder), quality.silver_rules())
    tables.write_report(profiles.run_metrics(checked, "run-1", "catalogue_a", RUN_TS), path)
    return tables.read_json(spark, path, RUN_REPORT).select("run_id", "status", _time("start_time"), _time("end_time"), "records_ingested", "records_rejected")


@query
def default_batch(spark, folder):
    """A batch without an id is named by the time of writing and found by that pattern."""
    path = work_folder(spark, "silver")
    tables.write_batch(_silver(spark, folder).where("source_id is not null"), path)
    back = tables.read_layer(spark, path, SILVER).where(F.col("batch_id").rlike("^[0-9]{8}_[0-9]{6}$"))
    return back.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("batch_id").alias("batches"))


@query
def balanced_write(spark, folder):
    """Orders by status, two of the three with nearly half of all rows: files of like size."""
    path = work_folder(spark, "orders")
    rows = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("source"), "o_orderkey", "o_totalprice")
    tables.write_batch(rows, path, "b1", file_bytes=64 << 10)
    schema = StructType.fromDDL("o_orderkey bigint, o_totalprice double")
    back = tables.read_layer(spark, path, schema)
    return back.groupBy("source", "batch_id").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("price_sum"))


@query
def layer_counts(spark, folder):
    """Rows of bronze, silver and gold."""
    accepted, _ = quality.split_rows(_silver(spark, folder), quality.silver_rules())
    layers = {"bronze": product_pages(spark, folder), "silver": accepted, "gold": dimension.category_dimension(_silver(spark, folder))}
    return profiles.layer_counts(layers)


@query
def gold_contract(spark, folder):
    """Every gold table against its schema: columns that differ and nulls where none may be."""
    rows, links = _three_sources(spark, folder)
    found = clusters.book_clusters(links)
    checked = quality.with_reasons(_silver(spark, folder), quality.silver_rules())
    prices = clusters.with_cluster_ids(catalogue(spark, folder, 0), found).select(
        "book_id", "source", F.col("price_current").alias("price"), "currency", F.col("ingested_at").alias("effective_date"), *facts.discount_columns(F.col("price_current"), F.col("price_original"))
    )
    status = table(spark, folder, "orders").select(F.col("o_custkey").cast("string").alias("book_id"), F.lit("orders").alias("source"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp").alias("effective_date"), "o_orderkey")
    built = {
        "canonical_books": (clusters.build_clusters(rows, found, RUN_TS), CANONICAL),
        "price_history": (prices, PRICE_HISTORY),
        "availability_history": (facts.availability_history(status, ties=["o_orderkey"]), AVAILABILITY_HISTORY),
        "category_dimension": (dimension.category_dimension(_silver(spark, folder)), CATEGORY_DIMENSION),
        "rule_results": (quality.check_rules(_silver(spark, folder), quality.silver_rules(), "run-1", RUN_TS), RULE_RESULT),
        "run_report": (profiles.run_metrics(checked, "run-1", "catalogue_a", RUN_TS), RUN_REPORT),
    }
    parts = [
        silver.null_violations(df, schema).agg(F.count(F.lit(1)).alias("required"), F.sum("nulls").alias("nulls")).select(
            F.lit(name).alias("table_name"), F.lit(",".join(silver.schema_differences(df, schema))).alias("differences"), "required", "nulls"
        )
        for name, (df, schema) in built.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def verified_write(spark, folder):
    """Counts of what was written and read; an empty batch in between leaves nothing."""
    path = work_folder(spark, "silver")
    rows = _silver(spark, folder).where("source_id is not null")
    tables.write_batch(rows, path, "b1")
    tables.write_batch(rows.limit(0), path, "b2")
    return tables.verify_written(rows, tables.read_layer(spark, path, SILVER))


def _new_files(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stream of the files of a given table, be it one file or a folder of files.

    A stream takes one file only by a pattern, so the last letter is one.
    """
    schema = table(spark, folder, name).schema
    return incremental.read_new_files(spark, f"{folder}/{name}.parque[t]", schema, "*")


def _load_documents(spark, folder, path, states):
    """Documents from the stream of files to a table without repeated texts, once per checkpoint folder."""
    stream = _new_files(spark, folder, "documents")

    def to_rows(documents: DataFrame) -> DataFrame:
        return documents.select(
            "doc_id", "lang", "source", F.md5("text").alias("content_hash"), F.lit(RUN_TS).cast("timestamp").alias("ingested_at")
        )

    target = to_rows(spark.read.parquet(f"{folder}/documents.parquet")).schema
    store = incremental.append_unseen(path, target, ("content_hash",), ties=("doc_id",))
    for state in states:
        incremental.load_increment(stream, to_rows, store, state).awaitTermination()
    stored = keyed.read(spark, path, target)
    if stored is None:  # no documents
        stored = spark.createDataFrame([], target)
    return stored.select("doc_id", "lang", "source", "content_hash")


@query
def incremental_load(spark, folder):
    """The second start finds no new files."""
    return _load_documents(spark, folder, work_folder(spark, "documents"), [work_folder(spark, "stream")] * 2)


@query
def incremental_restart(spark, folder):
    """A start with a new checkpoint reads all files again, adds nothing and loses nothing."""
    return _load_documents(spark, folder, work_folder(spark, "documents"), [work_folder(spark, "stream"), work_folder(spark, "stream")])


@query
def stream_late_rows(spark, folder):
    """Files that come out of order: stored, repeated and late rows together are all rows."""
    source, path = work_folder(spark, "arrivals"), work_folder(spark, "late")
    events = table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ingested_at"), "user_id", "event_type", "event_id")
    middle = events.agg(F.expr("percentile(unix_micros(ingested_at), 0.5)").cast("bigint").alias("m")).first()["m"]
    later = F.unix_micros("ingested_at") >= middle
    for part in (events.where(later), events.where(~later)):  # the newer half arrives first
        part.coalesce(1).write.mode("append").parquet(source)
    stream = incremental.read_new_files(spark, source, events.schema, files_per_batch=1)
    store = incremental.store_with_late_rows(path, events.schema, ("user_id", "event_type"), delay="20 days", ties=("event_id",))
    incremental.load_increment(stream, lambda df: df, store, work_folder(spark, "stream")).awaitTermination()
    return spark.read.schema(incremental.COUNTS).parquet(f"{path}/counts").select("batch", "came", "stored", "repeats", "late")


@query
def stream_dedup(spark, folder):
    """Keys of the event stream, each once within the watermark."""
    path, state = work_folder(spark, "events"), work_folder(spark, "stream")
    events = _new_files(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ingested_at"), "user_id", "event_type"
    )
    unique = incremental.drop_repeats(events, delay="60 days", keys=("user_id", "event_type"))
    (
        unique.select("user_id", "event_type")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema("user_id bigint, event_type string").parquet(path)
