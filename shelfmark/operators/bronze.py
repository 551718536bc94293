"""Raw pages and API records to parsed records.

Input of the page operators is a bronze table (source_url, raw_content, http_status,
ingested_at). All fields of a page come from one projection over it. Functions of a page
take plain markup: the operators on tables bring it into that form once
(``functions.html.normalized``), and so must who calls a function on a page of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfmark.functions import html as h
from shelfmark.functions.records import availability_status
from shelfmark.schemas import PARSED

# Rating words, symbols of currencies in the order they are looked for,
# and the author of a page that names none.
RATINGS = {"One": 1.0, "Two": 2.0, "Three": 3.0, "Four": 4.0, "Five": 5.0}
CURRENCY_SYMBOLS = {"£": "GBP", "$": "USD", "€": "EUR"}
NO_AUTHOR = "Unknown Author"
NO_CATEGORY = "Unknown"

_SPEC_TABLE = r"(?is)<table\b[^>]*\bclass\s*=\s*[\"']table table-striped[\"'][^>]*>(.*?)</table\s*>"
_SPEC_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
_LINK = r"(?is)<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*)[\"']"


def title(html: Column) -> Column:
    return h.blank_to_null(h.strip_tags(h.first_match(html, h.element("h1"))))


def price_text(html: Column) -> Column:
    return h.strip_tags(h.inside_class(html, "price_color"))


def price(text: Column) -> Column:
    """Digits and dots as a number, null if they form none."""
    return F.regexp_replace(text, r"[^\d.]", "").try_cast("double")


def currency(text: Column, default: str = "GBP") -> Column:
    found = F.lit(default)
    for symbol, code in reversed(CURRENCY_SYMBOLS.items()):
        found = F.when(text.contains(symbol), code).otherwise(found)
    return found


def availability(html: Column) -> Column:
    return availability_status(h.strip_tags(h.inside_class(html, "availability")))


def rating(html: Column) -> Column:
    """Value of the first class of the star element that starts with a number word."""
    classes = h.first_match(html, r"\bclass\s*=\s*[\"']((?:[^\"']*\s)?star-rating(?:\s[^\"']*)?)[\"']")
    word = F.regexp_extract(classes, r"(?:^|\s)(One|Two|Three|Four|Five)", 1)
    values = F.create_map(*[F.lit(x) for entry in RATINGS.items() for x in entry])
    return F.when(html.contains("star-rating"), F.try_element_at(values, word))


def description(html: Column) -> Column:
    """First of two places that holds a paragraph, with two broken encodings repaired.

    The places: right after the element ``product_description``, else directly below
    the element of class ``product_page``.
    """

    def after_heading(rest: Column) -> Column:
        end = F.substring(rest, F.greatest(F.instr(rest, "</div"), F.lit(1)), F.length(rest))
        paragraph = F.regexp_extract(end, r"(?is)^</div\s*>\s*(<p\b[^>]*>.*?)</p\s*>", 1)
        return F.regexp_replace(h.blank_to_null(paragraph), r"(?is)^<p\b[^>]*>", "")

    anchor = F.regexp_extract(html, r"\bid\s*=\s*[\"']product_description[\"']", 0)
    rest = F.when(
        html.contains("product_description"),
        h.bind(h.blank_to_null(anchor), lambda a: F.substring(html, F.instr(html, a), F.length(html))),
    )
    below = F.when(html.contains("product_page"), F.get(h.children(html, "product_page", "p"), F.lit(0)))
    text = h.strip_tags(F.coalesce(h.bind(rest, after_heading), below))
    return F.replace(F.replace(text, F.lit("â"), F.lit("'")), F.lit("Â"), F.lit(""))


def spec_map(html: Column) -> Column:
    """Rows of the product table as a map; of equal keys the last row counts."""
    table = F.when(html.contains("table-striped"), h.first_match(html, _SPEC_TABLE))
    rows = F.regexp_extract_all(table, F.lit(_SPEC_ROW), F.lit(1))
    cells = F.transform(
        rows,
        lambda row: F.struct(
            F.replace(F.lower(h.strip_tags(_cell(row, "th"))), F.lit(" "), F.lit("_")).alias("key"),
            F.replace(h.strip_tags(_cell(row, "td")), F.lit("Â"), F.lit("")).alias("value"),
        ),
    )
    cells = F.filter(cells, lambda c: c["key"].isNotNull() & c["value"].isNotNull())
    empty = F.create_map().cast("map<string,string>")
    specs = F.aggregate(
        cells,
        empty,
        lambda done, c: F.map_concat(
            F.map_filter(done, lambda key, _: key != c["key"]), F.create_map(c["key"], c["value"])
        ),
    )
    return F.coalesce(specs, empty)


def _cell(row: Column, tag: str) -> Column:
    """Inside of a cell, which may be empty; null if the row has no such cell."""
    return F.regexp_replace(h.first_match(row, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", 0), rf"(?is)^<{tag}\b[^>]*>|</{tag}\s*>$", "")


def upc(specs: Column) -> Column:
    return F.coalesce(h.blank_to_null(specs["upc"]), specs["universal_product_code"])


def _names(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda name: F.trim(name))


def authors(html: Column, specs: Column) -> Column:
    """Names beside the first header on the page, then in the table, that speaks of an author."""
    beside = r"(?is)<th\b[^>]*>[^<]*author[^<]*</th\s*>\s*<td\b[^>]*>(.*?)</td\s*>"
    filled = F.map_filter(specs, lambda key, value: key.contains("author") & (F.trim(value) != ""))
    names = F.coalesce(h.blank_to_null(h.strip_tags(h.first_match(html, beside))), F.get(F.map_values(filled), F.lit(0)))
    return F.coalesce(_names(names), F.array(F.lit(NO_AUTHOR)))


def category_from_breadcrumb(html: Column) -> Column:
    crumbs = h.elements(h.inside_class(html, "breadcrumb"), "li")
    third = h.blank_to_null(F.array_join(F.slice(crumbs, 3, F.size(crumbs)), ""))
    return F.coalesce(h.strip_tags(h.bind(third, h.inner)), F.lit(NO_CATEGORY))


def category_from_url(url: Column) -> Column:
    """The second path segment after ``category``, in title case."""
    parts = F.split(url, "/")
    at = F.array_position(parts, "category").cast("int")
    found = F.when(at > 0, F.get(parts, at + 1))
    return F.coalesce(F.initcap(F.replace(found, F.lit("_"), F.lit(" "))), F.lit(NO_CATEGORY))


def image_source(html: Column) -> Column:
    """Address of the shown picture as the page gives it."""
    image = h.first_match(h.inside_class(html, "item active"), r"(?is)(<img\b[^>]*>)")
    return h.unescape(h.first_match(image, h.attribute("src")), attribute=True)


def review_count(specs: Column) -> Column:
    text = F.coalesce(specs["number_of_reviews"], F.lit("0"))
    return F.coalesce(F.when(text.rlike("^[0-9]+$"), text.try_cast("int")), F.lit(0))


def is_detail_page(url: Column) -> Column:
    """A product page, not a listing of a category."""
    return url.contains("catalogue/") & ~url.contains("/category/")


def _fragments(pages: DataFrame) -> DataFrame:
    """What several fields use, or one field uses several times, taken out of the page once."""
    page = F.col("raw_content")
    pages = pages.withColumn("raw_content", h.normalized(page))
    return pages.select(
        "source_url",
        "ingested_at",
        "http_status",
        page.alias("_html"),
        title(page).alias("_title"),
        price_text(page).alias("_price"),
        spec_map(page).alias("_specs"),
        image_source(page).alias("_image"),
    )


def _fields(fragments: DataFrame) -> DataFrame:
    page, specs = F.col("_html"), F.col("_specs")
    fields = {
        "title": F.col("_title"),
        "authors": authors(page, specs),
        "price_current": price(F.col("_price")),
        "price_original": F.lit(None),
        "currency": currency(F.col("_price")),
        "availability": availability(page),
        "rating": rating(page),
        "num_reviews": review_count(specs),
        "description": description(page),
        "category": category_from_breadcrumb(page),
        "product_info": specs,
        "upc": upc(specs),
        "image_url": h.resolve_url(F.col("source_url"), F.col("_image")),
        "source_url": F.col("source_url"),
        "ingested_at": F.col("ingested_at").cast("string"),
        "http_status": F.col("http_status"),
    }
    return fragments.select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in PARSED])


def page_fields(pages: DataFrame) -> DataFrame:
    """The 16 parsed columns of every page, complete or not."""
    return _fields(_fragments(pages))


def _missing(fragment: Column) -> Column:
    """What a page lacks, null if it is complete. A price of 0 counts as none."""
    no_price = F.coalesce(price(fragment["_price"]), F.lit(0.0)) == 0
    no_title = fragment["_title"].isNull()
    return h.blank_to_null(F.concat_ws(",", F.when(no_title, "title"), F.when(no_price, "price_current")))


def _detail_fragments(pages: DataFrame, wanted: Callable[[Column], Column]) -> DataFrame:
    """Fragments of the product pages for which ``wanted`` holds.

    The test is part of a generator. As a plain filter it would be pushed below the
    projection, and what it reads would be extracted from the page twice.
    """
    fragments = _fragments(pages.where(is_detail_page(F.col("source_url"))))
    row = F.array(F.struct(*fragments.columns))
    return fragments.select(F.inline(F.filter(row, wanted)))


def parse_pages(pages: DataFrame) -> DataFrame:
    """Parsed records of all complete product pages."""
    return _fields(_detail_fragments(pages, lambda f: _missing(f).isNull()))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Address and reason of the product pages that ``parse_pages`` leaves out."""
    left_out = _detail_fragments(pages, lambda f: _missing(f).isNotNull())
    return left_out.select("source_url", _missing(F.struct("_price", "_title")).alias("missing_fields"))


def _links(pages: DataFrame, within: str | None) -> DataFrame:
    """(source_url, position, _ref) of every link, or of those anywhere in a ``within`` element."""

    def links_of(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit(_LINK), F.lit(1))

    found = links_of(F.col("raw_content"))
    if within:
        ended = lambda part: F.split(part, rf"(?i)</{within}[\s>]", 2)[0]
        found = F.flatten(F.transform(h.elements(F.col("raw_content"), within), lambda part: links_of(ended(part))))
    pages = pages.withColumn("raw_content", h.normalized(F.col("raw_content")))
    links = pages.select("source_url", F.posexplode(found).alias("position", "_ref"))
    return links.withColumn("_ref", h.unescape(F.col("_ref"), attribute=True))


def page_links(pages: DataFrame, within: str | None = None) -> DataFrame:
    """One row per link of a page, made absolute: (source_url, position, link)."""
    resolved = h.resolve_url(F.col("source_url"), F.col("_ref"))
    return _links(pages, within).select("source_url", "position", resolved.alias("link"))


def catalogue_links(pages: DataFrame, site: str) -> DataFrame:
    """Product links of listing pages; leading steps up lead to the site's ``catalogue/``."""
    inner = F.replace(F.col("_ref"), F.lit("../../../"), F.lit(""))
    resolved = h.resolve_url(F.lit(f"{site.rstrip('/')}/catalogue/"), inner)
    return _links(pages, "h3").select("source_url", "position", resolved.alias("link"))


def category_links(pages: DataFrame, scope: str = "side_categories") -> DataFrame:
    """The category list of a home page: (source_url, position, name, link).

    The links in the inner lists of the element with class ``scope``.
    """
    pages = pages.withColumn("raw_content", h.normalized(F.col("raw_content")))
    side = h.inside_class(F.col("raw_content"), scope)
    lists = F.slice(h.elements(side, "ul"), 2, F.size(h.elements(side, "ul")))
    inside = F.transform(lists, lambda u: F.split(u, r"(?i)</ul[\s>]", 2)[0])
    found = F.flatten(F.transform(inside, lambda u: F.regexp_extract_all(u, F.lit(r"(?is)(<a\b[^>]*\bhref\s*=[^>]*>.*?)</a\s*>"), F.lit(1))))
    links = pages.select("source_url", F.posexplode(found).alias("position", "_a"))
    ref = h.unescape(h.first_match(F.col("_a"), _LINK), attribute=True)
    return links.select("source_url", "position", h.strip_tags(F.col("_a")).alias("name"), h.resolve_url(F.col("source_url"), ref).alias("link"))


def next_page(html: Column, url: Column) -> Column:
    return h.resolve_url(url, h.unescape(h.first_match(h.inside_class(html, "next", "li"), _LINK), attribute=True))


def first_per_group(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """A crawl's cap, by request: the first n rows per group.

    Spark applies the limit before the shuffle as well, so big groups shrink where they are.
    """
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


# ---- API records -----------------------------------------------------------------

# Fields of an API record, and those of them that make its map.
API_FIELDS = [
    "title", "subtitle", "authors", "publisher", "language", "isbn10", "isbn13", "pages", "year", "rating",
    "desc", "price", "image", "url",
]
API_RECORD = StructType([StructField(name, StringType()) for name in API_FIELDS])
_CORRUPT = "_corrupt_record"


def read_api_records(records: DataFrame, column: str = "raw_content") -> DataFrame:
    """API JSON as columns; ``malformed`` holds the text of what is no JSON object."""
    schema = StructType([*API_RECORD.fields, StructField(_CORRUPT, StringType())])
    kept = [c for c in records.columns if c != column and c not in API_FIELDS]
    parsed = F.from_json(F.col(column), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    return records.select(*kept, parsed.alias("_r")).select(
        *kept, *[F.col(f"_r.{name}") for name in API_FIELDS], F.col(f"_r.{_CORRUPT}").alias("malformed")
    )


def api_fields(rows: DataFrame) -> DataFrame:
    """API columns to the 16 parsed columns."""
    text = {name: F.coalesce(F.col(name), F.lit("")) for name in API_FIELDS}
    info = F.map_filter(
        F.create_map(
            *[x for name in ("isbn10", "isbn13", "publisher", "year", "pages", "language") for x in (F.lit(name), text[name])]
        ),
        lambda _, value: value != "",
    )
    optional = {c: F.col(c) for c in ("ingested_at", "http_status") if c in rows.columns}
    fields = {
        "title": text["title"],
        "authors": F.when(text["authors"] != "", _names(F.col("authors"))).otherwise(F.array().cast("array<string>")),
        "price_current": F.replace(F.col("price"), F.lit("$"), F.lit("")).try_cast("double"),
        "currency": F.lit("USD"),
        "availability": F.lit("in_stock"),
        "description": text["desc"],
        "category": F.coalesce(h.blank_to_null(F.col("subtitle")), F.lit("Technology")),
        "product_info": info,
        "upc": text["isbn13"],
        "image_url": text["image"],
        "source_url": text["url"],
        **optional,
    }
    return rows.select(
        *[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PARSED]
    )


def _api_rows(records: DataFrame, column: str, malformed: bool) -> DataFrame:
    """Well-formed or malformed records. The test is part of a generator, so the text is parsed once."""
    rows = read_api_records(records, column)
    wanted = F.filter(F.array(F.struct(*rows.columns)), lambda r: r["malformed"].isNotNull() if malformed else r["malformed"].isNull())
    return rows.select(F.inline(wanted))


def parse_api_records(records: DataFrame, column: str = "raw_content") -> DataFrame:
    return api_fields(_api_rows(records, column, False))


def rejected_api_records(records: DataFrame, column: str = "raw_content") -> DataFrame:
    """What ``parse_api_records`` leaves out: the other columns, and the malformed text."""
    rows = _api_rows(records, column, True)
    return rows.select(*[c for c in rows.columns if c not in API_FIELDS])


def hydrate(listed: DataFrame, details: DataFrame, key: str = "isbn13", null_detail_wins: bool = False) -> DataFrame:
    """List rows completed by their detail rows; rows without details drop out.

    Where both have a column the detail counts; a null detail only if asked for.
    """
    left, right = listed.alias("l"), details.alias("d")
    names = [key, *[c for c in dict.fromkeys([*listed.columns, *details.columns]) if c != key]]
    columns = []
    for name in names:
        if name == key:
            columns.append(F.col(f"l.{key}"))
        elif name not in details.columns:
            columns.append(F.col(f"l.{name}"))
        elif name not in listed.columns or null_detail_wins:
            columns.append(F.col(f"d.{name}"))
        else:
            columns.append(F.coalesce(f"d.{name}", f"l.{name}").alias(name))
    return left.join(right, F.col(f"l.{key}") == F.col(f"d.{key}")).where(F.col(f"l.{key}").cast("string") != "").select(*columns)
