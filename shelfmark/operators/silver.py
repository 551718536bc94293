"""Parsed records to the silver table, as projections that Catalyst folds into one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, TimestampType

from shelfmark.functions import records
from shelfmark.schemas import SILVER

# Column names of each kind of source and what the canonical tables call them.
FIELD_MAPPING = {
    "title": "title",
    "price": "price_current",
    "availability": "availability",
    "rating": "rating",
    "url": "product_url",
}

# The same by kind of source, where a name means different things.
SOURCE_FIELDS = {
    "page": {"title": "title", "price": "price_current", "availability": "availability", "rating": "rating"},
    "api": {"title": "title", "price": "price_current", "url": "product_url"},
}

# Category spelling by lower-case name.
CATEGORY_NAMES = {
    "travel": "Travel & Tourism",
    "music": "Arts & Music",
}


def rename_fields(df: DataFrame, mapping: dict[str, str] | None = None, kind: str | None = None) -> DataFrame:
    """Source column names to canonical ones; columns without an entry stay.

    ``kind`` takes the map of one kind of source (``SOURCE_FIELDS``) instead.
    """
    if kind is not None:
        mapping = SOURCE_FIELDS[kind]
    return df.withColumnsRenamed(FIELD_MAPPING if mapping is None else mapping)


def _author_list(df: DataFrame) -> Column:
    authors = F.col("authors")
    if not isinstance(df.schema["authors"].dataType, ArrayType):
        authors = F.when(authors.isNotNull(), F.array(authors.cast("string")))
    return F.coalesce(authors, F.array().cast("array<string>"))


def _moment(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, TimestampType):
        return F.col(name)
    return F.try_to_timestamp(F.col(name))


def clean(df: DataFrame, source: str, currency: str = "GBP", root: str = "Books") -> DataFrame:
    """The silver transform: 16 parsed columns to the 20 columns of ``SILVER``."""
    df = df.withColumn("authors", _author_list(df))
    upc, category = F.col("upc"), F.col("category")
    columns = {
        "source": F.lit(source),
        "source_id": F.coalesce(upc, F.col("title")),
        "isbn13": records.isbn13(upc),
        "title": F.col("title"),
        "authors": F.col("authors"),
        "category_path": F.concat(F.lit(f"{root} > "), F.coalesce(category, F.lit("Unknown"))),
        "price_current": F.col("price_current").try_cast("double"),
        "price_original": F.col("price_original").try_cast("double"),
        "currency": F.coalesce(F.col("currency"), F.lit(currency)),
        "availability": records.availability_status(F.col("availability")),
        "stock_quantity": records.stock_quantity(F.col("product_info")),
        "rating": F.col("rating"),
        "num_reviews": F.col("num_reviews"),
        "specs": F.coalesce(F.col("product_info"), F.create_map().cast("map<string,string>")),
        "image_url": F.col("image_url"),
        "product_url": F.col("source_url"),
        "description": F.col("description"),
        "ingested_at": _moment(df, "ingested_at"),
        "content_hash": records.content_hash("title", "upc", "source_url"),
        "data_quality_score": records.quality_score(),
    }
    return df.select(*[expr.alias(name) for name, expr in columns.items()])


def with_clean_authors(df: DataFrame) -> DataFrame:
    return df.withColumn("authors", records.clean_authors(F.col("authors")))


def standard_category(
    category: Column, names: dict[str, str] | None = None, default: str = "Unknown"
) -> Column:
    """Standard name of a category from a map of the caller's, which is small by nature."""
    names = CATEGORY_NAMES if names is None else names
    table = F.create_map(*[F.lit(part) for entry in names.items() for part in entry])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(category))), F.lit(default))


def map_categories(df: DataFrame, mapping: DataFrame, column: str, default: str = "Unknown") -> DataFrame:
    """As ``standard_category`` with a (name, standard_name) table of any size.

    Names compare without case and outer blanks; of several entries for one name the
    smallest counts. Spark broadcasts the mapping if its measured size allows it and
    shuffles otherwise.
    """
    lookup = mapping.groupBy(F.lower(F.trim("name")).alias("_name")).agg(F.min("standard_name").alias("_standard"))
    return (
        df.join(lookup, F.lower(F.trim(F.col(column))) == F.col("_name"), "left")
        .withColumn("category_standard", F.coalesce("_standard", F.lit(default)))
        .drop("_name", "_standard")
    )


def _plain(kind: DataType) -> str:
    return kind.simpleString()


def schema_differences(df: DataFrame, schema: StructType = SILVER) -> list[str]:
    """Missing, extra and wrongly typed columns; reads no data."""
    actual = {f.name: f.dataType for f in df.schema}
    expected = {f.name: f.dataType for f in schema}
    found = [f"missing: {n}" for n in expected if n not in actual]
    found += [f"extra: {n}" for n in actual if n not in expected]
    found += [
        f"type of {n}: {_plain(actual[n])} instead of {_plain(t)}"
        for n, t in expected.items()
        if n in actual and _plain(actual[n]) != _plain(t)
    ]
    return found


def null_violations(df: DataFrame, schema: StructType = SILVER) -> DataFrame:
    """Nulls per required column, counted in one pass: (field_name, nulls)."""
    required = [f.name for f in schema if not f.nullable and f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in required])
    pairs = F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(n).alias("nulls")) for n in required])
    return counts.select(F.inline(pairs))
