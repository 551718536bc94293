import pytest
from pyspark.sql import functions as F

from shelfmark.functions import records
from shelfmark.operators import dedupe, silver
from shelfmark.schemas import SILVER
from tests_support import parsed


def first(df):
    return df.collect()[0]


def test_full_record(spark):
    out = silver.clean(parsed(spark), "shop")
    row = first(out)
    assert out.columns == [f.name for f in SILVER]
    assert row.source == "shop" and row.source_id == row.isbn13 == "9781234567890"
    assert row.category_path == "Books > Travel" and row.availability == "in_stock" and row.stock_quantity == 19
    assert row.data_quality_score == 1.0 and row.ingested_at.microsecond == 250000
    import hashlib

    assert row.content_hash == hashlib.md5(b"Book_9781234567890_http://x/1").hexdigest()
    assert silver.schema_differences(out) == []
    assert {r.field_name: r.nulls for r in silver.null_violations(out).collect()}["title"] == 0


def test_missing_fields(spark):
    row = first(
        silver.clean(
            parsed(
                spark, title=None, authors=None, price_current=None, currency=None, availability=None, category=None,
                product_info=None, upc=None, ingested_at="not a time",
            ),
            "shop",
        )
    )
    assert row.authors == [] and row.specs == {} and row.currency == "GBP" and row.category_path == "Books > Unknown"
    assert row.availability == "unknown" and row.stock_quantity is None and row.ingested_at is None
    assert row.data_quality_score == 0.0 and row.source_id is None


def test_title_stands_in_for_a_missing_upc(spark):
    row = first(silver.clean(parsed(spark, upc=None), "shop"))
    assert row.source_id == "Book" and row.isbn13 is None and row.data_quality_score == 0.8


def test_isbn_needs_thirteen_digits(spark):
    assert first(silver.clean(parsed(spark, upc="a22124811bfa8350"), "shop")).isbn13 is None


@pytest.mark.parametrize(
    "text, status",
    [("In stock (19 available)", "in_stock"), ("in_stock", "in_stock"), ("OUT OF STOCK", "out_of_stock"),
     ("out_of_stock", "out_of_stock"), ("pre_order", "pre_order"), ("soon", "unknown"), (None, "unknown")],
)
def test_availability(spark, text, status):
    assert first(silver.clean(parsed(spark, availability=text), "shop")).availability == status


def test_stock_text_without_number(spark):
    row = first(silver.clean(parsed(spark, product_info={"availability": "In stock"}), "shop"))
    assert row.stock_quantity is None


def test_authors(spark):
    df = spark.createDataFrame([(["  Author One  ", "", "Author Two  "],)], "authors array<string>")
    assert first(silver.with_clean_authors(df)).authors == ["Author One", "Author Two"]
    single = parsed(spark).withColumn("authors", F.lit("Solo"))
    assert first(silver.clean(single, "shop")).authors == ["Solo"]


def test_discount(spark):
    df = spark.createDataFrame([(25.0, 20.0), (0.0, 5.0), (None, 5.0)], "o double, c double")
    out = [r[0] for r in df.select(records.discount_percentage(F.col("o"), F.col("c"))).collect()]
    assert out == [20.0, None, None]


def test_schema_differences(spark):
    df = spark.createDataFrame([(1, "x")], "source int, other string")
    found = silver.schema_differences(df)
    assert "missing: title" in found and "extra: other" in found
    assert "type of source: int instead of string" in found


def test_rename_and_categories(spark):
    df = spark.createDataFrame([("T", 1.0, "u", " Travel ")], "title string, price double, url string, category string")
    out = silver.rename_fields(df)
    assert out.columns == ["title", "price_current", "product_url", "category"]
    assert first(out.select(silver.standard_category(F.col("category")).alias("c"))).c == "Travel & Tourism"
    assert first(out.select(silver.standard_category(F.lit("cooking")).alias("c"))).c == "Unknown"
    mapping = spark.createDataFrame([("TRAVEL", "Trips")], "name string, standard_name string")
    assert first(silver.map_categories(out, mapping, "category")).category_standard == "Trips"


def test_dedupe_latest(spark):
    rows = [("h1", "2024-01-01", "a", "2"), ("h1", "2024-01-02", "a", "9"), ("h1", "2024-01-02", "a", "3"), ("h2", "2024-01-01", "b", "1")]
    df = spark.createDataFrame(rows, "content_hash string, t string, source string, source_id string")
    df = df.withColumn("ingested_at", F.to_timestamp("t"))
    out = {r.content_hash: r.source_id for r in dedupe.dedupe_latest(df).collect()}
    assert out == {"h1": "3", "h2": "1"}
    plan = dedupe.dedupe_latest(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min_by" in plan


def test_new_or_changed(spark):
    schema = "source string, source_id string, content_hash string"
    stored = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y")], schema)
    batch = spark.createDataFrame([("a", "1", "x"), ("a", "2", "z"), ("a", "3", "x"), ("a", None, "x")], schema)
    out = dedupe.new_or_changed(batch, stored).collect()
    assert {(r.source_id, r.content_hash) for r in out} == {("2", "z"), ("3", "x"), (None, "x")}
    assert dedupe.new_or_changed(stored, stored).count() == 0


def test_latest_row_without_time(spark):
    rows = spark.createDataFrame([("h", None, "s", "1"), ("h", "2024-02-01", "s", "2")], "content_hash string, ingested_at string, source string, source_id string")
    assert [r.source_id for r in dedupe.dedupe_latest(rows).collect()] == ["2"]


def test_null_identity_is_stored_once(spark):
    rows = spark.createDataFrame([("s", None, "h"), ("s", "1", "h")], "source string, source_id string, content_hash string")
    assert dedupe.new_or_changed(rows, rows).count() == 0


def test_mapping_that_repeats_a_name(spark):
    names = spark.createDataFrame([("Travel", "B"), (" travel", "A")], "name string, standard_name string")
    rows = spark.createDataFrame([("TRAVEL ",)], "c string")
    assert [r.category_standard for r in silver.map_categories(rows, names, "c").collect()] == ["A"]
