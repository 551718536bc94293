from shelfmark.schemas import PARSED


def parsed(spark, **fields):
    """A parsed record with some fields replaced."""
    base = dict(
        title="Book", authors=["A"], price_current=10.0, price_original=None, currency="USD", availability="In stock",
        rating=4.0, num_reviews=3, description=None, category="Travel", product_info={"availability": "In stock (19 available)"},
        upc="9781234567890", image_url=None, source_url="http://x/1", ingested_at="2024-01-01T10:00:00.250000", http_status=200,
    )
    row = {**base, **fields}
    return spark.createDataFrame([tuple(row[f.name] for f in PARSED)], PARSED)
