"""Table schemas of the bronze, silver and gold layers."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_STR = StringType()
_DBL = DoubleType()
_INT = IntegerType()
_TS = TimestampType()
_STRS = ArrayType(_STR)
_TAGS = MapType(_STR, _STR)


def _table(required: dict, optional: dict, order: list[str] | None = None) -> StructType:
    fields = {n: StructField(n, t, False) for n, t in required.items()}
    fields |= {n: StructField(n, t, True) for n, t in optional.items()}
    return StructType([fields[n] for n in (order or list(fields))])


RAW_RECORD = _table(
    {"source": _STR, "source_url": _STR, "raw_content": _STR, "http_status": _INT, "ingested_at": _TS},
    {"file_path": _STR},
)

PARSED = _table(
    {},
    {
        "title": _STR,
        "authors": _STRS,
        "price_current": _DBL,
        "price_original": _DBL,
        "currency": _STR,
        "availability": _STR,
        "rating": _DBL,
        "num_reviews": _INT,
        "description": _STR,
        "category": _STR,
        "product_info": _TAGS,
        "upc": _STR,
        "image_url": _STR,
        "source_url": _STR,
        "ingested_at": _STR,
        "http_status": _INT,
    },
)

# The silver column order is part of the table contract.
SILVER = _table(
    {
        "source": _STR,
        "source_id": _STR,
        "title": _STR,
        "category_path": _STR,
        "price_current": _DBL,
        "currency": _STR,
        "availability": _STR,
        "product_url": _STR,
        "ingested_at": _TS,
        "content_hash": _STR,
        "data_quality_score": _DBL,
    },
    {
        "isbn13": _STR,
        "authors": _STRS,
        "price_original": _DBL,
        "stock_quantity": _INT,
        "rating": _DBL,
        "num_reviews": _INT,
        "specs": _TAGS,
        "image_url": _STR,
        "description": _STR,
    },
    [
        "source", "source_id", "isbn13", "title", "authors", "category_path", "price_current",
        "price_original", "currency", "availability", "stock_quantity", "rating", "num_reviews",
        "specs", "image_url", "product_url", "description", "ingested_at", "content_hash",
        "data_quality_score",
    ],
)

CANONICAL = _table(
    {
        "book_id": _STR,
        "title": _STR,
        "primary_category": _STR,
        "valid_from": _TS,
        "is_current": BooleanType(),
        "version": _INT,
        "confidence_score": _DBL,
        "source_count": _INT,
    },
    {
        "source_key": _STR,
        "isbn13": _STR,
        "source_ids": MapType(_STR, _STRS),
        "authors": _STRS,
        "category_hierarchy": _STRS,
        "match_score": _DBL,
        "valid_to": _TS,
    },
    [
        "book_id", "source_key", "isbn13", "source_ids", "title", "authors", "primary_category",
        "category_hierarchy", "valid_from", "valid_to", "is_current", "version",
        "confidence_score", "match_score", "source_count",
    ],
)

PRICE_HISTORY = _table(
    {"book_id": _STR, "source": _STR, "price": _DBL, "currency": _STR, "effective_date": _TS, "is_discount": BooleanType()},
    {"discount_percentage": _DBL},
)

AVAILABILITY_HISTORY = _table(
    {"book_id": _STR, "source": _STR, "status": _STR, "effective_date": _TS},
    {"previous_status": _STR},
)

CATEGORY_DIMENSION = _table(
    {"category_id": _STR, "category_name": _STR, "level": _INT, "full_path": _STR},
    {"parent_category_id": _STR},
)

RULE_RESULT = _table(
    {"run_id": _STR, "rule_name": _STR, "status": _STR, "timestamp": _TS},
    {"field_name": _STR, "expected_value": _STR, "actual_value": _STR, "error_message": _STR},
)

RUN_REPORT = _table(
    {"run_id": _STR, "status": _STR, "source": _STR, "start_time": _TS},
    {
        "end_time": _TS,
        "records_ingested": LongType(),
        "records_cleaned": LongType(),
        "records_deduplicated": LongType(),
        "records_rejected": LongType(),
        "data_quality_failures": LongType(),
        "success_rate": _DBL,
        "errors": _STRS,
    },
)
