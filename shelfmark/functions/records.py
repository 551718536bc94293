"""Column rules of the silver layer: status, scores, hashes, discounts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The status names of the availability enum.
IN_STOCK = "in_stock"
OUT_OF_STOCK = "out_of_stock"
PRE_ORDER = "pre_order"
UNKNOWN = "unknown"

# What a missing field takes off the quality score of 1.0.
SCORE_PENALTIES = {
    "title": 0.3,
    "price_current": 0.3,
    "upc": 0.2,
    "category": 0.1,
    "authors": 0.1,
}

# Fixed value: where the stock count stands in an availability text.
STOCK_PATTERN = r"\((\d+) available\)"


def availability_status(text: Column) -> Column:
    """Status of a free text such as "In stock (19 available)", or of a status name."""
    plain = F.regexp_replace(F.lower(F.trim(text)), r"[\s_-]+", " ")
    return (
        F.when(plain.contains("in stock"), IN_STOCK)
        .when(plain.contains("out of stock"), OUT_OF_STOCK)
        .when(plain == "pre order", PRE_ORDER)
        .otherwise(UNKNOWN)
    )


def stock_quantity(specs: Column) -> Column:
    return F.regexp_extract(specs["availability"], STOCK_PATTERN, 1).try_cast("int")


def quality_score(penalties: dict[str, float] | None = None) -> Column:
    """1.0 less a penalty per missing field, kept within 0..1 and free of float residue."""
    penalties = SCORE_PENALTIES if penalties is None else penalties
    lost = [
        F.when(
            (F.coalesce(F.size(name), F.lit(0)) < 1) if name == "authors" else F.col(name).isNull(),
            F.lit(points),
        ).otherwise(F.lit(0.0))
        for name, points in penalties.items()
    ]
    score = F.lit(1.0) - reduce(lambda a, b: a + b, lost, F.lit(0.0))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4)


def content_hash(*columns: str | Column) -> Column:
    """MD5 of the parts joined by underscores; null parts are left out."""
    return F.md5(F.concat_ws("_", *columns))


def raw_hash(url: Column, content: Column, length: int = 1000) -> Column:
    """Hash of a fetched record by rule: its address and the first ``length`` characters.

    A change further down does not show. To tell records apart use ``content_hash``,
    which covers all of what it is given.
    """
    return F.md5(F.concat(url, F.lit("_"), F.substring(content, 1, length)))


def isbn13(text: Column) -> Column:
    return F.when(text.rlike(r"^[0-9]{13}$"), text)


def discount_percentage(original: Column, current: Column) -> Column:
    return F.when(original > 0, (original - current) / original * 100)


def clean_authors(authors: Column) -> Column:
    """Trimmed, non-blank names."""
    return F.filter(F.transform(authors, lambda name: F.trim(name)), lambda name: name != "")


def surrogate_id(*natural_key: str | Column) -> Column:
    """A stable id that every job derives alike from the natural key.

    Parts carry their length, so no two keys read alike, and a null is not an empty text.
    """
    columns = [F.col(k) if isinstance(k, str) else k for k in natural_key]
    parts = [F.when(c.isNull(), "-").otherwise(F.concat_ws(":", F.length(c).cast("string"), c)) for c in columns]
    return F.concat(F.lit("bk_"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32))


def category_levels(path: Column, separator: str = " > ") -> Column:
    return F.split(path, separator)
