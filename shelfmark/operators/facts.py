"""Gold facts: prices and availability over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.records import discount_percentage
from shelfmark.operators.dimension import with_book_ids
from shelfmark.operators.ordered import with_neighbours


def discount_columns(current: Column, original: Column) -> list[Column]:
    percent = discount_percentage(original, current)
    return [F.coalesce(percent > 0, F.lit(False)).alias("is_discount"), percent.alias("discount_percentage")]


def price_history(silver: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per price observation, under the id its book has in the dimension."""
    return with_book_ids(silver, matches).select(
        "book_id",
        "source",
        F.col("price_current").alias("price"),
        "currency",
        F.col("ingested_at").alias("effective_date"),
        *discount_columns(F.col("price_current"), F.col("price_original")),
    )


def price_changes(
    prices: DataFrame, ties: list[str] = (), keys: list[str] = ("book_id", "source"), share: int | None = None
) -> DataFrame:
    """Observations whose price differs from the one before, with the step in value and percent.

    An observation without a price is none: the step goes from the last known price.
    """
    seen = with_neighbours(prices.where(F.col("price").isNotNull()), list(keys), "effective_date", ties, {"previous_price": "price"}, share=share)
    step = F.col("price") - F.col("previous_price")
    return seen.where(step != 0).withColumns(
        {"price_change": step, "change_percentage": F.when(F.col("previous_price") != 0, step / F.col("previous_price") * 100)}
    )


def availability_history(
    log: DataFrame, keys: list[str] = ("book_id", "source"), time: str = "effective_date", ties: list[str] = (), share: int | None = None
) -> DataFrame:
    """Status changes with the status before; the first status of a key has none."""
    seen = with_neighbours(
        log.withColumn("_seen", F.lit(True)),
        list(keys),
        time,
        ties,
        {"previous_status": "status", "_was_seen": "_seen"},
        share=share,
    )
    changed = F.col("_was_seen").isNull() | ~F.col("status").eqNullSafe(F.col("previous_status"))
    return seen.where(changed).select(*keys, "status", F.col(time).alias("effective_date"), "previous_status")


def prices_per_source(prices: DataFrame) -> DataFrame:
    return prices.groupBy("source").agg(F.count(F.lit(1)).alias("events")).orderBy("source")
