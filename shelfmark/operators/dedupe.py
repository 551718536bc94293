"""Deduplication and change detection between batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_digest(*keys: str) -> Column:
    """A digest that tells keys apart, nulls and separators inside values included."""
    return F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    An aggregate rather than a window: each task first reduces its own rows to one
    per key, so a key that holds a third of the table moves as a few rows only.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(first).select(*keys, "_row.*").select(*df.columns)


def dedupe_latest(
    df: DataFrame,
    keys: list[str] = ("content_hash",),
    latest: str = "ingested_at",
    ties: list[str] = ("source", "source_id"),
) -> DataFrame:
    """The most recent row per key; a row without a time comes last, equal times are settled by the smallest ``ties``."""
    moment = F.unix_micros(F.col(latest).cast("timestamp"))
    return keep_first(df, list(keys), [moment.isNull(), -moment, *[F.col(c) for c in ties]])


def new_or_changed(
    batch: DataFrame, stored: DataFrame, keys: list[str] = ("source", "source_id", "content_hash")
) -> DataFrame:
    """Rows of a batch that the stored table does not hold yet in this version; null keys compare as values."""
    held = stored.select(key_digest(*keys).alias("_identity"))
    return batch.withColumn("_identity", key_digest(*keys)).join(held, "_identity", "left_anti").drop("_identity")
