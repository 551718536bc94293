"""Profiles of the layers and the report of a run; each one aggregate pass."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and nulls per column: (field_name, rows, nulls)."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in columns])
    entries = [F.struct(F.lit(c).alias("field_name"), "rows", F.col(f"_{c}").alias("nulls")) for c in columns]
    return counts.select(F.inline(F.array(*entries)))


def number_profile(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """avg, min, max, non-null count and row count of a numeric column."""
    return df.agg(
        F.round(F.avg(column), digits).alias("avg_value"),
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        F.count(column).alias("with_value"),
        F.count(F.lit(1)).alias("rows"),
    )


def group_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), column)


def gold_profile(canonical: DataFrame) -> DataFrame:
    return canonical.agg(
        F.avg("confidence_score").alias("avg_confidence"),
        F.count("book_id").alias("total_books"),
        F.count("isbn13").alias("books_with_isbn"),
    )


def success_rate(cleaned: Column, ingested: Column) -> Column:
    return F.when(ingested > 0, cleaned / ingested * 100).otherwise(F.lit(0.0))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row with a count per layer; each layer is reduced to one number before they meet."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n") for name, df in layers.items()]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.agg(*[F.sum(F.when(F.col("layer") == name, F.col("n"))).alias(name) for name in layers])


def run_metrics(
    checked: DataFrame,
    run_id: str,
    source: str,
    start_time: str | datetime,
    end_time: str | datetime | None = None,
    key: str = "content_hash",
    errors: list[str] = (),
) -> DataFrame:
    """The report of one run, from one pass over its rows with their ``reasons``.

    Ingested are all rows, cleaned those without a reason, kept one per ``key`` of these.
    Each broken rule of a row is a quality failure. A run with errors has failed.
    """
    accepted = F.size("reasons") == 0
    by_key = checked.groupBy(F.when(accepted, F.col(key)).alias("_key")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(accepted).alias("clean"), F.sum(F.size("reasons")).alias("broken")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    counts = by_key.agg(
        zero(F.sum("n")).alias("records_ingested"),
        zero(F.sum("clean")).alias("records_cleaned"),
        F.count_if(F.col("clean") > 0).alias("_kept"),
        zero(F.sum("broken")).alias("data_quality_failures"),
    )
    moment = lambda t: F.lit(t).cast("timestamp")
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit("FAILED" if errors else "SUCCESS").alias("status"),
        F.lit(source).alias("source"),
        moment(start_time).alias("start_time"),
        moment(end_time).alias("end_time"),
        "records_ingested",
        "records_cleaned",
        (F.col("records_cleaned") - F.col("_kept")).alias("records_deduplicated"),
        (F.col("records_ingested") - F.col("records_cleaned")).alias("records_rejected"),
        "data_quality_failures",
        success_rate(F.col("records_cleaned"), F.col("records_ingested")).alias("success_rate"),
        F.array(*[F.lit(e) for e in errors]).cast("array<string>").alias("errors"),
    )
