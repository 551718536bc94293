"""Layer tables as partitioned Parquet, bronze records and reports as JSON."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PARTITIONS = ("source", "batch_id")


def default_batch_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: str | None = None,
    partitions: tuple[str, ...] = PARTITIONS,
    compression: str = "snappy",
    file_bytes: int | None = None,
) -> tuple[str | None, int]:
    """Write a batch below ``path``: (path, rows), or (None, 0) if it is empty.

    Rows are rebalanced by partition before they are written: a partition with very many
    rows is written by several tasks, many small ones by one, so files get a like size,
    that of ``file_bytes`` (as shuffled) or the session's advisory size.

    Only the partitions of this batch are replaced, so a repeated batch changes
    nothing and other batches stay. The rows are counted as they are written; an
    empty batch leaves no files.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if "batch_id" in partitions and "batch_id" not in df.columns:
        counted = counted.withColumn("batch_id", F.lit(batch_id or default_batch_id()))
    balanced = counted.hint("rebalance", *[F.col(p) for p in partitions])
    writer = balanced.write.partitionBy(*partitions).mode("overwrite")
    with advisory_size(df.sparkSession, file_bytes):
        writer.option("partitionOverwriteMode", "dynamic").parquet(path, compression=compression)
    rows = seen.get["rows"]
    return (path, rows) if rows else (None, 0)


@contextmanager
def advisory_size(spark: SparkSession, size: int | None):
    """Within, partitions after a shuffle are to have ``size`` bytes; None leaves the session's setting."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    if size is not None:
        spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_layer(
    spark: SparkSession,
    path: str,
    schema: StructType,
    source: str | None = None,
    batch_id: str | None = None,
    partitions: tuple[str, ...] = PARTITIONS,
) -> DataFrame | None:
    """A layer, one source or one batch of it; None if nothing was written yet.

    The filters fall on partition columns, so only their folders are read.
    """
    named = {f.name for f in schema}
    full = StructType([*schema.fields, *[StructField(p, StringType()) for p in partitions if p not in named]])
    try:
        df = spark.read.schema(full).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if source is not None:
        df = df.where(F.col("source") == source)
    if batch_id is not None:
        df = df.where(F.col("batch_id") == batch_id)
    return df


def read_matching_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """All Parquet files below a folder whose name fits, at any depth."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(path)


def write_sample(df: DataFrame, path: str, key: list[str], n: int = 3) -> None:
    """The first n rows by ``key`` as JSON, outside the table's own folder."""
    df.orderBy(*key).limit(n).write.mode("overwrite").json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON object."""
    report.coalesce(1).write.mode("overwrite").json(path)


def verify_written(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Row counts on both sides and whether they agree."""
    sides = expected.agg(F.count(F.lit(1)).alias("n")).select(F.lit("expected").alias("side"), "n").unionByName(
        actual.agg(F.count(F.lit(1)).alias("n")).select(F.lit("actual").alias("side"), "n")
    )
    return sides.agg(
        F.sum(F.when(F.col("side") == "expected", F.col("n"))).alias("rows_expected"),
        F.sum(F.when(F.col("side") == "actual", F.col("n"))).alias("rows_actual"),
    ).withColumn("equal", F.col("rows_expected") == F.col("rows_actual"))
