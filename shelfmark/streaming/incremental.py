"""Incremental loads: new bronze files to silver, and stream deduplication."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from shelfmark.operators.dedupe import dedupe_latest, new_or_changed
from shelfmark.session import discard, written
from shelfmark.sources import keyed

IDENTITY = ("source", "source_id", "content_hash")


def read_new_files(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the files that appear in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def append_unseen(
    target: str,
    schema: StructType,
    identity: tuple[str, ...] = IDENTITY,
    latest: str = "ingested_at",
    ties: tuple[str, ...] = ("source", "source_id"),
    partitions: tuple[str, ...] = (),
    buckets: int = 16,
    files_per_bucket: int = 32,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores the rows whose identity is not stored yet.

    Every batch adds files of its own and replaces nothing, so a new checkpoint, whose
    batch numbers start again, loses no stored row; and all of the table counts as
    stored, so a batch that comes again, from any checkpoint, adds nothing. Identities
    with nulls compare as values. The table is a keyed one (``sources.keyed``): a batch
    reads the row groups that may hold its rows, and a bucket that has got many files is
    rewritten as one. ``batch_id`` is a plain column.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keyed.check_layout(spark, target, identity, buckets)
        rows = keyed.with_bucket(dedupe_latest(batch, list(identity), latest, list(ties)), identity, buckets)
        rows = written(rows, "batch")  # read for its keys, and again for its rows
        full = StructType([*schema.fields, StructField("batch_id", StringType())])
        with keyed.point_lookups(spark):
            stored = keyed.read(spark, target, full)
            fresh = rows if stored is None else new_or_changed(rows, stored.where(keyed.may_hold(rows)), list(identity))
            fresh = written(fresh.withColumn("batch_id", F.lit(f"{number:012d}-{uuid.uuid4().hex}")), "batch-fresh")
        if not fresh.isEmpty():
            keyed.append(fresh.select(*full.names, keyed.DIGEST, keyed.BUCKET), target, partitions)
            if partitions == ():
                keyed.compact(spark, target, full, files_per_bucket)
        discard(rows, fresh)

    return store


def load_increment(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    store: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """Process everything that is there now, then stop; a later start goes on from there."""
    return (
        stream.transform(transform)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drop_repeats(stream: DataFrame, time: str = "ingested_at", delay: str = "1 day", keys: tuple[str, ...] = ("content_hash",)) -> DataFrame:
    """Stream deduplication whose state is bounded by the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def store_with_late_rows(
    path: str,
    schema: StructType,
    keys: tuple[str, ...],
    time: str = "ingested_at",
    delay: str = "1 day",
    ties: tuple[str, ...] = (),
    buckets: int = 16,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for deduplication that accounts for every row.

    A row is late if it is older than the latest time of all earlier batches less
    ``delay``. Late rows do not vanish: they go to ``path``/late. Of all others each key is
    stored once in ``path``/rows, and ``path``/counts has a row for each batch with the
    numbers of rows that came, were stored, were repeats or were late. A batch that comes
    again replaces what it wrote.
    """
    store = append_unseen(f"{path}/rows", schema, keys, time, ties, buckets=buckets)

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = written(batch.select(*schema.names), "late-batch")
        counts = _counts(spark, path)
        high = None if counts is None else counts.where(F.col("batch") < number).agg(F.max("high")).first()[0]
        mark = F.lit(high).cast("timestamp") - F.expr(f"interval {delay}")
        behind = F.coalesce(F.col(time) < mark, F.lit(False))
        tagged = rows.withColumn("batch", F.lit(number).cast("bigint"))
        late = tagged.where(behind)
        late.write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/late")
        store(rows.where(~behind), number)
        stored = keyed.read(spark, f"{path}/rows", StructType([*schema.fields, StructField("batch_id", StringType())]))
        mine = 0 if stored is None else stored.where(F.col("batch_id").startswith(f"{number:012d}-")).count()
        seen = rows.agg(F.count(F.lit(1)).alias("came"), F.count_if(behind).alias("late"), F.max(time).alias("high"))
        line = seen.select("came", F.lit(mine).cast("bigint").alias("stored"), (F.col("came") - F.col("late") - mine).alias("repeats"), "late", F.col("high").cast("timestamp"), F.lit(number).cast("bigint").alias("batch"))
        line.write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/counts")
        discard(rows)

    return run


COUNTS = "came bigint, stored bigint, repeats bigint, late bigint, high timestamp, batch bigint"


def _counts(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(COUNTS).parquet(f"{path}/counts")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
