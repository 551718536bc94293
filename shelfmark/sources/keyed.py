"""Tables kept by key: small batches read and rewrite only the part that they touch.

A keyed table is partitioned by ``bucket``, a hash of its key, and within a bucket's files
rows are sorted by ``_digest``, 64 bits of the key. The number of buckets and the key are
stored with the table, and a caller that assumes others is refused.

* Reading for a batch: only the buckets that the batch touches are listed, and of their
  files Parquet reads the row groups and pages whose statistics and Bloom filters may hold
  a digest of the batch. A batch with more than ``POINTS`` keys touches most row groups
  anyway and reads its buckets whole.
* Replacing: the new content of a bucket is written beside the table and takes the place of
  the bucket's files when all of it is there; other buckets' files are not touched.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfmark.operators.dedupe import key_digest

BUCKET, DIGEST = "bucket", "_digest"
#: Keys of a batch that are looked up one by one, and so the most that the driver is sent.
POINTS = 2000
#: Bytes of a row group and rows of a page: what is read for one key at least.
ROW_GROUP, PAGE_ROWS = 16 << 20, 1000
_IN = "spark.sql.parquet.pushdown.inFilterThreshold"


def with_bucket(rows: DataFrame, key: tuple[str, ...], buckets: int) -> DataFrame:
    """Add ``_digest`` and ``bucket``; keys with nulls are keys."""
    digest = F.xxhash64(key_digest(*key))
    return rows.withColumns({DIGEST: digest, BUCKET: F.format_string("%05d", F.pmod(digest, F.lit(buckets)))})


def stored_schema(schema: StructType) -> StructType:
    names = {f.name for f in schema}
    return StructType([*schema.fields, *[f for f in (StructField(DIGEST, LongType()), StructField(BUCKET, StringType())) if f.name not in names]])


def check_layout(spark: SparkSession, path: str, key: tuple[str, ...], buckets: int) -> None:
    """Write the layout of a new table; refuse to use a table with another one."""
    place = f"{path.rstrip('/')}/_layout"
    mine = ("|".join(key), buckets)
    try:
        stored = spark.read.schema("key string, buckets int").json(place).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([mine], "key string, buckets int").coalesce(1).write.json(place)
        return
    if tuple(stored) != mine:
        raise ValueError(f"the table at {path} has key {stored['key']} in {stored['buckets']} buckets, not {mine[0]} in {mine[1]}")


def _writer(rows: DataFrame, partitions: tuple[str, ...], key_rows: int):
    ordered = rows.repartition(BUCKET, *partitions).sortWithinPartitions(BUCKET, *partitions, DIGEST)
    writer = ordered.write.partitionBy(BUCKET, *partitions)
    for name, value in (("block.size", ROW_GROUP), ("page.row.count.limit", PAGE_ROWS), (f"bloom.filter.enabled#{DIGEST}", "true"), (f"bloom.filter.expected.ndv#{DIGEST}", key_rows)):
        writer = writer.option(f"parquet.{name}", str(value))
    return writer


def append(rows: DataFrame, path: str, partitions: tuple[str, ...] = (), key_rows: int = 100_000) -> None:
    """Add files with ``rows`` (bucketed); ``key_rows`` is the number of keys that a row group's Bloom filter is made for."""
    _writer(rows, partitions, key_rows).mode("append").parquet(path)


def replace(rows: DataFrame, path: str, key_rows: int = 100_000) -> None:
    """Put ``rows`` (bucketed) in the place of all rows of their buckets.

    ``rows`` may be computed from the table itself: Spark stages the new files and swaps
    the buckets when the job has ended.
    """
    _writer(rows, (), key_rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table with ``_digest`` and ``bucket``; None if nothing was written yet."""
    try:
        table = spark.read.schema(stored_schema(schema)).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return table


def touched_buckets(rows: DataFrame) -> list[str]:
    return [r[BUCKET] for r in rows.select(BUCKET).distinct().collect()]  # at most the number of buckets


def may_hold(rows: DataFrame) -> Column:
    """A condition on the table that every stored row with a key of ``rows`` meets, made to be pushed to the files."""
    condition = F.col(BUCKET).isin(touched_buckets(rows))
    points = [r[DIGEST] for r in rows.select(DIGEST).distinct().limit(POINTS + 1).collect()]
    return condition & F.col(DIGEST).isin(points) if len(points) <= POINTS else condition


@contextmanager
def point_lookups(spark: SparkSession):
    """Within, Spark hands lists of up to ``POINTS`` values to Parquet one by one, not as a range."""
    before = spark.conf.get(_IN)
    spark.conf.set(_IN, str(POINTS))
    try:
        yield
    finally:
        spark.conf.set(_IN, before)


def compact(spark: SparkSession, path: str, schema: StructType, files: int = 8) -> list[str]:
    """Rewrite the buckets that consist of more than ``files`` files as sorted ones; their names."""
    table = read(spark, path, schema)
    if table is None:
        return []
    many = table.select(BUCKET, F.input_file_name().alias("file")).groupBy(BUCKET).agg(F.count_distinct("file").alias("n")).where(F.col("n") > files)
    names = [r[BUCKET] for r in many.collect()]  # at most the number of buckets
    if names:
        replace(table.where(F.col(BUCKET).isin(names)), path)
    return sorted(names)


def changed_buckets(before: DataFrame, after: DataFrame) -> list[str]:
    """Buckets in which the rows differ, by count and a sum over a hash of every row, whatever their order."""

    def sums(rows: DataFrame, sign: int) -> DataFrame:
        text = F.to_json(F.struct(*[F.array_sort(F.map_entries(f.name)).alias(f.name) if f.dataType.typeName() == "map" else F.col(f.name) for f in before.schema]), {"ignoreNullFields": "false"})
        return rows.select(BUCKET, F.lit(sign).alias("n"), *[(F.xxhash64(text, F.lit(k)).cast("decimal(38,0)") * sign).alias(f"h{k}") for k in (0, 1)])

    both = sums(before, -1).unionByName(sums(after, 1)).groupBy(BUCKET).agg(*[F.sum(c).alias(c) for c in ("n", "h0", "h1")])
    return sorted(r[BUCKET] for r in both.where("n <> 0 or h0 <> 0 or h1 <> 0").collect())
