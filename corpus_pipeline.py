"""A training corpus from raw documents, in five stages.

Each stage takes all that its predecessor kept, written as Parquet and read again, and
returns rows with the columns of ``documents``:

1. toxicity: documents that the fitted model calls toxic go;
2. line_dedup: of similar lines the first stays; a document that has no line left goes;
3. near_dup: of each class of near-duplicates one document stays (the smallest doc_id);
4. decontaminate: documents that hold a passage of a benchmark item go;
5. mix: documents are repeated, or left out, by their source's rate.

Rows are told apart by doc_id and text. Rows that repeat both are one document to stages 2
to 4; stage 3 leaves one of them if they hold a word. Null texts are empty texts; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, line_dedup, mixing, near_dup, toxicity
from shelfmark.session import written

#: Rows to leave out, up to this number, are sent to all tasks (some 50 MB); beyond, rows are joined by a shuffle.
BROADCAST_ROWS = 500_000


def row_key() -> Column:
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))


def fresh(name: str, docs: DataFrame) -> str:
    """A name that no column of ``docs`` has."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not in ``gone`` (_key)."""
    key = fresh("_key", docs)
    gone = written(gone.select(F.col("_key").alias(key)).distinct(), "pipeline-gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.withColumn(key, row_key()).join(gone, key, "left_anti").select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    score = fresh("_score", docs)
    return toxicity.score(docs, model, score).where(F.col(score) < 0.5).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lines, removed = fresh("_lines", docs), fresh("_removed", docs)
    done = line_dedup.dedup_lines(docs, lines, removed)
    bare = F.translate("text", " \t\n\x0b\x0c\r", "") == ""
    kept = done.where(~((F.col(removed) > 0) & bare))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the smallest doc_id stands first in a key's struct, so it is the one that stays
    keyed = docs.select(F.struct("doc_id", row_key().alias("_key")).alias("doc_id"), "text")
    found = written(near_dup.classes(keyed), "pipeline-classes")
    gone = found.where("doc_id <> class_id").select("doc_id._key")
    kept = without(docs, gone)
    twice = found.where("doc_id = class_id and n_words > 0").groupBy("doc_id._key").count().where("count > 1")
    if twice.isEmpty():
        return kept
    # rows that repeat id and text; texts without words are similar to nothing and stay
    worded = F.col("text").rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]")
    bare = kept.where(~F.coalesce(worded, F.lit(False)))
    key = fresh("_key", docs)
    return kept.where(worded).withColumn(key, row_key()).dropDuplicates([key]).select(docs.columns).unionByName(bare)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.find_contamination(docs.select(row_key().alias("_key"), "text"), items, "_key")
    return without(docs, found.where("n_hit > 0").select("_key"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

#: Learned scores and similarity groups are beyond SQL; the tests hold a run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
