"""Mixing sources to target weights, by repetition rates.

Sizes are summed per source, a target is set for each source, and every document is
emitted ``floor(rate)`` times plus once more if a hash of its id falls below the
fraction that is left. Only DataFrame functions; no text is ever shuffled.

Defined cases: a null text has size 0; sources order by code point, null last; rows that
repeat a doc_id draw alike; an empty table gives an empty mix; a table of empty texts has
targets of 0. A column of the input that has the name of an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import written

#: Words are runs of anything but blanks and the control characters from tab to return.
WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to this number (some MB) are sent to all tasks; beyond, they are joined by a shuffle of sizes.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def allocate(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: int = 150, most: int = 2) -> DataFrame:
    """A target for each source of ``sizes`` (source, source_size).

    The targets sum to ``share`` per cent of all sizes and follow the weights, which are
    dealt to the sources in order, again and again. A target stops at ``most`` times the
    source's size; what is too much goes to the others by weight, until none is above.
    This is the level at which sources, ordered by limit over weight, stop to be full:
    with C the limits and W the weights of the sources that come before and from there
    on, a source is full if its own limit over weight is at most (total - C) / W.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("_at", F.row_number().over(by_name) - 1)
        .withColumn("_weight", weight.cast("long"))
        .withColumn("_limit", F.col("source_size") * most)
        .withColumn("_total", F.sum("source_size").over(Window.partitionBy()) * share / F.lit(100))
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_limit").over(before), F.lit(0))) / F.sum("_weight").over(after))
        .withColumn("_open", F.col("_limit") / F.col("_weight") > F.col("_level"))
        .withColumn("_level", F.min(F.when(F.col("_open"), F.struct(F.col("_limit") / F.col("_weight"), "_level"))).over(Window.partitionBy())["_level"])
    )
    full = F.col("_level").isNull() | (F.col("_limit") / F.col("_weight") <= F.col("_level"))
    target = F.when(full, F.col("_limit").cast("double")).otherwise(F.col("_level") * F.col("_weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number from 0 to below 1 by the first 52 bits of an MD5 hash of seed and id."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def plan_copies(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: int = 150, most: int = 2, seed: str = "mix") -> DataFrame:
    """``docs`` with size, source_size, target and copies (how often the mix takes the row).

    One pass sums the sizes by source (partial sums first, so a source with a third of
    all rows costs no more than any other); the table of sources is written once.
    """
    sized = docs.withColumn("size", word_count(F.col("text")))
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(allocate(by_source, weights, share, most), "mix-targets").withColumnRenamed("source", "_source")
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rest = sized.drop("source_size", "target", "copies")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = draw(F.col("doc_id"), seed) < rate - F.floor(rate)
    return (
        rest.join(targets, rest["source"].eqNullSafe(targets["_source"]))
        .drop("_source")
        .withColumn("copies", F.floor(rate) + extra.cast("long"))
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """Every document as often as its source's rate says, with the columns of ``docs``."""
    planned = plan_copies(docs.select(F.struct("*").alias("_row"), "doc_id", "source", "text"), **options)
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return planned.where("copies > 0").select("_row", F.explode(copies)).select("_row.*")
