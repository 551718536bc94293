"""Canonical books over any number of sources: connected components of match links.

Two sources give pairs; three or more give chains (a is like b, b is like c), so a book is
a component of the graph whose nodes are rows (source, source_id) and whose edges are the
links of all pairwise matches. It is named by its smallest member.

Components are found by rounds on DataFrames: every node takes the smallest label around
it, then the label of its label, so a chain's length halves in each round. Labels meet in
an aggregate with partial minima; a node with very many links is reduced in each task
before it moves. Each round is written, so a lost executor costs one round at most.
Labels compress well, so a small file may be a large table: the joins are hinted to shuffle,
or such files would go through the driver to all tasks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.records import category_levels, surrogate_id
from shelfmark.session import discard, written

LINK_COLUMNS = ["source_a", "id_a", "source_b", "id_b", "score"]


def links_of(matches: DataFrame) -> DataFrame:
    """The links of a pairwise match (``matching.match``)."""
    return matches.select(
        F.col("source1_source").alias("source_a"), F.col("source1_id").alias("id_a"), F.col("source2_source").alias("source_b"), F.col("source2_id").alias("id_b"),
        F.col("confidence_score").alias("score"),
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): label is the smallest node it is connected with.

    Nodes are of any type that has an order; nulls are no nodes. An edge to itself makes a
    node known.
    """
    both = edges.where("a is not null and b is not null").select("a", "b")
    both = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "components-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "components")
    while True:
        around = both.hint("merge").join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        lower = written(labels.hint("merge").join(around, "node").select("node", F.col("label").alias("was"), F.least("label", "low").alias("label")), "components-low")
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("top"))
        jumped = written(lower.hint("merge").join(up, "label").select("node", "was", F.least("label", "top").alias("label")), "components-next")
        settled = jumped.where("label <> was").isEmpty()
        before, labels = labels, jumped.drop("was")
        discard(before, lower)
        if settled:
            discard(both)
            return labels
        labels = written(labels, "components")
        discard(jumped)


def book_clusters(links: DataFrame) -> DataFrame:
    """(source, source_id, book_id, first_source, first_id, link_score) of every linked row.

    ``link_score`` is the weakest link of the row's cluster.
    """
    node = [F.struct(F.col(f"source_{s}").alias("source"), F.col(f"id_{s}").alias("source_id")) for s in ("a", "b")]
    known = links.where(" and ".join(f"{c} is not null" for c in LINK_COLUMNS[:4]))
    edges = written(known.select(node[0].alias("a"), node[1].alias("b"), "score"), "cluster-links")
    labels = connected_components(edges.select("a", "b"))
    weakest = edges.hint("merge").join(labels, edges["a"] == labels["node"]).groupBy("label").agg(F.min("score").alias("link_score"))
    members = labels.hint("merge").join(weakest, "label")
    return members.select("node.*", surrogate_id("label.source", "label.source_id").alias("book_id"), F.col("label.source").alias("first_source"), F.col("label.source_id").alias("first_id"), "link_score")


def with_cluster_ids(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """Silver rows with the id of their book; rows without a link are books of their own."""
    ids = clusters.select("source", "source_id", F.col("book_id").alias("_book_id"))
    return rows.join(ids.hint("merge"), ["source", "source_id"], "left").withColumn("book_id", F.coalesce("_book_id", surrogate_id("source", "source_id"))).select(*rows.columns, "book_id")


def build_clusters(silver: DataFrame, clusters: DataFrame, run_ts: str | datetime) -> DataFrame:
    """The first version of every canonical book, from rows of any number of sources.

    ``silver`` is unique per (source, source_id). Members rank by source and id; of each
    attribute the first that is not null counts, the title is that of the first member; a
    book without any category is in "Unknown".
    ``source_ids`` lists all ids by source, so a book has as long a list as it has members.
    """
    rows = silver.join(clusters.select("source", "source_id", "book_id", "link_score").hint("merge"), ["source", "source_id"], "left")
    rows = rows.withColumn("book_id", F.coalesce("book_id", surrogate_id("source", "source_id")))
    rank = F.struct("source", "source_id")

    by_source = rows.groupBy("book_id", "source").agg(
        F.sort_array(F.collect_list("source_id")).alias("ids"),
        F.min(F.struct(rank.alias("rank"), F.col("title"))).alias("head"),
        *[F.min(F.when(F.col(c).isNotNull(), F.struct(rank.alias("rank"), F.col(c).alias("value")))).alias(c) for c in ("isbn13", "authors", "category_path")],
        F.min("link_score").alias("link_score"),
    )
    books = by_source.groupBy("book_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "ids")))).alias("source_ids"),
        F.min("head").alias("head"),
        *[F.min(c).getField("value").alias(c) for c in ("isbn13", "authors", "category_path")],
        F.min("link_score").alias("match_score"),
        F.count(F.lit(1)).cast("int").alias("source_count"),
    )
    levels = category_levels(F.col("category_path"))
    return books.select(
        "book_id",
        F.concat_ws("_", F.col("head.rank.source_id"), F.when(F.aggregate(F.map_values("source_ids"), F.lit(0), lambda n, ids: n + F.size(ids)) == 1, F.lit("single"))).alias("source_key"),
        "isbn13", "source_ids", F.col("head.title").alias("title"), "authors",
        F.coalesce(F.get(levels, F.lit(1)), F.lit("Unknown")).alias("primary_category"), levels.alias("category_hierarchy"),
        F.lit(run_ts).cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"), F.lit(1).alias("version"),
        F.least(F.lit(1.0), F.coalesce("match_score", F.lit(1.0))).alias("confidence_score"), "match_score", "source_count",
    )
