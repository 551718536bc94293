"""Books over many sources against a plain union-find."""

import random

import pytest

from shelfmark.operators import clusters

LINK = "source_a string, id_a string, source_b string, id_b string, score double"
ROW = "source string, source_id string, isbn13 string, title string, authors array<string>, category_path string"


def roots(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(70)], [(0, i) for i in range(1, 90)], [(random.Random(i).randrange(200), random.Random(-i).randrange(200)) for i in range(150)], [(5, 5)], [(9, 1), (9, 2), (3, 9), (None, 4)], []])
def test_components(spark, edges):
    found = clusters.connected_components(spark.createDataFrame(edges, "a int, b int")).collect()
    assert {r.node: r.label for r in found} == roots([e for e in edges if e[0] is not None])


def test_books_of_a_chain(spark):
    rows = spark.createDataFrame(
        [("s1", "a", None, "First", None, None), ("s2", "b", "9" * 13, "Second", ["B"], "Books > X"), ("s2", "b2", "8" * 13, "Other", ["C"], None), ("s3", "c", None, "Third", ["D"], "Books > Y"), ("s3", "d", None, "Alone", [], None), ("s3", None, None, "No id", None, None)],
        ROW,
    )
    links = spark.createDataFrame([("s1", "a", "s2", "b", 0.9), ("s2", "b", "s3", "c", 0.7), ("s2", "b2", "s3", "c", 1.4), ("s1", None, "s2", "b", 0.9)], LINK)
    found = clusters.book_clusters(links)
    books = {r.title: r for r in clusters.build_clusters(rows, found, "2024-01-01").collect()}
    assert set(books) == {"First", "Alone", "No id"}
    book = books["First"]
    assert dict(book.source_ids) == {"s1": ["a"], "s2": ["b", "b2"], "s3": ["c"]}
    assert (book.isbn13, list(book.authors), book.primary_category, book.source_count, book.match_score, book.source_key) == ("9" * 13, ["B"], "X", 3, 0.7, "a")
    assert books["Alone"].source_key == "d_single" and books["Alone"].confidence_score == 1.0
    ids = {(r.source, r.source_id): r.book_id for r in clusters.with_cluster_ids(rows, found).collect()}
    assert len({ids[k] for k in (("s1", "a"), ("s2", "b"), ("s2", "b2"), ("s3", "c"))}) == 1 and ids["s1", "a"] == book.book_id
    assert ids["s3", "d"] == books["Alone"].book_id


def test_no_links(spark):
    rows = spark.createDataFrame([("s1", "a", None, "First", None, None)], ROW)
    found = clusters.book_clusters(spark.createDataFrame([], LINK))
    assert [r.source_count for r in clusters.build_clusters(rows, found, "2024-01-01").collect()] == [1]


def test_labels_are_not_sent_through_the_driver(spark):
    links = spark.createDataFrame([("a", "1", "b", "2", 0.9), ("b", "2", "c", "3", 0.8)], "source_a string, id_a string, source_b string, id_b string, score double")
    rows = spark.createDataFrame([("a", "1"), ("c", "3"), ("c", "4")], "source string, source_id string")
    found = clusters.with_cluster_ids(rows, clusters.book_clusters(links))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.select("book_id").distinct().count() == 2
