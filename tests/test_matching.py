import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.functions.similarity import jaro_winkler_arrays
from shelfmark.operators.dimension import build_dimension, source_split, unmatched
from shelfmark.operators.facts import price_history
from shelfmark.operators.matching import MatchConfig, best_titles, keep_one_to_one, match, match_summary, top_matches
from shelfmark.operators.title_join import title_pairs

ROW = (
    "source string, source_id string, isbn13 string, title string, authors array<string>, price_current double, "
    "price_original double, currency string, category_path string, product_url string, ingested_at timestamp"
)


def side(spark, source, rows):
    """rows: (source_id, isbn13, title, authors)"""
    data = [
        (source, i, isbn, title, authors, 10.0, None, "USD", "Books > Travel", f"http://x/{i}", None)
        for i, isbn, title, authors in rows
    ]
    return spark.createDataFrame(data, ROW).withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp"))


SIDE_1 = [
    ("book1", None, "Travel Guide", ["Author A"]),
    ("book2", None, "Python Programming", ["Author B"]),
]
SIDE_2 = [
    ("9781912047451", "9781912047451", "Python Programming Guide", ["John Smith"]),
    ("9781234567890", "9781234567890", "Data Engineering Fundamentals", ["Jane Doe"]),
    ("9781111111111", "9781111111111", "Travel Guide 2024", ["Author A"]),
]


def brute_force(rows1, rows2, config=MatchConfig()):
    """Best pair per side-1 id over all pairs."""
    best = {}
    for i1, isbn1, t1, a1 in rows1:
        for i2, isbn2, t2, a2 in rows2:
            if t1 is None or t2 is None:
                continue
            t1_, t2_ = t1.lower(), t2.lower()
            sim = round(float(jaro_winkler_arrays([t1_], [t2_])[0]), 10)
            s1, s2 = set(a1 or []), set(a2 or [])
            overlap = len(s1 & s2) / len(s1 | s2) if s1 and s2 else 0.0
            score = config.isbn_weight if isbn1 is not None and isbn1 == isbn2 else 0.0
            score += sim * config.title_weight if sim >= config.title_threshold else 0.0
            score = round(score + overlap * config.author_weight, 10)
            if score >= config.min_confidence and (-score, i2) < best.get(i1, (1.0, "")):
                best[i1] = (-score, i2)
    return {k: (i2, -loss) for k, (loss, i2) in best.items()}


def found(pairs):
    return {r.source1_id: (r.source2_id, r.confidence_score) for r in pairs.collect()}


def assert_same(mine, expected):
    assert mine.keys() == expected.keys()
    for key, (partner, score) in expected.items():
        assert mine[key][0] == partner, (key, mine[key], expected[key])
        assert mine[key][1] == pytest.approx(score, abs=1e-9)


def test_jaro_winkler_known_values():
    left = ["martha", "dixon", "dwayne", "", "a", None, "crate", "é€😀", "abc"]
    right = ["marhta", "dicksonx", "duane", "a", "a", "a", "trace", "é€😀", "xyz"]
    expected = [0.961111, 0.813333, 0.84, 0.0, 1.0, 0.0, 0.733333, 1.0, 0.0]
    assert np.allclose(jaro_winkler_arrays(left, right), expected, atol=1e-6)


def test_jaro_winkler_equals_duckdb():
    import duckdb
    import pandas as pd

    rng = random.Random(5)
    words = ["".join(rng.choices("abcde ", k=rng.randint(1, 40))) for _ in range(4000)]
    frame = pd.DataFrame({"a": words[:2000], "b": words[2000:]})
    frame.loc[:500, "b"] = [w[:-1] + "x" for w in frame.loc[:500, "a"]]
    theirs = duckdb.sql("SELECT jaro_winkler_similarity(a, b) AS s FROM frame").df()["s"]
    assert np.abs(jaro_winkler_arrays(frame.a, frame.b) - theirs).max() < 1e-12


@pytest.mark.parametrize("threshold, cell_rows", [(0.85, 8192), (0.85, 4), (0.6, 7)])
def test_title_pairs_loses_nothing(spark, threshold, cell_rows):
    rng = random.Random(11)
    base = ["".join(rng.choices("abcdefg ", k=rng.randint(1, 24))) for _ in range(60)]
    near = [w[: rng.randint(0, len(w))] + rng.choice(["x", "", "yz", "é😀"]) + w[rng.randint(0, len(w)) :] for w in base]
    left, right = sorted(set(base) - {""}), sorted(set(near + base[:10]) - {""})
    expected = {
        (a, b)
        for a in left
        for b in right
        if round(float(jaro_winkler_arrays([a], [b])[0]), 10) >= threshold
    }
    a = spark.createDataFrame([(x,) for x in [*left, ""]], "t1 string")
    b = spark.createDataFrame([(x,) for x in [*right, ""]], "t2 string")
    pairs = title_pairs(a, b, ("t1", "t2"), threshold, cell_rows=cell_rows).collect()
    assert len(pairs) == len({(r.t1, r.t2) for r in pairs})
    assert {(r.t1, r.t2) for r in pairs} == expected


def test_title_threshold_must_be_positive(spark):
    df = spark.createDataFrame([("a",)], "t string")
    with pytest.raises(ValueError):
        title_pairs(df, df.toDF("u"), ("t", "u"), 0.0)


def test_sample_matches(spark):
    pairs = match(side(spark, "a", SIDE_1), side(spark, "b", SIDE_2))
    rows = {r.source1_id: r for r in pairs.collect()}
    assert rows["book1"].source2_id == "9781111111111"
    assert rows["book1"].confidence_score == pytest.approx(0.958824, abs=1e-6)
    assert rows["book1"].author_match_score == pytest.approx(0.3)
    assert rows["book1"].source1_title == "travel guide"
    assert rows["book2"].source2_id == "9781912047451"
    assert rows["book2"].confidence_score == pytest.approx(0.665, abs=1e-6)
    assert {r.match_type for r in rows.values()} == {"fuzzy_title"}
    assert len(pairs.columns) == 24
    assert [r.source1_id for r in top_matches(pairs, 1).collect()] == ["book1"]
    assert match_summary(pairs).collect()[0].pairs == 2


def random_rows(seed, n, prefix):
    rng = random.Random(seed)
    words = ["data", "book", "guide", "the", "learning", "spark", "sparks", "travel", "of", "art"]
    rows = []
    for i in range(n):
        title = " ".join(rng.choices(words, k=rng.randint(1, 4)))
        if rng.random() < 0.3:
            title = "The Same Title"  # a third of all rows share a title
        if rng.random() < 0.1:
            title = title[::-1]
        if rng.random() < 0.05:
            title = rng.choice([None, ""])
        authors = ["Unknown Author"] if rng.random() < 0.4 else rng.sample(["A", "B", "C", "D", "E"], rng.randint(0, 3))
        if rng.random() < 0.1:
            authors = None
        isbn = None if rng.random() < 0.4 else ("hot" if rng.random() < 0.5 else str(rng.randint(1, 12)))
        rows.append((f"{prefix}{i:03}", isbn, title, authors))
    return rows


CONFIGS = [
    MatchConfig(cell_rows=8),
    MatchConfig(min_confidence=0.7),
    MatchConfig(title_threshold=0.7, min_confidence=0.35, cell_rows=8),
    MatchConfig(title_weight=0.5, min_confidence=0.6),
    MatchConfig(isbn_weight=0.2, min_confidence=0.75),
]


@pytest.mark.parametrize("number", range(len(CONFIGS)))
def test_match_equals_brute_force(spark, number):
    config = CONFIGS[number]
    rows1, rows2 = random_rows(number, 60, "l"), random_rows(100 + number, 50, "r")
    pairs = match(side(spark, "a", rows1), side(spark, "b", rows2), config)
    assert_same(found(pairs), brute_force(rows1, rows2, config))


def test_match_without_any_pair(spark):
    left = side(spark, "a", [("1", None, "Alpha", ["X"])])
    right = side(spark, "b", [("2", "9", "Omega zzz", ["Y"])])
    pairs = match(left, right)
    assert pairs.count() == 0
    books = build_dimension(left.unionByName(right), pairs, "2024-01-01")
    assert books.where("source_count = 1").count() == 2
    assert price_history(left.unionByName(right), pairs).count() == 2


def test_authors_alone_must_not_match():
    with pytest.raises(ValueError):
        MatchConfig(min_confidence=0.3)


def test_one_to_one(spark):
    rows1 = [("a1", None, "Travel Guide", ["A"]), ("a2", None, "Travel Guide 1", ["A"])]
    rows2 = [("b1", None, "Travel Guide", ["A"])]
    left, right = side(spark, "a", rows1), side(spark, "b", rows2)
    assert match(left, right).count() == 2
    single = match(left, right, one_to_one=True)
    assert [(r.source1_id, r.source2_id) for r in single.collect()] == [("a1", "b1")]
    assert keep_one_to_one(single).collect() == single.collect()


def test_best_titles(spark):
    titles = spark.createDataFrame([("travel guide",), ("zzz",)], "title string")
    others = spark.createDataFrame([("travel guides", "2"), ("travel guidez", "1"), ("other", "3")], "title string, id string")
    rows = best_titles(titles, others).collect()
    assert [(r.title, r.best.id) for r in rows] == [("travel guide", "1")]


def test_dimension_and_prices(spark):
    left, right = side(spark, "a", SIDE_1), side(spark, "b", SIDE_2)
    pairs = match(left, right, one_to_one=True)
    silver = left.unionByName(right)
    books = build_dimension(silver, pairs, "2024-01-01 00:00:00")
    rows = {r.source_key: r for r in books.collect()}
    assert set(rows) == {"book1_9781111111111", "book2_9781912047451", "9781234567890_single"}
    both = rows["book1_9781111111111"]
    assert both.isbn13 == "9781111111111" and both.title == "Travel Guide" and both.source_count == 2
    assert both.source_ids == {"a": ["book1"], "b": ["9781111111111"]}
    assert both.primary_category == "Travel" and both.category_hierarchy == ["Books", "Travel"]
    assert both.version == 1 and both.is_current and both.valid_to is None
    prices = price_history(silver, pairs)
    assert prices.count() == 5
    # every price belongs to a book, and every book has an id of its own
    assert prices.join(books, "book_id", "left_anti").count() == 0
    assert books.select("book_id").distinct().count() == 3
    assert {r.multi_source: r.books for r in source_split(books).collect()} == {True: 2, False: 1}
    assert [r.source_id for r in unmatched(right, pairs, 2).collect()] == ["9781234567890"]
    assert unmatched(left, pairs, 1).count() == 0


def test_unmatched_keeps_null_ids(spark):
    pairs = match(side(spark, "a", SIDE_1), side(spark, "b", SIDE_2))
    rows = side(spark, "a", [*SIDE_1, (None, None, "No Id", None)])
    assert [r.title for r in unmatched(rows, pairs, 1).collect()] == ["No Id"]


def test_confidence_is_published_within_one(spark):
    rows1 = [("a1", "9780000000001", "Travel Guide", ["A"])]
    rows2 = [("b1", "9780000000001", "Travel Guide", ["A"])]
    left, right = side(spark, "a", rows1), side(spark, "b", rows2)
    pairs = match(left, right)
    assert pairs.collect()[0].confidence_score == pytest.approx(2.0)
    assert pairs.collect()[0].match_type == "exact_isbn"
    book = build_dimension(left.unionByName(right), pairs, "2024-01-01").collect()[0]
    assert book.confidence_score == 1.0 and book.match_score == pytest.approx(2.0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_no_cartesian_and_no_row_udf(spark):
    a = spark.createDataFrame([("x",)], "t1 string")
    b = spark.createDataFrame([("x",)], "t2 string")
    plan = plan_of(title_pairs(a, b, ("t1", "t2"), 0.85))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "BatchEvalPython" not in plan
    assert plan.count("ArrowEvalPython") == 1
    assert "bit_count" in plan[plan.index("SortMergeJoin [") :].split("\n")[0] or "bit_count" in plan
