"""Stable one-to-one matches against a greedy pass over all pairs."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import assignment
from shelfmark.operators.assignment import scored_entries, stable_match, stable_rounds
from shelfmark.operators.matching import MatchConfig, prepare_side, with_scores
from shelfmark.functions.similarity import title_similarity

SIDE = "source string, source_id string, isbn13 string, title string, authors array<string>, price_current double, currency string, category_path string, product_url string"


def side(spark, name, rows):
    return spark.createDataFrame([(name, i, isbn, t, a, 1.0, "USD", "Books", "u") for i, isbn, t, a in rows], SIDE)


def says(row):
    return "|".join([row[1] or "", row[2].lower(), ",".join(sorted(set(row[3] or [])))])


def all_pairs(spark, a, b, config):
    one, two = prepare_side(side(spark, "x", a), "source1"), prepare_side(side(spark, "y", b), "source2")
    pairs = one.crossJoin(two).withColumn("title_similarity", title_similarity(F.col("source1_title"), F.col("source2_title")))
    scored = with_scores(pairs, config).where(f"confidence_score >= {config.min_confidence}")
    return {(r.source1_id, r.source2_id): r.confidence_score for r in scored.select("source1_id", "source2_id", "confidence_score").collect()}


def greedy(pairs, a, b):
    text = {r[0]: says(r) for r in (*a, *b)}
    taken, out = set(), {}
    order = sorted(pairs, key=lambda p: (-pairs[p], hashlib.md5(f"{text[p[0]]}|{text[p[1]]}".encode()).hexdigest(), p))
    for x, y in order:
        if x not in taken and y not in taken:
            taken |= {x, y}
            out[x] = y
    return out


def test_a_loser_gets_the_next_partner(spark):
    a = [("x1", None, "Iron gear", ["A"]), ("x2", None, "Iron gear 2", [])]
    b = [("y1", None, "Iron gear", ["A"]), ("y2", None, "Iron gears 3", [])]
    assert {(r.source1_id, r.source2_id) for r in stable_match(side(spark, "x", a), side(spark, "y", b)).collect()} == {("x1", "y1"), ("x2", "y2")}


def test_no_pair_would_rather_be_matched(spark):
    rng = random.Random(4)
    words = "red blue iron copper ring bolt gear".split()

    def rows(name, n):
        return [(f"{name}{i:03}", rng.choice([None, None, f"97800000000{rng.randint(10, 15)}"]), " ".join(rng.choice(words) for _ in range(rng.randint(1, 3))), rng.choice([[], ["A"], ["A", "B"], None])) for i in range(n)]

    a, b = rows("x", 60), rows("y", 50)
    config = MatchConfig()
    pairs = all_pairs(spark, a, b, config)
    found = {r.source1_id: (r.source2_id, r.confidence_score) for r in stable_match(side(spark, "x", a), side(spark, "y", b)).collect()}
    assert {x: y for x, (y, _) in found.items()} == greedy(pairs, a, b)
    assert all(pairs[x, y] == s for x, (y, s) in found.items())
    score2 = {y: s for y, s in found.values()}
    assert not [p for p, s in pairs.items() if s > found.get(p[0], (None, 0))[1] and s > score2.get(p[1], 0)]
    assert len(found) > 30


@pytest.mark.parametrize("n, m", [(400, 300), (1, 5)])
def test_copies_are_paired_by_rank_in_one_round(spark, n, m):
    a = [(f"x{i:03}", None, "Same title", ["A"]) for i in range(n)]
    b = [(f"y{i:03}", None, "Same title", ["A"]) for i in range(m)]
    found = {(r.source1_id, r.source2_id) for r in stable_match(side(spark, "x", a), side(spark, "y", b)).collect()}
    assert found == {(f"x{i:03}", f"y{i:03}") for i in range(min(n, m))}


def test_rounds_stay_few_with_ties(spark):
    """All pairs are equally good: without the digest each round would take one of them."""
    n = 120
    pairs = spark.range(n * n).selectExpr(f"concat('a', id div {n}) as source1_entry", f"concat('b', id % {n}) as source2_entry", "0.7D as score").withColumn("tie", F.md5(F.concat_ws("|", "source1_entry", "source2_entry")))
    places = [spark.range(n).selectExpr(f"concat('{p}', id) as source{k}_entry", f"1L as source{k}_places") for k, p in ((1, "a"), (2, "b"))]
    taken, rounds = stable_rounds(pairs, tuple(places))
    assert taken.count() == n and rounds <= 15


def test_empty_sides(spark):
    none, some = side(spark, "x", []), side(spark, "y", [("y1", None, "Ring", ["A"]), (None, None, "Ring", []), ("y2", None, None, [])])
    assert stable_match(none, some).collect() == [] and stable_match(some, none).collect() == []


def test_entries_reach_the_least_confidence(spark):
    one = spark.createDataFrame([("e", None, "ring of iron", ["A"])], "source1_entry string, source1_isbn13 string, source1_title string, source1_authors array<string>")
    two = spark.createDataFrame([("f", None, "bolt", ["A"])], "source2_entry string, source2_isbn13 string, source2_title string, source2_authors array<string>")
    assert scored_entries(one, two, MatchConfig()).collect() == []


def test_pairs_are_made_only_between_entries_with_a_place_left(spark, monkeypatch):
    """Alike titles under many ISBNs: the best layer settles nearly all, and the pairs across titles are not made."""
    n = 30
    a, b = ([(f"{p}{i:03}", f"{k}{i:012}", f"Iron gear {'abcd'[i % 4]}", ["A"]) for i in range(n + k)] for k, p in ((0, "x"), (2, "y")))
    config = MatchConfig()
    made, layers = [], assignment.stable_layers
    monkeypatch.setattr(assignment, "FEW_PAIRS", 20)  # so that rounds are taken as well

    def watched(one, two, config):
        taken, pairs = layers(one, two, config, 0)
        made.append(pairs)
        return taken, pairs

    monkeypatch.setattr(assignment, "stable_layers", watched)
    found = {r.source1_id: r.source2_id for r in stable_match(side(spark, "x", a), side(spark, "y", b)).collect()}
    pairs = all_pairs(spark, a, b, config)
    assert found == greedy(pairs, a, b) and len(found) == n
    assert len(pairs) == n * (n + 2) and made[0] < len(pairs) / 2
