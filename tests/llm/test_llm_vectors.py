"""Vector codes and hard negatives against brute force, with odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import hard_negatives, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label long, key string, q int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], SCHEMA).repartition(3)


def vectors(seed, n, dims=16, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    return [[c + rng.gauss(0, spread) for c in centres[rng.randrange(5)]] for _ in range(n)]


def odd_rows():
    rows = [(i, v, i % 3 if i % 11 else None) for i, v in enumerate(vectors(1, 120))]
    rows += [(200 + i, rows[4][1], 1) for i in range(30)]  # equal vectors, ties
    rows += [(300, None, 1), (301, [None] + [0.0] * 15, 1), (302, [math.nan] * 16, 1), (303, [math.inf] * 16, 2), (304, [0.5], 1), (305, [], 1), (350, [0.0] * 16, 1)]
    return rows


def sound(rows):
    return [r for r in rows if r[1] is not None and len(r[1]) == 16 and all(x is not None and math.isfinite(x) for x in r[1])]


# ---- codes --------------------------------------------------------------------------


def plain_codes(rows, rounds=6, parts=8, entries=16):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, [math.floor(4096 * x) for x in r[1]]))
    width = -(-len(rows[0][1]) // parts)
    x = np.zeros((len(rows), parts * width), np.int64)
    for i, r in enumerate(rows):
        x[i, : len(r[1])] = [math.floor(4096 * c) for c in r[1]]
    x = x.reshape(len(rows), parts, width)
    book = [x[:entries, p].copy() for p in range(parts)]

    def nearest(p):
        far = ((x[:, p, None] - book[p][None]) ** 2).sum(axis=2)
        return far.argmin(axis=1), far.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            own = nearest(p)[0]
            for k in range(len(book[p])):
                if (own == k).any():
                    book[p][k] = x[own == k, p].sum(axis=0) // (own == k).sum()
    done = [nearest(p) for p in range(parts)]
    codes = ["".join(f"{done[p][0][i]:02x}" for p in range(parts)) for i in range(len(rows))]
    errors = [int(sum(done[p][1][i] for p in range(parts))) for i in range(len(rows))]
    numbers = ",".join(str(c) for p in range(parts) for e in book[p] for c in e)
    return [(r[0], c, e) for r, c, e in zip(rows, codes, errors)], hashlib.sha256(numbers.encode()).hexdigest()


@pytest.mark.parametrize("rows", [odd_rows(), odd_rows()[:7], [(None, v, None) for v in vectors(2, 40)] + [(3, v, 1) for v in vectors(3, 3)], [(i, v, 0) for i, v in enumerate(vectors(4, 60, dims=13))]])
def test_codes_equal_brute_force(spark, rows):
    found, books = vector_codes.compress(table(spark, rows))
    got = sorted(((r["key"], r["code"].hex(), r["error"]) for r in found.collect()), key=str)
    kept = sound(rows) or [r for r in rows if r[1]]
    want, digest = plain_codes(kept)
    assert got == sorted(want, key=str)
    assert vector_codes.digest(books) == digest


def test_label_errors_keep_nulls_together(spark):
    codes = spark.createDataFrame([(1, None, 5), (2, None, 7), (3, 1, 2)], "key long, label long, error long")
    assert sorted((r["key"], r["label_error"]) for r in vector_codes.label_errors(codes).collect()) == [(1, 12), (2, 12), (3, 2)]


def test_codes_of_an_empty_table(spark):
    found, books = vector_codes.compress(table(spark, []))
    assert found.collect() == [] and books is None
    found, _ = vector_codes.compress(table(spark, [(1, None, 1), (2, [math.nan], None)]))
    assert found.collect() == []


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(table(spark, [(1, [1e12] * 16, 1)]))
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(table(spark, [(1, [1e300] * 16, 1)]))


def test_bounds_hold_and_save_scans():
    """Carried bounds never say that an entry is kept when it is not, and most scans are saved."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (16, 8, 4))
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-300, 300, (3000, 8, 4))
    books = vector_codes.Codebooks(x[:16].transpose(1, 0, 2).copy())
    state = {c: np.zeros((3000, 8), kind) for c, kind in vector_codes.STATE_KINDS.items()}
    for p in range(8):
        state["assigned"][:, p], state["upper"][:, p], state["lower"][:, p] = vector_codes.scan(x[:, p], books.latest()[p])
    scanned = 0
    for turn in range(1, 8):
        fresh = books.latest().copy()
        for p in range(8):
            for k in range(16):
                own = state["assigned"][:, p] == k
                if own.any():
                    fresh[p, k] = x[own, p].sum(axis=0) // own.sum()
        books.history.append(fresh)
        scanned += vector_codes.assign(x, state, fresh, books.moves(), turn).sum()
        for p in range(8):
            assert (state["assigned"][:, p] == vector_codes.scan(x[:, p], fresh[p])[0]).all()
    assert scanned < 0.5 * 7 * 3000 * 8
    own, _ = books.moves()
    steps = np.array([np.sqrt(((b - a) ** 2).sum(axis=2)) for a, b in zip(books.history, books.history[1:])])
    assert (own[0] <= steps.sum(axis=0) + 1e-9).all()


def test_decode(spark):
    found, books = vector_codes.compress(table(spark, odd_rows()))
    x = {r[0]: np.array([math.floor(4096 * c) for c in r[1]]) for r in sound(odd_rows())}
    for r in found.collect():
        assert int(((np.array(vector_codes.decode(r["code"], books)) - x[r["key"]]) ** 2).sum()) == r["error"]


# ---- hard negatives -----------------------------------------------------------------


def plain_negatives(rows, step):
    kept = {}
    for i, v, lab in sound(rows):
        if i is not None and lab is not None:
            q = [math.floor(256 * c) for c in v]
            kept[i] = min(kept.get(i, (lab, q)), (lab, q))
    out = []
    for a, (lab, q) in kept.items():
        if a % step:
            continue
        score = {i: sum(x * y for x, y in zip(q, w)) for i, (_, w) in kept.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if kept[i][0] == lab][:5]:
            fits = [i for i in order if kept[i][0] != lab and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(fits[:3])]
    return sorted(out)


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ZONES", 4)
    rows = odd_rows() + [(400, vectors(9, 1)[0], 5), (6, vectors(8, 1)[0], 0), (None, vectors(7, 1)[0], 1)]
    found = hard_negatives.mine(table(spark, rows), 4).collect()
    assert sorted(tuple(r) for r in found) == plain_negatives(rows, 4)
    assert len(found) > 50


def test_negative_and_zero_scores(spark):
    flat = [(i, [(-1.0) ** i / 16 * (1 + i % 3)] * 16, i % 2) for i in range(20)] + [(i, [0.0] * 16, 1) for i in range(20, 24)]
    found = hard_negatives.mine(table(spark, flat), 2).collect()
    assert sorted(tuple(r) for r in found) == plain_negatives(flat, 2)


def test_no_negatives_of_nothing(spark):
    assert hard_negatives.mine(table(spark, []), 4).collect() == []
    assert hard_negatives.mine(table(spark, [(4, [0.5] * 16, 1)]), 4).collect() == []
    assert hard_negatives.mine(table(spark, [(5, [0.5] * 16, 1)]), 4).collect() == []


def test_zone_maps_bound_every_score_and_prune():
    rng = np.random.default_rng(2)
    blocks = [rng.integers(-250, 250, 8) + rng.integers(-20, 20, (50, 8)) for _ in range(30)]
    anchors = rng.integers(-250, 250, (10, 8))
    least, most = hard_negatives.score_range(anchors, np.stack([b.min(axis=0) for b in blocks]), np.stack([b.max(axis=0) for b in blocks]))
    scores = np.stack([anchors @ b.T for b in blocks], axis=1)
    assert (least <= scores.min(axis=2)).all() and (most >= scores.max(axis=2)).all()
    best = scores.reshape(10, -1).max(axis=1)
    assert (most >= best[:, None]).mean() < 0.4


def test_exact_percentages(spark):
    row = spark.createDataFrame([(s,) for s in range(-45, 46)], "s long").select("s", hard_negatives.exact_floor("s", 95), hard_negatives.exact_ceiling("s", 50)).collect()
    assert all(f == 95 * s // 100 and c == -(-50 * s // 100) for s, f, c in row)


def test_order_of_blocks_follows_the_curve(spark):
    """Blocks of a clustered table are narrower than blocks of rows in order of id."""
    rows = [(i, v, 0) for i, v in enumerate(vectors(11, 3000, spread=0.05))]
    made = hard_negatives.blocks_of(hard_negatives.candidates(table(spark, rows), "vec_id", "embedding", F.col("label"))).collect()
    assert sum(len(r["keys"]) // 8 for r in made) == 3000
    width = np.mean([(np.frombuffer(r["high"], np.int32) - np.frombuffer(r["low"], np.int32)).mean() for r in made if len(r["keys"]) >= 8 * 100])
    every = np.array([[math.floor(256 * c) for c in v] for _, v, _ in rows])
    assert width < 0.6 * (every.max(axis=0) - every.min(axis=0)).mean()
