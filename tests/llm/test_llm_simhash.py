"""SimHash fingerprints and the Gray-order index against brute force."""

import random
import re

import brute
import numpy as np
import pytest
import xxhash

from shelfmark.llm import simhash
from shelfmark.llm.queries import QUERIES

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    w = BLANK.findall((text or "").translate(brute.LOW))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def expected(rows):
    fps = [fingerprint(t) for _, t in rows]
    root = brute.groups(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    out = []
    for (doc, _), fp, r in zip(rows, fps, root):
        ids = [d for (d, _), q in zip(rows, root) if q == r and d is not None]
        out.append((doc, f"{fp:016x}", min(ids, default=None)))
    return out


def order(rows):
    return sorted(rows, key=str)


def test_documents_equal_brute_force(spark, tmp_path):
    rows = brute.documents()
    near = brute.prose(5, 400).split()
    for i in range(40, 60):  # one word changed: few bits differ
        near[i] = f"changed{i}"
        rows.append((i, " ".join(near)))
    rows += [(None, rows[0][1]), (3, rows[5][1]), (61, None), (62, "two words"), (63, "Two WORDS"), (64, "a\x00b c d e"), (None, "alone without an id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs.selectExpr("doc_id", "text", "'x' as fp", "1 as page").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op11_simhash"](spark, str(tmp_path)).collect()
    assert order(tuple(r) for r in found) == order(expected(rows))


@pytest.mark.parametrize("piece", [7, 40, 1000])
def test_long_texts_in_pieces(monkeypatch, piece):
    text = "One  two\nthree\t" + brute.prose(3, 90) + " " + "long" * 40 + " end\r\n"
    monkeypatch.setattr(simhash, "BYTES", piece)
    for t in (text, "word " * 3, "w" * 50, "a b", "a b " + "c" * 60, " " * 50):
        data = np.frombuffer(t.encode(), np.uint8)
        assert int(simhash.fingerprints(data, np.array([0, len(data)]))[0]) == fingerprint(t)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_gray_order(spark):
    rng = random.Random(1)
    bits = [rng.getrandbits(64) for _ in range(50)]
    df = spark.createDataFrame([(b - (1 << 64) if b >> 63 else b,) for b in bits], "b long")
    ranks = np.array([r[0] for r in df.select(simhash.gray_rank(simhash.F.col("b"))).collect()])
    assert [int(x) for x in simhash.unranked(ranks)] == bits


def clustered(seed, n):
    """Fingerprints around a few centres, with many pairs at a distance of two to five."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        fp = rng.choice(centres[:1] * 3 + centres)
        for _ in range(rng.randint(0, 12)):
            fp ^= 1 << rng.randrange(64)
        out.add(fp)
    return sorted(out)


@pytest.mark.parametrize("page, leaf", [(1024, 16), (8, 2)])
def test_pages_and_blocks_of_any_size(spark, monkeypatch, page, leaf):
    """A hot block over many pages and groups of pages loses no link and makes none."""
    monkeypatch.setattr(simhash, "PAGE", page)
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash.page_pairs, "__defaults__", (4,))
    # workers read the module's own sizes, so pages are cut here by the driver's functions
    fps = clustered(page, 500)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    real = simhash.pages_of

    def small_pages(frame):
        rows = []
        for turn in range(4):
            bits = np.array([(f << 16 * turn | f >> (64 - 16 * turn)) & (1 << 64) - 1 if turn else f for f in fps], np.uint64)
            rank = bits.copy()
            for k in (1, 2, 4, 8, 16, 32):
                rank ^= rank >> np.uint64(k)
            bits = bits[np.argsort(rank)]
            for k in range(0, len(bits), page):
                part = bits[k : k + page]
                rows.append((turn, (turn * 3 + (k > 250)) << 32 | k, part.tobytes(), int(part[0] >> np.uint64(48)), int(part[-1] >> np.uint64(48))))
        pages = {}
        for i, r in enumerate(rows):  # pages of a partition are numbered without gaps
            part = r[1] >> 32
            pages[part] = pages.get(part, -1) + 1
            rows[i] = (r[0], part << 32 | pages[part], *r[2:])
        return spark.createDataFrame(rows, "turn int, page long, entries binary, opens long, closes long")

    monkeypatch.setattr(simhash, "pages_of", small_pages if page < 1024 else real)
    found = {r["id"] % (1 << 64): r["group"] for r in simhash.components(df).collect()}
    root = brute.groups(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    members = {}
    for fp, r in zip(fps, root):
        members.setdefault(r, set()).add(fp)
    want = {frozenset(m) for m in members.values() if len(m) > 1}
    got = {}
    for fp, g in found.items():
        got.setdefault(g, set()).add(fp)
    assert {frozenset(m) for m in got.values()} == want
    assert len(want) > 1


def test_index_finds_every_near_pair():
    fps = np.array(clustered(3, 700), np.uint64)
    rank = fps.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    fps = fps[np.argsort(rank)]
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 3
    index = simhash.Index(fps)
    a, b = simhash.near_pairs(index, index)
    assert set(zip(a.tolist(), b.tolist())) == {(int(i), int(j)) for i, j in zip(*np.nonzero(near)) if i < j}
    one, two = simhash.Index(fps[:333]), simhash.Index(fps[333:])
    a, b = simhash.near_pairs(one, two)
    assert set(zip(a.tolist(), b.tolist())) == {(int(i), int(j)) for i, j in zip(*np.nonzero(near[:333, 333:]))}
    pruned = len(simhash.near_leaves(index, index)[0]) / len(index.first) ** 2
    assert pruned < 0.9
