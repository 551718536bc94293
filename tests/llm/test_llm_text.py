"""Operators on whole texts against their brute-force versions."""

import hashlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, groups, line_dedup, near_dup, substrings
from shelfmark.llm.blocks import ascii_word_fold, text_bytes, words

SCHEMA = "doc_id long, text string, score string, size long, n_lines string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in rows], SCHEMA).repartition(3)


def test_words_across_steps(monkeypatch):
    import pyarrow as pa

    from shelfmark.llm import blocks

    texts = ["alpha Beta-gamma", None, "", "x" * 500, "a b" * 50, "é ß9 --- end", "end"]
    expected = [(i, w) for i, t in enumerate(texts) for w in brute.words(t)]
    for step in (7, 64, 1 << 20):
        monkeypatch.setattr(blocks, "STEP", step)
        data, offsets = text_bytes(pa.array(texts))
        hashes, row, start, end = words(data, offsets, ascii_word_fold())
        got = [(int(r), bytes(data[a:b]).decode().translate(brute.LOW)) for r, a, b in zip(row, start, end)]
        assert got == expected
        assert len({w for _, w in got}) == len(set(hashes.tolist()))


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_substrings(spark, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    rows = brute.documents()
    expected = {i: b for (i, _), b in zip(rows, brute.repeated_bytes(rows))}
    got = substrings.remove(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {i: (*b[:3], hashlib.sha256(b[3]).hexdigest()) for i, b in expected.items()}


def test_substrings_odd_rows(spark):
    text = brute.prose(1, 80)
    rows = [(None, text), (1, text), (1, text), (1, brute.prose(2, 80)), (2, None)]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in substrings.remove(frame(spark, rows)).collect())
    n = len(text)
    assert got == sorted([(0, n, 0), (1, n, n), (1, n, n), (1, len(rows[3][1]), 0), (2, 0, 0)])
    assert substrings.remove(frame(spark, rows).limit(0)).count() == 0


def test_substrings_of_one_id_whose_32_bit_hashes_are_equal(spark):
    """Texts of one doc_id are told apart even if a short hash of them is not."""
    text = F.concat(F.repeat(F.sha2(F.col("id").cast("string"), 256), 2))
    twins = spark.range(300_000).select(text.alias("t")).groupBy(F.hash("t").alias("h")).agg(F.sort_array(F.collect_list("t")).alias("t"))
    a, b = twins.where("size(t) > 1").orderBy("h").first()["t"][:2]
    for rows in ([(0, b), (1, a), (1, b)], [(1, a), (1, b), (2, b)]):
        got = sorted((r.doc_id, r.kept_sha256, r.n_removed) for r in substrings.remove(frame(spark, rows)).collect())
        empty = hashlib.sha256(b"").hexdigest()
        digest = {t: hashlib.sha256(t.encode()).hexdigest() for t in (a, b)}
        kept = [(i, digest[t], 0) for i, t in rows[:-1]] + [(rows[-1][0], empty, 128)]
        assert got == sorted(kept)


@pytest.mark.parametrize("collide", [False, True])
def test_suffix_order(monkeypatch, collide):
    if collide:  # every prefix has the same hash: the bytes decide
        monkeypatch.setattr(substrings, "_OTHER", np.zeros(256, np.uint64))
    rng = np.random.default_rng(5)
    group = np.sort(rng.integers(0, 6, 60))
    table = rng.integers(97, 99, (60, 12)).astype(np.uint8)
    limit = rng.integers(0, 13, 60)
    order, shared = substrings.suffix_order(table, limit, group)
    strings = [(group[k], table[k, : limit[k]].tobytes()) for k in order]
    assert strings == sorted(strings)
    for k in range(1, 60):
        (g, a), (h, b) = strings[k - 1], strings[k]
        if g == h:
            common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert min(shared[k], len(a), len(b)) == common


def test_decontamination(spark):
    rows = brute.documents()
    items = [(1, rows[3][1]), (2, "xx yy zz"), (2, rows[20][1][:200]), (3, None), (4, ""), (5, brute.prose(99, 40)[30:150]), (None, "short line"), (6, "word")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")
    named = [("null" if i is None else str(i), t) for i, t in items]
    expected = {i: brute.contamination(t, named) for i, t in rows}
    for portion in (32 << 20, 400):
        got = decontaminate.find_contamination(frame(spark, rows), bench, portion=portion).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, set(r["items"])) for r in got} == expected
        assert all(set(r["items"]) <= set(r.near) for r in got if "6" not in r["items"])
    clean = decontaminate.find_contamination(frame(spark, rows), bench.limit(0)).collect()
    assert len(clean) == len(rows) and all(r.n_hit == 0 and r["items"] == [] for r in clean)


def test_proximity(spark):
    item = "one two three four five six seven eight nine ten"
    mixed = "start ten nine eight seven x six five four three two one end"
    far = " ".join(w + " pad" * 9 for w in item.split())
    docs = frame(spark, [(1, item), (2, mixed), (3, far)])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near) for r in decontaminate.find_contamination(docs, bench).collect()}
    assert got == {1: (["7"], ["7"]), 2: ([], ["7"]), 3: ([], [])}


def test_near_duplicates(spark):
    rows = brute.documents()
    sets = [brute.shingles(t) for _, t in rows]
    root = brute.groups(sets, lambda a, b: bool(a and b) and brute.probability_jaccard(a, b) >= 0.8)
    expected = {i: rows[r][0] for (i, _), r in zip(rows, root)}
    got = near_dup.classes(frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == expected
    size = {c: sum(v == c for v in expected.values()) for c in expected.values()}
    assert all(r.class_size == size[r.class_id] for r in got)
    assert near_dup.classes(frame(spark, rows).limit(0)).count() == 0


def test_near_duplicate_signatures():
    """Registers agree with the probability Jaccard of the weights."""
    rng = np.random.default_rng(1)
    element = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    u, v = rng.integers(1, 5, 60).astype(float), rng.integers(1, 5, 60).astype(float)
    u[:15], v[45:] = 0, 0
    row = np.repeat([0, 1], 60)
    weight = np.concatenate([u, v])
    keep = weight > 0
    sigs = near_dup.prob_minhash(row[keep], np.tile(element, 2)[keep], weight[keep], 2, 4000)
    exact = near_dup.probability_jaccard((element[u > 0], u[u > 0]), (element[v > 0], v[v > 0]))
    named = [dict(zip(element[w > 0].tolist(), w[w > 0])) for w in (u, v)]
    assert abs(exact - brute.probability_jaccard(*named)) < 1e-9
    assert abs((sigs[0] == sigs[1]).mean() - exact) < 0.04


def test_lines(spark):
    rows = brute.documents()
    rows += [(40, "The quick brown fox jumps over the lazy dog today, and then it sleeps all day long.\nkept one here"), (41, "other start line\nThe quick brown fox jumps over the lazy dog today, and then it sleeps all day Long.")]
    expected = dict(zip([i for i, _ in rows], brute.dedup_lines(rows)))
    got = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert {r.doc_id: r.text for r in got} == expected
    assert {r.size for r in got} == {1} and all(isinstance(r.n_lines, int) for r in got)
    assert line_dedup.dedup_lines(frame(spark, rows).limit(0)).count() == 0


def test_lines_of_ordinary_length(spark):
    """One changed character in lines of 30 to 60 characters, of one byte or of several each."""
    rng = np.random.default_rng(8)
    rows, kept = [], []
    for low, high in ((0x21, 0x7F), (0x4E00, 0x9FA5), (0x1F300, 0x1F600)):
        for size in (30, 37, 45, 60):
            line = [chr(c) for c in rng.choice(np.arange(low, high), size, replace=False)]
            other = list(line)
            other[int(rng.integers(3, size - 3))] = "é"
            rows += [(len(rows), "".join(line)), (len(rows) + 1, "".join(other))]
            kept += ["".join(line), ""]
    short = ["a", "ab", "abc", "é", "éa"]
    rows += [(len(rows) + k, t) for k, t in enumerate(short)]
    got = sorted(line_dedup.dedup_lines(frame(spark, rows)).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in got] == kept + short


def test_lines_odd_rows(spark):
    rows = [(None, "same old line\nfirst"), (1, "same old line\nsecond"), (1, "same old line\nthird"), (2, None)]
    got = sorted(r.text for r in line_dedup.dedup_lines(frame(spark, rows)).collect())
    assert got == ["", "same old line\nfirst", "second", "third"]


def test_near_lines_of_a_bucket(monkeypatch):
    """The pairs of a bucket connect all similar lines, whichever way the bucket is gone through; few others pass."""
    rng = np.random.default_rng(3)
    texts = []
    for k in range(60):
        line = rng.choice(np.arange(0x21, 0x7F), int(rng.integers(3, 300) if k % 9 else 3000))
        texts += [bytes(line.astype(np.uint8))] * 2
        for _ in range(2):
            line[rng.integers(0, len(line), max(1, len(line) // 60))] = 0x20
            texts.append(bytes(line.astype(np.uint8)))
    data = np.frombuffer(b"".join(texts), np.uint8)
    end = np.cumsum([len(t) for t in texts])
    begin = end - [len(t) for t in texts]
    ids = line_dedup.line_ids(data, begin, end)
    _, rest = line_dedup._signatures(data, begin, end, np.empty(0, np.uint32))
    heads = np.hstack([ids.view(np.uint8).reshape(-1, 8), rest])
    sets = [set(line_dedup.prepare(t).tolist()) for t in texts]
    similar = {(i, j) for i in range(len(texts)) for j in range(i) if ids[i] != ids[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert len(similar) > 60 and all(line_dedup.spare_bits(rest[i], rest[[j]])[0] >= 0 for i, j in similar)
    for long in (4096, 4):
        monkeypatch.setattr(line_dedup, "LONG", long)
        group = dict(zip(*(x.tolist() for x in line_dedup.joined(*line_dedup.near_pairs(np.zeros(len(texts), np.uint32), heads)))))
        of = [group.get(i, i) for i in ids.view(np.int64).tolist()]
        assert all(of[i] == of[j] for i, j in similar)
        assert len(set(of)) > 40


def test_lines_in_many_passes(spark, monkeypatch):
    """Few bands at a time, and stored in two portions: equal results."""
    rows = brute.documents()
    monkeypatch.setattr(line_dedup, "SMALL", 0)
    monkeypatch.setattr(line_dedup, "PASS", 9)
    monkeypatch.setattr(line_dedup, "STORED", 18)
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, rows)).collect()} == dict(zip([i for i, _ in rows], brute.dedup_lines(rows)))


def test_packed_rows_grow_with_lines(spark):
    """Rows that move are packed full: many small blocks or many parts make no more of them than their lines fill."""
    rng = np.random.default_rng(5)
    blocks, lines, step, parts = 300, 40, 3, 64
    every = [(rng.integers(0, 256, (lines, line_dedup.HEAD), np.uint8), rng.integers(0, 1 << 32, (lines, step), np.uint32)) for _ in range(blocks)]
    stored = spark.createDataFrame([(h.tobytes(), k.tobytes()) for h, k in every], "heads binary, keys0 binary").coalesce(1)
    rows = line_dedup.cut_by_key(stored, "keys0", step, parts).collect()
    assert len(rows) == parts  # 12,000 lines in one task; block by block and band by band there were some 29,000 rows
    got = []
    for r in rows:
        key, heads = np.frombuffer(r.keys, np.uint32), np.frombuffer(r.heads, np.uint8).reshape(-1, line_dedup.HEAD)
        assert (key % parts == r.part).all()
        got += zip(np.repeat(np.arange(step), np.frombuffer(r["sizes"], np.int32)).tolist(), key.tolist(), map(bytes, heads))
    assert sorted(got) == sorted((band, int(key[band]), bytes(head)) for h, k in every for head, key in zip(h, k) for band in range(step))


def test_bands_keep_their_chance():
    assert [line_dedup.rows_for(n) for n in (0, 4_000_000, 5_000_000, 1 << 40)] == [7, 7, 8, 12]
    assert all((1 - 0.8**rows) ** line_dedup.bands_for(rows) < 0.0018 for rows in range(7, 13))


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 90), (90, 95)] + [(200 + i, 300) for i in range(30)]
    links = spark.createDataFrame(chain, "id long, root long")
    got = {r.id: r.group for r in groups.components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 90 for i in (90, 95, 100)}, **{200 + i: 200 for i in range(30)}, 300: 200}
    assert groups.components(links.limit(0)).count() == 0


def test_cells_lose_no_link(spark, monkeypatch):
    """A group cut into many cells gives the same components."""
    rows = brute.documents()
    expected = {r.doc_id: r.class_id for r in near_dup.classes(frame(spark, rows)).collect()}
    monkeypatch.setattr(groups, "CELL", 1500)
    assert {r.doc_id: r.class_id for r in near_dup.classes(frame(spark, rows)).collect()} == expected


def test_paths_without_sent_ids(spark, monkeypatch):
    rows = brute.documents()
    expected = {r.doc_id: r.class_id for r in near_dup.classes(frame(spark, rows)).collect()}
    monkeypatch.setattr(groups, "BROADCAST_IDS", 0)
    assert {r.doc_id: r.class_id for r in near_dup.classes(frame(spark, rows)).collect()} == expected
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, rows)).collect()} == dict(zip([i for i, _ in rows], brute.dedup_lines(rows)))


def test_shared_buckets(spark):
    rows = [(b, i) for b in range(50) for i in range(b % 4)] * 2
    got = groups.shared_buckets(spark.createDataFrame(rows, "bucket long, id long").withColumn("id", F.col("id") * 7))
    assert sorted((r.bucket, r.id) for r in got.collect()) == sorted({(b, i * 7) for b, i in rows if b % 4 > 1})
