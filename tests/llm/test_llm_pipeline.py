"""The pipeline's stages against a brute-force version, and odd tables."""

import hashlib
import math

import brute
import corpus_pipeline
import pytest
from test_llm_rest import targets


def tables(spark, folder, rows, labels, items):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _score string"
    documents = [(i, t, "en", s, len(t or ""), "clash") for i, t, s in rows]
    spark.createDataFrame(documents, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def fixture():
    rows = [(i, t) for i, t in brute.documents()]
    rows += [(100 + i, brute.prose(1000 + i, 30)) for i in range(60)]
    rows += [(200 + i, brute.prose(2000 + i, 15) + " idiot " + brute.prose(3000 + i, 15)) for i in range(30)]
    rows += [(300 + i, brute.prose(4000 + i, 10) + " " + brute.prose(5000, 25)) for i in range(3)]
    rows += [(400, rows[0][1]), (400, rows[0][1])]
    rows = [(i, t, ["b", "a", None, "c"][i % 4]) for i, t in rows]
    labels = [(i, 1, int("idiot" in (t or ""))) for i, t, _ in rows if i >= 100 and i < 300]
    return rows, labels, [(1, brute.prose(5000, 25)), (2, None)]


def brute_run(rows, items):
    """What each stage keeps, as (doc_id, text, source)."""
    stages = []
    rows = sorted(((i, t or "", s) for i, t, s in rows if "idiot" not in (t or "")), key=lambda r: r[0])
    stages.append(rows)
    # rows that repeat id and text are one document to the line stage
    distinct = list(dict.fromkeys(rows))
    after = dict(zip(distinct, brute.dedup_lines([(i, t) for i, t, _ in distinct])))
    rows = [(r[0], after[r], r[2]) for r in rows if not (after[r] != r[1] and not after[r].strip(brute.BLANK))]
    stages.append(rows)
    sets = [brute.shingles(t) for _, t, _ in rows]
    root = brute.groups(sets, lambda a, b: bool(a and b) and brute.probability_jaccard(a, b) >= 0.8)
    rows = [r for k, r in enumerate(rows) if root[k] == k]
    stages.append(rows)
    rows = [r for r in rows if not brute.contamination(r[1], [(str(i), t) for i, t in items])[1]]
    stages.append(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    goal, out = targets(sizes), []
    for i, t, s in rows:
        rate = goal[s] / sizes[s] if sizes[s] else 0
        u = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 2**52
        out += [(i, t, s)] * (math.floor(rate) + (u < rate - math.floor(rate)))
    stages.append(out)
    return stages


def test_stages_equal_brute_force(spark, tmp_path):
    rows, labels, items = fixture()
    folder = tables(spark, str(tmp_path), rows, labels, items)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    key = lambda r: (r[0], r[1], r[2] or "")
    for (name, stage), expected in zip(corpus_pipeline.STAGES, brute_run(rows, items)):
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == columns
        got = sorted(((r.doc_id, r.text or "", r.source) for r in docs.collect()), key=key)
        assert got == sorted(expected, key=key), name
        assert all(r.n_chars == len(r.text or "") and r._score == "clash" for r in docs.collect())


@pytest.mark.parametrize("rows", [[], [(None, None, None), (1, "", "a"), (1, None, "a")]])
def test_odd_tables(spark, tmp_path, rows):
    folder = tables(spark, str(tmp_path), rows, [], [])
    got = corpus_pipeline.run(spark, folder)
    assert got.columns[:2] == ["doc_id", "text"] and got.count() == 0
