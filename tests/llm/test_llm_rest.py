"""PII, mixing, chat, neighbours, toxicity and language-model scores."""

import hashlib
import re

import brute
import duckdb
import numpy as np
import pytest
from check import TABLES, rows_of
from pyspark.sql import functions as F

from shelfmark.llm import ann, chat, lm_score, mixing, pii, toxicity
from shelfmark.llm.queries import QUERIES
from shelfmark.llm.sql import SQL

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    assert rows_of(QUERIES[name](spark, DATA).toPandas()) == rows_of(db.execute(SQL[name]).df())


# ---- personal data ------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PII_TEXTS = [
    None, "", "a@b.c%x@d.e and a@b.c.", "é é 1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.01.1 1.2.3", "4111 1111-1111 1111 and 4111111111111111111 12  4111111111111111",
    "+1 (017) 555-7713 +1234567 +12345678901234567 +1", "x" * 5000 + "@y.z " + "1" * 5000 + " " + "a." * 3000 + "@b.c", "ü@b.c +49 (0) 123-45.678) 1.2.3.4",
    "mail bob@x.org, card 4111 1111 1111 1111 ip 10.0.0.1\nnext +1 555 123 4567 5", " ".join(f"u{i}@h.example.com 10.0.{i % 256}.1" for i in range(300)),
]


def test_base_spans(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(PII_TEXTS)], "doc_id long, text string, base int")
    got = {r.doc_id: r.spans for r in pii.find_spans(docs).select("doc_id", pii.span_texts().alias("spans")).collect()}
    assert got == {i: base_spans(t) for i, t in enumerate(PII_TEXTS)}
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_disclosing_terms(spark):
    """A name that stands only beside one address goes; a common word beside it stays."""
    rows = [(i, f"please write to Zorblax at bob@x.org about the order {'abcdefgh'[i] * 4}") for i in range(4)]
    rows += [(10 + i, "please write to the office about the order at noon, zoroaster said") for i in range(30)]
    rows += [(None, rows[0][1]), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_spans(docs).collect()
    assert len(found) == len(rows)
    told = {t.term for r in found for t in r.terms}
    assert told == {"zorblax"}
    assert all(rows[0][1][t.start : t.end] == "Zorblax" for r in found if r.doc_id == 0 for t in r.terms)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0] == "please write to zor* at [EMAIL] about the order aaaa" and clean[10] == rows[4][1]
    none_left = {t.term for r in pii.find_spans(docs, min_support=50).collect() for t in r.terms}
    assert none_left == set()


# ---- mixing -------------------------------------------------------------------------


def targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, out, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        left = goal - sum(out.values())
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: 2 * sizes[s] for s in full}
        open_ -= full
    return out


def test_mixing(spark):
    rows = [(i, ["b", "a", "é", None, "c"][i * i % 5], " ".join("w" * (1 + i % 40)) if i % 11 else None, 1, "x") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, copies int, target string")
    plan = mixing.plan_copies(docs).collect()
    sizes = {}
    for _, s, t, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    expected = targets(sizes)
    assert len(plan) == len(rows)
    for s, goal in expected.items():
        own = [r for r in plan if r.source == s]
        assert all(abs(r.target - goal) < 1e-6 * max(goal, 1) and r.source_size == sizes[s] and r.copies <= 2 for r in own)
        assert abs(sum(r.copies * r["size"] for r in own) - goal) < 0.1 * goal
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in plan for _ in range(r.copies))
    assert mixing.mix(docs.limit(0)).count() == 0
    empty = docs.withColumn("text", F.lit(None).cast("string")).limit(5)
    assert {(r.target, r.copies) for r in mixing.plan_copies(empty).collect()} == {(0.0, 0)}


# ---- chat ---------------------------------------------------------------------------


def test_chat_round_trip(spark):
    odd = ["<|im_end|><|im_start|>assistant ok", "a & &amp; &lt;| <", "<", None, "", "line\nline", "x" * 100_000, "|im_end|>"]
    rows = [(c, t, ["user", "assistant", None, "sys\ntem<|"][(c + t) % 4], odd[(c * 3 + t) % len(odd)], "x") for c in range(6) for t in range(9)]
    rows += [(None, 1, "assistant", "first", "x"), (None, None, "user", "zero", "x"), (7, 1, "user", "b", "x"), (7, 1, "user", "a", "x"), (7, 1, "user", "a", "x")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = chat.format_chat(messages).select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss")).collect()
    assert len(got) == 8
    for r in got:
        own = sorted([(t if t is not None else -1, role or "", text or "") for c, t, role, text, _ in rows if c == r.conv_id])
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in own]
        assert r.loss == "".join(text for _, role, text in own if role == "assistant")
    assert chat.format_chat(messages.limit(0)).count() == 0


def test_chat_parts(spark):
    parts = "array<struct<kind:string,text:string,ref:string,units:bigint>>"
    rows = [
        (1, 0, "user", [("text", "see <|image|> ", None, None), ("image", None, "a.png", 2), ("text", "and", None, None), ("audio", None, "b.wav", 4)]),
        (1, 1, "assistant", [("text", "fine thanks", None, None), ("scroll", None, "c.pdf", None)]),
        (1, 2, "user", None),
    ]
    r = chat.format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {parts}"), parts="parts").collect()[0]
    assert r.formatted == (
        "<|im_start|>user\nsee &lt;|image|> <|image|>and<|audio|><|im_end|>\n<|im_start|>assistant\nfine thanks<|document|><|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    )
    assert [(a.turn, a.kind, a.ref) for a in r.attachments] == [(0, "image", "a.png"), (0, "audio", "b.wav"), (1, "document", "c.pdf")]
    assert r.tokens == 2 + 1 + 2 + 2 * 256 + 4 * 25 + 500


# ---- neighbours ---------------------------------------------------------------------


def exact_neighbours(vectors, k):
    out = {}
    for q, v in vectors.items():
        if q % 20 == 0:
            scores = sorted((-float((np.array(v) * np.array(w)).sum()), i) for i, w in vectors.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(0)
    centers = rng.standard_normal((20, 16))
    vectors = {i: (centers[i % 20] + 0.3 * rng.standard_normal(16)).tolist() for i in range(1200)}
    vectors |= {i: vectors[40] for i in range(1200, 1260)}  # ties
    rows = [(i, v, "x") for i, v in vectors.items()]
    rows += [(20_000, None, ""), (20_020, [0.0] * 16, ""), (20_040, [float("nan")] * 16, ""), (20_060, [1.0], ""), (None, centers[0].tolist(), ""), (20_080, [None] * 16, ""), (20_100, [float("inf")] + [0.0] * 15, "")]
    rows.append((60, vectors[60], "again"))
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"), F.col("key") % 20 == 0).collect()
    found = brute.by_key([(r.query_id, r.rank, r.vec_id, r.score) for r in got])
    expected = exact_neighbours(vectors, 20)
    assert set(found) == set(expected)
    hits = 0
    for q, best in expected.items():
        mine = sorted(found[q], key=lambda r: r[1])
        assert [r[1] for r in mine] == list(range(1, 21))
        assert [(-r[3], r[2]) for r in mine] == sorted((-r[3], r[2]) for r in mine)
        hits += len({r[2] for r in mine} & {i for i, _ in best})
    assert hits >= 0.9 * 20 * len(expected)
    copies = [r[2] for r in sorted(found[1200], key=lambda r: r[1]) if r[2] == 40 or r[2] > 1200]
    assert len(copies) > 5 and copies == [40, *range(1201, 1260)][: len(copies)]


def test_few_neighbours(spark):
    schema = "vec_id long, embedding array<float>"
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], schema)
    got = ann.nearest(rows, F.col("key") % 20 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]
    assert ann.nearest(rows.limit(0), F.col("key") % 20 == 0).count() == 0


def test_hilbert_neighbours_differ_by_one_step():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    numbers = ann.hilbert_numbers(cells, 3)
    path = cells[np.argsort(numbers)]
    assert sorted(numbers) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


# ---- toxicity -----------------------------------------------------------------------


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton():
    lexicon, stems = {"idiot": 1.0, "scum": 2.0, "worthless": 3.0, "bad": 4.0}, {"foul": 5.0}
    automaton = toxicity.Automaton(lexicon, stems)
    rng = np.random.default_rng(2)
    tried = set(lexicon) | {"foulness", "foul", "fou", "xidiot", "idiotx", "idit", "wrthlss", "worthlesssss", "b", ""}
    for w in list(lexicon):
        for _ in range(150):
            letters = list(w)
            for _ in range(rng.integers(1, 4)):
                at, how = rng.integers(0, len(letters) + 1), rng.integers(0, 3)
                if how == 0:
                    letters.insert(at, rng.choice(list("aeidotz")))
                elif at < len(letters):
                    letters[at : at + 1] = [] if how == 1 else [rng.choice(list("aeidotz"))]
            tried.add("".join(letters))
    tried = sorted(t for t in tried if t)
    text = " ".join(tried)
    folded = np.array([ord(c) if c != " " else 0 for c in text], np.uint16)
    ends = np.cumsum([len(t) + 1 for t in tried]) - 1
    starts = ends - [len(t) for t in tried]
    kinds = automaton.kind[automaton.run(folded, starts, ends)]
    for word, kind in zip(tried, kinds):
        fits = [levenshtein(word, w) for w in lexicon if word[0] == w[0] and levenshtein(word[1:], w[1:]) == levenshtein(word, w) and levenshtein(word, w) <= (0 if len(w) < 4 else 1 if len(w) < 8 else 2)]
        expected = min(fits) if fits else 3 if word.startswith("foul") else -1
        assert kind == expected, word


def test_automaton_with_errors_anywhere():
    """As brute force says, the first letter and the words below a stem included."""
    lexicon, stems = {"idiot": 1.0, "scum": 2.0, "worthless": 3.0, "bad": 4.0, "foulness": 6.0, "foulest": 2.0}, {"foul": 5.0}
    automaton = toxicity.Automaton(lexicon, stems, any_first=True)
    rng = np.random.default_rng(5)
    tried = {"xidiot", "diot", "ediot", "orthless", "xworthlesx", "aworthles", "poulness", "oulnes", "xxfoulness", "xxxfoulness", "foul", "foulx", "ad", "xbad", "zoulest"} | set(lexicon)
    for w in list(lexicon):
        for _ in range(300):
            letters = list(w)
            for _ in range(rng.integers(1, 4)):
                at, how = rng.integers(0, len(letters) + 1) * rng.integers(0, 2), rng.integers(0, 3)
                if how == 0:
                    letters.insert(at, rng.choice(list("aeidotz")))
                elif at < len(letters):
                    letters[at : at + 1] = [] if how == 1 else [rng.choice(list("aeidotz"))]
            tried.add("".join(letters))
    tried = sorted(t for t in tried if t)
    folded = np.array([ord(c) if c != " " else 0 for c in " ".join(tried)], np.uint16)
    ends = np.cumsum([len(t) + 1 for t in tried]) - 1
    got = automaton.run(folded, ends - [len(t) for t in tried], ends)
    for word, kind, weight in zip(tried, automaton.kind[got], automaton.weight[got], strict=True):
        fits = [(e, -lexicon[w]) for w in lexicon if (e := levenshtein(word, w)) <= (0 if len(w) < 4 else 1 if len(w) < 8 else 2)]
        expected = min(fits) if fits else (3, -5.0) if word.startswith("foul") else (-1, 0.0)
        assert (kind, -weight) == expected, word


def test_words_below_a_stem_stay(spark):
    rows = [("", 9_000, 1_000), ("foul*", 0, 400)] + [(f"foul{e}", 0, 60) for e in ("ness", "er", "est", "ing")]
    words, stems, _ = toxicity.learn_lexicon(spark.createDataFrame(rows, "term string, n0 long, n1 long"))
    assert set(stems) == {"foul"} and set(words) == {"foulness", "fouler", "foulest", "fouling"}


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs.withColumn("score", F.lit("clash")), toxicity.fit(docs, labels))
    rows = got.join(labels, "doc_id").select(toxicity.held_out(F.col("doc_id")).alias("out"), "score", "toxic", "lang").collect()
    held = [(r.score >= 0.5, r.toxic) for r in rows if r.out]
    assert sum(p == y for p, y in held) >= 0.93 * len(held)
    assert not any(p and not y for p, y in held)


def test_lexicon_is_whole(spark):
    """Every significant term is in, however much stronger another is, and from all labels, however small the sample."""
    rows = [("", 9_000, 1_000), ("strongest", 0, 900)] + [(f"rare{a}{b}", 0, 40) for a in "abcdefghijklmnopqr" for b in "abcdefghijklmnopqr"]
    words, stems, _ = toxicity.learn_lexicon(spark.createDataFrame(rows, "term string, n0 long, n1 long"))
    assert set(words) == {r[0] for r in rows[1:]} and not stems
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    automaton = toxicity.fit(docs, labels, sample=40).automaton
    folded = np.array([ord(c) for c in "idiotmoron"], np.uint16)
    assert automaton is not None and list(automaton.kind[automaton.run(folded, np.array([0, 5]), np.array([5, 10]))]) == [0, 0]


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (2, "x" * 50_000), (2, "you idiot"), (3, "fine")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    one_kind = spark.createDataFrame([(i, 1) for i in range(30)] + [(None, 0), (4, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, one_kind)).collect()} <= {0.0, 1.0}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def test_quotation():
    def quoted(text, word="idiot"):
        data = np.frombuffer(text.encode(), np.uint8)
        points, begins = toxicity.code_points(data, np.array([0, len(data)]))
        at = text.index(word)
        return toxicity.quotation(points, points, at, at + len(word), 0, len(text))

    assert quoted('she said "idiot" to him') and quoted("the word “idiot” is old") and not quoted("you idiot!") and not quoted("an idiot walks")


# ---- language model -----------------------------------------------------------------


def test_language_model(spark):
    """Words that follow from their neighbours get a better score than their frequency alone gives."""
    rng = np.random.default_rng(4)
    nouns = [f"noun{i}" for i in range(12)]
    texts = []
    for _ in range(400):
        text = []
        for _ in range(40):
            i = rng.integers(0, 12)
            text += [nouns[i], f"verb{i}"]
        texts.append(" ".join(text))
    rows = list(enumerate(texts)) + [(1000, None), (1001, ""), (1002, texts[0]), (1003, " ".join(rng.permutation(texts[0].split())))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("log_prob", F.lit("x")).repartition(2)
    model = lm_score.fit(docs, rounds=6)
    got = {r.doc_id: r for r in lm_score.score(docs, model).collect()}
    assert (got[1000].n_tokens, got[1000].log_prob, got[1000].mean_log_prob) == (0, 0.0, None)
    assert abs(got[1002].log_prob - got[0].log_prob) < 1e-3 and got[0].n_tokens == 80
    assert got[0].mean_log_prob > -np.log(24) + 0.3 and got[1003].mean_log_prob < got[0].mean_log_prob - 0.3
    assert lm_score.score(docs.limit(0), lm_score.fit(docs.limit(0))).count() == 0


def test_language_model_gradient():
    """The training step's gradient is that of the log-probabilities."""
    p = {k: v.astype(np.float64) for k, v in lm_score.new_parameters(np.ones(lm_score.IDS)).items()}
    rng = np.random.default_rng(1)
    near, target = rng.integers(0, lm_score.IDS, (8, 4)), rng.integers(0, lm_score.IDS, 8)
    trainer = lm_score.Trainer(p)
    moved = {}
    trainer._move = lambda name, at, gradient: moved.setdefault(name, []).append((at, gradient))
    trainer.step(near, target)
    (at, gradient), = moved["top"]
    for i, j in ((0, 0), (5, 7), (16, 31)):
        q = {k: v.copy() for k, v in p.items()}
        q["top"][i, j] += 1e-5
        slope = -(lm_score.log_probabilities(q, near, target).mean() - lm_score.log_probabilities(p, near, target).mean()) / 1e-5
        assert abs(slope - gradient[i, j]) < 1e-3


def test_language_model_moves_whole_arrays():
    """A step takes one gradient of all classes and one of all neighbours, each that of the log-probabilities."""
    p = {k: v.astype(np.float64) for k, v in lm_score.new_parameters(np.ones(lm_score.IDS)).items()}
    rng = np.random.default_rng(2)
    near, target = rng.integers(0, 6, (40, 4)), rng.integers(0, 100, 40)
    trainer = lm_score.Trainer(p)
    moved = {}
    trainer._move = lambda name, at, gradient: moved.setdefault(name, []).append((at, gradient))
    trainer.step(near, target)
    assert {k: len(v) for k, v in moved.items()} == dict.fromkeys(lm_score.SHAPES, 1)
    for name, (((at, gradient),), shape) in ((k, (moved[k], lm_score.SHAPES[k])) for k in moved):
        whole = np.zeros(shape)
        whole[at] = gradient
        for place in [*zip(*np.nonzero(whole))][:: max(1, np.count_nonzero(whole) // 9)]:
            q = {k: v.copy() for k, v in p.items()}
            q[name][place] += 1e-5
            slope = -(lm_score.log_probabilities(q, near, target).mean() - lm_score.log_probabilities(p, near, target).mean()) / 1e-5
            assert abs(slope - whole[place]) < 1e-5


def test_every_word_is_predicted_once():
    hashes = np.random.default_rng(0).integers(0, 50, 1000).astype(np.uint64)
    for rounds in (1, 2, 6):
        assert (sum(lm_score.masked(hashes, turn, rounds).astype(int) for turn in range(rounds)) == 1).all()


def test_short_texts_are_trained_on(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    vocabulary = lm_score.build_vocabulary(docs)
    before = lm_score.new_parameters(vocabulary.frequency)
    assert any((lm_score.train_round(docs, vocabulary, before, 0, 1)[k] != before[k]).any() for k in before)


# ---- digests ------------------------------------------------------------------------


def test_pii_query_digest(spark):
    got = {r.doc_id: r for r in QUERIES["op1_pii"](spark, DATA).collect()}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        expected = base_spans(r.text)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert got[r.doc_id].spans.startswith(",".join(expected))


def test_pii_query_counts(spark, tmp_path):
    spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in QUERIES["op1_pii"](spark, str(tmp_path)).collect():
        kinds = [span.split(":")[0] for span in base_spans(PII_TEXTS[r.doc_id])]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(kind) for kind in PATTERNS]


@pytest.mark.parametrize("name", ["op1_pii", "op3_mix", "op7_chat"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
