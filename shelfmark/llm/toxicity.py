"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

1. Words and word beginnings that stand far more often in toxic than in other labelled
   texts become the lexicon: whole words, and stems where no single word explains them.
2. The lexicon's trie is intersected with Levenshtein automata (no error up to 3 letters,
   one up to 7, two beyond, at any letter; stems are matched exactly, and the words below
   them are kept with their errors) into
   one deterministic table, which all words of a block run through side by side; it is made
   as far as words reach it.
3. A hit's context window tells quotation from abuse: quotation marks around it and words
   of speech before it against words of address near it.
4. A logistic model of the weighted hits by kind and context gives the score.

The lexicon is learned from all labelled rows; the few numbers of the model are fitted on about
``SAMPLE`` of them, chosen by a hash; every text is scored whole. Words are runs of letters and digits; digits that
look like letters count as those.

Defined cases: a null text is empty; an empty text has the score of a text without hits;
labels that are null, or of a null doc_id, are not used; several labels of one document
count by their mean; without labels of both kinds every score is the share of toxic
labels (0 without any); every input row gives one row; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import row_blocks, text_bytes
from shelfmark.session import written

#: Labelled rows that the logistic model is fitted on, about at most; the lexicon is learned from all.
SAMPLE = 20_000
#: Labels up to this number are sent to all tasks; beyond, Spark chooses the join.
BROADCAST_LABELS = 1_000_000
#: A term needs so many toxic texts, such a likelihood ratio (G) against the share of toxic texts, and such odds.
SUPPORT, SURE, ODDS = 5, 28.0, 4.0
STEMS = (4, 5, 6, 7)
WINDOW = 48
BLOCK = 1 << 20
#: Terms counted before they are passed on.
COUNTED = 1 << 18
#: Words run side by side, nodes stepped at once, and nodes held in states before the table is begun anew.
AT_ONCE, STEP, HELD = 1 << 14, 1 << 18, 1 << 22
#: Fixed words. Speech before a hit and quotation marks around it speak for quotation, address for abuse.
SPEECH = frozenset("said says wrote called calls quote quoted word term dit dijo dice sagte schrieb nannte palabra mot wort".split())
ADDRESS = frozenset("you your youre u du dich dein ihr tu toi te vous usted ustedes vosotros".split())
QUOTES = frozenset("\"“”„«»‹›")
LOOKS = str.maketrans("013457", "oieast")

#: Features: weighted hits by (kind, context), their spread and density.
KINDS = ("exact", "one", "two", "stem")
FEATURES = 2 * len(KINDS) + 2


def _tables() -> tuple[np.ndarray, list[str]]:
    """For each code point of the first plane: its folded letter, 0 if it is in no word."""
    letters = np.zeros(1 << 16, np.uint16)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalnum():
            low = ch.lower()[0].translate(LOOKS)
            letters[c] = ord(low) if ord(low) < 1 << 16 else c
    return letters


_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _tables()
    return _LETTERS


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a block, and where its rows begin among them."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, heads[offsets]


def word_spans(points: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded letters of all code points, and start and end of each word."""
    folded = letters()[np.minimum(points, 0xFFFF)]
    inside = folded != 0
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = begins[(begins > 0) & (begins < len(points))]
    before[edges], after[edges - 1] = False, False
    return folded, np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


class Automaton:
    """The lexicon's trie with errors: a table, state and letter to state, that grows as words ask for it.

    State 0 is the dead end. A state is the set of trie nodes that the letters so far may have
    reached, each with its fewest errors; only states that occur in a text are made, all that a
    step lacks at once, so a lexicon of any size needs no table of all its states. ``kind`` and
    ``weight`` tell what each outcome of ``run`` is: -1 nothing, else the place in ``KINDS``.
    With ``any_first`` errors may concern the first letter too.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float], any_first: bool = False):
        self.top = -1 if any_first else 0  # nodes beyond it may be left with an error
        self.alphabet = np.unique([ord(c) for w in [*words, *stems] for c in w]).astype(np.uint16)
        terms = sorted(words)
        allowed = np.array([0 if len(w) < 4 else 1 if len(w) < 8 else 2 for w in terms], np.int8)
        self.first, self.count, self.child, self.limit, self.ends = self._trie(terms, allowed)
        self.allowed = allowed
        weights = np.array([words[w] for w in terms])
        self.rank = np.argsort(np.argsort(-weights, kind="stable"))
        self.stem_child, self.stem_at = self._trie(sorted(stems), np.zeros(len(stems), np.int8))[2::2]
        # outcomes: nothing, each word with no, one or two errors, each stem
        self.kind = np.concatenate([[-1], np.tile([0, 1, 2], len(terms)), np.full(len(stems), KINDS.index("stem"))]).astype(np.int8)
        self.weight = np.concatenate([[0.0], np.repeat(weights, 3), [stems[w] for w in sorted(stems)]])
        self.clear()

    def _trie(self, terms: list[str], allowed: np.ndarray) -> tuple[np.ndarray, ...]:
        """First child, number of children, child by letter (0: none), most errors below and term of each node.

        Nodes are numbered by depth, so that the children of a node lie side by side.
        """
        letters_of = [np.searchsorted(self.alphabet, [ord(c) for c in w]) for w in terms]
        first, count, child, limit, ends = [0], [0], [[0] * (len(self.alphabet) + 1)], [int(max(allowed, default=0))], [-1]
        level = [(0, list(range(len(terms))))]
        depth = 0
        while level:
            deeper = []
            for node, inside in level:
                below: dict[int, list[int]] = defaultdict(list)
                for k in inside:
                    if len(letters_of[k]) == depth:
                        ends[node] = k
                    else:
                        below[int(letters_of[k][depth])].append(k)
                first[node], count[node] = len(first), len(below)
                for c, ks in sorted(below.items()):
                    child[node][c] = len(first)
                    deeper.append((len(first), ks))
                    first.append(0)
                    count.append(0)
                    child.append([0] * (len(self.alphabet) + 1))
                    limit.append(int(allowed[ks].max()))
                    ends.append(-1)
            level = deeper
            depth += 1
        return np.array(first), np.array(count), np.array(child, np.int32), np.array(limit), np.array(ends)

    def clear(self) -> None:
        """Only the dead end and the start."""
        moves = [(np.zeros(1, np.int64),) * 3]
        while len(moves[-1][0]):
            moves.append(self._below(*moves[-1]))
        _, node, errors = (np.concatenate(x) for x in zip(*moves, strict=True))
        self.sets = [np.empty(0, np.int64), np.sort(4 * node + errors)]  # 4 * node + errors
        self.names = {s.tobytes(): k for k, s in enumerate(self.sets)}
        self.held = len(self.sets)
        self.table = np.full((1024, len(self.alphabet) + 1), -1, np.int32)
        self.table[0] = 0
        self.outcome = np.zeros(1024, np.int64)

    def _below(self, owner: np.ndarray, node: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, ...]:
        """All children of the nodes that may have one error more."""
        may = (errors < self.limit[node]) & (node > self.top)
        owner, node, errors = owner[may], node[may], errors[may]
        n = self.count[node]
        to = np.arange(n.sum()) + np.repeat(self.first[node] - np.cumsum(n) + n, n)
        owner, errors = np.repeat(owner, n), np.repeat(errors, n) + 1
        may = errors <= self.limit[to]
        return owner[may], to[may], errors[may]

    def _step(self, states: np.ndarray, letter: np.ndarray) -> None:
        """Fill in the table for pairs of state and letter."""
        size = np.array([len(self.sets[s]) for s in states])
        owner, packed = np.repeat(np.arange(len(states)), size), np.concatenate([self.sets[s] for s in states])
        node, errors = packed >> 2, packed & 3
        to = self.child[node, letter[owner]]
        same, more = to > 0, (errors < self.limit[node]) & (node > self.top)
        moves = [(owner[same], to[same], errors[same]), (owner[more], node[more], errors[more] + 1), self._below(owner, node, errors)]
        reach = tuple(np.concatenate(x) for x in zip(*moves, strict=True))
        fits = reach[2] <= self.limit[reach[1]]
        moves = [tuple(x[fits] for x in reach)]
        while len(moves[-1][0]):  # letters of the lexicon left out
            moves.append(self._below(*moves[-1]))
        owner, node, errors = (np.concatenate(x) for x in zip(*moves, strict=True))
        key = np.unique(owner * (4 * len(self.ends)) + 4 * node + errors)
        new = np.append(True, key[1:] >> 2 != key[:-1] >> 2)[: len(key)]  # the fewest errors of each node
        owner, packed = np.divmod(key[new], 4 * len(self.ends))
        cuts = np.searchsorted(owner, np.arange(len(states) + 1))
        made = []
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            name = packed[a:b].tobytes()
            at = self.names.get(name)
            if at is None:
                at = self.names[name] = len(self.sets)
                self.sets.append(packed[a:b].copy())
                self.held += b - a
                made.append((at, k))
            if len(self.sets) > len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.outcome = np.concatenate([self.outcome, np.zeros_like(self.outcome)])
            self.table[states[k], letter[k]] = at
        word = self.ends[packed >> 2]
        hit = np.flatnonzero(word >= 0)
        hit = hit[(packed[hit] & 3) <= self.allowed[word[hit]]]
        hit = hit[np.lexsort([self.rank[word[hit]], packed[hit] & 3, owner[hit]])]
        best = hit[np.append(True, owner[hit][1:] != owner[hit][:-1])[: len(hit)]]
        found = np.zeros(len(states), np.int64)
        found[owner[best]] = 1 + 3 * word[best] + (packed[best] & 3)
        for at, k in made:
            self.outcome[at] = found[k]

    def run(self, folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The outcome of each word."""
        parts = [np.empty(0, np.int64)]
        for first in range(0, len(start), AT_ONCE):
            if self.held > HELD or len(self.sets) > HELD >> 5:
                self.clear()
            parts.append(self._run(folded, start[first : first + AT_ONCE], end[first : first + AT_ONCE]))
        return np.concatenate(parts)

    def _run(self, folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        to = np.full(1 << 16, len(self.alphabet), np.int32)  # the last letter: any other
        to[self.alphabet] = np.arange(len(self.alphabet))
        state, node = np.ones(len(start), np.int32), np.zeros(len(start), np.int32)
        stem = np.zeros(len(start), np.int64)  # the heaviest one so far
        going = np.arange(len(start))
        step = 0
        while len(going):
            letter = to[folded[start[going] + step]]
            next_ = self.table[state[going], letter]
            lacks = np.unique(state[going][next_ < 0].astype(np.int64) * len(self.table[0]) + letter[next_ < 0])
            if len(lacks):
                pairs = np.divmod(lacks, len(self.table[0]))
                size = np.cumsum([len(self.sets[s]) for s in pairs[0]])
                for some in np.split(np.arange(len(lacks)), np.searchsorted(size, np.arange(STEP, size[-1], STEP))):
                    if len(some):
                        self._step(pairs[0][some], pairs[1][some])
                next_ = self.table[state[going], letter]
            state[going] = next_
            alive = (node[going] > 0) | (step == 0)
            node[going] = np.where(alive, self.stem_child[node[going], letter], 0)
            at = going[self.stem_at[node[going]] >= 0]
            its = 1 + 3 * len(self.allowed) + self.stem_at[node[at]]
            stem[at] = np.where(self.weight[its] > self.weight[stem[at]], its, stem[at])
            step += 1
            going = going[((state[going] != 0) | (node[going] != 0)) & (start[going] + step < end[going])]
        found = self.outcome[state]
        return np.where(found > 0, found, stem)


def quotation(points: np.ndarray, folded: np.ndarray, start: int, end: int, first: int, last: int) -> bool:
    """Whether the window around a hit speaks for quotation rather than abuse."""
    before = points[max(first, start - WINDOW) : start].tobytes().decode("utf-32-le").rpartition("\n")[2]
    after = points[end : min(last, end + WINDOW)].tobytes().decode("utf-32-le").partition("\n")[0]
    marks = not QUOTES.isdisjoint(before) and not QUOTES.isdisjoint(after)
    said = set(before.lower().split()[-6:])
    near = said | set(after.lower().split()[:6])
    plain = lambda words: {w.strip(".,;:!?\"'") for w in words}
    return marks + bool(plain(said) & SPEECH) - bool(plain(near) & ADDRESS) > 0


def features(automaton: Automaton, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text of a block."""
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES))
    if not len(data):
        return out
    points, begins = code_points(data, offsets)
    folded, start, end = word_spans(points, begins)
    state = automaton.run(folded, start, end)
    hit = np.flatnonzero(automaton.kind[state] >= 0)
    row = np.searchsorted(begins, start[hit], "right") - 1
    for h, r in zip(hit, row, strict=True):
        quoted = quotation(points, folded, start[h], end[h], begins[r], begins[r + 1])
        out[r, 2 * automaton.kind[state[h]] + quoted] += automaton.weight[state[h]]
    words = np.bincount(np.searchsorted(begins, start, "right") - 1, minlength=n)
    direct = out[:, 0 : 2 * len(KINDS) : 2].sum(1)
    out[:, -2] = np.bincount(row, minlength=n) > 1
    out[:, -1] = 100 * direct / np.maximum(words, 20)
    return np.log1p(out)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and label of the labelled rows that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("label"))
    known = written(known, "toxicity-labels")
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "text", "label")


def sampled(rows: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` of the rows at most."""
    share = min(1.0, sample / max(rows.count(), 1))
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def term_counts(rows: DataFrame) -> DataFrame:
    """term (a word, or its beginning with a star), and how many texts of each label have it; partial sums."""

    def table(counts):
        terms = list(counts[0].keys() | counts[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([counts[0][t] for t in terms], pa.int64()), pa.array([counts[1][t] for t in terms], pa.int64())], ["term", "n0", "n1"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                points, begins = code_points(data, np.array([0, len(data)]))
                folded, start, end = word_spans(points, begins)
                line = folded.astype(np.uint16).tobytes().decode("utf-16-le", "replace")
                words = {line[a:b] for a, b in zip(start, end, strict=True) if 3 <= b - a <= 40}
                counts[label].update(words)
                counts[label].update({w[:k] + "*" for w in words for k in STEMS if len(w) > k})
                counts[label][""] += 1  # the number of texts
                if len(counts[0]) + len(counts[1]) > COUNTED:
                    yield table(counts)
                    counts = (Counter(), Counter())
        yield table(counts)

    return rows.mapInArrow(run, "term string, n0 bigint, n1 bigint").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def learn_lexicon(counts: DataFrame) -> tuple[dict[str, float], dict[str, float], float]:
    """Words and stems with their weights (log odds), and the share of toxic texts."""
    total = counts.where("term = ''").first()
    if total is None:
        return {}, {}, 0.0
    all0, all1 = total["n0"], total["n1"]
    share = all1 / (all0 + all1)
    if not all0 or not all1:
        return {}, {}, share
    odds = F.log((F.col("n1") + 0.5) / (all1 + 1)) - F.log((F.col("n0") + 0.5) / (all0 + 1))
    texts = F.col("n0") + F.col("n1")
    part = lambda n, rate: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (texts * rate))).otherwise(0.0)
    sure = 2 * (part("n0", 1 - share) + part("n1", share))
    strong = (
        counts.where((F.col("term") != "") & (F.col("n1") >= SUPPORT))
        .select("term", "n1", odds.alias("odds"), sure.alias("sure"))
        .where((F.col("sure") >= SURE) & (F.col("odds") >= log(ODDS)))
        .collect()
    )
    strong.sort(key=lambda r: (-r["sure"], r["term"]))
    words, stems, below, begun = {}, {}, {}, set()
    for r in strong:  # the most frequent word under each beginning
        for k in STEMS:
            if not r["term"].endswith("*") and len(r["term"]) > k:
                below[r["term"][:k]] = max(below.get(r["term"][:k], 0), r["n1"])
    for r in strong:  # the strongest first
        term, stem = r["term"].rstrip("*"), r["term"].endswith("*")
        if not stem:
            words[term] = r["odds"]
        elif below.get(term, 0) < 0.5 * r["n1"] and term not in begun and not any(term[:k] in stems for k in STEMS):
            stems[term] = r["odds"]  # no single word explains it
            begun.update(term[:k] for k in STEMS)
    return words, stems, share


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the constant) by Newton steps with a ridge penalty."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """Automaton, weights and the score of a text without hits."""

    def __init__(self, automaton: Automaton | None, weights: np.ndarray | None, share: float):
        self.automaton, self.weights, self.share = automaton, weights, share

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.automaton is None:
            return np.full(len(offsets) - 1, self.share)
        z = features(self.automaton, data, offsets) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and model from labelled rows of ``docs`` (doc_id, text) that are not held out."""
    rows = written(training_rows(docs, labels), "toxicity-labelled")
    # copies of one text would make chance words look sure, so each text counts once
    words, stems, share = learn_lexicon(written(term_counts(rows.select("text", "label").dropDuplicates()), "toxicity-terms"))
    if not words and not stems:
        return Model(None, None, share)
    automaton = Automaton(words, stems, any_first=True)
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in row_blocks(offsets, BLOCK):
                at = offsets[first : last + 1] - offsets[first]
                x = features(shared.value, data[offsets[first] : offsets[last]], at)
                yield pa.RecordBatch.from_arrays([pa.array(list(x)), batch.column("label")[first:last]], ["x", "y"])

    got = sampled(rows, sample).mapInArrow(run, "x array<double>, y int").collect()  # at most about SAMPLE rows of a few numbers
    x, y = np.array([r["x"] for r in got]), np.array([r["y"] for r in got], float)
    return Model(automaton, fit_logistic(x, y), share)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; no column but text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != column]

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = [np.empty(0)]
            for first, last in row_blocks(offsets, BLOCK):
                at = offsets[first : last + 1] - offsets[first]
                parts.append(shared.value.scores(data[offsets[first] : offsets[last]], at))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(np.concatenate(parts))], [*kept, column])

    schema = docs.select(kept).schema.add(column, "double")
    return docs.select(kept).mapInArrow(run, schema)
