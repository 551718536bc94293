"""Masked pseudo-likelihood of documents by a bidirectional window network.

Every word is predicted from the two words on its left and the two on its right; the sum of
the conditional log-probabilities scores a document.

1. All words of all documents are counted. The most frequent get an id each, the others
   share ids by their hash; a shared id's probability is split evenly among its words.
2. The network (a place-wise embedding of each neighbour, tanh, and a softmax in two steps:
   class, then word in class) is trained in numpy. In each round every document takes part:
   a part of its words, another one each round, is masked and predicted, until after the
   last round every word of every document has been predicted once. Each task trains
   on its own rows; parameters are averaged by the words that they have seen, in slices, in
   tasks, so only one model reaches the driver however many tasks there are.
3. Every document is scored whole.

Words are runs of digits, letters (A-Z as a-z) and characters beyond ASCII. Defined cases:
a text without words (null, empty) has 0 tokens, the sum 0 and no mean; beyond the ends of
a text stands a border sign; equal texts get equal scores but for rounding; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import U64, ascii_word_fold, mix64, row_blocks, text_bytes, words
from shelfmark.session import written

CLASSES, IN_CLASS, HIDDEN, REACH = 32, 32, 16, 2
IDS = CLASSES * IN_CLASS
OWN = 24 * IN_CLASS  # ids of single words; the rest is shared
BORDER = IDS
#: Every word is predicted in one of the training rounds.
ROUNDS, RATE, BATCH = 2, 0.2, 2048
BLOCK = 1 << 20
SLICES = 16


class Vocabulary:
    def __init__(self, single: np.ndarray, shared_words: np.ndarray, frequency: np.ndarray):
        """``single``: word hashes, the most frequent first; ``shared_words``: number of words of each shared id;
        ``frequency``: how often each id occurs."""
        self.frequency = frequency
        self.sorted = np.sort(single)
        self.id_of = np.argsort(single, kind="stable").astype(np.int32)
        self.cost = np.zeros(IDS)
        self.cost[OWN:] = -np.log(np.maximum(shared_words, 1))

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        out = (OWN + (hashes % U64(IDS - OWN)).astype(np.int32)).astype(np.int32)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
            known = self.sorted[at] == hashes
            out[known] = self.id_of[at[known]]
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """word (hash) and n over all documents; counted by block before anything moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = ascii_word_fold()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in row_blocks(offsets, 16 * BLOCK):
                hashes, *_ = words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], fold)
                word, n = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_vocabulary(docs: DataFrame) -> Vocabulary:
    counts = written(count_words(docs), "lm-words")
    most = written(counts.orderBy(F.desc("n"), "word").limit(OWN), "lm-frequent")  # OWN rows
    rows = sorted(most.collect(), key=lambda r: (-r["n"], r["word"]))
    single = np.array([r["word"] for r in rows], np.int64).view(U64)
    frequency = np.zeros(IDS)
    frequency[: len(rows)] = [r["n"] for r in rows]
    # the hash is unsigned; 2**64 is a multiple of the number of shared ids, so pmod agrees
    rest = counts.join(F.broadcast(most.select("word")), "word", "left_anti").groupBy(F.pmod("word", F.lit(IDS - OWN)).alias("id"))
    sizes = np.zeros(IDS - OWN, np.int64)
    for r in rest.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect():
        sizes[r["id"]], frequency[OWN + r["id"]] = r["words"], r["n"]
    return Vocabulary(single, sizes, frequency)


SHAPES = {"context": (2 * REACH, IDS + 1, HIDDEN), "bias": (HIDDEN,), "top": (HIDDEN + 1, CLASSES), "low": (CLASSES, HIDDEN + 1, IN_CLASS)}


def new_parameters(frequency: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random weights; the constants of both softmax steps give the frequencies of the ids."""
    rng = np.random.default_rng(seed)
    out = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
    often = np.log(frequency.reshape(CLASSES, IN_CLASS) + 0.5)
    out["top"][-1] = np.logaddexp.reduce(often, axis=1) - np.logaddexp.reduce(often, axis=None)
    out["low"][:, -1] = often - np.logaddexp.reduce(often, axis=1, keepdims=True)
    return out


def flat(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[k].ravel() for k in SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = values[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def padded(ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with border signs around each row, and where each word stands among them."""
    place = np.arange(len(ids)) + REACH * (row + 1)
    out = np.full(len(ids) + REACH * (int(row[-1]) + 2) if len(ids) else REACH, BORDER, np.int32)
    out[place] = ids
    return out, place


def neighbours(line: np.ndarray, place: np.ndarray) -> np.ndarray:
    """(words, 2 * REACH): the ids on the left, then on the right."""
    steps = np.array([*range(-REACH, 0), *range(1, REACH + 1)])
    return line[place[:, None] + steps[None]]


def hidden_layer(p: dict[str, np.ndarray], near: np.ndarray) -> np.ndarray:
    """tanh of the summed embeddings, with a row of ones: (HIDDEN + 1, words)."""
    total = p["bias"] + sum(p["context"][k][near[:, k]] for k in range(2 * REACH))
    out = np.ones((HIDDEN + 1, len(near)), total.dtype)
    np.tanh(total.T, out=out[:HIDDEN])
    return out


def log_softmax(z: np.ndarray) -> np.ndarray:
    """Of each column; the columns are as many as the words, so the sums run along them."""
    z = z - z.max(0)
    return z - np.log(np.exp(z).sum(0))


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(0))
    z /= z.sum(0)
    return z


def by_class(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The order of the targets by class, and where each class that occurs stands in it."""
    which = (target // IN_CLASS).astype(np.int8)
    order = np.argsort(which, kind="stable")
    cuts = np.searchsorted(which[order], np.arange(CLASSES + 1))
    return order, [(c, slice(cuts[c], cuts[c + 1])) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]


def low_scores(p: dict[str, np.ndarray], h: np.ndarray, classes: list[tuple[int, slice]]) -> np.ndarray:
    """The second softmax step's scores, of words in the order of their classes: (IN_CLASS, words)."""
    out = np.empty((IN_CLASS, h.shape[1]), h.dtype)
    for c, at in classes:
        out[:, at] = p["low"][c].T @ h[:, at]
    return out


def log_probabilities(p: dict[str, np.ndarray], near: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The log-probability of each target given its neighbours."""
    order, classes = by_class(target)
    h, which, place = hidden_layer(p, near[order]), target[order] // IN_CLASS, target[order] % IN_CLASS
    column, out = np.arange(len(target)), np.empty(len(target))
    out[order] = log_softmax(p["top"].T @ h)[which, column].astype(float) + log_softmax(low_scores(p, h, classes))[place, column]
    return out


class Trainer:
    """Adagrad on batches of masked words."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = {k: v.copy() for k, v in parameters.items()}
        self.seen = {k: np.full(v.shape, 1e-3, np.float32) for k, v in parameters.items()}
        self.words = 0

    def _move(self, name: str, at, gradient: np.ndarray) -> None:
        seen = self.seen[name][at] + gradient**2
        self.seen[name][at] = seen
        self.p[name][at] -= RATE * gradient / np.sqrt(seen)

    def step(self, near: np.ndarray, target: np.ndarray) -> None:
        n, p = len(target), self.p
        order, classes = by_class(target)
        near, target = near[order], target[order]
        h, column = hidden_layer(p, near), np.arange(n)
        z = softmax(p["top"].T @ h)
        z[target // IN_CLASS, column] -= 1
        back = p["top"][:HIDDEN] @ z
        z_low = softmax(low_scores(p, h, classes))
        z_low[target % IN_CLASS, column] -= 1
        low = np.zeros_like(p["low"])
        for c, at in classes:
            back[:, at] += p["low"][c, :HIDDEN] @ z_low[:, at]
            low[c] = h[:, at] @ z_low[:, at].T
        inner = np.ascontiguousarray((back * (1 - h[:HIDDEN] ** 2) / n).T)
        # all neighbours that are one id at one place, side by side
        at = (near + np.arange(2 * REACH) * (IDS + 1)).astype(np.int16).ravel()
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        context = np.add.reduceat(inner[order // (2 * REACH)], first)
        gradients = [("top", slice(None), h @ z.T / n), ("low", slice(None), low / n), ("bias", slice(None), inner.sum(0)), ("context", np.divmod(at[first], IDS + 1), context)]
        for name, at, gradient in gradients:
            self._move(name, at, gradient.astype(np.float32))
        self.words += n


def _token_blocks(batches, vocabulary: Vocabulary):
    fold = ascii_word_fold()
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for first, last in row_blocks(offsets, BLOCK):
            hashes, row, _, _ = words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], fold)
            yield batch.slice(first, last - first), vocabulary.ids(hashes), row, hashes


def masked(hashes: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Which words of a block are predicted in a round: the rounds share them out by hash and place, none is left out."""
    return mix64(hashes + mix64(np.arange(len(hashes), dtype=U64))) % U64(rounds) == U64(turn)


def train_round(docs: DataFrame, vocabulary: Vocabulary, parameters: dict[str, np.ndarray], turn: int, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The parameters after all tasks have trained on their rows, averaged by masked words; round ``turn`` of ``rounds``."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((vocabulary, parameters))
    cuts = np.linspace(0, len(flat(parameters)), SLICES + 1).astype(int)

    def train(batches):
        vocab, start = shared.value
        trainer = Trainer(start)
        for _, ids, row, hashes in _token_blocks(batches, vocab):
            line, place = padded(ids, row)
            at = place[masked(hashes, turn, rounds)]
            for part in np.array_split(at, -(-len(at) // BATCH)) if len(at) else ():
                trainer.step(neighbours(line, part), line[part])
        values = flat(trainer.p).astype(float) * trainer.words
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([float(trainer.words)] * SLICES), pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
            ["slice", "words", "sums"],
        )

    def average(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            for k, n, part in zip(*(batch.column(c).to_pylist() for c in ("slice", "words", "sums")), strict=True):
                held = totals.setdefault(k, [0.0, 0.0])
                held[0] += n
                held[1] = held[1] + np.frombuffer(part)
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array([t[0] for t in totals.values()]), pa.array([t[1].tobytes() for t in totals.values()], pa.binary())], ["slice", "words", "sums"]
            )

    schema = "slice int, words double, sums binary"
    sums = docs.select("text").mapInArrow(train, schema)
    slices = sorted(sums.repartition(SLICES, "slice").mapInArrow(average, schema).collect(), key=lambda r: r["slice"])
    if not slices or not slices[0]["words"]:
        return parameters
    return unflat(np.concatenate([np.frombuffer(r["sums"]) / r["words"] for r in slices]))


def fit(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Vocabulary, dict[str, np.ndarray]]:
    vocabulary = build_vocabulary(docs)
    parameters = new_parameters(vocabulary.frequency)
    for turn in range(rounds):
        parameters = train_round(docs, vocabulary, parameters, turn, rounds)
    return vocabulary, parameters


def score(docs: DataFrame, model: tuple[Vocabulary, dict[str, np.ndarray]]) -> DataFrame:
    """doc_id, n_tokens, log_prob (sum) and mean_log_prob of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        vocabulary, parameters = shared.value
        for batch, ids, row, _ in _token_blocks(batches, vocabulary):
            line, place = padded(ids, row)
            each = np.empty(len(ids))
            for first in range(0, len(ids), 1 << 15):
                part = place[first : first + (1 << 15)]
                each[first : first + len(part)] = log_probabilities(parameters, neighbours(line, part), line[part])
            each += vocabulary.cost[ids]
            total, count = np.bincount(row, each, batch.num_rows), np.bincount(row, minlength=batch.num_rows)
            mean = pa.array(total / np.maximum(count, 1), mask=count == 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count.astype(np.int64)), pa.array(total), mean], ["doc_id", "n_tokens", "log_prob", "mean_log_prob"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, log_prob double, mean_log_prob double")
