"""Near-duplicate documents by ProbMinHash.

Words are runs of digits, letters (A-Z as a-z) and characters beyond ASCII; a shingle is
five words in a row (all words of a shorter text), its weight how often it occurs. Each
shingle is a Poisson process whose rate is its weight; every arrival falls on a random
register, and a register keeps the shingle that arrives first. A shingle stops as soon as
its next arrival comes later than every register of the document was reached. Two
documents agree in a register with the probability Jaccard of their weighted shingles.
Bands of registers give candidates; the similarity that decides is computed exactly.

Defined cases: a text without words (null, empty) is similar to nothing and is a class of
its own; texts with the same words are one class; every input row gives one row; a class
is named by its smallest doc_id (null only if none of its rows has one); an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import groups
from shelfmark.llm.blocks import U64, ascii_word_fold, mix64, row_blocks, text_bytes, words
from shelfmark.session import written

WORDS = 5
LEAST = 0.8
ROWS, BANDS = 4, 20
REGISTERS = ROWS * BANDS
#: Equal registers below which a pair is let go: 0.8 of 80, less four standard deviations.
FLOOR = 49
BLOCK = 4 << 20


def shingles(hashes: np.ndarray, row: np.ndarray, n: int, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and weight of the distinct shingles of n rows, by row and hash."""
    count = np.bincount(row, minlength=n)
    if not len(hashes):
        return np.empty(0, np.int64), np.empty(0, U64), np.empty(0)
    begin = np.cumsum(count) - count
    place = np.arange(len(hashes)) - begin[row]
    left = count[row] - place  # words from here to the end of the row
    first = (left >= size) | ((place == 0) & (left < size))
    at = np.flatnonzero(first)
    mixed = np.zeros(len(at), U64)
    for k in range(size):
        there = left[at] > k
        term = hashes[np.minimum(at + k, len(hashes) - 1)]
        mixed = np.where(there, mix64(mixed * U64(0x9E3779B97F4A7C15) + term + U64(k + 1)), mixed)
    owner = row[at]
    order = np.lexsort((mixed, owner))
    owner, mixed = owner[order], mixed[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (mixed[1:] != mixed[:-1]))
    start = np.flatnonzero(new)
    return owner[start], mixed[start], np.diff(np.append(start, len(owner))).astype(float)


def prob_minhash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """Signatures (n, registers) of the weighted elements; a row without elements gets all ones.

    Registers hold arrival time (as float bits, which keep their order) and element in one
    number, so the earliest arrival is a minimum.
    """
    state = np.full(n * registers, ~U64(0), U64)
    time = np.zeros(len(row))
    turn = 0
    while len(row):
        turn += 1
        draw = mix64(element + U64(turn * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log1p(-(draw >> U64(11)).astype(float) / float(1 << 53)) / weight
        where = (mix64(draw) >> U64(33)).astype(np.int64) % registers
        bits = time.astype(np.float32).view(np.uint32).astype(U64)
        np.minimum.at(state, row * registers + where, (bits << U64(32)) | (element >> U64(32)))
        latest = state.reshape(n, registers).max(1) >> U64(32)
        going = bits <= latest[row]
        row, element, weight, time = row[going], element[going], weight[going], time[going]
    return (state & U64(0xFFFFFFFF)).astype(np.uint32).reshape(n, registers)


def content_ids(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the word sequence of each row, and the number of words."""
    count = np.bincount(row, minlength=n)
    out = np.zeros(n, U64)
    if len(hashes):
        begin = np.cumsum(count) - count
        place = (np.arange(len(hashes)) - begin[row]).astype(U64)
        full = count > 0
        out[full] = np.add.reduceat(mix64(hashes + place * U64(0xA0761D6478BD642F)), begin[full])
    return mix64(out + count.astype(U64)).view(np.int64), count


def _blocks(batches: Iterator[pa.RecordBatch]):
    fold = ascii_word_fold()
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for first, last in row_blocks(offsets, BLOCK):
            at = offsets[first : last + 1] - offsets[first]
            part = data[offsets[first] : offsets[last]]
            hashes, row, _, _ = words(part, at, fold)
            ids, count = content_ids(hashes, row, last - first)
            yield batch.slice(first, last - first), part, at, hashes, row, ids, count


def document_ids(docs: DataFrame) -> DataFrame:
    """doc_id, id (hash of the words) and n_words of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch, _, _, _, _, ids, count in _blocks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids), pa.array(count.astype(np.int64))], ["doc_id", "id", "n_words"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, id bigint, n_words bigint")


def _select(hashes, row, keep):
    """The words of some rows, with new row numbers."""
    new = np.cumsum(keep) - 1
    take = keep[row]
    return hashes[take], new[row[take]]


def band_rows(docs: DataFrame) -> DataFrame:
    """(bucket, id) of the distinct texts; equal texts of a block are taken once."""

    def run(batches):
        for _, _, _, hashes, row, ids, count in _blocks(batches):
            keep = np.zeros(len(ids), bool)
            keep[np.unique(ids, return_index=True)[1]] = True
            keep &= count > 0
            some, owner = _select(hashes, row, keep)
            n = int(keep.sum())
            keys = groups.band_keys(prob_minhash(*shingles(some, owner, n), n), ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(ids[keep], keys.shape[1]))], ["bucket", "id"])

    return docs.select("text").mapInArrow(run, "bucket bigint, id bigint")


def bodies(docs: DataFrame, ids: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """id, signature and packed text of each candidate, once."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for _, part, at, hashes, row, own, count in _blocks(batches):
            keep = np.zeros(len(own), bool)
            keep[np.unique(own, return_index=True)[1]] = True
            keep &= count > 0
            if shared.value is not None:
                found = np.searchsorted(shared.value, own)
                keep &= np.append(shared.value, 0)[found] == own
                keep &= found < len(shared.value)
            some, owner = _select(hashes, row, keep)
            n = int(keep.sum())
            sigs = prob_minhash(*shingles(some, owner, n), n)
            packed = [pack.compress(part[at[i] : at[i + 1]].tobytes()) for i in np.flatnonzero(keep)]
            yield pa.RecordBatch.from_arrays([pa.array(own[keep]), pa.array([s.tobytes() for s in sigs], pa.binary()), pa.array(packed, pa.binary())], ["id", "sig", "body"])

    rows = docs.select("text").mapInArrow(run, "id bigint, sig binary, body binary")
    return (rows if wanted is not None else rows.join(ids, "id", "left_semi")).dropDuplicates(["id"])


def prepare(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    hashes, row, _, _ = words(data, np.array([0, len(data)]), ascii_word_fold())
    _, element, weight = shingles(hashes, row, 1)
    return element, weight


def probability_jaccard(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact chance that two weighted sets agree in a register.

    The sum over shared elements d of 1 / sum over all e of max(u(e)/u(d), v(e)/v(d)). Which
    of the two is larger depends on how u(e)/v(e) compares with u(d)/v(d), so elements are
    sorted by that ratio and the inner sums come from running sums.
    """
    every, at = np.unique(np.concatenate([one[0], two[0]]), return_inverse=True)
    u, v = np.zeros(len(every)), np.zeros(len(every))
    u[at[: len(one[0])]], v[at[len(one[0]) :]] = one[1], two[1]
    both = (u > 0) & (v > 0)
    if not both.any():
        return 0.0
    if (u <= 1).all() and (v <= 1).all():
        return float(both.sum() / len(every))
    ratio = np.where(v > 0, u / np.where(v > 0, v, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    ratio, u, v, both = ratio[order], u[order], v[order], both[order]
    below, above = np.cumsum(v), np.cumsum(u[::-1])[::-1]
    first = np.searchsorted(ratio, ratio[both], "left")  # from here on u(e)/u(d) is the larger
    inner = above[first] / u[both] + np.where(first > 0, below[first - 1], 0) / v[both]
    return float((1 / inner).sum())


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, class (a 64-bit name) and class_id (smallest doc_id) of every row of ``docs``."""
    own = written(document_ids(docs), "near-ids")
    buckets = written(groups.shared_buckets(band_rows(docs)), "near-buckets")
    ids, wanted = groups.wanted_ids(buckets)
    body = written(bodies(docs, ids, wanted), "near-bodies")
    likely = groups.likely_groups(buckets, body.select("id", "sig"), FLOOR)
    links = groups.exact_links(written(likely, "near-likely"), body, prepare, probability_jaccard, LEAST, FLOOR)
    final = groups.components(links)
    named = own.join(final, "id", "left").withColumn("class", F.coalesce("group", "id"))
    named = written(named.select("doc_id", "n_words", "class"), "near-classes")
    # written, so that the join below can split a class of very many copies
    smallest = named.where("n_words > 0").groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    smallest = written(smallest, "near-smallest")
    with_words = named.where("n_words > 0").join(smallest, "class")
    alone = named.where("n_words = 0").withColumn("class_id", F.col("doc_id")).withColumn("class_size", F.lit(1).cast("long"))
    return with_words.select("doc_id", "n_words", "class", "class_id", "class_size").unionByName(alone.select("doc_id", "n_words", "class", "class_id", "class_size"))
