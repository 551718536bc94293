"""Benchmark decontamination by a distributed positional inverted index.

The index is split by documents: one row is a block of documents with the sorted terms of
its words, their posting lists and the positions, so a block answers any phrase alone and
nothing is shuffled. It is stored, then searched: for each window of test words the lists
of the block are intersected, shifted by their offsets, from the rarest term on.

Words are compared by 64-bit hashes. Test items are sent to all tasks in portions of at
most ``PORTION`` bytes of words, one pass over the index for each.

Defined cases: a null text, of a document or item, has no words; an empty benchmark hits
nothing; an item of fewer words than a window is one window; items with one id count once
and a null id is the text "null"; every document row gives one result row, repeated rows
and ids too; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import ascii_word_fold, list_of, ranges, row_blocks, text_bytes, words
from shelfmark.session import written

BLOCK = 2 << 20
PORTION = 32 << 20
#: Words between two documents of a block; no window and no proximity reaches across.
GAP = 64


def build_index(docs: DataFrame, key: str, terms: np.ndarray | None) -> DataFrame:
    """The index of ``docs`` (key, text): block, keys, n_words, terms, ends, positions.

    With ``terms`` (sorted hashes of all test words) only their postings are stored. The
    last three columns are arrays of uint64, uint32 and uint32 as bytes: the terms of the
    block, where each posting list ends, and the lists one after another.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    kind = docs.schema[key].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, wanted = ascii_word_fold(), shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in row_blocks(offsets, BLOCK):
                at = offsets[first : last + 1] - offsets[first]
                hashes, row, _, _ = words(data[offsets[first] : offsets[last]], at, fold)
                position = np.arange(len(hashes)) + row * GAP
                if wanted is not None:
                    found = np.searchsorted(wanted, hashes)
                    kept = np.append(wanted, np.uint64(0))[found] == hashes
                    kept &= found < len(wanted)
                    hashes, position = hashes[kept], position[kept]
                order = np.argsort(hashes, kind="stable")
                hashes, position = hashes[order], position[order]
                ends = np.append(np.flatnonzero(hashes[1:] != hashes[:-1]) + 1, len(hashes)) if len(hashes) else np.empty(0, int)
                count = np.bincount(row, minlength=last - first)
                keys = batch.column(key)[first:last]
                one = np.array([last - first])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uuid.uuid4().hex]),
                        list_of(keys, one),
                        list_of(pa.array(count.astype(np.int64)), one),
                        pa.array([hashes[ends - 1].tobytes()], pa.binary()),
                        pa.array([ends.astype(np.uint32).tobytes()], pa.binary()),
                        pa.array([position.astype(np.uint32).tobytes()], pa.binary()),
                    ],
                    ["block", "keys", "n_words", "terms", "ends", "positions"],
                )

    schema = f"block string, keys array<{kind}>, n_words array<bigint>, terms binary, ends binary, positions binary"
    return docs.select(key, "text").mapInArrow(index, schema)


def item_words(items: DataFrame) -> DataFrame:
    """The word hashes of each item as bytes; items without words are left out."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = ascii_word_fold()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            hashes, row, _, _ = words(data, offsets, fold)
            cuts = np.searchsorted(row, np.arange(len(offsets)))
            each = [hashes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(each, pa.binary())], ["item", "words"])

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return named.mapInArrow(hashed, "item string, words binary").where(F.length("words") > 0)


class Windows:
    """The distinct windows of some items: term hashes, length, and the items of each."""

    def __init__(self, rows: list, width: int):
        table, owner = [], []
        for k, row in enumerate(rows):
            w = np.frombuffer(row["words"], np.uint64)
            if len(w) >= width:
                part = np.lib.stride_tricks.sliding_window_view(w, width)
            else:
                part = np.concatenate([w, np.zeros(width - len(w), np.uint64)])[None]
            size = np.full((len(part), 1), min(len(w), width), np.uint64)
            table.append(np.hstack([part, size]))
            owner.append(np.full(len(part), k))
        self.items = [row["item"] for row in rows]
        every = np.concatenate(table) if table else np.zeros((0, width + 1), np.uint64)
        distinct, which = np.unique(every, axis=0, return_inverse=True)
        self.terms, self.size = distinct[:, :width].copy(), distinct[:, width].astype(np.int64)
        order = np.argsort(which.ravel(), kind="stable")
        self.owner = np.concatenate(owner)[order] if owner else np.empty(0, np.int64)
        self.owner_ends = np.cumsum(np.bincount(which.ravel(), minlength=len(distinct)))
        real = np.arange(width)[None] < self.size[:, None]
        self.vocabulary = np.unique(self.terms[real])


def intersect(windows: Windows, terms: np.ndarray, ends: np.ndarray, positions: np.ndarray, reach: int):
    """Exact matches (window, start) and proximity matches (window, place) in one block.

    Lists are taken from the rarest term of a window to the most frequent. A proximity
    match has all terms of the window within ``reach`` words of its rarest term.
    """
    none = np.empty(0, np.int64)
    if not len(terms) or not len(windows.size):
        return (none, none), (none, none)
    width = windows.terms.shape[1]
    real = np.arange(width)[None] < windows.size[:, None]
    found = np.minimum(np.searchsorted(terms, windows.terms), len(terms) - 1)
    alive = np.flatnonzero(((terms[found] == windows.terms) | ~real).all(1))
    found, real = found[alive], real[alive]
    begins = np.concatenate([[0], ends[:-1]])
    frequency = np.where(real, (ends - begins)[found], np.iinfo(np.int64).max)
    order = np.argsort(frequency, axis=1, kind="stable")
    # every posting as one number, in order, for membership tests
    postings = (np.repeat(np.arange(len(terms)), ends - begins) << 34) | positions
    last = len(postings) - 1

    rarest = found[np.arange(len(alive)), order[:, 0]]
    many = frequency[np.arange(len(alive)), order[:, 0]]
    which = np.repeat(np.arange(len(alive)), many)
    place = positions[ranges(begins[rarest], many)]
    exact, near = (which, place - order[which, 0]), (which, place)
    exact = tuple(x[exact[1] >= 0] for x in exact)
    for k in range(1, width):
        w, start = exact
        column = order[w, k]
        wanted = (found[w, column] << 34) | (start + column)
        ok = ~real[w, column] | (postings[np.minimum(np.searchsorted(postings, wanted), last)] == wanted)
        exact = w[ok], start[ok]
        w, at = near
        column = order[w, k]
        term = found[w, column] << 34
        nearest = postings[np.minimum(np.searchsorted(postings, term | np.maximum(at - reach, 0)), last)]
        ok = ~real[w, column] | ((nearest >= term) & (nearest <= (term | (at + reach))))
        near = w[ok], at[ok]
    return (alive[exact[0]], exact[1]), (alive[near[0]], near[1])


def _per_row(rows: np.ndarray, names: pa.Array, which: np.ndarray, n: int) -> pa.Array:
    """For each of n rows, the distinct names that (rows, which) gives it."""
    pairs = np.unique(rows.astype(np.int64) << 32 | which)
    return list_of(names.take(pa.array(pairs & 0xFFFFFFFF)), np.bincount(pairs >> 32, minlength=n))


def search(index: DataFrame, windows: Windows, reach: int) -> DataFrame:
    """For each document: spans of hit words, items with a phrase and items with a proximity match."""
    shared = index.sparkSession.sparkContext.broadcast(windows)
    kind = index.schema["keys"].dataType.elementType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wins = shared.value
        names = pa.array(wins.items, pa.string())
        owner_begin = np.concatenate([[0], wins.owner_ends[:-1]]).astype(np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                count = row["n_words"].values.to_numpy()
                n = len(count)
                base = np.cumsum(count) - count + np.arange(n) * GAP
                terms = np.frombuffer(row["terms"].as_buffer(), np.uint64)
                ends = np.frombuffer(row["ends"].as_buffer(), np.uint32).astype(np.int64)
                positions = np.frombuffer(row["positions"].as_buffer(), np.uint32).astype(np.int64)
                (w, start), (wn, place) = intersect(wins, terms, ends, positions, reach)
                doc, doc_near = np.searchsorted(base, start, "right") - 1, np.searchsorted(base, place, "right") - 1

                def owners(rows, which):
                    size = wins.owner_ends[which] - owner_begin[which]
                    return _per_row(np.repeat(rows, size), names, wins.owner[ranges(owner_begin[which], size)], n)

                # runs of hit words: no run crosses the gap between documents
                order = np.argsort(start, kind="stable")
                s, e, d = start[order], (start + wins.size[w])[order], doc[order]
                reached = np.maximum.accumulate(e) if len(e) else e
                opens = np.append(True, s[1:] > reached[:-1]) if len(s) else np.empty(0, bool)
                closes = np.append(np.flatnonzero(opens)[1:] - 1, len(s) - 1) if len(s) else np.empty(0, int)
                d, s, e = d[opens], s[opens], reached[closes]
                spans = pa.StructArray.from_arrays([pa.array(s - base[d]), pa.array(e - base[d])], ["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"].as_py()] * n),
                        pa.array(np.arange(n, dtype=np.int32)),
                        row["keys"].values,
                        pa.array(count),
                        list_of(spans, np.bincount(d, minlength=n)),
                        owners(doc, w),
                        owners(doc_near, wn),
                    ],
                    ["block", "at", "key", "n_words", "spans", "items", "near"],
                )

    return index.mapInArrow(
        find, f"block string, at int, key {kind}, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>, near array<string>"
    )


def covered(spans):
    """Words under a sorted list of spans that may overlap."""
    step = lambda a, s: F.struct(F.greatest(a["end"], s["end"]).alias("end"), (a["n"] + F.greatest(s["end"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n"))
    return F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")), step, lambda a: a["n"])


def find_contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", width: int = 10, reach: int = 15, portion: int = PORTION) -> DataFrame:
    """One row per row of ``docs``: key, n_words, spans, items (phrase), near (proximity), n_hit.

    ``items`` has item_id and text. Windows are ``width`` consecutive words of an item.
    """
    if not 0 < width <= GAP // 2 or not 0 <= reach < GAP // 2:
        raise ValueError("width and reach must be below half the gap")
    hashed = written(item_words(items), "decontaminate-items")
    total = hashed.agg(F.sum(F.length("words"))).first()[0] or 0
    portions = -(-total // portion) or 1
    group = F.pmod(F.xxhash64("item", "words"), F.lit(portions))
    parts, index = [], None
    for k in range(portions):
        windows = Windows(hashed.where(group == k).collect(), width)
        if index is None:
            index = written(build_index(docs, key, windows.vocabulary if portions == 1 else None), "decontaminate-index")
        parts.append(search(index, windows, reach))
    found = parts[0]
    if portions > 1:
        for part in parts[1:]:
            found = found.unionByName(part)
        lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "near")]
        found = found.groupBy("block", "at").agg(F.first("key").alias("key"), F.first("n_words").alias("n_words"), *lists)
    return found.select(
        F.col("key").alias(key),
        "n_words",
        F.array_sort("spans").alias("spans"),
        F.sort_array(F.array_distinct("items")).alias("items"),
        F.sort_array(F.array_distinct("near")).alias("near"),
    ).withColumn("n_hit", covered(F.col("spans")))
