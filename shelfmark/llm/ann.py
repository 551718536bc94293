"""Approximate nearest neighbours by several shifted Hilbert curves.

Vectors are projected to a few dimensions by a random rotation for each curve, shifted by
a random vector, cut into a grid and numbered along a Hilbert curve. Spark range-partitions
the rows of all curves by number; a row's place in its curve comes from the partition sizes.
A query looks at the rows within ``window`` places of its own in every curve, in blocks of
consecutive rows, and its finds are merged and ranked by the exact inner product.

How wide the window must be is measured: for up to ``SAMPLE`` queries (chosen by a hash)
the exact neighbours are found, and the window is the smallest at which the share
``RECALL`` of them lies within it in some curve. The same rule holds at every size. Data
without any structure need windows that grow with the rows; then so does the work.

Defined cases: vectors that are null, all zero, of another length than most, or that hold
null or non-finite components take no part, nor do rows without an id; a query has as many
results as there are candidates, up to k; rows that repeat an id count as one with their
largest product; equal products order by id; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.groups import runs
from shelfmark.session import shuffle_partitions, written

CURVES, DIMENSIONS, BITS = 8, 12, 5
#: Queries whose exact neighbours tell the window, and the share of these that it must hold.
SAMPLE, RECALL = 128, 0.96
#: Rows of a block: some MB of vectors.
BLOCK = 8192
#: Sample rows from which the grid's range is taken.
GRID_SAMPLE = 4096


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """key and vector (doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    some = rows.select(F.col(key).cast("long").alias("key"), v.alias("v")).where("key is not null and v is not null").where(sound)
    common = some.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return some.where(F.size("v") == (common["n"] if common else 0))


def hilbert_numbers(cells: np.ndarray, bits: int) -> np.ndarray:
    """The number along the Hilbert curve of each row of grid cells, by the transposed form."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        p = q - np.uint64(1)
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - np.uint64(1), np.uint64(0))
        q >>= np.uint64(1)
    x ^= flip
    number = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            number = (number << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return number.astype(np.int64)


class Curves:
    """The rotations, shifts and grid of all curves; the grid is fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        wide = min(DIMENSIONS, size)
        self.turn = [np.linalg.qr(rng.standard_normal((size, size)))[0][:, :wide] for _ in range(CURVES)]
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        spread = np.concatenate([np.abs(unit @ t).ravel() for t in self.turn])
        self.scale = float(np.quantile(spread, 0.99)) or 1.0
        self.shift = [rng.random(wide) * 0.5 - 0.25 for _ in range(CURVES)]

    def numbers(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        """Directions decide: for the largest product, lengths are for the exact ranking."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        place = (unit @ self.turn[curve]) / self.scale + self.shift[curve]
        cells = np.clip((place + 1.25) / 2.5 * (1 << BITS), 0, (1 << BITS) - 1)
        return hilbert_numbers(cells.astype(np.int64), BITS)


def as_matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def numbered(vectors: DataFrame, curves: Curves) -> DataFrame:
    """curve, number and key of every vector on every curve."""
    shared = vectors.sparkSession.sparkContext.broadcast(curves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = as_matrix(batch.column("v"))
                for c in range(CURVES):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), c, np.int32)), pa.array(shared.value.numbers(v, c)), batch.column("key")], ["curve", "number", "key"])

    return vectors.mapInArrow(run, "curve int, number bigint, key bigint")


def ranked(numbers: DataFrame) -> DataFrame:
    """curve, key and place (from 0) along the curve.

    Rows are range-partitioned by curve and number; the place is the row's place in its
    partition plus the rows of its curve in earlier partitions: a count for each.
    """
    # written once, so that the places and the counts see the same partitions
    ordered = numbers.repartitionByRange(max(shuffle_partitions(numbers.sparkSession), CURVES), "curve", "number", "key").sortWithinPartitions("curve", "number", "key")
    inner = Window.partitionBy("part", "curve").orderBy("number", "key")
    kept = written(ordered.withColumn("part", F.spark_partition_id()), "ann-order")
    sizes = kept.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = kept.withColumn("inner", F.row_number().over(inner) - 1).join(before.drop("n"), ["curve", "part"])
    return placed.select("curve", "key", (F.col("inner") + F.col("before")).cast("long").alias("place"))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, each summed in the same order wherever it stands."""
    return (queries * vectors).sum(axis=1)


def best(query_key: np.ndarray, queries: np.ndarray, keys: np.ndarray, vectors: np.ndarray, allowed: np.ndarray | None, k: int):
    """The k best rows of a block for each query: query, key and product. Ties go to smaller keys.

    The matrix product only chooses; what is chosen, with all that may tie, is summed again.
    """
    out_q, out_k, out_s = [], [], []
    step = max(1, (4 << 20) // max(len(keys), 1))
    for first in range(0, len(queries), step):
        part = queries[first : first + step]
        about = part @ vectors.T
        about[query_key[first : first + step, None] == keys[None]] = -np.inf
        if allowed is not None:
            low, high = allowed[first : first + step].T
            about[(np.arange(len(keys))[None] < low[:, None]) | (np.arange(len(keys))[None] > high[:, None])] = -np.inf
        if about.shape[1] > k:
            limit = np.partition(about, about.shape[1] - k, axis=1)[:, about.shape[1] - k]
        else:
            limit = np.full(len(part), -np.inf)
        q, j = np.nonzero((about >= (limit - 1e-9 * (1 + np.abs(limit)))[:, None]) & (about > -np.inf))
        score = products(part[q], vectors[j])
        order = np.lexsort((keys[j], -score, q))
        q, j, score = q[order], j[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        q, j, score = q[place < k], j[place < k], score[place < k]
        out_q.append(query_key[first + q])
        out_k.append(keys[j])
        out_s.append(score)
    return (np.concatenate(x) if x else np.empty(0) for x in (out_q, out_k, out_s))


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all blocks."""
    once = found.groupBy("query", "key").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


FOUND = "query bigint, key bigint, score double"


def exact(vectors: DataFrame, query_keys: np.ndarray, query_vectors: np.ndarray, k: int) -> DataFrame:
    """The exact neighbours of a bounded set of queries, by a pass over all rows."""
    shared = vectors.sparkSession.sparkContext.broadcast((query_keys, query_vectors))

    def run(batches):
        keys, queries = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                q, j, s = best(keys, queries, part.column("key").to_numpy(), as_matrix(part.column("v")), None, k)
                yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int64)), pa.array(j.astype(np.int64)), pa.array(s.astype(float))], ["query", "key", "score"])

    return top(vectors.mapInArrow(run, FOUND), k)


def measured_window(vectors: DataFrame, places: DataFrame, is_query, k: int) -> int:
    """The window that holds the share RECALL of the sampled queries' exact neighbours."""
    sample = vectors.where(is_query).orderBy(F.xxhash64("key"), "key").limit(SAMPLE).collect()
    if not sample:
        return 0
    keys, queries = np.array([r["key"] for r in sample]), np.array([r["v"] for r in sample])
    pairs = written(exact(vectors, keys, queries, k).select("query", "key"), "ann-sample")
    near = places.join(F.broadcast(pairs), "key").select("query", "key", "curve", F.col("place").alias("there"))  # SAMPLE * k pairs
    mine = places.withColumnsRenamed({"key": "query", "place": "here"})
    apart = near.join(mine, ["query", "curve"]).groupBy("query", "key").agg(F.min(F.abs(F.col("there") - F.col("here"))).alias("apart"))
    return int(apart.agg(F.percentile("apart", F.lit(RECALL))).first()[0] or 0) + 1


def nearest(rows: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of every query.

    ``is_query`` is a condition on ``key`` (the column of that name here) for the queries.
    """
    vectors = written(valid_vectors(rows, key, vector).distinct(), "ann-vectors")
    few = vectors.orderBy(F.xxhash64("key"), "key").limit(GRID_SAMPLE).select("v").collect()
    found_schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not few:
        return rows.sparkSession.createDataFrame([], found_schema)
    places = written(ranked(numbered(vectors, Curves(np.array([r["v"] for r in few])))), "ann-places")
    window = measured_window(vectors, places, is_query, k)
    block = F.floor(F.col("place") / BLOCK).cast("long")
    low, high = F.greatest(F.col("place") - window, F.lit(0)), F.col("place") + window
    held = places.join(vectors, "key")
    data = held.select("curve", block.alias("block"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high"), F.col("place"), "key", "v")
    spread = F.explode(F.sequence(F.floor(low / BLOCK).cast("long"), F.floor(high / BLOCK).cast("long")))
    last = places.groupBy("curve").agg(F.max("place").alias("last"))
    asked = held.where(is_query).join(F.broadcast(last), "curve").select("curve", spread.alias("block"), low.alias("low"), F.least(high, F.col("last")).alias("high"), "place", "key", "v")
    asked = asked.where(F.col("block") <= F.floor(F.col("high") / BLOCK))
    both = data.unionByName(asked).repartition("curve", "block").sortWithinPartitions("curve", "block", F.col("low").isNotNull(), "place", "key")

    def run(batches):
        for table, begins in runs(batches, ["curve", "block"]):
            ends = np.append(begins[1:], len(table))
            for first, end in zip(begins, ends, strict=True):
                part = table.slice(first, end - first)
                rows_ = part.column("low").null_count
                if not rows_ or rows_ == len(part):
                    continue
                keys, v = part.column("key").to_numpy(), as_matrix(part.column("v"))
                begin = part.column("block")[0].as_py() * BLOCK
                reach = np.stack([part.column(c).slice(rows_).to_numpy() - begin for c in ("low", "high")], axis=1)
                q, j, s = best(keys[rows_:], v[rows_:], keys[:rows_], v[:rows_], reach, k)
                yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int64)), pa.array(j.astype(np.int64)), pa.array(s.astype(float))], ["query", "key", "score"])

    merged = top(both.mapInArrow(run, FOUND), k)
    return merged.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("key").alias("vec_id"), "score")
