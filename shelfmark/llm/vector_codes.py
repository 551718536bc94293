"""Vector compression: each part of a vector as the index of its nearest codebook entry.

Components become integers, vectors are cut into ``PARTS`` equal parts, and each part
position has a codebook of ``ENTRIES`` entries, trained by rounds of assigning and
averaging. All arithmetic that decides is in integers, so runs agree to the last digit.

Most exact scans are saved by norm-of-sum bounds. For each part a row keeps the distance
to its entry and the least distance to any other, each with the stamp of the round in
which it was measured. The driver retains the codebooks of all rounds (a few KB each), so
a bound of round s is carried to round t by the true displacement of an entry between s
and t, the norm of the sum of its steps; that is never more than the sum of the norms of
its steps, which plain drift bounds add up. Only where the carried bounds meet is the own
distance measured anew, and only where they still meet are all entries scanned.

Rows and their bounds are written as Parquet each round, and the table of the round
before goes. A task sends one partial sum per entry that changed; the driver sees no
more than codebooks.

Defined cases: rows whose vector is null, or holds null or non-finite components, are
dropped, and so are rows of another length than most vectors (ties: the shorter); vectors
whose length is no multiple of the parts are filled up with zeros. The smallest ids start
the codebook, null ids last, rows that repeat an id by their components; with fewer rows
than entries all of them start it. Equal distances go to the lower index, unused entries
stay. Every kept row gives one row; an empty table gives an empty result; other columns
are ignored. Components whose squared distances would not fit 64 bits are refused with
an error (at 64 components: beyond 2**27 in 1/4096).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import discard, shuffle_partitions, written

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
#: Relative room left on both sides of a measured distance for rounding, far above that of 32-bit floats.
ROOM = 1e-5
STATE = "assigned binary, upper binary, lower binary, upper_at binary, lower_at binary"
STATE_KINDS = {"assigned": np.uint8, "upper": np.float32, "lower": np.float32, "upper_at": np.uint8, "lower_at": np.uint8}


def whole_numbers(vector: str, scale: int) -> Column:
    """Components times ``scale`` as integers, rounded down; the product is taken in double precision."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))


def sound_vector(vector: str) -> Column:
    v = F.col(vector)
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The commonest vector length, the shorter of two; 0 if there is none."""
    common = rows.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return common["n"] if common else 0


class Codebooks:
    """The codebooks of all rounds so far: (rounds, parts, entries, part length)."""

    def __init__(self, first: np.ndarray):
        self.history = [first]

    def latest(self) -> np.ndarray:
        return self.history[-1]

    def moves(self) -> tuple[np.ndarray, np.ndarray]:
        """True displacement of every entry from each round to now: (rounds, parts, entries),
        and the largest of it over all entries but the one named, of the same shape."""
        now = self.latest()
        own = np.stack([np.sqrt(((now - then).astype(float) ** 2).sum(axis=2)) for then in self.history])
        others = np.zeros_like(own)
        for j in range(own.shape[2]):
            rest = np.delete(own, j, axis=2)
            others[:, :, j] = rest.max(axis=2) if rest.shape[2] else 0.0
        return own, others


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (rows, entries) in integers."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for d in range(x.shape[1]):
        step = x[:, d, None] - entries[None, :, d]
        step *= step
        out += step
    return out


def scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index and distance of the nearest entry, and the least distance to any other."""
    far = squared(x, entries)
    best = far.argmin(axis=1)  # the first of equal ones
    at = np.arange(len(x))
    near = far[at, best].astype(float)
    if far.shape[1] > 1:
        far[at, best] = np.iinfo(np.int64).max
        other = far.min(axis=1).astype(float)
    else:
        other = np.full(len(x), np.inf)
    return best, np.sqrt(near), np.sqrt(other)


def assign(x: np.ndarray, state: dict[str, np.ndarray], books: np.ndarray, moves: tuple[np.ndarray, np.ndarray], turn: int) -> np.ndarray:
    """Assign the parts ``x`` (rows, parts, length) anew, in place in ``state``; which (rows, parts) were scanned.

    A part keeps its entry only if it is nearer by more than the room for rounding, so a
    tie is always decided by a scan.
    """
    scanned = np.zeros(x.shape[:2], bool)
    for p in range(x.shape[1]):
        own, upper, lower, upper_at, lower_at = (state[c][:, p] for c in STATE_KINDS)
        high = (upper + moves[0][upper_at, p, own]) * (1 + ROOM)
        low = lower * (1 - ROOM) - moves[1][lower_at, p, own] * (1 + ROOM)
        open_ = np.flatnonzero(~(high < low))
        if not len(open_):
            continue
        entry = books[p][own[open_]]
        exact = np.sqrt(((x[open_, p] - entry) ** 2).sum(axis=1).astype(float))
        upper[open_], upper_at[open_] = exact, turn
        open_ = open_[~(exact * (1 + ROOM) < low[open_])]
        if len(open_):
            best, near, other = scan(x[open_, p], books[p])
            own[open_], upper[open_], lower[open_] = best, near, other
            upper_at[open_] = lower_at[open_] = turn
            scanned[open_, p] = True
    return scanned


def parts_of(column: pa.Array) -> np.ndarray:
    """A list column as (rows, parts, length), filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)
    missing = -flat.shape[1] % PARTS
    if missing:
        flat = np.pad(flat, ((0, 0), (0, missing)))
    return flat.reshape(len(flat), PARTS, -1)


def packed(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    matrix = np.ascontiguousarray(matrix)
    body, size = matrix.tobytes(), matrix.itemsize * matrix.shape[1]
    offsets = np.arange(len(matrix) + 1, dtype=np.int64) * size
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).cast(pa.binary())


def unpacked(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).copy()


def one_round(rows: DataFrame, books: Codebooks, turn: int) -> DataFrame:
    """The table with assignments to the latest codebooks, ``was``, the assignment before, and the scans of all parts so far."""
    first = turn == 0
    shared = rows.sparkSession.sparkContext.broadcast((books.latest(), books.moves()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, moves = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = parts_of(batch.column("q"))
            if first:
                state = {c: np.zeros(x.shape[:2], kind) for c, kind in STATE_KINDS.items()}
                for p in range(PARTS):
                    state["assigned"][:, p], state["upper"][:, p], state["lower"][:, p] = scan(x[:, p], entries[p])
                was = np.full(x.shape[:2], 255, np.uint8)
                scans = np.full(len(x), PARTS, np.int64)
            else:
                state = {c: unpacked(batch.column(c), kind) for c, kind in STATE_KINDS.items()}
                was = state["assigned"].copy()
                scans = batch.column("scans").to_numpy() + assign(x, state, entries, moves, turn).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("key", "label", "q")], *[packed(state[c]) for c in STATE_KINDS], packed(was), pa.array(scans)],
                ["key", "label", "q", *STATE_KINDS, "was", "scans"],
            )

    return rows.mapInArrow(run, f"key bigint, label bigint, q array<bigint>, {STATE}, was binary, scans bigint")


def changed_sums(rows: DataFrame, entries: int) -> DataFrame:
    """Per (part, entry): what the changes of this round add to its count and sums; one row a task and entry at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((PARTS, entries), np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = parts_of(batch.column("q"))
            now, was = unpacked(batch.column("assigned"), np.uint8), unpacked(batch.column("was"), np.uint8)
            if total is None:
                total = np.zeros((PARTS, entries, x.shape[2]), np.int64)
            for p in range(PARTS):
                moved = np.flatnonzero(now[:, p] != was[:, p])
                np.add.at(total[p], now[moved, p], x[moved, p])
                count[p] += np.bincount(now[moved, p], minlength=entries)
                left = moved[was[moved, p] != 255]
                np.subtract.at(total[p], was[left, p], x[left, p])
                count[p] -= np.bincount(was[left, p], minlength=entries)
        if total is not None:
            part, entry = np.nonzero((count != 0) | (total != 0).any(axis=2))
            sums = pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), sums], ["part", "entry", "n", "sums"])

    partial = rows.select("q", "assigned", "was").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    summed = partial.select("part", "entry", "n", F.posexplode("sums").alias("d", "s")).groupBy("part", "entry", "d")
    return summed.agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def start(rows: DataFrame) -> np.ndarray | None:
    """The first codebook: the parts of the smallest ids."""
    first = rows.orderBy(F.col("key").asc_nulls_last(), "q").limit(ENTRIES).select("q").toArrow().column("q").combine_chunks()
    return parts_of(first).transpose(1, 0, 2).copy() if len(first) else None


def kept_vectors(rows: DataFrame, key: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """key, label and q (integer components) of the rows that take part."""
    some = rows.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v")).where(sound_vector("v"))
    large = F.exists("v", lambda x: F.abs(x.cast("double") * scale) >= 2.0**62)  # too far to be an integer at all
    some = some.withColumn("q", F.when(large, F.raise_error(F.lit("a component is too large for 64-bit distances"))).otherwise(whole_numbers("v", scale)))
    return some.where(F.size("v") == usual_length(some, "v")).where("size(v) > 0").select("key", "label", "q")


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """key, label, code (bytes), error and scans (of all parts and rounds) of every kept row, and the codebooks of all rounds."""
    if not 0 <= rounds < 255:
        raise ValueError("a round's stamp has one byte")
    spark = rows.sparkSession
    # dealt out anew: the work of a row is far more than its bytes tell
    table = written(kept_vectors(rows, key, vector, label).repartition(shuffle_partitions(spark)), "codes-rows")
    first = start(table)
    if first is None:
        discard(table)
        return spark.createDataFrame([], "key bigint, label bigint, code binary, error bigint, scans bigint"), None
    reach = table.select(F.max(F.greatest(F.abs(F.array_max("q")), F.abs(F.array_min("q"))))).first()[0]
    if 4 * reach * reach * first.shape[2] * PARTS >= 1 << 62:
        discard(table)
        raise ValueError("a component is too large for 64-bit distances")
    books = Codebooks(first)
    count, total = np.zeros(first.shape[:2], np.int64), np.zeros(first.shape, np.int64)
    for turn in range(rounds):
        before, table = table, written(one_round(table, books, turn), "codes-round")
        discard(before)
        for r in changed_sums(table, first.shape[1]).collect():  # at most one codebook's numbers
            count[r["part"], r["entry"]] += r["n"] if r["d"] == 0 else 0
            total[r["part"], r["entry"], r["d"]] += r["s"]
        some = count > 0
        fresh = books.latest().copy()
        fresh[some] = total[some] // count[some][:, None]  # floor
        books.history.append(fresh)
    before, table = table, written(one_round(table, books, rounds), "codes-last")
    discard(before)
    return coded(table, books), books


def coded(table: DataFrame, books: Codebooks) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(books.latest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, own = parts_of(batch.column("q")), unpacked(batch.column("assigned"), np.uint8)
                error = sum(((x[:, p] - shared.value[p][own[:, p]]) ** 2).sum(axis=1) for p in range(PARTS))
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), batch.column("assigned"), pa.array(error), batch.column("scans")], ["key", "label", "code", "error", "scans"])

    return table.mapInArrow(run, "key bigint, label bigint, code binary, error bigint, scans bigint")


def digest(books: Codebooks | None) -> str:
    """SHA-256 of the latest codebooks' components in order of part, entry and place."""
    numbers = [] if books is None else books.latest().ravel().tolist()
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def decode(code: bytes, books: Codebooks) -> list[int]:
    """The integer vector that a code stands for."""
    return np.concatenate([books.latest()[p][i] for p, i in enumerate(code)]).tolist()


def label_errors(codes: DataFrame) -> DataFrame:
    """Add label_error, the sum of error over equal labels, nulls together."""
    sums = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
