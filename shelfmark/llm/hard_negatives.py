"""Hard negatives from blocks of candidates with zone maps, in Hilbert order.

For every anchor: its positives are the nearest rows of its own label; for each positive,
the negatives are the nearest rows of other labels whose score lies in a window below the
positive's score. Scores are inner products of integer components, so all of it is exact.

Rows are projected to the principal axes of a bounded sample, numbered along a Hilbert
curve, range-partitioned by that number and written as Parquet, one row per block of at
most ``BLOCK`` candidates that are neighbours on the curve. A block has a zone map: the
least and the largest value of every component. For an anchor, interval arithmetic makes
of it the least and the largest score that any row of the block can have. A block is
read for an anchor only if these reach one of its windows:

* positives: the block's largest score is not below the last of the best found so far,
* negatives: its scores can lie between the floor and the ceiling of a window, where the
  floor is raised to the last of the best found so far.

What is found so far comes from the anchor's own block, which is read first. Anchors are
handled in groups of neighbours on the curve, so a group asks for few blocks, and a group
and a block meet in a row of their own: memory does not grow with either table.

The sample fits the projection only: every row is placed in a block, and the result does
not depend on how well it is placed. On vectors without structure zone maps let nothing
go, and the work is anchors times rows, in blocks.

Defined cases: rows without an id, a label or a vector take no part, nor do rows with null
or non-finite components or of another length than most (ties: the shorter). An anchor has
as many positives, and a positive as many negatives, as there are; equal scores order by
id; rows that repeat an id count once, as the one with the smallest label and components;
an empty table gives an empty result; further columns are ignored. Components from 2**23
in 1/256 on are refused with an error: up to 1,000 of them give scores whose hundredfold
fits 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.ann import hilbert_numbers
from shelfmark.llm.vector_codes import packed, sound_vector, usual_length, whole_numbers
from shelfmark.session import discard, shuffle_partitions, written

SCALE = 256
BLOCK, GROUP = 1024, 64
#: Zone maps that are tested together against one group of anchors.
ZONES = 256
#: Rows on which the projection is fitted.
SAMPLE = 4096
DIMENSIONS, BITS = 8, 7
POSITIVES, NEGATIVES = 5, 3
#: Scores of a positive in percent between which its negatives lie.
LEAST, MOST = 50, 95


def candidates(rows: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """key, label and q (integer components) of the rows that take part."""
    some = rows.select(F.col(key).cast("long").alias("key"), label.cast("long").alias("label"), F.col(vector).alias("v"))
    some = some.where("key is not null and label is not null").where(sound_vector("v"))
    large = F.exists("v", lambda x: F.abs(x.cast("double") * SCALE) >= 2.0**23)
    some = some.withColumn("q", F.when(large, F.raise_error(F.lit("a component is too large for 64-bit scores"))).otherwise(whole_numbers("v", SCALE)))
    some = some.where(F.size("v") == usual_length(some, "v")).where("size(v) > 0")
    return some.groupBy("key").agg(F.min(F.struct("label", "q")).alias("row")).select("key", "row.label", "row.q")


# ---- blocks -------------------------------------------------------------------------


class Projection:
    """Principal axes of a sample, with the range of each for the grid."""

    def __init__(self, sample: np.ndarray):
        self.middle = sample.mean(axis=0)
        self.axes = np.linalg.svd(sample - self.middle, full_matrices=False)[2][:DIMENSIONS].T
        place = (sample - self.middle) @ self.axes
        self.low = place.min(axis=0)
        self.width = np.maximum(place.max(axis=0) - self.low, 1e-9)

    def numbers(self, vectors: np.ndarray) -> np.ndarray:
        place = ((vectors - self.middle) @ self.axes - self.low) / self.width
        return hilbert_numbers(np.clip(place * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def blocks_of(rows: DataFrame) -> DataFrame:
    """(block, keys, labels, vectors, low, high): candidates in Hilbert order, packed, with their zone map."""
    few = rows.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("q").toArrow().column("q").combine_chunks()
    shared = rows.sparkSession.sparkContext.broadcast(Projection(matrix(few).astype(float)))  # some KB

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q = matrix(batch.column("q"))
                yield pa.RecordBatch.from_arrays([pa.array(shared.value.numbers(q)), batch.column("key"), batch.column("label"), packed(q.astype(np.int32))], ["number", "key", "label", "q"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        made = 0

        def give(last: bool):
            nonlocal held, made
            table = pa.Table.from_batches(held).combine_chunks()
            first = 0
            while len(table) - first >= BLOCK or (last and first < len(table)):
                part = table.slice(first, BLOCK)
                v = np.frombuffer(b"".join(part.column("q").to_pylist()), np.int32).reshape(len(part), -1)
                body = [part.column(c).to_numpy().astype(np.int64).tobytes() for c in ("key", "label")] + [v.tobytes(), v.min(axis=0).tobytes(), v.max(axis=0).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([(part.column("part")[0].as_py() << 32) + made]), *[pa.array([b], pa.binary()) for b in body]], ["block", "keys", "labels", "vectors", "low", "high"])
                first, made = first + BLOCK, made + 1
            held = table.slice(first).to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(len(b) for b in held) >= BLOCK:
                    yield from give(False)
        if held:
            yield from give(True)

    numbered = rows.mapInArrow(number, "number bigint, key bigint, label bigint, q binary")
    parts = shuffle_partitions(rows.sparkSession)
    # equal vectors have one number; the id lets the range partitioning split them
    ordered = numbered.repartitionByRange(parts, "number", "key").sortWithinPartitions("number", "key").withColumn("part", F.spark_partition_id())
    return ordered.mapInArrow(pack, "block bigint, keys binary, labels binary, vectors binary, low binary, high binary")


GROUP_COLUMNS = ["group", "home", "members", "keys", "labels", "vectors"]
GROUPS = "group string, home bigint, members array<bigint>, keys binary, labels binary, vectors binary"


def anchors_of(blocks: DataFrame, step: int) -> DataFrame:
    """(group, home, members, keys, labels, vectors): the anchors of a block in groups, packed; home is their block, members are their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys, labels = np.frombuffer(r["keys"], np.int64), np.frombuffer(r["labels"], np.int64)
                v = np.frombuffer(r["vectors"], np.int32).reshape(len(keys), -1)
                own = np.flatnonzero(keys % step == 0)
                for k in range(0, len(own), GROUP):
                    some = own[k : k + GROUP]
                    body = [keys[some].tobytes(), labels[some].tobytes(), v[some].tobytes()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{r['block']}-{k}"]), pa.array([r["block"]]), pa.array([keys[some].tolist()]), *[pa.array([b], pa.binary()) for b in body]], GROUP_COLUMNS
                    )

    return blocks.select("block", "keys", "labels", "vectors").mapInArrow(run, GROUPS)


# ---- bounds and scores --------------------------------------------------------------


def score_range(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score (anchors, blocks) of any vector between ``low`` and ``high`` (blocks, components)."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return inner(up, low) + inner(down, high), inner(up, high) + inner(down, low)


def inner(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: as floats where these hold every sum exactly."""
    reach = float(np.abs(one).max(initial=0)) * float(np.abs(two).max(initial=0)) * one.shape[1]
    if reach < 1 << 52:
        return (one.astype(float) @ two.astype(float).T).astype(np.int64)
    return one.astype(np.int64) @ two.astype(np.int64).T


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = np.frombuffer(row["keys"], np.int64)
    return keys, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["vectors"], np.int32).reshape(len(keys), -1)


#: (anchor, window, key, score); the window of positives is 0.
FOUND = "anchor bigint, window bigint, key bigint, score bigint"


def matches(anchor: dict, block: dict, same: bool, k: int) -> tuple[np.ndarray, ...]:
    """The k best rows of a block in each window of each anchor of a group."""
    mine, own_labels, v = unpack(anchor)
    keys, labels, w = unpack(block)
    scores = inner(v, w)
    fits = (own_labels[:, None] == labels[None]) == same
    fits &= mine[:, None] != keys[None]
    out = [np.empty((4, 0), np.int64)]
    for spot, window, low, high in windows_of(anchor):
        inside = fits[spot] & (scores[spot] >= low) & (scores[spot] <= high)
        at = np.flatnonzero(inside)
        if len(at):
            best = at[np.lexsort((keys[at], -scores[spot, at]))[:k]]
            out.append(np.stack([np.full(len(best), mine[spot]), np.full(len(best), window), keys[best], scores[spot, best]]))
    return tuple(np.concatenate(out, axis=1))


def windows_of(anchor: dict) -> Iterator[tuple[int, int, int, int]]:
    table = np.frombuffer(anchor["windows"], np.int64).reshape(-1, 4)
    return map(tuple, table.tolist())


def visit(asked: DataFrame, groups: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """FOUND: the k best of every window, for all (group, block) in ``asked``."""
    taken = groups.select("group", F.struct("keys", "labels", "vectors", "windows").alias("anchor"))
    body = blocks.select("block", F.struct("keys", "labels", "vectors").alias("body"))
    met = asked.join(taken, "group").join(body, "block").select("anchor", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchor, block = batch.column("anchor")[i].as_py(), batch.column("body")[i].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in matches(anchor, block, same, k)], ["anchor", "window", "key", "score"])

    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "key")
    return met.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def blocks_to_read(groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """(group, block): the blocks whose zone maps reach a window of an anchor of the group.

    Zone maps go in pages of some hundred; every group meets every page once, which is the
    stated set of anchors against all zone maps, a thousandth of the rows.
    """
    count = blocks.count()
    pages = max(1, -(-count // ZONES))
    zone = F.struct("block", "low", "high")
    page = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(pages)).cast("int").alias("page")).agg(F.collect_list(zone).alias("zones"))
    asking = groups.select("group", F.struct("keys", "labels", "vectors", "windows").alias("anchor"), F.explode(F.sequence(F.lit(0), F.lit(pages - 1))).alias("page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchor, zones = batch.column("anchor")[i].as_py(), batch.column("zones")[i].as_py()
                keys, _, v = unpack(anchor)
                low, high = (np.stack([np.frombuffer(z[c], np.int32) for z in zones]) for c in ("low", "high"))
                least, most = score_range(v, low, high)
                reads = np.zeros(len(zones), bool)
                for spot, _, floor, ceiling in windows_of(anchor):
                    reads |= (most[spot] >= floor) & (least[spot] <= ceiling)
                some = [zones[z]["block"] for z in np.flatnonzero(reads)]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("group")[i].as_py()] * len(some), pa.string()), pa.array(some, pa.int64())], ["group", "block"])

    return asking.join(page, "page").select("group", "anchor", "zones").mapInArrow(run, "group string, block bigint")


def with_windows(groups: DataFrame, windows: DataFrame | None) -> DataFrame:
    """Groups with their windows packed as rows of (spot, window, floor, ceiling).

    ``windows`` has (anchor, windows); anchors that are not there have none. Without it
    every anchor has one window that is open on both sides.
    """
    wide = np.iinfo(np.int64)
    plain = windows is None
    if not plain:
        spread = groups.select("group", "members").select("group", F.posexplode("members").alias("spot", "anchor"))
        listed = spread.join(windows, "anchor").groupBy("group").agg(F.collect_list(F.struct("spot", "windows")).alias("listed"))
        groups = groups.join(listed, "group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = []
            for i in range(batch.num_rows):
                if plain:
                    n = len(batch.column("keys")[i].as_py()) // 8
                    table = [(spot, 0, wide.min, wide.max) for spot in range(n)]
                else:
                    table = [(x["spot"], w["window"], w["low"], w["high"]) for x in batch.column("listed")[i].as_py() for w in x["windows"]]
                body.append(np.array(table, np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in GROUP_COLUMNS], pa.array(body, pa.binary())], [*GROUP_COLUMNS, "windows"])

    return groups.mapInArrow(run, f"{GROUPS}, windows binary")


def best_rows(groups: DataFrame, blocks: DataFrame, same: bool, k: int, windows: DataFrame | None) -> DataFrame:
    """FOUND and rank: the k best of every window over all blocks.

    The anchors' own blocks are read first; the last of k found there raises the floor.
    """
    first = written(with_windows(groups, windows), "negatives-asking")
    home = first.select("group", F.col("home").alias("block"))
    seen = visit(home, first, blocks, same, k).where(F.col("rank") == k).select("anchor", "window", F.col("score").alias("floor"))
    if windows is None:
        every = groups.select(F.explode("members").alias("anchor"), F.lit(0).cast("long").alias("window"), F.lit(-(1 << 63)).cast("long").alias("low"), F.lit((1 << 63) - 1).cast("long").alias("high"))
    else:
        every = windows.select("anchor", F.inline("windows"))
    raised = every.distinct().join(seen, ["anchor", "window"], "left").select("anchor", F.struct("window", F.greatest("low", "floor").alias("low"), "high").alias("w"))
    raised = raised.groupBy("anchor").agg(F.collect_list("w").alias("windows"))
    asking = written(with_windows(groups, raised), "negatives-asking")
    asked = written(blocks_to_read(asking, blocks), "negatives-asked")
    found = written(visit(asked, asking, blocks, same, k), "negatives-found")
    discard(first, asking, asked)
    return found


def mine(rows: DataFrame, step: int = 50, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors are ids divisible by ``step``."""
    label = F.col(label) if isinstance(label, str) else label
    table = written(candidates(rows, key, vector, label), "negatives-rows")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if table.isEmpty():
        discard(table)
        return rows.sparkSession.createDataFrame([], schema)
    blocks = written(blocks_of(table), "negatives-blocks")
    groups = written(anchors_of(blocks, step), "negatives-anchors")
    discard(table)
    near = best_rows(groups, blocks, True, positives, None)
    # positives of one score share a window, which the score itself names
    whole = F.struct(F.col("score").alias("window"), exact_ceiling("score", LEAST).alias("low"), exact_floor("score", MOST).alias("high"))
    windows = near.select("anchor", whole.alias("w")).distinct().where("w.low <= w.high").groupBy("anchor").agg(F.collect_list("w").alias("windows"))
    windows = written(windows, "negatives-windows")
    far = best_rows(groups, blocks, False, negatives, windows)
    pairs = near.select("anchor", F.col("key").alias("positive_id"), F.col("score").alias("window")).join(
        far.select("anchor", "window", F.col("rank"), F.col("key").alias("negative_id"), F.col("score").alias("negative_score")), ["anchor", "window"]
    )
    discard(windows, groups)
    return pairs.select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("window").alias("positive_score"), "negative_score")


def exact_floor(column: str, percent: int) -> Column:
    """floor(column * percent / 100) in whole numbers."""
    return F.expr(f"({column} * {percent} - pmod({column} * {percent}, 100)) div 100")


def exact_ceiling(column: str, percent: int) -> Column:
    return F.expr(f"-((-{column} * {percent} - pmod(-{column} * {percent}, 100)) div 100)")
