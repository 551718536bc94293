"""From band keys to groups of similar things, without all pairs and without a driver.

Things (documents, lines) have an id, band keys (buckets), a signature and a body from which
the exact similarity is computed. The steps:

1. ``shared_buckets`` keeps the buckets with two ids or more.
2. ``likely_groups`` compares signatures within each bucket and links what may be similar.
   A pair is let go only if its signatures agree in fewer registers than ``floor``, some
   four standard deviations below the wanted similarity.
3. ``exact_links`` brings each likely group together once, compares bodies until all its
   members are connected or all likely pairs have been looked at, and returns links to the
   smallest id. Groups larger than ``CELL`` bytes are cut into cells; each pair of cells
   meets in a task of its own, so memory is bounded and no pair is lost.
4. ``components`` is a distributed union-find (large-star, small-star) on the links.

Links within a group that is connected already are not looked at: the result is the
components, not the list of links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import U64, mix64
from shelfmark.session import written

CELL = 32 << 20
#: Ids up to this number (32 MB) are sent to all tasks; beyond, bodies are joined by a shuffle.
BROADCAST_IDS = 4_000_000


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` registers: (things, bands)."""
    things, registers = signatures.shape
    bands = registers // rows
    cut = signatures[:, : bands * rows].reshape(things, bands, rows).astype(U64)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=U64)), (things, bands)).copy()
    for k in range(rows):
        key = mix64(key ^ cut[:, :, k]) + U64(k)
    return key


def shared_buckets(bands: DataFrame) -> DataFrame:
    """The rows (bucket, id) of buckets with two ids or more, each once.

    One shuffle; the rows of a bucket then stream by in order, and only its first id waits
    until a second one comes, so a bucket of any size takes no memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, waiting = None, None  # the last row, and the first id of its bucket if it is alone so far
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, ids = batch.column("bucket").to_numpy(), batch.column("id").to_numpy()
            opens = np.append(before is None or bucket[0] != before[0], bucket[1:] != bucket[:-1])
            new = opens | np.append(before is None or ids[0] != before[1], ids[1:] != ids[:-1])
            later = new & ~opens
            group = np.cumsum(opens)  # 0: the bucket that was open
            several = np.zeros(group[-1] + 1, bool)
            several[group[later]] = True
            out_bucket, out_id = bucket[later | (opens & several[group])], ids[later | (opens & several[group])]
            if waiting is not None and several[0]:
                out_bucket, out_id = np.append(out_bucket, waiting[0]), np.append(out_id, waiting[1])
                waiting = None
            start = np.flatnonzero(opens)
            if len(start):
                waiting = None if several[group[-1]] else (bucket[start[-1]], ids[start[-1]])
            before = bucket[-1], ids[-1]
            if len(out_id):
                yield pa.RecordBatch.from_arrays([pa.array(out_bucket), pa.array(out_id)], ["bucket", "id"])

    return bands.repartition("bucket").sortWithinPartitions("bucket", "id").mapInArrow(run, "bucket bigint, id bigint")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches as tables of whole groups, and where each group begins.

    Rows of one group stay together even if it goes over several batches.
    """
    kept: list[pa.RecordBatch] = []

    def change(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), bool)
        for key in keys:
            column = table.column(key).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        if kept and all(kept[-1].column(k)[-1] == batch.column(k)[-1] for k in keys) and all(batch.column(k)[0] == batch.column(k)[-1] for k in keys):
            kept.append(batch)
            continue
        table = pa.Table.from_batches([*kept, batch]).combine_chunks()
        new = change(table)
        last = int(new[-1]) if len(new) else 0
        if last:
            yield table.slice(0, last), np.concatenate([[0], new[:-1]])
        kept = table.slice(last).combine_chunks().to_batches()
    if kept:
        table = pa.Table.from_batches(kept).combine_chunks()
        yield table, np.concatenate([[0], change(table)])


def fixed_rows(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """A binary column of equal lengths as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def agreement(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.count_nonzero(others == one, axis=1)


def clusters(signatures: np.ndarray, floor: int) -> np.ndarray:
    """For each row the first row that is linked to it by pairs with ``floor`` equal registers."""
    n = len(signatures)
    label = np.arange(n)
    for i in range(n - 1):
        rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if not len(rest):
            continue
        for other in np.unique(label[rest[agreement(signatures[i], signatures[rest]) >= floor]]):
            low, high = min(label[i], other), max(label[i], other)
            label[label == high] = low
    return label


def likely_groups(buckets: DataFrame, signatures: DataFrame, floor: int, kind: type = np.uint32) -> DataFrame:
    """id and group (its smallest id) of everything that a likely pair links; ``kind`` is that of the registers."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in runs(batches, ["bucket"]):
            ids = table.column("id").to_numpy()
            regs = fixed_rows(table.column("sig"), kind)
            size = np.diff(np.append(begins, len(ids)))
            two = begins[size == 2]
            two = two[np.count_nonzero(regs[two] == regs[two + 1], axis=1) >= floor]
            a, b = [ids[two + 1]], [ids[two]]
            for first, n in zip(begins[size > 2], size[size > 2], strict=True):
                label = clusters(regs[first : first + n], floor)
                moved = np.flatnonzero(label != np.arange(n))
                a.append(ids[first + moved])
                b.append(ids[first + label[moved]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["id", "root"])

    rows = buckets.join(signatures, "id").select("bucket", "id", "sig")
    links = rows.repartition("bucket").sortWithinPartitions("bucket", "id").mapInArrow(link, "id bigint, root bigint")
    return components(links.distinct())


def exact_links(groups: DataFrame, bodies: DataFrame, prepare: Callable[[bytes], object], similar: Callable[[object, object], float], least: float, floor: int, kind: type = np.uint32, closeness: Callable[[np.ndarray, np.ndarray], np.ndarray] = agreement) -> DataFrame:
    """Links (id, root) between things whose bodies are similar; connected as all such links are.

    ``groups`` has (id, group), ``bodies`` (id, sig, body). ``prepare`` makes of a body what
    ``similar`` compares; pairs whose signatures have a ``closeness`` below ``floor`` are let go.
    """
    members = bodies.join(groups, "id")
    cells = members.groupBy("group").agg(F.ceil(F.sum(F.length("body") + 512) / CELL).cast("int").alias("cells"))
    own = F.pmod(F.xxhash64("id"), F.col("cells")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    met = (
        members.join(cells, "group")
        .withColumn("_own", own)
        .withColumn("_other", other)
        .select("group", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "id", "sig", "body")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in runs(batches, ["group", "i", "j"]):
            ids = table.column("id").to_numpy()
            regs = fixed_rows(table.column("sig"), kind)
            body = table.column("body")
            ends = np.append(begins[1:], len(ids))
            a, b = [], []
            for first, last in zip(begins, ends, strict=True):
                label = np.arange(first, last)
                ready: dict[int, object] = {}

                def of(k, ready=ready, body=body):
                    if k not in ready:
                        ready[k] = prepare(body[k].as_py())
                    return ready[k]

                for i in range(first, last - 1):
                    rest = np.flatnonzero(label[i - first + 1 :] != label[i - first]) + i + 1
                    if not len(rest):
                        continue
                    equal = closeness(regs[i], regs[rest])
                    likely = rest[equal >= floor][np.argsort(-equal[equal >= floor], kind="stable")]
                    for k in likely:
                        mine, its = label[i - first], label[k - first]
                        if mine != its and (ids[i] == ids[k] or similar(of(i), of(k)) >= least):
                            label[label == max(mine, its)] = min(mine, its)
                    ready.pop(i, None)
                moved = label != np.arange(first, last)
                a.append(ids[first:last][moved])
                b.append(ids[label[moved]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["id", "root"])

    ordered = met.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "id")
    return ordered.mapInArrow(compare, "id bigint, root bigint").where("id <> root")


def components(links: DataFrame, a: str = "id", b: str = "root") -> DataFrame:
    """id and group (smallest id of its component) of every id in ``links``.

    Large-star and small-star by turns: each node's neighbours are tied to the smallest of
    them, until nothing changes; the number of rounds grows with the logarithm of the size.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "groups-edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = written(small.where("u <> v").distinct(), "groups-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("group")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("group"))).distinct()


def wanted_ids(buckets: DataFrame) -> tuple[DataFrame, np.ndarray | None]:
    """The ids in shared buckets; as a sorted array too, if there are few enough to send."""
    ids = written(buckets.select("id").distinct(), "groups-ids")
    few = ids.count() <= BROADCAST_IDS
    return ids, np.sort(ids.toArrow().column("id").to_numpy()) if few else None
