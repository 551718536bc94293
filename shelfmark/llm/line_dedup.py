"""Fuzzy line deduplication: MinHash of character shingles, exact Jaccard, one line per group.

A line is what stands between line ends. Lines without a visible character are left alone.
Shingles are the runs of three characters (code points) of a line, the whole of a shorter one,
in sets: one changed character in a line of 30 leaves a similarity of 0.8. Equal lines are
found by their hash; of the distinct lines, bands of MinHash registers give candidates, which a
sketch of the shingles in the band row confirms or rules out on the spot; the exact Jaccard
similarity decides, and distributed union-find makes groups. Bands are moved some at a time. Of each group the first line stays (smallest doc_id, then place); all others
are removed with their line ends, wherever they stand.

Defined cases: a null text is empty; a text that loses all its lines becomes empty; rows of
one doc_id order by a hash of their texts, and rows that repeat an id and a text are one
document with equal results; a null doc_id comes first; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from shelfmark.llm import groups
from shelfmark.llm.blocks import U64, blank_fold, mix64, row_blocks, text_bytes
from shelfmark.session import discard, forget_shuffles, shuffle_partitions, written

#: Code points of a shingle; three, of 21 bits each, make one exact 64-bit number.
SIZE = 3
LEAST = 0.8
#: Registers of a band up to ``FEW`` lines; one more for each doubling, up to MOST_ROWS, so that buckets stay short.
ROWS, MOST_ROWS, FEW = 7, 12, 4_000_000
#: Share of the pairs of similarity 0.8 that no band finds.
MISSED = 0.00175
#: Bands whose rows are moved at a time (more, if they take less than SMALL bytes), and whose keys are stored at a time.
PASS, STORED, SMALL = 3, 28, 100 << 20
#: Bits of a sketch of a line's shingles, and bytes of a line's head: id, number of shingles, sketch.
BITS = 384
HEAD = 12 + BITS // 8
#: Bytes of band rows of one task, and rows of a bucket beyond which connected rows are left out first.
TASK, LONG = 32 << 20, 4096
#: Least number of parts of the keys, and heads that a packed row of one part holds on average, as far as TASK bytes allow.
PARTS, FILL = 64, 256
#: Bytes of text of a block, and of those whose shingles are made at a time (its arrays stay in a core's cache).
BLOCK, STEP = 1 << 20, 1 << 17


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number, first byte and end byte of every line with a visible character."""
    cut = np.flatnonzero(data == 0x0A)
    begin = np.union1d(offsets[:-1], cut + 1)
    # a line end at the end of a row opens an empty line, at the place where the next row begins
    row = np.searchsorted(offsets, begin, "right") - 1
    keep = (begin < offsets[-1]) & (row < len(offsets) - 1)
    begin, row = begin[keep], row[keep]
    after = np.append(cut, len(data))[np.searchsorted(cut, begin)]
    end = np.minimum(after, offsets[row + 1])
    number = np.searchsorted(cut, begin) - np.searchsorted(cut, offsets[row])
    visible = blank_fold() != 0
    full = (end > begin) & visible[data[np.minimum(begin, len(data) - 1)]] if len(data) else np.zeros(len(begin), bool)
    for i in np.flatnonzero((end > begin) & ~full):  # few lines begin with a blank
        full[i] = visible[data[begin[i] : end[i]]].any()
    return row[full], number[full], begin[full], end[full]


def line_ids(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each line."""
    view = memoryview(np.ascontiguousarray(data))
    return np.frombuffer(b"".join([blake2b(view[a:b], digest_size=8).digest() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]), U64)


def line_shingles(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the shingles of each line, one after another, and where each line's begin.

    The numbers of all places are made at once; in lines shorter than a shingle, what follows counts as none.
    """
    if not len(begin):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    part = data[int(begin[0]) : int(end[-1])]
    points = np.frombuffer(part.tobytes().decode().encode("utf-32-le"), np.uint32)
    begin, end = begin - begin[0], end - begin[0]
    if len(points) < len(part):  # from places of bytes to places of characters
        heads = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
        begin, end = heads[begin], heads[end]
    size = end - begin
    many = np.maximum(size - SIZE + 1, 1)
    start = np.cumsum(many) - many
    wide = np.zeros(len(points) + SIZE, U64)
    wide[: len(points)] = points
    wide[: len(points)] += U64(1)
    number = np.zeros(len(points), U64)
    for k in range(SIZE):
        number <<= U64(21)
        number += wide[k : k + len(points)]
    number = number[np.arange(int(many.sum())) + np.repeat(begin - start, many)]
    short = np.flatnonzero(size < SIZE)
    beyond = (U64(21) * (SIZE - size[short]).astype(U64)).astype(U64)
    number[start[short]] = number[start[short]] >> beyond << beyond
    return (mix64(number) >> U64(32)).astype(np.uint32), start


def rows_for(lines: int) -> int:
    return int(np.clip(ROWS + np.ceil(np.log2(max(lines, 1) / FEW)), ROWS, MOST_ROWS))


def bands_for(rows: int) -> int:
    return int(np.ceil(np.log(MISSED) / np.log1p(-(LEAST**rows))))


def factors(rows: int, bands: range) -> np.ndarray:
    """The odd factors of the registers of some bands."""
    every = np.random.default_rng(41).integers(0, 1 << 32, rows * bands.stop, dtype=np.uint64) | U64(1)
    return every[rows * bands.start :].astype(np.uint32)


def minhash(shingle: np.ndarray, start: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Signatures (lines, registers): the smallest product with each of the odd factors."""
    out = np.empty((len(odd), len(start)), np.uint32)
    if len(start):
        product = np.empty_like(shingle)
        for j, factor in enumerate(odd):
            np.multiply(shingle, factor, out=product)
            np.minimum.reduceat(product, start, out=out[j])
    return np.ascontiguousarray(out.T)


def distinct(shingle: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each line, one line after another, and where each line's begin."""
    if not len(start):
        return shingle, start
    many = np.diff(np.append(start, len(shingle)))
    key = np.repeat(np.arange(len(start), dtype=U64) << U64(32), many) | shingle
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])]
    return key.astype(np.uint32), np.searchsorted(key, np.arange(len(start), dtype=U64) << U64(32))


def sketches(shingle: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many shingles each line has, and its sketch: the parity of the shingles (different ones) that fall on each bit.

    A shingle that one of two lines lacks turns one bit over, so sketches differ in no more bits than lines in shingles.
    """
    many = np.diff(np.append(start, len(shingle)))
    bit = (shingle * U64(0x9E3779B97F4A7C15) >> U64(32)) * U64(BITS) >> U64(32)
    odd = np.bincount(np.repeat(np.arange(0, BITS * len(start), BITS), many) + bit.astype(np.int64), minlength=BITS * len(start)).astype(np.uint8) & 1
    return many.astype(np.uint32), np.packbits(odd.reshape(-1, BITS), axis=1)


def most_bits(size: np.ndarray) -> np.ndarray:
    """Differing bits up to which two lines may be similar, by the sum of their sizes.

    Similar lines differ in at most a ninth of their shingles together (0.2 / 1.8). Of long lines many shingles fall on one
    bit; there the bound is what so many shingles turn over, and four standard deviations (3 in 100,000 are beyond).
    """
    differ = size // 9
    even, both = (1 - 2 / BITS) ** differ, (1 - 4 / BITS) ** differ
    deviation = np.sqrt(np.maximum(BITS * (1 - even**2) + BITS * (BITS - 1) * (both - even**2), 0)) / 2
    return np.minimum(differ, np.ceil(BITS * (1 - even) / 2 + 4 * deviation).astype(np.int64))


@cache
def _bounds() -> np.ndarray:
    """``most_bits`` of all sums below 65,536; larger ones have the last one's bound."""
    return most_bits(np.arange(1 << 16))


def spare_bits(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """By how many bits heads without ids (rows of bytes) stay below ``most_bits``; negative: not similar."""
    size, its = one[:4].view(np.uint32).astype(np.int64), np.ascontiguousarray(others[:, :4]).view(np.uint32)[:, 0].astype(np.int64)
    bound = _bounds()
    return bound[np.minimum(size + its, len(bound) - 1)] - np.bitwise_count(one[4:] ^ others[:, 4:]).sum(1, dtype=np.int64)


def _signatures(data: np.ndarray, begin: np.ndarray, end: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Registers, and heads without ids: size and sketch as bytes."""
    registers, heads, first = [np.empty((0, len(odd)), np.uint32)], [np.empty((0, HEAD - 8), np.uint8)], 0
    while first < len(begin):
        # lines lie in order but not side by side, so this is at most STEP bytes or one line
        last = max(first + 1, int(np.searchsorted(end, begin[first] + STEP)))
        shingle, start = distinct(*line_shingles(data, begin[first:last], end[first:last]))
        size, sketch = sketches(shingle, start)
        registers.append(minhash(shingle, start, odd))
        heads.append(np.hstack([size.view(np.uint8).reshape(-1, 4), sketch]))
        first = last
    return np.concatenate(registers), np.concatenate(heads)


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for first, last in row_blocks(offsets, BLOCK):
            at = offsets[first : last + 1] - offsets[first]
            part = data[offsets[first] : offsets[last]]
            row, number, begin, end = lines(part, at)
            yield batch.slice(first, last - first), part, row, number, begin, end, line_ids(part, begin, end).view(np.int64)


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, tie (hash of the text), line and id of every line."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch, _, row, number, _, _, ids in _blocks(batches):
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("tie").take(take), pa.array(number.astype(np.int32)), pa.array(ids)], ["doc_id", "tie", "line", "id"])

    return docs.select("doc_id", "tie", "text").mapInArrow(run, f"doc_id {kind}, tie bigint, line int, id bigint")


def _once(ids: np.ndarray) -> np.ndarray:
    return np.sort(np.unique(ids, return_index=True)[1])


def heads_and_keys(docs: DataFrame, rows: int, bands: range, step: int) -> DataFrame:
    """One row for each block of text: the heads of its distinct lines side by side, and their keys of each ``step`` bands."""
    odd = factors(rows, bands)
    cuts = [slice(k, k + step) for k in range(0, len(bands), step)]

    def run(batches):
        for _, part, _, _, begin, end, ids in _blocks(batches):
            one = _once(ids)
            registers, rest = _signatures(part, begin[one], end[one], odd)
            keys = (groups.band_keys(registers, rows) >> U64(32)).astype(np.uint32)
            heads = np.hstack([ids[one].view(np.uint8).reshape(-1, 8), rest])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (heads, *(keys[:, c] for c in cuts))], names)

    names = ["heads", *(f"keys{k}" for k in range(len(cuts)))]
    return docs.select("text").mapInArrow(run, ", ".join(f"{n} binary" for n in names))


def cut_by_key(stored: DataFrame, column: str, step: int, parts: int) -> DataFrame:
    """(part, sizes, keys, heads): the rows of ``step`` bands in each part of the keys, packed, and how many each band has.

    Blocks are gathered until a packed row is well filled, so their number grows with the lines, not with blocks and parts.
    """
    full = min(FILL * parts, TASK // (HEAD + 4 * step))

    def cut(held):
        heads = np.concatenate([h for h, _ in held])
        key = np.concatenate([k for _, k in held])
        bands = key.shape[1]
        place = (key % np.uint32(parts)).astype(np.int64) * bands + np.arange(bands)
        order = np.argsort((place.astype(np.uint16) if parts * bands <= 1 << 16 else place).ravel(), kind="stable")
        sizes = np.bincount(place.ravel(), minlength=parts * bands).reshape(parts, bands)
        part = np.flatnonzero(sizes.any(axis=1))
        sizes = sizes[part].astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])

        def packed(rows, width):
            return pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(ends * width), pa.py_buffer(rows)]).cast(pa.binary())

        return pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array([x.tobytes() for x in sizes], pa.binary()), packed(key.ravel()[order], 4), packed(heads.take(order // bands, axis=0), HEAD)],
            ["part", "sizes", "keys", "heads"],
        )

    def run(batches):
        held, lines = [], 0
        for batch in batches:
            for heads, keys in zip(batch.column("heads"), batch.column("keys"), strict=True):
                heads = np.frombuffer(heads.as_buffer(), np.uint8).reshape(-1, HEAD)
                if not len(heads):
                    continue
                held.append((heads, np.frombuffer(keys.as_buffer(), np.uint32).reshape(len(heads), -1)))
                lines += len(heads)
                if lines >= full:
                    yield cut(held)
                    held, lines = [], 0
        if held:
            yield cut(held)

    return stored.select("heads", F.col(column).alias("keys")).mapInArrow(run, "part int, sizes binary, keys binary, heads binary")


def near_pairs(key: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one key (bucket) whose sketches and sizes are near, as two arrays of ids; all such pairs are connected."""
    none = np.empty(0, np.int64)
    place = key.astype(U64) << U64(32) | np.ascontiguousarray(heads[:, 8:12]).view(np.uint32)[:, 0]  # by key, then size
    order = np.argsort(place)
    place = place[order]
    same = place[1:] >> U64(32) == place[:-1] >> U64(32)
    several = np.append(same, False) | np.append(False, same)
    if not several.any():
        return none, none
    order, place = order[several], place[several]
    heads = heads.take(order, axis=0)
    ids = np.ascontiguousarray(heads[:, :8]).view(np.int64)[:, 0]
    once = _once(ids)  # equal lines of several blocks
    place, heads, ids = place[once], heads[once], ids[once]
    key, size = (place >> U64(32)).astype(np.uint32), (place & U64(0xFFFFFFFF)).astype(np.int64)
    sketch = np.ascontiguousarray(heads[:, 12:]).view(U64).T.copy()  # word by word
    bound = _bounds()

    def near(x, y):
        """Which pairs are near; most are ruled out by the first half of the sketch."""
        most, half = bound[np.minimum(size[x] + size[y], len(bound) - 1)], len(sketch) // 2
        bits = np.zeros(len(most), np.int16)
        for word in sketch[:half]:
            bits += np.bitwise_count(word[x] ^ word[y])
        left = np.flatnonzero(bits <= most)
        x, y, bits = (v[left] if isinstance(v, np.ndarray) else v for v in (x, y, bits))
        for word in sketch[half:]:
            bits += np.bitwise_count(word[x] ^ word[y])
        return left[bits <= most[left]]

    # rows of a bucket in the order of their sizes: partners of a row are the next ones, up to a quarter larger
    begin = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
    many = np.diff(begin)
    end = np.repeat(begin[1:], many)
    a, b = [none], [none]
    active = np.flatnonzero(np.repeat(many, many) <= LONG)
    step = 1
    while len(active):
        active = active[active + step < end[active]]
        active = active[4 * size[active + step] <= 5 * size[active]]
        for k in range(0, len(active), 1 << 16):
            x = active[k : k + (1 << 16)]
            x = x[near(x, x + step)]
            a.append(ids[x])
            b.append(ids[x + step])
        step += 1
    for first, last in zip(begin[:-1][many > LONG], begin[1:][many > LONG], strict=True):
        label = np.arange(first, last)
        for i in range(first, last - 1):
            stop = first + int(np.searchsorted(size[first:last], 5 * size[i] // 4, "right"))
            rest = np.flatnonzero(label[i + 1 - first : stop - first] != label[i - first]) + i + 1
            found = rest[near(i, rest)]
            if len(found):
                group = np.unique(np.append(label[found - first], label[i - first]))
                label[np.isin(label, group)] = group[0]
        moved = np.flatnonzero(label != np.arange(first, last))
        a.append(ids[first + moved])
        b.append(ids[label[moved]])
    return np.concatenate(a), np.concatenate(b)


def joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between ids as fewer links: each id and the smallest id of its component."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = np.split(at, 2)
    label = np.arange(len(ids))
    while len(one):
        low = np.minimum(label[one], label[two])
        np.minimum.at(label, label[one], low)
        np.minimum.at(label, label[two], low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[one] != label[two]
        one, two = one[open_], two[open_]
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[moved], ids[label[moved]]


def likely_links(packed: DataFrame) -> DataFrame:
    """(id, root) of lines that share a bucket and have near sketches; a task takes the bands of its parts one by one."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for sizes, keys, heads in zip(*(batch.column(c).to_pylist() for c in ("sizes", "keys", "heads")), strict=True):
                end = np.cumsum(np.frombuffer(sizes, np.int32)).tolist()
                for band, (first, last) in enumerate(zip([0, *end], end)):
                    held.setdefault(band, []).append((memoryview(keys)[4 * first : 4 * last], memoryview(heads)[HEAD * first : HEAD * last]))
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for band in sorted(held):
            some = held.pop(band)
            key = np.frombuffer(b"".join(k for k, _ in some), np.uint32)
            heads = np.frombuffer(b"".join(h for _, h in some), np.uint8).reshape(-1, HEAD)
            del some
            x, y = joined(*near_pairs(key, heads))
            a.append(x)
            b.append(y)
        x, y = joined(np.concatenate(a), np.concatenate(b))
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["id", "root"])

    return packed.mapInArrow(run, "id bigint, root bigint")


def likely_groups(docs: DataFrame, lines: int) -> DataFrame:
    """id and group of lines that likely pairs connect. Bands go in passes, so that only a few are on disk at a time."""
    spark = docs.sparkSession
    rows = rows_for(lines)
    bands = bands_for(rows)
    step = int(np.clip(SMALL // (max(lines, 1) * (HEAD + 4)), PASS, STORED))
    # a hash deals the parts to the tasks, so there are several for each
    parts = max(PARTS, 4 * -(-lines * step * (HEAD + 4) // TASK))
    tasks = max(shuffle_partitions(spark), parts // 4)
    found = []
    for low in range(0, bands, STORED):
        some = range(low, min(low + STORED, bands))
        stored = written(heads_and_keys(docs, rows, some, step), "lines-heads")
        for k in range(-(-len(some) // step)):
            packed = cut_by_key(stored, f"keys{k}", step, parts).repartition(tasks, "part")
            found.append(written(likely_links(packed), "lines-links"))
            del packed
            forget_shuffles(spark)
        discard(stored)
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    done = written(groups.components(links.distinct()), "lines-likely")
    discard(*found)
    return done


def bodies(docs: DataFrame, ids: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """id, head and bytes of each candidate line, once."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for _, part, _, _, begin, end, own in _blocks(batches):
            one = _once(own)
            if shared.value is not None:
                found = np.searchsorted(shared.value, own[one])
                one = one[(np.append(shared.value, 0)[found] == own[one]) & (found < len(shared.value))]
            body = [part[begin[i] : end[i]].tobytes() for i in one]
            at = np.concatenate([[0], np.cumsum(end[one] - begin[one])])
            _, heads = _signatures(np.frombuffer(b"".join(body), np.uint8), at[:-1], at[1:], np.empty(0, np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array(own[one]), pa.array([h.tobytes() for h in heads], pa.binary()), pa.array(body, pa.binary())], ["id", "sig", "body"])

    rows = docs.select("text").mapInArrow(run, "id bigint, sig binary, body binary")
    return (rows if wanted is not None else rows.join(ids, "id", "left_semi")).dropDuplicates(["id"])


def prepare(body: bytes) -> np.ndarray:
    """The different shingles of one line, in order; as those of ``line_shingles``, with less to do for a single line."""
    points = np.frombuffer(body.decode().encode("utf-32-le"), np.uint32).astype(U64) + U64(1)
    points = np.append(points, np.zeros(max(SIZE - len(points), 0), U64))
    number = points[: len(points) - SIZE + 1].copy()
    for k in range(1, SIZE):
        number = number << U64(21) | points[k : len(points) - SIZE + 1 + k]
    number = (mix64(number) >> U64(32)).astype(np.uint32)
    number.sort()
    return number[np.append(True, number[1:] != number[:-1])]


def jaccard(one: np.ndarray, two: np.ndarray) -> float:
    both = np.concatenate([one, two])
    both.sort()
    shared = np.count_nonzero(both[1:] == both[:-1])
    return shared / (len(both) - shared)


def line_groups(docs: DataFrame, lines: int) -> DataFrame:
    """id and group of the lines that are similar to a line of other bytes, of about so many lines."""
    likely = likely_groups(docs, lines)
    ids, wanted = groups.wanted_ids(likely)
    body = written(bodies(docs, ids, wanted), "lines-bodies")
    return groups.components(groups.exact_links(likely, body, prepare, jaccard, LEAST, 0, np.uint8, spare_bits))


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, tie and the numbers of the lines to remove, for rows that have any."""
    every = written(occurrences(docs), "lines-places")
    grouped = every.join(line_groups(docs, every.count()), "id", "left").select("doc_id", "tie", "line", F.coalesce("group", "id").alias("group"))
    place = F.struct("doc_id", "tie", "line")
    # the first place of each group, with partial minima before anything moves
    first = grouped.groupBy("group").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = written(first, "lines-first")  # so that the join below can split a line of very many places
    later = grouped.join(first, "group").where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set("line")).alias("remove"))


def dedup_lines(docs: DataFrame, lines_column: str = "n_lines", removed_column: str = "n_removed") -> DataFrame:
    """``docs`` without repeated lines in text, and the numbers of all and of removed lines.

    Texts travel packed to where the numbers of their lines are.
    """
    kept = [c for c in docs.columns if c not in ("text", lines_column, removed_column)]
    inner = "_" * (1 + max(map(len, docs.columns)))  # before a name: no column of the input has it
    tie_, body_, remove_, id_, other_ = (inner + name for name in ("tie", "body", "remove", "id", "other"))
    tied = docs.select(*kept, "text", F.xxhash64("text").alias(tie_))

    def pack(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            body = [packer.compress(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], batch.column(tie_), pa.array(body, pa.binary())], [*kept, tie_, body_])

    def cut(batches):
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            first, size, done = 0, 0, []
            for i in range(batch.num_rows):
                text = opener.decompress(batch.column(body_)[i].as_py()).decode()
                every = text.split("\n")
                gone = set(batch.column(remove_)[i].as_py() or ())
                text = "\n".join(line for k, line in enumerate(every) if k not in gone) if gone else text
                done.append((text, len(every), len(gone)))
                size += len(text)
                if size > 16 * BLOCK or i == batch.num_rows - 1:
                    columns = [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
                    rest = batch.slice(first, len(done))
                    yield pa.RecordBatch.from_arrays([*[rest.column(c) for c in kept], *columns], [*kept, "text", lines_column, removed_column])
                    first, size, done = i + 1, 0, []

    plain = docs.select(kept).schema
    packed = tied.mapInArrow(pack, StructType([*plain, StructField(tie_, LongType()), StructField(body_, BinaryType())]))
    lines = removed_lines(tied.select("doc_id", F.col(tie_).alias("tie"), "text"))
    lines = lines.select(F.col("doc_id").alias(id_), F.col("tie").alias(other_), F.col("remove").alias(remove_))
    joined = packed.join(lines, packed["doc_id"].eqNullSafe(lines[id_]) & (packed[tie_] == lines[other_]), "left")
    result = StructType([*plain, StructField("text", StringType()), StructField(lines_column, LongType()), StructField(removed_column, LongType())])
    return joined.select(*kept, body_, remove_).mapInArrow(cut, result)
