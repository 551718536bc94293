"""Near-duplicate documents by SimHash fingerprints in a Gray-order hierarchical index.

A fingerprint has 64 bits, each the majority over the hashes of all word shingles of the
text, repeats included. Documents are linked if their fingerprints differ in at most
``WITHIN`` bits, and a component is all that links reach.

Equal fingerprints are one entry. Two fingerprints that differ in three bits agree in one
of four blocks of 16 bits, so each is entered four times, rotated so that another block
stands first, and compared only with entries of the same first block. Spark sorts the
entries by Gray rank (neighbours in Gray order differ in few bits) in one range
partitioning and cuts every partition into pages of ``PAGE`` entries. A page is an index:
leaves of ``LEAF`` entries in a row, under nodes of ``FAN`` leaves. A node holds the bits
in which all below it agree; a leaf only those that its node does not hold yet. A pair of
nodes adds up the differences in what both hold, a pair of leaves adds its own to that of
their nodes, and as soon as the sum is over the limit the whole group is left out.

A block that goes over several pages is compared page by page, each pair of pages a row of
its own, after the same test on what the entries of the block agree in on either page;
where a block has very many pages, pages are tested in groups first. So no task ever holds
more than two pages, and no pair is lost. A page gives links of a spanning forest, not all
pairs; distributed union-find joins them.

Defined cases: a null text is empty; words end at blanks and at control characters from
tab to return; a text with fewer words than a shingle is one shingle, one without words
has fingerprint zero, which is linked like any other; every row gives one row, repeated
ones too; a component is named by its smallest doc_id (null only if it has no other); an
empty table gives an empty result; further columns are ignored. Texts are taken whole,
as many shingles at a time as ``STEP`` allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import groups
from shelfmark.llm.blocks import U64, blank_fold, ranges, row_blocks, text_bytes
from shelfmark.session import discard, shuffle_partitions, written

WORDS, SEED = 3, 42
WITHIN = 3
BLOCKS = 4
PAGE, LEAF, FAN = 1024, 16, 8
#: Shingles, and bytes of text, that are worked on at a time.
STEP, BYTES = 1 << 16, 4 << 20
#: Leaf pairs that are compared at a time.
PAIRS = 1 << 12


# ---- fingerprints -------------------------------------------------------------------


def _lower() -> np.ndarray:
    table = np.arange(256).astype(np.uint8)
    table[0x41:0x5B] += 0x20
    return table


LOWER, _SEEN = _lower(), blank_fold() != 0


def shingle_bits(data: np.ndarray, offsets: np.ndarray, whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of text bytes: how often each bit is set in a shingle's hash, the number of
    shingles, and the first bytes of all words. If ``whole``, a text with few words is one shingle."""
    n = len(offsets) - 1
    seen = _SEEN[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = seen[:-1], seen[1:]
    inner = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    before[inner], after[inner - 1] = False, False
    start, end = np.flatnonzero(seen & ~before), np.flatnonzero(seen & ~after) + 1
    ones = np.zeros((n, 64), np.int64)
    if not len(start):
        return ones, np.zeros(n, np.int64), start
    # all words in lower case, one blank after each
    size = end - start
    line = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    first = np.cumsum(size + 1) - (size + 1)
    line[ranges(first, size)] = LOWER[data[ranges(start, size)]]
    text = line.tobytes()
    last = first + size
    row = np.searchsorted(offsets, start, "right") - 1
    count = np.bincount(row, minlength=n)
    begin = np.cumsum(count) - count
    # a shingle begins at every word that has enough words behind it, or opens a short text
    left = begin[row] + count[row] - np.arange(len(row))
    opens = np.flatnonzero((left >= WORDS) | ((np.arange(len(row)) == begin[row]) & whole))
    a, b = first[opens], last[np.minimum(opens + WORDS, (begin + count)[row[opens]]) - 1]
    owner = row[opens]
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(opens), STEP):
        part = slice(k, k + STEP)
        hashes = np.fromiter((digest(text[i:j], SEED) for i, j in zip(a[part].tolist(), b[part].tolist(), strict=True)), U64, len(a[part]))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.append(True, owner[part][1:] != owner[part][:-1]))
        ones[owner[part][heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    return ones, np.bincount(owner, minlength=n), start


def majority(ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(U64).ravel()


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each row of text bytes."""
    if len(offsets) == 2 and len(data) > BYTES:
        return long_fingerprint(data)
    ones, total, _ = shingle_bits(data, offsets)
    return majority(ones, total)


def long_fingerprint(data: np.ndarray) -> np.ndarray:
    """The fingerprint of one text, piece by piece; a piece begins with the last words of the one before."""
    ones, total, at, reach = np.zeros((1, 64), np.int64), np.zeros(1, np.int64), 0, BYTES
    while True:
        stop = min(len(data), at + reach)
        if stop < len(data):  # after the last blank
            blank = np.flatnonzero(~_SEEN[data[at:stop]])
            stop = at + int(blank[-1]) + 1 if len(blank) else at
        piece = data[at:stop]
        some, n, start = shingle_bits(piece, np.array([0, len(piece)]), whole=at == 0 and stop == len(data))
        if stop < len(data) and len(start) <= WORDS:  # words of a length beyond the piece
            reach *= 2
            continue
        ones, total = ones + some, total + n
        if stop == len(data):
            return majority(ones, total)
        at, reach = at + int(start[1 - WORDS]), BYTES


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (64 bits as a signed number) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in row_blocks(offsets, BYTES):
                at = offsets[first : last + 1] - offsets[first]
                fp = fingerprints(data[offsets[first] : offsets[last]], at)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


# ---- Gray order ---------------------------------------------------------------------


def rotated(fp: Column, block: int) -> Column:
    """The bits turned round so that ``block`` stands first."""
    turn = 16 * block
    return fp if not turn else F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn))


def gray_rank(bits: Column) -> Column:
    """Place of the bits in Gray order, as a signed number of the same order."""
    for k in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, k))
    return bits.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def unranked(rank: np.ndarray) -> np.ndarray:
    """The bits at places in Gray order."""
    rank = rank.view(U64) ^ U64(1 << 63)
    return rank ^ (rank >> U64(1))


# ---- one page as an index -----------------------------------------------------------


class Index:
    """Leaves and nodes over entries in Gray order: the bits in which they agree."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.first = np.arange(0, len(entries), LEAF)
        self.leaf_bits, leaf_mask = self._agreed(self.first)
        node_first = self.first[::FAN]
        self.node_bits, self.node_mask = self._agreed(node_first)
        self.node = np.arange(len(self.first)) // FAN
        self.mask = leaf_mask
        #: what the leaf holds beyond its node
        self.rest = leaf_mask & ~self.node_mask[self.node]

    def _agreed(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        every, some = np.bitwise_and.reduceat(self.entries, first), np.bitwise_or.reduceat(self.entries, first)
        return every, ~(every ^ some)


def near_leaves(one: Index, two: Index) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves that may hold a pair within the limit."""
    far = np.bitwise_count((one.node_bits[:, None] ^ two.node_bits[None]) & one.node_mask[:, None] & two.node_mask[None])
    a, b = np.nonzero(far <= WITHIN)
    gone = far[a, b].astype(np.int64)
    # all leaves of one node with all of the other
    wide = np.minimum(FAN, len(one.first) - a * FAN), np.minimum(FAN, len(two.first) - b * FAN)
    many = wide[0] * wide[1]
    pair = np.repeat(np.arange(len(a)), many)
    place = ranges(np.zeros(len(a), np.int64), many)
    i, j = a[pair] * FAN + place // wide[1][pair], b[pair] * FAN + place % wide[1][pair]
    # only what both hold now and their nodes did not both hold before is counted
    held = one.node_mask[one.node[i]] & two.node_mask[two.node[j]]
    both = one.mask[i] & two.mask[j] & ~held
    gone = gone[pair] + np.bitwise_count((one.leaf_bits[i] ^ two.leaf_bits[j]) & both)
    return i[gone <= WITHIN], j[gone <= WITHIN]


def near_pairs(one: Index, two: Index) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of entries within the limit; of an index with itself each pair once."""
    i, j = near_leaves(one, two)
    if one is two:
        i, j = i[i <= j], j[i <= j]
    found = []
    for k in range(0, len(i), PAIRS):
        a = one.first[i[k : k + PAIRS], None] + np.arange(LEAF)
        b = two.first[j[k : k + PAIRS], None] + np.arange(LEAF)
        x, y = one.entries[np.minimum(a, len(one.entries) - 1)], two.entries[np.minimum(b, len(two.entries) - 1)]
        near = np.bitwise_count(x[:, :, None] ^ y[:, None, :]) <= WITHIN
        near &= (a < len(one.entries))[:, :, None] & (b < len(two.entries))[:, None, :]
        p, u, v = np.nonzero(near)
        found.append((a[p, u], b[p, v]))
    if not found:
        none = np.empty(0, np.int64)
        return none, none
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return (a[a < b], b[a < b]) if one is two else (a, b)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n things the smallest that the links reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        fresh = root.copy()
        np.minimum.at(fresh, root[a], low)
        np.minimum.at(fresh, root[b], low)
        while True:
            again = fresh[fresh]
            if (again == fresh).all():
                break
            fresh = again
        if (fresh == root).all():
            return root
        root = fresh


# ---- pages --------------------------------------------------------------------------


def pages_of(fps: DataFrame) -> DataFrame:
    """Rows (turn, page, entries, opens, closes): entries in Gray order, as bits of one rotation.

    opens and closes are the first block of the first and of the last entry.
    """
    turns = F.explode(F.array(*[F.struct(F.lit(k).alias("turn"), gray_rank(rotated(F.col("fp"), k)).alias("rank")) for k in range(BLOCKS)])).alias("_e")
    entries = fps.select(turns).select("_e.turn", "_e.rank")
    parts = shuffle_partitions(fps.sparkSession)
    ordered = entries.repartitionByRange(parts, "turn", "rank").sortWithinPartitions("turn", "rank").withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_turn, held_rank, part, made = np.empty(0, np.int32), np.empty(0, np.int64), 0, 0

        def give(turn: np.ndarray, rank: np.ndarray, last: bool):
            nonlocal made
            borders = np.append(np.flatnonzero(np.append(True, turn[1:] != turn[:-1])), len(turn))
            done = 0
            for first, end in zip(borders[:-1], borders[1:], strict=True):
                for k in range(first, end, PAGE):
                    stop = min(k + PAGE, end)
                    if stop == len(turn) and not last and stop - k < PAGE:
                        break
                    bits = unranked(rank[k:stop])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(turn[k : k + 1]), pa.array([(part << 32) + made]), pa.array([bits.tobytes()], pa.binary()), pa.array([int(bits[0] >> U64(48))]), pa.array([int(bits[-1] >> U64(48))])],
                        ["turn", "page", "entries", "opens", "closes"],
                    )
                    made, done = made + 1, stop
            return done

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                held_turn = np.concatenate([held_turn, batch.column("turn").to_numpy()])
                held_rank = np.concatenate([held_rank, batch.column("rank").to_numpy()])
                done = yield from give(held_turn, held_rank, False)
                held_turn, held_rank = held_turn[done:], held_rank[done:]
        if len(held_turn):
            yield from give(held_turn, held_rank, True)

    return ordered.mapInArrow(run, "turn int, page bigint, entries binary, opens bigint, closes bigint")


def _turned_back(bits: np.ndarray, turn: int) -> np.ndarray:
    turn = U64(16 * turn)
    return bits if not turn else (bits >> turn) | (bits << (U64(64) - turn))


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["id", "root"])


def links_within(pages: DataFrame) -> DataFrame:
    """A spanning forest of the links between entries of one page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for turn, body in zip(batch.column("turn").to_pylist(), batch.column("entries").to_pylist(), strict=True):
                bits = np.frombuffer(body, U64)
                index = Index(bits)
                root = forest(len(bits), *near_pairs(index, index))
                moved = np.flatnonzero(root != np.arange(len(bits)))
                own = _turned_back(bits, turn)
                yield _links(own[moved], own[root[moved]])

    return pages.select("turn", "entries").mapInArrow(run, "id bigint, root bigint")


def open_blocks(pages: DataFrame) -> DataFrame:
    """(turn, block, page, every, some): what the entries of a block agree in, for blocks at the ends of a page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for turn, page, body in zip(*(batch.column(c).to_pylist() for c in ("turn", "page", "entries")), strict=True):
                bits = np.frombuffer(body, U64)
                block = bits >> U64(48)
                for b in np.unique(block[[0, -1]]):
                    own = bits[block == b]
                    rows.append((turn, int(b), page, int(np.bitwise_and.reduce(own).view(np.int64)), int(np.bitwise_or.reduce(own).view(np.int64))))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["turn", "block", "page", "every", "some"])

    return pages.select("turn", "page", "entries").mapInArrow(run, "turn int, block bigint, page bigint, every bigint, some bigint")


def _may_meet(a: str, b: str) -> str:
    """Two groups may hold a pair within the limit, by the bits in which each agrees."""
    return f"bit_count(({a}.every ^ {b}.every) & ~({a}.every ^ {a}.some) & ~({b}.every ^ {b}.some)) <= {WITHIN}"


def page_pairs(nodes: DataFrame, fan: int = 64) -> DataFrame:
    """(turn, block, page, other): pairs of pages of a block that may hold a near pair.

    Pages of a block are numbered in order and put into groups of ``fan``, groups of groups
    and so on until a block has at most ``fan`` of them. Pairs are made at the top and opened
    level by level where the bits that the groups agree in allow it.
    """
    by = ["turn", "block"]
    sizes = nodes.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    nodes = written(nodes.join(sizes, by), "simhash-open")
    most = nodes.agg(F.max("n")).first()[0] or 0
    # a page's place in its block follows from the partition and the number in it, both in its name
    spots = nodes.select(*by, F.shiftright("page", 32).alias("part"), "page", "every", "some")
    starts = spots.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("low"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    placed = spots.join(starts, [*by, "part"]).select(*by, "page", "every", "some", (F.col("before") + F.col("page") - F.col("low")).alias("place"))
    levels = [written(placed, "simhash-nodes")]
    while most > fan:
        most = -(-most // fan)
        grouped = levels[-1].groupBy(*by, F.floor(F.col("place") / fan).alias("place")).agg(F.expr("bit_and(every) as every"), F.expr("bit_or(some) as some"))
        levels.append(written(grouped, "simhash-nodes"))
    top = levels[-1]
    pairs = top.alias("a").join(top.alias("b"), by).where(f"a.place <= b.place and {_may_meet('a', 'b')}").select(*by, F.col("a.place").alias("i"), F.col("b.place").alias("j"))
    for level in reversed(levels[:-1]):
        child = level.withColumn("up", F.floor(F.col("place") / fan))
        a = child.select(*by, F.col("up").alias("i"), F.struct("place", "every", "some").alias("a"))
        b = child.select(*by, F.col("up").alias("j"), F.struct("place", "every", "some").alias("b"))
        pairs = pairs.join(a, [*by, "i"]).join(b, [*by, "j"]).where(f"a.place <= b.place and {_may_meet('a', 'b')}").select(*by, F.col("a.place").alias("i"), F.col("b.place").alias("j"))
    named = levels[0].select(*by, "place", "page")
    one, two = named.withColumnsRenamed({"place": "i"}), named.withColumnsRenamed({"place": "j", "page": "other"})
    return pairs.where("i < j").join(one, [*by, "i"]).join(two, [*by, "j"]).select(*by, "page", "other")


def links_between(pages: DataFrame, pairs: DataFrame) -> DataFrame:
    """A spanning forest of the links between the entries of a block on two pages."""
    body = pages.select("page", "entries")
    other = pages.select(F.col("page").alias("other"), F.col("entries").alias("others"))
    met = pairs.join(body, "page").join(other, "other").select("turn", "block", "entries", "others")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for turn, block, one, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = (b[b >> U64(48) == U64(block)] for b in (np.frombuffer(one, U64), np.frombuffer(two, U64)))
                a, b = near_pairs(Index(x), Index(y))
                root = forest(len(x) + len(y), a, b + len(x))
                moved = np.flatnonzero(root != np.arange(len(root)))
                own = _turned_back(np.concatenate([x, y]), turn)
                yield _links(own[moved], own[root[moved]])

    return met.mapInArrow(run, "id bigint, root bigint")


def components(fps: DataFrame) -> DataFrame:
    """id and group (one name for each component) of the distinct fingerprints ``fps`` (fp) that have a link."""
    pages = written(pages_of(fps), "simhash-pages")
    within = links_within(pages)
    nodes = open_blocks(pages)
    pairs = written(page_pairs(nodes), "simhash-pairs")
    links = written(within.unionByName(links_between(pages, pairs)).distinct(), "simhash-links")
    discard(pages, pairs)
    return groups.components(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id of the component) of every row of ``docs``."""
    own = written(with_fingerprints(docs), "simhash-docs")
    # equal fingerprints of a task are one row before anything moves
    fps = written(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    found = components(fps.select("fp"))
    named = fps.join(found, fps["fp"] == found["id"], "left").select("fp", "least", F.coalesce("group", "fp").alias("group"))
    named = written(named, "simhash-named")
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    name = written(named.join(smallest, "group").select("fp", "component_id"), "simhash-names")
    discard(fps, named)
    return own.join(name, "fp").select("doc_id", "fp", "component_id")
