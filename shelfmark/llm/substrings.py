"""Removal of repeated 100-byte strings by a hash-compared suffix sort.

Windows are the 100-byte strings of all texts. Each window has an anchor, the 32 bytes in it
with the smallest hash (the leftmost of equal ones), so equal windows have equal anchors at
equal offsets. Windows in a row with one anchor form a run; its context is all bytes under
them. This cuts the corpus into about one row for 35 bytes:

1. ``anchor_rows``: anchor hash, context hash and place of each run. Contexts that a batch of
   documents repeats are settled there, before anything moves.
2. ``settle``: sorted by anchor and context, a run whose context came earlier is repeated.
   What differs from others with the same anchor, as where a shared passage begins or ends,
   goes on; all else is unique.
3. ``sort_contexts``: the contexts of one anchor are sorted as suffixes, to the right of the
   anchor and, reversed, to its left, by a mergesort whose comparisons find the common
   extension by binary search over prefix polynomial hashes. The extensions of neighbours
   are checked byte by byte; if one is wrong, the bytes themselves are sorted. From the two
   orders follows, for each offset, which windows are equal; all but the first repeat.
   Anchors with more than ``CROWD`` contexts take ``settle_crowded``: their windows are
   compared by 128-bit hashes in a distributed aggregate, so no task holds such a group.
4. ``remove``: repeated windows are joined to the texts and cut out.

Defined cases: a null text is empty; texts under 100 bytes are kept whole; rows of one
doc_id order by a 64-bit hash of their texts (two texts of one id share it with a chance of
2**-64), and rows that repeat an id and a text are one
document with equal results; a null doc_id comes first; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import U64, mix64, powers, ranges, row_blocks, text_bytes
from shelfmark.llm.groups import fixed_rows, runs
from shelfmark.session import written

WINDOW = 100
GRAM = 32
#: Places of an anchor in a window, and the bytes of a context to the left and in all.
PLACES = WINDOW - GRAM + 1
LEFT = PLACES - 1
WIDE = LEFT + WINDOW
#: Bytes looked at in one go, and bytes of documents settled among themselves.
PIECE, BATCH = 1 << 19, 16 << 20
CROWD = 20_000
_RNG = np.random.default_rng(100)
_VALUE = _RNG.integers(0, 1 << 64, 256, dtype=U64)
_OTHER = _RNG.integers(0, 1 << 64, 256, dtype=U64)
_BASE = U64(0xA24BAED4963EE407)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [powers(n, _BASE), powers(n, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes along the last axis: the hash of the first l values at place l."""
    up, _ = power_tables(values.shape[-1])
    out = np.zeros((*values.shape[:-1], values.shape[-1] + 1), U64)
    np.cumsum(values * up[: values.shape[-1]], axis=-1, out=out[..., 1:])
    return out


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, by doubling."""
    h, size = _VALUE[data], 1
    while size < GRAM:
        h = h[:-size] * U64(0x9E3779B97F4A7C15) + mix64(h[size:])
        size *= 2
    return mix64(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def window_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs of windows of a block: first window, number, bytes from it to the anchor, anchor hash, context hash."""
    parts = []
    whole = np.flatnonzero(np.diff(offsets) >= WINDOW)
    for a in range(0, len(data), PIECE):
        b = min(a + PIECE, len(data) - WINDOW + 1)
        if b <= a:
            break
        piece = data[a : b + WINDOW - 1]
        # starts of windows that lie within one text
        edge = np.zeros(b - a + 1, np.int64)
        low, high = np.clip(offsets[whole], a, b) - a, np.clip(offsets[whole + 1] - WINDOW + 1, a, b) - a
        np.add.at(edge, low, 1)
        np.add.at(edge, high, -1)
        valid = np.cumsum(edge[:-1]) > 0
        gram = gram_hashes(piece)
        places = U64((1 << 21) - 1)
        anchor = (sliding_min((gram & ~places) | np.arange(len(gram), dtype=U64), PLACES) & places).astype(np.int64)
        new = valid.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        last = valid.copy()
        last[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
        first, end = np.flatnonzero(new), np.flatnonzero(last)
        if not len(first):
            continue
        sums = prefix_sums(_OTHER[piece])
        context = (sums[end + WINDOW] - sums[first]) * power_tables(len(piece))[1][first]
        size = end - first + 1
        parts.append((first + a, size, anchor[first] - first, gram[anchor[first]], mix64(context + size.astype(U64))))
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(U64), none.astype(U64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def pack(place: np.ndarray, size: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Place, number of windows and way to the anchor as one number that orders by place."""
    return place << 14 | size << 7 | back


def unpack(loc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return loc >> 14, (loc >> 7) & 127, loc & 127


def join_spans(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans sorted by owner and start, those that touch or overlap as one (lengths are WINDOW at least)."""
    if not len(owner):
        return owner, start, end
    base = owner.astype(np.int64) * (int(end.max()) + 1)  # so that spans of two owners never meet
    reach = np.maximum.accumulate(base + end)
    opens = np.append(True, (owner[1:] != owner[:-1]) | (base[1:] + start[1:] > reach[:-1]))
    at = np.flatnonzero(opens)
    closes = np.append(at[1:], len(owner)) - 1
    return owner[at], start[at], (reach - base)[closes]


ROWS = "key bigint, context bigint, doc_id {0}, tie bigint, loc bigint, stop bigint"


def anchor_rows(docs: DataFrame) -> DataFrame:
    """Runs (key, context, doc_id, tie, loc), and spans that are settled (loc is the start, stop the end)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in row_blocks(offsets, BATCH):
                at = offsets[first : last + 1] - offsets[first]
                place, size, back, anchor, context = window_runs(data[offsets[first] : offsets[last]], at)
                part = batch.slice(first, last - first)
                # the documents of the block in their order; equal rows share a place
                ids, ties = part.column("doc_id"), part.column("tie").to_numpy()
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                number = ids.fill_null(0).to_numpy()
                order = np.lexsort((ties, number, known))
                same = np.append(False, (number[order][1:] == number[order][:-1]) & (known[order][1:] == known[order][:-1]) & (ties[order][1:] == ties[order][:-1]))
                doc = np.searchsorted(at, place, "right") - 1
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                twin = np.zeros(len(order), bool)
                twin[order] = same
                take = ~twin[doc]  # a row that repeats id and text adds nothing
                place, size, back, anchor, context, doc = (x[take] for x in (place, size, back, anchor, context, doc))
                place = place - at[doc]
                sort = np.lexsort((place, rank[doc], context, anchor))
                again = np.append(False, (anchor[sort][1:] == anchor[sort][:-1]) & (context[sort][1:] == context[sort][:-1])) if len(sort) else np.empty(0, bool)
                settled, fresh = sort[again], sort[~again]
                settled = settled[np.lexsort((place[settled], doc[settled]))]
                owner, start, stop = join_spans(doc[settled], place[settled], place[settled] + size[settled] - 1 + WINDOW)
                fresh = fresh[np.lexsort((place[fresh], doc[fresh]))]
                who = pa.array(np.concatenate([doc[fresh], owner]))
                empty = np.zeros(len(owner), np.int64)
                spread = mix64(owner.astype(U64) << U64(32) ^ start.astype(U64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([anchor[fresh].view(np.int64), spread])),
                        pa.array(np.concatenate([context[fresh].view(np.int64), empty])),
                        part.column("doc_id").take(who),
                        part.column("tie").take(who),
                        pa.array(np.concatenate([pack(place[fresh], size[fresh], back[fresh]), start])),
                        pa.array(np.concatenate([np.zeros(len(fresh), np.int64), stop])),
                    ],
                    ["key", "context", "doc_id", "tie", "loc", "stop"],
                )

    return docs.mapInArrow(run, ROWS.format(kind))


def settle(rows: DataFrame) -> DataFrame:
    """Settled spans (stop > 0), and the first run of each context whose anchor has several contexts.

    Rows stream by in order. Of a group (one anchor) only its first run waits, until a
    second context shows; a group of any size takes no memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.RecordBatch | None = None  # the first run of the group that is open
        before = None  # key and context of the row before
        for batch in batches:
            if not batch.num_rows:
                continue
            stop = batch.column("stop").to_numpy()
            if (stop > 0).any():
                yield batch.filter(pa.array(stop > 0))
                batch = batch.filter(pa.array(stop == 0))
                if not batch.num_rows:
                    continue
            key, context = batch.column("key").to_numpy(), batch.column("context").to_numpy()
            loc = batch.column("loc").to_numpy()
            new_key = np.append(before is None or key[0] != before[0], key[1:] != key[:-1])
            new_context = new_key | np.append(before is None or context[0] != before[1], context[1:] != context[:-1])
            # runs of a context seen before: settled
            seen = np.flatnonzero(~new_context)
            if len(seen):
                place, size, _ = unpack(loc[seen])
                out = batch.take(pa.array(seen))
                yield out.set_column(4, "loc", pa.array(place)).set_column(5, "stop", pa.array(place + size - 1 + WINDOW))
            # a second context of a group sends the group's first run on, and itself
            second = new_context & ~new_key
            group = np.cumsum(new_key)  # 0: the group that was open
            several = np.zeros(group[-1] + 1, bool)
            several[group[second]] = True
            if waiting is not None and several[0]:
                yield waiting
                waiting = None
            send = second | (new_key & several[group])
            if send.any():
                yield batch.filter(pa.array(send))
            start = np.flatnonzero(new_key)
            if len(start):
                waiting = None if several[group[-1]] else batch.slice(int(start[-1]), 1)
            before = key[-1], context[-1]

    ordered = rows.repartition("key").sortWithinPartitions("key", "context", F.col("doc_id").asc_nulls_first(), "tie", "loc")
    return ordered.mapInArrow(run, rows.schema)


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, tie and the packed text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            body = [packer.compress(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(body, pa.binary())], ["doc_id", "tie", "body"])

    return docs.mapInArrow(run, f"doc_id {kind}, tie bigint, body binary")


def contexts(docs: DataFrame, open_runs: DataFrame) -> DataFrame:
    """The open runs with their bytes, WIDE of them with the anchor at place LEFT and zeros around."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    each = open_runs.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("key", "loc")).alias("runs")).withColumnsRenamed({"doc_id": "_id", "tie": "_tie"})
    body = packed(docs)
    joined = body.join(each, body["doc_id"].eqNullSafe(each["_id"]) & (body["tie"] == each["_tie"])).select("doc_id", "tie", "body", "runs")

    def run(batches):
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(opener.decompress(batch.column("body")[i].as_py()), np.uint8)
                some = batch.column("runs")[i].values
                key, loc = some.field("key").to_numpy(), some.field("loc").to_numpy()
                place, size, back = unpack(loc)
                every = place[:, None] + back[:, None] - LEFT + np.arange(WIDE)[None]
                inside = (every >= place[:, None]) & (every < (place + size - 1 + WINDOW)[:, None])
                cut = np.where(inside, data[np.clip(every, 0, len(data) - 1)], 0).astype(np.uint8)
                n = len(key)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key), batch.column("doc_id").take(pa.array(np.full(n, i))), batch.column("tie").take(pa.array(np.full(n, i))), pa.array(loc),
                        pa.array([r.tobytes() for r in cut], pa.binary()),
                    ],
                    ["key", "doc_id", "tie", "loc", "bytes"],
                )

    return joined.mapInArrow(run, f"key bigint, doc_id {kind}, tie bigint, loc bigint, bytes binary")


def common_extension(sums: np.ndarray, limit: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many leading bytes rows i and j share, by binary search over their prefix hashes."""
    low, high = np.zeros(len(i), np.int64), np.minimum(limit[i], limit[j])
    while True:
        going = low < high
        if not going.any():
            return low
        middle = (low + high + 1) >> 1
        equal = sums[i, middle] == sums[j, middle]
        low, high = np.where(going & equal, middle, low), np.where(going & ~equal, middle - 1, high)


def suffix_order(table: np.ndarray, limit: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in suffix order within each group, and what each shares with the row before it.

    Rows of a group stand together. A bottom-up mergesort: at each level every row finds its
    place in the run beside its own by binary search, all rows at once.
    """
    n, width = table.shape
    sums = prefix_sums(_OTHER[table])
    begin = np.searchsorted(group, group)
    size = np.searchsorted(group, group, "right") - begin
    place = np.arange(n) - begin

    def before(i, j):
        """Whether row i is smaller than row j."""
        shared = common_extension(sums, limit, i, j)
        ends_i, ends_j = shared >= limit[i], shared >= limit[j]
        at = np.minimum(shared, width - 1)
        return np.where(ends_i | ends_j, ends_i & ~ends_j, table[i, at] < table[j, at])

    order, run = np.arange(n), 1
    while run < size.max(initial=1):
        base = place - place % (2 * run)
        left = place % (2 * run) < run
        low = np.where(left, np.minimum(base + run, size), base)
        high = np.where(left, np.minimum(base + 2 * run, size), np.minimum(base + run, size))
        start = low.copy()
        while True:
            going = np.flatnonzero(low < high)
            if not len(going):
                break
            middle = (low[going] + high[going]) >> 1
            mine, its = order[going], order[begin[going] + middle]
            # rows of the left run go before equal rows of the right run
            behind = np.where(left[going], before(its, mine), ~before(mine, its))
            low[going] = np.where(behind, middle + 1, low[going])
            high[going] = np.where(behind, high[going], middle)
        target = begin + base + (place - base - np.where(left, 0, run)) + (low - start)
        moved = np.empty(n, np.int64)
        moved[target] = order
        order = moved
        run *= 2
    first = place == 0

    def neighbours(order):
        shared = np.zeros(n, np.int64)
        rest = np.flatnonzero(~first)
        shared[rest] = common_extension(sums, limit, order[rest - 1], order[rest])
        return shared

    shared = neighbours(order)
    rest = np.flatnonzero(~first)
    i, j = order[rest - 1], order[rest]
    differ = (table[i] != table[j]) & (np.arange(width)[None] < shared[rest][:, None])
    at = np.minimum(shared[rest], width - 1)
    inside = shared[rest] < np.minimum(limit[i], limit[j])
    wrong = differ.any() or (inside & (table[i, at] >= table[j, at])).any() or (~inside & (limit[i] > limit[j])).any()
    if wrong:  # two strings met in one hash: take the bytes themselves
        words = [table[k, : limit[k]].tobytes() for k in range(n)]
        order = np.array(sorted(range(n), key=lambda k: (group[k], words[k], k)), np.int64)
        i, j = order[rest - 1], order[rest]
        unequal = (table[i] != table[j]) | (np.arange(width)[None] >= np.minimum(limit[i], limit[j])[:, None])
        shared = np.zeros(n, np.int64)
        shared[rest] = np.where(unequal.any(1), unequal.argmax(1), width)
    return order, shared


def repeated_windows(table: np.ndarray, size: np.ndarray, back: np.ndarray, group: np.ndarray) -> np.ndarray:
    """(rows, PLACES): whether the window that begins o bytes before the anchor came earlier in the group."""
    n = len(table)
    right, left = table[:, LEFT:], table[:, :LEFT][:, ::-1]
    reach = size - 1 - back + WINDOW
    order_r, shared_r = suffix_order(np.ascontiguousarray(right), reach, group)
    order_l, shared_l = suffix_order(np.ascontiguousarray(left), back, group)
    head = np.append(True, group[1:] != group[:-1])
    out = np.zeros((n, PLACES), bool)
    for o in range(PLACES):
        has = np.flatnonzero((o <= back) & (o > back - size))
        if len(has) < 2:
            continue
        class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
        class_r[order_r] = np.cumsum(head | (shared_r < WINDOW - o))
        class_l[order_l] = np.cumsum(head | (shared_l < o))
        key = class_r[has] * (n + 1) + class_l[has]
        later = np.ones(len(has), bool)
        later[np.unique(key, return_index=True)[1]] = False
        out[has[later], o] = True
    return out


SPANS = "doc_id {0}, tie bigint, start bigint, end bigint"


def _spans(batch: pa.Table, repeated: np.ndarray, place: np.ndarray, back: np.ndarray) -> pa.RecordBatch:
    """Runs of repeated windows as spans."""
    forward = np.zeros((len(repeated), PLACES + 2), np.int8)
    forward[:, 1:-1] = repeated[:, ::-1]  # by growing start: o from PLACES - 1 to 0
    step = np.diff(forward, axis=1)
    row, first = np.nonzero(step == 1)
    last = np.nonzero(step == -1)[1] - 1
    origin = (place + back)[row] - (PLACES - 1)
    take = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").combine_chunks().take(take), batch.column("tie").combine_chunks().take(take), pa.array(origin + first), pa.array(origin + last + WINDOW)], ["doc_id", "tie", "start", "end"]
    )


def sort_contexts(open_contexts: DataFrame) -> DataFrame:
    """Spans of the windows that repeat an earlier one with the same anchor."""
    kind = open_contexts.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for table, begins in runs(batches, ["key"]):
            count = np.diff(np.append(begins, len(table)))
            group = np.repeat(np.arange(len(begins)), count)
            place, size, back = unpack(table.column("loc").to_numpy())
            repeated = repeated_windows(fixed_rows(table.column("bytes"), np.uint8), size, back, group)
            yield _spans(table, repeated, place, back)

    ordered = open_contexts.repartition("key").sortWithinPartitions("key", F.col("doc_id").asc_nulls_first(), "tie", "loc")
    return ordered.mapInArrow(run, SPANS.format(kind))


def settle_crowded(open_contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many contexts: one row for each window, the first of each string by an aggregate."""
    kind = open_contexts.schema["doc_id"].dataType.simpleString()

    def explode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = fixed_rows(batch.column("bytes"), np.uint8)
            place, size, back = unpack(batch.column("loc").to_numpy())
            row = np.repeat(np.arange(len(place)), size)
            start = ranges(place, size)
            at = start - (place + back - LEFT)[row]
            down = power_tables(WIDE)[1]
            one, two = prefix_sums(_VALUE[table]), prefix_sums(_OTHER[table])
            h = [mix64((s[row, at + WINDOW] - s[row, at]) * down[at]).view(np.int64) for s in (one, two)]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1]), batch.column("doc_id").take(take), batch.column("tie").take(take), pa.array(start)], ["h1", "h2", "doc_id", "tie", "start"])

    rows = written(open_contexts.mapInArrow(explode, f"h1 bigint, h2 bigint, doc_id {kind}, tie bigint, start bigint"), "substrings-windows")
    where = F.struct("doc_id", "tie", "start")
    first = rows.groupBy("h1", "h2").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = rows.join(first, ["h1", "h2"]).where(~where.eqNullSafe(F.col("first")))
    return later.select("doc_id", "tie", "start", (F.col("start") + WINDOW).alias("end"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, tie, start, end of repeated windows of ``docs`` (doc_id, tie, text); spans may overlap."""
    found = written(settle(anchor_rows(docs)), "substrings-runs")
    settled = found.where("stop > 0").select("doc_id", "tie", F.col("loc").alias("start"), F.col("stop").alias("end"))
    open_runs = found.where("stop = 0")
    crowd = written(open_runs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select("key"), "substrings-crowded")
    bytes_ = contexts(docs, open_runs.select("doc_id", "tie", "key", "loc"))
    if crowd.isEmpty():
        return settled.unionByName(sort_contexts(bytes_))
    bytes_ = written(bytes_, "substrings-contexts")
    few, many = bytes_.join(crowd, "key", "left_anti"), bytes_.join(crowd, "key", "left_semi")
    return settled.unionByName(sort_contexts(few)).unionByName(settle_crowded(many))


def remove(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs`` (doc_id, text).

    With ``keep_text`` the remaining bytes as well: cuts may fall inside a character.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    tied = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    spans = written(repeated_spans(tied), "substrings-spans")
    each = spans.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans")).withColumnsRenamed({"doc_id": "_id", "tie": "_tie"})
    body = packed(tied)
    joined = body.join(each, body["doc_id"].eqNullSafe(each["_id"]) & (body["tie"] == each["_tie"]), "left").select("doc_id", "body", "spans")

    def run(batches):
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for body, cut in zip(batch.column("body"), batch.column("spans"), strict=True):
                data = opener.decompress(body.as_py())
                if not cut.is_valid:
                    out.append((len(data), 0, 0, data))
                    continue
                start, end = cut.values.field("start").to_numpy(), cut.values.field("end").to_numpy()
                order = np.argsort(start, kind="stable")
                _, start, end = join_spans(np.zeros(len(start), np.int64), start[order], end[order])
                edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(data), len(data) - len(kept), len(start), kept))
            columns = [pa.array([x[k] for x in out], pa.int64()) for k in range(3)]
            digest = pa.array([hashlib.sha256(x[3]).hexdigest() for x in out], pa.string())
            kept = pa.array([x[3] if keep_text else None for x in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, digest, kept], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = joined.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return done if keep_text else done.drop("kept")
