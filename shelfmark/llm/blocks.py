"""Text of Arrow batches as numpy arrays: blocks of rows, words and their hashes.

Everything here works on the UTF-8 bytes of whole texts, in steps of bounded size, so the
memory of a task does not depend on how long a text is (beyond the text itself).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are turned into words at a time.
STEP = 1 << 20
U64 = np.uint64
_RNG = np.random.default_rng(20240229)
_VALUE = _RNG.integers(0, 1 << 64, 256, dtype=U64)
_BASE = U64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text.

    Called once a batch, so it also gives back what the pool keeps of batches before.
    """
    pa.default_memory_pool().release_unused()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def row_blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together, or of one row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def ascii_word_fold() -> np.ndarray:
    """Byte -> folded byte of words of digits, letters (A-Z as a-z) and all beyond ASCII; 0 separates."""
    fold = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        fold[low : high + 1] = np.arange(low, high + 1)
    fold[0x41:0x5B] = np.arange(0x61, 0x7B)
    return fold


def blank_fold() -> np.ndarray:
    """Byte -> itself, but 0 for blanks and the control characters from tab to return."""
    fold = np.arange(256).astype(np.uint8)
    fold[[0x20, *range(0x09, 0x0E)]] = 0
    fold[0] = 0xFF  # a zero byte belongs to a word; no UTF-8 text has the byte 0xFF
    return fold


def words(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of the rows: hash, row, first byte and end byte of each, in order.

    The hash is a polynomial in the folded bytes modulo 2**64, mixed. Two words meet in it
    with a chance of about 2**-64.
    """
    parts, a, n = [], 0, len(data)
    borders = np.unique(offsets)
    while a < n:
        b = min(n, a + STEP)
        if b < n:
            cut = np.flatnonzero(fold[data[a:b]] == 0)
            edge = int(borders[np.searchsorted(borders, b, "right") - 1])
            best = max(edge, a + int(cut[-1]) + 1 if len(cut) else 0)
            while best <= a and b < n:  # one word longer than a step
                c = min(n, b + STEP)
                cut = np.flatnonzero(fold[data[b:c]] == 0)
                at = np.searchsorted(borders, b, "right")
                edge = int(borders[at]) if at < len(borders) else n
                stop = b + int(cut[0]) + 1 if len(cut) else c
                best = min(stop, edge) if len(cut) or edge <= c or c == n else a
                b = c
            b = best
        folded = fold[data[a:b]]
        flag = folded != 0
        before, after = np.zeros(b - a, bool), np.zeros(b - a, bool)
        before[1:], after[:-1] = flag[:-1], flag[1:]
        inner = borders[np.searchsorted(borders, a, "right") : np.searchsorted(borders, b)] - a
        before[inner], after[inner - 1] = False, False
        starts, ends = np.flatnonzero(flag & ~before), np.flatnonzero(flag & ~after) + 1
        if len(starts):
            size = ends - starts
            first = np.cumsum(size) - size
            letters = _VALUE[folded[flag]]
            place = np.arange(len(letters)) - np.repeat(first, size)
            letters *= powers(int(size.max()))[place]
            parts.append((mix64(np.add.reduceat(letters, first)), starts + a, ends + a))
        a = b
    if not parts:
        none = np.empty(0, np.int64)
        return np.empty(0, U64), none, none, none
    h, s, e = (np.concatenate(x) for x in zip(*parts, strict=True))
    return h, np.searchsorted(offsets, s, "right") - 1, s, e


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. first[i] + size[i] - 1 for all i, one after another."""
    total = int(size.sum())
    if not total:
        return np.empty(0, np.int64)
    return np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)


def list_of(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    """A list column of the given sizes."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)
