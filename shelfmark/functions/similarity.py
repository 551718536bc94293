"""Similarity of titles (Jaro-Winkler) and of author sets (Jaccard)."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The functions travel with the tasks: executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the Jaro-Winkler definition: the shared prefix counts up to
# four characters, each adds a tenth, and only above a Jaro value of 0.7.
PREFIX_CHARS = 4
PREFIX_GAIN = 0.1
PREFIX_FROM = 0.7

# Both engines that check the results round here before they use a threshold.
DIGITS = 10

_CHUNK = 2048


def _char_codes(strings: np.ndarray) -> np.ndarray:
    width = max(strings.dtype.itemsize // 4, 1)
    codes = np.ascontiguousarray(strings).view(np.uint32).reshape(len(strings), width)
    top = codes.max(initial=0)
    return codes.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32)


def _lowest(bits: np.ndarray) -> np.ndarray:
    return bits & (~bits + np.uint64(1))


def _equal_positions(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row i: per pair the positions of ``b`` that hold character i of ``a``, as 64 bits."""
    # Pairs run along the last axis, so every operation works on long contiguous rows.
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    words = np.zeros((len(a), a.shape[1]), dtype=np.uint64)
    for start in range(0, len(b), 8):
        byte = np.zeros(a.shape, dtype=np.uint8)
        for j, row in enumerate(b[start : start + 8]):
            byte |= (a == row).view(np.uint8) << np.uint8(j)
        words |= byte.astype(np.uint64) << np.uint64(start)
    return words


def _matches_by_bits(a, b, n_left, n_right, reach) -> tuple[np.ndarray, np.ndarray]:
    """Matched characters and those out of order, for ``b`` of at most 64 characters."""
    equal = _equal_positions(a, b)
    return _matched([np.where(i < n_left, row, np.uint64(0)) for i, row in enumerate(equal)], n_right, reach)


def _matched(equal, n_right, reach) -> tuple[np.ndarray, np.ndarray]:
    """As ``_matches_by_bits``, from the positions of ``b`` that hold each character of ``a`` in turn."""
    one = np.uint64(1)
    free = np.where(n_right >= 64, ~np.uint64(0), (one << np.minimum(n_right, 63).astype(np.uint64)) - one)
    near = (one << np.minimum(reach + 1, 63).astype(np.uint64)) - one
    taken = np.zeros(len(free), dtype=np.uint64)
    hits = []
    for i, row in enumerate(equal):
        pick = _lowest(row & free & near)
        free ^= pick
        taken |= pick
        hits.append(pick != 0)
        near = (near << one) | (i < reach)
    m, moved = np.zeros((2, len(free)), dtype=np.int64)
    for row, hit in zip(equal, hits, strict=True):
        # The k-th matched character of one side faces the k-th of the other.
        facing = _lowest(taken) * hit
        moved += hit & ((row & facing) == 0)
        taken ^= facing
        m += hit
    return m, moved


def _front(codes: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Marked characters of each row, moved to the front in their order."""
    return np.take_along_axis(codes, np.argsort(~marked, axis=1, kind="stable"), axis=1)


def _matches_by_position(a, b, n_left, n_right, reach) -> tuple[np.ndarray, np.ndarray]:
    """As ``_matches_by_bits`` for any length."""
    widest = int(reach.max(initial=0))
    rows = np.arange(len(a))
    cols = np.arange(b.shape[1])
    hit_a = np.zeros(a.shape, dtype=bool)
    open_b = cols[None, :] < n_right[:, None]
    for i in range(a.shape[1]):
        lo, hi = max(i - widest, 0), min(i + widest + 1, b.shape[1])
        if lo >= hi:
            break
        fit = (b[:, lo:hi] == a[:, i : i + 1]) & open_b[:, lo:hi]
        fit &= np.abs(cols[None, lo:hi] - i) <= reach[:, None]
        at = fit.argmax(axis=1)
        found = fit[rows, at] & (i < n_left)
        hit_a[:, i] = found
        open_b[rows[found], at[found] + lo] = False
    hit_b = (cols[None, :] < n_right[:, None]) & ~open_b
    m = hit_a.sum(axis=1)
    width = min(a.shape[1], b.shape[1])
    differ = _front(a, hit_a)[:, :width] != _front(b, hit_b)[:, :width]
    return m, (differ & (np.arange(width)[None, :] < m[:, None])).sum(axis=1)


def _jaro_winkler_chunk(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    n_left, n_right = np.char.str_len(left), np.char.str_len(right)
    a, b = _char_codes(left), _char_codes(right)
    reach = np.maximum(np.maximum(n_left, n_right) // 2 - 1, 0)
    # The bits of a window must fit as well, so both sides have to be short.
    short = max(a.shape[1], b.shape[1]) <= 64
    m, moved = (_matches_by_bits if short else _matches_by_position)(a, b, n_left, n_right, reach)
    lead = min(PREFIX_CHARS, a.shape[1], b.shape[1])
    inside = np.arange(lead)[None, :] < np.minimum(n_left, n_right)[:, None]
    same = np.cumprod((a[:, :lead] == b[:, :lead]) & inside, axis=1).sum(axis=1)
    return _jaro_winkler_of(m, moved, n_left, n_right, same)


def _jaro_winkler_of(m, moved, n_left, n_right, same) -> np.ndarray:
    """From the matched characters, those out of order, the lengths, and the shared first characters."""
    safe = np.maximum(m, 1)
    jaro = (m / np.maximum(n_left, 1) + m / np.maximum(n_right, 1) + (m - moved // 2) / safe) / 3.0
    jaro = np.where(m > 0, jaro, 0.0)
    return np.where(jaro > PREFIX_FROM, jaro + PREFIX_GAIN * same * (1.0 - jaro), jaro)


class Spelled:
    """Strings of at most 64 characters, spelled out once for many comparisons."""

    def __init__(self, strings: list[str]):
        self.length = np.fromiter(map(len, strings), np.int64, len(strings))
        self.codes = np.zeros((int(self.length.max(initial=0)), len(strings)), np.uint32)  # one row per position
        inside = np.arange(len(self.codes)) < self.length[:, None]
        self.codes.T[inside] = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
        seen = np.zeros(int(self.codes.max(initial=0)) + 1, bool)
        seen[self.codes.T[inside]] = True
        # characters are numbered; the last number stands for all that do not occur
        self.kinds = int(seen.sum())
        self.number = np.append(np.where(seen, np.cumsum(seen) - 1, self.kinds), self.kinds)
        # where each character stands in each string
        self.places = np.zeros((len(strings), self.kinds + 1), np.uint64)
        rows = np.arange(len(strings))
        for place, own in enumerate(self.codes):
            here = rows[place < self.length]
            self.places[here, self.number[own[here]]] |= np.uint64(1) << np.uint64(place)

    def ids_in(self, other: Spelled) -> np.ndarray:
        """The characters as columns of ``other.places``."""
        ids = other.number[np.minimum(self.codes, len(other.number) - 1)]
        return np.where(np.arange(len(self.codes))[:, None] < self.length, ids, other.kinds)


def jaro_winkler_spelled(a: Spelled, b: Spelled, ids: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Jaro-Winkler of the strings x of ``a`` and y of ``b``; ``ids`` are ``a.ids_in(b)``."""
    n_left, n_right = a.length[x], b.length[y]
    places, start = b.places.ravel(), y * b.places.shape[1]
    equal = [places.take(start + row.take(x)) for row in ids]
    reach = np.maximum(np.maximum(n_left, n_right) // 2 - 1, 0)
    m, moved = _matched(equal, n_right, reach)
    same, alike = np.zeros(len(x), np.int64), np.ones(len(x), bool)
    for i in range(min(PREFIX_CHARS, len(a.codes), len(b.codes))):
        alike &= (a.codes[i][x] == b.codes[i][y]) & (i < n_left) & (i < n_right)
        same += alike
    return _jaro_winkler_of(m, moved, n_left, n_right, same)


def jaro_winkler_arrays(left, right) -> np.ndarray:
    """Jaro-Winkler of two equally long string sequences; 0.0 where one is null."""
    # Arrays of fixed width are made of titles of like length only, and of a bounded
    # number of characters together, so one long title costs only its own memory.
    a = pd.Series(left, dtype=object).fillna("").to_numpy()
    b = pd.Series(right, dtype=object).fillna("").to_numpy()
    out = np.zeros(len(a))
    size = np.fromiter((max(len(x), len(y), 1) for x, y in zip(a, b)), np.int64, len(a))
    order = np.argsort(size, kind="stable")
    start = 0
    while start < len(order):
        stop = start + max(1, min(_CHUNK, int(np.searchsorted(size[order[start:]] * np.arange(1, len(order) - start + 1), _CHUNK * 64, "right"))))
        pick = order[start:stop]
        out[pick] = _jaro_winkler_chunk(a[pick].astype(np.str_), b[pick].astype(np.str_))
        start = stop
    return out


@F.pandas_udf(DoubleType())
def _jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(jaro_winkler_arrays(left, right))


# Declared non-deterministic so that a filter on the result is not pushed below the
# projection, which would make Spark evaluate the function twice per pair.
_jaro_winkler = _jaro_winkler.asNondeterministic()


def title_similarity(left: Column, right: Column) -> Column:
    """Jaro-Winkler similarity, rounded before any threshold sees it."""
    return F.round(_jaro_winkler(left, right), DIGITS)


def author_set(authors: Column) -> Column:
    """Author list as a sorted set without null names; null is the empty set."""
    return F.coalesce(F.array_sort(F.array_distinct(F.array_compact(authors))), F.array().cast("array<string>"))


def author_overlap(left: Column, right: Column) -> Column:
    """Jaccard similarity of two author sets, 0.0 if one is empty."""
    shared = F.size(F.array_intersect(left, right))
    joint = F.size(F.array_union(left, right))
    return F.when(shared > 0, shared / joint).otherwise(F.lit(0.0))
