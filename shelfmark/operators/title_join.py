"""Exact Jaro-Winkler join of two title columns without comparing all pairs by UDF.

Jaro-Winkler is J + 0.1 * p * (1 - J) with p = shared first characters, at most
four. A pair with similarity >= s and exactly p shared first characters therefore
needs J >= (s - 0.1 p) / (1 - 0.1 p), which is far stricter for small p. So each
title takes part in one class per p, keyed by its first p characters, and a pair is
looked at in the one class of its true p.

With k = 3 J - 1, J also bounds the shared characters c of lengths m and n:
c / m + c / n >= k, hence n >= (k - 1) m. Length bands of that ratio make the length
an equality key too: a partner's band differs by at most one.

Within a key, an upper bound of the similarity from 128-bit character signatures is
tested inside the join, in generated code; only what passes reaches the UDF. Every
bound is lossless, so the result equals that of the full comparison.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.similarity import PREFIX_CHARS, PREFIX_GAIN, title_similarity
from shelfmark.operators.gridjoin import grid_join

SLACK = 1e-9
ALL_CLASSES = range(PREFIX_CHARS + 1)
_CLASS_KEYS = ["_shared", "_head", "_band"]


def _features(titles: DataFrame, title: str, side: str) -> DataFrame:
    """Add the length and the character signature of every non-empty title.

    The signature holds the hashes of (character, occurrence), folded into 2 x 64 bits.
    """
    chars = f"array_sort(transform(sequence(1, length({title})), i -> substr({title}, i, 1)))"
    hashes = "transform(_chars, (c, i) -> xxhash64(c, i - array_position(_chars, c)))"
    bit = "shiftleft(1L, cast(pmod(shiftright(h, 1), 64) as int))"
    half = "aggregate(_hashes, 0L, (bits, h) -> if(pmod(h, 2) = {n}, bits | {bit}, bits)) as {side}_sig{n}"
    return (
        titles.where(f"length({title}) > 0")
        .selectExpr("*", f"{chars} as _chars")
        .selectExpr("*", f"{hashes} as _hashes")
        .selectExpr(
            *titles.columns,
            f"length({title}) as {side}_len",
            f"1D / length({title}) as {side}_per_char",
            *[half.format(n=n, bit=bit, side=side) for n in (0, 1)],
        )
    )


def _bands(length: str, similarity: float, shared: int, repeat: bool) -> str:
    """Length bands of a title in a class: its own, or the neighbouring ones as well."""
    gain = PREFIX_GAIN * shared
    ratio = 3 * (similarity - gain) / (1 - gain) - 2
    if ratio <= 0.05:
        return "array(0)"  # too loose a class to bound lengths
    width = -math.log(min(ratio, 0.95)) * 1.001
    band = f"cast(floor(ln({length}) / {width!r}D) as int)"
    return f"sequence({band} - 1, {band} + 1)" if repeat else f"array({band})"


def _class_keys(
    df: DataFrame, title: str, side: str, similarity: float, repeat: bool, classes: Iterable[int]
) -> DataFrame:
    """One row per class the title can be in, and per band if ``repeat``."""
    length = f"{side}_len"
    entries = ", ".join(
        f"if({length} >= {p}, named_struct('_shared', {p}, '_head', left({title}, {p}), "
        f"'{side}_next', substr({title}, {p + 1}, 1), '_bands', {_bands(length, similarity, p, repeat)}), null)"
        for p in classes
    )
    return df.selectExpr("*", f"inline(array_compact(array({entries})))").selectExpr(
        *df.columns, "_shared", "_head", f"{side}_next", "explode(_bands) as _band"
    )


def _condition(needed: str) -> str:
    """The pair is in its true class and may reach the similarity it needs."""
    missing = "bit_count({x}_sig0 & ~{y}_sig0) + bit_count({x}_sig1 & ~{y}_sig1)"
    common = (
        f"least(_a_len - ({missing.format(x='_a', y='_b')}), _b_len - ({missing.format(x='_b', y='_a')}))"
    )
    jaro = f"({common} * (_a_per_char + _b_per_char) + 1D) / 3D"
    # Where both titles have ended they are equal, and this is the class of their length.
    true_class = f"(_shared = {PREFIX_CHARS} OR _a_next <> _b_next OR _a_next = '')"
    return f"1D - (1D - {jaro}) * (1D - {PREFIX_GAIN}D * _shared) >= {needed} - {SLACK}D AND {true_class}"


def title_pairs(
    left: DataFrame,
    right: DataFrame,
    titles: tuple[str, str],
    threshold: float,
    need: str | None = None,
    spread: tuple[str, str] | None = None,
    scope: list[str] = (),
    keep: str | None = None,
    cell_rows: int = 8192,
    classes: Iterable[int] = ALL_CLASSES,
) -> DataFrame:
    """All row pairs with title similarity >= ``threshold`` (and >= column ``need``).

    ``scope`` are further equality columns, ``keep`` a further test made inside the
    join, ``spread`` the columns that tell the rows of a hot key apart. Adds
    ``similarity``. Rows with an empty title have no pair. ``classes`` limits the
    result to pairs with these numbers of shared first characters (four means any more).
    """
    if not 0 < threshold <= 1:
        raise ValueError("the title threshold must lie above 0 and not above 1")
    a = _class_keys(_features(left, titles[0], "_a"), titles[0], "_a", threshold, False, classes)
    b = _class_keys(_features(right, titles[1], "_b"), titles[1], "_b", threshold, True, classes)
    needed = f"{threshold!r}D" if need is None else f"greatest({threshold!r}D, {need})"
    condition = _condition(needed)
    if keep:
        condition += f" AND ({keep})"
    pairs = grid_join(a, b, [*scope, *_CLASS_KEYS], condition, spread or titles, cell_rows)
    names = [c for c in dict.fromkeys([*left.columns, *right.columns])]
    similarity = title_similarity(F.col(titles[0]), F.col(titles[1])).alias("similarity")
    return pairs.select(*names, similarity).where(
        f"similarity >= {threshold!r}D" + (f" AND similarity >= {need} - {SLACK}D" if need else "")
    )
