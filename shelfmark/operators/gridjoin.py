"""Equi-join that cuts hot keys into a grid of cells of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import shuffle_partitions


def _cut(df: DataFrame, hot: DataFrame, keys: list[str], own: str, own_cuts: str, other: str, other_cuts: str, spread: str):
    """Give each row its own line of the grid and repeat it along the other side's lines."""
    return df.join(hot, keys, "left").selectExpr(
        *df.columns,
        f"cast(pmod(xxhash64({spread}), coalesce({own_cuts}, 1)) as int) as {own}",
        f"explode(sequence(0, coalesce({other_cuts}, 1) - 1)) as {other}",
    )


def grid_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    condition: str,
    spread: tuple[str, str],
    cell_rows: int,
) -> DataFrame:
    """Inner join on ``keys`` and ``condition`` in which no task gets a whole hot key.

    A key with more than ``cell_rows`` rows on a side is cut: its left rows fall
    into lines by the hash of ``spread[0]``, its right rows into columns by
    ``spread[1]``, and every (line, column) cell is joined by itself. Each pair
    still meets in exactly one cell, so the result is that of the plain join.
    ``condition`` is tested inside the join: pairs that fail it are never emitted.
    Keys must not be null; the two sides share no other column names. A larger
    ``cell_rows`` repeats rows less, a smaller one gives more and shorter tasks.
    """
    sides = left.selectExpr(*keys, "1L as _left", "0L as _right").union(
        right.selectExpr(*keys, "0L as _left", "1L as _right")
    )
    hot = (
        sides.groupBy(*keys)
        .agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))
        .where(f"least(_left, _right) > 0 AND greatest(_left, _right) > {cell_rows}")
        .selectExpr(
            *keys,
            f"cast(ceil(_left / {cell_rows}) as int) as _lines",
            f"cast(ceil(_right / {cell_rows}) as int) as _columns",
        )
    )
    cells = [*keys, "_line", "_column"]
    # An explicit number of partitions: AQE would merge these small inputs into one
    # task by their bytes, while the work grows with the pairs.
    parts = shuffle_partitions(left.sparkSession)
    a = _cut(left, hot, keys, "_line", "_lines", "_column", "_columns", spread[0])
    b = _cut(right, hot, keys, "_column", "_columns", "_line", "_lines", spread[1])
    joined = a.repartition(parts, *cells).join(b.repartition(parts, *cells), cells)
    return joined.where(condition).drop("_line", "_column")
