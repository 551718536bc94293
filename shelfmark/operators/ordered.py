"""Neighbours in time per key, without one task per key: a segmented scan.

A window over a key hands all rows of that key to one task. That is right for keys with few
rows, and these take it. A key with more rows than an even share of a task goes another way:

1. Rows of such keys are range-partitioned by key, time and ties together, so a key, and
   even a single moment of it, is spread over as many tasks as its rows ask for. The result
   is written once: a range partitioning draws its borders by sampling, and all that follows
   has to see the same ones.
2. Windows run per key and partition.
3. What crosses a border is carried: the first and last row of each key and partition, the
   number of its rows and its last known value meet per key in a second, tiny window. It has
   at most two rows for each partition of a key, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import shuffle_partitions, written

_PART, _KEY, _OWN = "_part", "_key", "_own"


def split_hot(df: DataFrame, keys: list[str], order: list[str], share: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys with at most ``share`` rows, and the rows of all others, if there are any, in
    range partitions numbered by ``_part``. ``share`` is an even share of a task if it is not given.

    Keys are counted by partial sums; null keys are keys.
    """
    counts = df.groupBy(F.struct(*keys).alias(_OWN)).agg(F.count(F.lit(1)).alias("_n"))
    parts = shuffle_partitions(df.sparkSession)
    counts = written(counts, "ordered-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    share = share or max(1, -(-total // parts))
    hot = counts.where(F.col("_n") > share).select(_OWN)
    if hot.isEmpty():
        return df, None
    # structs with null fields are equal by =, so null keys find their rows
    keyed = df.withColumn(_KEY, F.struct(*keys))
    met = keyed[_KEY] == hot[_OWN]
    calm = keyed.join(hot, met, "left_anti").drop(_KEY)
    ranged = keyed.join(hot, met, "left_semi").drop(_KEY).repartitionByRange(parts, *keys, *order)
    return calm, written(ranged.withColumn(_PART, F.spark_partition_id()), "ordered-ranges")


def _join_borders(rows: DataFrame, borders: DataFrame) -> DataFrame:
    """Join on (keys, part), null keys included."""
    carried = borders.withColumnRenamed(_KEY, f"_b{_KEY}")
    return rows.join(carried, rows[_KEY] == carried[f"_b{_KEY}"]).drop(f"_b{_KEY}")


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    time: str,
    ties: list[str] = (),
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    number: str | None = None,
    share: int | None = None,
) -> DataFrame:
    """Add ``lag`` / ``lead`` columns {new: column} and a row ``number`` per key.

    Rows are ordered by ``time`` and then ``ties``. ``share`` is the number of rows of a key
    that one task may have to take, an even share of all rows if it is not given.
    """
    previous, following = previous or {}, following or {}
    order = [time, *ties]
    calm, hot = split_hot(df, keys, order, share)
    plain = Window.partitionBy(*keys).orderBy(*order)
    added = {n: F.lag(c).over(plain) for n, c in previous.items()} | {n: F.lead(c).over(plain) for n, c in following.items()}
    if number:
        added[number] = F.row_number().over(plain)
    done = calm.withColumns(added)
    if hot is None:
        return done
    return done.unionByName(_scan_neighbours(hot, keys, order, previous, following, number).select(*done.columns))


def _scan_neighbours(hot: DataFrame, keys: list[str], order: list[str], previous: dict[str, str], following: dict[str, str], number: str | None) -> DataFrame:
    rows = hot.withColumn(_KEY, F.struct(*keys, _PART))
    within = Window.partitionBy(_KEY).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(_PART, *order)
    back = F.struct(*[F.col(c).alias(n) for n, c in previous.items()])
    ahead = F.struct(*[F.col(c).alias(n) for n, c in following.items()])
    inner = {"_first": F.lag(F.lit(True)).over(within).isNull(), "_last": F.lead(F.lit(True)).over(within).isNull()}
    if previous:
        inner["_back"] = F.lag(back).over(within)
    if following:
        inner["_ahead"] = F.lead(ahead).over(within)
    if number:
        inner["_rn"] = F.row_number().over(within)
    seen = rows.withColumns(inner)
    edges = seen.where("_first or _last")
    beyond = {}
    if previous:
        beyond["_back"] = F.coalesce("_back", F.lag(back).over(across))
    if following:
        beyond["_ahead"] = F.coalesce("_ahead", F.lead(ahead).over(across))
    joined = seen.where("not (_first or _last)").unionByName(edges.withColumns(beyond)) if beyond else seen
    final = [F.col("_back")[n].alias(n) for n in previous] + [F.col("_ahead")[n].alias(n) for n in following]
    if number:
        earlier = across.rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum(F.when(F.col("_last"), F.col("_rn"))).over(earlier), F.lit(0))
        sizes = edges.withColumn("_before", F.when(F.col("_first"), before)).where("_first").select(_KEY, "_before")
        joined = _join_borders(joined, sizes)
        final.append((F.col("_rn") + F.col("_before")).cast("int").alias(number))
    return joined.select(*[c for c in hot.columns if c != _PART], *final)


def with_last_known(
    df: DataFrame, keys: list[str], time: str, ties: list[str], value: Column, name: str, share: int | None = None
) -> DataFrame:
    """Add the last non-null ``value`` at or before each row, in order of ``time`` and ``ties``."""
    order = [time, *ties]
    calm, hot = split_hot(df.withColumn(name, value), keys, order, share)
    plain = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = calm.withColumn(name, F.last(name, ignorenulls=True).over(plain))
    if hot is None:
        return done
    rows = hot.withColumn(_KEY, F.struct(*keys, _PART))
    so_far = Window.partitionBy(_KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*[F.col(_KEY)[k] for k in keys]).orderBy(F.col(_KEY)[_PART]).rowsBetween(Window.unboundedPreceding, -1)
    known = F.when(F.col(name).isNotNull(), F.struct(*order))
    borders = (
        rows.groupBy(_KEY)
        .agg(F.max_by(name, known).alias("_value"))
        .select(_KEY, F.last("_value", ignorenulls=True).over(earlier).alias("_carried"))
    )
    inner = rows.withColumn("_inner", F.last(name, ignorenulls=True).over(so_far))
    carried = _join_borders(inner, borders).withColumn(name, F.coalesce("_inner", "_carried"))
    return done.unionByName(carried.select(*done.columns))
