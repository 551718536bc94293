"""Gold dimensions: canonical books with history, and the category tree."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.functions.records import category_levels, surrogate_id
from shelfmark.operators.dedupe import keep_first
from shelfmark.operators.ordered import with_last_known, with_neighbours
from shelfmark.session import discard, written
from shelfmark.sources import keyed

# What makes a new version of a canonical book.
TRACKED = ["isbn13", "title", "authors", "primary_category", "source_ids"]


def _moment(run_ts: str | datetime) -> Column:
    return F.lit(run_ts).cast("timestamp")


def _members(pairs: DataFrame) -> DataFrame:
    """(source, source_id) of both sides of each pair with the ids they share."""
    natural = [F.col(f"source{i}_{part}") for i in (1, 2) for part in ("source", "id")]
    members = F.array(
        *[
            F.struct(
                F.col(f"source{i}_source").alias("source"), F.col(f"source{i}_id").alias("source_id"), F.lit(i).alias("side")
            )
            for i in (1, 2)
        ]
    )
    return pairs.select(
        F.inline(members),
        surrogate_id(*natural).alias("book_id"),
        F.concat_ws("_", "source1_id", "source2_id").alias("source_key"),
        F.col("source2_source").alias("other_source"),
        F.col("source2_id").alias("other_id"),
        F.col("source2_isbn13").alias("other_isbn13"),
        F.col("source2_authors").alias("other_authors"),
        F.col("source2_category").alias("other_category"),
        F.col("confidence_score").alias("match_score"),
    )


def _single_id(rows: DataFrame) -> Column:
    """From source and id; a row without an id is known by its content."""
    content = [c for c in ("content_hash", "isbn13", "title", "authors", "category_path") if c in rows.columns]
    content = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    return F.when(F.col("source_id").isNull(), surrogate_id(F.col("source"), F.col("source_id"), content)).otherwise(surrogate_id("source", "source_id"))


def _single_key() -> Column:
    return F.concat_ws("_", F.col("source_id"), F.lit("single"))


def book_ids(matches: DataFrame) -> DataFrame:
    """(source, source_id) -> (book_id, source_key), unique per source row; ``matches`` are one to one."""
    return _members(matches).select("source", "source_id", "book_id", "source_key")


def with_book_ids(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Add the canonical ids to silver rows; rows without a partner get their own.

    ``matches`` are one to one (``match(..., one_to_one=True)``).
    """
    return (
        rows.withColumn("_single", _single_id(rows))
        .join(book_ids(matches), ["source", "source_id"], "left")
        .withColumn("book_id", F.coalesce("book_id", "_single"))
        .drop("_single")
        .withColumn("source_key", F.coalesce("source_key", _single_key()))
    )


def unmatched(rows: DataFrame, matches: DataFrame, side: int) -> DataFrame:
    """Rows of one source without a pair, rows with a null id included."""
    taken = matches.select(F.col(f"source{side}_id").alias("source_id"))
    return rows.join(taken, "source_id", "left_anti").select(*rows.columns)


def build_dimension(silver: DataFrame, matches: DataFrame, run_ts: str | datetime) -> DataFrame:
    """The first version of every canonical book.

    One left join covers matched and unmatched rows of both sources: the side-1 row
    of a pair carries the book, its side-2 row is absorbed, all others stand alone.
    ``silver`` must be unique per (source, source_id), ``matches`` one to one.
    """
    members = _members(matches)
    rows = silver.select("source", "source_id", "isbn13", "title", "authors", "category_path", _single_id(silver).alias("_single"))
    joined = rows.join(members, ["source", "source_id"], "left").where("coalesce(side, 1) = 1")
    paired = F.col("side").isNotNull()
    levels = category_levels(F.coalesce("category_path", "other_category"))
    own = F.create_map("source", F.array("source_id"))
    both = F.when(
        F.col("source") == F.col("other_source"), F.create_map("source", F.array("source_id", "other_id"))
    ).otherwise(F.create_map("source", F.array("source_id"), "other_source", F.array("other_id")))
    return joined.select(
        F.coalesce("book_id", "_single").alias("book_id"),
        F.coalesce("source_key", _single_key()).alias("source_key"),
        F.coalesce("isbn13", "other_isbn13").alias("isbn13"),
        F.when(paired, both).otherwise(own).alias("source_ids"),
        "title",
        F.coalesce("authors", "other_authors").alias("authors"),
        F.get(levels, F.lit(1)).alias("primary_category"),
        levels.alias("category_hierarchy"),
        _moment(run_ts).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version"),
        F.least(F.lit(1.0), F.coalesce("match_score", F.lit(1.0))).alias("confidence_score"),
        "match_score",
        F.when(paired, 2).otherwise(1).alias("source_count"),
    )


def _comparable(df: DataFrame, columns: list[str]) -> list[Column]:
    """Columns for a digest; maps have no order of their own, so their entries are sorted."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    return [F.array_sort(F.map_entries(c)).alias(c) if kinds[c] == "map" else F.col(c) for c in columns]


def merge_versions(
    current: DataFrame,
    incoming: DataFrame,
    run_ts: str | datetime,
    key: str = "book_id",
    tracked: list[str] = tuple(TRACKED),
    close_missing: bool = False,
) -> DataFrame:
    """Slowly changing dimension, type 2: the next state of ``current``.

    A key that ``incoming`` holds several times counts once, with the smallest of its
    tracked values; null keys are keys.

    A changed key has its open version closed at ``run_ts`` and a new one opened; a
    new key opens version 1, a key whose versions are all closed the next one; equal
    keys and closed versions stay as they are. With ``close_missing`` a key that
    ``incoming`` lacks is closed. Write the result to a
    new version of the table, never over the files being read.
    """
    columns = current.columns
    # maps have no order, so a digest of the tracked values settles which row counts
    incoming = keep_first(
        incoming.withColumn("_order", F.to_json(F.struct(*_comparable(incoming, list(tracked))), {"ignoreNullFields": "false"})), [key], [F.col("_order")]
    ).drop("_order")
    digest = F.md5(F.to_json(F.struct(*_comparable(current, list(tracked))), {"ignoreNullFields": "false"}))
    closed_keys = (
        current.groupBy(key)
        .agg(F.max("version").alias("_last"), F.bool_or("is_current").alias("_open"))
        .where("not _open")
        .select(F.col(key).alias("_closed"), "_last")
    )
    opened = incoming.join(closed_keys, F.col(key).eqNullSafe(F.col("_closed")), "left").withColumns(
        {
            "valid_from": _moment(run_ts).cast(current.schema["valid_from"].dataType),
            "valid_to": F.lit(None).cast(current.schema["valid_to"].dataType),
            "is_current": F.lit(True),
            "version": F.coalesce(F.col("_last"), F.lit(0)) + 1,
        }
    ).select(*[F.col(f.name).cast(f.dataType) for f in current.schema])
    old = current.where("is_current").select(
        F.col(key), digest.alias("_old_hash"), F.struct(*columns).alias("_old")
    )
    new = opened.select(F.col(key).alias("_key"), digest.alias("_new_hash"), F.struct(*columns).alias("_new"))
    both = old.join(new, F.col(key).eqNullSafe(F.col("_key")), "full_outer")
    changed = F.col("_old_hash") != F.col("_new_hash")
    gone = F.col("_new").isNull() & F.lit(close_missing)
    end = F.lit(run_ts).cast("timestamp").cast(current.schema["valid_to"].dataType)
    closed = F.col("_old").withField("valid_to", end).withField("is_current", F.lit(False))
    kept = F.when(changed | gone, closed).otherwise(F.col("_old"))
    added = F.when(F.col("_old").isNull(), F.col("_new")).when(
        changed, F.col("_new").withField("version", F.col("_old.version") + 1)
    )
    states = both.select(F.explode(F.array_compact(F.array(kept, added))).alias("_row")).select("_row.*")
    return current.where(~F.col("is_current")).unionByName(states)


def merge_into(
    spark: SparkSession,
    path: str,
    schema: StructType,
    incoming: DataFrame,
    run_ts: str | datetime,
    key: str = "book_id",
    tracked: list[str] = tuple(TRACKED),
    close_missing: bool = False,
    buckets: int = 64,
) -> list[str]:
    """``merge_versions`` on a stored dimension of ``schema`` (a table of ``sources.keyed``): the buckets rewritten.

    Only the buckets that hold a key of ``incoming`` are read (all of them to find missing
    keys), and of these only those in which something changes are replaced, so the same
    batch again changes no file.
    """
    keyed.check_layout(spark, path, (key,), buckets)
    batch = written(keyed.with_bucket(incoming, (key,), buckets), "merge-batch")
    stored = keyed.read(spark, path, schema)
    names = keyed.touched_buckets(batch)
    if stored is None:
        stored = spark.createDataFrame([], keyed.stored_schema(schema))
    part = stored if close_missing else stored.where(F.col(keyed.BUCKET).isin(names))
    after = merge_versions(part.select(*schema.names), batch.drop(keyed.DIGEST, keyed.BUCKET), run_ts, key, tracked, close_missing)
    after = written(keyed.with_bucket(after, (key,), buckets), "merge-after")
    changed = keyed.changed_buckets(part, after.select(*part.columns))
    if changed:
        keyed.replace(after.where(F.col(keyed.BUCKET).isin(changed)).select(*schema.names, keyed.DIGEST, keyed.BUCKET), path)
    discard(batch, after)
    return changed


def versions_from_log(
    log: DataFrame, keys: list[str], tracked: list[str], time: str, ties: list[str] = (), share: int | None = None
) -> DataFrame:
    """Type-2 versions from dated observations; only changes make a version.

    ``share`` is the number of rows of a key that one task may have to take (``ordered``).
    """
    before = {f"_was_{c}": c for c in tracked}
    seen = with_neighbours(
        log.withColumn("_seen", F.lit(True)), keys, time, ties, {**before, "_was_seen": "_seen"}, share=share
    )
    same = F.col("_was_seen").isNotNull()
    for column in tracked:
        same = same & F.col(column).eqNullSafe(F.col(f"_was_{column}"))
    changes = seen.where(~same).select(*keys, *tracked, F.col(time).alias("valid_from"), *[c for c in ties if c not in keys])
    changes = written(changes, "versions-changes")  # its keys are counted before it is numbered
    numbered = with_neighbours(
        changes, keys, "valid_from", ties, following={"valid_to": "valid_from"}, number="version", share=share
    )
    return numbered.select(
        *keys, *tracked, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), "version"
    )


def valid_at(versions: DataFrame, moment: str | datetime | Column) -> DataFrame:
    """The state of a dimension at one moment."""
    at = moment if isinstance(moment, Column) else F.lit(moment).cast(versions.schema["valid_from"].dataType)
    return versions.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))


def as_of(
    probes: DataFrame, versions: DataFrame, keys: list[str], time: str, attributes: list[str], share: int | None = None
) -> DataFrame:
    """Add to each probe the attributes of the version valid at its time, null if none.

    Versions and probes are put in one timeline and the last version is carried
    forward, so a key never pairs all its probes with all its versions.
    """
    state = F.struct(*attributes, "valid_to")
    moment = versions.schema["valid_from"].dataType
    never = F.lit("9999-12-31").cast(moment)
    # Of versions that start at the same moment the one that ends last counts.
    marks = versions.select(
        *keys,
        F.col("valid_from").alias("_at"),
        F.lit(0).alias("_kind"),
        F.coalesce("valid_to", never).alias("_end"),
        state.alias("_state"),
    )
    marks = written(marks, "as-of-marks")  # keys of the timeline are counted before it is read in order
    asks = probes.select(
        *keys,
        F.col(time).cast(moment).alias("_at"),
        F.lit(1).alias("_kind"),
        never.alias("_end"),
        F.struct(*probes.columns).alias("_probe"),
    )
    timeline = marks.unionByName(asks, allowMissingColumns=True)
    known = with_last_known(timeline, keys, "_at", ["_kind", "_end"], F.col("_state"), "_known", share)
    valid = F.col("_known.valid_to").isNull() | (F.col("_at") < F.col("_known.valid_to"))
    return known.where("_kind = 1").select(
        "_probe.*", *[F.when(valid, F.col(f"_known.{c}")).alias(c) for c in attributes]
    )


def category_dimension(paths: DataFrame, column: str = "category_path", separator: str = " > ") -> DataFrame:
    """Every node of the category tree once: id, name, parent, level, full path."""
    levels = paths.select(category_levels(F.col(column), separator).alias("_levels")).distinct()
    nodes = levels.select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("_levels")), lambda n: F.array_join(F.slice("_levels", 1, n), separator)
            )
        ).alias("full_path")
    ).distinct()
    parts = category_levels(F.col("full_path"), separator)
    parent = F.array_join(F.slice(parts, 1, F.size(parts) - 1), separator)
    return nodes.select(
        F.md5("full_path").alias("category_id"),
        F.element_at(parts, -1).alias("category_name"),
        F.when(F.size(parts) > 1, F.md5(parent)).alias("parent_category_id"),
        F.size(parts).alias("level"),
        "full_path",
    )


def source_split(canonical: DataFrame) -> DataFrame:
    """Books known to several sources and to one, counted in one pass."""
    return canonical.groupBy((F.col("source_count") > 1).alias("multi_source")).agg(
        F.count(F.lit(1)).alias("books"), F.avg("confidence_score").alias("avg_confidence")
    )
