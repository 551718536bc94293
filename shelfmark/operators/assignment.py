"""One-to-one matches that are stable: who loses a partner gets the next one.

A matching is stable if no two entries that are not matched with each other would both
rather be. Both sides rank a pair by its confidence, equal ones by a digest of what the
two entries say, so there is one order of all pairs and one stable matching. It is found by
rounds in which every pair that is the best left for both of its sides is taken. The digest
scatters equal pairs, so that long chains of ties do not make long chains of rounds.

Rows that say the same (ISBN, title, authors) are one entry with a number of places, however
many they are: copies are paired off by rank of id and never with each other one by one.
Pairs are made in layers of scores, from the best one down, and only between entries that
have a place left: what the best partners settle meets no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.similarity import author_set, title_similarity
from shelfmark.operators.gridjoin import grid_join
from shelfmark.operators.matching import SLACK, MatchConfig, prepare_side, with_scores
from shelfmark.operators.ordered import with_neighbours
from shelfmark.operators.title_join import title_pairs
from shelfmark.session import discard, written

#: Steps of score in which pairs are counted, for each whole number.
STEPS = 1000
#: Pairs that one task walks through; rounds would take longer by far.
FEW_PAIRS = 1 << 19
#: Pairs of a layer that are always worth making at once.
LAYER_PAIRS = 1 << 20

_SAYS = "concat_ws('|', coalesce({0}_isbn13, ''), {0}_title, array_join(array_sort(array_distinct(array_compact(coalesce({0}_authors, array())))), ','))"


def _entries(side: DataFrame, name: str) -> DataFrame:
    """(entry, id, isbn13, title, authors) of every row; an id counts once, with its first entry."""
    own = side.selectExpr(f"{_SAYS.format(name)} as entry", f"{name}_id as id", f"{name}_isbn13", f"{name}_title", f"{name}_authors")
    first = F.min_by(F.struct("entry", f"{name}_isbn13", f"{name}_title", f"{name}_authors"), "entry").alias("row")
    return own.groupBy("id").agg(first).select("id", "row.*")


def _places(entries: DataFrame, name: str) -> DataFrame:
    """Distinct entries with the number of their rows."""
    say = F.struct(f"{name}_isbn13", f"{name}_title", f"{name}_authors")
    return entries.groupBy(F.col("entry").alias(f"{name}_entry")).agg(F.min(say).alias("say"), F.count(F.lit(1)).alias(f"{name}_places")).select(f"{name}_entry", "say.*", f"{name}_places")


def _with_class(entries: DataFrame, name: str) -> DataFrame:
    """Entries with a digest of title and authors, all that a score depends on but the ISBN."""
    return entries.withColumn(f"{name}_class", F.md5(F.to_json(F.struct(f"{name}_title", author_set(F.col(f"{name}_authors"))))))


def scored_classes(one: DataFrame, two: DataFrame, config: MatchConfig) -> tuple[DataFrame, DataFrame]:
    """What pairs of entries (with their class) reach the least confidence, without making them.

    (source1_class, source2_class, score) of classes whose entries do so without a common ISBN, and
    (source1_entry, source2_entry, score) of entries with a common one. As in ``matching``, only an ISBN
    or a similar title makes a pair.
    """
    least = max(config.title_threshold, (config.min_confidence - config.author_weight) / config.title_weight if config.title_weight else 1.0) - SLACK
    kinds = [s.groupBy(f"{n}_class").agg(F.min(F.struct(f"{n}_title", f"{n}_authors")).alias("say")).select(f"{n}_class", "say.*", F.lit(None).cast("string").alias(f"{n}_isbn13")) for s, n in ((one, "source1"), (two, "source2"))]
    titles = [s.select(F.col(f"{n}_title").alias(t)).where(f"{n}_title <> ''").distinct() for s, n, t in ((one, "source1", "title_1"), (two, "source2", "title_2"))]
    near = title_pairs(*titles, ("title_1", "title_2"), min(max(least, SLACK), 1.0), cell_rows=config.cell_rows)
    by_title = near.join(kinds[0], F.col("title_1") == F.col("source1_title")).join(kinds[1], F.col("title_2") == F.col("source2_title"))
    by_title = by_title.withColumn("title_similarity", F.col("similarity"))
    same = one.join(two, F.col("source1_isbn13") == F.col("source2_isbn13"))
    same = same.withColumn("title_similarity", title_similarity(F.col("source1_title"), F.col("source2_title")))
    reached = f"confidence_score >= {config.min_confidence}D"
    score = F.col("confidence_score").alias("score")
    return (
        with_scores(by_title, config).where(reached).select("source1_class", "source2_class", score),
        with_scores(same, config).where(reached).select("source1_entry", "source2_entry", score),
    )


def paired_entries(classes: DataFrame, same: DataFrame, one: DataFrame, two: DataFrame, config: MatchConfig) -> DataFrame:
    """(source1_entry, source2_entry, score, tie) of all pairs of the given classes and of a common ISBN.

    A class of very many entries is spread over several tasks.
    """
    a, b = (s.select(f"{n}_class", f"{n}_entry", f"{n}_isbn13") for s, n in ((one, "source1"), (two, "source2")))
    left = classes.join(a, "source1_class").withColumnRenamed("source2_class", "class").drop("source1_class")
    right = b.withColumnRenamed("source2_class", "class")
    other = "not coalesce(source1_isbn13 = source2_isbn13, false)"
    met = grid_join(left, right, ["class"], other, ("source1_entry", "source2_entry"), config.cell_rows)
    pairs = met.select("source1_entry", "source2_entry", "score").unionByName(same)
    return pairs.withColumn("tie", F.md5(F.concat_ws("|", "source1_entry", "source2_entry")))


def scored_entries(one: DataFrame, two: DataFrame, config: MatchConfig) -> DataFrame:
    """(source1_entry, source2_entry, score, tie) of all pairs of distinct entries that reach the least confidence.

    The number of such pairs is what it is: titles that are all alike have many. ``stable_layers`` makes the few it needs.
    """
    one, two = _with_class(one, "source1"), _with_class(two, "source2")
    return paired_entries(*scored_classes(one, two, config), one, two, config)


def _walk(pairs: DataFrame) -> DataFrame:
    """What ``stable_rounds`` takes of some pairs (with their free and used places), by one pass from the best on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free: tuple[dict, dict] = ({}, {})
        used: tuple[dict, dict] = ({}, {})
        for batch in batches:
            taken = []
            for row in batch.to_pylist():
                names = row["source1_entry"], row["source2_entry"]
                for k, name in enumerate(names):
                    free[k].setdefault(name, row[f"free_source{k + 1}"])
                    used[k].setdefault(name, row[f"used_source{k + 1}"])
                n = min(free[k][name] for k, name in enumerate(names))
                if n > 0:
                    taken.append((*names, row["score"], n, *(used[k][name] for k, name in enumerate(names))))
                    for k, name in enumerate(names):
                        free[k][name] -= n
                        used[k][name] += n
            columns = list(zip(*taken, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["source1_entry", "source2_entry", "score", "n", "from1", "from2"])

    kinds = [pa.string(), pa.string(), pa.float64(), *[pa.int64()] * 3]
    ordered = pairs.repartition(1).sortWithinPartitions(F.desc("score"), "tie")
    return ordered.mapInArrow(run, "source1_entry string, source2_entry string, score double, n long, from1 long, from2 long")


def stable_rounds(pairs: DataFrame, places: tuple[DataFrame, DataFrame], most_rounds: int = 1000) -> tuple[DataFrame, int]:
    """Taken pairs (source1_entry, source2_entry, score, n, from1, from2) and the number of rounds.

    ``pairs`` has (source1_entry, source2_entry, score, tie), ``places`` the two sides'
    (entry, places) and how many of them are used already, if any. n is how many rows of the two
    entries are paired, from the places from1 and from2 on. Each round takes at least the best pair
    of all that are left; what is left in the end, up to FEW_PAIRS, is walked through by one task.
    """
    sides = ("source1", "source2")
    left = pairs
    for p, s in zip(places, sides, strict=True):
        used = F.col(f"{s}_used") if f"{s}_used" in p.columns else F.lit(0).cast("long")
        left = left.join(p.select(f"{s}_entry", (F.col(f"{s}_places") - used).alias(f"free_{s}"), used.alias(f"used_{s}")), f"{s}_entry")
    left = written(left, "stable-pairs")
    taken, rounds = None, 0
    while many := left.count():
        if rounds == most_rounds:
            raise RuntimeError(f"no stable matching within {most_rounds} rounds")
        rounds += 1
        if many <= FEW_PAIRS:
            now = written(_walk(left), "stable-taken")
            taken = now if taken is None else taken.unionByName(now)
            break
        order = F.struct(-F.col("score"), F.col("tie"))
        state = F.struct("score", *[f"{kind}_{s}" for s in sides for kind in ("free", "used")])
        first = left.groupBy("source1_entry").agg(F.min_by(F.struct("source2_entry", state.alias("state")), order).alias("best")).select("source1_entry", "best.*")
        second = left.groupBy("source2_entry").agg(F.min_by("source1_entry", order).alias("source1_entry"))
        mutual = first.join(second, ["source1_entry", "source2_entry"]).select("source1_entry", "source2_entry", "state.*")
        n = F.least("free_source1", "free_source2")
        now = written(mutual.select("source1_entry", "source2_entry", "score", n.alias("n"), F.col("used_source1").alias("from1"), F.col("used_source2").alias("from2")), "stable-taken")
        taken = now if taken is None else taken.unionByName(now)
        rest = left
        for s in sides:  # an entry is in one taken pair at most
            gone = F.coalesce("_n", F.lit(0))
            rest = rest.join(now.select(f"{s}_entry", F.col("n").alias("_n")), f"{s}_entry", "left")
            rest = rest.withColumns({f"free_{s}": F.col(f"free_{s}") - gone, f"used_{s}": F.col(f"used_{s}") + gone}).drop("_n")
        before, left = left, written(rest.where("free_source1 > 0 and free_source2 > 0").select(*left.columns), "stable-pairs")
        discard(before)
    discard(left)
    if taken is None:
        return pairs.select("source1_entry", "source2_entry", "score", *[F.lit(0).cast("long").alias(c) for c in ("n", "from1", "from2")]), 0
    return taken, rounds


def stable_layers(one: DataFrame, two: DataFrame, config: MatchConfig, most_pairs: int = LAYER_PAIRS) -> tuple[DataFrame | None, int]:
    """The result of ``stable_rounds`` over all pairs of the entries (with their places), without making all of them.

    One order of all pairs decides, so its better part can be settled first. Layers of scores go from the best
    one down; the pairs of a layer are made only between entries that still have a free place. A layer takes as many
    steps of score as have ``most_pairs`` pairs together or, if that is more, four for each entry left; one at least.
    Returns the taken pairs (None if there are none) and the number of pairs made.
    """
    sides = ("source1", "source2")
    free = [written(_with_class(s, n).withColumn(f"{n}_used", F.lit(0).cast("long")), "stable-free") for s, n in ((one, "source1"), (two, "source2"))]
    classes, same = (written(t, "stable-classes") for t in scored_classes(*free, config))
    step = F.floor(F.col("score") * STEPS).alias("step")
    taken, above, made = None, None, 0
    while True:
        rest = [t if above is None else t.where(F.floor(F.col("score") * STEPS) < above) for t in (classes, same)]
        sizes = [p.groupBy(f"{s}_class").agg(F.count(F.lit(1)).alias(f"n_{s}")) for p, s in zip(free, sides, strict=True)]
        of_classes = rest[0].join(sizes[0], "source1_class").join(sizes[1], "source2_class").groupBy(step).agg(F.sum(F.col("n_source1") * F.col("n_source2")).alias("n"))
        of_isbn = rest[1].groupBy(step).agg(F.count(F.lit(1)).alias("n"))
        counted = of_classes.unionByName(of_isbn).groupBy("step").agg(F.sum("n").alias("n")).orderBy(F.desc("step")).collect()  # a row for each step
        if not counted:
            break
        most, low, pairs = max(most_pairs, 4 * sum(p.count() for p in free)), None, 0
        for row in counted:
            if low is not None and pairs + row.n > most:
                break
            low, pairs = row.step, pairs + row.n
        layer = [t.where(F.floor(F.col("score") * STEPS) >= low) for t in rest]
        now, rounds = stable_rounds(paired_entries(*layer, *free, config), tuple(free))
        above, made = low, made + pairs
        if not rounds:
            continue
        taken = now if taken is None else taken.unionByName(now)
        before = free
        free = []
        for p, s, place in zip(before, sides, ("from1", "from2"), strict=True):
            gone = now.groupBy(f"{s}_entry").agg(F.max(F.col(place) + F.col("n")).alias("_used"))
            left = p.join(gone, f"{s}_entry", "left").withColumn(f"{s}_used", F.coalesce("_used", f"{s}_used")).drop("_used")
            free.append(written(left.where(f"{s}_used < {s}_places").select(*p.columns), "stable-free"))
        discard(*before)
    discard(*free, classes, same)
    return taken, made


def stable_match(df1: DataFrame, df2: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """(source1_id, source2_id, confidence_score): the stable one-to-one matching of two tables.

    Every id of either side is matched at most once. Rows without an id or a title take no
    part; an id that comes several times counts with the first of its entries.
    """
    one, two = (written(_entries(prepare_side(df, name), name), "stable-entries") for df, name in ((df1, "source1"), (df2, "source2")))
    places = tuple(written(_places(e, name), "stable-places") for e, name in ((one, "source1"), (two, "source2")))
    taken, _ = stable_layers(*places, config)
    if taken is None:
        return one.join(two, F.lit(False)).select(one["id"].alias("source1_id"), two["id"].alias("source2_id"), F.lit(0.0).alias("confidence_score"))
    # the rows of an entry by rank of id, an entry with very many rows in several tasks
    ranks = [with_neighbours(e.select("entry", "id"), ["entry"], "id", number="rank").select(F.col("entry").alias(f"{n}_entry"), F.col("id").alias(f"{n}_id"), F.col("rank").cast("long").alias(f"{n}_rank")) for e, n in ((one, "source1"), (two, "source2"))]
    spans = taken.withColumnRenamed("score", "confidence_score")
    first = spans.join(ranks[0], "source1_entry").where("source1_rank > from1 and source1_rank <= from1 + n")
    placed = first.withColumn("source2_rank", F.col("source1_rank") - F.col("from1") + F.col("from2"))
    return placed.join(ranks[1], ["source2_entry", "source2_rank"]).select("source1_id", "source2_id", "confidence_score")
