"""Entity matching of two catalogues: exact ISBN, fuzzy title, author overlap.

The confidence of a pair is the sum of an ISBN, a title and an author score. The
reported row per side-1 id is its best pair, found without scoring all pairs:

1. similar titles that share an ISBN or an author,
2. any partner with the same ISBN,
3. partners with the same ISBN and a common author,
4. partners with the same title,
5. similar titles, only for what is left: entries whose best offer so far lies
   below the title weight, which no differing title without more can exceed.

Authors alone never reach the least confidence, so every pair that can be reported
is in one of these. An offer scores only what its group is about; that is a lower
bound of the pair's confidence, and exact in at least one group of the pair, so the
best offer is the best pair.

All groups hold distinct values with the smallest id of side 2, never rows: copies
of a record, however many, are compared once. 2 and 4 are plain aggregates.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.similarity import DIGITS, PREFIX_CHARS, author_overlap, author_set, title_similarity
from shelfmark.operators.block_join import ALL_CLASSES, NEAREST, Partners, best_by_blocks
from shelfmark.operators.dedupe import keep_first
from shelfmark.operators.title_join import SLACK, title_pairs
from shelfmark.session import written


@dataclass(frozen=True)
class MatchConfig:
    """Weights and thresholds; the defaults are fixed values of the data model."""

    title_threshold: float = 0.85
    isbn_weight: float = 1.0
    title_weight: float = 0.7
    author_weight: float = 0.3
    min_confidence: float = 0.6
    cell_rows: int = 8192

    def __post_init__(self):
        if self.author_weight >= self.min_confidence:
            raise ValueError("author overlap alone must not reach min_confidence: every shared author would match")
        if min(self.isbn_weight, self.title_weight, self.author_weight) < 0:
            raise ValueError("weights must not be negative")


# Silver column and its name on a match side.
_SIDE_COLUMNS = {
    "source": "source",
    "source_id": "id",
    "isbn13": "isbn13",
    "title": "title",
    "authors": "authors",
    "price_current": "price",
    "currency": "currency",
    "category_path": "category",
    "product_url": "url",
}
SCORE_COLUMNS = [
    "isbn_match_score", "title_similarity", "title_match_score", "author_match_score", "confidence_score", "match_type",
]


def prepare_side(df: DataFrame, side: str) -> DataFrame:
    """Nine columns with the side's prefix, titles in lower case, null titles dropped."""
    picked = [
        (f"lower({name})" if name == "title" else name) + f" as {side}_{short}"
        for name, short in _SIDE_COLUMNS.items()
    ]
    return df.selectExpr(*picked).where(f"{side}_title is not null and {side}_id is not null")


def with_scores(pairs: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """The six score columns of (source1, source2) rows that carry ``title_similarity``."""
    overlap = author_overlap(author_set(F.col("source1_authors")), author_set(F.col("source2_authors")))
    plain = [c for c in pairs.columns if c not in SCORE_COLUMNS]
    return (
        pairs.select("*", overlap.alias("_overlap"))
        .selectExpr(
            *plain,
            f"if(source1_isbn13 = source2_isbn13, {config.isbn_weight}D, 0D) as isbn_match_score",
            "title_similarity",
            f"if(title_similarity >= {config.title_threshold}D, title_similarity * {config.title_weight}D, 0D)"
            " as title_match_score",
            f"_overlap * {config.author_weight}D as author_match_score",
        )
        .selectExpr(
            "*",
            f"{_rounded('isbn_match_score + title_match_score + author_match_score')} as confidence_score",
            "case when isbn_match_score > 0 then 'exact_isbn' when title_match_score > 0 then 'fuzzy_title'"
            " else 'low_confidence' end as match_type",
        )
    )


def _rounded(score: str) -> str:
    return f"round({score}, {DIGITS})"


# What a side-1 row can look an offer up by: one digest per kind of group.
_ENTRY = "md5(to_json(named_struct('k', 'entry', 'i', isbn, 't', title, 'a', authors)))"
_PROFILE = "md5(to_json(named_struct('k', 'profile', 't', title, 'a', authors)))"
_ISBN_AUTHORS = "md5(to_json(named_struct('k', 'isbn authors', 'i', isbn, 'a', authors)))"
_ISBN = "md5(to_json(named_struct('k', 'isbn', 'i', isbn)))"
_TITLE = "md5(to_json(named_struct('k', 'title', 't', title)))"

_OVERLAP = (
    "coalesce(try_divide(cast(size(array_intersect(authors_1, authors_2)) as double),"
    " cast(size(array_union(authors_1, authors_2)) as double)), 0D)"
)


def _facts(side: DataFrame, name: str, *more: str) -> DataFrame:
    """What the confidence depends on, and the id."""
    return side.selectExpr(
        *more,
        f"{name}_id as id",
        f"{name}_isbn13 as isbn",
        f"{name}_title as title",
        f"coalesce(array_sort(array_distinct(array_compact({name}_authors))), array()) as authors",
    )


def _scoped(facts: DataFrame, side: int) -> DataFrame:
    """Distinct (scope, title, authors) with the smallest id; a scope is one ISBN or one author."""
    scopes = (
        "explode(concat(if(isbn is null, array(), array(concat('i', isbn))),"
        " transform(authors, x -> concat('a', x)))) as scope"
    )
    return (
        facts.selectExpr(scopes, f"title as title_{side}", f"authors as authors_{side}", "id")
        .groupBy("scope", f"title_{side}", f"authors_{side}")
        .agg(F.min("id").alias(f"id_{side}"))
    )


def _similar_in_scope(a: DataFrame, b: DataFrame, config: MatchConfig) -> DataFrame:
    """Offers 1. A pair with several common authors is taken at the first of them."""
    pairs = title_pairs(
        _scoped(a, 1),
        _scoped(b, 2),
        ("title_1", "title_2"),
        config.title_threshold,
        spread=("id_1", "id_2"),
        scope=["scope"],
        keep="scope like 'i%' OR scope = concat('a', array_min(array_intersect(authors_1, authors_2)))",
        cell_rows=config.cell_rows,
    )
    score = (
        f"if(scope like 'i%', {config.isbn_weight}D, 0D) + similarity * {config.title_weight}D"
        f" + {_OVERLAP} * {config.author_weight}D"
    )
    own = "if(scope like 'i%', substr(scope, 2), null) as isbn"
    return pairs.selectExpr(own, "title_1 as title", "authors_1 as authors", f"{_rounded(score)} as score", "id_2 as id").selectExpr(
        f"if(isbn is null, {_PROFILE}, {_ENTRY}) as key", "score", "id"
    )


def _same_isbn_and_author(a: DataFrame, b: DataFrame, config: MatchConfig) -> DataFrame:
    """Offers 3, between distinct author sets of an ISBN."""
    left = a.where("isbn is not null").selectExpr("isbn", "authors as authors_1").distinct()
    right = (
        b.where("isbn is not null")
        .groupBy("isbn", F.col("authors").alias("authors_2"))
        .agg(F.min("id").alias("id"))
    )
    pairs = left.selectExpr("*", "explode(authors_1) as author").join(
        right.selectExpr("*", "explode(authors_2) as author"), ["isbn", "author"]
    )
    score = f"{config.isbn_weight}D + {_OVERLAP} * {config.author_weight}D"
    return pairs.selectExpr("isbn", "authors_1 as authors", f"{_rounded(score)} as score", "id").selectExpr(
        f"{_ISBN_AUTHORS} as key", "score", "id"
    )


def _first_offers(a: DataFrame, b: DataFrame, config: MatchConfig) -> DataFrame:
    """Best of the offers 1 to 4 per key, combined before they are shuffled."""
    any_partner = b.where("isbn is not null").selectExpr(f"{_ISBN} as key", f"{config.isbn_weight}D as score", "id")
    # An empty title is similar to none, not even to itself.
    same_title = b.where("title <> ''").selectExpr(f"{_TITLE} as key", f"{config.title_weight}D as score", "id")
    offers = (
        _similar_in_scope(a, b, config)
        .union(_same_isbn_and_author(a, b, config))
        .union(any_partner)
        .union(same_title)
        .where(f"score >= {config.min_confidence}D")
    )
    return offers.groupBy("key").agg(F.expr("min(struct(-score as loss, id)) as offer"))


def best_titles(
    titles: DataFrame, others: DataFrame, threshold: float = 0.85, need: str | None = None
) -> DataFrame:
    """Per distinct ``title`` the most similar row of ``others``: (title, best).

    ``others`` has (title, id) with one row per title; the smaller id settles ties.
    Column ``need`` of ``titles`` may raise the threshold for single titles.

    Two steps. First each title looks at titles near it that have the same first characters. What they
    reach is what any other title then has to reach at least, which rules most of the many others out:
    pages and blocks of them at once, see ``block_join``. The second step looks at all of them.
    """
    wanted = titles.selectExpr("title", f"cast({need or threshold} as double) as need")
    kind = others.schema["id"].dataType.simpleString()
    partners = Partners.of(wanted, others)

    def step(left: DataFrame, classes: Iterable[int], nearest: int | None = None) -> DataFrame:
        near = best_by_blocks(left, partners, threshold, classes, nearest).selectExpr(
            "title_1 as title", f"struct(-round(similarity, {DIGITS}) as loss, cast(id_2 as {kind}) as id, title_2 as title) as best"
        )
        return near.where(f"-best.loss >= {threshold!r}D").groupBy("title").agg(F.min("best").alias("best"))

    close = written(step(wanted, (PREFIX_CHARS,), NEAREST), "titles")
    raised = wanted.join(close, "title", "left").selectExpr("title", "greatest(need, -best.loss) as need")
    found = close.unionByName(step(raised, ALL_CLASSES))
    partners.discard()
    return found.groupBy("title").agg(F.min("best").alias("best"))


def _best_offers(a: DataFrame, b: DataFrame, config: MatchConfig) -> DataFrame:
    """(entry, offer) for every distinct entry of side 1 with a reportable pair."""
    keys = f"explode(array({_ENTRY}, {_PROFILE}, {_ISBN_AUTHORS}, {_ISBN}, {_TITLE})) as key"
    entries = a.select("isbn", "title", "authors").distinct()
    so_far = (
        entries.selectExpr(f"{_ENTRY} as entry", "title", keys)
        .join(_first_offers(a, b, config), "key", "left")
        .groupBy("entry", "title")
        .agg(F.min("offer").alias("offer"))
        .selectExpr("entry", "title", "coalesce(-offer.loss, 0D) as score", "offer")
    )
    so_far = written(so_far, "offers")
    found = so_far.where("offer is not null").select("entry", "offer")
    still_open = so_far.where(f"score < {config.title_weight}D")
    if config.title_weight < config.min_confidence or still_open.isEmpty():
        return found

    open_titles = still_open.groupBy("title").agg((F.min("score") / config.title_weight).alias("need"))
    titles_2 = b.groupBy("title").agg(F.min("id").alias("id"))
    least = max(config.title_threshold, config.min_confidence / config.title_weight - SLACK)
    similar = (
        best_titles(open_titles, titles_2, least, "need")
        .selectExpr("title", f"struct({_rounded(f'best.loss * {config.title_weight}D')} as loss, best.id as id) as late")
        .where(f"-late.loss >= {config.min_confidence}D")
    )
    return (
        so_far.join(similar, "title", "left")
        .selectExpr("entry", "least(offer, late) as offer")
        .where("offer is not null")
    )


def match(df1: DataFrame, df2: DataFrame, config: MatchConfig = MatchConfig(), one_to_one: bool = False) -> DataFrame:
    """Best pair per side-1 id: nine columns of each side and six score columns.

    Equal confidence is settled by the smaller side-2 id. One row per side-1 id comes
    out whatever comes in: rows of one id may differ, then the best of their pairs
    counts, and of rows that score alike the first by title, ISBN and authors. With
    ``one_to_one`` a side-2 id keeps only the best of the side-1 ids that chose it.
    """
    side1, side2 = prepare_side(df1, "source1"), prepare_side(df2, "source2")
    a, b = _facts(side1, "source1"), _facts(side2, "source2")
    # the offers of an id's entries, reduced to the best one with its entry
    chosen = (
        a.selectExpr("id as source1_id", f"{_ENTRY} as _entry")
        .join(_best_offers(a, b, config), F.col("_entry") == F.col("entry"))
        .groupBy("source1_id")
        .agg(F.expr("min(struct(offer.loss as loss, offer.id as id, entry as entry)) as best"))
        .selectExpr("source1_id", "best.entry as _entry", "best.id as source2_id")
    )
    left = _with_entry(side1, "source1")
    own = left.join(chosen.withColumnRenamed("_entry", "_best"), "source1_id").where("_entry = _best").drop("_entry", "_best")
    rows = keep_first(own, ["source1_id"], _row_order(left, "source1"))
    # the rows of a side-2 id may differ as well: the best pair of each side-1 id stays
    pairs = rows.join(side2, "source2_id")
    similarity = title_similarity(F.col("source1_title"), F.col("source2_title"))
    scored = with_scores(pairs.withColumn("title_similarity", similarity), config)
    scored = scored.select(*side1.columns, *side2.columns, *SCORE_COLUMNS)
    scored = keep_first(scored, ["source1_id"], [-F.col("confidence_score"), *_row_order(scored, "source2")])
    return keep_one_to_one(scored) if one_to_one else scored


def _with_entry(side: DataFrame, name: str) -> DataFrame:
    facts = _facts(side.select("*", F.struct(*side.columns).alias("_row")), name, "_row")
    return facts.selectExpr(f"{_ENTRY} as _entry", "_row.*")


def _row_order(rows: DataFrame, name: str) -> list[Column]:
    """An order of rows of one id: by all their columns, as text."""
    columns = [c for c in rows.columns if c.startswith(f"{name}_")]
    return [F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})]


def keep_one_to_one(pairs: DataFrame) -> DataFrame:
    """For each side-2 id the row of highest confidence, then smallest side-1 id."""
    rest = [c for c in pairs.columns if c != "source2_id"]
    order = F.struct(-F.col("confidence_score"), F.col("source1_id"))
    return (
        pairs.groupBy("source2_id")
        .agg(F.min_by(F.struct(*rest), order).alias("_row"))
        .select("source2_id", "_row.*")
        .select(*pairs.columns)
    )


def top_matches(pairs: DataFrame, n: int = 10) -> DataFrame:
    """The n most confident pairs, for a report."""
    return pairs.orderBy(F.desc("confidence_score"), "source1_id", "source2_id").limit(n)


def match_summary(pairs: DataFrame) -> DataFrame:
    """Number of pairs and average confidence per match type, in one pass."""
    return pairs.groupBy("match_type").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.avg("confidence_score").alias("avg_confidence"),
        F.min("confidence_score").alias("min_confidence"),
        F.max("confidence_score").alias("max_confidence"),
    )
