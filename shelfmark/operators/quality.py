"""Data-quality rules: one aggregate pass for a table, one expression for a row."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule kinds, result states, and the bounds of a silver record.
NOT_NULL, UNIQUE, RANGE, REGEX, CUSTOM = "not_null", "unique", "range", "regex", "custom"
PASS, FAIL, WARNING = "PASS", "FAIL", "WARNING"
MAX_TITLE = 500
MAX_PRICE = 10000.0
MAX_RATING = 5.0
ISBN_PATTERN = "^[0-9]{13}$"
URL_PATTERN = "^https?://"
AVAILABILITY = ["in_stock", "out_of_stock", "pre_order", "unknown"]
CURRENCIES = ["USD", "GBP", "EUR", "UNK"]


@dataclass(frozen=True)
class Rule:
    """``parameters``: ``min`` / ``max``, ``pattern``, or ``test`` (an SQL predicate).

    A null value breaks only ``not_null``. ``tolerance`` is the share of broken rows
    up to which a result is a WARNING instead of a FAIL.
    """

    name: str
    kind: str
    column: str
    parameters: dict = field(default_factory=dict)
    tolerance: float = 0.0

    def holds(self) -> Column:
        value = F.col(self.column)
        if self.kind == NOT_NULL:
            return value.isNotNull()
        if self.kind == RANGE:
            low, high = self.parameters.get("min"), self.parameters.get("max")
            test = F.lit(True)
            if low is not None:
                test = test & (value >= low)
            if high is not None:
                test = test & (value <= high)
        elif self.kind == REGEX:
            test = value.rlike(self.parameters["pattern"])
        elif self.kind == CUSTOM:
            test = F.expr(self.parameters["test"])
        else:
            raise ValueError(f"{self.kind} is no rule on single rows")
        return F.coalesce(test, F.lit(True))

    def expected(self) -> str:
        if self.kind == RANGE:
            return f"{self.parameters.get('min', '')}..{self.parameters.get('max', '')}"
        return str(self.parameters.get("pattern") or self.parameters.get("test") or self.kind)


def member_rule(name: str, column: str, values: list[str], tolerance: float = 0.0) -> Rule:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return Rule(name, CUSTOM, column, {"test": f"{column} IN ({listed})"}, tolerance)


def silver_rules(sources: list[str] | None = None, currencies: list[str] = CURRENCIES, max_price: float = MAX_PRICE) -> list[Rule]:
    """The constraints of a silver record."""
    required = ["source", "source_id", "title", "category_path", "price_current", "product_url", "ingested_at", "content_hash"]
    rules = [Rule(f"{c}_present", NOT_NULL, c) for c in required]
    rules += [
        Rule("title_length", CUSTOM, "title", {"test": f"length(title) BETWEEN 1 AND {MAX_TITLE}"}),
        Rule("category_length", CUSTOM, "category_path", {"test": "length(category_path) >= 1"}),
        Rule("isbn_digits", REGEX, "isbn13", {"pattern": ISBN_PATTERN}),
        Rule("price_current_range", RANGE, "price_current", {"min": 0.0, "max": max_price}),
        Rule("price_original_range", RANGE, "price_original", {"min": 0.0, "max": max_price}),
        Rule("price_order", CUSTOM, "price_original", {"test": "price_original >= price_current"}),
        Rule("stock_range", RANGE, "stock_quantity", {"min": 0}),
        Rule("rating_range", RANGE, "rating", {"min": 0.0, "max": MAX_RATING}),
        Rule("reviews_range", RANGE, "num_reviews", {"min": 0}),
        Rule("score_range", RANGE, "data_quality_score", {"min": 0.0, "max": 1.0}),
        member_rule("currency_listed", "currency", currencies),
        member_rule("availability_listed", "availability", AVAILABILITY),
    ]
    if sources:
        rules.append(member_rule("source_listed", "source", sources))
    return rules


def url_rule(column: str) -> Rule:
    return Rule(f"{column}_is_url", REGEX, column, {"pattern": URL_PATTERN})


def _counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(number, broken, rows) of each rule.

    All rules on rows share one pass. A unique rule groups its own column, with partial
    counts first, so no row is repeated for each of them.
    """
    plain = [i for i, r in enumerate(rules) if r.kind != UNIQUE]
    rows = F.count(F.lit(1)).alias("rows")
    parts = []
    if plain:
        counts = df.agg(rows, *[F.count_if(~rules[i].holds()).alias(f"_{i}") for i in plain])
        entries = F.array(*[F.struct(F.lit(i).alias("number"), F.col(f"_{i}").alias("broken"), "rows") for i in plain])
        parts.append(counts.select(F.inline(entries)))
    for i, rule in enumerate(rules):
        if rule.kind == UNIQUE:
            groups = df.groupBy(rule.column).agg(F.count(F.lit(1)).alias("n"))
            repeats = F.coalesce(F.sum(F.when(F.col(rule.column).isNotNull(), F.col("n") - 1)), F.lit(0))
            parts.append(groups.agg(repeats.alias("broken"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).select(F.lit(i).alias("number"), "broken", "rows"))
    return reduce(DataFrame.unionByName, parts)


def check_rules(df: DataFrame, rules: list[Rule], run_id: str, timestamp: str | datetime) -> DataFrame:
    """One row per rule: status, expected, actual, message."""

    def of_rule(values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("number") + 1)

    broken, name = F.col("broken"), of_rule([r.name for r in rules])
    share = broken / F.greatest(F.col("rows"), F.lit(1))
    return _counts(df, rules).select(
        F.lit(run_id).alias("run_id"),
        name.alias("rule_name"),
        F.when(broken == 0, PASS).when(share <= of_rule([float(r.tolerance) for r in rules]), WARNING).otherwise(FAIL).alias("status"),
        of_rule([r.column for r in rules]).alias("field_name"),
        of_rule([r.expected() for r in rules]).cast("string").alias("expected_value"),
        broken.cast("string").alias("actual_value"),
        F.when(broken > 0, F.format_string("%d of %d rows break %s", broken, F.col("rows"), name)).alias("error_message"),
        F.lit(timestamp).cast("timestamp").alias("timestamp"),
    )


def with_reasons(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``reasons``, the names of the rules a row breaks."""
    names = [F.when(~r.holds(), r.name) for r in rules if r.kind != UNIQUE]
    return df.withColumn("reasons", F.array_compact(F.array(*names)))


def split_rows(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): every row is in exactly one; rejected rows keep their reasons."""
    checked = with_reasons(df, rules)
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)
