import pytest
from pyspark.sql import functions as F

from shelfmark.operators.silver import schema_differences
from shelfmark.schemas import RUN_REPORT
from shelfmark.operators import profiles, quality, silver
from tests_support import parsed


def rows(spark, *changes):
    from functools import reduce

    frames = [silver.clean(parsed(spark, **c), "shop") for c in changes]
    return reduce(lambda a, b: a.unionByName(b), frames)


def test_rules_table(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", -1.0), (2, None, None)], "k int, s string, v double")
    rules = [
        quality.Rule("k_unique", quality.UNIQUE, "k"),
        quality.Rule("s_present", quality.NOT_NULL, "s", tolerance=0.5),
        quality.Rule("v_range", quality.RANGE, "v", {"min": 0, "max": 10}),
        quality.Rule("s_form", quality.REGEX, "s", {"pattern": "^[ab]$"}),
        quality.Rule("custom", quality.CUSTOM, "v", {"test": "v > k"}),
        quality.member_rule("member", "s", ["a", "it's"]),
    ]
    out = {r.rule_name: r for r in quality.check_rules(df, rules, "run", "2024-01-01").collect()}
    assert {n: (r.status, r.actual_value) for n, r in out.items()} == {
        "k_unique": ("FAIL", "1"), "s_present": ("WARNING", "1"), "v_range": ("FAIL", "1"), "s_form": ("PASS", "0"),
        "custom": ("FAIL", "1"), "member": ("FAIL", "1"),
    }
    assert out["v_range"].expected_value == "0..10" and out["v_range"].error_message == "1 of 3 rows break v_range"
    assert out["s_form"].error_message is None and out["s_form"].run_id == "run"
    empty = quality.check_rules(df.where("k > 9"), rules, "run", "2024-01-01")
    assert {r.status for r in empty.collect()} == {"PASS"}


def test_silver_rules_reject(spark):
    df = rows(
        spark, {}, {"price_current": -5.0}, {"price_current": 10001.0}, {"title": "x" * 501}, {"title": ""}, {"price_original": 5.0},
        {"rating": 5.5}, {"num_reviews": -1}, {"currency": "XXX"}, {"price_current": None}, {"price_original": 12.0},
    )
    accepted, rejected = quality.split_rows(df, quality.silver_rules(["shop"]))
    assert accepted.count() == 2 and accepted.columns == df.columns
    reasons = sorted(",".join(r.reasons) for r in rejected.collect())
    assert reasons == sorted([
        "price_current_range", "price_current_range", "title_length", "title_length", "price_order", "rating_range",
        "reviews_range", "currency_listed", "price_current_present",
    ])
    assert quality.split_rows(df, quality.silver_rules(["other"]))[0].count() == 0


def test_every_row_is_on_one_side(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, id) as v")
    accepted, rejected = quality.split_rows(df, [quality.Rule("v", quality.NOT_NULL, "v")])
    assert accepted.count() + rejected.count() == 1000 and accepted.join(rejected, "id").count() == 0


@pytest.mark.parametrize("url, ok", [("http://x", True), ("https://x", True), ("invalid-url", False), ("ftp://x", False)])
def test_url_rule(spark, url, ok):
    df = spark.createDataFrame([(url,)], "source_url string")
    assert (quality.split_rows(df, [quality.url_rule("source_url")])[0].count() == 1) is ok


def test_success_rate(spark):
    df = spark.createDataFrame([(950, 1000), (0, 0)], "c long, i long")
    assert [r[0] for r in df.select(profiles.success_rate(F.col("c"), F.col("i"))).collect()] == [95.0, 0.0]


def test_run_metrics(spark):
    rows = [(str(i % 7), []) for i in range(8)] + [("8", ["a"]), ("9", ["a", "b"])]
    checked = spark.createDataFrame(rows, "content_hash string, reasons array<string>")
    report = profiles.run_metrics(checked, "r", "shop", "2024-01-01 10:00:00", "2024-01-01 10:01:00")
    row = report.collect()[0]
    assert (row.records_ingested, row.records_cleaned, row.records_deduplicated, row.records_rejected, row.success_rate) == (10, 8, 1, 2, 80.0)
    assert (row.status, row.data_quality_failures, row.errors) == ("SUCCESS", 3, []) and str(row.end_time - row.start_time) == "0:01:00"
    assert schema_differences(report, RUN_REPORT) == []
    assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
    empty = profiles.run_metrics(checked.limit(0), "r", "shop", "2024-01-01", errors=["no input"]).collect()[0]
    assert (empty.records_ingested, empty.success_rate, empty.status, empty.errors) == (0, 0.0, "FAILED", ["no input"])


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "g string, v double")
    row = profiles.number_profile(df, "v").collect()[0]
    assert (row.avg_value, row.min_value, row.max_value, row.with_value, row.rows) == (2.0, 1.0, 3.0, 2, 3)
    assert [(r.g, r.rows) for r in profiles.group_profile(df, "g").collect()] == [("a", 2), ("b", 1)]
    assert {r.field_name: r.nulls for r in profiles.null_profile(df, ["g", "v"]).collect()} == {"g": 0, "v": 1}
    assert profiles.layer_counts({"bronze": df, "gold": df.limit(0)}).collect()[0].asDict() == {"bronze": 3, "gold": 0}
