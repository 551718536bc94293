import random
from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfmark.operators import dimension, facts
from shelfmark.operators.ordered import split_hot, with_last_known, with_neighbours


def log(spark, seed=1, n=300):
    rng = random.Random(seed)
    rows = [
        # a third of all rows belong to one key; some keys are null
        ("hot" if rng.random() < 0.33 else rng.choice(["a", "b", "c", None]), f"2024-{rng.randint(1, 6):02}-{rng.randint(1, 28):02}", i, rng.choice(["x", "y", None]))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "k string, d string, i int, v string").withColumn("t", F.to_timestamp("d"))


def test_neighbours_equal_plain_windows(spark):
    df = log(spark)
    w = Window.partitionBy("k").orderBy("t", "i")
    expected = df.withColumns({"p": F.lag("v").over(w), "n": F.lead("t").over(w), "rn": F.row_number().over(w)})
    for share in (None, 1, 10, 1000):
        mine = with_neighbours(df, ["k"], "t", ["i"], {"p": "v"}, {"n": "t"}, "rn", share)
        assert sorted(map(str, mine.collect())) == sorted(map(str, expected.collect()))


def test_last_known_equals_plain_window(spark):
    df = log(spark, 2)
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("last", F.last("v", ignorenulls=True).over(w))
    for share in (None, 1, 10, 1000):
        mine = with_last_known(df, ["k"], "t", ["i"], F.col("v"), "last", share)
        assert sorted(map(str, mine.collect())) == sorted(map(str, expected.collect()))


def test_keys_without_a_burst_take_one_shuffle(spark, tmp_path):
    rows = [(f"k{i % 50}", i, "x") for i in range(500)]
    spark.createDataFrame(rows, "k string, t int, v string").write.parquet(str(tmp_path / "log"))
    seen = with_neighbours(spark.read.parquet(str(tmp_path / "log")), ["k"], "t", [], {"p": "v"}, {"n": "v"}, "rn")
    seen.collect()
    plan = seen._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1 and plan.count("Scan parquet") == 1 and "Join" not in plan


def test_one_moment_of_one_key_goes_to_all_tasks(spark):
    """Two thirds of all rows are one key at one time: only their ties tell them apart."""
    df = spark.range(3000).selectExpr("if(id % 3 < 2, 'burst', concat('k', id % 100)) as k", "date'2024-01-01' as t", "id as i")
    calm, hot = split_hot(df, ["k"], ["t", "i"])
    sizes = [r["count"] for r in hot.groupBy("_part").count().collect()]
    assert sum(sizes) == 2000 and calm.count() == 1000
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * min(sizes)
    w = Window.partitionBy("k").orderBy("t", "i")
    expected = df.withColumns({"p": F.lag("i").over(w), "rn": F.row_number().over(w)})
    mine = with_neighbours(df, ["k"], "t", ["i"], {"p": "i"}, number="rn")
    assert sorted(map(str, mine.collect())) == sorted(map(str, expected.collect()))


def test_versions_do_not_overlap_and_one_is_current(spark):
    versions = dimension.versions_from_log(log(spark, 3).where("k is not null"), ["k"], ["v"], "t", ["i"]).cache()
    assert versions.groupBy("k").agg(F.count_if("is_current").alias("n")).where("n <> 1").count() == 0
    w = Window.partitionBy("k").orderBy("version")
    steps = versions.withColumns({"next": F.lead("valid_from").over(w), "after": F.lead("v").over(w), "more": F.lead("version").over(w)})
    assert steps.where("more is not null and not (valid_to <=> next)").count() == 0
    assert steps.where("more is not null and v <=> after").count() == 0


def test_as_of_equals_range_join(spark):
    versions = dimension.versions_from_log(log(spark, 4).where("k is not null"), ["k"], ["v"], "t", ["i"]).cache()
    probes = log(spark, 5).where("k is not null").selectExpr("i as ask", "k", "t + interval 1 day as at")
    v, p = versions.alias("v"), probes.alias("p")
    test = (F.col("v.k") == F.col("p.k")) & (F.col("valid_from") <= F.col("at")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to")))
    expected = p.join(v, test, "left").select("p.ask", "p.k", "p.at", "v.v")
    mine = dimension.as_of(probes, versions, ["k"], "at", ["v"])
    assert sorted(map(str, mine.collect())) == sorted(map(str, expected.collect()))


BOOK = "book_id string, title string, source_ids map<string,array<string>>"


def incoming(spark, *rows):
    return spark.createDataFrame([(i, t, {"a": [i]}) for i, t in rows], BOOK)


def merged(spark, current, rows, ts, **options):
    out = dimension.merge_versions(current, incoming(spark, *rows), ts, tracked=["title", "source_ids"], **options)
    return spark.createDataFrame(out.collect(), out.schema)


def test_merge_history(spark):
    schema = incoming(spark, ("x", "x")).schema
    empty = spark.createDataFrame([], schema).selectExpr(
        "*", "cast(null as timestamp) as valid_from", "cast(null as timestamp) as valid_to", "true as is_current", "1 as version"
    )
    one = merged(spark, empty, [("1", "A"), ("2", "B")], "2024-01-01")
    assert one.count() == 2
    two = merged(spark, one, [("1", "A2"), ("2", "B"), ("3", "C")], "2024-02-01")
    state = {(r.book_id, r.version): r for r in two.collect()}
    assert len(state) == 4
    assert state["1", 1].valid_to == datetime(2024, 2, 1) and not state["1", 1].is_current
    assert state["1", 2].title == "A2" and state["1", 2].is_current and state["1", 2].valid_from == datetime(2024, 2, 1)
    assert state["2", 1].is_current and state["2", 1].valid_from == datetime(2024, 1, 1)
    assert state["3", 1].is_current
    # the same batch again changes nothing
    again = merged(spark, two, [("1", "A2"), ("2", "B"), ("3", "C")], "2024-03-01")
    assert sorted(map(str, again.collect())) == sorted(map(str, two.collect()))
    # a key that disappears stays, unless it is to be closed; coming back it goes on counting
    assert merged(spark, two, [("1", "A2")], "2024-03-01").where("is_current").count() == 3
    closed = merged(spark, two, [("1", "A2"), ("3", "C")], "2024-03-01", close_missing=True)
    assert closed.where("book_id = '2' and is_current").count() == 0
    back = merged(spark, closed, [("1", "A2"), ("2", "B"), ("3", "C")], "2024-04-01")
    assert [(r.version, r.is_current) for r in back.where("book_id = '2'").orderBy("version").collect()] == [(1, False), (2, True)]
    at = dimension.valid_at(back, "2024-01-15 00:00:00")
    assert {(r.book_id, r.title) for r in at.collect()} == {("1", "A"), ("2", "B")}


def test_price_changes_and_availability(spark):
    rows = [("b", "s", 10.0, "2024-01-01"), ("b", "s", 10.0, "2024-01-20"), ("b", "s", 12.0, "2024-02-02"), ("b", "s", 6.0, "2024-04-01")]
    prices = spark.createDataFrame(rows, "book_id string, source string, price double, d string").selectExpr("*", "cast(d as timestamp) as effective_date")
    out = facts.price_changes(prices).orderBy("effective_date").collect()
    assert [(r.previous_price, r.price, r.price_change, r.change_percentage) for r in out] == [(10.0, 12.0, 2.0, 20.0), (12.0, 6.0, -6.0, -50.0)]
    rows = [("b", "s", "in_stock", "2024-01-01"), ("b", "s", "in_stock", "2024-02-01"), ("b", "s", None, "2024-03-01"), ("b", "s", "in_stock", "2024-05-01")]
    states = spark.createDataFrame(rows, "book_id string, source string, status string, d string").selectExpr("*", "cast(d as timestamp) as effective_date")
    out = facts.availability_history(states).orderBy("effective_date").collect()
    assert [(r.status, r.previous_status) for r in out] == [("in_stock", None), (None, "in_stock"), ("in_stock", None)]


def test_category_dimension(spark):
    df = spark.createDataFrame([("Books > Travel > Asia",), ("Books > Travel",), ("Books > Music",)], "category_path string")
    nodes = {r.full_path: r for r in dimension.category_dimension(df).collect()}
    assert set(nodes) == {"Books", "Books > Travel", "Books > Travel > Asia", "Books > Music"}
    assert nodes["Books"].parent_category_id is None and nodes["Books"].level == 1
    assert nodes["Books > Travel > Asia"].parent_category_id == nodes["Books > Travel"].category_id
    assert nodes["Books > Travel > Asia"].category_name == "Asia"


def test_ids_of_books_without_id(spark):
    rows = spark.createDataFrame(
        [("a", None, None, "One", ["x"], "Books > T"), ("a", None, None, "Two", ["x"], "Books > T"), ("a:b", "c", None, "T", None, None), ("a", "b:c", None, "T", None, None)],
        "source string, source_id string, isbn13 string, title string, authors array<string>, category_path string",
    )
    matches = spark.createDataFrame([], "source1_source string, source1_id string, source2_source string, source2_id string, source2_isbn13 string, source2_authors array<string>, source2_category string, confidence_score double")
    books = dimension.build_dimension(rows, matches, "2024-01-01")
    assert len({r.book_id for r in books.collect()}) == 4
    assert {r.book_id for r in dimension.with_book_ids(rows, matches).collect()} == {r.book_id for r in books.collect()}
    again = dimension.merge_versions(books, books.unionByName(books.withColumn("title", F.concat("title", F.lit("!")))), "2024-02-01")
    assert again.groupBy("book_id").agg(F.count_if("is_current").alias("n")).where("n <> 1").count() == 0
    assert dimension.merge_versions(books, books, "2024-02-01").count() == 4


def test_merge_with_null_and_repeated_keys(spark):
    schema = "book_id string, title string, valid_from timestamp, valid_to timestamp, is_current boolean, version int"
    empty = spark.createDataFrame([], schema)
    new = spark.createDataFrame([(None, "n"), ("k", "b"), ("k", "a")], "book_id string, title string")
    first = dimension.merge_versions(empty, new, "2024-01-01", tracked=["title"])
    assert sorted((r.book_id or "", r.title, r.version) for r in first.collect()) == [("", "n", 1), ("k", "a", 1)]
    second = dimension.merge_versions(first, new, "2024-02-01", tracked=["title"])
    assert sorted(map(str, second.collect())) == sorted(map(str, first.collect()))


def test_steps_next_to_missing_prices(spark):
    rows = [("k", 1, 10.0), ("k", 2, None), ("k", 3, 12.0), (None, 1, 1.0), (None, 9, 2.0)]
    prices = spark.createDataFrame(rows, "book_id string, day int, price double").withColumns({"source": F.lit("s"), "effective_date": F.timestamp_add("DAY", F.col("day") * 40, F.to_timestamp(F.lit("2024-01-01")))})
    got = facts.price_changes(prices).select("book_id", "previous_price", "price").collect()
    assert sorted((r.book_id or "", r.previous_price, r.price) for r in got) == [("", 1.0, 2.0), ("k", 10.0, 12.0)]
