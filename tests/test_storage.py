import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.operators import dimension, silver
from shelfmark.plans.inputs import parsed_parts
from shelfmark.plans.queries import QUERIES
from shelfmark.schemas import RAW_RECORD, SILVER
from shelfmark.session import work_folder, written
from shelfmark.sources import keyed, tables
from shelfmark.streaming import incremental

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return silver.clean(parsed_parts(spark, DATA), "shop").where("title is not null")


def test_batches_replace_only_themselves(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    n = rows.count()
    assert tables.write_batch(rows, path, "b1") == (path, n)
    tables.write_batch(rows.withColumn("source", F.lit("other")), path, "b1")
    tables.write_batch(rows.limit(5), path, "b2")
    tables.write_batch(rows, path, "b1")
    assert tables.read_layer(spark, path, SILVER).count() == 2 * n + 5
    one = tables.read_layer(spark, path, SILVER, source="shop", batch_id="b2")
    assert one.count() == 5 and silver.schema_differences(one.drop("batch_id")) == []
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "batch_id" in plan.split("PartitionFilters")[1][:200]
    check = tables.verify_written(rows.limit(5), one).collect()[0]
    assert check.equal and check.rows_actual == 5
    assert tables.read_matching_files(spark, path).count() == 2 * n + 5


def test_empty_batch_and_missing_table(spark, rows, tmp_path):
    path = str(tmp_path / "none")
    assert tables.write_batch(rows.limit(0), path, "b1") == (None, 0)
    assert not [f for _, _, files in os.walk(path) for f in files if f.endswith(".parquet")]
    assert tables.read_layer(spark, str(tmp_path / "nothing"), SILVER) is None


def test_default_batch_id():
    from datetime import datetime

    assert tables.default_batch_id(datetime(2024, 1, 2, 3, 4, 5)) == "20240102_030405"


def test_json_sample_and_report(spark, rows, tmp_path):
    tables.write_sample(rows, str(tmp_path / "sample"), ["content_hash"], 3)
    assert tables.read_json(spark, str(tmp_path / "sample"), SILVER).count() == 3
    raw = spark.createDataFrame([("s", "http://x", "<p>é</p>", 200, None, None)], RAW_RECORD.simpleString()[7:-1].replace(":", " "))
    tables.write_json(raw, str(tmp_path / "raw"))
    assert tables.read_json(spark, str(tmp_path / "raw"), RAW_RECORD).collect()[0].raw_content == "<p>é</p>"
    tables.write_report(spark.range(1).selectExpr("true as ok", "5 as rows"), str(tmp_path / "report"))
    files = [f for f in os.listdir(tmp_path / "report") if f.endswith(".json")]
    assert len(files) == 1


def test_scan_reads_only_what_is_asked(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    tables.write_batch(rows, path, "b1")
    plan = tables.read_layer(spark, path, SILVER).where("price_current > 5").select("title")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(price_current), GreaterThan(price_current,5.0)]" in text
    assert "ReadSchema: struct<title:string,price_current:double>" in text


def test_work_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(root)
    assert written(spark.range(5), "ids").count() == 5


def test_incremental_load(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "source string, source_id string, content_hash string, ingested_at timestamp"

    def arrive(name, *entries):
        data = spark.createDataFrame([("s", i, c) for i, c in entries], "source string, source_id string, content_hash string")
        data.withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)

    kind = spark.createDataFrame([], schema).schema

    def run():
        stream = incremental.read_new_files(spark, source, kind)
        store = incremental.append_unseen(target, kind)
        incremental.load_increment(stream, lambda df: df, store, state).awaitTermination()
        rows = tables.read_layer(spark, target, kind).collect()
        return sorted((r.source_id, r.content_hash) for r in rows)

    arrive("1", ("1", "a"), ("1", "a"), ("2", "b"))
    assert run() == [("1", "a"), ("2", "b")]
    assert run() == [("1", "a"), ("2", "b")]
    arrive("2", ("2", "b"), ("2", "b2"), ("3", "a"))
    assert run() == [("1", "a"), ("2", "b"), ("2", "b2"), ("3", "a")]


@pytest.mark.parametrize("name", ["incremental_load", "incremental_restart", "stream_dedup"])
def test_streams_read_tables_that_are_folders(spark, tmp_path, name):
    rows = spark.createDataFrame([(i, f"text {i % 4}", "en", "web", i) for i in range(9)], "doc_id long, text string, lang string, source string, n_chars long")
    rows.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    events = spark.createDataFrame([(i, i % 4, "view", "2024-01-01 00:00:00") for i in range(9)], "event_id long, user_id long, event_type string, ts string")
    events.withColumn("ts", F.col("ts").cast("timestamp")).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert QUERIES[name](spark, str(tmp_path)).count() == 4


def test_incremental_load_without_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["incremental_load"](spark, str(tmp_path)).count() == 0


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    schema = "source string, source_id string, content_hash string, ingested_at timestamp"
    rows = spark.createDataFrame([("s", "1", "a", None)], schema)
    store = incremental.append_unseen(str(tmp_path / "t"), rows.schema)
    store(rows, 0)
    store(rows, 0)
    store(rows, 1)
    assert tables.read_layer(spark, str(tmp_path / "t"), rows.schema).count() == 1


def test_a_new_checkpoint_loses_no_stored_row(spark, tmp_path):
    """Batch numbers that start again neither replace stored rows nor add them twice."""
    schema = "source string, source_id string, content_hash string, ingested_at timestamp"
    target = str(tmp_path / "t")

    def rows(*ids):
        return spark.createDataFrame([("s", i, "h", None) for i in ids], schema)

    first, second = (incremental.append_unseen(target, rows().schema) for _ in range(2))
    first(rows("1", "2", None), 0)
    first(rows("3"), 1)
    second(rows("3", "4", None), 0)
    stored = tables.read_layer(spark, target, rows().schema, partitions=("bucket", "batch_id"))
    assert stored.select("bucket").distinct().count() > 1
    assert sorted(r.source_id or "" for r in stored.collect()) == ["", "1", "2", "3", "4"]
    assert stored.where("source_id = '3'").first()["batch_id"].startswith("000000000001")


def _rows_read(table):
    """Rows that the scan of a table gave after Parquet had left out row groups and pages."""
    table.collect()
    waiting, total = [table._jdf.queryExecution().executedPlan()], 0
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        else:
            waiting += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_small_batches_read_little_of_the_stored_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "ROW_GROUP", 1 << 16)
    path = str(tmp_path / "t")
    rows = spark.range(200_000).selectExpr("cast(id as string) as id", "repeat(cast(id as string), 3) as text")
    keyed.append(keyed.with_bucket(rows, ("id",), 4), path)
    read = []
    for n in (3, 30, 1000, 50_000):
        batch = keyed.with_bucket(rows.where(f"id < {n}"), ("id",), 4)
        with keyed.point_lookups(spark):
            part = keyed.read(spark, path, rows.schema).where(keyed.may_hold(batch))
            assert part.join(batch.select("id"), "id", "left_semi").count() == n
            read.append(_rows_read(part.select("id")))
    assert read[0] < 10_000 and read[0] < read[1] < read[3] and read[3] == 200_000


def test_another_layout_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("s", "1", "a", None)], "source string, source_id string, content_hash string, ingested_at timestamp")
    incremental.append_unseen(path, rows.schema, buckets=16)(rows, 0)
    incremental.append_unseen(path, rows.schema, buckets=16)(rows, 1)
    with pytest.raises(ValueError, match="16 buckets"):
        incremental.append_unseen(path, rows.schema, buckets=8)(rows, 2)
    assert keyed.read(spark, path, rows.schema).count() == 1


def test_buckets_of_many_files_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "source string, source_id string, content_hash string, ingested_at timestamp"
    kind = spark.createDataFrame([], schema).schema
    store = incremental.append_unseen(path, kind, buckets=2, files_per_bucket=3)
    for n in range(6):
        store(spark.createDataFrame([("s", f"{n}-{k}", "h", None) for k in range(8)], schema), n)
    stored = keyed.read(spark, path, kind)
    assert stored.select("source_id").distinct().count() == stored.count() == 48
    assert stored.select(F.input_file_name().alias("f")).distinct().count() <= 6


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_a_merge_rewrites_only_buckets_that_change(spark, tmp_path):
    path = tmp_path / "dim"
    schema = StructType.fromDDL("id string, title string, tags map<string,array<string>>, valid_from timestamp, valid_to timestamp, is_current boolean, version int")

    def merge(rows, ts, **options):
        df = spark.createDataFrame([(i, t, {"a": [t or "-"], "b": []}) for i, t in rows], "id string, title string, tags map<string,array<string>>")
        return dimension.merge_into(spark, str(path), schema, df, ts, key="id", tracked=["title", "tags"], buckets=8, **options)

    every = [(f"k{i}", "old") for i in range(200)] + [(None, "no id")]
    assert len(merge(every, "2024-01-01")) == 8
    before = _files(path)
    assert merge(every, "2024-01-02") == [] and _files(path) == before
    changed = merge([("k7", "new"), ("k8", "old"), ("fresh", "x")], "2024-01-03")
    after = _files(path)
    assert 1 <= len(changed) <= 2
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if f.split("=")[1][:5] in changed}
    assert merge([("k7", "new"), ("fresh", "x")], "2024-01-04") == [] and _files(path) == after
    rows = {(r.id, r.version): (r.title, r.is_current) for r in keyed.read(spark, str(path), schema).collect()}
    assert len(rows) == 203 and rows["k7", 1] == ("old", False) and rows["k7", 2] == ("new", True) and rows["fresh", 1] == ("x", True)
    assert len(merge([("k7", "new")], "2024-01-05", close_missing=True)) == 8
    assert keyed.read(spark, str(path), schema).where("is_current").count() == 1


def test_files_are_balanced_under_skew(spark, tmp_path):
    """A source with most rows is written by several tasks, and each of many small ones by one."""
    path = str(tmp_path / "t")
    rows = spark.range(0, 60_000, numPartitions=16).selectExpr("if(id % 3 < 2, 'big', concat('small', id % 30)) as source", "id", "uuid() as text")
    _, written_rows = tables.write_batch(rows, path, "b1", file_bytes=512 << 10)
    files = {p.name: len(list(p.rglob("*.parquet"))) for p in (tmp_path / "t").glob("source=*")}
    assert written_rows == 60_000 and files["source=big"] >= 4
    # small ones are cut only where they share a shuffle partition with the big one
    assert len(files) == 11 and sorted(n for f, n in files.items() if f != "source=big")[5] == 1
    sizes = [f.stat().st_size for f in (tmp_path / "t" / "source=big").rglob("*.parquet")]
    assert max(sizes) < 3 * min(sizes)
    assert spark.read.parquet(path).select("id").distinct().count() == 60_000


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    path = str(tmp_path / "t")
    kind = StructType.fromDDL("k string, ingested_at timestamp")
    store = incremental.store_with_late_rows(path, kind, ("k",), delay="2 days")

    def batch(*rows):
        return spark.createDataFrame([(k, t) for k, t in rows], "k string, t string").select("k", F.col("t").cast("timestamp").alias("ingested_at"))

    store(batch(("a", "2024-01-10"), ("a", "2024-01-09"), ("b", "2024-01-01")), 0)  # nothing came before
    for _ in range(2):  # a batch that comes again changes nothing
        store(batch(("c", "2024-01-07"), ("d", "2024-01-08"), ("a", "2024-01-12"), ("e", None)), 1)
    store(batch(), 2)
    counts = {r.batch: (r.came, r.stored, r.repeats, r.late) for r in spark.read.schema(incremental.COUNTS).parquet(f"{path}/counts").collect()}
    assert counts == {0: (3, 2, 1, 0), 1: (4, 2, 1, 1), 2: (0, 0, 0, 0)}
    assert [r.k for r in spark.read.parquet(f"{path}/late").collect()] == ["c"]
    assert sorted(r.k for r in keyed.read(spark, f"{path}/rows", kind).collect()) == ["a", "b", "d", "e"]
