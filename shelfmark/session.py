"""Session defaults and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults the library is tested with."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the store all executors share.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="shelfmark-")
    elif root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must be a folder shared by all executors, not a local one")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Where the tables that ``written`` made lie, as long as somebody holds them.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the work folder and read back.

    For a result that several later branches read: they scan the files instead of
    repeating its plan, lost executors cost no recomputation, and the sizes are known.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written``, once the last job that reads them has run.

    Anything derived from them that has not been written yet can not be read any more.
    """
    for table in tables:
        delete_folder(table.sparkSession, _FOLDERS.pop(table))


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles that nothing refers to any more.

    It does so when their plans are collected as garbage, which on a large heap may come late.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Through Hadoop's file system, so that it reaches the store that the executors share."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
