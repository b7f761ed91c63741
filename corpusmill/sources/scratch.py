"""Folders for tables between steps."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share. Where it is unset, a session of one machine, as in
    tests, gets a temporary folder; on a cluster, whose executors don't see the driver's folders, that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='corpusmill-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found


def drop(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else has; what is written there goes when the session's process ends."""
    path = f"{shared_dir(spark)}/corpusmill/{name}-{uuid.uuid4().hex}"
    atexit.register(drop, spark, path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: made once, however often it is read, and its lineage cut."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def done_with(*tables: DataFrame) -> None:
    """Removes tables that `written` gave, which nothing reads any more, before the process ends."""
    for df in tables:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            drop(df.sparkSession, folder)


def dealt_by(texts: DataFrame, *keys: str) -> DataFrame:
    """Texts dealt by their keys, as they are: groups by keys and word, which take many times a text's room, then form where the
    texts lie, and only what crosses texts is shuffled by word."""
    return texts.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
