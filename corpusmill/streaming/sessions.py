"""Incremental runs with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def accept_new(stream: DataFrame, path: str, checkpoint: str, key: str, order: str) -> StreamingQuery:
    """Append rows whose key no earlier batch has, the first of each key within a batch. The accepted rows are the memory:
    they are read back for each batch, so state survives in the sink and grows with what was accepted only. A batch that
    runs again finds its own rows by batch number and leaves them out before it writes them anew."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        first = batch.groupBy(key).agg(F.min_by(F.struct(*batch.columns), order).alias("r")).select("r.*")
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            old = spark.read.parquet(path).where(F.col("batch") != number).select(key)
            first = first.join(old, key, "left_anti")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        first.withColumn("batch", F.lit(number)).write.mode("overwrite").partitionBy("batch").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_log(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each result once; a restart goes on where the checkpoint is."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str, by: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by tumbling window and value; rows later than the watermark don't count."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), by).agg(F.count("*").alias("n"))
