"""Tables as the queries read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources import tables

#: Bytes below which a table stays as it is read.
LEAST_BYTES = 256 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table that is dealt to all cores. A file of one row group is read by one task, however many cores there are; such a
    table is dealt out anew before work is done on its rows. One with a task for each core stays as it is."""
    df = tables.table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < LEAST_BYTES or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def counted(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number n: what follows from a row alone need be found for each of these only. Tasks count their
    own rows first, so that many equal ones shuffle little."""
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
