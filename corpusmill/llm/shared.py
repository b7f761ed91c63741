"""Tables in the shared folder and connected components, both without anything on the driver that grows with the input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.scratch import fresh


#: Shuffle files of a query go when it ends: the table that it wrote stands in for them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it again: lineage is cut, and a lost executor loses nothing. Dropped
    when the session's process ends. Token lists take a quarter less as zstd."""
    spark = df.sparkSession
    path = fresh(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: The key as a new expression: a join on it then deals out both of its sides, which adaptive execution can split for a hub.
_AGAIN = "u + 0L as u"


#: Links up to which one task finds the components: 16 bytes each. The count is taken before; beyond it rounds do.
LOCAL_LINKS = 1_000_000


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links of one partition: labels sink to the smallest id of each component, with pointer jumping."""
    found = [np.stack([b.column("u").to_numpy(), b.column("v").to_numpy()]) for b in batches if b.num_rows]
    if not found:
        return
    ids, at = np.unique(np.concatenate(found, axis=1), return_inverse=True)
    u, v = at.reshape(2, -1)
    root = np.arange(len(ids))
    while True:
        was = root.copy()
        low = np.minimum(root[u], root[v])
        for end in (u, v):
            np.minimum.at(root, root[end], low)
            np.minimum.at(root, end, low)
        while (root != root[root]).any():
            root = root[root]
        if (root == was).all():
            break
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], names=["id", "component"])


def components(links: DataFrame, src: str = "a", dst: str = "b", most_rounds: int = 60, local_links: int = LOCAL_LINKS) -> DataFrame:
    """Connected components: (id, component) with component the smallest id, for each id that `links` names.

    Up to `local_links` distinct links, by count, are one executor task's work. Beyond, it alternates large-star and small-star rounds (Kiveris et al., 2014). Each round takes minima with map-side
    combining and joins them back, so that a hub of any degree is neither collected nor dealt to one task.
    A round's edges are stored; it ends when a round changes nothing. Self links give their own id; nulls are dropped.
    """
    both = links.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    edges = stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if edges.count() <= local_links:
        return edges.coalesce(1).mapInArrow(_label, "id long, component long")
    before = None
    for _ in range(most_rounds):
        # Large star: each neighbour above u is tied to the smallest of u and its neighbours.
        sym = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).selectExpr(_AGAIN, "least(u, m) as m")
        edges = sym.where("v >= u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        # Small star: the neighbours at or below u and u itself are tied to the smallest of them.
        low = edges.groupBy("u").agg(F.min("v").alias("m")).selectExpr(_AGAIN, "m")
        edges = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(edges, "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
        before = now
    raise RuntimeError(f"components: no fixed point after {most_rounds} rounds")
