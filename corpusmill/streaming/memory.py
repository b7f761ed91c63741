"""A session's memory of accepted questions, with fuzzy keys, as state of a stream."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from corpusmill.operators.similarity import greedy_keep

#: Fixed order of marks, rarest letters first; any order is right, a good one makes keys rare. Others come before these.
_COMMON = "zqxjkvbpygfwmucldrhsnioate "
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keys(text: str, threshold: float) -> list[str]:
    """Marks, of which two texts that reach the threshold have one in common.

    A mark is a character with its occurrence number; the matching blocks of two texts of n and m characters are marks that
    both have, so threshold * (n + m) / 2 are common, with m at least threshold / (2 - threshold) * n. Marks stand in
    one order for all texts; the first ones, one more than may be missing, hold a common one.
    """
    counted = sorted(((-k, _COMMON.find(c), c) for c, m in Counter(text).items() for k in range(1, m + 1)))
    need = -(-len(text) * threshold // (2 - threshold)) if threshold < 2 else len(text)
    return [f"{c}{-k}" for k, _, c in counted[: max(1, int(len(text) - need + 1))]] or [""]


def alike(a: str, b: str, threshold: float) -> bool:
    from difflib import SequenceMatcher

    if min(len(a), len(b)) * 2 < threshold * (len(a) + len(b)):
        return False
    m = SequenceMatcher(None, a, b)
    return m.quick_ratio() >= threshold and m.ratio() >= threshold


class Meetings(StatefulProcessor):
    """State of one key: the questions that have come under it, in lists of their own. Gives each new question with the earlier ones
    that resemble it, of this batch or of those before."""

    def __init__(self, threshold: float, ttl_ms: int | None):
        self.threshold, self.ttl_ms = threshold, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "id long, at string, batch long, text string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = sorted(((r.at_, r.id, r.text, r.lead, r.row) for f in rows for r in f.itertuples()), key=lambda r: (r[0], r[1]))
        batch = int(TaskContext.get().getLocalProperty("streaming.sql.batchId"))
        old = [tuple(x) for x in self.seen.get()] if self.seen.exists() else []
        out: list[tuple] = []
        for at, i, text, lead, row in new:
            out += [(i, j, b, None) for j, _, b, t in old if alike(t, text, self.threshold)]
            if lead:
                out.append((i, None, None, row))
            old.append((i, at, batch, text))
        # Appended once for the batch: the state store keeps them with the batch's own commit.
        self.seen.appendList([(i, at, batch, text) for at, i, text, _, _ in new])
        yield pd.DataFrame(out, columns=["id", "earlier", "batch", "row"]).astype({"id": "int64", "earlier": "Int64", "batch": "Int64"})

    def close(self) -> None:
        pass


def accept_unlike(stream: DataFrame, path: str, checkpoint: str, id_col: str, text_col: str, order: str, threshold: float = 0.85, ttl_ms: int | None = None) -> StreamingQuery:
    """Append to `path` the questions that resemble no accepted earlier one: Ratcliff-Obershelp ratio of the texts, lower case and
    stripped, below `threshold`. It equals one pass over all batches in turn, in each by `order`, then by id.

    Questions are dealt by their rarest marks, and the texts that a key has seen are state in the state store: a batch reads
    its own keys, not the accepted rows, and a restart goes on from the last commit. Pairs that resemble each other then
    decide, each by whether the earlier one was accepted, for which only the batches that they name are read. A batch that
    runs again writes its partition anew.

    With `ttl_ms` a question is forgotten after so long. Null and empty texts are dropped. Ids are unique integers; a question
    that comes again under its id resembles itself and is refused. Other columns are kept.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)

    @F.pandas_udf("struct<text:string,keys:array<string>>")
    def marked(texts: pd.Series) -> pd.DataFrame:
        plain = [t.lower().strip() for t in texts]
        return pd.DataFrame({"text": plain, "keys": [keys(t, threshold) for t in plain]})

    whole = stream.where(F.col(text_col) != "").withColumn("__row", F.to_json(F.struct(*stream.columns)))
    each = whole.select(F.col(id_col).cast("long").alias("id"), F.col(order).cast("string").alias("at_"), "__row", marked(F.col(text_col)).alias("m"))
    dealt = each.select("id", "at_", "m.text", F.posexplode("m.keys").alias("pos", "key"), "__row").selectExpr("key", "id", "at_", "text", "pos = 0 as lead", "if(pos = 0, __row, null) as row")
    mode = "None" if ttl_ms is None else "ProcessingTime"
    met = dealt.groupBy("key").transformWithStateInPandas(Meetings(threshold, ttl_ms), "id long, earlier long, batch long, row string", "Append", mode)

    def write(batch: DataFrame, number: int) -> None:
        held = batch.sparkSession
        rows = f"{checkpoint}-steps/batch={number}"
        batch.write.mode("overwrite").parquet(rows)
        step = held.read.parquet(rows)
        new = step.where("row is not null").selectExpr("id", f"from_json(row, '{schema}') as r")
        pairs = step.where("earlier is not null").select("id", "earlier", "batch").distinct()
        before = pairs.where(f"batch < {number}")
        if not before.isEmpty() and _exists(held, path):
            accepted = held.read.parquet(path).where(f"batch < {number}").selectExpr(f"cast({id_col} as long) as earlier", "cast(batch as long) as batch")
            new = new.join(before.join(accepted, ["earlier", "batch"]).select("id").distinct(), "id", "left_anti")
        # The rest of the batch: in its order, one goes if a kept earlier one resembles it. Refused ones refuse nobody.
        now = pairs.where(f"batch = {number}").join(new.selectExpr("id as earlier"), "earlier", "left_semi").join(new.select("id"), "id", "left_semi").selectExpr("earlier as a", "id as b")
        kept = greedy_keep(now, new.select("id"), "id")
        held.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        new.join(kept, "id", "left_semi").select("r.*").withColumn("batch", F.lit(number)).write.mode("overwrite").partitionBy("batch").parquet(path)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema)
    return met.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
