"""Token blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.arrays import attention, padded
from corpusmill.operators.split import running_sum
from corpusmill.sources.scratch import written


def pack_blocks(rows: DataFrame, order: str, ids: str, block: int) -> DataFrame:
    """(block_no, input_ids): all rows' tokens in order, as one run cut into blocks of `block`; the short rest goes. `order`
    names each row.

    A row's offset comes from sums over ranges of the order, not from one window over all rows; a row is cut where blocks
    end, so that pieces and not tokens are shuffled."""
    # Tokens are made once: the offsets read their numbers, the blocks the tokens.
    kept = written(rows.select(order, F.col(ids).alias("__ids"), F.size(ids).cast("long").alias("__n")), "tokens").where("__n > 0")
    starts = running_sum(kept.select(order, "__n"), "__n", order, name="__off").select(order, "__off")
    off = kept.join(starts, order)
    first, last = F.floor(F.col("__off") / block), F.floor((F.col("__off") + F.col("__n") - 1) / block)
    pieces = off.withColumn("block_no", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.lit(0), F.col("block_no") * block - F.col("__off"))
    hi = F.least(F.col("__n"), (F.col("block_no") + 1) * block - F.col("__off"))
    pieces = pieces.select("block_no", F.struct(F.col("__off").alias("o"), F.slice(F.col("__ids"), (lo + 1).cast("int"), (hi - lo).cast("int")).alias("t")).alias("p"))
    packed = pieces.groupBy("block_no").agg(F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["t"])).alias("input_ids"))
    return packed.where(F.size("input_ids") == block)


def collate(rows: DataFrame, batch: str, ids: str, labels: str, pad_id: int) -> DataFrame:
    """Rows padded to the longest of their batch: input_ids, labels (ignored where padded), attention_mask."""
    most = rows.groupBy(batch).agg(F.max(F.size(ids)).alias("__most"))
    wide = rows.join(most, batch)
    return wide.withColumns({"attention_mask": attention(F.col(ids), F.col("__most")), ids: padded(F.col(ids), F.col("__most"), pad_id), labels: padded(F.col(labels), F.col("__most"), -100)}).drop("__most")
