"""Orders, splits, caps and interleaves that a run repeats exactly.

Global ranks do not use one unpartitioned window: rows are cut into ranges of the order, counted by range, and numbered
from their range's offset.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_key(seed: int, key: Column) -> Column:
    """A seeded order that other engines can repeat: SHA-256 of `seed:key`."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


#: Rows of a range of a global order, on the average; ranges at most, as a square; keys sampled for each range.
ROWS, SIDE, SAMPLED = 200_000, 64, 20


def _ranged(df: DataFrame, order: tuple[str, ...]) -> tuple[DataFrame, bool]:
    """Adds __p, the number of a row's range, and says whether there are several: ranges ascend in the order of all its columns,
    and grow in number with the rows. The cuts are whole keys, from a bounded sample that is taken once, so that a row's
    range follows from its key alone however often the plan runs. A row finds it in two steps of at most SIDE comparisons."""
    n = df.count()
    parts = min(SIDE * SIDE, -(-n // ROWS))
    if parts <= 1:
        return df.withColumn("__p", F.lit(0)), False
    keys = df.select(*order).sample(min(1.0, SAMPLED * parts / n), 7).limit(2 * SAMPLED * parts).collect()
    first = lambda k: tuple((x is not None, x) if x is not None else (False, 0) for x in k)
    keys = sorted({tuple(k) for k in keys}, key=first)
    cuts = [keys[i * len(keys) // parts] for i in range(1, parts)] if keys else []
    cuts = sorted(set(cuts), key=first)
    side = max(1, math.isqrt(len(cuts)) + 1)
    kinds = [df.schema[c].dataType for c in order]
    lit = lambda k: F.struct(*[F.lit(x).cast(t).alias(c) for c, x, t in zip(order, k, kinds, strict=True)])
    key = F.struct(*order)
    below = lambda some: F.size(F.filter(some, lambda c: c <= key))
    groups = [cuts[i : i + side] for i in range(0, len(cuts), side)]
    if not groups:
        return df.withColumn("__p", F.lit(0)), False
    coarse = df.withColumn("__g", below(F.array(*[lit(g[0]) for g in groups])))
    fine = below(F.get(F.array(*[F.array(*[lit(c) for c in g]) for g in groups]), F.col("__g") - 1))
    return coarse.withColumn("__p", F.when(F.col("__g") == 0, 0).otherwise((F.col("__g") - 1) * side + fine)).drop("__g"), True


def running_sum(df: DataFrame, value: str, *order: str, name: str = "before") -> DataFrame:
    """Adds the sum of `value` over all rows before this one, in ascending order of columns. Within a range by a window, before
    it by the sums of the ranges."""
    placed, several = _ranged(df, order)
    inner = Window.partitionBy("__p").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("__r", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    if not several:
        return local.withColumn(name, F.col("__r")).drop("__p", "__r")
    sums = placed.groupBy("__p").agg(F.sum(value).alias("__s"))
    # One row for each range: SIDE * SIDE at most.
    offsets = sums.withColumn("__range_start", F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__range_start")
    return local.join(F.broadcast(offsets), "__p").withColumn(name, F.col("__r") + F.col("__range_start")).drop("__p", "__r", "__range_start")


def global_rank(df: DataFrame, *order: str, name: str = "rank") -> DataFrame:
    """Adds 1, 2, ... over all rows in ascending order of columns, nulls first. Rows are dealt to ranges of the order and
    numbered within a range from the number of rows before it."""
    counted = running_sum(df.withColumn("__one", F.lit(1).cast("long")), "__one", *order, name="__b")
    return counted.withColumn(name, (F.col("__b") + 1).cast("long")).drop("__one", "__b")


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42, name: str = "position") -> DataFrame:
    return global_rank(df.withColumn("__k", shuffle_key(seed, F.col(key))), "__k", key, name=name).drop("__k")


def ratio_split(df: DataFrame, key: str, train: float, val: float, test: float, seed: int = 42) -> DataFrame:
    """Adds split with exact sizes: floor(n * train), floor(n * val), the rest."""
    if abs(train + val + test - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")
    total = df.agg(F.count("*").alias("__n"))
    out = seeded_shuffle(df, key, seed, "__pos").crossJoin(F.broadcast(total))
    a, b = F.floor(F.col("__n") * train), F.floor(F.col("__n") * val)
    return out.withColumn("split", F.when(F.col("__pos") <= a, "train").when(F.col("__pos") <= a + b, "val").otherwise("test")).drop("__pos", "__n")


def fixed_split(df: DataFrame, key: str, test_size: int, seed: int = 12) -> DataFrame:
    return seeded_shuffle(df, key, seed, "__pos").withColumn("split", F.when(F.col("__pos") <= test_size, "test").otherwise("train")).drop("__pos")


def cap_per_group(df: DataFrame, group: str, most: int, *order: str) -> DataFrame:
    """The first `most` rows of each group. Rank filters of this form stop early within a partition before the shuffle."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("__r") <= most).drop("__r")


def top_k(df: DataFrame, group: str, score: str, tie: str, k: int) -> DataFrame:
    """The k best of each group with their rank, ties by the smaller `tie`."""
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def round_robin(df: DataFrame, order: str, choices: list[str], name: str = "choice") -> DataFrame:
    """The i-th row gets choice i modulo their number."""
    ranked = global_rank(df, order, name="__i")
    return ranked.withColumn(name, F.element_at(F.array(*[F.lit(c) for c in choices]), ((F.col("__i") - 1) % len(choices)).cast("int") + 1)).drop("__i")


#: Parts of a mean gap that arrivals are counted in: whole numbers, whose sums are the same in any order.
GAP = 1 << 20


def arrival_gap(seed: int, *key: Column) -> Column:
    """An exponential gap of mean GAP, rounded down, from the hash of a row's key."""
    x = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key])), 1, 13), 16, 10).cast("double")
    return F.floor(-F.log((x + 0.5) / float(1 << 52)) * GAP).cast("long")


def interleave(df: DataFrame, source: str, order: str, weights: Mapping[str, float], seed: int = 42) -> DataFrame:
    """Sources merged by draws with probabilities `weights` until the first is used up; within a source rows stay in `order`, a
    key that names each row. Adds slot: rows in its order, ties by source and key, are the merged sequence.

    Each row arrives a gap after the one before it in its source, exponential and at the source's rate: of arrivals laid over
    each other the next one is of a source with the probability of its weight, whatever came before. So running sums by
    source make the draws, without a pass in sequence. Gaps are hashed from seed and key and summed as whole numbers: the
    result does not depend on partitions. Sources without a weight, or of null order, take no part."""
    w = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))])
    mine = df.where(F.col(source).isin(list(weights)) & F.col(order).isNotNull()).withColumn("__gap", arrival_gap(seed, F.col(source), F.col(order)))
    sums = mine.groupBy(source).agg(F.sum("__gap").alias("__s")).collect()  # sources are as few as the weights
    offset, at = {}, 0
    for name, total in sorted(((r[0], r[1]) for r in sums), key=lambda x: x[0].encode()):
        offset[name], at = at, at + total
    off = F.create_map(*[F.lit(x) for k, v in offset.items() for x in (k, v)]) if offset else F.create_map().cast("map<string,bigint>")
    summed = running_sum(mine, "__gap", source, order, name="__before")
    slotted = summed.withColumn("slot", (F.col("__before") + F.col("__gap") - off[F.col(source)]) / float(GAP) / w[F.col(source)])
    end = min((r[1] / float(GAP) / weights[r[0]] for r in sums), default=0.0)
    return slotted.where(F.col("slot") <= F.lit(end)).drop("__gap", "__before")


def normalized_weights(df: DataFrame, col: str) -> DataFrame:
    total = df.agg(F.sum(col).alias("__t"))
    return df.crossJoin(F.broadcast(total)).withColumn("share", F.col(col) / F.col("__t")).drop("__t")
