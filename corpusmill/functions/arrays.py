"""Token arrays: masks, cuts, padding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED = -100


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it. Branches of conditions do not share work."""
    return F.transform(F.array(value), body)[0]


def once(value: Column) -> Column:
    """The value as a column that no optimiser puts in the place of its name: what reads the column reads what was computed. The
    partition's number, which is never below 0, is not known to be so before it runs."""
    return F.when(F.spark_partition_id() >= 0, value)


def cut_with_eos(ids: Column, eos: int, size: int) -> Column:
    return F.slice(F.concat(ids, F.array(F.lit(eos))), 1, size)


def masked_labels(ids: Column, prompt: Column) -> Column:
    """IGNORED for the prompt's tokens, the rest as they are."""
    n = F.least(prompt, F.size(ids))
    return F.concat(F.array_repeat(F.lit(IGNORED), n), F.slice(ids, n + 1, F.greatest(F.size(ids) - n, F.lit(0))))


def padded(ids: Column, size: Column, fill: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(fill), F.greatest(size - F.size(ids), F.lit(0))))


def attention(ids: Column, size: Column) -> Column:
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), F.greatest(size - F.size(ids), F.lit(0))))
