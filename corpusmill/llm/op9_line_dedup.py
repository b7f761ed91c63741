"""Line dedup: lines that nearly repeat an earlier line are removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import K2, lower_ascii, mix, shingles, slices, span_hashes, utf8, words
from corpusmill.llm.postings import Sets, best_partners, least_overlap, prefix_pairs, shared_keys, shared_sets, slice_bytes
from corpusmill.llm.shared import stored


#: Words of a line from which on it is compared by shingles. Lines of up to SHORT * den / num words are compared by words.
SHORT = 12


def line_sets(k: int, short: int, word_most: int, limit: int):
    """Sets of lines, keyed by document, 2 * line number, plus 1 for the set of words of a line that has no more than
    `word_most`, and hash of the text; the other one holds the shingles of a line of `short` words or more. Between them a
    line has both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Sets]:
        for batch in slices(batches, limit=limit):
            buf, off = utf8(batch.column("text"))
            buf = lower_ascii(buf)
            cuts = np.union1d(off, np.flatnonzero(buf == 10) + 1)
            starts, ends, line = words(buf, cuts)
            h = span_hashes(buf, starts, ends)
            many = np.bincount(line, minlength=len(cuts) - 1)[line] if len(line) else line
            long, few = many >= short, many <= word_most
            tokens, other, owner = shingles(h[long], line[long], k)
            # Words of a line, under hashes that no shingle has but by chance.
            tokens = np.concatenate([tokens, mix(~h[few])])
            other = np.concatenate([other, mix(h[few] ^ K2)])
            owner = np.concatenate([2 * owner, 2 * line[few] + 1])
            # Lines of their document by number; lines without words hold nothing and stay.
            doc = np.searchsorted(off, cuts[:-1], side="right") - 1
            first = np.searchsorted(cuts, off[:-1])
            number = np.arange(len(doc)) - first[doc] if len(doc) else np.zeros(0, np.int64)
            there = np.zeros(2 * len(doc), bool)
            there[owner] = True
            used, owner = np.flatnonzero(there), np.cumsum(there)[owner] - 1
            ids = batch.column("id").to_numpy().astype(np.int64)
            row = batch.column("row").to_numpy()
            yield ids[doc[used >> 1]], 2 * number[used >> 1].astype(np.int64) + (used & 1), row[doc[used >> 1]], tokens, other, owner

    return run


def class_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[Sets]:
    """Token lists of an earlier pass; the full sizes as second key."""
    for batch in batches:
        tokens = batch.column("tokens")
        flat = tokens.flatten().to_numpy(zero_copy_only=False).astype(np.uint64) << np.uint64(16)
        owner = np.repeat(np.arange(len(batch)), np.diff(tokens.offsets.to_numpy()))
        ids = batch.column("id").to_numpy()
        yield ids, batch.column("n").to_numpy(), np.zeros_like(ids), flat, flat, owner, batch.column("o1").to_numpy(), batch.column("o2").to_numpy()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 3, den: int = 4, short: int = SHORT) -> DataFrame:
    """(id, row, line) of each line (from 0, cut at line feeds) that an earlier line resembles, row being the 64-bit hash of its
    text: rows that repeat an id have lines of their own. Lines are in order of id, line and row.

    Words are runs of anything but white space of ASCII, lower-cased in A-Z. Two lines resemble each other at den * |A & B| >=
    num * |A | B|, A and B being their sets of words if neither has more than `short` * den / num, or their sets of
    `k`-word shingles if both have `short` words or more; lines between these bounds are compared either way. So a line
    of any length has partners both shorter and longer. A line without words is never removed.

    Equal sets form classes; of a class all but the first line go, and all of them if an earlier class resembles it,
    whether that one stays or not. A second pass over the classes of shingles leaves those that share enough with other
    classes, and names the earliest class of each token: where that one resembles the line, the matter is settled. So it
    is for lines that resemble one of their few likeliest partners. The rest meet through prefixes in order of rarity,
    by one shingle or by two words, with length and positional filters (`prefix_pairs`), and are verified exactly.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null").withColumn("row", F.xxhash64("text"))
    sets = line_sets(k, short, short * den // num, slice_bytes(docs.sparkSession))
    equal = ["digest", "digest2", "n"]
    lines = stored(shared_sets(rows, sets, num, den).select(*equal, F.struct("key1", "key2", "key3").alias("at"), "tokens"), "lines", "zstd")
    classes = lines.groupBy(*equal).agg(F.min(F.struct("at", "tokens")).alias("m")).select(*equal, "m.at.*", "m.tokens")
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes", "zstd")
    asked = classes.selectExpr("class as id", "n", "key1 as o1", "key2 as o2", "tokens")
    ranked = asked.where("o2 % 2 = 0").repartitionByRange("o1", "o2", "id").sortWithinPartitions("o1", "o2", "id")
    own = shared_sets(ranked, class_sets, num, den, sized=True).selectExpr("key1 as id", "n", "tokens", "batch", "idx", "lead_batch", "lead_idx", "lead_overlap")
    own = own.join(asked.selectExpr("id", "o1", "o2"), "id")
    # Nearly every word is in some other line: a second pass would leave sets of words as they are.
    own = own.unionByName(asked.where("o2 % 2 = 1"), allowMissingColumns=True)
    listed = stored(own.selectExpr("*", "id as label", "o2 % 2 = 1 as paired"), "listed", "zstd")
    keys = shared_keys(listed, num, den)
    # The first class of a line's tokens: if it resembles the line, the line goes, and is asked about no more.
    lead = listed.selectExpr("batch as lead_batch", "idx as lead_idx", "id as b", "n as nb")
    led = listed.join(lead, ["lead_batch", "lead_idx"]).where(f"id <> b and {den} * lead_overlap >= {num} * (n + nb - lead_overlap) and {least_overlap(num, den, 'lead_overlap')}").select("id").distinct()
    led = stored(led, "led")
    for last in (False, True):
        # First the likeliest partners alone, which settles most lines of many near copies; then all pairs of the others.
        left = keys.join(led.withColumn("led", F.lit(True)), "id", "left").withColumn("open", F.col("led").isNull())
        led = stored((prefix_pairs if last else best_partners)(listed, num, den, left).selectExpr("a as id").union(led).distinct(), "led")
    later = led.selectExpr("id as class")
    first = classes.select(*equal, "class", F.struct("key1", "key2", "key3").alias("first"))
    gone = lines.select(*equal, "at").join(first, equal).join(later.withColumn("later", F.lit(True)), "class", "left").where("later or at <> first")
    return gone.selectExpr(f"at.key1 as {id_col}", "at.key3 as row", "at.key2 div 2 as line").distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 3, den: int = 4, short: int = SHORT) -> DataFrame:
    """`docs` with the repeated lines of `repeated_lines` taken out of `text_col` and, as n_lines_removed, their number (in
    place of a column of that name); documents of which no line with a word is left have empty text.

    Nulls: null text stays null; a row with null id is not compared and stays whole. Rows that repeat an id
    are told apart by their texts, and lose only lines of their own; rows that repeat both lose the same lines. Long texts are
    whole; an empty table gives none.
    """
    gone = repeated_lines(docs, id_col, text_col, k, num, den, short)
    drop = gone.groupBy(F.col(id_col).alias("__gone_id"), F.col("row").alias("__gone_row")).agg(F.collect_list("line").alias("__gone"))
    of_row = (F.col(id_col).cast("long") == F.col("__gone_id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__gone_row"))
    out = docs.drop("n_lines_removed").join(drop, of_row, "left")
    # Lines are split once, taken by their places in linear time, and joined once. The partition's number, which is never below
    # 0, keeps the optimiser from putting either step in the place of its name: in the function that is called for each line,
    # or in every use of the new text. (It knows that a random number isn't below 0, and drops that.)
    once = F.spark_partition_id() >= 0
    out = out.withColumn("__lines", F.when(F.col("__gone").isNotNull() & once, F.split(F.col(text_col), "\n", -1)))
    places = F.array_except(F.sequence(F.lit(0).cast("long"), (F.size("__lines") - 1).cast("long")), "__gone")
    out = out.withColumn("__kept", F.when(once, F.array_join(F.transform(places, lambda i: F.get("__lines", i.cast("int"))), "\n")))
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.when(F.regexp_like("__kept", F.lit("[^\\x20\\x09-\\x0D]")), F.col("__kept")).otherwise(F.lit("")))
    return out.withColumn("n_lines_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long")).withColumn(text_col, text).drop("__gone", "__gone_id", "__gone_row", "__lines", "__kept")
