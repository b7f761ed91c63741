"""Unified diffs as text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import fold_behavior, strip


def changed_files(c: Column) -> Column:
    """Distinct new paths of `diff --git` headers."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit("(?m)^diff --git a/\\S+ b/(\\S+)"), F.lit(1)))


def tier(raw: Column, context: Column, raw_most: int = 35_000, context_most: int = 20_000) -> Column:
    """1 for a diff that fits, 2 where its context does, else 3."""
    n = F.length(F.coalesce(context, F.lit("")))
    return F.when(F.length(raw) <= raw_most, 1).when((n > 0) & (n <= context_most), 2).otherwise(3)


def tier_factor(t: Column) -> Column:
    return F.when(t == 1, 1.0).when(t == 2, 0.95).otherwise(0.85)


def file_blocks(c: Column) -> Column:
    return F.filter(F.split(c, "(?m)^(?=diff --git )", -1), lambda b: F.startswith(b, F.lit("diff --git ")))


def op_type(block: Column) -> Column:
    return (
        F.when(F.regexp_like(block, F.lit("(?m)^new file mode|^--- /dev/null")), "ADD")
        .when(F.regexp_like(block, F.lit("(?m)^deleted file mode|^\\+\\+\\+ /dev/null")), "DELETE")
        .when(F.regexp_like(block, F.lit("(?m)^rename (from|to) ")), "RENAME")
        .otherwise("MODIFY")
    )


def op_types(c: Column) -> Column:
    """Map of path to ADD, DELETE, RENAME or MODIFY."""
    return F.map_from_entries(F.transform(file_blocks(c), lambda b: F.struct(F.regexp_extract(b, "^diff --git a/\\S+ b/(\\S+)", 1), op_type(b))))


def changed_lines(c: Column, sign: str) -> Column:
    """Distinct added (+) or removed (-) lines, stripped, without headers and blanks."""
    lines = F.filter(F.split(c, "\n", -1), lambda x: F.startswith(x, F.lit(sign)) & ~F.startswith(x, F.lit(sign * 3)))
    return F.array_distinct(F.filter(F.transform(lines, lambda x: strip(F.substring(x, F.lit(2), F.length(x)))), lambda x: x != ""))


def hunk_header(line: Column) -> Column:
    """(old_start, old_count, new_start, new_count) of a hunk line; a missing count is 1."""
    pattern = "^@@ -(\\d+)(?:,(\\d+))? \\+(\\d+)(?:,(\\d+))? @@"
    part = lambda i, d: F.coalesce(F.nullif(F.regexp_extract(line, pattern, i), F.lit("")), F.lit(d)).cast("int")
    return F.when(F.regexp_like(line, F.lit(pattern)), F.struct(part(1, None).alias("old_start"), part(2, "1").alias("old_count"), part(3, None).alias("new_start"), part(4, "1").alias("new_count")))


def diff_lines(diffs: DataFrame, key: str, diff: str) -> DataFrame:
    """(key, pos, path, kind, text, old_line, new_line) of each line inside a hunk: kind is +, - or a blank; the line numbers
    are those of the side that has the line. A diff is one record, so its lines are one window."""
    lines = diffs.select(key, F.posexplode(F.split(diff, "\n", -1)).alias("pos", "line"))
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    head = lines.withColumn("h", hunk_header(F.col("line"))).withColumn("p", F.nullif(F.regexp_extract("line", "^diff --git a/\\S+ b/(\\S+)", 1), F.lit("")))
    head = head.withColumn("path", F.last("p", ignorenulls=True).over(w)).withColumn("start", F.last("h", ignorenulls=True).over(w)).withColumn("hunk", F.count("h").over(w)).withColumn("file", F.count("p").over(w))
    kind = F.substring("line", 1, 1)
    header = F.col("h").isNotNull() | F.col("p").isNotNull() | F.regexp_like("line", F.lit("^(---|\\+\\+\\+) |^(index|new file|deleted file|old mode|new mode|similarity|rename) "))
    body = head.where((F.col("hunk") > 0) & ~header & kind.isin("+", "-", " ")).withColumn("kind", kind)
    v = Window.partitionBy(key, "hunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    seen = lambda k: F.coalesce(F.sum(F.col("kind").isin(k, " ").cast("int")).over(v), F.lit(0))
    return body.select(
        key, "pos", "path", "kind", F.expr("substring(line, 2)").alias("text"),
        F.when(F.col("kind") != "+", F.col("start.old_start") + seen("-")).alias("old_line"), F.when(F.col("kind") != "-", F.col("start.new_start") + seen("+")).alias("new_line"),
    )


def same_changes(a: Column, b: Column) -> Column:
    """Whether two diffs change the same files and add and remove the same lines."""
    equal = lambda x, y: (F.size(F.array_except(x, y)) == 0) & (F.size(F.array_except(y, x)) == 0)
    return equal(changed_files(a), changed_files(b)) & equal(changed_lines(a, "+"), changed_lines(b, "+")) & equal(changed_lines(a, "-"), changed_lines(b, "-"))


def behavior_set(summary: Column, label: str) -> Column:
    """Items of a labelled bullet of a summary, folded, longer than five characters."""
    body = F.regexp_extract(summary, f"(?mi)^[-*\\s]*{label}\\s*:\\s*(.*)$", 1)
    return F.array_distinct(F.filter(F.transform(F.split(body, "[;,]", -1), fold_behavior), lambda x: F.length(x) > 5))


def behavior_gap(human: Column, model: Column) -> Column:
    """OK, or the first category that differs: primary must be equal, error handling and edge cases not missing."""
    lost = lambda label: F.size(F.array_except(behavior_set(human, label), behavior_set(model, label))) > 0
    extra = F.size(F.array_except(behavior_set(model, "primary"), behavior_set(human, "primary"))) > 0
    return F.when(lost("primary") | extra, "primary").when(lost("error_handling"), "error_handling").when(lost("edge_cases"), "edge_cases").otherwise("OK")


def chunk_diff(c: Column, most: int, overlap: int = 5) -> Column:
    """Line-packed chunks of at most `most` characters (longer only where `overlap` lines and one more exceed it); each
    starts with the last `overlap` lines of the one before. No line is lost."""
    shape = "struct<done: array<string>, buf: array<string>, size: int>"
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("buf"), F.lit(0).alias("size")).cast(shape)

    def step(acc, line):
        full = (F.size(acc["buf"]) > 0) & (acc["size"] + F.length(line) + 1 > most)
        tail = F.slice(acc["buf"], F.greatest(F.size(acc["buf"]) - overlap + 1, F.lit(1)), overlap)
        buf = F.concat(F.when(full, tail).otherwise(acc["buf"]), F.array(line))
        size = F.aggregate(buf, F.lit(0), lambda a, x: a + F.length(x) + 1)
        return F.struct(F.when(full, F.concat(acc["done"], F.array(F.array_join(acc["buf"], "\n")))).otherwise(acc["done"]).alias("done"), buf.alias("buf"), size.alias("size")).cast(shape)

    return F.aggregate(F.split(c, "\n", -1), start, step, lambda a: F.concat(a["done"], F.array(F.array_join(a["buf"], "\n"))))
