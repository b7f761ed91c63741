"""The structure of source files as rows of lines: functions and containers, the lines that a diff changes, and both brought together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.sources.scratch import written

# What starts a function or a block, by file extension.
STARTS = {
    ".py": (r"\s*(async\s+)?def\s+\w+", r"\s*class\s+\w+"),
    ".js": (r"\s*(export\s+)?(async\s+)?function\s+\w+", r"\s*(export\s+)?(const|let|var)\s+\w+\s*=\s*(async\s+)?\(", r"\s*(export\s+)?class\s+\w+"),
    ".ts": (r"\s*(export\s+)?(async\s+)?function\s+\w+", r"\s*(export\s+)?(const|let|var)\s+\w+\s*=\s*(async\s+)?\(", r"\s*(export\s+)?class\s+\w+"),
    ".toml": (r"\s*\[+[^\]]+\]+",),
    ".rs": (r"\s*(?:pub(?:\s*\([^)]*\))?\s+)?(?:async\s+)?fn\s+\w+",),
}
# Rust's containers, and what counts as a comment or attribute above a declaration.
RUST_TYPE = r"^\s*(?:pub(?:\s*\([^)]*\))?\s+)?(struct|enum|trait|mod)\s+(\w+)(\s*\{)?"
RUST_IMPL = r"^\s*impl\b"
LEAD = r"^\s*(#\[|//|/\*)"
# The name that a declaration gives, by extension; the first form that fits, else the first word.
NAMES = {
    ".rs": (r"\bfn\s+(\w+)",),
    ".py": (r"\b(?:def|class)\s+(\w+)",),
    ".js": (r"\bfunction\s+(\w+)", r"\b(?:const|let|var)\s+(\w+)", r"\bclass\s+(\w+)"),
    ".ts": (r"\bfunction\s+(\w+)", r"\b(?:const|let|var)\s+(\w+)", r"\bclass\s+(\w+)"),
}
#: Comments, strings of both kinds, characters and lifetimes of Rust: what braces don't count in.
OPAQUE = r"""(?s)//[^\n]*|/\*.*?(?:\*/|\z)|\br(#*)".*?(?:"\1|\z)|"(?:\\.|[^"\\])*+(?:"|\z)|'(?:\\.[^']?|[^\w'\\])'|'[^\W\d]\w*'?"""
#: Characters of text in a task's windows, on average.
PART = 4_000_000
# Lines around a change outside of functions, and lines shown around a region.
NEAR, AROUND = 5, 3
HEADER = "# Enhanced Git Diff with Full Function Context\n# This diff shows complete functions/methods that contain changes\n# to help understand the full context of modifications.\n"


def extension(path: Column) -> Column:
    return F.regexp_extract(path, r"(\.[^./]*)$", 1)


def masked(text: Column) -> Column:
    """The text with blanks for what is opaque: pieces between and opaque ones alternate. Line feeds stay where they are."""
    hits = F.transform(F.regexp_extract_all(text, F.lit(OPAQUE), F.lit(0)), lambda x: F.regexp_replace(x, r"[^\n]", " "))
    pairs = F.arrays_zip(F.split(text, OPAQUE, -1).alias("a"), hits.alias("b"))
    return F.array_join(F.transform(pairs, lambda x: F.concat(F.coalesce(x["a"], F.lit("")), F.coalesce(x["b"], F.lit("")))), "")


def source_lines(files: DataFrame, keys: list[str], path: str = "path", text: str = "text") -> DataFrame:
    """(keys, path, ext, n, line, body, code): the lines of each file from 1 to n, and in `code` those of Rust without what is
    opaque. A null text has no lines."""
    ext = extension(F.col(path))
    both = files.where(F.col(text).isNotNull()).select(*keys, F.col(path).alias("path"), ext.alias("ext"), F.split(text, "\n", -1).alias("a"), F.split(F.when(ext == ".rs", masked(F.col(text))).otherwise(F.col(text)), "\n", -1).alias("b"))
    rows = both.select(*keys, "path", "ext", F.size("a").alias("n"), F.posexplode(F.arrays_zip("a", "b")))
    return rows.select(*keys, "path", "ext", "n", (F.col("pos") + 1).alias("line"), F.col("col.a").alias("body"), F.col("col.b").alias("code"))


def parts(texts: DataFrame, *held: Column) -> int:
    """Into how many parts to deal texts: of at most PART characters of `held` on average, the session's number of partitions at
    least. Windows then form where a text lies, and a task holds as much of a large table as of a small one."""
    size = F.lit(0)
    for c in held:
        size = size + F.coalesce(F.length(c), F.lit(0))
    chars = texts.agg(F.sum(size.cast("long"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), chars // PART)


def _declared(lines: DataFrame, file: list[str]) -> DataFrame:
    """Lines with what they declare: `fn`, `typed` and `impl`; for those the first line of the comments and attributes above (Rust)
    and, for an impl, what it says up to its brace, over several lines if need be. `levels` are the indents of a file's starts."""
    body, ext = F.col("body"), F.col("ext")
    by_file = Window.partitionBy(*file).orderBy("line")
    fits = F.lit(False)
    for e, forms in STARTS.items():
        fits = fits | ((ext == e) & F.rlike(body, F.lit("^(?:" + "|".join(forms) + ")")))
    rust = ext == ".rs"
    kind = F.regexp_extract(body, RUST_TYPE, 1)
    typed = rust & ((kind != "") & ((kind != "mod") | (F.regexp_extract(body, RUST_TYPE, 3) != "")))
    lines = lines.withColumns({"fn": fits, "typed": typed, "impl": rust & F.rlike(body, F.lit(RUST_IMPL)), "lead": F.rlike(body, F.lit(LEAD)), "bare": F.trim("body"), "indent": F.length("body") - F.length(F.ltrim("body"))})
    # A line that ends the run of comments above: neither one itself, nor a single blank line below one.
    breaks = ~F.col("lead") & ~((F.col("bare") == "") & F.coalesce(F.lag("lead").over(by_file), F.lit(False)))
    past = F.coalesce(F.lag(F.contains(body, F.lit("{"))).over(by_file), F.lit(False))
    marked = lines.withColumns({"breaks": breaks, "past": past})
    above = F.last(F.when(F.col("breaks"), F.col("line")), ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, -1))
    # The line of the impl whose words up to its brace a line has, else 0.
    of = F.last(F.when(F.col("impl"), F.col("line")).when(F.col("past"), 0), ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, 0))
    levels = F.collect_set(F.when((ext == ".py") & F.col("fn"), F.col("indent"))).over(Window.partitionBy(*file))
    marked = marked.withColumns({"top": F.when(rust, F.coalesce(above, F.lit(0)) + 1).otherwise(F.col("line")), "of": F.coalesce(of, F.lit(0)), "levels": levels})
    start = F.col("fn") | F.col("typed") | F.col("impl")
    says = (F.col("of") > 0) & (F.col("impl") | ((F.col("bare") != "") & ~F.startswith("bare", F.lit("//"))))
    marked = marked.withColumns({"start": start, "says": says}).where("start or says or size(levels) > 0 or contains(code, '{') or contains(code, '}')")
    said = F.collect_list(F.when(F.col("says"), F.struct("line", F.col("bare").alias("t")))).over(Window.partitionBy(*file, "of"))
    head = F.array_join(F.transform(F.array_sort(said), lambda x: x["t"]), " ")
    name = F.trim(F.regexp_replace(F.trim(F.substring_index(head, "{", 1)), "^impl", ""))
    return marked.withColumns({"impl_name": F.when(F.col("impl"), name), "type_kind": kind, "type_name": F.regexp_extract(body, RUST_TYPE, 2)})


def _ended(lines: DataFrame, file: list[str]) -> DataFrame:
    """Starts with `last`, the line where they end. A block is closed by the next brace that brings the depth back to what it was at
    the start, once one was opened; in Python by the line before the next one, neither blank nor comment, that is not indented
    more; a section by the next one. What nothing closes goes to the last line.

    A start and the braces of a line, or the indents that it ends, are rows of one window, read from the end of the file.
    """
    ext, py = F.col("ext"), F.col("ext") == ".py"
    event = lambda pos, step, level: F.struct(pos.cast("int").alias("pos"), step.cast("int").alias("step"), level.cast("int").alias("level"))
    none = F.array().cast("array<struct<pos:int,step:int,level:int>>")
    starts = F.when(F.col("start"), F.array(event(F.lit(-1), F.lit(0), F.when(py, F.col("indent"))))).otherwise(none)
    braces = F.transform(F.regexp_extract_all("code", F.lit("[{}]"), F.lit(0)), lambda b, i: event(i, F.when(b == "{", 1).otherwise(-1), F.lit(None)))
    ends = F.transform(F.filter("levels", lambda v: v >= F.col("indent")), lambda v: event(F.lit(-2), F.lit(-1), v))
    ended = F.when(ext.isin(".rs", ".js", ".ts"), braces).when(py & (F.col("bare") != "") & ~F.startswith("bare", F.lit("#")), ends).otherwise(none)
    held = ["ext", "n", "body", "fn", "typed", "impl", "top", "impl_name", "type_kind", "type_name"]
    rows = lines.select(*file, "line", *held, F.explode(F.concat(starts, ended)).alias("e"))
    at = F.col("e.pos") == -1
    rows = rows.select(*file, "line", "e.*", at.alias("start"), *[c if c == "ext" else F.when(at, F.col(c)).alias(c) for c in held])
    later = Window.partitionBy(*file).orderBy(F.desc("line"), F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    depth = F.coalesce("level", -F.coalesce(F.sum(F.when(F.col("level").isNull(), F.col("step"))).over(later), F.lit(0)))
    opens = F.last(F.when(F.col("step") == 1, F.struct("line", "pos")), ignorenulls=True).over(later)
    rows = rows.withColumns({"depth": depth, "open": opens, "next": F.last(F.when(F.col("start"), F.col("line")), ignorenulls=True).over(later)}).where("start or step < 0")
    # A start stands where its first brace opens; from there on the next closing brace of its depth is its own.
    braced = F.col("start") & ~py
    rows = rows.withColumns({"depth": F.when(~braced | F.col("open").isNotNull(), F.col("depth")), "place": F.when(braced, F.col("open")).otherwise(F.struct("line", "pos"))})
    order = Window.partitionBy(*file, "depth").orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)
    close = F.last(F.when(~F.col("start"), F.col("line") - F.when(py, 1).otherwise(0)), ignorenulls=True).over(order)
    rows = rows.withColumn("close", close).where("start")
    return rows.withColumn("last", F.coalesce(F.when(ext == ".toml", F.col("next") - 1).otherwise(F.col("close")), F.col("n")))


def source_blocks(files: DataFrame, keys: list[str], path: str = "path", text: str = "text") -> DataFrame:
    """(keys, path, kind, name, first, last, signature): functions of each file and, as kind `container`, Rust's structs, enums,
    traits, modules with a body and impl blocks; lines from 1, both inclusive. Python, JavaScript, TypeScript, Rust and, by
    sections, TOML; other files have none. Rust's spans begin with the comments and attributes above.

    Files are dealt once; ends are then found by windows over lines: by the depth of braces, by indents, by the next section.
    A file is a partition of these windows, so that its size, not the number of files, bounds a task. Braces in strings and
    comments count in all but Rust. A block that nothing closes goes to the last line.
    """
    files = files.where(extension(F.col(path)).isin(*STARTS)).select(*keys, F.col(path).alias("path"), F.col(text).alias("text"))
    files = files.withColumn("deal", F.xxhash64(*keys, "path")).repartition(parts(files, F.col("text")), "deal")
    return _blocks(source_lines(files, ["deal", *keys]), ["deal", *keys]).drop("deal")


def _blocks(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks of lines. Keys that lines are dealt by come first, so that no window shuffles them."""
    ext, file = F.col("ext"), [*keys, "path"]
    starts = _ended(_declared(lines.where(ext.isin(*STARTS)), file), file)
    names = F.lit(None).cast("string")
    for e, forms in NAMES.items():
        found = F.coalesce(*[F.nullif(F.regexp_extract("body", f, 1), F.lit("")) for f in forms])
        names = F.when(ext == e, found).otherwise(names)
    names = F.coalesce(names, F.nullif(F.regexp_extract("body", r"\b(\w+)", 1), F.lit("")), F.lit("unknown"))
    impls = F.collect_list(F.when(F.col("impl"), F.struct("line", "last", "impl_name"))).over(Window.partitionBy(*file))
    own = F.array_min(F.filter(impls, lambda x: (x["line"] < F.col("line")) & (F.col("line") <= x["last"])))["impl_name"]
    tail = lambda s: F.coalesce(F.concat(F.lit(s), "owner"), F.lit(""))
    block = lambda kind, name, said: F.struct(F.lit(kind).alias("kind"), name.alias("name"), F.col("top").alias("first"), F.col("last").alias("last"), said.alias("signature"))
    fn = block("function", F.concat("name", tail("@impl ")), F.concat(F.trim("body"), tail("  // in impl ")))
    name, said = F.when(F.col("typed"), F.col("type_name")).otherwise(F.col("impl_name")), F.when(F.col("typed"), F.concat_ws(" ", "type_kind", "type_name")).otherwise(F.concat(F.lit("impl "), "impl_name"))
    both = F.array_compact(F.array(F.when(F.col("fn"), fn), F.when(F.col("typed") | (F.col("impl") & (F.col("impl_name") != "")), block("container", name, said))))
    return starts.withColumns({"owner": own, "name": names}).select(*file, F.explode(both).alias("b")).select(*file, "b.*")


def diff_lines(diffs: DataFrame, keys: list[str], diff: str = "diff") -> DataFrame:
    """(keys, f, old_path, new_path, kind, binary, h, no, sign, text, old_no, new_no): the lines of a unified diff with their file,
    hunk and numbers; a file without hunks has one row of null h. kind is new, deleted or modified."""
    header, hunk = r"^diff --git a/(.*?) b/(.*)$", r"^@@ -(\d+)(?:,\d+)? \+(\d+)(?:,\d+)? @@"
    rows = diffs.select(*keys, F.posexplode(F.split(diff, "\n", -1)).alias("no", "text"))
    got = lambda p, i: F.nullif(F.regexp_extract("text", p, i), F.lit(""))
    order = Window.partitionBy(*keys).orderBy("no")
    rows = rows.withColumns({"is_file": F.rlike("text", F.lit(header)), "is_hunk": F.rlike("text", F.lit(hunk))})
    rows = rows.withColumn("f", F.sum(F.col("is_file").cast("int")).over(order)).where("f > 0")
    rows = rows.withColumn("h", F.sum(F.col("is_hunk").cast("int")).over(Window.partitionBy(*keys, "f").orderBy("no")))
    rows = rows.withColumn("sign", F.when(~F.col("is_hunk") & (F.col("h") > 0) & F.substring("text", 1, 1).isin("+", "-", " "), F.substring("text", 1, 1)))
    file = Window.partitionBy(*keys, "f")
    meta = F.col("sign").isNull() & ~F.col("is_hunk")
    path = lambda i: F.max(F.when(F.col("is_file"), got(header, i))).over(file)
    heads = {
        "old_path": path(1), "new_path": path(2), "kind": F.coalesce(F.max(F.when(meta, got("^(new|deleted) file mode", 1))).over(file), F.lit("modified")),
        "binary": F.max(F.when(meta, F.rlike("text", F.lit("^Binary files")))).over(file), "signs": F.count("sign").over(file),
    }
    at = Window.partitionBy(*keys, "f", "h").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    begun = Window.partitionBy(*keys, "f", "h").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    number = lambda i, signs: F.max(F.when(F.col("is_hunk"), got(hunk, i).cast("int"))).over(begun) + F.coalesce(F.sum(F.col("sign").isin(*signs).cast("int")).over(at), F.lit(0))
    # A file without such lines is known by its header's line.
    body = rows.withColumns(heads).withColumns({"old_no": number(1, ("-", " ")), "new_no": number(2, ("+", " "))}).where("sign is not null or (signs = 0 and is_file)")
    held = lambda c: F.when(F.col("sign").isNotNull(), F.col(c)).alias(c)
    return body.select(*keys, "f", "old_path", "new_path", "kind", "binary", *map(held, ("h", "no", "sign", "text", "old_no", "new_no")))


def _files(diffs: DataFrame, keys: list[str], diff: str, old: str, new: str) -> DataFrame:
    """(keys, f, old_path, new_path, kind, binary, marks, old_text, new_text, blocks): each file of a diff in one row, with the lines
    of its hunks as `marks` (no, h, sign, text, line: the number on the side that has it), its sides before and after, and the
    blocks of both (side, kind, name, first, last). A side that a file doesn't have is empty, those of a binary file are null;
    a line feed at the end ends the last line and begins none.

    Diffs are dealt once by their keys and files once by theirs: groups, windows and joins are by these and shuffle nothing.
    """
    by = [*keys, "f"]
    given = diffs.select(*keys, F.col(diff).alias("diff"), F.col(old).alias("old"), F.col(new).alias("new"))
    given = given.repartition(parts(given, F.col("diff"), *[F.array_join(F.map_values(c), "") for c in ("old", "new")]), *keys)
    line = F.when(F.col("sign") == "-", F.col("old_no")).otherwise(F.col("new_no"))
    marks = F.array_sort(F.collect_list(F.when(F.col("sign").isNotNull(), F.struct("no", "h", "sign", "text", line.alias("line")))))
    files = diff_lines(given, keys, "diff").groupBy(*by, "old_path", "new_path", "kind", "binary").agg(marks.alias("marks")).join(given.drop("diff"), keys)
    side = lambda path, held, gone: F.when(F.col("binary"), None).when(F.col("kind") == gone, "").otherwise(F.regexp_replace(F.coalesce(F.element_at(held, F.col(path)), F.lit("")), "\\n\\z", ""))
    files = written(files.withColumns({"old_text": side("old_path", "old", "new"), "new_text": side("new_path", "new", "deleted")}).drop("old", "new"), "files")
    files = files.repartition(parts(files, F.col("old_text"), F.col("new_text")), *by)
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{x}_path").alias("path"), F.col(f"{x}_text").alias("text")) for s, x in (("-", "old"), ("+", "new"))])
    named = [*by, "side"]
    found = _blocks(source_lines(files.select(*by, F.explode(sides).alias("s")).select(*by, "s.*"), named), named)
    found = found.groupBy(*by).agg(F.collect_list(F.struct("side", "kind", "name", "first", "last")).alias("blocks"))
    return files.join(found, by, "left").withColumn("blocks", F.coalesce("blocks", F.array().cast(found.schema["blocks"].dataType)))


def _signed(marks: str, sign: str) -> Column:
    return F.filter(marks, lambda m: m["sign"] == sign)


def _blocks_of(sign: str, kind: str) -> Column:
    return F.filter("blocks", lambda b: (b["side"] == sign) & (b["kind"] == kind))


def _within(line: Column, block: Column) -> Column:
    return (line >= block["first"]) & (line <= block["last"])


def readable_diff(diffs: DataFrame, keys: list[str], diff: str = "diff", old: str = "old", new: str = "new") -> DataFrame:
    """(keys, path, kind, name, status, old_text, new_text): the functions that a diff changes, before and after. status is
    modified, new or deleted; kind function, container, for Rust's lines outside of functions, or `outside` for other lines.

    `old` and `new` are maps of path to text. The versions of a name meet in the row of their file; of several blocks of one
    name in a file the first one counts. Blank lines outside of functions are left out. A file that is missing counts as
    empty; binary files and null diffs have no rows.
    """
    files = _files(diffs, keys, diff, old, new)
    for sign, x in (("-", "old"), ("+", "new")):
        changed = F.transform(_signed("marks", sign), lambda m: m["line"])
        files = files.withColumns({f"{x}_lines": F.split(f"{x}_text", "\n", -1), "changed": changed, "fns": _blocks_of(sign, "function"), "holds": _blocks_of(sign, "container")})
        at = lambda m, lines=F.col(f"{x}_lines"): F.get(lines, m - 1)
        files = files.withColumn("loose", F.filter("changed", lambda m: (m >= 1) & ~F.exists("fns", lambda b: _within(m, b)) & (F.trim(at(m)) != "")))
        hit = lambda blocks, lines: F.transform(F.filter(blocks, lambda b: F.exists(lines, lambda m: _within(m, b))), lambda b: F.struct(b["kind"].alias("kind"), b["name"].alias("name")))
        rest = F.array_sort(F.filter("loose", lambda m: ~F.exists("holds", lambda b: _within(m, b))))
        outside = F.when(F.size(rest) > 0, F.array_join(F.transform(rest, lambda m: at(m)), "\n"))
        files = files.withColumns({f"{x}_hit": F.concat(hit("fns", "changed"), hit("holds", "loose")), f"{x}_outside": outside})

    def version(x: str, sign: str, one: Column) -> Column:
        same = F.filter("blocks", lambda b: (b["side"] == sign) & (b["kind"] == one["kind"]) & (b["name"] == one["name"]))
        s = F.array_min(F.transform(same, lambda b: F.struct(b["first"].alias("first"), b["last"].alias("last"))))
        return F.array_join(F.slice(F.col(f"{x}_lines"), s["first"], s["last"] - s["first"] + 1), "\n").alias(f"{x}_text")

    sides = (("old", "-"), ("new", "+"))
    each = F.transform(F.array_distinct(F.concat("old_hit", "new_hit")), lambda h: F.struct(h["kind"].alias("kind"), h["name"].alias("name"), *[version(x, s, h) for x, s in sides]))
    other = F.struct(F.lit("outside").alias("kind"), F.lit(None).cast("string").alias("name"), *[F.col(f"{x}_outside").alias(f"{x}_text") for x, _ in sides])
    every = F.concat(each, F.array_compact(F.array(F.when(F.coalesce("old_outside", "new_outside").isNotNull(), other))))
    both = files.select(*keys, "old_path", "new_path", F.explode(every).alias("v")).select(*keys, "old_path", "new_path", "v.*")
    status = F.when(F.col("old_text").isNull(), "new").when(F.col("new_text").isNull(), "deleted").otherwise("modified")
    path = F.when(F.col("new_text").isNotNull(), F.col("new_path")).otherwise(F.col("old_path"))
    return both.select(*keys, path.alias("path"), "kind", F.nullif("name", F.lit("")).alias("name"), status.alias("status"), "old_text", "new_text")


def context_diff(diffs: DataFrame, keys: list[str], diff: str = "diff", old: str = "old", new: str = "new") -> DataFrame:
    """(keys, text): each diff with its hunks under the names of the functions that they touch, and with the lines around the
    whole of these. A text without a diff in it stays as it is; null stays null.

    Regions are the functions that a hunk changes, or NEAR lines around it outside of any; those that meet within NEAR lines
    are one. `old` and `new` are maps of path to text; a missing file counts as empty.
    """
    files = _files(diffs, keys, diff, old, new)
    files = files.withColumns({"changed": F.filter("marks", lambda m: m["sign"] != " "), "fns": _blocks_of("+", "function"), "after": F.split("new_text", "\n", -1)})
    span = lambda a, b: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))
    meets = lambda lines, b: F.exists(lines, lambda m: _within(m["line"], b))
    for sign, x in (("-", "old"), ("+", "new")):
        files = files.withColumns({"mine": _signed("changed", sign), "own": _blocks_of(sign, "function"), "n": F.size(F.split(f"{x}_text", "\n", -1))})

        def of_hunk(h: Column) -> Column:
            lines = F.filter("mine", lambda m: m["h"] == h)
            hit = F.transform(F.filter("own", lambda b: meets(lines, b)), lambda b: span(b["first"], b["last"]))
            at = F.transform(lines, lambda m: m["line"])
            return F.when(F.size(hit) > 0, hit).otherwise(F.array(span(F.greatest(F.lit(1), F.array_min(at) - NEAR), F.least(F.col("n"), F.array_max(at) + NEAR))))

        regions = F.array_sort(F.array_distinct(F.flatten(F.transform(F.array_distinct(F.transform("mine", lambda m: m["h"])), of_hunk))))

        def joined(acc: Column, r: Column) -> Column:
            last = F.element_at(acc, -1)
            grown = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(span(last["a"], F.greatest(last["b"], r["b"]))))
            return F.when(F.size(acc) == 0, F.array(r)).when(r["a"] <= last["b"] + NEAR, grown).otherwise(F.concat(acc, F.array(r)))

        files = files.withColumn(f"{x}_regions", F.when(F.col("n") > 0, F.aggregate(regions, F.array().cast("array<struct<a:int,b:int>>"), joined)))

    # Added lines say where a hunk is shown; one that only removes is shown by the old file's lines.
    def place(h: Column) -> Column:
        of = lambda x, sign: F.array_min(F.filter(f"{x}_regions", lambda r: F.exists("changed", lambda m: (m["h"] == h) & (m["sign"] == sign) & (m["line"] >= r["a"]) & (m["line"] <= r["b"]))))
        return F.coalesce(of("new", "+"), of("old", "-"))

    def names(h: Column) -> Column:
        lines = F.filter("changed", lambda m: (m["h"] == h) & (m["sign"] == "+"))
        hit = F.array_sort(F.array_distinct(F.transform(F.filter("fns", lambda b: meets(lines, b)), lambda b: F.struct(b["first"].alias("first"), b["name"].alias("name")))))
        return F.array_join(F.transform(hit, lambda x: x["name"]), ", ")

    hunk = lambda h: F.struct(h.alias("h"), place(h).alias("p"), names(h).alias("names"))
    files = files.withColumn("shown", F.filter(F.transform(F.array_sort(F.array_distinct(F.transform("changed", lambda m: m["h"]))), hunk), lambda s: s["p"].isNotNull()))

    def told(s: Column) -> Column:
        a, b = s["p"]["a"], s["p"]["b"]
        size, top = b - a + 1, F.greatest(F.lit(1), a - AROUND)
        title = F.concat(F.when(s["names"] != "", F.concat(F.lit("@@ Function context: "), s["names"], F.lit(" @@\n"))).otherwise(""), F.lit("@@ -"), a, F.lit(","), size, F.lit(" +"), a, F.lit(","), size, F.lit(" @@"))
        blank = lambda start, n: F.transform(F.slice("after", start, n), lambda x: F.concat(F.lit(" "), x))
        return F.concat(F.array(title), blank(top, a - top), F.transform(F.filter("marks", lambda m: m["h"] == s["h"]), lambda m: m["text"]), blank(b + 1, F.lit(AROUND)))

    top = F.concat(F.lit("diff --git a/"), "old_path", F.lit(" b/"), "new_path", F.when(F.col("kind") != "modified", F.concat(F.lit("\n"), "kind", F.lit(" file mode 100644"))).otherwise(""))
    paths = F.when(F.col("binary"), F.concat(F.lit("\nBinary files a/"), "old_path", F.lit(" and b/"), "new_path", F.lit(" differ"))).otherwise(F.concat(F.lit("\n--- a/"), "old_path", F.lit("\n+++ b/"), "new_path"))
    rows = F.concat(F.array(F.concat(top, paths)), F.coalesce(F.flatten(F.transform("shown", told)), F.array().cast("array<string>")))
    texts = files.select(*keys, "f", F.concat(F.array_join(rows, "\n"), F.lit("\n")).alias("t"))
    given = diffs.select(*keys, diff)
    n = parts(given, F.col(diff))
    whole = texts.repartition(n, *keys).groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "t"))), lambda x: x["t"]), "\n").alias("made"))
    return given.repartition(n, *keys).join(whole, keys, "left").select(*keys, F.coalesce(F.concat(F.lit(HEADER + "\n"), "made"), F.col(diff)).alias("text"))
