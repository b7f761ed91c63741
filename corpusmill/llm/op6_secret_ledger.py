"""Secret scans over a ledger of blobs: DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.shared import stored
from corpusmill.sources.scratch import fresh


@dataclass(frozen=True)
class Rule:
    """A pattern, of which a match is a finding if its group `measured` (0: all of it) has `least` code points or more.
    A text is searched only if `hint` is found in it."""

    kind: str
    version: int
    pattern: str
    least: int
    measured: int = 0
    hint: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The rules, in the order in which findings at one place are listed; the first three are the base.
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = (
    Rule("assign", 1, _ASSIGN, 8, 2, r"(?i)password|passwd|secret|token|api_?key"),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16, 0, "AKIA"),
    # Runs that are too short are no findings, and none of them starts inside another run: so the bound is in the pattern.
    Rule("hex", 1, r"[0-9a-f]{32,}", 32, 0, None),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, "-----BEGIN"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, 0, "eyJ"),
)
_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"
#: Findings whose places are summed in one go. An array grows by copying, so that runs of these keep a text of many linear.
RUN = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """Findings of a rule: leftmost, non-overlapping, too short ones dropped. Pieces between matches and matches alternate,
    so the sums of their lengths are the places: first where each run of RUN matches begins, then within the runs."""
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    sizes = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(hits, F.length).alias("hit"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.measured)), F.length).alias("measured"),
    )
    empty = F.array().cast(_SPANS)

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["gap"]
        end = at + F.coalesce(x["hit"], F.lit(0))
        one = F.array(F.struct(at.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))).cast(_SPANS)
        return F.struct(end.alias("at"), F.when(x["measured"] >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def within(run: Column, start: Column) -> Column:
        return F.aggregate(run, F.struct(start.alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    def length(run: Column) -> Column:
        return F.aggregate(run, F.lit(0), lambda n, x: n + x["gap"] + F.coalesce(x["hit"], F.lit(0)))

    def starts(runs: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(runs, first, lambda acc, r: F.struct((acc["at"] + length(r)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def in_runs(all_sizes: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(all_sizes) - 1) / RUN).cast("int"))
        return F.transform(firsts, lambda i: F.slice(all_sizes, i * RUN + 1, RUN))

    def all_runs(runs: Column) -> Column:
        return _let(starts(runs), lambda at: F.flatten(F.transform(runs, lambda r, i: within(r, F.get(at, i)))))

    found = _let(sizes, lambda x: _let(in_runs(x), all_runs))
    if rule.hint is None:
        asked = F.regexp_like(text, pattern)
    elif rule.hint.isalpha() or rule.hint.startswith("-"):
        asked = F.contains(text, F.lit(rule.hint))
    else:
        asked = F.regexp_like(text, F.lit(rule.hint))
    return F.when(asked, found).otherwise(F.array().cast(_SPANS))


def unseen_scans(versions: DataFrame, ledger: DataFrame | None = None, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, seen, spans) of the blobs of `versions` that some rule version has not read yet, after it has: a new row, or one
    that takes the place of the ledger's.

    A blob's name is the SHA-256 of its UTF-8 bytes; null text counts as empty. `seen` names the rule versions that have
    read it. Each distinct blob is read once, and only by rule versions that its ledger row doesn't name; findings of a
    rule's older versions give way to those of its new one, and of a rule no longer given they stay. `versions` holds one
    row for each historical version of each path, in any number of copies. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = versions.select(F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("text"))
    names = F.array(*[F.lit(r.name) for r in rules])
    if ledger is None:
        asked = named.groupBy("blob").agg(F.first("text").alias("text")).withColumns({"had": F.array().cast("array<string>"), "old": F.array().cast(_SPANS)})
    else:
        # Names alone tell what is left to read; texts that have been read go no further.
        known = ledger.select("blob", F.col("seen").alias("had"), F.col("spans").alias("old"))
        left = named.select("blob").distinct().join(known, "blob", "left").withColumns({"had": F.coalesce("had", F.array().cast("array<string>")), "old": F.coalesce("old", F.array().cast(_SPANS))})
        left = stored(left.where(F.size(F.array_except(names, "had")) > 0), "unseen")
        asked = named.join(left.select("blob"), "blob", "left_semi").groupBy("blob").agg(F.first("text").alias("text")).join(left, "blob")
    # Not called seen and spans: inside a lambda these names would mean the columns that are made here.
    asked = asked.where(F.size(F.array_except(names, "had")) > 0)
    todo = {r: ~F.array_contains("had", r.name) for r in rules}

    def replaced(span: Column) -> Column:
        out = F.lit(False)
        for r in rules:
            out = out | (todo[r] & (span["kind"] == r.kind))
        return out

    stays = F.filter("old", lambda span: ~replaced(span))
    new = F.concat(stays, *[F.when(todo[r], matches(F.col("text"), r, i)).otherwise(F.array().cast(_SPANS)) for i, r in enumerate(rules)])
    return asked.select("blob", F.array_sort(F.array_union("had", names)).alias("seen"), F.array_sort(new).alias("spans"))


def scan_blobs(versions: DataFrame, ledger: DataFrame | None = None, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger after a scan of `versions`: a row for each content ever seen. Blobs of the ledger that `versions` lacks, or that
    all rule versions have read, stay as they are."""
    scanned = unseen_scans(versions, ledger, text_col, rules)
    if ledger is None:
        return scanned
    return scanned.unionByName(ledger.select("blob", "seen", "spans").join(scanned.select("blob"), "blob", "left_anti"))


def read_ledger(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The ledger in a folder: of each blob the row of the newest run, or of the newest before a number. Null where no such run
    has ended yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    runs = [x.getPath() for x in files.listStatus(folder)] if files.exists(folder) else []
    # A run that did not end has no mark of success; its rows don't count.
    done = [r.toString() for r in runs if files.exists(spark._jvm.org.apache.hadoop.fs.Path(r, "_SUCCESS")) and (before is None or int(r.getName().split("=")[1]) < before)]
    if not done:
        return None
    rows = spark.read.option("basePath", path).parquet(*done)
    return rows.groupBy("blob").agg(F.max_by(F.struct("seen", "spans"), "run").alias("r")).select("blob", "r.seen", "r.spans")


def update_ledger(versions: DataFrame, path: str, run: int, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger in the folder `path` has not seen, write it there as the rows of `run`, a number above those of
    earlier runs, and return the ledger. A run writes only blobs that it has read; one that is made again puts its own
    rows in place."""
    spark = versions.sparkSession
    scanned = unseen_scans(versions, read_ledger(spark, path, before=run), text_col, rules)
    scanned.write.mode("overwrite").parquet(f"{path}/run={run}")
    return read_ledger(spark, path)


def next_run(spark: SparkSession, path: str) -> int:
    """A number above those of all runs in the folder, ended or not."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []
    return 1 + max((int(n.split("=")[1]) for n in names if n.startswith("run=")), default=0)


def findings_by_path(versions: DataFrame, ledger: DataFrame, path_col: str, text_col: str = "text") -> DataFrame:
    """(path, blob, spans) of each version's row: the findings of its blob, joined back to all paths that hold it."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    paths = versions.select(F.col(path_col), F.sha2(text.cast("binary"), 256).alias("blob"))
    return paths.join(ledger.select("blob", "spans"), "blob").select(path_col, "blob", "spans")


def secret_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans of each document, by way of the ledger in the folder `path`, or one of its own. A second run over the same
    rows then has nothing to read: it is made, so that what the findings come from is a ledger that says so. A null id is a
    path like any other; repeated rows one each."""
    spark = docs.sparkSession
    path = path or fresh(spark, "ledger")
    first = next_run(spark, path)
    for run in (first, first + 1):
        known = update_ledger(docs, path, run, text_col)
    found = findings_by_path(docs, known, id_col, text_col)

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["rank"] < 3)

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of(k) for k in ("assign", "access", "hex")]
    return found.select(id_col, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
