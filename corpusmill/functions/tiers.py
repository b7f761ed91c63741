"""Verdicts on a model's patch against a human one, by tier, as Column expressions over diffs and over replies that are given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let
from corpusmill.functions.diff import changed_files, changed_lines, file_blocks, op_type, tier
from corpusmill.functions.jsonish import strict_json, verdict
from corpusmill.functions.text import fold_behavior, strip

# Limits in characters, the headings of a summary, what counts as mentioning each of four things, and words
# that name nothing.
MOST_DIFF, MOST_PROMPT, LEAST_REPLY = 35_000, 120_000, 20
HEADINGS = {"primary": "Primary behavior change", "secondary": "Secondary effects", "error_handling": "Error handling changes", "edge_cases": "Edge cases affected"}
SUMMARY_HEAD, UNKNOWN = "BEHAVIORAL SUMMARY:", "BEHAVIOR: UNKNOWN"
MENTIONS = {
    "Files Mentioned": ("files changed", "modified files", "changed files", "a/core", "b/utils", "/core.py", "/utils.py", "in core", "in utils", "in the file", "the file"),
    "Logic Changes": ("add", "remove", "modify", "modifies", "change", "update", "insert", "delete"),
    "Control Flow": ("if", "else", "condition", "try", "catch", "except", "finally", "loop", "iterate", "return", "throw", "raise", "error handling", "switch", "match", "case"),
    "Behavioral Impact": ("behavior", "impact", "effect", "result", "outcome", "prevents", "avoids", "fixes", "resolves", "handles", "ensures", "guarantees"),
}
EMPTY_WORDS = ("the", "a", "an", "to", "for", "in", "of", "and", "or", "is", "if", "with", "on", "be", "not", "null", "none")


def behaviors(summary: Column, category: str) -> Column:
    """What a summary's bullets of a category say, folded, each bullet a whole; those of five characters or fewer say nothing."""
    said = F.regexp_extract_all(summary, F.lit(f"(?m)^\\s*- {HEADINGS[category]}:(.*)$"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(said, fold_behavior), lambda x: F.length(x) > 5))


def says_unknown(summary: Column) -> Column:
    """Whether any line of a summary is or ends in UNKNOWN."""
    return F.regexp_like(summary, F.lit("(?m)BEHAVIOR: UNKNOWN|: UNKNOWN|^\\s*- UNKNOWN\\s*$"))


def touched_functions(diff: Column) -> Column:
    """Added and removed lines that hold a bracket, comments and attributes aside, folded."""
    lines = F.filter(F.split(diff, "\n", -1), lambda x: F.regexp_like(x, F.lit("^[+-](?!\\+\\+|--)")) & F.contains(x, F.lit("(")))
    bodies = F.transform(lines, lambda x: strip(F.substring(x, F.lit(2), F.length(x))))
    return F.array_distinct(F.transform(F.filter(bodies, lambda x: (x != "") & ~F.startswith(x, F.lit("#")) & ~F.startswith(x, F.lit("//"))), fold_behavior))


def _same(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def _folded(diff: Column, sign: str) -> Column:
    return F.array_distinct(F.transform(changed_lines(diff, sign), fold_behavior))


def raw_mismatch(human: Column, model: Column) -> Column:
    """The first thing in which two diffs differ: files, kinds of change by file, added lines, removed lines; null if none. A
    diff that names files but has none that can be read is no match."""
    kinds = lambda d: F.transform(file_blocks(d), lambda b: F.concat(F.regexp_extract(b, "^diff --git a/\\S+ b/(\\S+)", 1), F.lit("\t"), op_type(b)))

    def parts(d: Column) -> Column:
        named = {"blank": strip(d) == "", "git": F.contains(d, F.lit("diff --git")), "files": changed_files(d), "kinds": kinds(d), "added": _folded(d, "+"), "removed": _folded(d, "-")}
        return F.struct(*[c.alias(n) for n, c in named.items()])

    def first_gap(x: Column) -> Column:
        a, b = x["human"], x["model"]
        unread = lambda p: p["git"] & (F.size(p["files"]) == 0)
        gap = F.when(a["blank"] | b["blank"], "empty").when(unread(a) | unread(b), "unreadable")
        for name, word in (("files", "files"), ("kinds", "types"), ("added", "added"), ("removed", "removed")):
            gap = gap.when(~_same(a[name], b[name]), word)
        return gap

    return let(F.struct(parts(human).alias("human"), parts(model).alias("model")), first_gap)


def summary_kept(reply: Column) -> Column:
    """A summary that can be used: neither unknown nor short, with its heading; else null."""
    text = strip(reply)
    return F.when(~F.contains(text, F.lit(UNKNOWN)) & (F.length(text) >= LEAST_REPLY) & F.contains(text, F.lit(SUMMARY_HEAD)), text)


def claims_backed(summary: Column, diff: Column) -> Column:
    """Whether every primary behaviour of ten characters or more, of which more than two words name something, has one of these
    words in the diff."""
    low = F.lower(diff)
    words = lambda b: F.array_except(F.split(b, " ", -1), F.array(*[F.lit(w) for w in EMPTY_WORDS]))
    named = lambda text, said: F.forall(said, lambda b: (F.length(b) < 10) | let(words(b), lambda ws: (F.size(ws) <= 2) | F.exists(ws, lambda w: F.contains(text, w))))
    return let(F.struct(low.alias("low"), behaviors(summary, "primary").alias("said")), lambda x: named(x["low"], x["said"]))


def missing_mentions(summary: Column) -> Column:
    """Which of four things a summary does not mention, in order."""
    low = F.lower(summary)
    found = [F.when(~F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w)), F.lit(name)) for name, words in MENTIONS.items()]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def summary_complete(summary: Column, diff: Column) -> Column:
    """Whether a summary mentions all four and isn't of fewer than five words for a diff of more than ten lines."""
    brief = (F.size(F.regexp_extract_all(summary, F.lit("\\S+"), F.lit(0))) < 5) & (F.size(F.split(F.rtrim(diff), "\n", -1)) > 10)
    return (strip(F.coalesce(summary, F.lit(""))) != "") & (F.size(missing_mentions(summary)) == 0) & ~brief


def summary_verdict(human: Column, model: Column) -> Column:
    """PASS if primary behaviours are the same and no error handling or edge case is lost; FAIL else; FAIL_INFRA where a summary
    is missing or unknown."""
    lost = lambda c: F.size(F.array_except(behaviors(human, c), behaviors(model, c))) > 0
    primary = let(F.struct(behaviors(human, "primary").alias("a"), behaviors(model, "primary").alias("b")), lambda x: _same(x["a"], x["b"]))
    none = lambda s: F.coalesce(s, F.lit("")) == ""
    return F.when(none(human) | none(model) | says_unknown(human) | says_unknown(model), "FAIL_INFRA").when(~primary | lost("error_handling") | lost("edge_cases"), "FAIL").otherwise("PASS")


def too_long_line(diff: Column) -> Column:
    return F.exists(F.split(diff, "\n", -1), lambda x: F.length(x) > MOST_DIFF)


def third_tier(human: Column, model: Column, human_reply: Column, model_reply: Column) -> Column:
    """(verdict, reason, confidence) of the third tier for diffs that can be summarised whole: the raw diffs decide first, then
    the summaries that were given."""
    known = F.struct(
        summary_kept(human_reply).alias("a"), summary_kept(model_reply).alias("b"), raw_mismatch(human, model).alias("gap"), (strip(F.coalesce(human, F.lit(""))) == "").alias("no_human"),
        (strip(F.coalesce(model, F.lit(""))) == "").alias("no_model"), (too_long_line(human) | too_long_line(model)).alias("long"),
    )
    return let(known, lambda x: _decided(x, human, model))


def _decided(x: Column, human: Column, model: Column) -> Column:
    a, b, gap = x["a"], x["b"], x["gap"]
    out = lambda v, r, c: F.struct(F.lit(v).alias("verdict") if isinstance(v, str) else v.alias("verdict"), F.lit(r).alias("reason") if isinstance(r, str) else r.alias("reason"), F.lit(float(c)).alias("confidence"))
    return (
        F.when(x["no_human"], out("FAIL_INFRA", "no human diff", 0))
        .when(x["no_model"], out("FAIL", "no changes made", 1))
        .when(x["long"], out("FAIL_INFRA", "line too long", 0))
        .when(gap.isNotNull(), out("FAIL", F.concat(F.lit("raw: "), gap), 0))
        .when(a.isNull(), out("FAIL_INFRA", "no human summary", 0))
        .when(b.isNull(), out("FAIL_INFRA", "no model summary", 0))
        .when(~claims_backed(a, human), out("FAIL", "human summary not backed", 0))
        .when(~claims_backed(b, model), out("FAIL", "model summary not backed", 0))
        .otherwise(
            let(
                summary_verdict(a, b),
                lambda told: F.when(told == "PASS", out("PASS", "raw parity and behaviours match", 0.95)).when(told == "FAIL_INFRA", out("FAIL_INFRA", "unknown behaviour", 1)).otherwise(out("FAIL", "behaviours differ", 0.8)),
            )
        )
    )


def summary_guard(n_files: Column, reply: Column) -> Column:
    """Why a structured summary can't be trusted: several files changed, or the reply is no JSON; null if it can."""
    return F.when(n_files > 1, "RISK_AWARE_REJECTION").when(strict_json(reply).isNull(), "JSON_PARSE_FAILURE")


def chunk_attempts(replies: Column) -> Column:
    """(status, retries) of a chunk that was asked for up to as many times as there are replies: SUCCESS at the first that has
    the heading and 20 characters, UNKNOWN at once at one that says so, else ERROR after the last."""
    usable = F.transform(replies, lambda r: F.when(F.contains(strip(r), F.lit(UNKNOWN)), F.lit("UNKNOWN")).when((F.length(strip(r)) >= LEAST_REPLY) & F.contains(r, F.lit(SUMMARY_HEAD)), F.lit("SUCCESS")))
    first = F.try_element_at(F.filter(F.transform(usable, lambda s, i: F.struct(i.alias("retries"), s.alias("status"))), lambda x: x["status"].isNotNull()), F.lit(1))
    return F.struct(F.coalesce(first["status"], F.lit("ERROR")).alias("status"), F.coalesce(first["retries"], F.size(replies) - 1).alias("retries"))


def routed(human: Column, model: Column, context: Column, prompt: Column, reply: Column, error: Column) -> Column:
    """(tier, verdict) of an evaluation: an empty patch fails without a tier; in tiers 1 and 2 a prompt beyond the limit is skipped
    and never asked, a time-out fails, and else the reply decides. Tier 3 has its own engine: null."""
    t = tier(human, context)
    late = F.regexp_like(F.lower(F.coalesce(error, F.lit(""))), F.lit("timeout|timed out"))
    told = F.when(t == 3, None).when(F.length(prompt) > MOST_PROMPT, "SKIPPED_CONTEXT_OVERFLOW").when(late, "FAIL").otherwise(verdict(reply, t))
    blank = strip(F.coalesce(model, F.lit(""))) == ""
    return F.struct(F.when(blank, 0).otherwise(t).alias("tier"), F.when(blank, "FAIL").otherwise(told).alias("verdict"))


def tier_prompt(t: Column, title: Column, raw: tuple[Column, Column], context: tuple[Column, Column], summary: Column) -> Column:
    """What the judge of a tier sees: its own inputs alone, under the tier's name."""
    block = lambda name, c: F.concat(F.lit(f"## {name}\n"), F.coalesce(c, F.lit("")))
    seen = F.when(t == 1, F.concat_ws("\n\n", block("Human diff", raw[0]), block("Model diff", raw[1]))).when(t == 2, F.concat_ws("\n\n", block("Human context", context[0]), block("Model context", context[1]))).otherwise(block("Summary", summary))
    name = F.when(t == 1, "Tier-1 (Raw Diff)").when(t == 2, "Tier-2 (Context Diff)").otherwise("Tier-3 (Structured Summary)")
    return F.concat(F.lit("EVALUATION TIER: "), name, F.lit("\n\n# "), title, F.lit("\n\n"), seen)
