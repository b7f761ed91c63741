"""Checks of Rust answers and compiler messages, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import strip

# Phrases and codes by which compiler messages about borrowing, moves and lifetimes are known.
BORROW_PHRASES = (
    "cannot borrow", "borrowed value", "borrow later used here", "does not live long enough", "doesn't live long enough", "lifetime may not live long enough", "borrow checker", "temporary value dropped while borrowed",
    "cannot return reference", "returns a value referencing data owned by the current function", "cannot return value referencing", "cannot move out", "use of moved value", "value used here after move", "cannot assign to",
    "cannot borrow as mutable", "cannot borrow as immutable", "cannot mutably borrow", "cannot immutably borrow",
    "e0382", "e0387", "e0495", "e0499", "e0500", "e0501", "e0502", "e0503", "e0504", "e0505", "e0506", "e0507", "e0508", "e0509", "e0515", "e0594", "e0596", "e0597", "e0716",
)


def is_borrow_error(message: Column) -> Column:
    """A known phrase or code, or any bracketed code that starts with 0."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return F.exists(F.array(*[F.lit(p) for p in BORROW_PHRASES]), lambda p: F.contains(low, p)) | F.regexp_like(low, F.lit("error\\s*\\[e0\\d{3}\\]"))


def function_name(signature: Column) -> Column:
    """The name after `fn`, attributes and line comments taken out; null without one."""
    bare = F.regexp_replace(F.regexp_replace(signature, "#\\[.*?\\]", ""), "//.*?\n", "")
    return F.nullif(F.regexp_extract(bare, "(?U)fn\\s+(\\w+)", 1), F.lit(""))


def has_signature(code: Column, signature: Column) -> Column:
    """Whether the code declares a function of the signature's name. Empty code or signature: no."""
    return F.coalesce(F.regexp_like(code, F.concat(F.lit("(?U)fn\\s+\\Q"), function_name(signature), F.lit("\\E\\s*[(<]"))), F.lit(False))


def enforced_signature(code: Column, signature: Column) -> Column:
    """Code without the signature's function, rebuilt: its imports, the signature, and as body what stands between its first
    opening and its last closing brace. Left as it is if it has the function, or if the signature names none."""
    lines = F.filter(F.split(code, "\\r?\n", -1), lambda x: strip(x) != "")
    imports = F.filter(F.transform(lines, strip), lambda x: F.startswith(x, F.lit("use ")))
    others = F.filter(lines, lambda x: ~F.startswith(strip(x), F.lit("use ")) & ~F.startswith(strip(x), F.lit("```")))
    body = strip(F.array_join(others, "\n"))
    body = F.when(F.contains(body, F.lit("{")), F.substring(body, F.instr(body, "{") + 1, F.length(body))).otherwise(body)
    body = strip(F.when(F.contains(body, F.lit("}")), F.regexp_extract(body, "(?s)^(.*)\\}", 1)).otherwise(body))
    head = F.filter(F.transform(F.split(F.regexp_replace(strip(signature), ";+$", ""), "\\r?\n", -1), lambda x: F.rtrim(x)), lambda x: strip(x) != "")
    none = F.array().cast("array<string>")
    parts = F.concat(F.when(F.size(imports) > 0, F.concat(imports, F.array(F.lit("")))).otherwise(none), head, F.array(F.lit("{")), F.when(body != "", F.array(body)).otherwise(none), F.array(F.lit("}")))
    rebuilt = F.array_join(parts, "\n")
    return F.when((code == "") | has_signature(code, signature) | ~has_signature(rebuilt, signature), code).otherwise(rebuilt)


def uses_api(code: Column, api: Column) -> Column:
    """The name or its last part as a whole word, a method or path call of that part, or a use line with it in any case."""
    base = F.element_at(F.split(api, "::", -1), -1)
    quoted = lambda c: F.concat(F.lit("\\Q"), c, F.lit("\\E"))
    word = lambda c: F.regexp_like(code, F.concat(F.lit("(?U)\\b"), quoted(c), F.lit("\\b")))
    called = F.regexp_like(code, F.concat(F.lit("(\\.|::)"), quoted(base), F.lit("\\s*\\(")))
    used = F.regexp_like(code, F.concat(F.lit("(?i)use\\s+.*"), quoted(base)))
    return F.coalesce((api != "") & (code != "") & (word(api) | word(base) | called | used), F.lit(False))


def wrap_tests(test: Column) -> Column:
    """The test inside a test module, unless it is one already."""
    return F.when(F.contains(test, F.lit("#[cfg(test)]")), test).otherwise(F.concat(F.lit("#[cfg(test)]\nmod tests {\n    use super::*;\n\n"), test, F.lit("\n}")))


def failure_kind(passed: Column, message: Column) -> Column:
    return F.when(passed, None).when(is_borrow_error(message), "borrow").when(F.startswith(message, F.lit("Compilation error")), "compile").when(F.startswith(message, F.lit("Timeout")), "timeout").otherwise("test")
