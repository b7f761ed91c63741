"""JSON inside model replies, as Column expressions. A VARIANT tells absent from null."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let, once
from corpusmill.functions.text import strip


def brace_slice(c: Column) -> Column:
    """From the first { to the last }; null without them."""
    return F.nullif(F.regexp_extract(c, "(?s)\\{.*\\}", 0), F.lit(""))


def fenced_json(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "(?s)```(?:json)?\\s*(.*?)```", 1), F.lit(""))


def is_json(c: Column) -> Column:
    """Whether the whole text is one JSON value. Spark's parsers stop behind the first value and do not mind what follows: so
    the text must be one value inside a list and inside an object, which nothing that has more can be."""
    listed = F.json_array_length(F.concat(F.lit("["), c, F.lit("]")))
    named = F.json_object_keys(F.concat(F.lit('{"v":'), c, F.lit("}")))
    return F.coalesce((listed == 1) & named.isNotNull(), F.lit(False))


def strict_json(c: Column) -> Column:
    """JSON as VARIANT; null for what is no JSON as a whole."""
    return F.when(is_json(c), F.try_parse_json(c))


def parsed(c: Column) -> Column:
    """JSON as VARIANT; null for what is no JSON, and for JSON null."""
    return F.try_parse_json(json_text(c))


def json_text(c: Column) -> Column:
    """The text if it is JSON other than null."""
    return F.when(is_json(c) & (strip(c) != "null"), c)


def first_parsed(*candidates: Column) -> Column:
    """The first candidate that is JSON, as VARIANT: later ones are not looked at, and one is parsed."""
    return F.try_parse_json(F.coalesce(*[json_text(c) for c in candidates]))


def after(c: Column, mark: str) -> Column:
    """What follows the first `mark`; null without one."""
    at = F.instr(c, mark)
    return F.when(at > 0, F.substring(c, at + len(mark), F.length(c)))


#: What a judge may put before its object.
JUDGE_MARKS = ("```json", "```", "JSON:", "json:", "{", "Response:")


def judge_json(c: Column) -> Column:
    """Four strategies: the whole reply; its brace slice; the object right behind the first of each mark, up to the last
    brace; the first parsable of the objects that nest once at most."""
    behind = [F.when(F.startswith(strip(after(c, m)), F.lit("{")), brace_slice(strip(after(c, m)))) for m in JUDGE_MARKS]
    nested = F.regexp_extract_all(c, F.lit("(\\{[^{}]*(?:\\{[^{}]*\\}[^{}]*)*\\})"), F.lit(1))
    return first_parsed(strip(c), brace_slice(c), *behind, F.try_element_at(F.filter(nested, is_json), F.lit(1)))


def balanced_object(c: Column) -> Column:
    """From the first { to the } that balances it, braces in strings counted too; a text that starts with { is left as it is,
    as is one that has no balance. Pieces between closing braces are folded, not characters."""
    tail = F.substring(c, F.instr(c, "{"), F.length(c))
    pieces = F.split(tail, "\\}", -1)
    opened = F.transform(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: F.length(p) - F.length(F.replace(p, F.lit("{"), F.lit(""))))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("end"))

    def step(acc: Column, n: Column) -> Column:
        depth, seen = acc["depth"] + n - 1, acc["seen"] + 1
        return F.struct(depth.alias("depth"), seen.alias("seen"), F.when((acc["end"] == 0) & (depth == 0), seen).otherwise(acc["end"]).alias("end"))

    end = F.aggregate(opened, start, step, lambda a: a["end"])
    return F.when((F.instr(c, "{") > 1) & (end > 0), F.concat(F.array_join(F.slice(pieces, F.lit(1), end), "}"), F.lit("}"))).otherwise(c)


def markdown_json(c: Column) -> Column:
    """The first JSON value that is the whole text, its json fence, any fenced block, or a run of whole lines, as text; null
    without one. Only the last needs Python: a decoder starts at each line and must stop at the end of one."""

    @F.pandas_udf("string")
    def lines_json(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import json

        decoder = json.JSONDecoder()

        def find(text: str | None) -> str | None:
            at = 0
            while text is not None and at <= len(text):
                begin = at
                while begin < len(text) and text[begin] in " \t\r\n":
                    begin += 1
                try:
                    value, end = decoder.raw_decode(text, begin)
                    stop = text.find("\n", end)
                    if value is not None and not text[end : stop if stop >= 0 else len(text)].strip(" \t\r"):
                        return text[begin:end]
                except ValueError:
                    pass
                feed = text.find("\n", at)
                at = feed + 1 if feed >= 0 else len(text) + 1
            return None

        for batch in batches:
            yield batch.map(find)

    bare = strip(c)
    bare = F.when(F.startswith(bare, F.lit("```json")), strip(F.substring(bare, F.lit(8), F.length(bare)))).otherwise(bare)
    bare = F.when(F.endswith(bare, F.lit("```")), strip(F.substring(bare, F.lit(1), F.length(bare) - 3))).otherwise(bare)
    block = strip(F.nullif(F.regexp_extract(c, "(?s)```(?:\\w+\\n)?(.*?)```", 1), F.lit("")))
    # A text that is not opened like JSON is not parsed, and one that is the whole text is not tried as its fence again.
    opened = lambda x: F.when(F.regexp_like(x, F.lit(r"^\s*[\[{\"\-\dtfn]")), json_text(x))
    quick = let(F.struct(c.alias("c"), bare.alias("bare"), block.alias("block")), lambda x: F.coalesce(opened(x["c"]), F.when(x["bare"] != x["c"], opened(x["bare"])), opened(x["block"])))
    quick = once(quick)
    return F.coalesce(quick, lines_json(F.when(quick.isNull(), c)))


def canonical(c: Column) -> Column:
    """JSON text with sorted keys and no spaces; null for what is no JSON. Equal texts are deeply equal values."""
    return strict_json(c).cast("string")


def deep_equal(a: Column, b: Column) -> Column:
    """Whether two JSON texts hold equal values: keys in any order, lists in order. What is no JSON equals nothing."""
    return F.coalesce(canonical(a) == canonical(b), F.lit(False))


def field(v: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", kind)


def has_field(v: Column, name: str) -> Column:
    """True also where the field is JSON null."""
    return F.array_contains(F.json_object_keys(v.cast("string")), name)


def strict_confidence(c: Column) -> Column:
    """The field of the JSON reply, of a fenced block, a bare "confidence": n, else 0."""
    number = F.regexp_extract(c, '"confidence":\\s*([0-9]+\\.?[0-9]*)', 1)
    return F.coalesce(field(parsed(strip(c)), "confidence", "double"), field(parsed(fenced_json(c)), "confidence", "double"), F.nullif(number, F.lit("")).cast("double"), F.lit(0.0))


def generous_confidence(c: Column, model: Column) -> Column:
    """The reply's confidence; if it is 0 or missing on a real answer, one inferred from citations or length; for a reply that
    isn't JSON a number found in it, or 0.7 for a long one that doesn't decline."""
    v = strict_json(strip(c))
    gemma = F.contains(F.lower(model), F.lit("gemma"))
    answer = field(v, "answer", "string")
    given = F.coalesce(field(v, "confidence", "double"), F.lit(0.0))
    cited = F.coalesce(F.json_array_length(F.get_json_object(c, "$.citations")) > 0, F.lit(False))
    real = F.coalesce((answer != "") & (answer != "I don't know"), F.lit(False))
    inferred = F.when(cited, F.when(gemma, 0.7).otherwise(0.75)).when(F.length(answer) > 100, F.when(gemma, 0.68).otherwise(0.65)).otherwise(0.0)
    number = F.nullif(F.regexp_extract(c, '"confidence":\\s*([0-9.]+)', 1), F.lit(""))
    loose = F.when(number.isNotNull(), number.try_cast("double")).when((F.length(strip(c)) > 50) & ~F.contains(c, F.lit("I don't know")), 0.7).otherwise(0.0)
    return F.when(v.isNull(), loose).when((given == 0) & real, inferred).otherwise(given)


def verdict(c: Column, tier: Column | None = None) -> Column:
    """The verdict of the one line that gives one of four; without exactly one such line FAIL, and in tier 3 FAIL_INFRA. So
    for runaway replies, of more than 50,000 characters and more than 1000 lines."""
    lines = F.regexp_extract_all(c, F.lit("(?mi)^(?:FINAL_)?VERDICT:\\s*(PASS|FAIL|FAIL_INFRA|SKIPPED_CONTEXT_OVERFLOW)\\s*$"), F.lit(1))
    runaway = (F.length(strip(c)) > 50_000) & (F.size(F.split(strip(c), "\n", -1)) > 1000)
    lost = F.lit("FAIL") if tier is None else F.when(tier == 3, "FAIL_INFRA").otherwise("FAIL")
    return F.when(~runaway & (F.size(lines) == 1), F.upper(F.try_element_at(lines, F.lit(1)))).otherwise(lost)


def verdict_reason(c: Column) -> Column:
    """What follows the line start REASON:, else the whole reply."""
    found = F.regexp_extract(c, "(?ms)^REASON:\\s*(.*)\\z", 1)
    return F.when(F.regexp_like(c, F.lit("(?m)^REASON:")), strip(found)).otherwise(strip(c))


def ndjson_content(c: Column) -> Column:
    """message.content of each line, joined."""
    return F.array_join(F.transform(F.split(c, "\n", -1), lambda x: F.coalesce(F.get_json_object(x, "$.message.content"), F.lit(""))), "")


def canonical_hash(m: Column) -> Column:
    """SHA-256 of a map's entries as JSON, by sorted key."""
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m)))), 256)


def trim_keys(m: Column) -> Column:
    return F.transform_keys(m, lambda k, _: strip(k))


def tool_call(c: Column) -> Column:
    """(name, arguments) of an action that is a call: a JSON object with a name and an object of arguments, or text of the
    form name(key=value, ...) whose values are literals. arguments is JSON with sorted keys. Null for any other text, and
    for arguments that can't be read."""

    @F.pandas_udf("string")
    def keywords(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ast
        import json

        def read(text: str | None) -> str | None:
            if text is None:
                return None
            try:
                call = ast.parse(f"f({text})", mode="eval").body
                if not isinstance(call, ast.Call):
                    return None
                found = {k.arg: ast.literal_eval(k.value) for k in call.keywords}
                return json.dumps(found, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            except (SyntaxError, ValueError, TypeError, RecursionError):
                return None

        for batch in batches:
            found = {text: read(text) for text in batch.unique()}
            yield batch.map(found.get)

    text = strip(c)
    call = lambda name, given: F.when(name.isNotNull() & F.startswith(given, F.lit("{")), F.struct(name.alias("name"), given.alias("arguments")))
    # The text is parsed once, and only one that can be an object.
    by_json = let(text, lambda t: F.when(F.startswith(t, F.lit("{")), let(parsed(t), lambda v: let(F.struct(field(v, "name", "string").alias("n"), F.try_variant_get(v, "$.arguments", "variant").cast("string").alias("a")), lambda x: call(x["n"], x["a"])))))
    form = "(?sU)^(\\w+)\\s*\\((.*)\\)$"
    called = F.nullif(F.regexp_extract(text, form, 1), F.lit(""))
    # The Python side sees only texts of that form.
    values = keywords(F.when(called.isNotNull() & by_json.isNull(), F.regexp_extract(text, form, 2)))
    return F.coalesce(by_json, F.when(values.isNotNull(), F.struct(called.alias("name"), values.alias("arguments"))))
