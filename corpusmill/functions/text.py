"""Text as Column expressions. White space and word characters are Unicode's, as in Python, hence (?U)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python strips U+001C to U+001F as well.
_SPACE = "[\\p{IsWhite_Space}\\x1c-\\x1f]"
#: Fixed value: the characters that this matches.
BLANKS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_SPACE}+|{_SPACE}+$", "")


def truthy(c: Column) -> Column:
    """Null for an empty string: `or` in Python passes over both."""
    return F.nullif(c, F.lit(""))


def word_list(c: Column) -> Column:
    """Words: runs of anything but white space. Every kind of it becomes a blank, which texts are split at without a pattern."""
    return F.filter(F.split(F.translate(c, BLANKS, " " * len(BLANKS)), " ", -1), lambda w: w != "")


def token_list(c: Column) -> Column:
    """Runs of word characters, and every other character but white space by itself."""
    return F.regexp_extract_all(c, F.lit("(?U)(\\w+|[^\\w\\s])"), F.lit(1))


def token_count(c: Column) -> Column:
    """Approximate tokens; at least one."""
    return F.greatest(F.lit(1), F.size(token_list(c)))


def char_tokens(c: Column) -> Column:
    """A token for every four characters."""
    return F.floor(F.length(c) / 4).cast("int")


def squeeze_space(c: Column) -> Column:
    """CRLF to LF, blanks and tabs to one space, two or more line feeds to two, stripped."""
    c = F.replace(c, F.lit("\r\n"), F.lit("\n"))
    return strip(F.regexp_replace(F.regexp_replace(c, "[ \\t]+", " "), "\\n{2,}", "\n\n"))


def clean_paragraphs(c: Column) -> Column:
    """No blanks before a line feed, at most one empty line in a row, stripped."""
    return strip(F.regexp_replace(F.regexp_replace(c, "[ \\t]+\\n", "\n"), "\\n{3,}", "\n\n"))


def preview(c: Column, size: int = 1200) -> Column:
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit("..."))).otherwise(c)


def sanitize(c: Column, size: int = 4096) -> Column:
    """Stripped, then cut; not stripped again."""
    return F.substring(strip(c), 1, size)


def drop_think(c: Column) -> Column:
    """Without closed think blocks; three or more line feeds become two."""
    return strip(F.regexp_replace(F.regexp_replace(c, "(?s)<think>.*?</think>", ""), "\\n\\s*\\n\\s*\\n", "\n\n"))


def drop_reasoning(c: Column) -> Column:
    """Without closed blocks of any of four reasoning tags, in either case."""
    for tag in ("think", "redacted_reasoning", "reasoning", "thought"):
        c = F.regexp_replace(c, f"(?si)<{tag}>.*?</{tag}>", "")
    return strip(c)


def after_think(c: Column) -> Column:
    """What follows the last closing think tag, or everything."""
    return strip(F.element_at(F.split(c, "</think>", -1), -1))


def unclosed_think(c: Column) -> Column:
    return F.contains(c, F.lit("<think>")) & ~F.contains(c, F.lit("</think>"))


def before(c: Column, mark: str) -> Column:
    """What comes before the first `mark`, or everything."""
    return F.substring_index(c, mark, 1)


def assistant_reply(c: Column) -> Column:
    """What follows the last assistant tag, up to the next user tag or the closing one. Without an assistant tag: the text
    less closed system and user blocks and less prompts of the plain `User: ... Assistant:` forms."""
    tagged = before(before(F.substring_index(c, "<|assistant|>", -1), "<|user|>"), "</|assistant|>")
    plain = c
    for opening, closing in (("<\\|system\\|>", "</\\|system\\|>"), ("<\\|user\\|>", "</\\|user\\|>"), ("User:", "Assistant:"), ("Human:", "Assistant:")):
        plain = F.regexp_replace(plain, f"(?s){opening}.*?{closing}", "")
    return strip(F.when(F.contains(c, F.lit("<|assistant|>")), tagged).otherwise(plain))


def code_lines(c: Column) -> Column:
    """Lines that look like code, for replies without fences: from the first import or function on, up to a lone closing
    brace that is the fifth line or a later one; before that, imports and functions start it. Null if none do."""
    shape = "struct<taken: array<string>, open: boolean, done: boolean>"
    start = F.struct(F.array().cast("array<string>").alias("taken"), F.lit(False).alias("open"), F.lit(False).alias("done")).cast(shape)

    def step(acc: Column, line: Column) -> Column:
        begins = F.regexp_like(line, F.lit("^\\s*(use\\s|fn\\s+\\w)"))
        takes = ~acc["done"] & (acc["open"] | begins)
        taken = F.when(takes, F.concat(acc["taken"], F.array(line))).otherwise(acc["taken"])
        ends = takes & ~begins & (strip(line) == "}") & (F.size(taken) > 3)
        return F.struct(taken.alias("taken"), (acc["open"] | begins).alias("open"), (acc["done"] | ends).alias("done")).cast(shape)

    taken = F.aggregate(F.split(strip(c), "\n", -1), start, step, lambda a: a["taken"])
    return F.when(F.size(taken) > 0, F.array_join(taken, "\n"))


def fenced_code(c: Column, lang: str = "rust") -> Column:
    """The first fenced block; without one the lines that look like code; without those the whole reply."""
    fenced = F.regexp_like(c, F.lit(f"(?s)```(?:{lang})?\\s*.*?```"))
    return F.when(fenced, strip(F.regexp_extract(c, f"(?s)```(?:{lang})?\\s*(.*?)```", 1))).otherwise(F.coalesce(code_lines(c), c))


def drop_fences(c: Column, lang: str = "rust") -> Column:
    return strip(F.replace(F.replace(c, F.lit(f"```{lang}"), F.lit("")), F.lit("```"), F.lit("")))


def drop_controls(c: Column) -> Column:
    return F.regexp_replace(c, "[\\x00-\\x1f\\x7f-\\x9f]", "")


def fold_behavior(c: Column) -> Column:
    """Lower case, white space squeezed, stripped."""
    return F.regexp_replace(F.lower(strip(c)), f"{_SPACE}+", " ")


def letters_digits(c: Column) -> Column:
    """Lower-case letters and digits only: for comparisons that ignore all else."""
    return F.lower(F.regexp_replace(c, "[^\\p{L}\\p{N}]", ""))


def safe_dir(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "[/:@#]+", "-"), "^-+|-+$", "")


def alpha_label(i: Column) -> Column:
    """0 is A, 25 is Z, 26 is AA."""
    digits = F.expr("filter(array(1, 2, 3, 4, 5, 6), x -> true)")
    start = F.struct((i.cast("long") + 1).alias("n"), F.lit("").alias("s"))

    def step(acc: Column, _: Column) -> Column:
        n = acc["n"]
        more = n > 0
        return F.struct(F.when(more, F.floor((n - 1) / 26).cast("long")).otherwise(n).alias("n"), F.when(more, F.concat(F.char(F.lit(65) + (n - 1) % 26), acc["s"])).otherwise(acc["s"]).alias("s"))

    return F.aggregate(digits, start, step, lambda a: a["s"])


def longest_prefix(c: Column, options: Column) -> Column:
    """The longest of `options` that the text starts with; null if none."""
    fit = F.filter(options, lambda o: F.startswith(c, o))
    ranked = F.array_sort(F.transform(fit, lambda o: F.struct((-F.length(o)).alias("n"), o.alias("o"))))
    return F.try_element_at(ranked, F.lit(1))["o"]


def fill_placeholders(template: Column, values: dict[str, Column]) -> Column:
    """{{K}} and <K> replaced, then three or more line feeds to two."""
    for key, value in values.items():
        for form in (f"{{{{{key}}}}}", f"<{key}>"):
            template = F.replace(template, F.lit(form), value)
    return F.regexp_replace(template, "\\n{3,}", "\n\n")


def budgeted(head: Column, content: Column, foot: Column, limit: int, spare: int = 50) -> Column:
    """head + content + foot; if that is longer than `limit`, the content is cut to what is left, less `spare`, and marked."""
    room = F.greatest(F.lit(0), F.lit(limit - spare) - F.length(head) - F.length(foot))
    cut = F.when(F.length(content) > room, F.concat(F.substring(content, F.lit(1), room), F.lit("...[truncated]"))).otherwise(content)
    whole = F.concat(head, content, foot)
    return F.when(F.length(whole) <= limit, whole).otherwise(F.concat(head, cut, foot))
