"""Chat and instruction records: normalising, styling, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.jsonish import strict_json
from corpusmill.functions.text import sanitize, strip, truthy

# Field aliases in order of precedence.
USER_FIELDS = ("user", "question", "prompt", "input", "instruction", "query")
ASSISTANT_FIELDS = ("assistant", "answer", "response", "target", "output")


def first_field(df: DataFrame, names: tuple[str, ...]) -> Column:
    found = [truthy(F.col(n)) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def normalize(raw: DataFrame, default_system: str = "", keep: tuple[str, ...] = ()) -> DataFrame:
    """(system, user, assistant, reject_reason): the first non-empty alias each, stripped and cut; rows without a user or an
    assistant have a reason instead of being lost."""
    user, assistant = first_field(raw, USER_FIELDS), first_field(raw, ASSISTANT_FIELDS)
    system = F.coalesce(first_field(raw, ("system",)), F.lit(default_system))
    bad = user.isNull() | assistant.isNull()
    return raw.select(*keep, strip(system).alias("system"), sanitize(user).alias("user"), sanitize(assistant).alias("assistant"), F.when(bad, "missing user/assistant fields").alias("reject_reason"))


def normalize_json(lines: DataFrame, value_col: str = "value", default_system: str = "", keep: tuple[str, ...] = ()) -> DataFrame:
    """The same for JSON text of either shape: an object with aliases, or a list [question, {"answer": ...}]."""
    get = lambda n: truthy(F.get_json_object(value_col, f"$.{n}"))
    as_list = F.startswith(F.ltrim(F.col(value_col)), F.lit("["))
    user = F.when(as_list, truthy(F.get_json_object(value_col, "$[0]"))).otherwise(F.coalesce(*[get(n) for n in USER_FIELDS]))
    assistant = F.when(as_list, truthy(F.get_json_object(value_col, "$[1].answer"))).otherwise(F.coalesce(*[get(n) for n in ASSISTANT_FIELDS]))
    system = F.when(as_list, F.lit(default_system)).otherwise(F.coalesce(get("system"), F.lit(default_system)))
    reason = F.when(strict_json(F.col(value_col)).isNull(), "malformed").when(user.isNull() | assistant.isNull(), "missing user/assistant fields")
    return lines.select(*keep, strip(system).alias("system"), sanitize(user).alias("user"), sanitize(assistant).alias("assistant"), reason.alias("reject_reason"))


def style(rows: DataFrame, text: str, mode: str = "prepend") -> DataFrame:
    """The style before the system text, or instead of it."""
    if mode not in ("prepend", "replace"):
        raise ValueError(f"unknown mode {mode}")
    old = F.coalesce(F.col("system"), F.lit(""))
    new = F.lit(text) if mode == "replace" else F.when(old == "", F.lit(text)).otherwise(F.concat(F.lit(text + "\n\n"), old))
    return rows.withColumn("system", new)


def chatml(system: Column, user: Column) -> Column:
    """The prompt up to the assistant's turn; without a system text no system block."""
    head = F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.lit("<|im_start|>system\n"), system, F.lit("<|im_end|>\n"))).otherwise("")
    return F.concat(head, F.lit("<|im_start|>user\n"), user, F.lit("<|im_end|>\n<|im_start|>assistant"))


def render(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(input, target) of normalised rows."""
    return rows.select(*keep, chatml(strip(F.coalesce(F.col("system"), F.lit(""))), strip(F.col("user"))).alias("input"), strip(F.col("assistant")).alias("target"))


def fallback_prompt(system: Column, user: Column) -> Column:
    head = F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.lit("System: "), system, F.lit("\n"))).otherwise("")
    return F.concat(head, F.lit("User: "), user, F.lit("\nAssistant:"))


def to_messages(turns: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: messages in order."""
    packed = turns.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct(order, role, text))).alias("m"))
    return packed.select(conv, F.transform("m", lambda x: F.struct(x[role].alias("role"), x[text].alias("content"))).alias("messages"))


def last_of_role(messages: Column, role: str) -> Column:
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(-1))["content"]


def detect_format(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(system, user, assistant) from {input, target}, {user, assistant} or {messages}; the last message of a role wins."""
    has = set(rows.columns)
    shapes = []
    if {"user", "assistant"} <= has:
        shapes.append(F.when(F.col("user").isNotNull() & F.col("assistant").isNotNull(), F.struct((F.col("system") if "system" in has else F.lit(None).cast("string")).alias("system"), F.col("user").alias("user"), F.col("assistant").alias("assistant"))))
    if {"input", "target"} <= has:
        shapes.append(F.when(F.col("input").isNotNull() & F.col("target").isNotNull(), F.struct(F.lit(None).cast("string").alias("system"), F.col("input").alias("user"), F.col("target").alias("assistant"))))
    if "messages" in has:
        m = F.col("messages")
        shapes.append(F.struct(last_of_role(m, "system").alias("system"), last_of_role(m, "user").alias("user"), last_of_role(m, "assistant").alias("assistant")))
    return rows.select(*keep, F.coalesce(*shapes).alias("r")).select(*keep, "r.system", "r.user", "r.assistant")


def exchange_pairs(turns: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """Each user turn with the assistant turn right after it, and the conversation's last system text before them."""
    w = Window.partitionBy(conv).orderBy(order)
    seen = turns.withColumn("system", F.last(F.when(F.col("role") == "system", F.col("text")), ignorenulls=True).over(w))
    seen = seen.withColumn("next_role", F.lead("role").over(w)).withColumn("assistant", F.lead("text").over(w))
    return seen.where("role = 'user' and next_role = 'assistant'").select(conv, order, "system", F.col("text").alias("user"), "assistant")


def instruction_text(instruction: Column, given: Column, output: Column) -> Column:
    """Continued-pretraining text of an instruction; a blank input is left out."""
    return F.concat(instruction, F.when(strip(F.coalesce(given, F.lit(""))) != "", F.concat(F.lit("\n\nInput: "), given)).otherwise(""), F.lit("\n\nResponse: "), output)


def instruction_pair(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(user, assistant, text): instruction and input as the user's text, and the tagged fallback form."""
    user = strip(F.concat_ws("\n", "instruction", F.coalesce("input", F.lit(""))))
    return rows.select(*keep, user.alias("user"), F.col("output").alias("assistant"), F.concat(F.lit("<|user|>"), user, F.lit("<|end|><|assistant|>"), F.col("output"), F.lit("<|end|>")).alias("text"))


def turn_index(turns: DataFrame, conv: str, order: str) -> DataFrame:
    return turns.withColumn("turn_idx", F.row_number().over(Window.partitionBy(conv).orderBy(order)) - 1)


def flip_roles(turns: DataFrame) -> DataFrame:
    """The other side's view: user and assistant change places; system and tool turns stay."""
    return turns.withColumn("role", F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "user").otherwise(F.col("role")))


def transcript(messages: Column) -> Column:
    """`Role: content` lines without the system's."""
    kept = F.filter(messages, lambda m: m["role"] != "system")
    return F.array_join(F.transform(kept, lambda m: F.concat(F.initcap(m["role"]), F.lit(": "), F.coalesce(m["content"], F.lit("")))), "\n")


def chunk_lines(chunks: Column) -> Column:
    """`[chunk_id] text` lines of an array of chunk structs."""
    return F.array_join(F.transform(chunks, lambda c: F.concat(F.lit("["), c["chunk_id"], F.lit("] "), c["text"])), "\n")


def call_text(name: Column, args: Column) -> Column:
    """`name(k=v, ...)` of a map of arguments, by key."""
    return F.concat(name, F.lit("("), F.array_join(F.transform(F.array_sort(F.map_entries(args)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", "), F.lit(")"))


def unpivot_outputs(items: DataFrame, key: str, prefix: str = "output") -> DataFrame:
    """Numbered columns output1..n, in numeric order, as rows (key, output_no, output_text); nulls are no outputs."""
    names = sorted((c for c in items.columns if c.startswith(prefix) and c[len(prefix) :].isdigit()), key=lambda c: int(c[len(prefix) :]))
    each = F.array(*[F.struct(F.lit(int(c[len(prefix) :])).alias("no"), F.col(c).cast("string").alias("text")) for c in names])
    return items.select(key, F.explode(each).alias("o")).where("o.text is not null").select(key, F.col("o.no").alias("output_no"), F.col("o.text").alias("output_text"))


def task_parts(tasks: DataFrame, col: str = "task_id") -> DataFrame:
    """intent of a leading [..], persona of [PERSONA:..], number of issues: parts between bars."""
    return tasks.withColumns({"intent": F.regexp_extract(col, "^\\[([^\\]]+)\\]", 1), "persona": F.regexp_extract(col, "\\[PERSONA:([^\\]]+)\\]", 1), "num_issues": F.size(F.split(col, "\\|", -1))})


def export_messages(rows: DataFrame, system: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Validated question-answer rows as three messages, citations at the end of the answer."""
    context = F.concat(F.lit("CITED CONTEXT:"), F.array_join(F.transform("citations", lambda c: F.concat(F.lit("\n["), c, F.lit("] (excerpt) ..."))), ""))
    user = F.concat(F.col("question"), F.lit("\n\n"), context)
    answer = F.concat(F.col("answer"), F.lit("\n\nCitations: "), F.array_join("citations", ", "))
    message = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    return rows.select(*keep, F.array(message("system", F.lit(system)), message("user", user), message("assistant", answer)).alias("messages"))
