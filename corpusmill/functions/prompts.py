"""Prompts and messages as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.text import alpha_label, strip


def _said(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def item_prompt(task_type: Column, prompt: Column, context: Column, buggy: Column, language: Column, errors: Column, constraints: Column) -> Column:
    """A benchmark item's prompt: a section for each field that says something, in a set order, each with a blank line behind;
    constraints only for debugging and generation."""
    kind = F.lower(F.coalesce(task_type, F.lit("")))
    fence = lambda c: F.concat(F.lit("```"), F.coalesce(language, F.lit("")), F.lit("\n"), c, F.lit("\n```"))
    asks = F.contains(kind, F.lit("debug")) | F.contains(kind, F.lit("gen"))
    parts = [
        F.when(_said(task_type), F.concat(F.lit("**Task Type:** "), task_type)),
        F.when(_said(context), F.concat(F.lit("**Context Code:**\n"), fence(context))),
        F.when(_said(buggy), F.concat(F.lit("**Buggy Code:**\n"), fence(buggy))),
        F.when(_said(errors), F.concat(F.lit("**Error Handling Pattern:** "), errors)),
        F.when(_said(prompt), F.concat(F.lit("**Task:**\n"), prompt)),
        F.when(asks & _said(constraints), F.concat(F.lit("**Constraints:**\n"), constraints)),
    ]
    return F.array_join(F.transform(F.filter(F.array(*parts), lambda p: p.isNotNull()), lambda p: F.concat(p, F.lit("\n"))), "\n")


def task_file(title: Column, body: Column) -> Column:
    """A task as Markdown: title, description and what is asked for."""
    return F.concat(
        F.lit("# Task: "), title, F.lit("\n\n## PR Information\n**Title:** "), title, F.lit("\n\n## Description\n"), body,
        F.lit("\n\n## Requirements\nBased on the PR description above, please implement the required changes.\n\n**Please implement this feature.**\n"),
    )


def display_choices(options: Column) -> Column:
    """`A. first` lines of an array of options, and the map from label to place, from 0."""
    labels = F.transform(options, lambda _, i: alpha_label(i))
    lines = F.array_join(F.transform(options, lambda o, i: F.concat(alpha_label(i), F.lit(". "), o)), "\n")
    return F.struct(lines.alias("text"), F.map_from_arrays(labels, F.transform(options, lambda _, i: i)).alias("places"))


def whole_or_raw(v: Column, required: list[str]) -> Column:
    """Whether a reply's object has all the fields that a type requires, none of them JSON null: else it is passed on as it is."""
    out = F.lit(True)
    for name in required:
        f = F.try_variant_get(v, f"$.{name}", "variant")
        out = out & F.coalesce(f.isNotNull() & ~F.is_variant_null(f), F.lit(False))
    return out


def patched(record: Column, change: Column) -> Column:
    """A map with the entries of another put in place of its own of the same key."""
    return F.map_concat(F.map_filter(record, lambda k, _: ~F.array_contains(F.map_keys(change), k)), change)


def flipped_message(role: Column, requestor: Column, n_calls: Column) -> Column:
    """(role, error) of a message in the other side's view: user and assistant change places; an assistant's tool call, a tool's
    reply to the assistant and any other role can't be shown there."""
    bad = F.when((role == "assistant") & (F.coalesce(n_calls, F.lit(0)) > 0), "assistant tool call").when((role == "tool") & (F.coalesce(requestor, F.lit("")) != "user"), "tool reply to the assistant").when(~role.isin("user", "assistant", "tool"), "unknown role")
    return F.struct(F.when(bad.isNull(), F.when(role == "user", "assistant").when(role == "assistant", "user").otherwise(role)).alias("role"), bad.alias("error"))


def provider_message(role: Column, content: Column, calls: Column, call_id: Column) -> Column:
    """A message as a provider's JSON: calls, an array of (id, name, arguments as JSON text), as functions with their arguments in
    text; a tool's reply names its call. An unknown role gives null."""
    function = F.transform(calls, lambda c: F.struct(c["id"].alias("id"), c["name"].alias("name"), F.struct(c["name"].alias("name"), c["arguments"].alias("arguments")).alias("function"), F.lit("function").alias("type")))
    some = F.size(F.coalesce(calls, F.array().cast("array<struct<id:string,name:string,arguments:string>>"))) > 0
    keep = {"ignoreNullFields": "false"}
    assistant = F.to_json(F.struct(role.alias("role"), content.alias("content"), F.when(some, function).alias("tool_calls")), keep)
    plain, tool = F.to_json(F.struct(role.alias("role"), content.alias("content")), keep), F.to_json(F.struct(role.alias("role"), content.alias("content"), call_id.alias("tool_call_id")), keep)
    return F.when(role == "assistant", assistant).when(role == "tool", tool).when(role.isin("user", "system"), plain)


def communication_fault(sender: Column, text: Column, n_calls: Column, solo: Column, stops: Column) -> Column:
    """Why a message breaks the rules, null if it keeps them: it says nothing, or says something and calls tools, or is an agent's
    text to nobody, unless that ends the run. The environment keeps them always."""
    says, calls = strip(F.coalesce(text, F.lit(""))) != "", F.coalesce(n_calls, F.lit(0)) > 0
    fault = F.when(~says & ~calls, "empty").when(says & calls, "mixed").when((sender == "agent") & solo & says & ~stops, "text in solo mode")
    return F.when(sender != "env", F.when(fault.isNotNull(), F.concat(sender, F.lit(": "), fault)))


def iso_text(ts: Column) -> Column:
    """A timestamp as Python's isoformat writes it: microseconds only if there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
