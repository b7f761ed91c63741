"""Transactional logs: an ordered fold over each task's actions, replayed, hashed and rewarded.

A task's actions are one record's worth of data, and its fold is a sequence; tasks are spread by key.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.domains.store import Domain, Store, Tables, canonical


def _same_reply(got: str, want: str) -> bool:
    """Texts, or the JSON of them, are equal; two refusals are, whatever they say."""
    if got.startswith("Error") or want.startswith("Error"):
        return got.startswith("Error") and want.startswith("Error")
    try:
        return got == want or json.loads(got) == json.loads(want)
    except ValueError:
        return False


#: Outcomes of calls that a partition remembers, bytes of the states they lead to, and outcomes after which it stops if fewer than half
#: of its calls were known.
REMEMBERED, REMEMBERED_BYTES, TRIED = 20_000, 64 << 20, 2_000


def fold(actions: DataFrame, base: Tables, domain: Domain, task: str = "task_id", order: str = "pos", name: str = "name", args: str = "arguments", side: str | None = None, reply: str | None = None) -> DataFrame:
    """(task, n_actions, n_errors, n_differ, checks, responses, state_hash, changes): every task's actions, in order, each task
    on a state of its own over the shared base.

    `side` names a column with the requestor of an action, whose tools alone are known to it; `reply` one with the response
    that a log has, of which n_differ counts those that a replay doesn't give, null where there is none. Assertions among
    the actions give `checks`, an error counts as false, and not `responses`. Arguments that are no JSON object are an
    error. changes is the JSON of all records that differ from the base; state_hash, its digest."""
    kind = actions.schema[task].dataType.simpleString()
    nothing = pickle.dumps({})
    cols = [c for c in (side, reply) if c]

    def act(store: Store, what: str, given: str | None, who: str | None) -> tuple[str, bool]:
        try:
            return domain.step(store, what, json.loads(given or "{}"), who)
        except (TypeError, ValueError) as e:
            return f"Error: {e}", True

    def recalled(memo: dict, at: bytes, what: str, given: str | None, who: str | None) -> tuple[bytes, str, bool]:
        """The state that a call on state `at` leads to, with its outcome."""
        known, states = memo["known"], memo["states"]
        memo["calls"] += 1
        came = known.get((at, what, given, who))
        if came is None:
            memo["misses"] += 1
            store = states[at].copy() if at in states else Store(base)
            got, failed = act(store, what, given, who)
            # All that a tool can read: the records taken, in their order.
            then = pickle.dumps(store.own)
            if then not in states:
                states[then] = store
                memo["size"] += len(then)
            came = known[at, what, given, who] = (then, got, failed)
            if len(known) > REMEMBERED or memo["size"] > REMEMBERED_BYTES:
                known.clear()
                memo.update(states={then: store}, size=len(then))
        return came

    def play(key: object, calls: list, memo: dict) -> tuple:
        at, replies, checks, bad, differ = nothing, [], [], 0, 0
        store = Store(base) if memo["poor"] else None
        for what, given, who, want in calls:
            if store is None:
                at, got, failed = recalled(memo, at, what, given, who)
                if memo["misses"] > TRIED and 2 * memo["misses"] > memo["calls"]:
                    store = memo["states"][at].copy() if at in memo["states"] else Store(base)
                    memo.update(known={}, states={}, poor=True)
            else:
                got, failed = act(store, what, given, who)
            tool = domain.tools.get(what)
            if tool and tool.kind == "assert":
                checks.append(not failed and got == "true")
                continue
            replies.append(got)
            bad += failed
            if isinstance(want, str):
                differ += not _same_reply(got, want)
        end = memo["known"].get(at) if store is None else None
        if end is None:
            last = store or memo["states"].get(at) or Store(base)
            end = (last.digest(), canonical(last.changes()))
            if store is None:
                memo["known"][at] = end
        return key, len(calls), bad, differ, checks, replies, *end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by task and in order; a task may go on in the next batch."""
        key, rows, out = None, [], []
        memo = {"known": {}, "states": {}, "calls": 0, "misses": 0, "size": 0, "poor": False}

        def packed() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [kept.type, *types], strict=True)], names=names)

        kept = None
        for batch in batches:
            kept = batch.column(task) if kept is None else kept
            none = [None] * batch.num_rows
            columns = [batch.column(c).to_pylist() if c else none for c in (task, name, args, side, reply)]
            for k, *call in zip(*columns, strict=True):
                if rows and k != key:
                    out.append(play(key, rows, memo))
                    rows = []
                key = k
                rows.append(call)
            if len(out) >= 1000:
                yield packed()
                out = []
        if rows:
            out.append(play(key, rows, memo))
        if out:
            yield packed()

    names = [task, "n_actions", "n_errors", "n_differ", "checks", "responses", "state_hash", "changes"]
    types = [pa.int64()] * 3 + [pa.list_(pa.bool_()), pa.list_(pa.string()), pa.string(), pa.string()]
    shape = f"{task} {kind}, n_actions long, n_errors long, n_differ long, checks array<boolean>, responses array<string>, state_hash string, changes string"
    # One sorted stream a partition: tasks are many and short, and a call for each would cost more than its fold.
    dealt = actions.select(task, order, name, args, *cols).repartition(task).sortWithinPartitions(task, order)
    return dealt.mapInArrow(run, shape)


def end_state_reward(gold: DataFrame, model: DataFrame, task: str = "task_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(task, db_match, checks_hold, keep): whether the model's actions lead to the gold actions' state, and whether all assertions
    of its log hold; a task without model actions fails both. `keep` names columns of the model's to go along."""
    got = model.select(task, F.col("state_hash").alias("got"), F.forall("checks", lambda c: c).alias("holds"), *keep)
    return gold.select(task, F.col("state_hash").alias("want")).join(got, task, "left").select(task, F.coalesce(F.col("want") == F.col("got"), F.lit(False)).alias("db_match"), F.coalesce("holds", F.lit(False)).alias("checks_hold"), *keep)


def outputs_told(outputs: Column, replies: Column) -> Column:
    """Whether each required output is in some reply of the agent, case and commas of the reply aside."""
    return F.forall(outputs, lambda o: F.exists(replies, lambda r: F.contains(F.replace(F.lower(r), F.lit(","), F.lit("")), F.lower(o))))


def assertions_met(verdicts: Column) -> Column:
    """1 if the judge found every assertion met, also if there are none; else 0."""
    return F.when(F.forall(F.coalesce(verdicts, F.array().cast("array<boolean>")), lambda v: F.coalesce(v, F.lit(False))), 1.0).otherwise(0.0)


def combined_reward(basis: Column, scores: dict[str, Column], ended_well: Column) -> Column:
    """The product of the scores that the basis names; 0 for a run that was stopped early."""
    out = F.lit(1.0)
    for name, score in scores.items():
        out = out * F.when(F.array_contains(basis, name), score.cast("double")).otherwise(1.0)
    return F.when(ended_well, out).otherwise(0.0)


def one_kind_of_content(text: Column, n_calls: Column) -> Column:
    """Whether a message has text or tool calls, and not both."""
    has_text = F.coalesce(F.trim(text) != "", F.lit(False))
    return has_text != F.coalesce(n_calls > 0, F.lit(False))


def protocol_breaks(turns: DataFrame, conv: str, order: str, role: str, n_calls: str) -> DataFrame:
    """(conv, n_calls, n_replies, ok): whether as many tool turns follow as tools were called, right behind the turn that called
    them. A conversation's turns are one window."""
    w = Window.partitionBy(conv).orderBy(order)
    is_tool = F.col(role) == "tool"
    block = F.sum(F.when(is_tool, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    each = turns.withColumn("__b", block).groupBy(conv, "__b").agg(F.coalesce(F.sum(F.when(~is_tool, F.col(n_calls))), F.lit(0)).alias("__c"), F.count_if(is_tool).alias("__r"))
    return each.groupBy(conv).agg(F.sum("__c").alias("n_calls"), F.sum("__r").alias("n_replies"), F.bool_and(F.col("__c") == F.col("__r")).alias("ok"))
