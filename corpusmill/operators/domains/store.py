"""A task's view of a database, and the registry of tools that act on it."""

from __future__ import annotations

import copy
import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

Record = dict[str, Any]
Tables = Mapping[str, Mapping[str, Record]]


def canonical(value: Any) -> str:
    """JSON with sorted keys and no spaces."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


class ToolError(ValueError):
    """A tool's refusal."""


def check(ok: Any, reason: str) -> None:
    if not ok:
        raise ToolError(reason)


class Store:
    """Tables of records by key, over a base that is shared and never written. A record is copied when it is first taken, so a
    task costs what it touches and not the size of the database. Within a step the records taken are remembered as they
    were, which is what `undo` brings back."""

    def __init__(self, base: Tables) -> None:
        self.base, self.own, self.before = base, {}, {}

    def copy(self) -> Store:
        out = Store(self.base)
        out.own = copy.deepcopy(self.own)
        return out

    def get(self, table: str, key: Any) -> Record | None:
        """The record to read or write, null if there is none."""
        at = (table, key)
        if at not in self.own:
            found = self.base.get(table, {}).get(key)
            if found is None:
                return None
            self.own[at] = copy.deepcopy(found)
        if at not in self.before:
            self.before[at] = copy.deepcopy(self.own[at])
        return self.own[at]

    def need(self, table: str, key: Any) -> Record:
        found = self.get(table, key)
        check(found is not None, f"{table}: {key} not found")
        return found

    def add(self, table: str, key: str, record: Record) -> Record:
        self.before.setdefault((table, key), None)
        self.own[table, key] = record
        return record

    def rows(self, table: str) -> dict[str, Record]:
        """All records, to read only: in the order of the base, then as they were added."""
        out = {k: self.own.get((table, k), r) for k, r in self.base.get(table, {}).items()}
        return out | {k: r for (t, k), r in self.own.items() if t == table and k not in out}

    def begin(self) -> None:
        self.before = {}

    def undo(self) -> None:
        for at, record in self.before.items():
            if record is None:
                del self.own[at]
            else:
                self.own[at] = record
        self.before = {}

    def changes(self) -> dict[str, dict[str, Record]]:
        """Records that differ from the base, by table and key. Two tasks on one base end in the same state if these agree."""
        out: dict[str, dict[str, Record]] = {}
        for (table, key), record in self.own.items():
            if record != self.base.get(table, {}).get(key):
                out.setdefault(table, {})[key] = record
        return out

    def digest(self) -> str:
        return hashlib.sha256(canonical(self.changes()).encode()).hexdigest()


@dataclass(frozen=True)
class Tool:
    run: Callable[..., Any]
    kind: str  # read, write, generic, assert, setup
    side: str  # assistant or user


@dataclass
class Domain:
    """Tools by name, and what happens between two steps."""

    name: str
    tools: dict[str, Tool] = field(default_factory=dict)
    sync: Callable[[Store], None] | None = None

    def tool(self, kind: str, side: str = "assistant") -> Callable:
        def register(run: Callable) -> Callable:
            self.tools[run.__name__] = Tool(run, kind, side)
            return run

        return register

    def names(self, kind: str, side: str | None = None) -> list[str]:
        return sorted(n for n, t in self.tools.items() if t.kind == kind and side in (None, t.side))

    def step(self, store: Store, name: str, args: Mapping[str, Any], side: str | None = None) -> tuple[str, bool]:
        """The tool's response as text, and whether it failed. A tool that fails leaves the state as it was; one of the other
        side is unknown. After each step the domain's tables are brought into line."""
        store.begin()
        found = self.tools.get(name)
        try:
            check(found is not None and side in (None, found.side), f"unknown tool {name}")
            out = found.run(store, **args)
            reply, failed = out if isinstance(out, str) else canonical(out), False
        except Exception as e:  # noqa: BLE001
            store.undo()
            reply, failed = f"Error: {e}", True
        store.begin()
        if self.sync:
            self.sync(store)
        return reply, failed


def calculate(db: Store, expression: str) -> str:
    """The value of an arithmetic expression, to two digits: numbers, + - * /, brackets. A parser of its own, no eval."""
    check(expression.strip() and all(c in "0123456789+-*/(). " for c in expression), "invalid characters")
    return str(round(float(arithmetic(expression)), 2))


def arithmetic(expression: str) -> float:
    import ast
    import operator

    binary = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.FloorDiv: operator.floordiv, ast.Pow: operator.pow}

    def value(node: ast.AST) -> float:
        match node:
            case ast.Constant(value=int() | float()):
                return node.value
            case ast.UnaryOp(op=ast.USub()):
                return -value(node.operand)
            case ast.UnaryOp(op=ast.UAdd()):
                return value(node.operand)
            case ast.BinOp() if type(node.op) in binary:
                a, b = value(node.left), value(node.right)
                check(not isinstance(node.op, ast.Pow) or abs(b) <= 1000, "exponent too large")
                return binary[type(node.op)](a, b)
        raise ToolError("not an arithmetic expression")

    return value(ast.parse(expression.strip(), mode="eval").body)


def transfer_to_human_agents(db: Store, summary: str) -> str:
    return "Transfer successful"


def common(domain: Domain) -> None:
    """What every domain offers."""
    domain.tool("generic")(transfer_to_human_agents)
