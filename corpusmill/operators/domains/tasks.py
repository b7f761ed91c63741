"""A list of things to do for users: the smallest domain."""

from __future__ import annotations

from corpusmill.operators.domains.store import Domain, Record, Store, check, common

DOMAIN = Domain("mock")
common(DOMAIN)
tool = DOMAIN.tool


@tool("write")
def create_task(db: Store, user_id: str, title: str, description: str | None = None) -> Record:
    user = db.need("users", user_id)
    key = f"task_{len(db.rows('tasks')) + 1}"
    user["tasks"].append(key)
    return db.add("tasks", key, {"task_id": key, "title": title, "description": description, "status": "pending"})


@tool("write")
def update_task_status(db: Store, task_id: str, status: str) -> Record:
    check(status in ("pending", "completed"), "invalid status")
    task = db.need("tasks", task_id)
    task["status"] = status
    return task


@tool("read")
def get_users(db: Store) -> list[Record]:
    return list(db.rows("users").values())


@tool("assert")
def assert_number_of_tasks(db: Store, user_id: str, expected_number: int) -> bool:
    return len(db.need("users", user_id)["tasks"]) == expected_number


@tool("assert")
def assert_task_status(db: Store, task_id: str, expected_status: str) -> bool:
    return db.need("tasks", task_id)["status"] == expected_status
