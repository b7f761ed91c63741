"""A shop: orders of users, items by product variant."""

from __future__ import annotations

import json
from collections import Counter

from corpusmill.operators.domains.store import Domain, Record, Store, calculate, check, common

DOMAIN = Domain("retail")
common(DOMAIN)
tool = DOMAIN.tool
tool("generic")(calculate)
MODIFIED = "pending (item modified)"


def _order(db: Store, order_id: str, *states: str) -> Record:
    order = db.need("orders", order_id)
    check(order["status"] in states, f"order is {order['status']}")
    return order


def _method(db: Store, order: Record, method_id: str) -> Record:
    methods = db.need("users", order["user_id"])["payment_methods"]
    check(method_id in methods, f"payment method {method_id} not found")
    return methods[method_id]


def _is_card(method: Record) -> bool:
    return method["source"] == "gift_card"


def _move(method: Record, amount: float) -> None:
    """Money onto a gift card, or off it; other methods keep no balance."""
    if _is_card(method):
        method["balance"] = round(method["balance"] + amount, 2)


def _entry(kind: str, amount: float, method_id: str) -> Record:
    return {"transaction_type": kind, "amount": amount, "payment_method_id": method_id}


def _all_held(order: Record, item_ids: list[str]) -> None:
    """An item may be named as often as the order has it."""
    held = Counter(i["item_id"] for i in order["items"])
    check(all(n <= held[i] for i, n in Counter(item_ids).items()), "item not in the order")


def _exchanges(db: Store, order: Record, item_ids: list[str], new_item_ids: list[str]) -> list[tuple[Record, Record]]:
    """The first item of each id with the variant of its product that it is to become."""
    _all_held(order, item_ids)
    check(len(item_ids) == len(new_item_ids), "as many new items as old ones are needed")
    out = []
    for old, new in zip(item_ids, new_item_ids, strict=True):
        item = next(i for i in order["items"] if i["item_id"] == old)
        variant = db.need("products", item["product_id"])["variants"].get(new)
        check(variant and variant["available"], f"item {new} not available")
        out.append((item, variant))
    return out


@tool("write")
def cancel_pending_order(db: Store, order_id: str, reason: str) -> Record:
    """Every payment is refunded, on a gift card at once."""
    order = _order(db, order_id, "pending")
    check(reason in ("no longer needed", "ordered by mistake"), "invalid reason")
    refunds = [_entry("refund", p["amount"], p["payment_method_id"]) for p in order["payment_history"]]
    for r in refunds:
        _move(_method(db, order, r["payment_method_id"]), r["amount"])
    order["payment_history"] += refunds
    order["status"], order["cancel_reason"] = "cancelled", reason
    return order


@tool("write")
def exchange_delivered_order_items(db: Store, order_id: str, item_ids: list, new_item_ids: list, payment_method_id: str) -> Record:
    """A request only: nothing is charged yet, but a gift card must cover the difference."""
    order = _order(db, order_id, "delivered")
    difference = round(sum(v["price"] - i["price"] for i, v in _exchanges(db, order, item_ids, new_item_ids)), 2)
    method = _method(db, order, payment_method_id)
    check(not _is_card(method) or method["balance"] >= difference, "balance too low")
    order.update(status="exchange requested", exchange_items=sorted(item_ids), exchange_new_items=sorted(new_item_ids), exchange_payment_method_id=payment_method_id, exchange_price_difference=difference)
    return order


@tool("write")
def return_delivered_order_items(db: Store, order_id: str, item_ids: list, payment_method_id: str) -> Record:
    order = _order(db, order_id, "delivered")
    method = _method(db, order, payment_method_id)
    check(_is_card(method) or payment_method_id == order["payment_history"][0]["payment_method_id"], "refund to a gift card or the way of payment only")
    _all_held(order, item_ids)
    order.update(status="return requested", return_items=sorted(item_ids), return_payment_method_id=payment_method_id)
    return order


@tool("write")
def modify_pending_order_items(db: Store, order_id: str, item_ids: list, new_item_ids: list, payment_method_id: str) -> Record:
    """Once for an order: afterwards its status says so. The difference is charged or refunded. All items take price and
    options of the last variant named, as the published rules have it."""
    order = _order(db, order_id, "pending")
    pairs = _exchanges(db, order, item_ids, new_item_ids)
    check(all(a != b for a, b in zip(item_ids, new_item_ids, strict=True)), "new and old item are the same")
    difference = sum(v["price"] - i["price"] for i, v in pairs)
    method = _method(db, order, payment_method_id)
    check(not _is_card(method) or method["balance"] >= difference, "balance too low")
    order["payment_history"].append(_entry("payment" if difference > 0 else "refund", abs(difference), payment_method_id))
    _move(method, -difference)
    for old, new in zip(item_ids, new_item_ids, strict=True):
        item = next((i for i in order["items"] if i["item_id"] == old), None)
        check(item, "item not in the order")
        item.update(item_id=new, price=pairs[-1][1]["price"], options=pairs[-1][1]["options"])
    order["status"] = MODIFIED
    return order


@tool("write")
def modify_pending_order_payment(db: Store, order_id: str, payment_method_id: str) -> Record:
    """The one payment of an order is made anew by another method and refunded to the old one."""
    order = _order(db, order_id, "pending", MODIFIED)
    method, history = _method(db, order, payment_method_id), order["payment_history"]
    check(len(history) == 1 and history[0]["transaction_type"] == "payment", "not exactly one payment")
    first, amount = history[0]["payment_method_id"], history[0]["amount"]
    check(first != payment_method_id, "same payment method")
    check(not _is_card(method) or method["balance"] >= amount, "balance too low")
    history += [_entry("payment", amount, payment_method_id), _entry("refund", amount, first)]
    _move(method, -amount)
    _move(_method(db, order, first), amount)
    return order


def _address(address1: str, address2: str, city: str, state: str, country: str, zip: str) -> Record:
    return {"address1": address1, "address2": address2, "city": city, "state": state, "country": country, "zip": zip}


@tool("write")
def modify_pending_order_address(db: Store, order_id: str, **address: str) -> Record:
    order = _order(db, order_id, "pending", MODIFIED)
    order["address"] = _address(**address)
    return order


@tool("write")
def modify_user_address(db: Store, user_id: str, **address: str) -> Record:
    user = db.need("users", user_id)
    user["address"] = _address(**address)
    return user


@tool("read")
def find_user_id_by_email(db: Store, email: str) -> str:
    found = next((k for k, u in db.rows("users").items() if u["email"].lower() == email.lower()), None)
    check(found, "user not found")
    return found


@tool("read")
def find_user_id_by_name_zip(db: Store, first_name: str, last_name: str, zip: str) -> str:
    name = (first_name.lower(), last_name.lower(), zip)
    found = next((k for k, u in db.rows("users").items() if (u["name"]["first_name"].lower(), u["name"]["last_name"].lower(), u["address"]["zip"]) == name), None)
    check(found, "user not found")
    return found


@tool("read")
def get_order_details(db: Store, order_id: str) -> Record:
    return db.need("orders", order_id)


@tool("read")
def get_product_details(db: Store, product_id: str) -> Record:
    return db.need("products", product_id)


@tool("read")
def get_user_details(db: Store, user_id: str) -> Record:
    return db.need("users", user_id)


@tool("read")
def list_all_product_types(db: Store) -> str:
    return json.dumps({p["name"]: p["product_id"] for p in db.rows("products").values()}, sort_keys=True)


def statistics(tables: dict) -> dict[str, int]:
    return {"num_products": len(tables["products"]), "num_users": len(tables["users"]), "num_orders": len(tables["orders"]), "total_num_items": sum(len(p["variants"]) for p in tables["products"].values())}
