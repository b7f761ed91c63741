"""Folds over domain logs: each tool's effect, refusals that leave no trace, rewards, replays."""

from __future__ import annotations

import copy
import json

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import state
from corpusmill.operators.domains import DOMAINS
from corpusmill.operators.domains import telecom as T
from corpusmill.operators.domains.store import Store, arithmetic

ADDRESS = {"address1": "1 A St", "address2": "", "city": "Bonn", "state": "NW", "country": "DE", "zip": "53111"}
SHOP = {
    "users": {"u1": {"user_id": "u1", "name": {"first_name": "Ann", "last_name": "Li"}, "email": "Ann@x.org", "address": {"zip": "10115"}, "payment_methods": {"g": {"source": "gift_card", "balance": 10.0}, "c": {"source": "credit_card"}}}},
    "products": {"p": {"product_id": "p", "name": "Mug", "variants": {"i1": {"price": 5.0, "available": True, "options": {"size": "S"}}, "i2": {"price": 7.5, "available": True, "options": {"size": "L"}}, "i3": {"price": 1.0, "available": False, "options": {}}}}},
    "orders": {
        "o1": {"order_id": "o1", "user_id": "u1", "status": "pending", "address": {}, "items": [{"item_id": "i1", "product_id": "p", "price": 5.0, "options": {"size": "S"}}], "payment_history": [{"transaction_type": "payment", "amount": 5.0, "payment_method_id": "g"}]},
        "o2": {"order_id": "o2", "user_id": "u1", "status": "delivered", "address": {}, "items": [{"item_id": "i2", "product_id": "p", "price": 7.5, "options": {}}] * 2, "payment_history": [{"transaction_type": "payment", "amount": 15.0, "payment_method_id": "c"}]},
    },
}


def play(domain: str, base: dict, *steps: tuple) -> tuple[Store, list[tuple[str, bool]]]:
    """Steps are (name, arguments); the base must stay as it was."""
    before, db = copy.deepcopy(base), Store(base)
    out = [DOMAINS[domain].step(db, name, args) for name, args in steps]
    assert base == before
    return db, out


def test_shop_writes():
    db, out = play("retail", SHOP, ("modify_pending_order_items", {"order_id": "o1", "item_ids": ["i1"], "new_item_ids": ["i2"], "payment_method_id": "g"}))
    assert not out[0][1]
    order = db.get("orders", "o1")
    assert order["status"] == "pending (item modified)" and order["items"][0] == {"item_id": "i2", "product_id": "p", "price": 7.5, "options": {"size": "L"}}
    assert db.get("users", "u1")["payment_methods"]["g"]["balance"] == 7.5 and order["payment_history"][-1] == {"transaction_type": "payment", "amount": 2.5, "payment_method_id": "g"}
    db, out = play("retail", SHOP, ("exchange_delivered_order_items", {"order_id": "o2", "item_ids": ["i2", "i2"], "new_item_ids": ["i1", "i1"], "payment_method_id": "c"}))
    assert db.get("orders", "o2")["exchange_price_difference"] == -5.0 and db.get("orders", "o2")["status"] == "exchange requested"
    db, out = play("retail", SHOP, ("modify_pending_order_payment", {"order_id": "o1", "payment_method_id": "c"}), ("cancel_pending_order", {"order_id": "o1", "reason": "no longer needed"}))
    history = [(p["transaction_type"], p["payment_method_id"]) for p in db.get("orders", "o1")["payment_history"]]
    assert history == [("payment", "g"), ("payment", "c"), ("refund", "g"), ("refund", "g"), ("refund", "c"), ("refund", "g")]
    assert db.get("users", "u1")["payment_methods"]["g"]["balance"] == 25.0 and db.get("orders", "o1")["cancel_reason"] == "no longer needed"
    db, out = play("retail", SHOP, ("modify_pending_order_address", {"order_id": "o1", **ADDRESS}), ("modify_user_address", {"user_id": "u1", **ADDRESS}), ("return_delivered_order_items", {"order_id": "o2", "item_ids": ["i2"], "payment_method_id": "g"}))
    assert db.get("orders", "o1")["address"] == db.get("users", "u1")["address"] == ADDRESS and db.get("orders", "o2")["return_items"] == ["i2"]


@pytest.mark.parametrize(
    ("name", "args"),
    [
        ("cancel_pending_order", {"order_id": "o1", "reason": "bored"}),
        ("cancel_pending_order", {"order_id": "o2", "reason": "no longer needed"}),
        ("modify_pending_order_items", {"order_id": "o1", "item_ids": ["i1"], "new_item_ids": ["i1"], "payment_method_id": "g"}),
        ("modify_pending_order_items", {"order_id": "o1", "item_ids": ["i1"], "new_item_ids": ["i3"], "payment_method_id": "g"}),
        ("modify_pending_order_items", {"order_id": "o1", "item_ids": ["i1", "i1"], "new_item_ids": ["i2", "i2"], "payment_method_id": "g"}),
        ("exchange_delivered_order_items", {"order_id": "o2", "item_ids": ["i2"], "new_item_ids": [], "payment_method_id": "c"}),
        ("return_delivered_order_items", {"order_id": "o2", "item_ids": ["i2"], "payment_method_id": "none"}),
        ("modify_pending_order_payment", {"order_id": "o1", "payment_method_id": "g"}),
        ("modify_pending_order_address", {"order_id": "o2", **ADDRESS}),
        ("modify_user_address", {"user_id": "u1"}),
        ("no_such_tool", {}),
    ],
)
def test_shop_refusals_leave_no_trace(name, args):
    db, out = play("retail", SHOP, (name, args))
    assert out[0][1] and out[0][0].startswith("Error") and db.changes() == {}


def test_shop_reads():
    _, out = play("retail", SHOP, ("find_user_id_by_email", {"email": "ann@X.org"}), ("find_user_id_by_name_zip", {"first_name": "ann", "last_name": "LI", "zip": "10115"}), ("list_all_product_types", {}), ("calculate", {"expression": "(1 + 2) * 2.555"}), ("calculate", {"expression": "__import__"}))
    assert [x[0] for x in out[:4]] == ["u1", "u1", '{"Mug": "p"}', "7.67"] and out[4][1]
    assert DOMAINS["retail"].names("write") == ["cancel_pending_order", "exchange_delivered_order_items", "modify_pending_order_address", "modify_pending_order_items", "modify_pending_order_payment", "modify_user_address", "return_delivered_order_items"]


def test_arithmetic():
    assert [arithmetic(x) for x in ("1 + 2 * 3", "-(4 - 1) / 2", "2.5*2", "7 // 2", "2 ** 3")] == [7, -1.5, 5.0, 3, 8]
    for bad in ("1 +", "9**9**9**9", "f(1)"):
        with pytest.raises((ValueError, SyntaxError)):
            arithmetic(bad)


def day(seats: int, price: int, status: str = "available") -> dict:
    return {"status": status, "available_seats": {"economy": seats, "business": 1}, "prices": {"economy": price, "business": 3 * price}}


AIR = {
    "flights": {
        "F1": {"origin": "SFO", "destination": "JFK", "scheduled_departure_time_est": "20:00:00", "scheduled_arrival_time_est": "01:00:00+1", "dates": {"2024-05-20": day(3, 100), "2024-05-21": day(0, 100), "2024-05-22": day(5, 90, "cancelled")}},
        "F2": {"origin": "JFK", "destination": "BOS", "scheduled_departure_time_est": "06:00:00", "scheduled_arrival_time_est": "07:00:00", "dates": {"2024-05-20": day(9, 50), "2024-05-21": day(9, 60)}},
    },
    "users": {"u": {"user_id": "u", "reservations": [], "payment_methods": {"gc": {"id": "gc", "source": "gift_card", "amount": 300}, "ce": {"id": "ce", "source": "certificate", "amount": 100}, "cc": {"id": "cc", "source": "credit_card"}}}},
    "reservations": {},
}
PEOPLE = [{"first_name": "A", "last_name": "B", "dob": "1990-01-01"}, {"first_name": "C", "last_name": "D", "dob": "1991-01-01"}]
BOOK = {
    "user_id": "u", "origin": "SFO", "destination": "JFK", "flight_type": "one_way", "cabin": "economy", "flights": [{"flight_number": "F1", "date": "2024-05-20"}], "passengers": PEOPLE,
    "payment_methods": [{"payment_id": "gc", "amount": 210}, {"payment_id": "ce", "amount": 100}], "total_baggages": 3, "nonfree_baggages": 1, "insurance": "yes",
}


def test_airline_books_changes_and_cancels():
    db, out = play("airline", AIR, ("book_reservation", BOOK))
    assert not out[0][1], out
    made, user = db.get("reservations", "HATHAT"), db.get("users", "u")
    assert made["flights"][0]["price"] == 100 and user["payment_methods"]["gc"]["amount"] == 90 and "ce" not in user["payment_methods"] and user["reservations"] == ["HATHAT"]
    assert db.get("flights", "F1")["dates"]["2024-05-20"]["available_seats"]["economy"] == 1
    step = DOMAINS["airline"].step
    assert step(db, "update_reservation_baggages", {"reservation_id": "HATHAT", "total_baggages": 4, "nonfree_baggages": 2, "payment_id": "gc"})[1] is False
    assert user["payment_methods"]["gc"]["amount"] == 40
    assert step(db, "update_reservation_baggages", {"reservation_id": "HATHAT", "total_baggages": 5, "nonfree_baggages": 3, "payment_id": "gc"})[1] is True
    both = [{"flight_number": "F1", "date": "2024-05-20"}, {"flight_number": "F2", "date": "2024-05-21"}]
    assert step(db, "update_reservation_flights", {"reservation_id": "HATHAT", "cabin": "economy", "flights": both, "payment_id": "cc"})[1] is False
    assert db.get("reservations", "HATHAT")["payment_history"][-1] == {"payment_id": "cc", "amount": 120} and db.get("flights", "F2")["dates"]["2024-05-21"]["available_seats"]["economy"] == 9
    assert step(db, "update_reservation_passengers", {"reservation_id": "HATHAT", "passengers": PEOPLE[:1]})[1] is True
    assert step(db, "cancel_reservation", {"reservation_id": "HATHAT"})[1] is False
    made = db.get("reservations", "HATHAT")
    assert made["status"] == "cancelled" and sum(p["amount"] for p in made["payment_history"]) == 0
    assert step(db, "send_certificate", {"user_id": "u", "amount": 50})[0] == "Certificate certificate_3221322 added to user u with amount 50."


@pytest.mark.parametrize("change", [{"flights": [{"flight_number": "F1", "date": "2024-05-21"}]}, {"flights": [{"flight_number": "F1", "date": "2024-05-22"}]}, {"flights": [{"flight_number": "F9", "date": "2024-05-22"}]}, {"insurance": "no"}, {"payment_methods": [{"payment_id": "gc", "amount": 310}]}, {"payment_methods": [{"payment_id": "x", "amount": 310}]}, {"cabin": "business"}])
def test_airline_refusals(change):
    db, out = play("airline", AIR, ("book_reservation", BOOK | change))
    assert out[0][1] and db.changes() == {}


def test_airline_searches():
    _, out = play("airline", AIR, ("search_direct_flight", {"origin": "SFO", "destination": "JFK", "date": "2024-05-20"}), ("search_onestop_flight", {"origin": "SFO", "destination": "BOS", "date": "2024-05-20"}), ("get_flight_status", {"flight_number": "F1", "date": "2024-05-22"}), ("search_direct_flight", {"origin": "SFO", "destination": "JFK", "date": "2024-05-22"}))
    assert json.loads(out[0][0])[0]["flight_number"] == "F1" and out[2][0] == "cancelled" and out[3][0] == "[]"
    assert [[leg["flight_number"], leg["date"]] for leg in json.loads(out[1][0])[0]] == [["F1", "2024-05-20"], ["F2", "2024-05-21"]]


CARRIER = {
    "plans": {"P1": {"plan_id": "P1", "data_limit_gb": 5.0, "price_per_month": 40.0, "data_refueling_price_per_gb": 2.0}},
    "customers": {"C1": {"customer_id": "C1", "full_name": "John Smith", "date_of_birth": "1985-06-15", "phone_number": "555-1", "line_ids": ["L1", "L2"], "bill_ids": ["B1", "B2"], "payment_methods": []}},
    "lines": {
        "L1": {"line_id": "L1", "phone_number": "555-2", "status": "Active", "plan_id": "P1", "data_used_gb": 6.0, "data_refueling_gb": 0.0, "roaming_enabled": False, "suspension_start_date": None, "contract_end_date": None},
        "L2": {"line_id": "L2", "phone_number": "555-3", "status": "Pending Activation", "plan_id": "P1", "data_used_gb": 0.0, "data_refueling_gb": 0.0, "roaming_enabled": False, "suspension_start_date": None, "contract_end_date": None},
    },
    "bills": {"B1": {"bill_id": "B1", "status": "Issued", "total_due": 75.5, "issue_date": "2025-01-01"}, "B2": {"bill_id": "B2", "status": "Paid", "total_due": 10.0, "issue_date": "2025-02-01"}},
    "devices": {},
    "device": {"phone": T.PHONE},
    "surroundings": {"user": T.SURROUNDINGS},
}


def test_carrier_lookups():
    _, out = play("telecom", CARRIER, ("get_customer_by_phone", {"phone_number": "555-3"}), ("get_customer_by_name", {"full_name": "john SMITH", "dob": "1985-06-15"}), ("get_details_by_id", {"id": "P1"}), ("get_details_by_id", {"id": "X1"}), ("get_bills_for_customer", {"customer_id": "C1", "limit": 1}), ("get_customer_by_phone", {"phone_number": "0"}), ("get_data_usage", {"customer_id": "C1", "line_id": "L1"}))
    assert json.loads(out[0][0])["customer_id"] == "C1" and len(json.loads(out[1][0])) == 1 and json.loads(out[2][0])["plan_id"] == "P1" and out[3][1] and out[5][1]
    assert json.loads(out[4][0])[0]["bill_id"] == "B2" and json.loads(out[6][0])["cycle_end_date"] == "2025-02-28"


def test_carrier_writes():
    db, out = play(
        "telecom", CARRIER, ("suspend_line", {"customer_id": "C1", "line_id": "L1", "reason": "r"}), ("suspend_line", {"customer_id": "C1", "line_id": "L1", "reason": "r"}), ("resume_line", {"customer_id": "C1", "line_id": "L1"}),
        ("refuel_data", {"customer_id": "C1", "line_id": "L1", "gb_amount": 2.0}), ("refuel_data", {"customer_id": "C1", "line_id": "L1", "gb_amount": 1.5}), ("enable_roaming", {"customer_id": "C1", "line_id": "L1"}), ("enable_roaming", {"customer_id": "C1", "line_id": "L1"}),
        ("send_payment_request", {"customer_id": "C1", "bill_id": "B1"}), ("send_payment_request", {"customer_id": "C1", "bill_id": "B2"}), ("resume_line", {"customer_id": "C1", "line_id": "L9"}),
    )
    assert [failed for _, failed in out] == [False, True, False, False, False, False, False, False, True, True]
    line, draft = db.get("lines", "L1"), db.get("bills", db.get("customers", "C1")["bill_ids"][-1])
    assert line["status"] == "Active" and line["data_refueling_gb"] == 3.5 and line["roaming_enabled"]
    assert draft["status"] == "Draft" and draft["total_due"] == 7.0 and (draft["period_start"], draft["period_end"], draft["due_date"]) == ("2025-03-01", "2025-03-31", "2025-03-15") and len(draft["line_items"]) == 2
    checks = [("assert_line_status", {"customer_id": "C1", "line_id": "L1", "expected_status": "Active"}), ("assert_data_refueling_amount", {"customer_id": "C1", "line_id": "L1", "expected_amount": 3.5}), ("assert_no_overdue_bill", {"overdue_bill_id": "B7"})]
    assert all(DOMAINS["telecom"].step(db, *c) == ("true", False) for c in checks)


def test_phone_follows_the_carrier():
    db = Store(CARRIER)
    step = lambda _tool, **args: DOMAINS["telecom"].step(db, _tool, args)[0]
    step("set_user_info", name="J", phone_number="555-2")
    assert step("run_speed_test") == "Speed test failed: No Connection."  # 6 of 5 GB used
    step("refuel_data", customer_id="C1", line_id="L1", gb_amount=2.0)
    step("reboot_device")
    assert step("run_speed_test").startswith("Speed Test Result: 275.00 Mbps (Excellent).")
    step("set_network_mode_preference", mode="3g_only")
    step("toggle_data_saver_mode")
    assert step("run_speed_test").startswith("Speed Test Result: 0.30 Mbps (Very Poor).")
    step("send_payment_request", customer_id="C1", bill_id="B1")
    assert step("check_payment_request") == "You have a payment request for bill B1 of 75.5 USD."
    step("make_payment")
    assert db.get("bills", "B1")["status"] == "Paid" and step("check_payment_request") == "No payment request has been made."
    step("suspend_line", customer_id="C1", line_id="L1", reason="r")
    step("toggle_airplane_mode")
    assert step("check_status_bar") == "Status Bar: ✈️ Airplane Mode | 🔋 80%"
    step("toggle_airplane_mode")
    assert step("assert_service_status", expected_status="no_service") == "true"
    step("set_user_location", abroad=True)
    assert step("can_send_mms") == "Your messaging app cannot send MMS messages."


def test_phone_settings():
    db = Store({"device": {"phone": T.PHONE}, "surroundings": {"user": T.SURROUNDINGS}})
    step = lambda _tool, **args: DOMAINS["telecom"].step(db, _tool, args)[0]
    assert step("check_status_bar") == "Status Bar: 📶³ Good | 5G | 📱 Data Enabled | 🔋 80%"
    step("break_apn_settings")
    assert step("assert_mobile_data_status", expected_status=False) == "true"
    step("reset_apn_settings")
    assert "Resetting APN" in step("reboot_device") and step("assert_mobile_data_status", expected_status=True) == "true"
    step("unseat_sim_card")
    assert step("check_sim_status") == T.SIM["missing"] and step("assert_service_status", expected_status="no_service") == "true"
    step("reseat_sim_card")
    step("break_vpn")
    assert step("run_speed_test").startswith("Speed Test Result: 27.50 Mbps (Good).")
    step("disconnect_vpn")
    assert step("remove_app_permission", app_name="messaging", permission="SMS").startswith("[true") and step("assert_can_send_mms", expected_status=False) == "true"
    step("grant_app_permission", app_name="messaging", permission="sms")
    assert step("assert_can_send_mms", expected_status=True) == "true" and "network" in step("check_app_permissions", app_name="browser")
    step("turn_roaming_on")
    step("turn_data_off")
    assert step("assert_mobile_roaming_status", expected_status=True) == "true" and step("toggle_wifi").startswith("Wi-Fi is now ON.")


def test_folds_and_rewards(spark):
    act = lambda t, pos, name, **a: (t, pos, name, json.dumps(a))
    change = {"order_id": "o1", "item_ids": ["i1"], "new_item_ids": ["i2"], "payment_method_id": "g"}
    gold = [act(1, 0, "modify_pending_order_items", **change), act(2, 0, "return_delivered_order_items", order_id="o2", item_ids=["i2"], payment_method_id="c"), act(3, 0, "cancel_pending_order", order_id="o1", reason="no longer needed"), act(4, 0, "get_order_details", order_id="o1")]
    model = [act(1, 1, "modify_pending_order_items", **change), act(1, 0, "find_user_id_by_email", email="ann@X.org"), act(2, 0, "modify_pending_order_items", **(change | {"new_item_ids": ["i3"]})), act(3, 0, "cancel_pending_order", order_id="o1", reason="bored"), act(4, 0, "no_such_tool")]
    schema = "task_id int, pos int, name string, arguments string"
    g, m = (state.fold(spark.createDataFrame(x, schema), SHOP, DOMAINS["retail"]) for x in (gold, model))
    out = {r[0]: r[1] for r in state.end_state_reward(g, m).collect()}
    assert out == {1: True, 2: False, 3: False, 4: True}
    rows = {r["task_id"]: r for r in m.collect()}
    assert rows[1]["responses"][0] == "u1" and rows[1]["n_errors"] == 0
    assert [rows[i]["n_errors"] for i in (2, 3, 4)] == [1, 1, 1] and rows[2]["changes"] == "{}"
    frame = spark.createDataFrame([(["db"], True), (["db", "said"], True), ([], True), (["said"], False)], "b array<string>, w boolean")
    assert [r[0] for r in frame.select(state.combined_reward(F.col("b"), {"db": F.lit(1), "said": F.lit(0)}, F.col("w"))).collect()] == [1.0, 0.0, 1.0, 0.0]


def test_replays_tell_replies_and_sides_apart(spark):
    rows = [
        (1, 0, "find_user_id_by_email", '{"email": "ann@x.org"}', "assistant", "u1"), (1, 1, "calculate", '{"expression": "1+1"}', "assistant", "3.0"), (1, 2, "no_tool", "{}", "assistant", "Error: whatever"),
        (2, 0, "calculate", '{"expression": "1+1"}', "user", None), (2, 1, "calculate", "[1]", "assistant", None), (2, 2, "calculate", "{oops", "assistant", None),
    ]
    df = spark.createDataFrame(rows, "task_id int, pos int, name string, arguments string, side string, reply string")
    out = {r["task_id"]: r for r in state.fold(df, SHOP, DOMAINS["retail"], side="side", reply="reply").collect()}
    assert (out[1]["n_errors"], out[1]["n_differ"]) == (1, 1) and out[2]["n_errors"] == 3


def test_tasks_and_assertions(spark):
    base = {"users": {"u": {"user_id": "u", "tasks": []}}, "tasks": {}}
    rows = [(1, 0, "create_task", '{"user_id": "u", "title": "t"}'), (1, 1, "update_task_status", '{"task_id": "task_1", "status": "odd"}'), (1, 2, "assert_number_of_tasks", '{"user_id": "u", "expected_number": 1}'), (1, 3, "assert_task_status", '{"task_id": "task_1", "expected_status": "completed"}')]
    out = state.fold(spark.createDataFrame(rows, "task_id int, pos int, name string, arguments string"), base, DOMAINS["mock"]).first()
    assert out["n_errors"] == 1 and out["checks"] == [True, False] and json.loads(out["changes"])["users"]["u"]["tasks"] == ["task_1"]


def test_message_protocol(spark):
    turns = [(1, 0, "assistant", 2), (1, 1, "tool", 0), (1, 2, "tool", 0), (2, 0, "assistant", 1), (2, 1, "user", 0), (2, 2, "tool", 0), (3, 0, "user", 0)]
    out = {r[0]: r["ok"] for r in state.protocol_breaks(spark.createDataFrame(turns, "c int, t int, role string, n int"), "c", "t", "role", "n").collect()}
    assert out == {1: True, 2: False, 3: True}
    rows = [("a", 0), ("", 1), ("a", 1), (None, 0), (" ", 2)]
    got = spark.createDataFrame(rows, "t string, n int").select(state.one_kind_of_content(F.col("t"), F.col("n"))).collect()
    assert [r[0] for r in got] == [True, True, False, False, True]


@pytest.mark.parametrize("bounds", [(20_000, 64 << 20, 2_000), (3, 64 << 20, 10**9), (20_000, 200, 10**9), (20_000, 64 << 20, 2)])
def test_a_fold_remembers_outcomes_and_gives_those_of_a_play(spark, monkeypatch, bounds):
    """Within any bounds; and a call on a state that came before isn't played again."""
    import random

    for name, value in zip(("REMEMBERED", "REMEMBERED_BYTES", "TRIED"), bounds, strict=True):
        monkeypatch.setattr(state, name, value)
    r = random.Random(3)
    items = {"order_id": "o1", "item_ids": ["i1"], "new_item_ids": ["i2"], "payment_method_id": "g"}
    calls = [("modify_pending_order_items", items), ("cancel_pending_order", {"order_id": "o1", "reason": "no longer needed"}), ("cancel_pending_order", {"order_id": "o1", "reason": "odd"}), ("modify_pending_order_payment", {"order_id": "o1", "payment_method_id": "c"}), ("modify_pending_order_address", {"order_id": "o1", **ADDRESS}), ("get_order_details", {"order_id": "o1"})]
    tasks = {k: [r.choice(calls) for _ in range(r.randrange(1, 6))] for k in range(300)}
    played = spark.sparkContext.accumulator(0)
    retail = copy.copy(DOMAINS["retail"])

    def step(*args, **kwargs):
        played.add(1)
        return DOMAINS["retail"].step(*args, **kwargs)

    object.__setattr__(retail, "step", step)
    df = spark.createDataFrame([(k, i, n, json.dumps(a)) for k, c in tasks.items() for i, (n, a) in enumerate(c)], "task_id int, pos int, name string, arguments string")
    out = {x.task_id: x for x in state.fold(df, SHOP, retail).collect()}
    for k, steps in tasks.items():
        db, came = play("retail", SHOP, *steps)
        assert (out[k].n_errors, out[k].responses, out[k].state_hash) == (sum(f for _, f in came), [x for x, _ in came], db.digest())
    if bounds[0] == 20_000 and bounds[2] == 2_000 and bounds[1] > 200:
        assert played.value < len([c for s in tasks.values() for c in s]) / 2
