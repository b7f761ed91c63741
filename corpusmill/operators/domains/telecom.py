"""A mobile carrier and its customer's phone. The carrier's tools are the assistant's, the phone's the user's; after each step
the phone's surroundings follow the carrier's records."""

from __future__ import annotations

from datetime import date, timedelta

from corpusmill.operators.domains.store import Domain, Record, Store, check, common

DOMAIN = Domain("telecom")
common(DOMAIN)
tool = DOMAIN.tool

# The simulation's day, and what the data model calls its states.
TODAY = date(2025, 2, 25)
ACTIVE, SUSPENDED, PENDING = "Active", "Suspended", "Pending Activation"
PAID, OVERDUE, AWAITING, DRAFT = "Paid", "Overdue", "Awaiting Payment", "Draft"
TABLES = {"L": "lines", "D": "devices", "B": "bills", "C": "customers", "P": "plans"}


#: What the tools answer, carrier first, phone after.
SAYS = {
    "suspended": "Line suspended successfully. $5/month holding fee will apply.",
    "resumed": "Line resumed successfully",
    "requested": "Payment request sent to the customer for bill {}",
    "refueling": "Data refueling: {} GB at ${}/GB",
    "refueled": "Successfully added {} GB of data for line {} for ${:.2f}",
    "roaming_same": "Roaming was already {}",
    "roaming_set": "Roaming {} successfully",
    "usage_set": "Data usage set to {} GB for line {}",
    "line_charge": "Charge for line {}",
    "overdue": "Line {} suspended for unpaid bill {}. Contract ended: {}",
    "mode": "Network Mode Preference: {}",
    "mode_bad": "Failed to set network mode: '{}' is not a valid option. Please use one of: {}",
    "mode_set": "Preferred Network Mode set to: {}",
    "speed_none": "Speed test failed: {}.",
    "speed": "Speed Test Result: {:.2f} Mbps ({}). {}",
    "now": "{} is now {}.",
    "reseated": "SIM card re-seated successfully.",
    "saver_on": "Data Saver mode is ON (limits data usage).",
    "saver_off": "Data Saver mode is OFF.",
    "apn": "Current APN Name: {}\nMMSC URL (for picture messages): {}\n(These are technical settings, usually best left unchanged.)",
    "apn_set": "APN settings set to: {}",
    "apn_reset": "APN settings will reset at reboot.",
    "apn_resetting": "Resetting APN settings...",
    "restarting": "Restarting network services...",
    "wifi_off": "Wi-Fi is turned OFF.",
    "wifi_on": "Wi-Fi is ON and connected to '{}'. Signal strength: {}.",
    "wifi_alone": "Wi-Fi is ON but not connected to any network.",
    "wifi_barred": "Cannot change Wi-Fi settings while Airplane Mode is ON.",
    "calling": "Wi-Fi Calling is currently turned {}.",
    "mms_wifi": "\nMMS over Wi-Fi is now {}.",
    "vpn": "VPN is ON and connected. Details: {}",
    "vpn_bare": "VPN is ON and connected (no specific details available).",
    "vpn_idle": "VPN is turned ON in settings, but currently not connected.",
    "vpn_off": "VPN is turned OFF.",
    "vpn_already": "VPN already connected.",
    "vpn_made": "VPN connected successfully.",
    "vpn_none": "No active VPN connection to disconnect.",
    "vpn_ended": "VPN disconnected successfully.",
    "apps": "The following apps are installed on the phone: {}",
    "app_none": "App '{}' not found on this phone.",
    "app": "Status for App: {}",
    "app_denied": " - Permissions: None granted.",
    "app_granted": " - Permissions Granted:",
    "may_not": "App '{}' currently has no permissions granted.",
    "may": "App '{}' has permission for: {}.",
    "grant_no_app": "Error. App '{}' not found. Cannot grant permission.",
    "grant_unknown": "Error. Permission '{}' not tracked for app '{}', available permissions: {}",
    "granted": "Success. Permission '{}' granted to app '{}'.",
    "mms": "Your messaging app {} send MMS messages.",
    "asked": "You have a payment request for bill {} of {} USD.",
    "not_asked": "No payment request has been made.",
    "pay_none": "You do not have a payment request.",
    "paid": "Payment of {} USD has been made for bill {}.",
    "data_on": "Data connection restored.",
    "data_off": "Data connection broken.",
    "unseated": "SIM card un-seated successfully.",
    "locked": "SIM card locked successfully in {} mode.",
    "apn_broken": "APN settings broken. Please call reset_apn_settings() to fix.",
    "apn_mms_broken": "APN MMS setting broken. Please call reset_apn_settings() to fix.",
    "vpn_broken": "VPN connection broken.",
    "remove_no_app": "App '{}' not found. Cannot remove permission.",
    "remove_unknown": "Permission '{}' not tracked for app '{}'.",
    "removed": "Permission '{}' removed from app '{}'.",
}


def say(what: str, *values: object) -> str:
    return SAYS[what].format(*values)


def month_start(day: date, months: int = 0) -> date:
    n = day.year * 12 + day.month - 1 + months
    return date(n // 12, n % 12 + 1, 1)


def _line(db: Store, customer_id: str, line_id: str) -> Record:
    """A line, which must be the customer's."""
    check(line_id in db.need("customers", customer_id)["line_ids"], f"line {line_id} is not of {customer_id}")
    return db.need("lines", line_id)


def _bills(db: Store, customer: Record, status: str) -> list[Record]:
    return [b for b in (db.get("bills", k) for k in customer["bill_ids"]) if b and b["status"] == status]


@tool("read")
def get_customer_by_phone(db: Store, phone_number: str) -> Record:
    """By the contact number or that of any line."""
    lines = db.rows("lines")
    for key, c in db.rows("customers").items():
        if phone_number in (c["phone_number"], *(lines[k]["phone_number"] for k in c["line_ids"] if k in lines)):
            return db.need("customers", key)
    check(False, "customer not found")


@tool("read")
def get_customer_by_id(db: Store, customer_id: str) -> Record:
    return db.need("customers", customer_id)


@tool("read")
def get_customer_by_name(db: Store, full_name: str, dob: str) -> list[Record]:
    return [c for c in db.rows("customers").values() if c["full_name"].lower() == full_name.lower() and c["date_of_birth"] == dob]


@tool("read")
def get_details_by_id(db: Store, id: str) -> Record:
    """A record of any table: the id's first letter says of which."""
    check(id[:1] in TABLES, f"unknown kind of id: {id}")
    return db.need(TABLES[id[:1]], id)


@tool("read")
def get_bills_for_customer(db: Store, customer_id: str, limit: int = 12) -> list[Record]:
    bills = [db.need("bills", k) for k in db.need("customers", customer_id)["bill_ids"]]
    return sorted(bills, key=lambda b: b["issue_date"], reverse=True)[:limit]


@tool("read")
def get_data_usage(db: Store, customer_id: str, line_id: str) -> Record:
    line = _line(db, customer_id, line_id)
    plan = db.need("plans", line["plan_id"])
    ends = month_start(TODAY, 1) - timedelta(days=1)
    return {"line_id": line_id, "data_used_gb": line["data_used_gb"], "data_limit_gb": plan["data_limit_gb"], "data_refueling_gb": line["data_refueling_gb"], "cycle_end_date": ends.isoformat()}


@tool("write")
def suspend_line(db: Store, customer_id: str, line_id: str, reason: str) -> Record:
    line = _line(db, customer_id, line_id)
    check(line["status"] == ACTIVE, "line is not active")
    line.update(status=SUSPENDED, suspension_start_date=TODAY.isoformat())
    return {"message": say("suspended"), "line": line}


@tool("write")
def resume_line(db: Store, customer_id: str, line_id: str) -> Record:
    line = _line(db, customer_id, line_id)
    check(line["status"] in (SUSPENDED, PENDING), "line is not suspended")
    line.update(status=ACTIVE, suspension_start_date=None)
    return {"message": say("resumed"), "line": line}


@tool("write")
def send_payment_request(db: Store, customer_id: str, bill_id: str) -> str:
    """One bill of a customer awaits payment at a time."""
    customer = db.need("customers", customer_id)
    check(not _bills(db, customer, AWAITING), "another bill awaits payment")
    check(bill_id in customer["bill_ids"], f"bill {bill_id} is not of {customer_id}")
    db.need("bills", bill_id)["status"] = AWAITING
    return say("requested", bill_id)


def _charge(db: Store, customer: Record, amount: float, description: str) -> None:
    """Onto the customer's draft bill, which is made for the next month if there is none. Its id follows from the customer's,
    so that a task that runs again gives the same state."""
    draft = next(iter(_bills(db, customer, DRAFT)), None)
    if draft is None:
        start = month_start(TODAY, 1)
        key = f"B{customer['customer_id']}D{len(customer['bill_ids']) + 1}"
        customer["bill_ids"].append(key)
        draft = db.add("bills", key, _bill(key, customer["customer_id"], start, month_start(start, 1) - timedelta(days=1), DRAFT))
    draft["line_items"].append(_item(description, amount))
    draft["total_due"] += amount


def _bill(key: str, customer_id: str, start: date, end: date, status: str) -> Record:
    return {
        "bill_id": key, "customer_id": customer_id, "period_start": start.isoformat(), "period_end": end.isoformat(), "issue_date": start.isoformat(), "total_due": 0, "due_date": (start + timedelta(days=14)).isoformat(),
        "line_items": [], "status": status,
    }


def _item(description: str, amount: float) -> Record:
    return {"description": description, "amount": amount, "date": TODAY.isoformat(), "item_type": "Credit" if amount < 0 else "Charge"}


@tool("write")
def refuel_data(db: Store, customer_id: str, line_id: str, gb_amount: float) -> Record:
    line = _line(db, customer_id, line_id)
    check(gb_amount > 0, "amount must be positive")
    price = db.need("plans", line["plan_id"])["data_refueling_price_per_gb"]
    charge = gb_amount * price
    line["data_refueling_gb"] += gb_amount
    _charge(db, db.need("customers", customer_id), charge, say("refueling", gb_amount, price))
    return {"message": say("refueled", gb_amount, line_id, charge), "new_data_refueling_gb": line["data_refueling_gb"], "charge": charge}


def _roam(db: Store, customer_id: str, line_id: str, on: bool) -> str:
    line, word = _line(db, customer_id, line_id), "enabled" if on else "disabled"
    if line["roaming_enabled"] == on:
        return say("roaming_same", word)
    line["roaming_enabled"] = on
    return say("roaming_set", word)


@tool("write")
def enable_roaming(db: Store, customer_id: str, line_id: str) -> str:
    return _roam(db, customer_id, line_id, True)


@tool("write")
def disable_roaming(db: Store, customer_id: str, line_id: str) -> str:
    return _roam(db, customer_id, line_id, False)


@tool("setup")
def set_data_usage(db: Store, customer_id: str, line_id: str, data_used_gb: float) -> str:
    _line(db, customer_id, line_id)["data_used_gb"] = data_used_gb
    return say("usage_set", data_used_gb, line_id)


@tool("setup")
def suspend_line_for_overdue_bill(db: Store, customer_id: str, line_id: str, new_bill_id: str, contract_ended: bool) -> str:
    """A scenario's start: last month's bill is overdue and the line suspended."""
    line, customer = db.need("lines", line_id), db.need("customers", customer_id)
    check(line["status"] == ACTIVE, "line is not active")
    amount = db.need("plans", line["plan_id"])["price_per_month"]
    check(amount > 0, "amount must be positive")
    check(not _bills(db, customer, OVERDUE), "customer has an overdue bill")
    start, end = month_start(TODAY, -1), month_start(TODAY) - timedelta(days=1)
    bill = db.add("bills", new_bill_id, _bill(new_bill_id, customer_id, start, end, OVERDUE))
    bill["line_items"].append(_item(say("line_charge", line_id), amount))
    bill["total_due"] += amount
    customer["bill_ids"].append(new_bill_id)
    line.update(status=SUSPENDED, suspension_start_date=TODAY.isoformat())
    if contract_ended:
        line["contract_end_date"] = end.isoformat()
    return say("overdue", line_id, new_bill_id, contract_ended)


@tool("assert")
def assert_data_refueling_amount(db: Store, customer_id: str, line_id: str, expected_amount: float) -> bool:
    return abs(_line(db, customer_id, line_id)["data_refueling_gb"] - expected_amount) < 1e-6


@tool("assert")
def assert_line_status(db: Store, customer_id: str, line_id: str, expected_status: str) -> bool:
    return _line(db, customer_id, line_id)["status"] == expected_status


@tool("assert")
def assert_overdue_bill_exists(db: Store, customer_id: str, overdue_bill_id: str) -> bool:
    check(overdue_bill_id in db.need("customers", customer_id)["bill_ids"], "bill is not the customer's")
    check(db.need("bills", overdue_bill_id)["status"] == OVERDUE, "bill is not overdue")
    return True


@tool("assert")
def assert_no_overdue_bill(db: Store, overdue_bill_id: str) -> bool:
    bill = db.get("bills", overdue_bill_id)
    return bill is None or bill["status"] == PAID


# The phone. Table `device` has one record, `phone`; table `surroundings` one, `user`.

CONNECTED, SEARCHING, NO_SERVICE = "connected", "searching", "no_service"
#: Technologies by preference, the first with a signal wins, the last one else; bars, speeds in Mbps, factors of
#: signals, and the bounds of what a speed is called.
MODES = {"4g_5g_preferred": ("5G", "4G"), "4g_only": ("4G",), "3g_only": ("3G",), "2g_only": ("2G",)}
BARS = {"none": "📵 No Signal", "poor": "📶¹ Poor", "fair": "📶² Fair", "good": "📶³ Good", "excellent": "📶⁴ Excellent"}
SPEEDS = {"2G": (0.1, 0.4), "3G": (1.0, 5.0), "4G": (10.0, 100.0), "5G": (50.0, 500.0)}
SIGNALS = {"poor": 0.2, "fair": 0.5, "good": 0.8, "excellent": 1.0}
GRADES = ((1, "Very Poor"), (5, "Poor"), (25, "Fair"), (100, "Good"), (float("inf"), "Excellent"))
ADVICE = {
    "Very Poor": "Connection is very slow. Basic web browsing might be difficult.",
    "Poor": "Connection is slow. Web browsing may be sluggish, streaming difficult.",
    "Fair": "Connection is okay for web browsing and some standard definition streaming.",
    "Good": "Connection is good for most activities, including HD streaming.",
    "Excellent": "Connection is very fast.",
}
SIM = {"active": "Your SIM card is active and working.", "missing": "No SIM card detected in the phone.", "locked_pin": "The SIM card is locked with a PIN code.", "locked_puk": "The SIM card is locked with a PUK code."}
APN = {"apn_name": "internet", "reset_at_reboot": False, "mms_apn": "mms", "mmsc_url": "http://mms.carrier.com/mms/wapenc", "mms_proxy": None, "mms_port": None}
VPN = {"server_address": "192.168.1.1", "protocol": "OpenVPN", "server_performance": "excellent"}
PHONE = {
    "sim_card_status": "active", "sim_card_missing": False, "airplane_mode": False, "network_signal_strength": "good", "network_technology_connected": "5G", "network_connection_status": CONNECTED, "battery_level": 80,
    "data_enabled": True, "roaming_enabled": False, "network_mode_preference": "4g_5g_preferred", "active_apn_settings": APN, "wifi_enabled": False, "wifi_connected": False, "wifi_ssid": None, "wifi_signal_strength": "none",
    "wifi_calling_enabled": False, "wifi_calling_mms_over_wifi": False, "data_saver_mode": False, "vpn_enabled_setting": False, "vpn_connected": False, "vpn_details": None,
    "app_statuses": {
        "messaging": {"app_name": "messaging", "permissions": {"sms": True, "storage": True, "phone": True, "network": False}},
        "browser": {"app_name": "browser", "permissions": {"sms": False, "storage": True, "phone": False, "network": True}},
    },
}
SURROUNDINGS = {
    "name": None, "phone_number": None, "is_abroad": False, "roaming_allowed": False, "signal_strength": {"2G": "poor", "3G": "fair", "4G": "good", "5G": "excellent"},
    "mobile_data_usage_exceeded": False, "line_active": True, "payment_request": None,
}


def _phone(db: Store) -> Record:
    return db.need("device", "phone")


def _around(db: Store) -> Record:
    return db.need("surroundings", "user")


def _search(db: Store) -> None:
    """What the phone connects to: nothing with airplane mode, broken APN, a dead line or no usable SIM."""
    phone, around = _phone(db), _around(db)
    dead = phone["sim_card_missing"] or phone["sim_card_status"] != "active" or phone["airplane_mode"] or phone["active_apn_settings"]["apn_name"] == "broken" or not around["line_active"]
    signal = around["signal_strength"]
    choices = MODES.get(phone["network_mode_preference"], ("4G",))
    kind = next((t for t in choices if signal.get(t, "none") != "none"), choices[-1])
    phone.update(
        network_connection_status=NO_SERVICE if dead else CONNECTED,
        network_technology_connected="none" if dead else kind,
        network_signal_strength="none" if dead else signal.get(kind, "none"),
    )


def status_bar(db: Store) -> str:
    phone = _phone(db)
    kind, out = phone["network_technology_connected"], []
    if phone["airplane_mode"]:
        out.append("✈️ Airplane Mode")
    else:
        out.append(BARS.get(phone["network_signal_strength"], BARS["none"]))
        if kind != "none":
            out.append(kind)
        if phone["data_enabled"] and kind != "none":
            out += ["📱 Data Enabled"] + ["🔽 Data Saver"] * phone["data_saver_mode"]
        else:
            out.append("📵 Data Disabled")
    if phone["wifi_enabled"] and phone["wifi_connected"]:
        out.append(f"📡 Connected to {phone['wifi_ssid']}" if phone["wifi_ssid"] else "📡 Enabled")
    return " | ".join(out + ["🔒 VPN Connected"] * phone["vpn_connected"] + [f"🔋 {phone['battery_level']}%"])


def _with_bar(db: Store, text: str) -> str:
    return f"{text}\nStatus Bar: {status_bar(db)}"


def _on(flag: bool) -> str:
    return "ON" if flag else "OFF"


def _yes(flag: bool) -> str:
    return "Yes" if flag else "No"


def _flip(db: Store, name: str, label: str, search: bool) -> str:
    """A switch of the phone turned; some make it look for a network."""
    phone = _phone(db)
    phone[name] = not phone[name]
    if search:
        _search(db)
    return _with_bar(db, say("now", label, _on(phone[name])))


def _sim(phone: Record) -> str:
    return "missing" if phone["sim_card_missing"] else phone["sim_card_status"]


def _no_wifi(phone: Record) -> None:
    phone.update(wifi_connected=False, wifi_ssid=None, wifi_signal_strength="none")


def data_works(db: Store) -> bool:
    phone, around = _phone(db), _around(db)
    connected = not phone["airplane_mode"] and phone["network_signal_strength"] != "none" and phone["network_connection_status"] != NO_SERVICE
    roams = not around["is_abroad"] or (phone["roaming_enabled"] and around["roaming_allowed"])
    return connected and roams and phone["data_enabled"] and not around["mobile_data_usage_exceeded"]


def speed(db: Store) -> tuple[float | None, str]:
    """Mbps, to two digits, and what that is called: the middle of the technology's range by signal, VPN and data saver."""
    if not data_works(db):
        return None, "No Connection"
    phone = _phone(db)
    slow = phone["vpn_connected"] and phone["vpn_details"] and phone["vpn_details"]["server_performance"] == "poor"
    factor = (0.1 if slow else 1.0) * (0.2 if phone["data_saver_mode"] else 1.0)
    lo, hi = SPEEDS.get(phone["network_technology_connected"], (0.0, 0.0))
    mbps = round((lo + hi) / 2.0 * SIGNALS.get(phone["network_signal_strength"], 0.0) * factor, 2)
    return mbps, next(name for bound, name in GRADES if mbps < bound)


def mms_works(db: Store) -> bool:
    phone = _phone(db)
    app = phone["app_statuses"].get("messaging")
    over_wifi = phone["wifi_calling_enabled"] and phone["wifi_calling_mms_over_wifi"]
    sends = data_works(db) and phone["network_technology_connected"] != "2G" and not over_wifi and phone["active_apn_settings"]["mmsc_url"] is not None
    return bool(sends and app and app["permissions"]["storage"] and app["permissions"]["sms"])


@tool("read", "user")
def check_status_bar(db: Store) -> str:
    return f"Status Bar: {status_bar(db)}"


@tool("read", "user")
def check_network_status(db: Store) -> str:
    p = _phone(db)
    lines = {
        "Airplane Mode": _on(p["airplane_mode"]), "SIM Card Status": _sim(p), "Cellular Connection": p["network_connection_status"], "Cellular Signal": p["network_signal_strength"],
        "Cellular Network Type": p["network_technology_connected"], "Mobile Data Enabled": _yes(p["data_enabled"]), "Data Roaming Enabled": _yes(p["roaming_enabled"]), "Wi-Fi Radio": _on(p["wifi_enabled"]),
        "Wi-Fi Connected": _yes(p["wifi_connected"]),
    }
    if p["wifi_connected"]:
        lines["Connected Wi-Fi Network"] = p["wifi_ssid"]
    return "\n".join(f"{k}: {v}" for k, v in lines.items())


@tool("read", "user")
def check_network_mode_preference(db: Store) -> str:
    return say("mode", _phone(db)["network_mode_preference"])


@tool("write", "user")
def set_network_mode_preference(db: Store, mode: str) -> str:
    if mode not in MODES:
        return say("mode_bad", mode, ", ".join(MODES))
    _phone(db)["network_mode_preference"] = mode
    _search(db)
    return _with_bar(db, say("mode_set", mode))


@tool("read", "user")
def run_speed_test(db: Store) -> str:
    mbps, name = speed(db)
    return say("speed_none", name) if mbps is None else say("speed", mbps, name, ADVICE[name])


def _airplane(db: Store) -> bool:
    """Turned either way, Wi-Fi is cut; turned on, the VPN as well."""
    phone = _phone(db)
    turned_off = phone["airplane_mode"]
    phone["airplane_mode"] = not turned_off
    if turned_off:
        phone["network_connection_status"] = SEARCHING
    if not turned_off or phone["wifi_enabled"]:
        _no_wifi(phone)
    if not turned_off:
        phone.update(vpn_connected=False, vpn_details=None if phone["vpn_connected"] else phone["vpn_details"])
    _search(db)
    return phone["airplane_mode"]


@tool("write", "user")
def toggle_airplane_mode(db: Store) -> str:
    return _with_bar(db, say("now", "Airplane Mode", _on(_airplane(db))))


@tool("read", "user")
def check_sim_status(db: Store) -> str:
    return SIM[_sim(_phone(db))]


@tool("write", "user")
def reseat_sim_card(db: Store) -> str:
    _phone(db)["sim_card_missing"] = False
    _search(db)
    return _with_bar(db, say("reseated"))


@tool("write", "user")
def toggle_data(db: Store) -> str:
    return _flip(db, "data_enabled", "Mobile Data", True)


@tool("write", "user")
def toggle_roaming(db: Store) -> str:
    return _flip(db, "roaming_enabled", "Data Roaming", True)


@tool("write", "user")
def toggle_data_saver_mode(db: Store) -> str:
    return _flip(db, "data_saver_mode", "Data Saver Mode", False)


@tool("write", "user")
def toggle_wifi_calling(db: Store) -> str:
    return _flip(db, "wifi_calling_enabled", "Wi-Fi Calling", False)


@tool("read", "user")
def check_data_restriction_status(db: Store) -> str:
    return say("saver_on" if _phone(db)["data_saver_mode"] else "saver_off")


@tool("read", "user")
def check_apn_settings(db: Store) -> str:
    apn = _phone(db)["active_apn_settings"]
    return say("apn", apn["apn_name"] or "Not Set", apn["mmsc_url"] or "Not Set")


@tool("write", "user")
def set_apn_settings(db: Store, apn_settings: Record) -> str:
    check(set(apn_settings) <= set(APN), "unknown APN setting")
    _phone(db)["active_apn_settings"] = {**APN, **apn_settings}
    _search(db)
    return _with_bar(db, say("apn_set", _phone(db)["active_apn_settings"]["apn_name"]))


@tool("write", "user")
def reset_apn_settings(db: Store) -> str:
    _phone(db)["active_apn_settings"]["reset_at_reboot"] = True
    _search(db)
    return _with_bar(db, say("apn_reset"))


@tool("read", "user")
def check_wifi_status(db: Store) -> str:
    p = _phone(db)
    if not p["wifi_enabled"]:
        return say("wifi_off")
    return say("wifi_on", p["wifi_ssid"], p["wifi_signal_strength"]) if p["wifi_connected"] else say("wifi_alone")


@tool("write", "user")
def toggle_wifi(db: Store) -> str:
    phone = _phone(db)
    if phone["airplane_mode"]:
        return _with_bar(db, say("wifi_barred"))
    phone["wifi_enabled"] = not phone["wifi_enabled"]
    if not phone["wifi_enabled"]:
        _no_wifi(phone)
    return _with_bar(db, say("now", "Wi-Fi", _on(phone["wifi_enabled"])))


@tool("read", "user")
def check_wifi_calling_status(db: Store) -> str:
    return say("calling", _on(_phone(db)["wifi_calling_enabled"]))


@tool("read", "user")
def check_vpn_status(db: Store) -> str:
    p = _phone(db)
    if p["vpn_connected"]:
        return say("vpn", p["vpn_details"]) if p["vpn_details"] else say("vpn_bare")
    return say("vpn_idle" if p["vpn_enabled_setting"] else "vpn_off")


@tool("write", "user")
def connect_vpn(db: Store) -> str:
    if _phone(db)["vpn_connected"]:
        return say("vpn_already")
    _phone(db).update(vpn_connected=True, vpn_details=dict(VPN))
    return _with_bar(db, say("vpn_made"))


@tool("write", "user")
def disconnect_vpn(db: Store) -> str:
    if not _phone(db)["vpn_connected"]:
        return _with_bar(db, say("vpn_none"))
    _phone(db).update(vpn_connected=False, vpn_details=None)
    return _with_bar(db, say("vpn_ended"))


@tool("read", "user")
def check_installed_apps(db: Store) -> str:
    return say("apps", ", ".join(_phone(db)["app_statuses"]))


def _granted(app: Record) -> list[str]:
    return [name.replace("_", " ").lower() for name, allowed in app["permissions"].items() if allowed]


@tool("read", "user")
def check_app_status(db: Store, app_name: str) -> str:
    app = _phone(db)["app_statuses"].get(app_name)
    if app is None:
        return say("app_none", app_name)
    granted = _granted(app)
    lines = [say("app_granted"), *(f"   - {p}" for p in granted)] if granted else [say("app_denied")]
    return "\n".join([say("app", app_name), *lines])


@tool("read", "user")
def check_app_permissions(db: Store, app_name: str) -> str:
    app = _phone(db)["app_statuses"].get(app_name)
    if app is None:
        return say("app_none", app_name)
    granted = _granted(app)
    return say("may", app_name, ", ".join(granted)) if granted else say("may_not", app_name)


@tool("write", "user")
def grant_app_permission(db: Store, app_name: str, permission: str) -> str:
    app, permission = _phone(db)["app_statuses"].get(app_name), permission.lower()
    if app is None:
        return _with_bar(db, say("grant_no_app", app_name))
    if permission not in app["permissions"]:
        return _with_bar(db, say("grant_unknown", permission, app_name, list(app["permissions"])))
    app["permissions"][permission] = True
    return _with_bar(db, say("granted", permission, app_name))


@tool("read", "user")
def can_send_mms(db: Store) -> str:
    return say("mms", "can" if mms_works(db) else "cannot")


@tool("write", "user")
def reboot_device(db: Store) -> str:
    phone, lines = _phone(db), [say("restarting")]
    if phone["active_apn_settings"]["reset_at_reboot"]:
        lines.insert(0, say("apn_resetting"))
        phone["active_apn_settings"] = dict(APN)
    phone["network_connection_status"] = SEARCHING
    _search(db)
    return _with_bar(db, "\n".join(lines))


@tool("read", "user")
def check_payment_request(db: Store) -> str:
    asked = _around(db)["payment_request"]
    return say("asked", asked["bill_id"], asked["amount_due"]) if asked else say("not_asked")


@tool("write", "user")
def make_payment(db: Store) -> str:
    asked = _around(db)["payment_request"]
    if not asked:
        return say("pay_none")
    asked["paid"] = True
    return say("paid", asked["amount_due"], asked["bill_id"])


# What scenarios do to the phone before a conversation starts.


@tool("setup", "user")
def set_user_info(db: Store, name: str, phone_number: str) -> None:
    _around(db).update(name=name, phone_number=phone_number)


@tool("setup", "user")
def set_user_location(db: Store, abroad: bool) -> None:
    _around(db)["is_abroad"] = abroad


def _turn(db: Store, name: str, on: bool, label: str) -> str:
    """Airplane mode, data, roaming or data saver set: turned twice if it was so already, which searches again."""
    for _ in range(1 if _phone(db)[name] != on else 2):
        _airplane(db) if name == "airplane_mode" else _flip(db, name, label, name != "data_saver_mode")
    return say("now", label, _on(on))


def _switch(name: str, key: str, on: bool, label: str) -> None:
    def run(db: Store) -> str:
        return _turn(db, key, on, label)

    run.__name__ = name
    tool("setup", "user")(run)


for _name, _key, _label in (("airplane_mode", "airplane_mode", "Airplane Mode"), ("roaming", "roaming_enabled", "Data Roaming"), ("data_saver_mode", "data_saver_mode", "Data Saver Mode")):
    for _state in (True, False):
        _switch(f"turn_{_name}_{_on(_state).lower()}", _key, _state, _label)


@tool("setup", "user")
def turn_data_on(db: Store) -> str:
    _phone(db)["data_enabled"] = True
    return say("data_on")


@tool("setup", "user")
def turn_data_off(db: Store) -> str:
    _turn(db, "data_enabled", False, "Mobile Data")
    return say("data_off")


@tool("setup", "user")
def unseat_sim_card(db: Store) -> str:
    _phone(db)["sim_card_missing"] = True
    _search(db)
    return say("unseated")


@tool("setup", "user")
def lock_sim_card(db: Store, mode: str) -> str:
    if mode in ("pin", "puk"):
        _phone(db)["sim_card_status"] = f"locked_{mode}"
    _search(db)
    return say("locked", mode)


@tool("setup", "user")
def break_apn_settings(db: Store) -> str:
    _phone(db)["active_apn_settings"]["apn_name"] = "broken"
    _search(db)
    return say("apn_broken")


@tool("setup", "user")
def break_apn_mms_setting(db: Store) -> str:
    _phone(db)["active_apn_settings"]["mmsc_url"] = None
    return say("apn_mms_broken")


@tool("setup", "user")
def break_vpn(db: Store) -> str:
    connect_vpn(db)
    if _phone(db)["vpn_details"]:
        _phone(db)["vpn_details"]["server_performance"] = "poor"
    return say("vpn_broken")


@tool("setup", "user")
def set_wifi_calling(db: Store, enabled: bool, mms_over_wifi: bool | None = None) -> str:
    _phone(db)["wifi_calling_enabled"] = enabled
    if mms_over_wifi is not None:
        _phone(db)["wifi_calling_mms_over_wifi"] = mms_over_wifi
    return say("now", "Wi-Fi Calling", _on(enabled)) + ("" if mms_over_wifi is None else say("mms_wifi", _on(mms_over_wifi)))


@tool("setup", "user")
def remove_app_permission(db: Store, app_name: str, permission: str) -> list:
    app, permission = _phone(db)["app_statuses"].get(app_name), permission.lower()
    if app is None:
        return [False, say("remove_no_app", app_name)]
    if permission not in app["permissions"]:
        return [False, say("remove_unknown", permission, app_name)]
    app["permissions"][permission] = False
    return [True, say("removed", permission, app_name)]


def _field_assert(name: str, read) -> None:
    def run(db: Store, expected_status) -> bool:
        return read(db) == expected_status

    run.__name__ = name
    tool("assert", "user")(run)


_field_assert("assert_airplane_mode_status", lambda db: _phone(db)["airplane_mode"])
_field_assert("assert_service_status", lambda db: _phone(db)["network_connection_status"])
_field_assert("assert_mobile_data_status", data_works)
_field_assert("assert_mobile_roaming_status", lambda db: _phone(db)["roaming_enabled"])
_field_assert("assert_mobile_data_saver_mode_status", lambda db: _phone(db)["data_saver_mode"])
_field_assert("assert_can_send_mms", mms_works)
_field_assert("assert_mobile_data_usage_exceeded", lambda db: _around(db)["mobile_data_usage_exceeded"])


@tool("assert", "user")
def assert_internet_speed(db: Store, expected_speed: float, expected_desc: str | None = None) -> bool:
    mbps, name = speed(db)
    return (mbps or 0.0) >= expected_speed and (expected_desc is None or expected_desc.lower() == name.lower())


@tool("assert", "user")
def assert_internet_not_excellent(db: Store) -> bool:
    return speed(db)[1] != "Excellent"


def sync(db: Store) -> None:
    """The surroundings by the carrier's records: whether the line is active, may roam, has data left; a payment that was made
    settles its bill, and a bill that awaits payment shows as a request."""
    around = db.get("surroundings", "user")
    if not around or around["phone_number"] is None:
        return
    number = around["phone_number"]
    line = next((db.need("lines", k) for k, x in db.rows("lines").items() if x["phone_number"] == number), None)
    check(line, f"no line of {number}")
    limit = db.need("plans", line["plan_id"])["data_limit_gb"] + line["data_refueling_gb"]
    around.update(line_active=line["status"] == ACTIVE, roaming_allowed=bool(line["roaming_enabled"]), mobile_data_usage_exceeded=line["data_used_gb"] >= limit)
    asked = around["payment_request"]
    if asked and asked["paid"]:
        db.need("bills", asked["bill_id"])["status"] = PAID
        asked = around["payment_request"] = None
    if asked is None:
        waiting = _bills(db, get_customer_by_phone(db, number), AWAITING)
        if waiting:
            around["payment_request"] = {"bill_id": waiting[0]["bill_id"], "amount_due": waiting[0]["total_due"], "paid": False}


DOMAIN.sync = sync


def statistics(tables: dict) -> dict[str, int]:
    counts = {f"num_{t}": len(tables[t]) for t in ("plans", "customers", "lines", "bills", "devices")}
    return counts | {"num_payment_methods": sum(len(c["payment_methods"]) for c in tables["customers"].values())}
