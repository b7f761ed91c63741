"""Queries that fold generated logs over the simulated businesses; their SQL plays the same rules by recursion or windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import state
from corpusmill.operators.domains import DOMAINS, airline, shop, telecom
from corpusmill.operators.domains.store import Tables
from corpusmill.plans.tables import table

_ADDRESS = {"address1": "1 A St", "address2": "", "city": "Bonn", "state": "NW", "country": "DE", "zip": "53111"}
#: Small databases that all tasks of a query start from.
SHOP: Tables = {
    "users": {"u": {"user_id": "u", "name": {"first_name": "Ann", "last_name": "Li"}, "email": "ann@x.org", "address": _ADDRESS, "payment_methods": {"g": {"source": "gift_card", "balance": 100.0}, "c": {"source": "credit_card"}}}},
    "products": {"p": {"product_id": "p", "name": "Mug", "variants": {"i1": {"price": 50.0, "available": True, "options": {}}, "i2": {"price": 60.0, "available": True, "options": {}}}}},
    "orders": {"o": {"order_id": "o", "user_id": "u", "status": "pending", "address": {}, "items": [{"item_id": "i1", "product_id": "p", "price": 50.0, "options": {}}], "payment_history": [{"transaction_type": "payment", "amount": 50.0, "payment_method_id": "c"}]}},
}
AIRLINE: Tables = {
    "flights": {"F1": {"origin": "SFO", "destination": "JFK", "scheduled_departure_time_est": "06:00:00", "scheduled_arrival_time_est": "09:00:00", "dates": {"2024-05-20": {"status": "available", "available_seats": {"economy": 9}, "prices": {"economy": 100}}}}},
    "users": {"u": {"user_id": "u", "reservations": ["R"], "payment_methods": {"g": {"source": "gift_card", "amount": 400}}}},
    "reservations": {"R": {"reservation_id": "R", "user_id": "u", "cabin": "economy", "flights": [], "passengers": [{}, {}], "payment_history": [], "total_baggages": 0, "nonfree_baggages": 0, "status": None}},
}
CARRIER: Tables = {
    "plans": {"P": {"plan_id": "P", "data_limit_gb": 5.0, "price_per_month": 40.0, "data_refueling_price_per_gb": 2.0}},
    "customers": {"C": {"customer_id": "C", "full_name": "Jo", "date_of_birth": "1985-06-15", "phone_number": "1", "line_ids": ["L"], "bill_ids": [], "payment_methods": []}},
    "lines": {"L": {"line_id": "L", "phone_number": "2", "status": "Active", "plan_id": "P", "data_used_gb": 1.0, "data_refueling_gb": 0.0, "roaming_enabled": False, "suspension_start_date": None}},
    "bills": {},
    "devices": {},
}
PHONE: Tables = {"device": {"phone": telecom.PHONE}, "surroundings": {"user": telecom.SURROUNDINGS}}
TASKS: Tables = {"users": {"u": {"user_id": "u", "tasks": []}}, "tasks": {}}


def _json(**parts: Column | str) -> Column:
    """The JSON of an object; a part that is a column stands in it as it is."""
    out = [F.lit("{")]
    for i, (k, v) in enumerate(parts.items()):
        out += [F.lit(f'{"," if i else ""}"{k}":'), v if isinstance(v, Column) else F.lit(f'"{v}"')]
    return F.concat(*out, F.lit("}"))


def _from(changes: Column, path: str, default: str) -> Column:
    """A field of a changed record; one that did not change has the base's value."""
    return F.coalesce(F.get_json_object(changes, path), F.lit(default))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("task_id"), F.col("event_id").alias("pos"), "event_type")


def carrier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events suspend, resume and refuel a line and switch its roaming."""
    t = F.col("event_type")
    own = {"customer_id": "C", "line_id": "L"}
    name = F.when(t == "view", "suspend_line").when(t == "click", "resume_line").when(t == "purchase", "refuel_data").when(t == "signup", "enable_roaming").otherwise("disable_roaming")
    args = F.when(t == "view", _json(**own, reason="r")).when(t == "purchase", _json(**own, gb_amount=(F.col("pos") % 3).cast("string"))).otherwise(_json(**own))
    out = state.fold(_events(spark, sf_dir).withColumns({"name": name, "arguments": args}), CARRIER, DOMAINS["telecom"])
    c = F.col("changes")
    return out.select(
        "task_id", "n_actions", "n_errors", _from(c, "$.lines.L.status", "Active").alias("status"), _from(c, "$.lines.L.data_refueling_gb", "0.0").cast("double").alias("refueled"),
        _from(c, "$.bills.BCD1.total_due", "0").cast("double").alias("due"), _from(c, "$.lines.L.roaming_enabled", "false").alias("roaming"),
    )


def phone_switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events turn a phone's switches; each log starts with a reboot and ends with a speed test."""
    t, e = F.col("event_type"), _events(spark, sf_dir)
    mode = F.get(F.array(*[F.lit(m) for m in (*telecom.MODES, "6g")]), (F.col("pos") % 5).cast("int"))
    name = F.when(t == "view", "toggle_airplane_mode").when(t == "click", "toggle_data").when(t == "purchase", "set_network_mode_preference").when(t == "signup", "toggle_data_saver_mode").otherwise("reboot_device")
    args = F.when(t == "purchase", _json(mode=F.concat(F.lit('"'), mode, F.lit('"')))).otherwise("{}")
    log = e.withColumns({"name": name, "arguments": args}).drop("event_type")
    ends = e.groupBy("task_id").agg(F.max("pos").alias("last"))
    for pos, tool in ((F.lit(-1).cast("long"), "reboot_device"), (F.col("last") + 1, "run_speed_test")):
        log = log.unionByName(ends.select("task_id", pos.alias("pos"), F.lit(tool).alias("name"), F.lit("{}").alias("arguments")))
    out = state.fold(log, PHONE, DOMAINS["telecom"])
    c = F.col("changes")
    return out.select("task_id", "n_errors", _from(c, "$.device.phone.airplane_mode", "false").alias("airplane"), _from(c, "$.device.phone.network_mode_preference", "4g_5g_preferred").alias("mode"), F.element_at("responses", -1).alias("speed"))


def airline_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events change bags and passengers of a reservation, send certificates and ask for a flight."""
    t, k = F.col("event_type"), F.col("pos")
    name = F.when(t == "view", "send_certificate").when(t == "click", "update_reservation_baggages").when(t == "purchase", "update_reservation_passengers").otherwise("get_flight_status")
    args = (
        F.when(t == "view", _json(user_id="u", amount=(k % 100).cast("string")))
        .when(t == "click", _json(reservation_id="R", total_baggages=(k % 5).cast("string"), nonfree_baggages=(k % 4).cast("string"), payment_id="g"))
        .when(t == "purchase", _json(reservation_id="R", passengers=F.concat(F.lit("["), F.array_join(F.array_repeat(F.lit("{}"), (k % 3 + 1).cast("int")), ","), F.lit("]"))))
        .otherwise(_json(flight_number=F.when(t == "signup", F.lit('"F1"')).otherwise(F.lit('"F2"')), date="2024-05-20"))
    )
    out = state.fold(_events(spark, sf_dir).withColumns({"name": name, "arguments": args}), AIRLINE, DOMAINS["airline"])
    c = F.col("changes")
    return out.select(
        "task_id", "n_errors", _from(c, "$.users.u.payment_methods.g.amount", "400").cast("long").alias("balance"), _from(c, "$.reservations.R.total_baggages", "0").cast("long").alias("bags"), _from(c, "$.reservations.R.nonfree_baggages", "0").cast("long").alias("paid_bags"),
        _from(c, "$.users.u.payment_methods.certificate_3221324.amount", "-1").cast("long").alias("third"),
    )


def _shop_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's line items as actions, by part; in order of line, part and supplier, which together are one action."""
    k = F.col("l_partkey") % 4
    name = F.when(k == 0, "modify_pending_order_payment").when(k == 1, "cancel_pending_order").when(k == 2, "modify_pending_order_items").otherwise("modify_pending_order_address")
    args = (
        F.when(k == 0, _json(order_id="o", payment_method_id="g"))
        .when(k == 1, _json(order_id="o", reason=F.when(F.col("l_suppkey") % 3 > 0, F.lit('"no longer needed"')).otherwise(F.lit('"bored"'))))
        .when(k == 2, _json(order_id="o", item_ids=F.lit('["i1"]'), new_item_ids=F.lit('["i2"]'), payment_method_id="g"))
        .otherwise(_json(order_id="o", **_ADDRESS))
    )
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("task_id"), (F.col("l_linenumber") * 10**15 + F.col("l_partkey") * 10**6 + F.col("l_suppkey")).alias("pos"), name.alias("name"), args.alias("arguments"))


def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = state.fold(_shop_log(spark, sf_dir), SHOP, DOMAINS["retail"])
    c = F.col("changes")
    return out.select("task_id", "n_errors", _from(c, "$.orders.o.status", "pending").alias("status"), _from(c, "$.users.u.payment_methods.g.balance", "100").cast("double").alias("balance"), _from(c, "$.orders.o.items[0].price", "50").cast("double").alias("price"))


def shop_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions of the first two lines are the wanted ones: does the whole log lead to the same state? Of logs of three
    actions and more the reward also asks that none failed; every seventh run was stopped early."""
    log = _shop_log(spark, sf_dir)
    gold, model = (state.fold(x, SHOP, DOMAINS["retail"]) for x in (log.where(f"pos < {3 * 10**15}"), log))
    got = state.end_state_reward(gold, model, keep=("n_actions", "n_errors"))
    basis = F.when(F.col("n_actions") > 2, F.array(F.lit("DB"), F.lit("ACTION"))).otherwise(F.array(F.lit("DB")))
    reward = state.combined_reward(basis, {"DB": F.col("db_match"), "ACTION": F.col("n_errors") == 0}, F.col("task_id") % 7 != 0)
    return got.select("task_id", "db_match", reward.alias("reward"))


def task_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations: a user's turn creates a task, an assistant's one closes the first, a last assertion counts them."""
    turns = table(spark, sf_dir, "conversations")
    name = F.when(F.col("role") == "user", "create_task").when(F.col("role") == "assistant", "update_task_status").otherwise("get_users")
    args = F.when(F.col("role") == "user", _json(user_id="u", title="t")).when(F.col("role") == "assistant", _json(task_id="task_1", status=F.when(F.col("turn") % 4 == 1, F.lit('"completed"')).otherwise(F.lit('"odd"')))).otherwise("{}")
    log = turns.select(F.col("conv_id").alias("task_id"), F.col("turn").alias("pos"), name.alias("name"), args.alias("arguments"))
    checks = log.groupBy("task_id").agg(F.max("pos").alias("last")).select("task_id", (F.col("last") + 1).alias("pos"), F.lit("assert_number_of_tasks").alias("name"), _json(user_id="u", expected_number=F.lit("2")).alias("arguments"))
    out = state.fold(log.unionByName(checks), TASKS, DOMAINS["mock"])
    return out.select("task_id", "n_errors", F.get_json_object("changes", "$.tasks.task_1.status").alias("status"), F.element_at("checks", 1).alias("holds"))


def message_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System turns stand for tool replies; an assistant calls as many tools as its text has characters, modulo three."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when((F.col("turn") % 3 == 2), "tool").otherwise(F.col("role")).alias("role"), F.when(F.col("role") == "assistant", F.length("text") % 3).otherwise(0).alias("n_calls"))
    return state.protocol_breaks(turns, "conv_id", "turn", "role", "n_calls").select("conv_id", F.col("n_calls").cast("long").alias("n_calls"), F.col("n_replies").cast("long").alias("n_replies"), "ok")


def domain_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by table of the small databases, and of the star schema as a shop: users, orders, products and their variants."""
    found = {f"{name}.{k}": v for name, counts in (("retail", shop.statistics(SHOP)), ("airline", airline.statistics(AIRLINE)), ("telecom", telecom.statistics(CARRIER))) for k, v in counts.items()}
    fixed = spark.createDataFrame(sorted(found.items()), "what string, n long")
    for what, name, of in (("orders", "orders", F.count("*")), ("users", "customer", F.count("*")), ("products", "part", F.countDistinct("p_type")), ("items", "part", F.count("*"))):
        fixed = fixed.unionByName(table(spark, sf_dir, name).agg(of.alias("n")).select(F.lit(f"tables.{what}").alias("what"), "n"))
    return fixed


QUERIES = {f.__name__: f for f in (carrier_lines, phone_switches, airline_changes, shop_orders, shop_rewards, task_lists, message_protocol, domain_statistics)}
_SHOP_PLAY = """
a as (select l_orderkey as k, l_linenumber as pos, l_partkey % 4 as kind, l_suppkey % 3 > 0 as fine, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as i from lineitem),
f as (
  select distinct k, 0::bigint as i, 'pending' as status, false as moved, 100.0::double as balance, 50.0::double as price, false as sent, 0::bigint as bad from a
  union all
  select k, i, case when ok and kind = 1 then 'cancelled' when ok and kind = 2 then 'pending (item modified)' else status end, moved or (ok and kind = 0),
    balance + case when not ok then 0 when kind = 0 then -50 when kind = 1 and moved then 50 when kind = 2 then -10 else 0 end, case when ok and kind = 2 then 60.0 else price end, sent or (ok and kind = 3), bad + case when ok then 0 else 1 end
  from (select f.k, a.i, kind, status, moved, balance, price, sent, bad,
    case kind when 0 then status <> 'cancelled' and not moved and price = 50 and balance >= 50 when 1 then status = 'pending' and fine when 2 then status = 'pending' and balance >= 10 else status <> 'cancelled' end as ok
    from f join a on a.k = f.k and a.i = f.i + 1)
),
n as (select k, count(*) as n, count(*) filter (pos <= 2) as two from a group by 1)
"""
ORACLES = {
    "carrier_lines": """
with e as (select user_id as k, event_id as i, event_type as t, event_id % 3 as gb, last_value(case when event_type in ('view', 'click') then event_type end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as before from events)
select k as task_id, count(*) as n_actions, count(*) filter ((t = 'view' and before = 'view') or (t = 'click' and coalesce(before, 'click') = 'click') or (t = 'purchase' and gb = 0)) as n_errors,
case when max_by(t, i) filter (t in ('view', 'click')) = 'view' then 'Suspended' else 'Active' end as status, coalesce(sum(gb) filter (t = 'purchase'), 0)::double as refueled, 2 * coalesce(sum(gb) filter (t = 'purchase'), 0)::double as due,
case when max_by(t, i) filter (t in ('signup', 'error')) = 'signup' then 'true' else 'false' end as roaming from e group by 1""",
    "phone_switches": """
with e as (select user_id as k, event_id as i, event_type as t, ['4g_5g_preferred', '4g_only', '3g_only', '2g_only', '6g'][event_id % 5 + 1] as m from events),
s as (select k, count(*) filter (t = 'view') % 2 = 1 as airplane, count(*) filter (t = 'click') % 2 = 0 as data, count(*) filter (t = 'signup') % 2 = 1 as saver, coalesce(max_by(m, i) filter (t = 'purchase' and m <> '6g'), '4g_5g_preferred') as mode from e group by 1),
v as (select *, round(case mode when '4g_5g_preferred' then 275 when '4g_only' then 44 when '3g_only' then 1.5 else 0.05::double end::double * case when saver then 0.2::double else 1 end, 2) as mbps from s),
g as (select *, case when mbps < 1 then 'Very Poor' when mbps < 5 then 'Poor' when mbps < 25 then 'Fair' when mbps < 100 then 'Good' else 'Excellent' end as grade from v)
select k as task_id, 0::bigint as n_errors, airplane::varchar as airplane, mode, case when airplane or not data then 'Speed test failed: No Connection.' else 'Speed Test Result: ' || printf('%.2f', mbps) || ' Mbps (' || grade || '). ' ||
case grade when 'Very Poor' then 'Connection is very slow. Basic web browsing might be difficult.' when 'Poor' then 'Connection is slow. Web browsing may be sluggish, streaming difficult.' when 'Fair' then 'Connection is okay for web browsing and some standard definition streaming.'
 when 'Good' then 'Connection is good for most activities, including HD streaming.' else 'Connection is very fast.' end end as speed from g""",
    "airline_changes": """
with recursive a as (select user_id as k, event_id as e, event_type as t, row_number() over (partition by user_id order by event_id) as i from events),
f as (
  select distinct k, 0::bigint as i, 400::bigint as balance, 0::bigint as bags, 0::bigint as paid, 0::bigint as sent, -1::bigint as third, 0::bigint as bad from a
  union all
  select k, i, balance - case when ok and t = 'click' then cost else 0 end, case when ok and t = 'click' then e % 5 else bags end, case when ok and t = 'click' then e % 4 else paid end, sent + case when ok and t = 'view' then 1 else 0 end,
    case when ok and t = 'view' and sent = 2 then e % 100 else third end, bad + case when ok then 0 else 1 end
  from (select f.k, a.i, a.e, a.t, balance, bags, paid, sent, third, bad, 50 * greatest(0, a.e % 4 - paid) as cost,
    case a.t when 'view' then sent < 3 when 'click' then balance >= 50 * greatest(0, a.e % 4 - paid) when 'purchase' then a.e % 3 = 1 when 'signup' then true else false end as ok from f join a on a.k = f.k and a.i = f.i + 1)
)
select k as task_id, arg_max(bad, i) as n_errors, arg_max(balance, i) as balance, arg_max(bags, i) as bags, arg_max(paid, i) as paid_bags, arg_max(third, i) as third from f group by 1""",
    "shop_orders": f"""
with recursive {_SHOP_PLAY}
select k as task_id, arg_max(bad, i) as n_errors, arg_max(status, i) as status, arg_max(balance, i) as balance, arg_max(price, i) as price from f group by 1""",
    "shop_rewards": f"""
with recursive {_SHOP_PLAY},
r as (select f.k, n.n, arg_max(bad, i) as bad, arg_max((status, moved, price, sent), i) = arg_max((status, moved, price, sent), i) filter (i <= two) as same from f join n using (k) where n.two > 0 group by all)
select k as task_id, same as db_match, case when k % 7 = 0 or not same or (n > 2 and bad > 0) then 0.0 else 1.0 end::double as reward from r""",
    "task_lists": """
with t as (select conv_id as k, turn, role, count(*) filter (role = 'user') over (partition by conv_id order by turn) as made from conversations)
select k as task_id, count(*) filter (role = 'assistant' and (made = 0 or turn % 4 <> 1)) as n_errors,
case when max(made) > 0 then case when count(*) filter (role = 'assistant' and made > 0 and turn % 4 = 1) > 0 then 'completed' else 'pending' end end as status, max(made) = 2 as holds from t group by 1""",
    "message_protocol": """
with t as (select conv_id, turn, case when turn % 3 = 2 then 'tool' else role end as r, case when role = 'assistant' and turn % 3 <> 2 then length(text) % 3 else 0 end as c from conversations),
b as (select *, sum(case when r = 'tool' then 0 else 1 end) over (partition by conv_id order by turn) as b from t),
g as (select conv_id, b, sum(c)::bigint as c, count(*) filter (r = 'tool') as n from b group by all)
select conv_id, sum(c)::bigint as n_calls, sum(n)::bigint as n_replies, bool_and(c = n) as ok from g group by 1""",
    "domain_statistics": """
select * from (values ('retail.num_products', 1::bigint), ('retail.num_users', 1), ('retail.num_orders', 1), ('retail.total_num_items', 2), ('airline.num_flights', 1), ('airline.num_flights_instances', 1), ('airline.num_users', 1), ('airline.num_reservations', 1),
('telecom.num_plans', 1), ('telecom.num_customers', 1), ('telecom.num_lines', 1), ('telecom.num_bills', 0), ('telecom.num_devices', 0), ('telecom.num_payment_methods', 0)) v(what, n)
union all select 'tables.orders', count(*) from orders union all select 'tables.users', count(*) from customer union all select 'tables.products', count(distinct p_type) from part union all select 'tables.items', count(*) from part""",
}
