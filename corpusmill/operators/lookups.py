"""Lookups over keyed tables: the same questions as the domains' reading tools, for any number of keys at once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def direct_flights(flights: DataFrame, origin: Column | None = None, destination: Column | None = None, date: Column | None = None, leave_after: Column | None = None) -> DataFrame:
    """Flights, a row for each date, that are available: `flights` has flight_number, origin, destination, departs, arrives and
    dates, a map of date to (status, seats, price). What is not given is not asked for."""
    each = flights.select("flight_number", "origin", "destination", "departs", "arrives", F.explode("dates").alias("date", "day")).where("day.status = 'available'")
    for asked, col in ((origin, "origin"), (destination, "destination"), (date, "date")):
        if asked is not None:
            each = each.where(F.col(col) == asked)
    if leave_after is not None:
        each = each.where(F.col("departs") >= leave_after)
    return each.select("flight_number", "origin", "destination", "departs", "arrives", "date", "day.seats", "day.price")


def customers_by_phone(numbers: DataFrame, customers: DataFrame, lines: DataFrame) -> DataFrame:
    """(phone, customer_id) by the contact number or that of any line, the least id where several have it; null where none."""
    own = customers.select(F.col("phone_number").alias("phone"), "customer_id")
    of_lines = customers.select("customer_id", F.explode("line_ids").alias("line_id")).join(lines.select("line_id", F.col("phone_number").alias("phone")), "line_id").select("phone", "customer_id")
    best = own.union(of_lines).groupBy("phone").agg(F.min("customer_id").alias("customer_id"))
    return numbers.select("phone").distinct().join(best, "phone", "left")


def by_prefix(ids: DataFrame, tables: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """(id, kind, record, error): each id is looked for in the table that its first letter names. `tables` gives kind, table and
    key for each letter; records come as JSON."""
    asked = ids.select("id").distinct().withColumn("__c", F.substring("id", 1, 1))
    all_rows = None
    for letter, (kind, df, key) in tables.items():
        one = df.select(F.lit(letter).alias("__c"), F.col(key).alias("id"), F.lit(kind).alias("kind"), F.to_json(F.struct(*df.columns)).alias("record"))
        all_rows = one if all_rows is None else all_rows.union(one)
    out = asked.join(all_rows, ["__c", "id"], "left")
    error = F.when(~F.col("__c").isin(*tables), "unknown kind of id").when(F.col("record").isNull(), "not found")
    return out.select("id", "kind", "record", error.alias("error"))


def bills_of_status(customers: DataFrame, bills: DataFrame, status: str) -> DataFrame:
    """(customer_id, bill_ids): each customer's bills of a status, in the order in which the customer has them."""
    each = customers.select("customer_id", F.posexplode("bill_ids").alias("at", "bill_id"))
    found = each.join(bills.where(F.col("status") == status).select("bill_id"), "bill_id").groupBy("customer_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bill_id"))), lambda x: x["bill_id"]).alias("bill_ids"))
    return customers.select("customer_id").join(found, "customer_id", "left").withColumn("bill_ids", F.coalesce("bill_ids", F.array().cast("array<string>")))


def calculated(expression: Column) -> Column:
    """The value of an arithmetic expression as text, to two digits; an error text for anything else."""
    from corpusmill.operators.domains.store import calculate  # here, not in the function: workers don't have the package

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text: str | None) -> str | None:
            try:
                return None if text is None else calculate(None, text)
            except Exception as e:  # noqa: BLE001
                return f"Error: {type(e).__name__}"

        for batch in batches:
            yield batch.map(one)

    return run(expression)


def speed_grade(technology: Column, signal: Column, slow_vpn: Column, data_saver: Column) -> Column:
    """(mbps, grade) of a phone's data connection, by the tables of the phone's domain."""
    from corpusmill.operators.domains.telecom import GRADES, SIGNALS, SPEEDS

    pick = lambda c, table, i=None: F.coalesce(F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, v if i is None else v[i])])[c], F.lit(0.0))
    factor = F.when(slow_vpn, 0.1).otherwise(1.0) * F.when(data_saver, 0.2).otherwise(1.0)
    mbps = F.round((pick(technology, SPEEDS, 0) + pick(technology, SPEEDS, 1)) / 2.0 * pick(signal, SIGNALS) * factor, 2)
    grade = F.lit(GRADES[-1][1])
    for bound, name in reversed(GRADES[:-1]):
        grade = F.when(mbps < bound, name).otherwise(grade)
    return F.struct(mbps.alias("mbps"), grade.alias("grade"))
