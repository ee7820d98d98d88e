"""Registered queries for ordered analytics over a batch: position of each change
within its customer, running totals and as-of joins, by the skew-safe operators
``running_totals`` and ``asof_join`` (range-split keys, carried across partitions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.asof import asof_join
from ..operators.ordered import running_totals
from .batch_sql import _ORACLE_VIEWS, _orders_batch
from .common import ORDERS_VIEW, as_ntz, ready, table


def window_position(spark, sf):
    """Rank of each order within its customer by price (highest first)."""
    batch = _orders_batch(spark, sf)
    out = running_totals(batch, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"])
    return out.select("o_orderkey", "o_custkey", "o_totalprice", "position")


def window_running_total(spark, sf):
    """Running count and spend of each customer in order-date order."""
    batch = _orders_batch(spark, sf)
    out = running_totals(batch, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice")
    return as_ntz(out.select("o_orderkey", "o_custkey", "o_orderdate", "position",
                             F.round("running_total", 2).alias("running_total")))


def asof_last_purchase(spark, sf):
    """Each event with the value and time of its user's latest purchase until then."""
    ready(spark)
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    bought = (table(spark, sf, "events").filter("event_type = 'purchase'")
              .select(F.col("user_id").alias("buyer"), F.col("ts").alias("bought_at"), F.col("value").alias("price")))
    return asof_join(events, bought, {"user_id": "buyer"}, "ts", "bought_at", ["price", "bought_at"])


def asof_previous_order(spark, sf):
    """Each order of the change batch with the price of the customer's latest order of an
    earlier day (the dearest of that day)."""
    batch = _orders_batch(spark, sf).select("o_orderkey", "o_custkey", "o_orderdate")
    before = _orders_batch(spark, sf).select(F.col("o_custkey").alias("cust"), F.col("o_orderdate").alias("day"),
                                             F.col("o_totalprice").alias("previous_price"))
    return as_ntz(asof_join(batch, before, {"o_custkey": "cust"}, "o_orderdate", "day", ["previous_price"], strict=True))


QUERIES = {
    "asof_last_purchase": asof_last_purchase,
    "asof_previous_order": asof_previous_order,
    "window_position": window_position,
    "window_running_total": window_running_total,
}

ORACLES = {
    "asof_last_purchase": (
        "SELECT e.event_id, e.ts, e.user_id, e.event_type, p.price, p.bought_at FROM events e ASOF LEFT JOIN "
        "(SELECT user_id AS buyer, ts AS bought_at, max(value) AS price FROM events WHERE event_type = 'purchase' "
        "GROUP BY ALL) p ON e.user_id = p.buyer AND e.ts >= p.bought_at"),
    "asof_previous_order": (
        "SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, p.previous_price FROM orders o ASOF LEFT JOIN "
        "(SELECT o_custkey AS cust, o_orderdate AS day, max(o_totalprice) AS previous_price FROM orders GROUP BY ALL) p "
        "ON o.o_custkey = p.cust AND o.o_orderdate > p.day"),
    "window_position": (
        _ORACLE_VIEWS + "select o_orderkey, o_custkey, o_totalprice, row_number() over "
        "(partition by o_custkey order by o_totalprice desc, o_orderkey) as position "
        f"from {ORDERS_VIEW}"),
    "window_running_total": (
        _ORACLE_VIEWS + "select o_orderkey, o_custkey, o_orderdate, row_number() over w as position, "
        "round(sum(o_totalprice) over w, 2) as running_total "
        f"from {ORDERS_VIEW} window w as (partition by o_custkey order by o_orderdate, o_orderkey "
        "rows between unbounded preceding and current row)"),
}
