"""Change feeds and business tables derived from the driver tables.

The driver tables are TPC-H-like and carry no change history, so the shapes the
change pipeline consumes are derived from them with plain column expressions
(no shuffles except where a join is part of the definition):

========================  =====================================================
chg_users                 change log keyed by ``user_id`` (from ``events``)
stock                     one inventory row per product (from ``part``)
order_final               last known order state with a status id (``orders``)
chg_order_status          order status life-cycle feed (``orders``)
order_snapshot            existing orders as snapshot rows, op ``r``
payments                  payments, lawful ones plus spoiled keys
reasons                   return / cancellation reasons, with gaps and extras
reviews                   product reviews, a share with a wrong reviewer
lineitem_spoiled          lineitem with orphan part keys, for FK checks
========================  =====================================================

The same definitions exist as SQL in :mod:`cdc_lake.plans.oracle`; the two are
compared on every oracle run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdc_lake.sources.tables import Tables

# Order states, payment methods (ids 1..5 in this order).
ORDER_STATES = {1: "Ordered", 2: "Shipped", 3: "Delivered", 4: "Returned", 5: "Cancelled"}
PAYMENT_METHODS = {1: "Cash", 2: "Credit Card", 3: "Debit Card", 4: "Bank Transfer", 5: "Digital Wallet"}
REASON_TYPES = ("Cancellation", "Return")
CASH_METHOD = 1
DELIVERED, RETURNED, CANCELLED = 3, 4, 5

# Op code of each event type in the user change feed.
EVENT_OPS = {"signup": "c", "error": "d"}  # anything else is an update


def _op_of_event(event_type: Column) -> Column:
    expr = F.lit("u")
    for et, op in EVENT_OPS.items():
        expr = F.when(event_type == et, F.lit(op)).otherwise(expr)
    return expr


def chg_users(t: Tables) -> DataFrame:
    """User change log: one change per event, ``batch_day`` plays the micro-batch."""
    e = t.events
    return e.select(
        "user_id",
        F.col("event_id").alias("seq"),
        "ts",
        F.col("ts").cast("date").alias("batch_day"),
        _op_of_event(F.col("event_type")).alias("op"),
        "value",
        "props",
    )


def chg_users_late(t: Tables) -> DataFrame:
    """The user feed with one event in seven arriving one micro-batch late."""
    return chg_users(t).withColumn(
        "arrival_day",
        F.when(F.col("seq") % 7 == 0, F.date_add("batch_day", 1)).otherwise(F.col("batch_day")),
    )


def stock(t: Tables) -> DataFrame:
    p = t.part
    return p.select(
        "p_partkey",
        ((F.col("p_partkey") * 37) % 1001).cast("int").alias("qty_in_stock"),
        (10 + F.col("p_partkey") % 41).cast("int").alias("reorder_threshold"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_cost"),
    )


def addresses(t: Tables) -> DataFrame:
    """Two addresses per customer, a billing and a shipping one; some carry both flags or none, and some
    customers have two billing addresses."""
    k = F.col("c_custkey")

    def one(number: int, billing, shipping):
        return F.struct(k.alias("customer_id"), (k * 2 + number).alias("address_id"), billing.alias("is_billing"),
                        shipping.alias("is_shipping"))

    return t.customer.select(F.inline(F.array(
        one(0, k % 50 != 7, k % 40 == 0), one(1, k % 30 == 0, (k % 30 != 0) & (k % 45 != 1)))))


def order_final(t: Tables) -> DataFrame:
    o = t.orders
    k = F.col("o_orderkey")
    status = (
        F.when(k % 33 == 0, F.lit(RETURNED))
        .when(k % 50 == 1, F.lit(CANCELLED))
        .when(F.col("o_orderstatus") == "F", F.lit(DELIVERED))
        .when(F.col("o_orderstatus") == "P", F.lit(2))
        .otherwise(F.lit(1))
    )
    return o.select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        status.alias("status_id"),
    )


def chg_order_status(t: Tables) -> DataFrame:
    """Order life cycle Ordered -> Shipped -> Delivered; keys divisible by 97 skip Shipped.

    One scan of ``orders``: each order row yields its one to three status
    changes through ``inline`` (no union of three scans).
    """
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    k, st, day = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")

    def change(seq: int, ts: Column, op: str, status: int) -> Column:
        return F.struct(F.lit(seq).alias("seq"), ts.alias("ts"), F.lit(op).alias("op"),
                        F.lit(status).alias("status_id"))

    created = change(1, day, "c", 1)
    shipped = F.when(st.isin("P", "F") & (k % 97 != 0),
                     change(2, day + F.expr("INTERVAL 1 DAY"), "u", 2))
    delivered = F.when(st == "F", change(3, day + F.expr("INTERVAL 3 DAY"), "u", 3))
    return o.select(k, F.inline(F.array_compact(F.array(created, shipped, delivered))))


def payments(t: Tables) -> DataFrame:
    of = order_final(t)
    k, s = F.col("o_orderkey"), F.col("status_id")
    lawful = ~s.isin(RETURNED, CANCELLED) & ~((k % 5 == 0) & (s != DELIVERED))
    return of.where(lawful | (k % 89 == 0)).select(
        k.alias("payment_id"), "o_orderkey",
        (1 + k % 5).alias("method_id"),
        F.col("total").alias("amount"),
    )


def reasons(t: Tables) -> DataFrame:
    of = order_final(t)
    k, s = F.col("o_orderkey"), F.col("status_id")
    rtype = F.when((s == RETURNED) & (k % 2 == 0), F.lit("Return")).otherwise(F.lit("Cancellation"))
    return of.where((s.isin(RETURNED, CANCELLED) & (k % 7 != 0)) | (k % 101 == 0)).select(
        "o_orderkey", rtype.alias("reason_type"))


def reviews(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    of = order_final(t).select("o_orderkey", "o_custkey")
    j = li.join(of, li.l_orderkey == of.o_orderkey)
    return j.where((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 20 == 0).select(
        "l_partkey",
        (F.col("o_custkey") + F.when(F.col("l_orderkey") % 4 == 0, 1).otherwise(0)).alias("custkey"),
        (3 + F.col("l_linenumber") % 3).alias("rating"),
    ).distinct()


def order_snapshot(t: Tables) -> DataFrame:
    """Existing order rows as snapshot images (op ``r``) ahead of the change feed."""
    return t.orders.select(
        "o_orderkey", F.lit(0).alias("seq"), F.col("o_orderdate").alias("ts"),
        F.lit("r").alias("op"), F.lit(1).alias("status_id"))


def lineitem_spoiled(t: Tables) -> DataFrame:
    """``lineitem`` whose part key points nowhere when ``l_orderkey % 113 = 0``."""
    li = t.lineitem
    return li.withColumn(
        "l_partkey",
        F.when(F.col("l_orderkey") % 113 == 0, F.col("l_partkey") + 10_000_000).otherwise(F.col("l_partkey")),
    )


def sales(t: Tables) -> DataFrame:
    """Sold items as stock movements, dated by ship date (no join needed)."""
    return t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_suppkey",
        "l_shipdate", "l_extendedprice", F.col("l_quantity").cast("int").alias("qty"))


__all__ = [
    "chg_users", "chg_users_late", "stock", "order_final", "chg_order_status", "payments",
    "reasons", "reviews", "order_snapshot", "lineitem_spoiled", "sales",
]
