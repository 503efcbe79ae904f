"""Change messages as a message bus would deliver them: ``topic, partition, offset, value``.

Production reads these from Kafka (see :mod:`cdc_lake.streaming.pipeline`);
tests and the query catalogue derive them from the driver tables so that the
whole parse path runs over data that grows with the tables:

* topic ``users``: one envelope per ``chg_users`` change at offset ``2*seq``;
  after every delete the tombstone the connector emits (null value) at
  ``2*seq+1``; every 500th change is followed by a damaged message at
  ``2*seq+1`` (cut to a third, or a heartbeat without ``payload``).
* topic ``order_status``: one envelope per order status change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdc_lake.functions.envelope import build_value
from cdc_lake.functions.timecols import epoch_ms_of
from cdc_lake.sources import feeds
from cdc_lake.sources.tables import Tables

USERS_TOPIC = "users"
ORDER_STATUS_TOPIC = "order_status"


def user_messages(t: Tables) -> DataFrame:
    """One scan of the user feed; each change yields its envelope and, after
    a delete or a damaged slot, one more message at ``2*seq+1``."""
    c = feeds.chg_users(t).withColumn("ts_ms", epoch_ms_of("ts"))
    seq, op = F.col("seq"), F.col("op")
    value = build_value(["user_id", "value", "props"])
    text = value.cast("string")

    def message(offset: Column, v: Column) -> Column:
        return F.struct(F.lit(0).alias("partition"), offset.alias("offset"), v.cast("binary").alias("value"))

    follow_up = (
        F.when(op == "d", message(seq * 2 + 1, F.lit(None)))
        .when(seq % 500 == 250, message(seq * 2 + 1, F.expr("substring(_t, 1, length(_t) div 3)")))
        .when(seq % 500 == 0, message(seq * 2 + 1, F.concat(F.lit('{"heartbeat": '), seq.cast("string"), F.lit("}"))))
    )
    with_text = c.select("seq", "op", value.alias("_v"), text.alias("_t"))
    # The topic stays outside the generator: a filter on another topic folds to false and drops the branch.
    rows = with_text.select(F.inline(F.array_compact(F.array(message(seq * 2, F.col("_v")), follow_up))))
    return rows.select(F.lit(USERS_TOPIC).alias("topic"), "partition", "offset", "value")


def order_status_messages(t: Tables) -> DataFrame:
    c = feeds.chg_order_status(t).withColumn("ts_ms", epoch_ms_of("ts"))
    return c.select(
        F.lit(ORDER_STATUS_TOPIC).alias("topic"), F.lit(0).alias("partition"),
        (F.col("o_orderkey") * 4 + F.col("seq")).alias("offset"),
        build_value(["o_orderkey", "status_id"]).alias("value"))


def all_messages(t: Tables) -> DataFrame:
    """Both topics on one bus, as a multi-topic subscription delivers them."""
    return user_messages(t).unionByName(order_status_messages(t))
