"""Business metrics served to the dashboard: top-selling products, change counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_products(items: DataFrame, products: DataFrame, k: int = 10, by_id: bool = False,
                 item_key: str = "l_partkey", qty: str = "l_quantity",
                 product_key: str = "p_partkey", name: str = "p_name") -> DataFrame:
    """Top-``k`` products by quantity sold; ties broken by name (or id).

    Plan: quantities are summed per product key first (partial aggregation on
    the map side, so a hot product shrinks to one row per task before the
    shuffle), the per-product totals are joined to the product table (broadcast
    or shuffle is AQE's choice from the runtime sizes), summed again per name
    (same-named products merge, as in the reference), and the top ``k`` leave
    through ``TakeOrderedAndProject``: only ``k`` rows reach the driver.
    """
    per_item = (items.select(F.col(item_key).alias("_pk"), F.col(qty).cast("int").alias("_q"))
                .groupBy("_pk").agg(F.sum("_q").alias("_q")))
    p = products.select(F.col(product_key).alias("_pk"), F.col(name).alias(name))
    if not by_id:
        p = p.where(F.col(name).isNotNull())
    j = per_item.join(p, "_pk")
    if by_id:
        g = j.groupBy(F.col("_pk").alias(product_key), name)
        tie = [F.col(product_key).asc()]
    else:
        g = j.groupBy(name)
        tie = [F.col(name).asc()]
    agg = g.agg(F.coalesce(F.sum("_q"), F.lit(0)).cast("long").alias("quantity"))
    return agg.orderBy(F.col("quantity").desc(), *tie).limit(k)


def change_counts(log: DataFrame, batch: str = "batch_day") -> DataFrame:
    """Number of changes per micro-batch and op code."""
    return log.groupBy(batch, "op").agg(F.count(F.lit(1)).alias("n_changes"))
