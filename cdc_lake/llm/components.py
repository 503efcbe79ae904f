"""Connected components by alternating large-star and small-star steps on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step; ``edges`` (a > b) is a written table, and so is the table of minima, so that the join on a hub
    can be split."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = C.written(near.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")), "cc-min")
    near = C.written(near, "cc-near") if large else near
    linked = near.join(C.small(low), "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return C.written(out.where("a <> b").distinct(), "cc-edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected edges (a, b); the component is its smallest node."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = C.written(e, "cc-edges")
    before = None
    while True:
        e = _star(_star(e, True), False)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == before or not now[0]:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
