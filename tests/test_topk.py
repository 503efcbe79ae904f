"""Ranked totals: every version equals the plain top-k, and a trigger touches what its deltas name."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cdc_lake.streaming.topk import RankedTotals

NAMES = "product long, name string"


def _plain(totals, names, k):
    by = {}
    for p, n in names:
        if n is not None and totals.get(p):
            by[n] = by.get(n, 0) + totals[p]
    return sorted(by.items(), key=lambda x: (-x[1], x[0]))[:k]


def _frame(spark, deltas):
    return spark.createDataFrame(deltas, "product long, delta long")


def test_random_triggers_equal_the_plain_top_k(spark, scratch):
    rng = random.Random(5)
    store = RankedTotals(spark, os.path.join(scratch, "top"), k=4, buckets=16)
    assert store.served().count() == 0                                   # before the first version
    totals, names = {}, [(p, f"n{p % 23}" if p % 9 else None) for p in range(40)]  # equal names and none
    for batch in range(6):
        deltas = [(rng.randrange(44) if batch else rng.randrange(3), rng.choice((-7, -3, 1, 5, 20))) for _ in range(12)]
        deltas += [(None, 5), (1, 2), (1, -2)]
        if batch == 3:                                                   # renamed, and a new name for a product without
            names = [(p, "renamed" if p in (1, 2, 9) else n) for p, n in names]
        if batch == 5:
            deltas += [(p, -q) for p, q in totals.items()]               # only the last trigger's deltas remain
        for p, d in deltas:
            if p is not None:
                totals[p] = totals.get(p, 0) + d
        assert store.apply("s", batch, _frame(spark, deltas), spark.createDataFrame(names, NAMES)) is not None
        got = [(r.name, r.quantity) for r in store.served().orderBy(F.desc("quantity"), "name").collect()]
        assert got == _plain(totals, names, 4)
        assert {r.batch_id for r in store.served().collect()} <= {batch}
    assert store.records.numbers() == [4, 5]


def test_a_trigger_reads_and_writes_touched_buckets_only(spark, scratch):
    store = RankedTotals(spark, os.path.join(scratch, "top"), k=3, buckets=64)
    names = spark.range(2000).select(F.col("id").alias("product"), F.concat(F.lit("n"), "id").alias("name"))
    first = store.apply("s", 0, spark.range(2000).select(F.col("id").alias("product"), (F.col("id") + 1).alias("delta")), names)
    assert len(first["buckets"]) == 64
    assert len(first["opened"]) <= 3                                     # unique names: the buckets of the best
    held = store.served()
    second = store.apply("s", 1, _frame(spark, [(7, 10_000), (8, 1)]), names)
    moved = [b for b in first["buckets"] if second["buckets"][b] != first["buckets"][b]]
    assert 1 <= len(moved) <= 2
    assert sorted(p for p in os.listdir(store.out + "_totals") if not p.startswith(".")).__len__() == 2
    assert [(r.name, r.quantity) for r in store.served().orderBy(F.desc("quantity")).collect()] == [
        ("n7", 10_008), ("n1999", 2000), ("n1998", 1999)]
    assert held.orderBy(F.desc("quantity")).first().name == "n1999"      # a reader of the version before
    # A third version: files that only the first one named are gone, those still in use are not.
    store.apply("s", 2, _frame(spark, [(7, 1)]), names)
    gone = [v[0] for b, v in first["buckets"].items() if b in moved]
    assert any(not os.path.exists(p) for p in gone) and not os.path.exists(first["served"])
    assert store._totals(store.latest()[1]["buckets"], set(range(64))).count() == 2000


def test_replay_failure_and_another_stream(spark, scratch, monkeypatch):
    store = RankedTotals(spark, os.path.join(scratch, "top"), k=2, buckets=8)
    names = spark.createDataFrame([(1, "a"), (2, "b")], NAMES)
    rows = lambda: sorted((r.name, r.quantity, r.batch_id) for r in store.served().collect())
    store.apply("s", 0, _frame(spark, [(1, 5), (2, 3)]), names)
    with monkeypatch.context() as m:                                     # all files written, no record
        m.setattr(store.records, "put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.apply("s", 1, _frame(spark, [(2, 9)]), names)
    assert rows() == [("a", 5, 0), ("b", 3, 0)]
    store.apply("s", 1, _frame(spark, [(2, 9)]), names)
    assert rows() == [("a", 5, 1), ("b", 12, 1)]
    assert store.apply("s", 1, _frame(spark, [(2, 9)]), names) is None   # a replay counts once
    assert store.apply("s", 0, _frame(spark, [(1, 5)]), names) is None
    assert rows() == [("a", 5, 1), ("b", 12, 1)]
    store.apply("s", 2, _frame(spark, []), names)                        # no deltas
    assert rows() == [("a", 5, 2), ("b", 12, 2)]
    store.apply("t", 0, _frame(spark, [(1, 1)]), names)                  # a new stream starts from empty totals
    assert rows() == [("a", 1, 0)]
