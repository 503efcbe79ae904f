"""Incrementally kept results (orphan counts, stock ledger) against the full recomputation, on random changes."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from cdc_lake.contracts import ForeignKey
from cdc_lake.operators import fkcount, ledger, quality
from cdc_lake.streaming.fkview import FkView

FKS = (ForeignKey("line_order", "line", "order_id", "orders", "id"), ForeignKey("line_part", "line", "part", "part", "id"),
       ForeignKey("order_cust", "orders", "cust", "cust", "id"))
SCHEMAS = {"line": "order_id int, part int", "orders": "id int, cust int", "part": "id int", "cust": "id int"}


def frames(spark, tables):
    return {t: spark.createDataFrame(tables.get(t, []), s) for t, s in SCHEMAS.items()}


def random_rows(rng):
    some = lambda n: rng.choice([None, *range(n)])
    return {"line": [(some(12), some(9)) for _ in range(rng.randrange(40))], "orders": [(some(12), some(6)) for _ in range(rng.randrange(8))],
            "part": [(some(9),) for _ in range(rng.randrange(5))], "cust": [(some(6),) for _ in range(rng.randrange(4))]}


def changes_of(rng, now):
    """(inserted, deleted) rows by table; ``now`` (rows held) is changed alike."""
    ins = random_rows(rng)
    dele = {t: rng.sample(now[t], rng.randrange(len(now[t]) + 1)) for t in now}
    for t in now:
        for r in dele[t]:
            now[t].remove(r)
        now[t] += ins[t]
    return ins, dele


def orphans(df):
    return sorted(tuple(r) for r in df.select("fk_name", "child_key", "n_rows").collect())


def test_counts_follow_random_changes(spark):
    rng = random.Random(1)
    now = random_rows(rng)
    counts = fkcount.fk_counts(frames(spark, now), FKS)
    for _ in range(3):
        ins, dele = changes_of(rng, now)
        counts = fkcount.fk_apply(counts, fkcount.fk_deltas(frames(spark, ins), frames(spark, dele), FKS)).persist()
        assert orphans(fkcount.fk_orphans_of(counts)) == orphans(quality.fk_orphans(frames(spark, now), FKS))


def test_stored_view_follows_random_changes(spark, scratch):
    """Merges on several levels; a batch applied again after a failure between the two stores changes nothing."""
    rng = random.Random(2)
    now = {t: [] for t in SCHEMAS}
    view = FkView(spark, scratch, "shop", FKS, buckets=3, fan=2)
    assert orphans(view.orphans()) == []
    for n in range(5):
        ins, dele = (frames(spark, x) for x in changes_of(rng, now))
        if n == 3:
            add = view.counts.add
            view.counts.add = lambda *a: (_ for _ in ()).throw(OSError("full"))
            try:
                view.apply(n, ins, dele)
            except OSError:
                pass
            view.counts.add = add
            assert (view.orphans_.latest(), view.counts.latest()) == (3, 2)
        view.apply(n, ins, dele)
        view.apply(n, ins, dele)
        if n in (1, 3, 4):
            assert orphans(view.orphans()) == orphans(quality.fk_orphans(frames(spark, now), FKS))
    assert max(s["level"] for s in view.counts.segments()) >= 2


def test_stored_view_reads_touched_buckets_only(spark, scratch):
    view = FkView(spark, scratch, "shop", FKS, buckets=16)
    view.apply(0, frames(spark, {"orders": [(k, k) for k in range(300)], "cust": [(k,) for k in range(0, 300, 2)]}), {})
    assert len({s["bucket"] for s in view.counts.segments()}) == 16
    one = fkcount.fk_deltas(frames(spark, {"cust": [(7,)]}), {}, FKS)
    from cdc_lake.streaming.fkview import _keyed
    read = view.old_counts(_keyed(one))
    assert len(read.inputFiles()) == 1 and [tuple(r) for r in read.collect()] == [("order_cust", 7, 1, 0)]
    view.apply(1, frames(spark, {"cust": [(7,)]}), {})
    assert ("order_cust", 7, 1) not in orphans(view.orphans()) and ("order_cust", 9, 1) in orphans(view.orphans())


# ------------------------------------------------------------------ ledger
SALES = "p_partkey long, l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate date, l_extendedprice double, qty int"


def some_sales(rng, n, first):
    day = lambda: rng.choice([None, dt.date(1965, 1, 1), *[dt.date(1995, 1, 1) + dt.timedelta(days=rng.randrange(2500))] * 20])
    return [(rng.choice([1, 1, 1, *range(2, 9)]), first + i, 1, 5, day(), 10.0, rng.randrange(1, 9)) for i in range(n)]


def ledger_of(df):
    return sorted(map(repr, df.collect()))


def test_kept_ledger_equals_full_ledger(spark, scratch):
    rng = random.Random(3)
    first, late = some_sales(rng, 400, 0), some_sales(rng, 12, 1000)
    a, b = (spark.createDataFrame(x, SALES) for x in (first, late))
    stock = spark.createDataFrame([(k, 500) for k in range(1, 8)], "p_partkey long, qty_in_stock int")
    want = ledger.stock_ledger(a.unionByName(b), stock)
    ledger.ledger_rows(a).write.partitionBy("bucket").parquet(scratch + "/rows")
    ledger.ledger_tree(a).write.parquet(scratch + "/tree")
    rows, tree = spark.read.parquet(scratch + "/rows").withColumn("bucket", F.col("bucket").cast("long")), \
        spark.read.parquet(scratch + "/tree")
    assert ledger_of(ledger.ledger_view(rows, tree, stock).select(*want.columns)) == ledger_of(ledger.stock_ledger(a, stock))
    changed, kept, nodes = ledger.ledger_add(rows, tree, b)
    new = ledger.tree_with(tree, nodes)
    assert ledger_of(ledger.ledger_view(kept.unionByName(changed), new, stock).select(*want.columns)) == ledger_of(want)
    # A late sale adds to one node per level; only its buckets are read.
    pairs = b.select("p_partkey", ledger.time_bucket()).distinct().count()
    assert nodes.count() <= pairs * ledger.LEVELS < tree.count()
    plan = changed._jdf.queryExecution().sparkPlan().toString()
    scans = re.findall(r"FileScan parquet [^\n]*scratch?[^\n]*|FileScan parquet [^\n]*", plan)
    assert scans and all(re.search(r"PartitionFilters: \[[^]]*bucket#\d+", s) for s in scans if "/rows" in s)
    weeks = {r[0] for r in b.select(ledger.time_bucket()).distinct().collect()}
    assert {r.bucket for r in changed.select("bucket").distinct().collect()} <= weeks
    for day in (dt.date(1960, 1, 1), dt.date(1996, 5, 5), dt.date(2030, 1, 1)):
        upto = [s for s in first + late if s[0] == 1 and (s[4] is None or s[4] <= day)]
        got = ledger.balance_at(kept.unionByName(changed), new, stock, 1, day).first()
        assert (got.sold_to_date, got.balance) == (sum(s[6] for s in upto), 500 - sum(s[6] for s in upto))


def test_kept_ledger_of_empty_tables(spark):
    none = spark.createDataFrame([], SALES)
    stock = spark.createDataFrame([(1, 5)], "p_partkey long, qty_in_stock int")
    rows, tree = ledger.ledger_rows(none), ledger.ledger_tree(none)
    changed, kept, nodes = ledger.ledger_add(rows, tree, none)
    assert changed.count() == kept.count() == nodes.count() == ledger.ledger_view(rows, tree, stock).count() == 0
    assert tuple(ledger.balance_at(rows, tree, stock, 1, dt.date(2000, 1, 1)).first()) == (1, 5, 0, 5)


def test_kept_ledger_moves_each_sale_once(spark):
    """From the sales to the view: the kept rows (those of changing weeks and the others) and the late rows are shuffled
    once each, never again after they met; the trees and the sums before the weeks move without the rows."""
    rng = random.Random(4)
    sales = some_sales(rng, 300, 0)
    sales += [(2, 500, 1, 5, dt.date(1996, 1, 1), 10.0, -3)] * 2 + [(9, 501, 1, 5, dt.date(1996, 1, 1), 10.0, 4)]
    a = spark.createDataFrame(sales, SALES)
    b = spark.createDataFrame(some_sales(rng, 60, 1000) + sales[-1:], SALES)
    stock = spark.createDataFrame([(k, 50) for k in range(1, 8)] + [(3, 60)], "p_partkey long, qty_in_stock int")
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for adaptive in ("false", "true"):
        try:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            changed, kept, nodes = ledger.ledger_add(ledger.ledger_rows(a), ledger.ledger_tree(a), b)
            view = ledger.ledger_view(kept.unionByName(changed), ledger.tree_with(ledger.ledger_tree(a), nodes), stock)
            plan = view._jdf.queryExecution().executedPlan().toString()
            assert ledger_of(view) == ledger_of(ledger.stock_ledger(a.unionByName(b), stock))
        finally:
            for k, v in was.items():
                spark.conf.set(k, v)
        by = [re.sub(r"#\d+L?", "", m) for m in re.findall(r" Exchange hashpartitioning\((.*), \d+\)", plan)]
        # Kept rows twice (weeks that change, weeks that do not), late rows, sums before the weeks.
        assert by.count("p_partkey, bucket") == 4, by
        # The old tree (read twice) and that of the late sales, each after its weeks' totals, and the stock.
        assert by.count("p_partkey") <= 4 and len(by) <= 11, by
