"""Stream = batch: the same messages through Structured Streaming (file source,
``availableNow``, several micro-batches) give the batch result; replays and
out-of-order arrival change nothing."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cdc_lake.contracts import ORDER_STATUS_ROW, ROW_SCHEMAS, USER_ROW
from cdc_lake.functions import envelope as env
from cdc_lake.operators import changes, metrics
from cdc_lake.sources import feeds, messages
from cdc_lake.sources.lake import LakeTable, table_path
from cdc_lake.sources.tables import Tables
from cdc_lake.streaming import pipeline as pl
from cdc_lake.streaming.changelog import ChangeLog, CheckpointError
from cdc_lake.streaming.topk import RankedTotals

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver fixtures missing")

USERS = pl.TableSpec("users", messages.USERS_TOPIC, USER_ROW, "user_id")
STATUS = pl.TableSpec("order_status", messages.ORDER_STATUS_TOPIC, ORDER_STATUS_ROW, "o_orderkey")


def _write_files(df, folder, cuts, col="offset", reverse=False):
    """Write ``df`` as one parquet file per ``col`` range, oldest first (or last)."""
    os.makedirs(folder, exist_ok=True)
    bounds = list(zip(cuts, cuts[1:]))
    if reverse:
        bounds = bounds[::-1]
    for i, (lo, hi) in enumerate(bounds):
        part = df.where((F.col(col) >= lo) & (F.col(col) < hi)).coalesce(1)
        tmp = os.path.join(folder, f"_part{i}")
        part.write.parquet(tmp)
        (name,) = [f for f in os.listdir(tmp) if f.endswith(".parquet")]
        os.link(os.path.join(tmp, name), os.path.join(folder, f"msgs_{i:03d}.parquet"))


def _run(spark, spec, src_dir, lake, ckpt, rejoin=False):
    q = pl.start_table_stream(spark, spec, pl.file_source(spark, src_dir + "/msgs_*.parquet", 1), lake, ckpt,
                              trigger={"availableNow": True}, rejoin=rejoin)
    q.awaitTermination(300)
    assert q.exception() is None
    return q


def _state(log):
    cur = changes.current_state(log.withColumnRenamed("ts_ms", "ts"), "user_id", ["value", "props"])
    return sorted((r.user_id, r.value, r.props) for r in cur.collect())


def _batch_state(spark):
    c = feeds.chg_users(Tables(spark, SF_SMALL))
    return sorted((r.user_id, r.value, r.props) for r in changes.current_state(c, "user_id", ["value", "props"]).collect())


def test_stream_equals_batch_and_replay(spark, scratch):
    msgs = messages.user_messages(Tables(spark, SF_SMALL))
    src = os.path.join(scratch, "users")
    _write_files(msgs, src, [0, 700, 1400, 10**9])
    lake = os.path.join(scratch, "lake")
    _run(spark, USERS, src, lake, os.path.join(scratch, "ckpt"))
    log = LakeTable(spark, lake, "users_log").read()
    assert {r.batch_id for r in log.select("batch_id").distinct().collect()} == {0, 1, 2}
    n_log = log.count()
    assert n_log == feeds.chg_users(Tables(spark, SF_SMALL)).count()
    assert _state(log) == _batch_state(spark)
    dead = LakeTable(spark, lake, "users_dead_letter").read()
    assert dead.count() == msgs.count() - n_log

    # Lost checkpoint: refused unless asked for, then the whole topic is read again into the same lake.
    with pytest.raises(CheckpointError):
        _run(spark, USERS, src, lake, os.path.join(scratch, "ckpt2"))
    _run(spark, USERS, src, lake, os.path.join(scratch, "ckpt2"), rejoin=True)
    again = ChangeLog(spark, lake, "users", USERS.log_schema).rows()
    assert again.count() == n_log
    assert _state(again) == _batch_state(spark)


def _offsets(df):
    return sorted(r.seq for r in df.select("seq").collect())


def test_new_checkpoint_with_other_batch_borders(spark, scratch):
    """Every message is in the log once, whatever borders the new stream's batches have."""
    msgs = messages.user_messages(Tables(spark, SF_SMALL))
    src, src2 = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    _write_files(msgs, src, [0, 700, 1400, 10**9])
    _write_files(msgs, src2, [0, 10**9])                       # the same messages as one batch
    lake = os.path.join(scratch, "lake")
    _run(spark, USERS, src, lake, os.path.join(scratch, "ckpt"))
    log = ChangeLog(spark, lake, "users", USERS.log_schema)
    want = _offsets(log.rows())
    history = changes.scd2_history(log.rows(), "user_id", ["value"], ("ts_ms", "seq"), ts="ts_ms").count()
    _run(spark, USERS, src2, lake, os.path.join(scratch, "ckpt2"), rejoin=True)
    assert _offsets(log.rows()) == want and len(set(want)) == len(want)
    assert [r[2] for r in log.registered()] == [0, 3]
    assert changes.scd2_history(log.rows(), "user_id", ["value"], ("ts_ms", "seq"), ts="ts_ms").count() == history


def test_new_checkpoint_when_part_of_the_topic_has_expired(spark, scratch):
    """Nothing that an older stream wrote is lost, and new messages come in."""
    msgs = messages.user_messages(Tables(spark, SF_SMALL))
    old, new = os.path.join(scratch, "old"), os.path.join(scratch, "new")
    _write_files(msgs.where("offset < 1500"), old, [0, 700, 10**9])
    _write_files(msgs.where("offset >= 1000"), new, [0, 1200, 10**9])   # 0 .. 999 are gone from the topic
    lake = os.path.join(scratch, "lake")
    _run(spark, USERS, old, lake, os.path.join(scratch, "ckpt"))
    _run(spark, USERS, new, lake, os.path.join(scratch, "ckpt2"), rejoin=True)
    _run(spark, USERS, new, lake, os.path.join(scratch, "ckpt2"))       # the same checkpoint goes on
    log = ChangeLog(spark, lake, "users", USERS.log_schema)
    valid = env.to_change_log(env.parse_messages(msgs, USER_ROW), "user_id", USERS.row_cols)
    assert _offsets(log.rows()) == _offsets(valid)
    assert _state(log.rows()) == _batch_state(spark)


def test_streams_need_a_checkpoint(spark, scratch):
    with pytest.raises(ValueError):
        pl.start_table_stream(spark, USERS, pl.file_source(spark, scratch), scratch, None)
    with pytest.raises(ValueError):
        pl.start_top_products(pl.file_source(spark, scratch), USERS, None, "")


def test_out_of_order_arrival(spark, scratch):
    msgs = messages.user_messages(Tables(spark, SF_SMALL))
    src = os.path.join(scratch, "users_rev")
    _write_files(msgs, src, [0, 500, 1000, 1500, 10**9], reverse=True)   # newest changes arrive first
    lake = os.path.join(scratch, "lake")
    _run(spark, USERS, src, lake, os.path.join(scratch, "ckpt"))
    log = LakeTable(spark, lake, "users_log").read()
    assert _state(log) == _batch_state(spark)


def test_one_query_per_table(spark, scratch):
    t = Tables(spark, SF_SMALL)
    u_dir, s_dir = os.path.join(scratch, "u"), os.path.join(scratch, "s")
    _write_files(messages.user_messages(t), u_dir, [0, 10**9])
    _write_files(messages.order_status_messages(t), s_dir, [0, 10**9])
    lake, ckpt = os.path.join(scratch, "lake"), os.path.join(scratch, "ckpt")
    dirs = {USERS.name: u_dir, STATUS.name: s_dir}
    qs = pl.start_all(spark, [USERS, STATUS], lambda s: pl.file_source(spark, dirs[s.name] + "/msgs_*.parquet"),
                      lake, ckpt, trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination(300)
        assert q.exception() is None
    status = LakeTable(spark, lake, "order_status_log").read()
    assert status.count() == feeds.chg_order_status(t).count()
    assert {r.topic for r in LakeTable(spark, lake, "users_dead_letter").read().select("topic").distinct().collect()} \
        == {messages.USERS_TOPIC}
    assert table_path(lake, "Order_Status_Log") == LakeTable(spark, lake, "order_status_log").path


def test_raw_tap_to_memory(spark, scratch):
    msgs = messages.user_messages(Tables(spark, SF_SMALL))
    src = os.path.join(scratch, "tap")
    _write_files(msgs, src, [0, 10**9])
    q = pl.tap(pl.file_source(spark, src + "/msgs_*.parquet"), sink="memory", name="raw_tap_test",
               checkpoint=os.path.join(scratch, "ckpt"))
    q.processAllAvailable()
    q.stop()
    got = spark.table("raw_tap_test")
    assert got.count() == msgs.count()
    assert got.where(F.col("raw_json").startswith('{"payload"')).count() == msgs.count() - \
        msgs.where(F.col("value").isNull() | ~F.col("value").cast("string").startswith('{"payload"')).count()


def test_top_products_stream_equals_batch(spark, scratch):
    t = Tables(spark, SF_SMALL)
    item = ROW_SCHEMAS["OrderItems"]
    li = t.lineitem.select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("k"), "l_partkey", "l_quantity")
    li = li.dropDuplicates(["k"]).select(
        F.col("k").cast("int").alias("OrderItemID"), F.lit(1).alias("OrderID"),
        F.col("l_partkey").cast("int").alias("ProductID"), F.col("l_quantity").cast("int").alias("Quantity"),
        F.lit(None).cast("decimal(18,2)").alias("CurrentPrice"), F.lit(0).cast("long").alias("CreatedAt"),
        F.lit(0).cast("long").alias("UpdatedAt"))
    cols = [f.name for f in item.fields]
    creates = li.select(F.lit("c").alias("op"), F.lit(1).cast("long").alias("ts_ms"),
                        F.col("OrderItemID").cast("long").alias("offset"), *cols)
    bumped = li.withColumn("Quantity", F.col("Quantity") + 1)
    upd = (li.where(F.col("OrderItemID") % 10 == 0).alias("b")
           .join(bumped.alias("a"), "OrderItemID")
           .select(F.lit("u").alias("op"), F.lit(2).cast("long").alias("ts_ms"),
                   (F.col("OrderItemID") + 10**9).cast("long").alias("offset"),
                   F.struct(*[F.col("b." + c if c != "OrderItemID" else c) for c in cols]).alias("before"),
                   F.struct(*[F.col("a." + c if c != "OrderItemID" else c) for c in cols]).alias("after")))
    state = bumped.where(F.col("OrderItemID") % 10 == 0).unionByName(li.where(F.col("OrderItemID") % 10 != 0))
    dele = (state.where(F.col("OrderItemID") % 25 == 0)
            .select(F.lit("d").alias("op"), F.lit(3).cast("long").alias("ts_ms"),
                    (F.col("OrderItemID") + 2 * 10**9).cast("long").alias("offset"),
                    F.struct(*cols).alias("before"), F.lit(None).alias("after")))

    def as_msgs(df, with_images):
        if not with_images:
            payload = F.struct(F.lit(None).alias("before"), F.struct(*cols).alias("after"), "op", "ts_ms")
        else:
            payload = F.struct("before", "after", "op", "ts_ms")
        return df.select(F.lit("order_items").alias("topic"), F.lit(0).alias("partition"), "offset",
                         F.to_json(F.struct(payload.alias("payload"))).cast("binary").alias("value"))

    allm = as_msgs(creates, False).unionByName(as_msgs(upd, True)).unionByName(as_msgs(dele, True))
    src = os.path.join(scratch, "items")
    # Delivered at least once and out of order: every third create again after the deletes, updates last.
    twice = allm.where("offset < 1000000000 AND offset % 3 = 0")
    order = (allm.withColumn("at", F.when(F.col("offset") < 10**9, 1).when(F.col("offset") < 2 * 10**9, 3).otherwise(2))
             .unionByName(twice.withColumn("at", F.lit(4))))
    _write_files(order, src, [1, 2, 3, 4, 5], col="at")
    out = os.path.join(scratch, "top10")
    products = lambda s: Tables(s, SF_SMALL).part.select(
        F.col("p_partkey").cast("int").alias("ProductID"), F.col("p_name").alias("Name"))
    spec = pl.TableSpec("OrderItems", "order_items", item, "OrderItemID")
    q = pl.start_top_products(pl.file_source(spark, src + "/msgs_*.parquet", 1), spec,
                              pl.TopKWriter(products, out), os.path.join(scratch, "ckpt"),
                              trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    assert RankedTotals(spark, out).latest()[1]["stream"] == str(q.id)
    streamed = [(r.name, r.quantity) for r in RankedTotals(spark, out).served().orderBy(F.desc("quantity"), "name").collect()]

    # Batch: current state of the items, then the dashboard query.
    parsed = env.parse_messages(allm, item)
    log = env.to_change_log(parsed, "OrderItemID", cols).withColumnRenamed("ts_ms", "ts")
    cur = changes.current_state(log, "OrderItemID", ["ProductID", "Quantity"])
    batch = metrics.top_products(cur, t.part, item_key="ProductID", qty="Quantity")
    assert streamed == [(r.p_name, r.quantity) for r in batch.collect()]


def test_compaction_equals_full_log(spark, scratch):
    from cdc_lake.streaming.compaction import SnapshotStore, compact_log, current_view
    msgs = messages.user_messages(Tables(spark, SF_SMALL))
    src = os.path.join(scratch, "users")
    _write_files(msgs, src, [0, 600, 1200, 1800, 10**9])
    lake = os.path.join(scratch, "lake")
    _run(spark, USERS, src, lake, os.path.join(scratch, "ckpt"))
    log = ChangeLog(spark, lake, "users", USERS.log_schema)
    store = SnapshotStore(spark, lake, "users")
    want = _batch_state(spark)

    def view():
        v = current_view(spark, log, store, "user_id", ["value", "props"])
        return sorted((r.user_id, r.value, r.props) for r in v.collect())

    assert view() == want                                   # no snapshot yet
    assert compact_log(spark, log, store, "user_id", ["value", "props"], 1) == 1
    assert view() == want
    assert compact_log(spark, log, store, "user_id", ["value", "props"], 1) == 1   # idempotent
    assert compact_log(spark, log, store, "user_id", ["value", "props"], 3) == 3
    assert store.versions() == [1, 3]
    assert view() == want


def test_history_snapshots_equal_full_history(spark, scratch):
    from cdc_lake.streaming.compaction import SnapshotStore, compact_history, history_view
    msgs = messages.user_messages(Tables(spark, SF_SMALL))
    src = os.path.join(scratch, "users")
    _write_files(msgs, src, [0, 600, 1200, 1800, 10**9])
    lake = os.path.join(scratch, "lake")
    _run(spark, USERS, src, lake, os.path.join(scratch, "ckpt"))
    log = ChangeLog(spark, lake, "users", USERS.log_schema)
    store = SnapshotStore(spark, lake, "users_history")
    cols = ["value", "props"]
    full = changes.scd2_history(log.rows(), "user_id", cols, ("ts_ms", "seq"), ts="ts_ms")
    rows = lambda df: sorted(
        (r.user_id, r.valid_from, r.valid_to, r.value, r.props, r.is_current) for r in df.collect())
    want = rows(full)
    assert rows(history_view(spark, log, store, "user_id", cols)) == want
    assert compact_history(spark, log, store, "user_id", cols, 1) == 1
    assert rows(history_view(spark, log, store, "user_id", cols)) == want
    assert compact_history(spark, log, store, "user_id", cols, 3) == 3
    assert store.versions() == [1, 3]
    assert rows(history_view(spark, log, store, "user_id", cols)) == want
    # With a snapshot only the log's partitions after it are scanned, once.
    assert compact_history(spark, log, SnapshotStore(spark, lake, "users_h2"), "user_id", cols, 1) == 1
    plan = history_view(spark, log, SnapshotStore(spark, lake, "users_h2"), "user_id", cols)
    assert rows(plan) == want
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    scans = plan._jdf.queryExecution().sparkPlan().toString()
    reads = re.findall(r"Location: InMemoryFileIndex[^\n]*users_log[^\n]*", scans)
    assert reads and all(re.search(r"PartitionFilters: \[[^]]*batch_id#\d+L > 1", r) for r in reads), (text, scans)
    k = want[0][0]
    assert rows(history_view(spark, log, store, "user_id", cols, value=k)) == [r for r in want if r[0] == k]


def test_tombstone_blocks_late_resurrection(spark):
    base = spark.createDataFrame([(1, 5, 50, "d", None)], "k int, seq long, ts long, op string, v string")
    late = spark.createDataFrame([(1, 2, 20, "u", "old")], "k int, seq long, ts long, op string, v string")
    snap = changes.compact(base, late, "k", ["v"])
    assert changes.current_state(snap, "k", ["v"]).count() == 0


def test_state_store_current_state_equals_batch(spark, scratch):
    msgs = messages.user_messages(Tables(spark, SF_SMALL))
    src = os.path.join(scratch, "users")
    _write_files(msgs, src, [0, 700, 1400, 10**9])
    agg = pl.current_state_stream(pl.file_source(spark, src + "/msgs_*.parquet", 1), USERS)
    q = (agg.writeStream.outputMode("complete").format("memory").queryName("cur_state_test")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.table("cur_state_test").where(F.col("op") != "d")
    assert sorted((r.user_id, r.value, r.props) for r in got.collect()) == _batch_state(spark)


def test_compact_touches_only_changed_keys(spark):
    """Snapshot + tail equals the last change per key over both, with late,
    deleted, new and untouched keys; untouched base rows are not shuffled
    when the tail's keys are small (broadcast anti join)."""
    base = spark.createDataFrame(
        [(1, 1, 10, "c", "a"), (2, 2, 20, "u", "b"), (3, 3, 30, "d", None), (4, 4, 40, "u", "d")],
        "k int, seq long, ts long, op string, v string")
    tail = spark.createDataFrame(
        [(2, 5, 50, "u", "b2"), (2, 6, 60, "u", "b3"), (3, 7, 25, "u", "late"), (4, 8, 70, "d", None),
         (9, 9, 90, "c", "new")],
        "k int, seq long, ts long, op string, v string")
    got = changes.compact(base, tail, "k", ["v"])
    want = changes.latest_per_key(base.unionByName(tail), "k", ["v"])
    rows = lambda df: sorted(tuple(r) for r in df.select("k", "seq", "ts", "op", "v").collect())
    assert rows(got) == rows(want)
    assert [r.k for r in changes.current_state(got, "k", ["v"]).orderBy("k").collect()] == [1, 2, 9]
    got.collect()                                            # AQE plans the joins from run-time sizes
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in p
    assert re.search(r"BroadcastHashJoin \[k#\d+\], \[k#\d+\], LeftAnti", p)
