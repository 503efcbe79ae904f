"""Commit records, levelled snapshots and the key index: what a reader sees beside writers, replays and compactions."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdc_lake import cli
from cdc_lake.operators import changes
from cdc_lake.sources.records import RecordFolder
from cdc_lake.streaming import keyindex
from cdc_lake.streaming import pipeline as pl
from cdc_lake.streaming.changelog import ChangeLog, CheckpointError
from cdc_lake.streaming.compaction import (CompactionConflict, SnapshotStore, compact_history, compact_log, current_view,
                                           history_view)

SPEC = pl.source_table_specs(names=["Customers"])[0]
COLS = [c for c in SPEC.row_cols if c != "CustomerID"]


def batch(spark, rows):
    """Messages (offset, key, op, name); a name of None is no JSON."""
    values = []
    for offset, key, op, name in rows:
        image = "before" if op == "d" else "after"
        text = "broken" if name is None else (
            f'{{"payload": {{"op": "{op}", "ts_ms": {offset}, "{image}": {{"CustomerID": {key}, "Name": "{name}"}}}}}}')
        values.append(("customers", 0, offset, text.encode()))
    return spark.createDataFrame(values, pl.MESSAGE_SCHEMA)


class Stop(Exception):
    pass


def half_written(spark, sink, rows, batch_id, monkeypatch):
    """Both tables are written, then the driver dies before the commit."""
    with monkeypatch.context() as m:
        m.setattr(RecordFolder, "put", lambda *a: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            sink(batch(spark, rows), batch_id)


def state(spark, lake):
    return sorted((r.CustomerID, r.seq) for r in cli.current_table(spark, lake, "Customers").collect())


def test_record_is_written_once(spark, scratch):
    folder = RecordFolder(spark, scratch + "/records")
    assert folder.numbers() == [] and folder.get(3) is None
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: folder.put(3, {"by": k}), range(8)))
    assert sum(won) == 1 and folder.get(3) == {"by": won.index(True)}
    assert folder.numbers() == [3]
    for n in range(100):
        folder.put(n, {"by": n})
    assert folder.read(list(range(4, 100))) == [(n, {"by": n}) for n in range(4, 100)]  # read in parallel
    assert all(not n.startswith("_") for n in os.listdir(folder.folder))


def test_half_written_batch_is_not_there(spark, scratch, monkeypatch):
    """Neither for readers nor for a compaction; after the replay nothing is lost, and the left-over can be removed."""
    sink = pl.ChangeLogSink(SPEC, scratch)
    sink(batch(spark, [(0, 1, "c", "a"), (1, 2, "c", "b")]), 0)
    second = [(2, 2, "u", "b2"), (3, 3, "c", "c"), (4, 9, "c", None)]
    half_written(spark, sink, second, 1, monkeypatch)
    log = sink.log_table(spark)
    assert sorted(r.seq for r in log.rows().collect()) == [0, 1]
    assert not sink.dead_letter_table(spark).exists()
    assert cli.compact_table(spark, scratch, "Customers") == 0
    assert state(spark, scratch) == [(1, 0), (2, 1)]
    assert log.vacuum() == []                                # a batch without a commit may still be written
    sink(batch(spark, second), 1)                            # the replay
    want = [(1, 0), (2, 2), (3, 3)]
    assert state(spark, scratch) == want
    assert cli.compact_table(spark, scratch, "Customers") == 1
    assert state(spark, scratch) == want
    assert [r.offset for r in sink.dead_letter_table(spark).read().collect()] == [4]
    left = os.listdir(log.path + "/batch_id=1")
    assert len(left) == 1 and left[0] == "attempt=" + log.commits.get(1)["attempt"]  # compaction removed the first attempt
    full = sorted((r.CustomerID, r.seq) for r in changes.current_state(
        log.rows().withColumnRenamed("ts_ms", "ts"), "CustomerID", COLS).collect())
    assert full == want


def test_replay_beside_a_reader(spark, scratch):
    """A committed batch is not written again: a reader that has listed the files goes on."""
    sink = pl.ChangeLogSink(SPEC, scratch)
    rows = [(0, 1, "c", "a"), (1, 2, "c", "b"), (2, 1, "d", "a"), (3, 5, "c", None)]
    sink(batch(spark, rows), 0)
    counts, log = sink.last_counts, sink.log_table(spark)
    reading = log.rows()
    files = set(reading.inputFiles())
    sink.last_counts = {}
    sink(batch(spark, rows), 0)
    assert sink.last_counts == counts == {"batch_id": 0, "c": 2, "u": 0, "d": 1, "r": 0}
    assert reading.count() == 3 and set(log.rows().inputFiles()) == files
    assert sink.dead_letter_table(spark).read().count() == 1


def test_dead_letters_are_unique_after_a_rejoin(spark, scratch):
    rows = [(0, 1, "c", "a"), (1, 2, "c", None), (2, 2, "c", None), (3, 3, "c", "b")]
    for n, first in ((0, 0), (1, 2)):
        sink = pl.ChangeLogSink(SPEC, scratch, checkpoint=f"chk{n}")
        log = sink.log_table(spark)
        sink.first_batch = log.join_stream(f"chk{n}", rejoin=True)
        assert sink.first_batch == first
        for k, part in enumerate((rows[:2], rows[2:]) if n == 0 else (rows,)):
            sink(batch(spark, part), k)
    assert sorted((r.offset, r.batch_id) for r in sink.dead_letter_table(spark).read().collect()) == [(1, 0), (2, 1)]
    assert sorted(r.seq for r in log.rows().collect()) == [0, 3]


def test_older_stream_is_closed(spark, scratch):
    """Once a new stream is registered the old one can neither start nor commit: no batch id is used twice."""
    old = pl.ChangeLogSink(SPEC, scratch, checkpoint="old")
    old.first_batch = old.log_table(spark).join_stream("old")
    old(batch(spark, [(0, 1, "c", "a")]), 0)
    new = pl.ChangeLogSink(SPEC, scratch, checkpoint="new")
    new.first_batch = new.log_table(spark).join_stream("new", rejoin=True)
    with pytest.raises(CheckpointError):
        old(batch(spark, [(1, 1, "u", "b")]), 1)
    new(batch(spark, [(0, 1, "c", "a"), (1, 1, "u", "b")]), 0)
    assert sorted(r.seq for r in new.log_table(spark).rows().collect()) == [0, 1]


def test_key_filter_reaches_the_scan_after_a_rejoin(spark, scratch):
    for n in range(2):
        sink = pl.ChangeLogSink(SPEC, scratch, checkpoint=f"chk{n}")
        sink.first_batch = sink.log_table(spark).join_stream(f"chk{n}", rejoin=True)
        sink(batch(spark, [(k, k % 5, "c" if k < 5 else "u", f"v{k}") for k in range(20)]), 0)
    log = sink.log_table(spark)
    one = history_view(spark, log, SnapshotStore(spark, scratch, "Customers_history"), "CustomerID", COLS, value=3)
    assert "EqualTo(CustomerID,3)" in one._jdf.queryExecution().sparkPlan().toString()
    assert [r.Name for r in one.orderBy("valid_from").collect()] == ["v3", "v8", "v13", "v18"]
    compact_history(spark, log, SnapshotStore(spark, scratch, "Customers_history"), "CustomerID", COLS, 0)
    tail = log.rows(0)                                       # the newest stream's batches alone: nothing to make unique
    assert "Aggregate" not in tail._jdf.queryExecution().optimizedPlan().toString()
    assert log.several_streams(None, None) and not log.several_streams(0, None)
    again = history_view(spark, log, SnapshotStore(spark, scratch, "Customers_history"), "CustomerID", COLS)
    assert again.count() == 20


# ------------------------------------------------------------ levelled snapshots
class Batches:
    """A committed log held in a frame (what a store reads of a change log)."""

    def __init__(self, df):
        self.df = df.cache()
        self.n = {r.batch_id: r["count"] for r in self.df.groupBy("batch_id").count().collect()}

    def rows(self, after=None, upto=None, where=None):
        df = self.df
        for cond in ([] if after is None else [F.col("batch_id") > after]) + (
                [] if upto is None else [F.col("batch_id") <= upto]) + ([] if where is None else [where]):
            df = df.where(cond)
        return df

    def rows_in(self, after=None, upto=None):
        return sum(n for b, n in self.n.items() if (after is None or b > after) and (upto is None or b <= upto))


@pytest.fixture(scope="module")
def batches(spark):
    """Nine batches of 400 changes of 600 keys, late ones, deletes and a key with a third of the rows."""
    rows = spark.range(3600).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(600))).cast("int").alias("k"),
        F.col("id").alias("seq"), (F.col("id") - F.when(F.col("id") % 11 == 0, 900).otherwise(0)).alias("ts_ms"),
        F.when(F.col("id") % 13 == 0, "d").otherwise("u").alias("op"), F.concat(F.lit("v"), "id").alias("v"),
        F.floor(F.col("id") / 400).cast("long").alias("batch_id"))
    return Batches(rows)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def disk_rows(spark, store):
    runs = [f for f in os.listdir(store.base) if f.startswith("run=")]
    return {f[4:]: {int(b[7:]) for b in os.listdir(f"{store.base}/{f}") if b.startswith("bucket=")} for f in runs}


def test_levels_rewrite_a_bounded_share_and_equal_the_log(spark, scratch, batches):
    state_ = SnapshotStore(spark, scratch, "t", buckets=4, fan=3, rows_per_file=300)
    hist = SnapshotStore(spark, scratch, "t_history", buckets=4, fan=3, rows_per_file=300)
    wrote, largest = 0, []
    real = SnapshotStore._write_run

    def counting(self, rows, key, level, at_most):
        made = real(self, rows, key, level, at_most)
        if self is hist:
            nonlocal wrote
            wrote += sum(s["rows"] for s in made)
            largest.append((level, sum(s["rows"] for s in made)))
        return made

    SnapshotStore._write_run = counting
    try:
        for upto in range(9):
            compact_history(spark, batches, hist, "k", ["v"], upto)
            if upto in (0, 4, 8):
                compact_log(spark, batches, state_, "k", ["v"], upto)
            if upto in (0, 3, 7):
                full = changes.scd2_history(batches.rows(), "k", ["v"], ("ts_ms", "seq"), ts="ts_ms")
                assert as_rows(history_view(spark, batches, hist, "k", ["v"])) == as_rows(full)
                now = changes.current_state(batches.rows(), "k", ["v"], ("ts_ms", "seq"))
                view = current_view(spark, batches, state_, "k", ["v"])
                assert as_rows(view.select(*now.columns)) == as_rows(now)
    finally:
        SnapshotStore._write_run = real
    levels = max(s["level"] for s in hist.segments())
    assert levels == 2 and wrote <= 3600 * (levels + 1)      # every change at most once per level
    assert [n for level, n in largest if level == 2] == [3600]
    assert sum(s["rows"] for s in hist.segments()) == 3600
    # Kept versions only, and no segment that none of them names.
    assert hist.versions() == [7, 8]
    named = {(s["run"], s["bucket"]) for _, r in hist.manifests.read(hist.manifests.numbers()) for s in r["segments"]}
    assert {(r, b) for r, own in disk_rows(spark, hist).items() for b in own} == named
    # A key's files: those of its bucket that can hold it, and the history of one key from them.
    all_files = hist.read(hist.segments()).inputFiles()
    for k in (7, 11, 250):
        files = hist.files_for(k)
        holds = hist.read(hist.segments()).where(F.col("k") == k).select(F.input_file_name()).distinct().count()
        assert holds <= len(files) <= holds + 1
        one = history_view(spark, batches, hist, "k", ["v"], value=k)
        assert set(one.inputFiles()) <= {*files, *one.inputFiles()} and one.count() == full.where(F.col("k") == k).count()
    assert len(hist.files_for(11)) < len(all_files) / 3
    assert len({f for f in hist.files_for(7)}) > 1           # the frequent key is cut over files
    assert hist.files_for(100_000) == [] and history_view(spark, batches, hist, "k", ["v"], value=100_000).count() == 0
    one = current_view(spark, batches, state_, "k", ["v"], value=11)
    assert as_rows(one) == as_rows(current_view(spark, batches, state_, "k", ["v"]).where(F.col("k") == 11).select(*one.columns))


def test_a_small_tail_leaves_other_buckets_alone(spark, scratch):
    schema = "k int, seq long, ts_ms long, op string, v string, batch_id long"
    first = spark.range(200).selectExpr("int(id) AS k", "id AS seq", "id AS ts_ms", "'c' AS op", "'a' AS v", "0L AS batch_id")
    later = spark.createDataFrame([(5, 1000 + n, 1000 + n, "u", f"b{n}", n + 1) for n in range(4)], schema)
    log = Batches(first.unionByName(later))
    store = SnapshotStore(spark, scratch, "t", buckets=4, fan=3)
    compact_log(spark, log, store, "k", ["v"], 0)
    before = {s["bucket"]: s["run"] for s in store.segments()}
    for upto in range(1, 5):
        compact_log(spark, log, store, "k", ["v"], upto)
    (own,) = {s["bucket"] for s in store.segments() if s["run"] not in before.values()}
    assert {s["bucket"]: s["run"] for s in store.segments() if s["bucket"] != own} == {
        b: r for b, r in before.items() if b != own}
    assert current_view(spark, log, store, "k", ["v"], value=5).first()["v"] == "b3"


def test_tombstones_are_purged_from_whole_buckets_only(spark, scratch):
    schema = "k int, seq long, ts_ms long, op string, v string, batch_id long"
    rows = [(1, 0, 0, "c", "a", 0), (2, 1, 1, "c", "b", 0), (1, 2, 2, "d", None, 1), (2, 3, 3, "u", "b2", 2)]
    log = Batches(spark.createDataFrame(rows, schema))
    store = SnapshotStore(spark, scratch, "t", buckets=1, fan=3)
    for upto in range(3):
        compact_log(spark, log, store, "k", ["v"], upto, purge_before=100)
        assert as_rows(current_view(spark, log, store, "k", ["v"]).select("k", "v")) == [(2, "b2")]
    assert as_rows(store.read(store.segments()).select("k", "op")) == [(2, "u")]


def test_two_compactions_cannot_both_publish(spark, scratch, batches):
    store = SnapshotStore(spark, scratch, "t", buckets=2)
    rival = SnapshotStore(spark, scratch, "t", buckets=2)
    real = store._write_run

    def slow(*a):
        compact_log(spark, batches, rival, "k", ["v"], 0)
        store._write_run = real
        return real(*a)

    store._write_run = slow
    with pytest.raises(CompactionConflict):
        compact_log(spark, batches, store, "k", ["v"], 1)
    assert store.latest() == 0
    compact_log(spark, batches, store, "k", ["v"], 1)
    assert store.latest() == 1


def test_index_has_no_false_negatives(spark, scratch):
    """Every key is found in its file, by its number as int or long; absent keys seldom pass."""
    df = spark.range(40_000).selectExpr("id * 3 AS k").repartition(4)
    df.write.parquet(scratch + "/t")
    t = spark.read.parquet(scratch + "/t")
    keyindex.file_index(t, "k").write.parquet(scratch + "/i")
    index = spark.read.parquet(scratch + "/i")
    assert index.schema["bits"].dataType == T.BinaryType() and index.select("file").distinct().count() == 4
    for value in (0, 3, 59_997, 119_997):
        (home,) = t.where(F.col("k") == value).select(F.col("_metadata.file_path").alias("f")).collect()
        assert home.f in [r.file for r in keyindex.may_hold(index, value).collect()]
    absent = sum(keyindex.may_hold(index, v).count() for v in range(1, 120_000, 3001) if v % 3)
    assert absent <= 8                                       # of about 110 file tests


def written_batches(spark, lake, first, n, rows=1):
    """``n`` committed batches of ``rows`` changes each, as the sink lays them out, and one that is not committed."""
    log = ChangeLog(spark, lake, SPEC.name, SPEC.log_schema)
    df = spark.range(first * rows, (first + n + 1) * rows).select(
        (F.col("id") % 7).cast("int").alias("CustomerID"), F.col("id").alias("seq"), F.col("id").alias("ts_ms"),
        F.lit("u").alias("op"), F.concat(F.lit("n"), "id").alias("Name"), F.lit("customers").alias("topic"),
        F.lit(0).alias("partition"), F.floor(F.col("id") / rows).alias("batch_id")).withColumn(
        "attempt", F.when(F.col("batch_id") < first + n, "a").otherwise("b"))
    df.coalesce(1).write.mode("append").partitionBy("batch_id", "attempt").parquet(log.path)
    for b in range(first, first + n):
        log.commits.put(b, {"attempt": "a", "rows": {"log": rows, "dead_letter": 0}, "ops": {}, "checkpoint": None})
    return log


def rows_of(df):
    return sorted((r.seq, r.CustomerID, r.Name, r.batch_id) for r in df.collect())


def test_small_batches_are_packed(spark, scratch):
    log = written_batches(spark, scratch, 0, 120)
    want = rows_of(log.rows())
    assert len(want) == 120 and len(log.paths()) == 120
    before = log.rows()                                        # a reader that planned before the pack
    made = log.pack(rows=50, least=16)
    assert [(b["first"], b["last"], b["rows"]) for b in made] == [(0, 49, 50), (50, 99, 50), (100, 118, 19)]
    assert rows_of(log.rows()) == want and rows_of(before) == want
    assert len(log.paths()) == 4                               # three bins and the newest batch
    # Only bins that overlap the batches asked for are opened; the tail opens none.
    assert len(log.paths(after=99)) == 2 and len(log.paths(after=118)) == 1 and len(log.paths(after=49, upto=60)) == 1
    assert rows_of(log.rows(after=70, upto=110)) == want[71:111]
    assert log.rows_in(after=118) == 1 and log.rows_in() == 120
    assert log.pack(rows=50, least=16) == [] and log.replayed(3, None)["attempt"] == "a"
    # Later batches: the small bin is packed again with them, full ones are left; what the first pack replaced goes.
    written_batches(spark, scratch, 120, 40)
    held = log.rows()
    again = log.pack(rows=50, least=16)
    assert [(b["first"], b["last"]) for b in again] == [(100, 149), (150, 158)]
    assert [b["path"] for b in log.packed()[1]][:2] == [b["path"] for b in made[:2]]
    assert not os.path.exists(log.attempt_path(7, "a")) and os.path.exists(made[2]["path"])
    assert len(rows_of(held)) == 160 and rows_of(log.rows()) == rows_of(held)
    files = [f for b in log.packed()[1] for f in os.listdir(b["path"]) if f.endswith(".parquet")]
    assert len(files) == 4                                     # one file per bin


def test_large_batches_stay_and_a_failed_pack_changes_nothing(spark, scratch, monkeypatch):
    log = written_batches(spark, scratch, 0, 4, rows=40)
    with monkeypatch.context() as m:
        m.setattr(RecordFolder, "put", lambda *a: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            log.pack(rows=1000, least=2)
    assert len(log.paths()) == 4 and log.packed() == (None, [])
    want = rows_of(log.rows())
    assert log.pack(rows=60, least=2) == []                    # 40 rows are more than half a file
    assert [b["path"] for b in log.packed()[1]] == [log.attempt_path(n, "a") for n in range(3)]
    assert rows_of(log.rows()) == want
    assert not os.path.exists(f"{log.path}_bins") or os.listdir(f"{log.path}_bins") == []


def test_compaction_packs_and_views_hold(spark, scratch):
    log = written_batches(spark, scratch, 0, 30)
    want = sorted((r.CustomerID, r.seq) for r in cli.current_table(spark, scratch, SPEC.name).collect())
    assert cli.compact_table(spark, scratch, SPEC.name) == 29
    assert log.packed()[0] == 28 and len(log.paths()) == 2
    assert state(spark, scratch) == want
    written_batches(spark, scratch, 30, 3)
    assert state(spark, scratch) == sorted((k, max(i for i in range(33) if i % 7 == k)) for k in range(7))
    assert cli.history_table(spark, scratch, SPEC.name, 3).count() == len([i for i in range(33) if i % 7 == 3])
