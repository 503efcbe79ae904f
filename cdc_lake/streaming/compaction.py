"""Compaction of a change log into levelled snapshots.

Reading the current state or the history from the whole log costs a pass over
every change ever made.  A snapshot store folds the log's batches once, and
then rewrites only what has grown:

* Rows belong to one of ``buckets`` by a hash of their key.  A compaction folds the
  batches after the newest version into one *run* at level 0, clustered by
  ``(bucket, key, order)``: a range partitioning, so a key with a third of the rows is
  cut over several files.  A run has a *segment* per bucket it touches.
* When a bucket has ``fan`` segments on a level, those are folded into one segment on
  the next level; the other buckets and levels are not read.  A row is thus
  written at most once per level, and levels grow with the logarithm of the
  number of compactions, whatever the size of the table.
* A *version* is one manifest record: the newest folded batch and the segments in
  force (:mod:`cdc_lake.sources.records`: whole or not there).  Readers take the
  newest; a failed compaction leaves none and the old version stays.  Two
  compactions at a time cannot both publish.  After publishing, versions beyond
  the last ``keep`` are dropped, with the segments that no kept one names.
* Every run has a sidecar index (:mod:`cdc_lake.streaming.keyindex`), so a
  question about one key opens the files of its bucket that can hold it.

A reader folds the largest segment of every bucket with the smaller ones and the
log after the version: rows of keys that only the large segments hold pass an anti
join and are not shuffled (:func:`changes.compact`, :func:`changes.scd2_extend`).
Compaction follows the log's commits, so it never folds half a batch.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdc_lake.operators import changes
from cdc_lake.operators.sequence import HotSplit
from cdc_lake.sources.lake import table_path
from cdc_lake.sources.records import RecordFolder
from cdc_lake.streaming import keyindex
from cdc_lake.streaming.changelog import ChangeLog

LOG_ORDER = ("ts_ms", "seq")
BUCKETS = 64
FAN = 4
KEEP = 2
ROWS_PER_FILE = 2_000_000

#: One segment of a version: a run's rows of one bucket.
Segment = dict


class CompactionConflict(RuntimeError):
    """Another compaction published a version at the same time."""


class SnapshotStore:
    """Levelled snapshots at ``<root>/<name>_snapshot``."""

    def __init__(self, spark: SparkSession, root: str, name: str, buckets: int = BUCKETS, fan: int = FAN, keep: int = KEEP,
                 rows_per_file: int = ROWS_PER_FILE):
        self.spark = spark
        self.base = table_path(root, f"{name}_snapshot")
        self.buckets, self.fan, self.keep, self.rows_per_file = buckets, fan, keep, rows_per_file
        self.manifests = RecordFolder(spark, f"{self.base}/manifests")

    # ----------------------------------------------------------- versions
    def manifest(self) -> tuple[int, dict] | None:
        """(number, record) of the version in force."""
        numbers = self.manifests.numbers()
        return (numbers[-1], self.manifests.get(numbers[-1])) if numbers else None

    def versions(self) -> list[int]:
        """Newest folded batch of the kept versions, oldest first."""
        return [r["upto"] for _, r in self.manifests.read(self.manifests.numbers())]

    def latest(self) -> int | None:
        m = self.manifest()
        return m[1]["upto"] if m else None

    def segments(self) -> list[Segment]:
        m = self.manifest()
        return m[1]["segments"] if m else []

    # -------------------------------------------------------------- files
    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path, path(self.base).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, s: Segment) -> str:
        return f"{self.base}/run={s['run']}/bucket={s['bucket']}"

    def read(self, segments: list[Segment]) -> DataFrame | None:
        """Rows of the segments; None without any."""
        paths = [self._folder(s) for s in segments]
        if not paths:
            return None
        return self.spark.read.option("basePath", self.base).parquet(*paths).drop("run", "bucket")

    def index(self, segments: list[Segment]) -> DataFrame | None:
        runs = sorted({s["run"] for s in segments})
        if not runs:
            return None
        return self.spark.read.option("basePath", f"{self.base}/index").parquet(*[f"{self.base}/index/run={r}" for r in runs])

    def files_for(self, value, segments: list[Segment] | None = None) -> list[str]:
        """Files of the version in force that can hold the key ``value``."""
        segments = self.segments() if segments is None else segments
        index = self.index(segments)
        if index is None:
            return []
        live = {(s["run"], s["bucket"]) for s in segments}
        own = F.pmod(keyindex.key_hash(F.lit(value), 0), F.lit(self._buckets()))
        found = keyindex.may_hold(index.where(F.col("bucket") == own), value).select("run", "bucket", "file").collect()
        return sorted(r.file for r in found if (r.run, r.bucket) in live)

    def read_key(self, key: str, value) -> DataFrame | None:
        """Rows of one key, from the files that can hold it; None when no file can."""
        files = self.files_for(value)
        if not files:
            return None
        return self.spark.read.parquet(*files).where(F.col(key) == F.lit(value))

    def _buckets(self) -> int:
        m = self.manifest()
        return m[1]["buckets"] if m else self.buckets

    def _write_run(self, rows: DataFrame, key: str, level: int, at_most: int) -> list[Segment]:
        """``rows`` (at most so many) as a run; its segments."""
        run = uuid.uuid4().hex
        bucket = F.pmod(keyindex.key_hash(F.col(key), 0), F.lit(self._buckets())).cast("int")
        order = [c for c in LOG_ORDER if c in rows.columns]
        parts = max(1, -(-at_most // self.rows_per_file))
        rows = rows.withColumn("bucket", bucket)
        if parts > 1:
            rows = rows.repartitionByRange(parts, "bucket", key, *order)
        else:
            rows = rows.repartition(1)
        path = f"{self.base}/run={run}"
        rows.sortWithinPartitions("bucket", key, *order).write.partitionBy("bucket").parquet(path)
        index = f"{self.base}/index/run={run}"
        keyindex.file_index(self.spark.read.parquet(path), key, ("bucket",)).coalesce(1).write.parquet(index)
        per = self.spark.read.parquet(index).dropDuplicates(["file"]).groupBy("bucket").agg(F.sum("rows").alias("rows"))
        to_path, fs = self._fs()
        return [{"run": run, "bucket": r.bucket, "level": level, "rows": r.rows,
                 "bytes": fs.getContentSummary(to_path(f"{path}/bucket={r.bucket}")).getLength()}
                for r in sorted(per.collect(), key=lambda r: r.bucket)]  # at most ``buckets`` rows

    # --------------------------------------------------------- compaction
    def add(self, tail: DataFrame, tail_rows: int, upto: int, key: str, fold: Callable[[DataFrame], DataFrame],
            drop: Callable[[DataFrame], DataFrame] | None = None,
            fold_tail: Callable[[DataFrame], DataFrame] | None = None) -> list[Segment]:
        """Publish a version with ``tail`` (the batches up to ``upto`` that are not in yet) folded in; returns the segments
        it wrote.  ``fold`` folds the rows of whole segments (``fold_tail`` those of the log, where that differs); ``drop``
        may remove rows once a bucket is one segment."""
        old = self.manifest()
        number, segments = (old[0] + 1, list(old[1]["segments"])) if old else (0, [])
        wrote: list[Segment] = []
        if tail_rows:
            wrote = self._write_run((fold_tail or fold)(tail), key, 0, tail_rows)
        segments += wrote
        level = 0
        while True:
            by = defaultdict(list)
            for s in segments:
                if s["level"] == level:
                    by[s["bucket"]].append(s)
            due = [s for own in by.values() if len(own) >= self.fan for s in own]
            if due:
                rows = fold(self.read(due))
                if drop is not None:
                    per = defaultdict(int)
                    for s in segments:
                        per[s["bucket"]] += 1
                    for s in due:
                        per[s["bucket"]] -= 1
                    whole = [b for b in {s["bucket"] for s in due} if not per[b]]
                    own = F.pmod(keyindex.key_hash(F.col(key), 0), F.lit(self._buckets()))
                    kept = drop(rows).where(own.isin(whole))
                    rows = kept.unionByName(rows.where(~own.isin(whole)))
                merged = self._write_run(rows, key, level + 1, sum(s["rows"] for s in due))
                gone = {(s["run"], s["bucket"]) for s in due}
                segments = [s for s in segments if (s["run"], s["bucket"]) not in gone] + merged
                wrote += merged
            level += 1
            if level > max((s["level"] for s in segments), default=0):
                break
        if not self.manifests.put(number, {"upto": upto, "buckets": self._buckets(), "segments": segments}):
            self._delete(wrote, set())
            raise CompactionConflict(f"another compaction of {self.base} published version {number}")
        self._delete(wrote, {(s["run"], s["bucket"]) for s in segments})  # those that were folded on at once
        self._expire()
        return wrote

    def _delete(self, segments: list[Segment], named: set[tuple[str, int]]) -> None:
        """Delete the files of the segments that are not ``named``, and of runs without a named segment all."""
        path, fs = self._fs()
        runs = {r for r, _ in named}
        for run, bucket in {(s["run"], s["bucket"]) for s in segments} - named:
            fs.delete(path(f"{self.base}/run={run}/bucket={bucket}"), True)
            if run not in runs:
                fs.delete(path(f"{self.base}/run={run}"), True)
                fs.delete(path(f"{self.base}/index/run={run}"), True)

    def _expire(self) -> None:
        """Drop all but the last ``keep`` versions, and the segments only they named."""
        numbers = self.manifests.numbers()
        old, kept = numbers[:-self.keep], numbers[-self.keep:]
        if not old:
            return
        named = {(s["run"], s["bucket"]) for _, r in self.manifests.read(kept) for s in r["segments"]}
        dropped = [s for _, r in self.manifests.read(old) for s in r["segments"]]
        self.manifests.drop(old)
        self._delete(dropped, named)

    def large_and_small(self) -> tuple[DataFrame | None, DataFrame | None, int | None]:
        """(rows of the largest segment of every bucket, rows of the others, newest folded batch)."""
        m = self.manifest()
        if m is None:
            return None, None, None
        best: dict[int, Segment] = {}
        for s in m[1]["segments"]:
            if s["bucket"] not in best or (s["level"], s["rows"]) > (best[s["bucket"]]["level"], best[s["bucket"]]["rows"]):
                best[s["bucket"]] = s
        large = {(s["run"], s["bucket"]) for s in best.values()}
        rest = [s for s in m[1]["segments"] if (s["run"], s["bucket"]) not in large]
        return self.read(list(best.values())), self.read(rest), m[1]["upto"]


def _both(*frames: DataFrame | None) -> DataFrame | None:
    have = [f for f in frames if f is not None]
    return reduce(DataFrame.unionByName, have) if have else None


def _tail_rows(log: ChangeLog, after: int | None, upto: int) -> int:
    """Rows of the batches, as their commits count them (bins that overlap them count whole)."""
    return log.rows_in(after, upto)


# ------------------------------------------------------------------ SCD1
def compact_log(spark: SparkSession, log: ChangeLog, store: SnapshotStore, key: str, cols: list[str],
                upto: int, purge_before: int | None = None) -> int:
    """Fold the log's committed batches up to ``upto`` into the store; returns the batch in force afterwards.
    ``purge_before`` (ts_ms) drops older tombstones from buckets that are folded whole."""
    prev = store.latest()
    if prev is not None and prev >= upto:
        return prev
    carry = [key, *[c for c in dict.fromkeys([*LOG_ORDER, "op", *cols]) if c != key]]

    def fold(rows: DataFrame) -> DataFrame:
        return changes.latest_per_key(rows.select(*carry), key, cols, LOG_ORDER)

    def purged(rows: DataFrame) -> DataFrame:
        return rows.where((F.col("op") != "d") | (F.col(LOG_ORDER[0]) >= purge_before))

    store.add(log.rows(prev, upto), _tail_rows(log, prev, upto), upto, key, fold, None if purge_before is None else purged)
    return upto


def current_view(spark: SparkSession, log: ChangeLog, store: SnapshotStore, key: str, cols: list[str],
                 value=None) -> DataFrame:
    """Current state = the store's version and the log after it, deletes applied.  With ``value``, that key's row only,
    from the files that can hold it."""
    carry = [key, *[c for c in dict.fromkeys([*LOG_ORDER, "op", *cols]) if c != key]]
    if value is not None:
        v = changes._int_key(key, value)
        rows = _both(store.read_key(key, v), log.rows(store.latest(), where=F.col(key) == F.lit(v)).select(*carry))
        return changes.latest_per_key(rows, key, cols, LOG_ORDER).where(F.col("op") != "d")
    large, small, upto = store.large_and_small()
    tail = _both(small, log.rows(upto).select(*carry))
    return changes.compact(large, tail, key, cols, LOG_ORDER).where(F.col("op") != "d")


# ------------------------------------------------------------------ SCD2
def _time_split(ts: str) -> HotSplit:
    """Keys with very many changes are split by event time, those of one and the same time by place in the topic."""
    return HotSplit(order_value=F.col(ts), tie=F.col("seq"))


def _history_rows(rows: DataFrame, key: str, cols: list[str], ts: str, bucket, unique: bool = False) -> DataFrame:
    """History rows (with ``valid_to``) of change rows, every change once (rows of the log alone are ``unique``)."""
    own = [key, *[c for c in dict.fromkeys([*LOG_ORDER, "op", *cols]) if c != key]]
    rows = rows.select(*own)
    rows = rows if unique else rows.dropDuplicates([key, *LOG_ORDER, "op"])
    return changes.scd2_rows(rows, key, cols, LOG_ORDER, ts, bucket)


def compact_history(spark: SparkSession, log: ChangeLog, store: SnapshotStore, key: str, cols: list[str],
                    upto: int, ts: str = "ts_ms") -> int:
    """Fold the log's committed batches up to ``upto`` into the history store; returns the batch in force afterwards."""
    prev = store.latest()
    if prev is not None and prev >= upto:
        return prev
    store.add(log.rows(prev, upto), _tail_rows(log, prev, upto), upto, key,
              lambda rows: _history_rows(rows, key, cols, ts, _time_split(ts)),
              fold_tail=lambda rows: _history_rows(rows, key, cols, ts, _time_split(ts), unique=True))
    return upto


def history_view(spark: SparkSession, log: ChangeLog, store: SnapshotStore, key: str, cols: list[str],
                 ts: str = "ts_ms", value=None) -> DataFrame:
    """SCD2 history = the store's version, extended with its smaller segments and the log after it.  With ``value``, the
    history of that key only: the store's files that can hold it, and a key filter in the scan of the log's tail."""
    own = [key, *[c for c in dict.fromkeys([*LOG_ORDER, "op", *cols]) if c != key]]
    if value is not None:
        v = changes._int_key(key, value)
        stored = store.read_key(key, v)
        tail = log.rows(store.latest(), where=F.col(key) == F.lit(v)).select(*own)
        rows = _history_rows(_both(None if stored is None else stored.select(*own), tail), key, cols, ts, None)
        return changes.scd2_versions(rows, key, cols, ts)
    large, small, upto = store.large_and_small()
    tail = _both(None if small is None else small.select(*own), log.rows(upto).select(*own))
    rows = (_history_rows(tail, key, cols, ts, _time_split(ts), unique=True) if large is None
            else changes.scd2_extend(large, tail, key, cols, LOG_ORDER, ts, _time_split(ts)))
    return changes.scd2_versions(rows, key, cols, ts)
