"""Eager SCD1 through Delta Lake ``MERGE`` (optional: needs delta-spark).

Same semantics as the change-log views: one row per key holding its last
change; a row is replaced only by a newer change ``(ts_ms, seq)``, so a
replayed or late batch cannot move it back; deletes stay as tombstone rows
(``op = 'd'``) that readers filter out, so a late older change cannot revive
a deleted key.  The batch is reduced to one row per key before the MERGE,
which Delta requires and which keeps the MERGE join to one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdc_lake.functions import envelope as env
from cdc_lake.operators import changes


def _delta():
    try:
        from delta.tables import DeltaTable
    except ImportError as e:  # pragma: no cover - depends on the cluster image
        raise RuntimeError("delta-spark is not installed on this cluster") from e
    return DeltaTable


def merge_latest(spark: SparkSession, path: str, log_batch: DataFrame, key: str, cols: list[str],
                 order=("ts_ms", "seq")) -> None:
    DeltaTable = _delta()
    last = changes.latest_per_key(log_batch, key, cols, order)
    if not DeltaTable.isDeltaTable(spark, path):
        last.write.format("delta").mode("append").save(path)
        return
    a, b = order
    newer = f"s.{a} > t.{a} OR (s.{a} = t.{a} AND s.{b} > t.{b})"
    (DeltaTable.forPath(spark, path).alias("t")
     .merge(last.alias("s"), f"t.{key} = s.{key}")
     .whenMatchedUpdateAll(condition=newer)
     .whenNotMatchedInsertAll()
     .execute())


def read_current(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("delta").load(path).where(F.col("op") != env.OP_DELETE)


class DeltaMergeSink:
    """``foreachBatch`` function: parse, then MERGE the batch into ``path``."""

    def __init__(self, spec, path: str):
        self.spec, self.path = spec, path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        s = self.spec
        parsed = env.parse_messages(batch, s.row_schema)
        log = env.to_change_log(parsed, s.pk, s.row_cols, ns_timestamps=s.ns_timestamps)
        merge_latest(batch.sparkSession, self.path, log, s.pk, [c for c in s.row_cols if c != s.pk])
