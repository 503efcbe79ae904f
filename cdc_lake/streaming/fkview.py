"""The counted foreign-key view, stored: counts and orphans as levelled sums of signed rows.

Both stores are :class:`~cdc_lake.streaming.compaction.SnapshotStore`\\ s whose fold
is a sum, so applying a batch appends its rows (one per touched key) and merges a
bucket only when it has grown.  Before that, the old counts of the touched keys
are read, from the buckets they fall into only, and what they change about the
orphans is appended to the orphan store; reading the orphans therefore reads
orphans, not counts.

A batch has a number.  The orphan store is published first, from counts in which
the batch is not in yet; a batch that is applied again after a failure skips what
is published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdc_lake.operators import fkcount
from cdc_lake.streaming import keyindex
from cdc_lake.streaming.compaction import SnapshotStore

#: The stores' key: foreign key and value as one text.
NAMED = "fk_key"


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn(NAMED, F.concat_ws(":", "fk_name", F.col("key").cast("string")))


class FkView:
    """Orphans of ``fks`` under ``<root>/<name>_fk_counts`` and ``<root>/<name>_fk_orphans``."""

    def __init__(self, spark: SparkSession, root: str, name: str, fks, buckets: int = 64, fan: int = 4):
        self.spark, self.fks = spark, list(fks)
        self.counts = SnapshotStore(spark, root, f"{name}_fk_counts", buckets, fan)
        self.orphans_ = SnapshotStore(spark, root, f"{name}_fk_orphans", buckets, fan)

    @staticmethod
    def _sum(cols) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: rows.groupBy(NAMED, *fkcount.KEYS).agg(*[F.sum(c).alias(c) for c in cols])

    @staticmethod
    def _nonzero(cols) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: rows.where(" OR ".join(f"{c} <> 0" for c in cols))

    def old_counts(self, deltas: DataFrame) -> DataFrame:
        """Counts of the touched keys, read from the buckets they fall into."""
        bucket = F.pmod(keyindex.key_hash(F.col(NAMED), 0), F.lit(self.counts._buckets()))
        touched = {r.b for r in deltas.select(bucket.alias("b")).distinct().collect()}  # at most ``buckets`` numbers
        rows = self.counts.read([s for s in self.counts.segments() if s["bucket"] in touched])
        if rows is None:
            return deltas.select(*fkcount.KEYS, *fkcount.COUNTS).limit(0)
        own = rows.join(deltas.select(NAMED), NAMED, "left_semi")
        return self._sum(fkcount.COUNTS)(own).select(*fkcount.KEYS, *fkcount.COUNTS)

    def apply(self, batch: int, inserted: dict[str, DataFrame], deleted: dict[str, DataFrame]) -> None:
        """Bring the view up to date with the rows that batch number ``batch`` inserted and deleted."""
        done = [-1 if s.latest() is None else s.latest() for s in (self.counts, self.orphans_)]
        if min(done) >= batch:
            return
        deltas = _keyed(fkcount.fk_deltas(inserted, deleted, self.fks)).persist()
        try:
            n = deltas.count()
            if done[1] < batch:
                changed = _keyed(fkcount.fk_orphan_changes(self.old_counts(deltas), deltas))
                self.orphans_.add(changed, n, batch, NAMED, self._sum(("n_rows",)), self._nonzero(("n_rows",)))
            if done[0] < batch:
                self.counts.add(deltas, n, batch, NAMED, self._sum(fkcount.COUNTS), self._nonzero(fkcount.COUNTS))
        finally:
            deltas.unpersist()

    def orphans(self) -> DataFrame:
        """(fk_name, child_key, n_rows), as :func:`quality.fk_orphans` gives them."""
        rows = self.orphans_.read(self.orphans_.segments())
        if rows is None:
            return self.spark.createDataFrame([], "fk_name string, child_key long, n_rows long")
        return self._sum(("n_rows",))(rows).where("n_rows <> 0").select(
            "fk_name", F.col("key").alias("child_key"), "n_rows")
