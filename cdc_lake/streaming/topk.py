"""The k best products by name, kept from deltas with work bounded by what a trigger touches.

*Totals* are rows (product, quantity) in a fixed number of buckets by a hash of the
product.  A trigger reads and writes the buckets that its deltas fall into and no
others; the rest are named again by the next version as they are.

*Bounds.*  A version keeps the largest total of every bucket.  The total of a name
is at most the sum of its products' bounds, which the product table and the bounds
give without a look at the totals (threshold algorithm): the exact totals of ``k``
names from the buckets with the largest bounds give a floor, and only buckets with
products of names whose bound reaches the floor are opened.  Names are joined when
the version is made, so renamed products and equal names count right.

*Versions.*  A version is one record (:mod:`cdc_lake.sources.records`): the folder
of the served rows, and folder and bound of every bucket.  It is put after all
files are written, so readers have the old version or the new one, never none.
The last ``keep`` versions stay readable; files that only older ones named are
deleted.  A batch that is in the newest version already (a replay) writes nothing;
a stream with another id starts from empty totals, as its state does.

Cases: totals of 0 count as no row; products without a name, or without a row, are
not ranked; equal totals go by name; fewer than ``k`` names give fewer rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdc_lake.sources.lake import LakeTable
from cdc_lake.sources.records import RecordFolder

TOTALS = "bucket int, product long, quantity long"
TOP = "name string, quantity long, batch_id long"


class RankedTotals:
    """Totals and served rows below ``<out>_totals`` and ``<out>``, their versions in ``<out>_versions``."""

    def __init__(self, spark: SparkSession, out: str, k: int = 10, buckets: int = 256, keep: int = 2):
        self.spark, self.out, self.k, self.buckets, self.keep = spark, out.rstrip("/"), k, buckets, keep
        self.records = RecordFolder(spark, f"{self.out}_versions")

    # -------------------------------------------------------------- versions
    def latest(self) -> tuple[int, dict | None]:
        """(number, record) of the newest version; (-1, None) without any."""
        numbers = self.records.numbers()
        return (numbers[-1], self.records.get(numbers[-1])) if numbers else (-1, None)

    def served(self) -> DataFrame:
        """name, quantity and batch_id of the newest version; empty before the first."""
        _, record = self.latest()
        if record is None:
            return self.spark.createDataFrame([], TOP)
        return self.spark.read.schema(TOP).parquet(record["served"])

    def _bucket(self, product: str) -> Column:
        return F.pmod(F.xxhash64(F.col(product)), F.lit(self.buckets)).cast("int")

    def _totals(self, state: dict, wanted: set[int]) -> DataFrame:
        """The stored rows of the ``wanted`` buckets; no other file is opened."""
        paths = [path for b, (path, _) in state.items() if int(b) in wanted]
        return self.spark.read.schema("product long, quantity long").parquet(*paths) if paths else \
            self.spark.createDataFrame([], "product long, quantity long")

    # ---------------------------------------------------------------- totals
    def _apply(self, state: dict, deltas: DataFrame) -> dict:
        """The buckets after ``deltas`` (product, delta: one row per product); untouched ones as they are."""
        deltas = deltas.withColumn("bucket", self._bucket("product"))
        touched = {r.bucket for r in deltas.select("bucket").distinct().collect()}  # at most ``buckets`` numbers
        if not touched:
            return state
        rows = self._totals(state, touched).withColumn("bucket", self._bucket("product")).unionByName(
            deltas.select("product", F.col("delta").alias("quantity"), "bucket"))
        path = f"{self.out}_totals/{uuid.uuid4().hex}"
        # Sums per (bucket, product) reuse the partitioning by bucket.
        (rows.repartition("bucket").groupBy("bucket", "product").agg(F.sum("quantity").cast("long").alias("quantity"))
         .where("quantity <> 0").write.partitionBy("bucket").parquet(path))
        most = self.spark.read.schema(TOTALS).parquet(path).groupBy("bucket").agg(F.max("quantity").alias("most")).collect()
        return {b: v for b, v in state.items() if int(b) not in touched} | {
            str(r.bucket): [f"{path}/bucket={r.bucket}", r.most] for r in most}

    # --------------------------------------------------------------- ranking
    def _buckets_of(self, names: DataFrame, some: DataFrame) -> set[int]:
        """Buckets of the products of the names in ``some``."""
        return {r.bucket for r in names.join(some.select("name"), "name", "left_semi").select("bucket").distinct().collect()}

    def _exact(self, state: dict, names: DataFrame, some: DataFrame | None, opened: set[int]) -> DataFrame:
        """(name, quantity) of the names in ``some`` (None: all), whose products lie in the ``opened`` buckets."""
        own = names if some is None else names.join(some.select("name"), "name", "left_semi")
        return self._totals(state, opened).join(own, "product").groupBy("name").agg(
            F.sum("quantity").cast("long").alias("quantity"))

    def _best(self, rows: DataFrame) -> DataFrame:
        return rows.orderBy(F.col("quantity").desc(), F.col("name").asc()).limit(self.k)

    def top(self, state: dict, names: DataFrame) -> tuple[DataFrame, set[int]]:
        """The ``k`` best (name, quantity) by the buckets ``state``, and the buckets opened for them.  ``names``:
        product, name."""
        names = names.where(F.col("name").isNotNull() & F.col("product").isNotNull()).select(
            "product", "name", self._bucket("product").alias("bucket"))
        bounds = {int(b): most for b, (_, most) in state.items()}
        full = sorted(bounds, key=lambda b: (-bounds[b], b))
        # k names that look best in the buckets with the largest bounds; their exact totals give the floor.
        first = set(full[:self.k])
        heads = self._best(self._exact(state, names, None, first)).collect()  # k rows
        every, asked = set(bounds), set(bounds)
        if len(heads) == self.k:
            heads = self.spark.createDataFrame([(r.name,) for r in heads], "name string")
            asked = self._buckets_of(names, heads) & every
            floor = min(r.quantity for r in self._exact(state, names, heads, asked).collect())  # k rows
            bound = F.coalesce(F.element_at(F.lit([max(bounds.get(b, 0), 0) for b in range(self.buckets)]).cast("array<long>"),
                                            F.col("bucket") + 1), F.lit(0))
            able = names.groupBy("name").agg(F.sum(bound).alias("most")).where(F.col("most") >= floor)
            asked = self._buckets_of(names, able) & every
            return self._best(self._exact(state, names, able, asked)), first | asked
        return self._best(self._exact(state, names, None, every)), every

    # ----------------------------------------------------------------- apply
    def apply(self, stream: str, batch: int, deltas: DataFrame, names: DataFrame) -> dict | None:
        """Make the version of batch number ``batch`` of ``stream``; None when a version has the batch already."""
        number, before = self.latest()
        if before is not None and before["stream"] == stream and before["batch"] >= batch:
            return None
        state = before["buckets"] if before is not None and before["stream"] == stream else {}
        deltas = deltas.groupBy("product").agg(F.sum("delta").cast("long").alias("delta")).where(
            "product IS NOT NULL AND delta <> 0").persist()
        try:
            state = self._apply(state, deltas)
        finally:
            deltas.unpersist()
        rows, opened = self.top(state, names)
        served = f"{self.out}/{uuid.uuid4().hex}"
        rows.withColumn("batch_id", F.lit(batch).cast("long")).coalesce(1).write.parquet(served)
        record = {"stream": stream, "batch": batch, "served": served, "buckets": state, "opened": sorted(opened)}
        if not self.records.put(number + 1, record):
            raise RuntimeError(f"another writer made version {number + 1} of {self.out}")
        self._retire()
        return record

    def _retire(self) -> None:
        """Forget all but the last ``keep`` versions and delete what only those before named."""
        numbers = self.records.numbers()
        old = [r for _, r in self.records.read(numbers[:-self.keep])]
        if not old:
            return
        named = set()
        for _, r in self.records.read(numbers[-self.keep:]):
            named |= {r["served"], *[path for path, _ in r["buckets"].values()]}
        path, fs = LakeTable(self.spark, self.out.rpartition("/")[0] or "/", self.out.rpartition("/")[2])._fs()
        self.records.drop(numbers[:-self.keep])  # first the records, so that none names a deleted file
        for r in old:
            for gone in {r["served"], *[p for p, _ in r["buckets"].values()]} - named:
                fs.delete(path(gone), True)


class TopKWriter:
    """``foreachBatch`` over product deltas (product, delta): the next version of ``out``, with names from ``products``."""

    def __init__(self, products: Callable[[SparkSession], DataFrame], out: str, k: int = 10,
                 product_key: str = "ProductID", name: str = "Name", buckets: int = 256):
        self.products, self.out, self.k, self.buckets = products, out, k, buckets
        self.product_key, self.name = product_key, name

    def __call__(self, deltas: DataFrame, batch_id: int) -> None:
        spark = deltas.sparkSession
        # The id that the checkpoint gives to a streaming query.
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        names = self.products(spark).select(F.col(self.product_key).cast("long").alias("product"),
                                            F.col(self.name).alias("name"))
        RankedTotals(spark, self.out, self.k, self.buckets).apply(stream, batch_id, deltas, names)
