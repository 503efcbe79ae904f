"""Lake table handle: naming rule, existence test, tolerant read, idempotent writes.

A table lives at ``<lake root>/<lower-cased name>``.  The default format is
parquet; ``fmt="delta"`` works where the Delta jar is on the classpath.  The
change log is partitioned by ``batch_id`` and written with dynamic partition
overwrite: replaying a micro-batch of the same stream rewrites exactly its own
partition.  What makes rows unique across streams is their place in the topic
(:mod:`cdc_lake.streaming.changelog`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_path(root: str, name: str) -> str:
    """Naming rule: ``<root>/<lower-cased table name>``."""
    return f"{root.rstrip('/')}/{name.lower()}"


class LakeTable:
    def __init__(self, spark: SparkSession, root: str, name: str, fmt: str = "parquet"):
        self.spark = spark
        self.name = name
        self.path = table_path(root, name)
        self.fmt = fmt

    # -------------------------------------------------------------- reads
    def _fs(self):
        """(Hadoop Path class, file system of the table's path), any scheme."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        """True when the path holds a table: a Delta log, or at least one data file
        (a folder that a batch without valid rows left behind is no table)."""
        path, fs = self._fs()
        if not fs.exists(path(self.path)):
            return False
        if self.fmt == "delta":
            return fs.exists(path(self.path + "/_delta_log"))
        files = fs.listFiles(path(self.path), True)
        while files.hasNext():
            name = files.next().getPath().toString()[len(path(self.path).toString()):]
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                return True
        return False

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        r = self.spark.read.format(self.fmt)
        return (r.schema(schema) if schema is not None and self.fmt != "delta" else r).load(self.path)

    def read_or_empty(self, schema: T.StructType) -> DataFrame:
        """The table with its known schema, or an empty frame of it when there is no
        data yet.  Any other failure (corrupt files, permissions) is raised, not swallowed."""
        if not self.exists():
            return self.spark.createDataFrame([], schema)
        return self.read(schema)

    # ------------------------------------------------------------- writes
    def overwrite(self, df: DataFrame) -> None:
        df.write.format(self.fmt).mode("overwrite").save(self.path)

    def append(self, df: DataFrame) -> None:
        df.write.format(self.fmt).mode("append").save(self.path)

    def overwrite_partitions(self, df: DataFrame, by: str = "batch_id") -> None:
        """Replace only the partitions present in ``df`` (replay-safe append)."""
        (df.write.format(self.fmt).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(by).save(self.path))
