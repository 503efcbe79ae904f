"""Driver tables: one parquet file (or directory) per table under a scale-factor folder.

Reads are lazy and carry no schema inference beyond the parquet footer; every
operator selects the columns it needs, so Catalyst prunes the scan and pushes
filters into it (``ReadSchema`` / ``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


class Tables:
    """Lazy handle on the tables of one scale-factor folder.

    Each table is resolved once per handle: the first read lists its files
    and infers the schema from a parquet footer (a small Spark job), later
    uses reuse that DataFrame, as a session catalog reuses a table's
    relation.  :meth:`of` keeps one handle per session and folder;
    :meth:`refresh` forgets what was resolved after the files change.
    """

    _handles: dict[tuple[int, str], "Tables"] = {}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, root: str) -> "Tables":
        """The shared handle on ``root`` for this session."""
        k = (id(spark), root.rstrip("/"))
        h = cls._handles.get(k)
        if h is None or h.spark is not spark:
            h = cls._handles[k] = cls(spark, root)
        return h

    def refresh(self) -> None:
        self._frames.clear()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        df = self._frames.get(name)
        if df is None:
            df = self._frames[name] = self.spark.read.parquet(self.path(name))
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)

    def register_views(self, names=TABLES) -> None:
        """Expose the tables to ``spark.sql`` under their own names."""
        for n in names:
            self.read(n).createOrReplaceTempView(n)
