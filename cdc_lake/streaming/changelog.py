"""The change log of one table: what identifies its rows, which batches are in it, and which streams wrote it.

*Commits.*  A micro-batch writes its valid rows to
``<table>_log/batch_id=N/attempt=A`` and its rejected messages to
``<table>_dead_letter/batch_id=N/attempt=A``, A a new name each time.  When both
are written, one record ``<table>_commits/N`` names the attempt
(:mod:`cdc_lake.sources.records`: whole or not there, the first one wins).
Readers and compaction take the files of committed attempts only, by their
paths: a batch that is half written is not there yet, for both tables alike,
and a replay of a committed batch writes nothing, so no file that a reader may
hold is ever overwritten or deleted.  Attempts without a record are left-overs
of failed tasks or drivers; :meth:`ChangeLog.vacuum` removes them.

*Streams.*  A row is identified by its place in the topic: ``(topic, partition,
seq)``.  Within one streaming query Spark's checkpoint decides which messages
form micro-batch N.  A query that starts with a new checkpoint cuts the topic
anew, so its batch N is another set of messages.  Every such start is therefore
registered as a stream of its own, in ``<lake>/<table>_streams``: the
checkpoint's path and the first ``batch_id`` of the stream, which is above all
ids that the log already holds.  Readers drop the messages that two streams
delivered, and only when the batches they read come from two: the tail behind
a snapshot is the newest stream's alone as soon as one snapshot covers the
older ones.  From the moment a stream is registered the older ones are closed:
their next batch is refused, so batch ids grow with time.

*Packs.*  Small batches make small files.  :meth:`CommittedTable.pack` writes runs
of successive closed batches into one file each, up to ``PACK_ROWS`` rows, and puts
one record ``<table>_<kind>_packs/N`` that lists every bin with its range of
batches: readers then open the bins that overlap the batches they ask for.  A
batch of half that size or more stays where it is and is only listed.  A small bin
is packed again once the batches behind it weigh half as much, so a row is
rewritten a logarithmic number of times.  The folders that a pack replaces are
removed by the next pack, so that a reader that planned before it can finish; the
commit records stay, as a replay asks for them.  One pack of a table runs at a time.

Starting a new checkpoint on a log that has data must be asked for
(``rejoin=True``): it reads the topic again from its start.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdc_lake.sources.lake import LakeTable, table_path
from cdc_lake.sources.records import RecordFolder

PLACE = ("topic", "partition", "seq")
#: Rows of a packed file, about.
PACK_ROWS = 2_000_000
STREAMS = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("checkpoint", T.StringType()),
                        T.StructField("first_batch", T.LongType())])


class CheckpointError(RuntimeError):
    """The checkpoint and the log do not belong together."""


class CommittedTable(LakeTable):
    """A table whose batches count once they are committed, each with the files of one attempt."""

    def __init__(self, spark: SparkSession, root: str, table: str, kind: str, fmt: str = "parquet"):
        super().__init__(spark, root, f"{table}_{kind}", fmt)
        self.kind = kind
        self.commits = RecordFolder(spark, table_path(root, f"{table}_commits"))
        self.streams = LakeTable(spark, root, f"{table}_streams")
        self.packs = RecordFolder(spark, table_path(root, f"{table}_{kind}_packs"))

    def registered(self) -> list[tuple[int, str, int]]:
        """(number, checkpoint, first batch) of every stream, oldest first: one short row per start."""
        return sorted(tuple(r) for r in self.streams.read_or_empty(STREAMS).collect())

    def committed(self, after: int | None = None, upto: int | None = None) -> list[tuple[int, dict]]:
        """(batch, record) of the committed batches in ``(after, upto]``."""
        return self.commits.read([n for n in self.commits.numbers()
                                  if (after is None or n > after) and (upto is None or n <= upto)])

    def packed(self) -> tuple[int | None, list[dict]]:
        """The newest batch that is packed and the bins (path, first, last, rows), oldest first."""
        numbers = self.packs.numbers()
        record = self.packs.get(numbers[-1]) if numbers else None
        return (None, []) if record is None else (record["upto"], record["bins"])

    def committed_upto(self) -> int | None:
        """The newest committed batch; every batch that is ever committed later has a larger id."""
        numbers = self.commits.numbers()
        return numbers[-1] if numbers else None

    def _parts(self, after: int | None, upto: int | None) -> tuple[list[dict], list[tuple[int, dict]]]:
        """The bins that overlap ``(after, upto]`` and its committed batches behind the packed ones."""
        packed, bins = self.packed()
        last = after if packed is None or (after is not None and after > packed) else packed
        return ([b for b in bins if (after is None or b["last"] > after) and (upto is None or b["first"] <= upto)],
                self.committed(last, upto))

    def rows_in(self, after: int | None = None, upto: int | None = None) -> int:
        """Rows of the batches in ``(after, upto]`` as their commits count them; a bin counts whole."""
        bins, batches = self._parts(after, upto)
        return sum(b["rows"] for b in bins) + sum(r["rows"][self.kind] for _, r in batches)

    def attempt_path(self, batch: int, attempt: str) -> str:
        return f"{self.path}/batch_id={batch}/attempt={attempt}"

    def paths(self, after: int | None = None, upto: int | None = None) -> list[str]:
        """Folders that hold this table's rows of the committed batches in ``(after, upto]``."""
        bins, batches = self._parts(after, upto)
        return [b["path"] for b in bins] + [
            self.attempt_path(n, r["attempt"]) for n, r in batches if r["rows"][self.kind]]

    def exists(self) -> bool:
        """True when a committed batch holds rows (a Delta table: when it is there)."""
        return super().exists() if self.fmt == "delta" else bool(self.paths())

    def _files(self, after: int | None, upto: int | None, schema: T.StructType | None) -> DataFrame | None:
        """The committed rows, every copy of them; None without any."""
        if self.fmt == "delta":
            df = super().read() if super().exists() else None
        else:
            df = None
            paths = self.paths(after, upto)
            for in_bins in (True, False):  # the batch is a column of the files in bins
                own = [p for p in paths if p.startswith(f"{self.path}_bins/") == in_bins]
                r = self.spark.read if in_bins else self.spark.read.option("basePath", self.path)
                if schema is not None:
                    r = r.schema(T.StructType([*schema.fields, T.StructField("attempt", T.StringType())]))
                part = r.parquet(*own).drop("attempt") if own else None
                if part is not None:
                    part = part.withColumn("batch_id", F.col("batch_id").cast("long")) if schema is None else part
                    df = part if df is None else df.unionByName(part)
        if df is not None and after is not None:
            df = df.where(F.col("batch_id") > after)
        if df is not None and upto is not None:
            df = df.where(F.col("batch_id") <= upto)
        return df

    def several_streams(self, after: int | None, upto: int | None) -> bool:
        """Do the batches in ``(after, upto]`` come from more than one stream?"""
        first = [s[2] for s in self.registered()]
        spans = [(a, b - 1 if b is not None else None) for a, b in zip(first, [*first[1:], None])]
        return sum((upto is None or a <= upto) and (b is None or after is None or b > after) for a, b in spans) > 1

    def vacuum(self) -> list[str]:
        """Delete the attempts of committed batches that the commit does not name; returns their paths.  A batch that
        is being written has no commit yet and is left alone."""
        path, fs = self._fs()
        named = {n: r["attempt"] for n, r in self.committed()}
        gone = []
        if self.fmt == "delta" or not fs.exists(path(self.path)):
            return gone
        for st in fs.listStatus(path(self.path)):
            name = st.getPath().getName()
            number = int(name[9:]) if name.startswith("batch_id=") else None
            if number not in named:
                continue
            for a in fs.listStatus(st.getPath()):
                if a.getPath().getName() != f"attempt={named[number]}":
                    fs.delete(a.getPath(), True)
                    gone.append(a.getPath().toString())
        return gone

    def pack(self, rows: int = PACK_ROWS, least: int = 16) -> list[dict]:
        """Pack the closed batches (all committed ones but the newest) when there are ``least`` of them that are not
        packed yet; returns the new bins."""
        upto, bins = self.packed()
        closed = self.committed(upto)[:-1]
        if self.fmt == "delta" or len(closed) < least:
            return []
        own = [{"path": self.attempt_path(n, r["attempt"]), "first": n, "last": n, "rows": r["rows"][self.kind]}
               for n, r in closed if r["rows"][self.kind]]
        # Small bins at the end are packed again when what follows weighs half as much.
        weight = sum(b["rows"] for b in own)
        keep = list(bins)
        while keep and keep[-1]["rows"] < rows // 2 and keep[-1]["rows"] <= 2 * weight:
            weight += keep[-1]["rows"]
            own.insert(0, keep.pop())
        groups, have = [], 0
        for b in own:  # successive batches to one file, so that its range stays narrow
            if not groups or have + b["rows"] > rows or b["rows"] >= rows // 2:
                groups.append([])
                have = 0
            groups[-1].append(b)
            have += rows if b["rows"] >= rows // 2 else b["rows"]
        path = f"{self.path}_bins/{uuid.uuid4().hex}"
        made = [g[0] if len(g) == 1 else {"path": f"{path}/bin={k}", "first": g[0]["first"], "last": g[-1]["last"],
                                          "rows": sum(b["rows"] for b in g)} for k, g in enumerate(groups)]
        moved = [(k, g[0]["first"], g[-1]["last"]) for k, g in enumerate(groups) if len(g) > 1]
        if moved:
            # A schema that the caller knows is that of the log; dead letters have one of their own.
            df = self._files(moved[0][1] - 1, moved[-1][2], getattr(self, "schema", None))
            spans = self.spark.createDataFrame(moved, "bin int, first long, last long").select(
                "bin", F.explode(F.sequence("first", "last")).alias("batch_id"))
            (df.join(spans, "batch_id").select("bin", *df.columns).repartition("bin").sortWithinPartitions("bin", "batch_id")
             .write.partitionBy("bin").parquet(path))
        numbers = self.packs.numbers()
        number = numbers[-1] + 1 if numbers else 0
        record = {"upto": closed[-1][0], "bins": keep + made,
                  "replaced": [b["path"] for g in groups if len(g) > 1 for b in g]}
        if not self.packs.put(number, record):
            raise RuntimeError(f"another run packed {self.path}")
        self._retire(numbers)
        return [b for b in made if b["path"].startswith(path)]

    def _retire(self, numbers: list[int]) -> None:
        """Delete what the packs before the newest one replaced, their records, and bins that no record names (of a
        pack that failed)."""
        path, fs = self._fs()
        for _, r in self.packs.read(numbers):
            for gone in r["replaced"]:
                fs.delete(path(gone), True)
        self.packs.drop(numbers)
        (_, newest), = self.packs.read(self.packs.numbers())
        root = f"{self.path}_bins"
        named = {p.split("/")[-2] for p in [*[b["path"] for b in newest["bins"]], *newest["replaced"]] if p.startswith(f"{root}/")}
        for st in fs.listStatus(path(root)) if fs.exists(path(root)) else []:
            if st.getPath().getName() not in named:
                fs.delete(st.getPath(), True)


class DeadLetters(CommittedTable):
    """Handle on ``<lake>/<table>_dead_letter``: rejected messages with their reason."""

    def __init__(self, spark: SparkSession, root: str, table: str, fmt: str = "parquet"):
        super().__init__(spark, root, table, "dead_letter", fmt)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """Every rejected message once, as the first batch that had it recorded it."""
        df = self._files(None, None, schema)
        if df is None:
            raise ValueError(f"no rejected messages in {self.path}")
        if not self.several_streams(None, None):
            return df
        place = ("topic", "partition", "offset")
        rest = [c for c in df.columns if c not in place]
        return df.groupBy(*place).agg(F.min_by(F.struct(*rest), "batch_id").alias("_r")).select(
            *[F.col(f"_r.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


class ChangeLog(CommittedTable):
    """Handle on ``<lake>/<table>_log`` with its known schema (without ``batch_id`` and message columns)."""

    def __init__(self, spark: SparkSession, root: str, table: str, row_log_schema: T.StructType | None = None,
                 fmt: str = "parquet"):
        super().__init__(spark, root, table, "log", fmt)
        self.schema = None if row_log_schema is None else T.StructType([
            *row_log_schema.fields, T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
            T.StructField("batch_id", T.LongType())])

    def rows(self, after: int | None = None, upto: int | None = None, where: Column | None = None) -> DataFrame:
        """The committed log, or its batches in ``(after, upto]`` (only their files are read), every message once;
        ``where`` filters by columns that copies of a message share (key, image), before copies are dropped, so it
        reaches the scan.  Empty with the known schema while there is no data."""
        df = self._files(after, upto, self.schema)
        if df is None:
            if self.schema is None:
                raise ValueError(f"no data in {self.path}")
            return self.spark.createDataFrame([], self.schema)
        if where is not None:
            df = df.where(where)
        if self.several_streams(after, upto):
            # Copies of a message are equal but for the batch: the first batch that had it counts.
            rest = [c for c in df.columns if c not in (*PLACE, "batch_id")]
            df = df.groupBy(*PLACE).agg(F.min("batch_id").alias("batch_id"), F.first(F.struct(*rest)).alias("_r")).select(
                *[F.col(f"_r.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])
        return df

    def replayed(self, batch: int, checkpoint: str | None) -> dict | None:
        """The record of a batch that is committed already (a replay), None for a new batch; refuses a batch of a
        stream that a newer one has closed."""
        streams = self.registered()
        if streams and checkpoint is not None and streams[-1][1] != checkpoint:
            raise CheckpointError(f"{self.path} is written by a newer stream ({streams[-1][1]}); {checkpoint} is closed")
        return self.commits.get(batch)

    def _started(self, checkpoint: str) -> bool:
        """Has a streaming query already committed to the checkpoint folder?"""
        path, fs = self._fs()
        return fs.exists(path(f"{checkpoint.rstrip('/')}/metadata"))

    def join_stream(self, checkpoint: str, rejoin: bool = False) -> int:
        """First batch id of the stream that runs from ``checkpoint``; registers a new stream when there is none."""
        known = self.registered()
        own = [s for s in known if s[1] == checkpoint]
        if self._started(checkpoint):
            if not own:
                raise CheckpointError(f"checkpoint {checkpoint} was not used to write {self.path}")
            if own[-1] != known[-1]:
                raise CheckpointError(f"{self.path} is written by a newer stream ({known[-1][1]}); {checkpoint} is closed")
            return own[-1][2]
        first = 0
        if self.exists() or self.commits.numbers():
            if not rejoin:
                raise CheckpointError(
                    f"{self.path} has data but checkpoint {checkpoint} is empty; pass rejoin=True (--rejoin) to read "
                    "the topic again from its start, or the checkpoint that wrote the log")
            first = max(self.commits.numbers(), default=-1) + 1
            if self.fmt == "delta":
                first = int(self.read(self.schema).agg(F.max("batch_id")).first()[0]) + 1
        if known:
            first = max(first, max(s[2] for s in known))
        number = len(known)
        row = self.spark.createDataFrame([(number, checkpoint, first)], STREAMS)
        row.coalesce(1).write.mode("append").parquet(self.streams.path)
        return first
