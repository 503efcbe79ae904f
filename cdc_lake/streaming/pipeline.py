"""Structured Streaming wiring: change topics -> change log -> tables.

Production subscribes to Kafka; tests point the same code at a directory of
message files.  The design differs from an eager per-batch MERGE:

* **One subscription per table.**  Each table gets its own streaming query
  reading only its topic, instead of every query reading every topic and
  filtering afterwards (the topic predicate does not reach the source).
* **Append-only change log.**  ``foreachBatch`` parses the batch once, writes
  valid changes to ``<lake>/<table>_log`` and rejected messages to
  ``<lake>/<table>_dead_letter`` and commits both with one record, which readers
  and compaction follow: a batch is seen whole or not at all, and a replay of
  a committed batch changes nothing.
  Rows carry their place in the topic, and every checkpoint gets its own range
  of batch ids (:mod:`cdc_lake.streaming.changelog`), so a restart with a new
  checkpoint neither loses nor doubles a message.  Current state and history
  are views over the log (:mod:`cdc_lake.operators.changes`), ordered by event
  time, so late and out-of-order batches give the same state.
* **Incremental serving.**  The Top-k dashboard keeps the last image of every
  item in the streaming state store and adds only what a newer change alters
  to one running total per product, so redelivered and late messages change
  nothing; a trigger writes the buckets of totals that it touches and switches
  to the new k best with one record (:mod:`cdc_lake.streaming.topk`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cdc_lake.contracts import PRIMARY_KEYS, ROW_SCHEMAS
from cdc_lake.functions import envelope as env
from cdc_lake.operators import changes
from cdc_lake.streaming.changelog import ChangeLog, CommittedTable, DeadLetters
from cdc_lake.streaming.topk import TopKWriter

# Schema of a message as the bus (or a message file) delivers it.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.BinaryType()),
])


@dataclass(frozen=True)
class TableSpec:
    """A captured source table: its topic, row image, primary key, the row
    columns that arrive as epoch nanoseconds (stored as timestamps), and how
    its DECIMAL columns arrive (``"number"``, or ``"base64"`` as a connector
    without a decimal mode sends them)."""
    name: str
    topic: str
    row_schema: T.StructType
    pk: str
    ns_timestamps: tuple[str, ...] = ()
    decimal_encoding: str = env.NUMBER

    @property
    def row_cols(self) -> list[str]:
        return [f.name for f in self.row_schema.fields]

    @property
    def log_schema(self) -> T.StructType:
        """Columns of the table's change log, before the message columns."""
        by = {f.name: f.dataType for f in self.row_schema.fields}
        return T.StructType([
            T.StructField(self.pk, by[self.pk]), T.StructField("seq", T.LongType()), T.StructField("ts_ms", T.LongType()),
            T.StructField("op", T.StringType()),
            *[T.StructField(c, T.TimestampNTZType() if c in self.ns_timestamps else by[c])
              for c in self.row_cols if c != self.pk]])

    def change_rows(self, parsed: DataFrame, keep: tuple[str, ...] = (), legacy_null_key: bool = False) -> DataFrame:
        """Valid parsed messages as change-log rows of this table."""
        return env.to_change_log(parsed, self.pk, self.row_cols, legacy_null_key=legacy_null_key,
                                 ns_timestamps=self.ns_timestamps, decimals=env.decimal_columns(self.row_schema),
                                 encoding=self.decimal_encoding, keep=keep)

    def rejected(self, parsed: DataFrame, legacy_null_key: bool = False) -> DataFrame:
        return env.dead_letters(parsed, self.pk, keep=("topic", "partition", "offset"), legacy_null_key=legacy_null_key,
                                decimals=env.decimal_columns(self.row_schema), encoding=self.decimal_encoding)


def source_table_specs(topic_prefix: str = "", names=None, decimal_encoding: str = env.NUMBER) -> list[TableSpec]:
    """Specs of the captured source tables (topic = prefix + table name)."""
    names = names or list(ROW_SCHEMAS)
    return [TableSpec(n, f"{topic_prefix}{n}", ROW_SCHEMAS[n], PRIMARY_KEYS[n], ("CreatedAt", "UpdatedAt"),
                      decimal_encoding) for n in names]


# ---------------------------------------------------------------- sources
def kafka_source(spark: SparkSession, servers: str, topics: str | list[str],
                 starting: str = "earliest", max_offsets_per_trigger: int | None = 50_000_000) -> DataFrame:
    """Kafka topics as a stream (needs the Kafka connector on the classpath).

    Prefer one topic per query (:func:`start_all`): a multi-topic
    subscription filtered by ``topic`` afterwards reads every topic once per
    query, because the topic predicate is not pushed into the source.
    ``starting="latest"`` tails a topic for inspection (:func:`tap`).
    ``max_offsets_per_trigger`` bounds a micro-batch: a first start from
    ``earliest`` on a topic holding years of changes is worked off in
    batches of that size instead of one batch holding the whole topic
    (``None``: no bound).
    """
    subscribe = topics if isinstance(topics, str) else ",".join(topics)
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", subscribe)
         .option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select("topic", "partition", "offset", "value")


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Message files (parquet with ``MESSAGE_SCHEMA``) as a stream; one
    directory per topic plays the role of a topic subscription."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


# ------------------------------------------------------------------ sinks
class ChangeLogSink:
    """``foreachBatch`` function: parse once, write the batch's rows to the change
    log and its rejected messages to the dead letters under
    ``first_batch + batch_id``, then commit both with one record
    (:mod:`cdc_lake.streaming.changelog`).  A replay of a committed batch writes nothing."""

    def __init__(self, spec: TableSpec, lake_root: str, fmt: str = "parquet",
                 legacy_null_key: bool = False, first_batch: int = 0, checkpoint: str | None = None):
        self.spec = spec
        self.lake_root = lake_root
        self.fmt = fmt
        self.legacy_null_key = legacy_null_key
        self.first_batch = first_batch
        self.checkpoint = checkpoint
        self.last_counts: dict = {}

    def log_table(self, spark: SparkSession) -> ChangeLog:
        return ChangeLog(spark, self.lake_root, self.spec.name, self.spec.log_schema, self.fmt)

    def dead_letter_table(self, spark: SparkSession) -> DeadLetters:
        return DeadLetters(spark, self.lake_root, self.spec.name, self.fmt)

    def _write(self, table: CommittedTable, df: DataFrame, number: int, attempt: str) -> None:
        if self.fmt == "delta":  # its own log isolates readers
            table.overwrite_partitions(df.withColumn("batch_id", F.lit(number).cast("long")))
        else:
            df.write.parquet(table.attempt_path(number, attempt))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # One cheap emptiness probe (a LIMIT 1 job) instead of a write per empty trigger.
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        s = self.spec
        number, attempt = self.first_batch + batch_id, uuid.uuid4().hex
        log, dead = self.log_table(spark), self.dead_letter_table(spark)
        done = log.replayed(number, self.checkpoint)
        if done is not None:
            self.last_counts = {"batch_id": batch_id, **done["ops"]}
            return
        parsed = env.parse_messages(batch, s.row_schema)
        # Two outputs read the parsed batch: keep it for the second one, the text of rejected messages only.
        bad = env.dead_letter_reason(s.pk, self.legacy_null_key, True, env.decimal_columns(s.row_schema),
                                     s.decimal_encoding).isNotNull()
        parsed = parsed.withColumn("_text", F.when(bad, F.col("_text"))).persist()
        try:
            rows = s.change_rows(parsed, keep=("topic", "partition"), legacy_null_key=self.legacy_null_key)
            # Counts ride along with the writes: no extra action.
            ops, rejected = Observation(f"{s.name}_{attempt}"), Observation(f"{s.name}_dead_{attempt}")
            self._write(log, rows.observe(ops, *[F.count_if(F.col("op") == o).alias(o) for o in env.OPS],
                                          F.count(F.lit(1)).alias("rows")), number, attempt)
            self._write(dead, s.rejected(parsed, self.legacy_null_key).observe(
                rejected, F.count(F.lit(1)).alias("rows")), number, attempt)
            counts = {k: int(v) for k, v in ops.get.items()}
            record = {"attempt": attempt, "rows": {"log": counts.pop("rows"), "dead_letter": int(rejected.get["rows"])},
                      "ops": counts, "checkpoint": self.checkpoint}
            log.replayed(number, self.checkpoint)  # a newer stream may have started while this batch was written
            log.commits.put(number, record)
            self.last_counts = {"batch_id": batch_id, **counts}
        finally:
            parsed.unpersist()


def start_table_stream(spark: SparkSession, spec: TableSpec, source: DataFrame, lake_root: str,
                       checkpoint_root: str, trigger: dict | None = None, fmt: str = "parquet",
                       rejoin: bool = False) -> StreamingQuery:
    """One streaming query for one table, checkpointed under ``<root>/<table>``.

    ``checkpoint_root`` must be a folder that outlives the process and that all
    executors share; there is no default.  ``rejoin`` allows a new checkpoint on
    a log that already has data.
    """
    if not checkpoint_root:
        raise ValueError("a stream needs a checkpoint folder that outlives it")
    checkpoint = f"{checkpoint_root.rstrip('/')}/{spec.name.lower()}"
    sink = ChangeLogSink(spec, lake_root, fmt, checkpoint=checkpoint)
    sink.first_batch = sink.log_table(spark).join_stream(checkpoint, rejoin)
    w = (source.writeStream
         .foreachBatch(sink)
         .option("checkpointLocation", checkpoint)
         .queryName(f"cdc_{spec.name.lower()}"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_all(spark: SparkSession, specs: list[TableSpec], source_for: Callable[[TableSpec], DataFrame],
              lake_root: str, checkpoint_root: str, trigger: dict | None = None,
              rejoin: bool = False) -> list[StreamingQuery]:
    """Start one query per table; wait with :func:`await_any`."""
    return [start_table_stream(spark, s, source_for(s), lake_root, checkpoint_root, trigger, rejoin=rejoin)
            for s in specs]


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Block until any query ends; a failed query raises here."""
    spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()


def tap(source: DataFrame, sink: str = "console", name: str = "raw_tap",
        checkpoint: str | None = None) -> StreamingQuery:
    """Raw message tap for inspection: the value as text, appended untruncated."""
    raw = source.select(F.col("value").cast("string").alias("raw_json"))
    w = raw.writeStream.outputMode("append").format(sink).queryName(name)
    if sink == "console":
        w = w.option("truncate", "false")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


# ----------------------------------------------------- stream-native SCD1
def current_state_stream(source: DataFrame, spec: TableSpec, order=("ts_ms", "seq")) -> DataFrame:
    """Streaming SCD1 held in the state store: the last change per key by
    event order (deletes kept as tombstone rows with op ``d``; drop them when
    serving).  Run in ``update`` mode to emit only the keys a batch touched;
    the state is one row per key, however many changes arrive."""
    parsed = env.parse_messages(source, spec.row_schema)
    log = spec.change_rows(parsed)
    return changes.latest_per_key(log, spec.pk, [c for c in spec.row_cols if c != spec.pk], order=order)


# ---------------------------------------------------------------- serving
DELTAS = "product long, delta long"
ITEM_STATE = "ts_ms long, seq long, product long, qty long"


def _item_deltas(key, frames, state) -> Iterator[pd.DataFrame]:
    """What the changes of one item add to and remove from products: the newest
    (ts_ms, seq) image replaces the one in state; older ones and copies do nothing."""
    ts, seq, product, qty = state.get if state.exists else (None, None, None, None)
    old = (product, qty)
    for f in frames:
        r = f.sort_values(["ts_ms", "seq"]).iloc[-1]
        if ts is None or (r.ts_ms, r.seq) > (ts, seq):
            ts, seq = int(r.ts_ms), int(r.seq)
            gone = r.op == env.OP_DELETE or pd.isna(r["product"]) or pd.isna(r.qty)
            product, qty = (None, None) if gone else (int(r["product"]), int(r.qty))
    if ts is not None:
        state.update((ts, seq, product, qty))
    if (product, qty) != old:
        rows = [(p, d) for p, d in ((old[0], -(old[1] or 0)), (product, qty)) if p is not None and d]
        if rows:
            yield pd.DataFrame(rows, columns=["product", "delta"])


def product_deltas_stream(items_source: DataFrame, spec: TableSpec, product: str = "ProductID",
                          qty: str = "Quantity") -> DataFrame:
    """Streaming (product, delta): the changes of the products' quantities.  State
    is one row per item (its last change), however many changes flow through."""
    rows = spec.change_rows(env.parse_messages(items_source, spec.row_schema)).where(
        F.col("ts_ms").isNotNull() & F.col("seq").isNotNull()).select(
        F.col(spec.pk).alias("item"), "ts_ms", "seq", "op", F.col(product).cast("long").alias("product"),
        F.col(qty).cast("long").alias("qty"))
    return rows.groupBy("item").applyInPandasWithState(_item_deltas, DELTAS, ITEM_STATE, "update", "NoTimeout")


def start_top_products(items_source: DataFrame, spec: TableSpec, writer: TopKWriter,
                       checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder that outlives it")
    w = (product_deltas_stream(items_source, spec).writeStream
         .outputMode("update").foreachBatch(writer)
         .option("checkpointLocation", checkpoint).queryName("top_products"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
