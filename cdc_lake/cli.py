"""Command line: the four programs of a CDC lake deployment.

    python -m cdc_lake.cli process  --lake PATH --checkpoint PATH (--kafka HOST:PORT [--topic-prefix P] | --source-dir DIR)
                                    [--decimals number|base64] [--rejoin]
    python -m cdc_lake.cli compact  --lake PATH [--tables A,B] [--purge-before MS]
    python -m cdc_lake.cli check    --lake PATH [--out PATH]
    python -m cdc_lake.cli history  --lake PATH [--table Customers] [KEY] [--limit N] [--out PATH]
    python -m cdc_lake.cli current  --lake PATH --table NAME [--limit N] [--out PATH]
    python -m cdc_lake.cli top-products --lake PATH [-k 10]
    python -m cdc_lake.cli tap      (--kafka HOST:PORT --topic T | --source-dir DIR)
    python -m cdc_lake.cli serve    --lake PATH --checkpoint PATH (--kafka HOST:PORT --topic T | --source-dir DIR) [-k 10]

``process`` starts one streaming query per source table and blocks until one
ends; ``compact`` folds the logs into current and history snapshots; the
others read the newest snapshot and the log after it.  A display shows
``--limit`` rows and says so when there are more; ``--out`` writes all of them
as Parquet.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdc_lake.contracts import PRIMARY_KEYS, ROW_SCHEMAS, SOURCE_CONTRACTS, SOURCE_FOREIGN_KEYS
from cdc_lake.functions.timecols import ms_to_ts
from cdc_lake.operators import changes, metrics, quality
from cdc_lake.session import build_session
from cdc_lake.streaming import pipeline as pl
from cdc_lake.streaming.changelog import ChangeLog, DeadLetters
from cdc_lake.streaming.compaction import (LOG_ORDER, SnapshotStore, compact_history, compact_log, current_view,
                                           history_view)
from cdc_lake.streaming.topk import RankedTotals


def _row_cols(table: str) -> list[str]:
    return [f.name for f in ROW_SCHEMAS[table].fields if f.name != PRIMARY_KEYS[table]]


def change_log(spark: SparkSession, lake: str, table: str) -> ChangeLog:
    return ChangeLog(spark, lake, table, pl.source_table_specs(names=[table])[0].log_schema)


def current_table(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """SCD1 view of a source table: newest snapshot and the log after it, deletes applied."""
    return current_view(spark, change_log(spark, lake, table), SnapshotStore(spark, lake, table),
                        PRIMARY_KEYS[table], _row_cols(table))


def history_table(spark: SparkSession, lake: str, table: str, key=None) -> DataFrame:
    """SCD2 view of a source table: versions with event-time validity, from
    the newest history snapshot and the log after it.  With ``key``, that key's
    versions only, read through a filter on snapshot and log.

    ``effective_date``, ``end_date``, ``source_created_at`` and
    ``source_updated_at`` are the names of a stored history table; the short
    names stay beside them.
    """
    store = SnapshotStore(spark, lake, f"{table}_history")
    h = history_view(spark, change_log(spark, lake, table), store, PRIMARY_KEYS[table], _row_cols(table), value=key)
    h = h.withColumn("valid_from", ms_to_ts("valid_from")).withColumn("valid_to", ms_to_ts("valid_to"))
    return h.withColumns({"effective_date": F.col("valid_from"), "end_date": F.col("valid_to"),
                          "source_created_at": F.col("CreatedAt"), "source_updated_at": F.col("UpdatedAt")})


def top_products_table(spark: SparkSession, lake: str, k: int = 10) -> DataFrame:
    items = current_table(spark, lake, "OrderItems")
    products = current_table(spark, lake, "Products")
    return metrics.top_products(items, products, k=k, item_key="ProductID", qty="Quantity",
                                product_key="ProductID", name="Name")


def compact_table(spark: SparkSession, lake: str, table: str, purge_before: int | None = None) -> int | None:
    """Bring both snapshots of a table up to its newest batch and pack its small batches; returns that batch, None
    without data."""
    log = change_log(spark, lake, table)
    if not log.exists():
        return None
    upto = log.committed_upto()
    key, cols = PRIMARY_KEYS[table], _row_cols(table)
    compact_log(spark, log, SnapshotStore(spark, lake, table), key, cols, upto, purge_before)
    compact_history(spark, log, SnapshotStore(spark, lake, f"{table}_history"), key, cols, upto)
    for t in (log, DeadLetters(spark, lake, table)):
        t.pack()
        t.vacuum()
    return upto


def show(df: DataFrame, limit: int, out: str | None) -> None:
    """Print the first ``limit`` rows, and say so when there are more; write all of them to ``out``."""
    if out:
        df.write.mode("errorifexists").parquet(out)
        print(f"written to {out}")
        return
    rows = df.limit(limit + 1).collect()
    df.sparkSession.createDataFrame(rows[:limit], df.schema).show(limit, truncate=False)
    if len(rows) > limit:
        print(f"only the first {limit} rows are shown (--limit N for more, --out PATH for all)")


def register_views(spark: SparkSession, lake: str, tables=None) -> list[str]:
    """Temp views ``<table>_current`` and ``<table>_history`` for SQL users, e.g.
    ``spark.sql("SELECT * FROM customers_history WHERE CustomerID = :id ORDER BY
    valid_from", args={"id": 42})`` (the parameter is bound, not spliced)."""
    names = []
    for t in tables or list(ROW_SCHEMAS):
        if not change_log(spark, lake, t).exists():
            continue
        current_table(spark, lake, t).createOrReplaceTempView(f"{t.lower()}_current")
        history_table(spark, lake, t).createOrReplaceTempView(f"{t.lower()}_history")
        names += [f"{t.lower()}_current", f"{t.lower()}_history"]
    return names


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cdc_lake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("process")
    p.add_argument("--lake", required=True)
    p.add_argument("--checkpoint", required=True, help="shared folder that outlives the process")
    p.add_argument("--rejoin", action="store_true", help="read the topics again with a new checkpoint")
    p.add_argument("--decimals", choices=("number", "base64"), default="number", help="how DECIMAL columns arrive")
    p.add_argument("--kafka")
    p.add_argument("--topic-prefix", default="")
    p.add_argument("--source-dir", help="one sub-folder of message files per table")
    p.add_argument("--tables", default=",".join(ROW_SCHEMAS))
    p.add_argument("--available-now", action="store_true")
    h = sub.add_parser("history")
    h.add_argument("--lake", required=True)
    h.add_argument("--table", default="Customers")
    h.add_argument("key", nargs="?")
    h.add_argument("--limit", type=int, default=None, help="rows shown (all versions of a key; 10 without a key)")
    h.add_argument("--out")
    c = sub.add_parser("current")
    c.add_argument("--lake", required=True)
    c.add_argument("--table", required=True)
    c.add_argument("--limit", type=int, default=20)
    c.add_argument("--out")
    cp = sub.add_parser("compact", help="fold the change logs into current and history snapshots")
    cp.add_argument("--lake", required=True)
    cp.add_argument("--tables", default=",".join(ROW_SCHEMAS))
    cp.add_argument("--purge-before", type=int, help="drop tombstones older than this ts_ms")
    ck = sub.add_parser("check", help="contracts and foreign keys of the captured tables")
    ck.add_argument("--lake", required=True)
    ck.add_argument("--out")
    t = sub.add_parser("top-products")
    t.add_argument("--lake", required=True)
    t.add_argument("-k", type=int, default=10)
    t.add_argument("--served", action="store_true", help="the rows that `serve` made last, without reading the log")
    sv = sub.add_parser("serve", help="keep <lake>/top_products current from the OrderItems stream")
    sv.add_argument("--lake", required=True)
    sv.add_argument("--kafka")
    sv.add_argument("--topic", default="OrderItems")
    sv.add_argument("--source-dir")
    sv.add_argument("--checkpoint", required=True)
    sv.add_argument("-k", type=int, default=10)
    sv.add_argument("--every", default="10 seconds")
    sv.add_argument("--available-now", action="store_true")
    tp = sub.add_parser("tap")
    tp.add_argument("--kafka")
    tp.add_argument("--topic")
    tp.add_argument("--source-dir")
    a = ap.parse_args(argv)

    spark = spark or build_session(app=f"cdc_lake_{a.cmd}")
    if a.cmd == "process":
        specs = pl.source_table_specs(a.topic_prefix, a.tables.split(","), a.decimals)

        def source_for(s: pl.TableSpec) -> DataFrame:
            if a.kafka:
                return pl.kafka_source(spark, a.kafka, s.topic)
            return pl.file_source(spark, f"{a.source_dir.rstrip('/')}/{s.name.lower()}")

        trigger = {"availableNow": True} if a.available_now else None
        queries = pl.start_all(spark, specs, source_for, a.lake, a.checkpoint, trigger, a.rejoin)
        if a.available_now:
            for q in queries:
                q.awaitTermination()
        else:
            pl.await_any(spark)
    elif a.cmd in ("history", "current") and a.table not in ROW_SCHEMAS:
        print(f"unknown table {a.table}: one of {', '.join(ROW_SCHEMAS)}")
        return 2
    elif a.cmd in ("history", "current") and not change_log(spark, a.lake, a.table).exists():
        print(f"no data yet for {a.table} in {a.lake}")
        return 1
    elif a.cmd == "history":
        key = PRIMARY_KEYS[a.table]
        if a.key is not None:
            try:
                rows = history_table(spark, a.lake, a.table, a.key).orderBy("valid_from")
            except ValueError as e:
                print(e)
                return 2
            if rows.isEmpty():
                print(f"no history for {key} = {a.key}")
            else:
                show(rows, a.limit or rows.count(), a.out)
        else:
            n = a.limit or 10
            if a.out or SnapshotStore(spark, a.lake, f"{a.table}_history").latest() is not None:
                h = history_table(spark, a.lake, a.table).orderBy(key, "valid_from")
            else:  # without a stored history: that of the first keys only (one row more tells that there are more)
                h = changes.history_head(change_log(spark, a.lake, a.table).rows(), key, _row_cols(a.table), n + 1,
                                         LOG_ORDER, ts="ts_ms")
                h = h.withColumn("valid_from", ms_to_ts("valid_from")).withColumn("valid_to", ms_to_ts("valid_to"))
            show(h, n, a.out)
    elif a.cmd == "current":
        show(current_table(spark, a.lake, a.table), a.limit, a.out)
    elif a.cmd == "check":
        tables = {t: current_table(spark, a.lake, t) for t in ROW_SCHEMAS if change_log(spark, a.lake, t).exists()}
        if not tables:
            print(f"no data yet in {a.lake}")
            return 1
        report = quality.check_tables(tables, SOURCE_CONTRACTS, SOURCE_FOREIGN_KEYS).orderBy("table_name", "rule")
        show(report, 1000, a.out)
    elif a.cmd == "compact":
        for t in a.tables.split(","):
            upto = compact_table(spark, a.lake, t, a.purge_before)
            print(f"{t}: no data yet" if upto is None else f"{t}: compacted up to batch {upto}")
    elif a.cmd == "top-products" and a.served:
        RankedTotals(spark, f"{a.lake.rstrip('/')}/top_products").served().orderBy(
            F.col("quantity").desc(), "name").show(a.k, truncate=False)
    elif a.cmd == "top-products":
        if not change_log(spark, a.lake, "OrderItems").exists():
            print(f"no data yet for OrderItems in {a.lake}")
            return 1
        top_products_table(spark, a.lake, a.k).show(a.k, truncate=False)
    elif a.cmd == "serve":
        src = (pl.kafka_source(spark, a.kafka, a.topic) if a.kafka else pl.file_source(spark, a.source_dir))
        writer = pl.TopKWriter(lambda s: current_table(s, a.lake, "Products"), f"{a.lake.rstrip('/')}/top_products", a.k)
        trigger = {"availableNow": True} if a.available_now else {"processingTime": a.every}
        spec = pl.source_table_specs(names=["OrderItems"])[0]
        pl.start_top_products(src, spec, writer, a.checkpoint, trigger).awaitTermination()
    elif a.cmd == "tap":
        src = (pl.kafka_source(spark, a.kafka, a.topic, starting="latest") if a.kafka
               else pl.file_source(spark, a.source_dir))
        pl.tap(src).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
