"""The query catalogue: one plan per operator of the blueprint.

Every entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables (or feeds Spark derives from them).  Column names equal
those of the SQL oracle in :mod:`cdc_lake.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdc_lake.contracts import CONTRACTS, FOREIGN_KEYS, ORDER_STATUS_ROW, USER_ROW
from cdc_lake.functions import envelope as env
from cdc_lake.functions.timecols import epoch_us_of, floor_div, ms_to_ts, ns_to_ts, ns_to_us_double
from cdc_lake.operators import changes, fkcount, ledger, metrics, quality
from cdc_lake.operators.sequence import HotSplit
from cdc_lake.sources import feeds, messages
from cdc_lake.sources.tables import Tables

USER_COLS = ["value", "props"]
LOOKUP_USER = 7          # key of the point lookup
PICK_SEED, PICK_K = "42", 5


ROWS_PER_BUCKET = 1_000_000   # a key with more rows is split into pieces of about as many, by event time
FORCED_BUCKET = 50            # the *_hot queries split every key above this, so that fixtures take the split path


def time_split(ts: str = "ts", rows: int = ROWS_PER_BUCKET) -> HotSplit:
    """Hot-key split for per-key sequences ordered by ``ts`` (adaptive widths), then ``seq`` or the order's key."""
    return HotSplit(order_value=epoch_us_of(ts), tie=F.col("seq" if ts == "ts" else "l_orderkey"), rows_per_bucket=rows)


def _t(spark: SparkSession, d: str) -> Tables:
    return Tables.of(spark, d)


# ----------------------------------------------------------------- metrics
def q_top_products(spark, d):
    t = _t(spark, d)
    return metrics.top_products(t.lineitem, t.part)


def q_top_products_by_id(spark, d):
    t = _t(spark, d)
    return metrics.top_products(t.lineitem, t.part, by_id=True)


# --------------------------------------------------------- envelope path
def _parsed_users(t: Tables) -> DataFrame:
    return env.parse_messages(messages.user_messages(t), USER_ROW)


def q_parse_envelope(spark, d):
    p = _parsed_users(_t(spark, d))
    return p.select(
        "offset", "op", "ts_ms", env.change_key("user_id").alias("user_id"),
        F.col("after.value").alias("after_value"), F.col("after.props").alias("after_props"),
        F.col("before.value").alias("before_value"))


def q_valid_changes(spark, d):
    return env.to_change_log(_parsed_users(_t(spark, d)), "user_id", ["user_id", *USER_COLS])


def q_dead_letter(spark, d):
    return env.dead_letters(_parsed_users(_t(spark, d)), "user_id").select("topic", "offset", "reason")


def q_epoch_ns_to_ts(spark, d):
    e = _t(spark, d).events
    ns = epoch_us_of("ts") * F.lit(1000) + F.col("event_id") % 1000
    x = e.select("event_id", ns.alias("ts_ns"))
    exact_us = floor_div(F.col("ts_ns"), 1000)
    return x.select(
        "event_id", "ts_ns", ns_to_ts("ts_ns").alias("ts_exact"),
        exact_us.alias("us_exact"), ns_to_us_double("ts_ns").alias("us_double"),
        (exact_us - ns_to_us_double("ts_ns")).alias("off_by_us"))


def q_decode_decimal(spark, d):
    c = _t(spark, d).customer.select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("bal"))
    # Encode the balance both ways the connector can send a DECIMAL, then parse it back.
    text = F.to_json(F.struct(env.encode_decimal_b64("bal").alias("b64"), F.col("bal").alias("num")))
    schema = T.StructType([T.StructField("b64", T.StringType()), T.StructField("num", T.DecimalType(18, 2))])
    m = c.select("c_custkey", F.from_json(text, schema).alias("m"))
    return m.select("c_custkey", env.decode_decimal_b64("m.b64").alias("amount_b64"),
                    F.col("m.num").alias("amount_num"))


def q_route_by_type(spark, d):
    msgs = messages.all_messages(_t(spark, d)).where(F.col("topic") == messages.ORDER_STATUS_TOPIC)
    p = env.parse_messages(msgs, ORDER_STATUS_ROW)
    return env.to_change_log(p, "o_orderkey", ["o_orderkey", "status_id"])


def q_change_keys(spark, d):
    c = feeds.chg_users(_t(spark, d))
    return c.where(F.col("op").isin(env.OP_UPDATE, env.OP_DELETE)).select("batch_day", "user_id").distinct()


def q_change_counts(spark, d):
    return metrics.change_counts(feeds.chg_users(_t(spark, d)))


# ------------------------------------------------------------------- SCD1
def q_latest_per_key(spark, d):
    return changes.latest_per_key(feeds.chg_users(_t(spark, d)), "user_id", [*USER_COLS, "batch_day"])


def q_latest_per_key_per_batch(spark, d):
    return changes.latest_per_key(feeds.chg_users(_t(spark, d)), "user_id", USER_COLS, by=["batch_day"])


def q_current_state(spark, d):
    return changes.current_state(feeds.chg_users(_t(spark, d)), "user_id", USER_COLS)


def q_current_state_keep_deleted(spark, d):
    return changes.current_state(feeds.chg_users(_t(spark, d)), "user_id", USER_COLS, apply_deletes=False)


def q_last_batch_wins(spark, d):
    log = feeds.chg_users_late(_t(spark, d))
    return changes.current_state(log, "user_id", [*USER_COLS, "arrival_day"], apply_deletes=False,
                                 order_guard=False, batch="arrival_day")


def q_upsert_snapshot(spark, d):
    """A snapshot with tombstones, merged with the last arrivals, among them changes older than it."""
    log = feeds.chg_users_late(_t(spark, d))
    last = log.select(F.max("arrival_day")).scalar()
    cut = F.date_sub(last, 3)
    snap = changes.latest_per_key(log.where(F.col("arrival_day") < cut), "user_id", USER_COLS)
    merged = changes.upsert(snap, log.where(F.col("arrival_day") >= cut), "user_id", USER_COLS)
    return merged.where(F.col("op") != env.OP_DELETE)


def q_touch_updated_at(spark, d):
    return changes.touch_updated_at(feeds.chg_users(_t(spark, d)), "user_id", USER_COLS)


def q_bootstrap_union(spark, d):
    t = _t(spark, d)
    chg = feeds.chg_order_status(t).where(F.col("op") == env.OP_UPDATE)
    return changes.bootstrap_union(feeds.order_snapshot(t), chg)


# ------------------------------------------------------------------- SCD2
def _history(t: Tables) -> DataFrame:
    return changes.scd2_history(feeds.chg_users(t), "user_id", USER_COLS, bucket=time_split())


def q_scd2_history(spark, d):
    return _history(_t(spark, d))


def q_scd2_history_hot(spark, d):
    """The history with every key of more than ``FORCED_BUCKET`` rows split."""
    return changes.scd2_history(feeds.chg_users(_t(spark, d)), "user_id", USER_COLS,
                                bucket=time_split(rows=FORCED_BUCKET))


def _user_log(spark, d) -> DataFrame:
    """Messages -> valid change-log rows, as the streaming sink writes them, with event time as a timestamp."""
    log = env.to_change_log(_parsed_users(_t(spark, d)), "user_id", ["user_id", *USER_COLS])
    return log.withColumn("ts", ms_to_ts("ts_ms"))


def q_log_current_state(spark, d):
    return changes.current_state(_user_log(spark, d), "user_id", USER_COLS).select("user_id", *USER_COLS, "op")


def q_log_history(spark, d):
    return changes.scd2_history(_user_log(spark, d), "user_id", USER_COLS, bucket=time_split())


ORDER_TOTAL_ROW = T.StructType([T.StructField("o_orderkey", T.LongType()),
                                T.StructField("total", T.DecimalType(18, 2))])


def q_decimal_envelope(spark, d):
    """Order totals sent as base64 DECIMAL, parsed, decoded and routed: the change log's rows and the rejected
    messages (every 50th total is no base64, every 70th op unknown), with the reason."""
    o = _t(spark, d).orders
    k = F.col("o_orderkey")
    text = F.when(k % 50 == 0, F.lit("*bad*")).otherwise(
        env.encode_decimal_b64(F.col("o_totalprice").cast("decimal(18,2)")))
    sent = o.select(k, text.alias("total"), F.when(k % 70 == 0, F.lit("x")).otherwise(F.lit("c")).alias("op"),
                    F.lit(1).cast("long").alias("ts_ms"))
    msgs = sent.select(F.lit("orders").alias("topic"), F.lit(0).alias("partition"), k.alias("offset"),
                       env.build_value(["o_orderkey", "total"]).alias("value"))
    parsed = env.parse_messages(msgs, ORDER_TOTAL_ROW)
    decimals = env.decimal_columns(ORDER_TOTAL_ROW)
    log = env.to_change_log(parsed, "o_orderkey", ["o_orderkey", "total"], decimals=decimals, encoding=env.BASE64)
    dead = env.dead_letters(parsed, "o_orderkey", decimals=decimals, encoding=env.BASE64)
    return log.select("seq", "total", F.lit(None).cast("string").alias("reason")).unionByName(
        dead.select(F.col("offset").alias("seq"), F.lit(None).cast("decimal(18,2)").alias("total"), "reason"))


def q_scd2_refresh(spark, d):
    """History stored up to the day before the last, refreshed with the last day's changes."""
    log = feeds.chg_users(_t(spark, d))
    last = log.select(F.max("batch_day")).scalar()
    stored = changes.scd2_history(log.where(F.col("batch_day") < last), "user_id", USER_COLS,
                                  bucket=time_split())
    return changes.scd2_refresh(stored, log, log.where(F.col("batch_day") >= last), "user_id", USER_COLS,
                                bucket=time_split())


def q_scd2_collapsed(spark, d):
    return changes.scd2_collapsed(feeds.chg_users(_t(spark, d)), "user_id", USER_COLS, "batch_day")


def q_scd2_reference_mode(spark, d):
    return changes.scd2_reference(feeds.chg_users(_t(spark, d)), "user_id", USER_COLS, "batch_day")


def q_scd2_expire(spark, d):
    log = feeds.chg_users(_t(spark, d))
    last = log.select(F.max("batch_day")).scalar()
    hist = changes.scd2_collapsed(log.where(F.col("batch_day") < last), "user_id", USER_COLS, "batch_day")
    keys = log.where((F.col("batch_day") >= last) & F.col("op").isin(env.OP_UPDATE, env.OP_DELETE))
    return changes.scd2_expire(hist, keys, "user_id", last)


def q_scd2_current(spark, d):
    h = _history(_t(spark, d))
    return h.where("is_current").select("user_id", *USER_COLS, "valid_from")


def q_history_lookup(spark, d):
    return changes.history_of(feeds.chg_users(_t(spark, d)), "user_id", LOOKUP_USER, USER_COLS,
                              bucket=time_split())


def q_history_head(spark, d):
    return changes.history_head(feeds.chg_users(_t(spark, d)), "user_id", USER_COLS, 10, bucket=time_split())


# ------------------------------------------------------------------- rules
class _RuleTables(dict):
    """Rule inputs by name, each built on first use (a report that needs five
    of them does not build the other six)."""

    def __init__(self, t: Tables):
        super().__init__()
        self._make = {
            "region": lambda: t.region, "nation": lambda: t.nation, "customer": lambda: t.customer,
            "supplier": lambda: t.supplier, "part": lambda: t.part, "orders": lambda: t.orders,
            "lineitem": lambda: t.lineitem, "reasons": lambda: feeds.reasons(t),
            "chg_users": lambda: feeds.chg_users(t), "payments": lambda: feeds.payments(t),
            "reviews": lambda: feeds.reviews(t),
        }

    def __missing__(self, name: str) -> DataFrame:
        df = self[name] = self._make[name]()
        return df


def _rule_tables(t: Tables) -> dict[str, DataFrame]:
    return _RuleTables(t)


def q_contract_report(spark, d):
    tabs = _rule_tables(_t(spark, d))
    return quality.union_all([quality.contract_report(tabs[name], c) for name, c in CONTRACTS.items()])


def q_pk_duplicates(spark, d):
    return quality.pk_duplicates(_t(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


def q_fk_orphans(spark, d):
    t = _t(spark, d)
    tabs = _rule_tables(t)
    tabs["lineitem"] = feeds.lineitem_spoiled(t)
    return quality.fk_orphans(tabs, FOREIGN_KEYS)


def q_fk_orphans_refresh(spark, d):
    """The counted orphan view after a batch of changes on both sides of the foreign keys: a tenth of the orders arrives
    after their lines, customers leave, and some lines are moved to orders that do not exist."""
    t = _t(spark, d)
    tabs = _rule_tables(t)
    late = F.pmod(F.col("o_orderkey"), F.lit(10)) == 3
    gone = F.pmod(F.col("c_custkey"), F.lit(40)) == 7
    moved = F.pmod(F.col("l_orderkey"), F.lit(50)) == 11
    before = {n: tabs[n] for n in dict.fromkeys(x for fk in FOREIGN_KEYS for x in (fk.child, fk.parent))}
    counts = fkcount.fk_counts({**before, "orders": t.orders.where(~late)}, FOREIGN_KEYS)
    lines = t.lineitem.where(moved)
    deltas = fkcount.fk_deltas(
        {"orders": t.orders.where(late), "lineitem": lines.withColumn("l_orderkey", -F.col("l_orderkey"))},
        {"customer": t.customer.where(gone), "lineitem": lines}, FOREIGN_KEYS)
    return fkcount.fk_orphans_of(fkcount.fk_apply(counts, deltas))


def q_order_total_reconcile(spark, d):
    t = _t(spark, d)
    return quality.order_total_reconcile(t.orders, t.lineitem)


def q_stock_ledger(spark, d):
    t = _t(spark, d)
    return ledger.stock_ledger(feeds.sales(t), feeds.stock(t), bucket=time_split("l_shipdate"))


def q_stock_ledger_hot(spark, d):
    """The ledger with every part of more than a few sales split."""
    t = _t(spark, d)
    return ledger.stock_ledger(feeds.sales(t), feeds.stock(t), bucket=time_split("l_shipdate", rows=20))


def q_stock_ledger_refresh(spark, d):
    """The kept ledger after late sales of every date: a fifth of the orders comes in after the others."""
    t = _t(spark, d)
    sales = feeds.sales(t)
    late = F.pmod(F.xxhash64("l_orderkey"), F.lit(5)) == 0
    rows, tree = ledger.ledger_rows(sales.where(~late)), ledger.ledger_tree(sales.where(~late))
    changed, kept, nodes = ledger.ledger_add(rows, tree, sales.where(late))
    return ledger.ledger_view(kept.unionByName(changed), ledger.tree_with(tree, nodes), feeds.stock(t))


def q_address_violations(spark, d):
    return quality.address_violations(feeds.addresses(_t(spark, d)))


def q_stock_balance(spark, d):
    t = _t(spark, d)
    return ledger.stock_balance(feeds.sales(t), feeds.stock(t))


def q_illegal_transitions(spark, d):
    return quality.illegal_transitions(feeds.chg_order_status(_t(spark, d)), time_split())


def q_status_timeline(spark, d):
    return quality.status_timeline(feeds.chg_order_status(_t(spark, d)), time_split())


def q_payment_violations(spark, d):
    t = _t(spark, d)
    return quality.payment_violations(feeds.payments(t), feeds.order_final(t))


def q_reason_violations(spark, d):
    t = _t(spark, d)
    return quality.reason_violations(feeds.order_final(t), feeds.reasons(t))


def q_verified_reviews(spark, d):
    t = _t(spark, d)
    return quality.verified_reviews(feeds.reviews(t), quality.delivered_purchases(t.lineitem, feeds.order_final(t)))


def q_unverified_reviews(spark, d):
    t = _t(spark, d)
    return quality.verified_reviews(feeds.reviews(t), quality.delivered_purchases(t.lineitem, feeds.order_final(t)),
                                    verified=False)


def q_low_stock(spark, d):
    return quality.low_stock(feeds.stock(_t(spark, d)))


def q_seeded_pick(spark, d):
    of = feeds.order_final(_t(spark, d)).where(F.col("status_id") == 1).select("o_orderkey", "o_custkey", "total")
    return quality.seeded_pick(of, "o_orderkey", PICK_K, PICK_SEED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
