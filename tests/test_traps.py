"""Hand-written envelopes for the semantic traps of the reference (T1-T11, STR-5, FLT-9)
and the null cases of the dashboard query (AGG-1, JOIN-1)."""

import base64
import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdc_lake.contracts import ROW_SCHEMAS
from cdc_lake.functions import envelope as env
from cdc_lake.functions.timecols import ns_to_ts, ns_to_us_double
from cdc_lake.operators import changes, metrics
from cdc_lake.streaming.pipeline import MESSAGE_SCHEMA

CUST = ROW_SCHEMAS["Customers"]


def cust(cid, name="n", ns=1_700_000_000_123_456_700):
    return {"CustomerID": cid, "Name": name, "Email": f"{name}@x", "PhoneNumber": "1",
            "CreatedAt": ns, "UpdatedAt": ns}


def msg(offset, op, ts_ms, before=None, after=None, raw=None):
    if raw is not None or op is None:
        text = raw
    else:
        payload = {"op": op, "ts_ms": ts_ms}
        if before is not None:
            payload["before"] = before
        if after is not None:
            payload["after"] = after
        text = json.dumps({"payload": payload})
    return ("customers", 0, offset, None if text is None else text.encode())


def messages(spark, rows):
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def log_of(spark, rows, batch=None, legacy=False):
    parsed = env.parse_messages(messages(spark, rows), CUST)
    log = env.to_change_log(parsed, "CustomerID", [f.name for f in CUST.fields], legacy_null_key=legacy)
    log = log.withColumnRenamed("ts_ms", "ts")
    if batch is not None:
        log = log.withColumn("batch", F.lit(batch))
    return log


LOG_SCHEMA = "CustomerID int, seq long, ts long, op string, Name string, batch int"


def log_df(spark, rows):
    """(key, seq, ts, op, name, batch) rows as a change log."""
    return spark.createDataFrame(rows, LOG_SCHEMA)


# ---------------------------------------------------------------- T1 / T2
def test_t1_two_deletes_in_one_batch(spark):
    log = log_df(spark, [
        (1, 1, 10, "c", "a", 1), (2, 2, 11, "c", "b", 1),
        (1, 3, 20, "d", None, 2), (2, 4, 21, "d", None, 2),
    ])
    ref = changes.scd2_reference(log, "CustomerID", ["Name"], "batch").collect()
    still_current = {r.CustomerID for r in ref if r.is_current}
    assert len(still_current) == 1          # reference: one delete per batch survives dedupe
    fixed = changes.scd2_collapsed(log, "CustomerID", ["Name"], "batch").collect()
    assert not any(r.is_current for r in fixed)   # both keys closed
    assert changes.current_state(log, "CustomerID", ["Name"]).count() == 0


def test_t2_update_then_delete_in_one_batch(spark):
    log = log_df(spark, [(1, 1, 10, "c", "a", 1), (1, 2, 20, "u", "b", 2), (1, 3, 21, "d", None, 2)])
    ref = changes.scd2_reference(log, "CustomerID", ["Name"], "batch").collect()
    assert [r.Name for r in ref if r.is_current] == ["b"]       # deleted row stays current
    assert changes.current_state(log, "CustomerID", ["Name"]).count() == 0
    assert not any(r.is_current for r in changes.scd2_collapsed(log, "CustomerID", ["Name"], "batch").collect())


# ------------------------------------------------------------------ T3
def test_t3_snapshot_read_is_a_create(spark):
    log = log_df(spark, [(1, 1, 10, "r", "a", 1), (2, 2, 11, "c", "b", 1)])
    assert {r.CustomerID for r in changes.current_state(log, "CustomerID", ["Name"]).collect()} == {1, 2}
    hist = changes.scd2_history(log, "CustomerID", ["Name"])
    assert hist.count() == 2
    ref = changes.scd2_reference(log, "CustomerID", ["Name"], "batch")
    assert {r.CustomerID for r in ref.collect()} == {2}         # reference drops r in SCD2


# ------------------------------------------------------------------ T4
def test_t4_replay_is_idempotent(spark, scratch):
    from cdc_lake.streaming.pipeline import ChangeLogSink, TableSpec
    spec = TableSpec("Customers", "customers", CUST, "CustomerID")
    sink = ChangeLogSink(spec, scratch)
    batch = messages(spark, [msg(1, "c", 10, after=cust(1)), msg(2, "u", 20, before=cust(1), after=cust(1, "z"))])
    sink(batch, 0)
    sink(batch, 0)                                   # replay after a crash
    sink(messages(spark, [msg(3, "u", 30, before=cust(1, "z"), after=cust(1, "y"))]), 1)
    log = sink.log_table(spark).read()
    assert log.count() == 3
    cur = changes.current_state(log.withColumnRenamed("ts_ms", "ts"), "CustomerID", ["Name"]).collect()
    assert [(r.CustomerID, r.Name) for r in cur] == [(1, "y")]


# ------------------------------------------------------------------ T5
def test_t5_version_ends_where_next_begins(spark):
    log = log_df(spark, [(1, i, 10 * i, "c" if i == 1 else "u", f"v{i}", 1) for i in range(1, 6)])
    h = changes.scd2_history(log, "CustomerID", ["Name"]).orderBy("valid_from").collect()
    for a, b in zip(h, h[1:]):
        assert a.valid_to == b.valid_from
    assert h[-1].valid_to is None and h[-1].is_current


# ------------------------------------------------------------------ T6
def _b64(unscaled: int) -> str:
    """Minimal big-endian two's complement, as ``BigInteger.toByteArray``."""
    bits = unscaled.bit_length() if unscaled >= 0 else (~unscaled).bit_length()
    n = bits // 8 + 1
    return base64.b64encode(unscaled.to_bytes(n, "big", signed=True)).decode()


@pytest.mark.parametrize("value", ["0", "0.01", "-0.01", "12.34", "-12.34", "1.28", "-1.28", "1.27",
                                   "-1.29", "327.68", "99999999999999.99", "-99999999999999.99"])
def test_t6_base64_decimals(spark, value):
    d = Decimal(value)
    b64 = _b64(int(d * 100))
    row = spark.createDataFrame([(b64, d)], "s string, d decimal(18,2)").select(
        env.decode_decimal_b64("s").alias("dec"), env.encode_decimal_b64("d").alias("enc")).first()
    assert row.dec == d
    assert row.enc == b64


def test_t6_json_number_forms(spark):
    schema = T.StructType([T.StructField("x", T.DecimalType(18, 2))])
    rows = spark.createDataFrame([('{"x": 12.34}',), ('{"x": "12.34"}',), ('{"x": 12.349}',), ('{"x": -5}',),
                                  ('{"x": "BNI="}',)], "j string")
    got = [r.x for r in rows.select(F.from_json("j", schema).alias("m")).select("m.x").collect()]
    assert got[:4] == [Decimal("12.34"), Decimal("12.34"), Decimal("12.35"), Decimal("-5.00")]
    assert got[4] is None                        # base64 text into DECIMAL: null, the reference's loss


# ------------------------------------------------------------------ T7
def test_t7_nanoseconds_exact(spark):
    base = 1_700_000_000_123_456_700
    vals = [base + k * 37 for k in range(-1000, 1000)]
    df = spark.createDataFrame([(v,) for v in vals], "ns long").select(
        "ns", ns_to_ts("ns").alias("ts"), ns_to_us_double("ns").alias("us_double"))
    rows = df.collect()
    epoch = dt.datetime(1970, 1, 1)
    wrong_double = 0
    for r in rows:
        us = r.ns // 1000
        assert r.ts == epoch + dt.timedelta(microseconds=us)
        wrong_double += r.us_double != us
    assert wrong_double > 0                       # the double path loses microseconds


# ------------------------------------------------------------------ T8
def test_t8_equal_ts_broken_by_seq(spark):
    log = log_df(spark, [(1, 5, 10, "c", "first", 1), (1, 9, 10, "u", "second", 1), (1, 7, 10, "u", "middle", 1)])
    (r,) = changes.latest_per_key(log, "CustomerID", ["Name"]).collect()
    assert r.Name == "second"


# ------------------------------------------------------------------ T9
def test_t9_history_does_not_depend_on_batches(spark):
    rows = [(1, 1, 10, "c", "a", 1), (1, 2, 11, "u", "b", 1), (1, 3, 12, "u", "c", 1)]
    log = log_df(spark, rows)
    assert changes.scd2_history(log, "CustomerID", ["Name"]).count() == 3
    assert changes.scd2_collapsed(log, "CustomerID", ["Name"], "batch").count() == 1
    split = log_df(spark, [(k, s, t, o, n, s) for k, s, t, o, n, _ in rows])
    assert changes.scd2_history(split, "CustomerID", ["Name"]).count() == 3


# ----------------------------------------------------------------- T10
def test_t10_ns_timestamps_converted_in_change_log(spark):
    parsed = env.parse_messages(messages(spark, [msg(1, "c", 10, after=cust(1))]), CUST)
    log = env.to_change_log(parsed, "CustomerID", [f.name for f in CUST.fields],
                            ns_timestamps=("CreatedAt", "UpdatedAt"))
    r = log.first()
    assert r.CreatedAt == dt.datetime(2023, 11, 14, 22, 13, 20, 123456)
    assert dict(log.dtypes)["CreatedAt"] == "timestamp_ntz"


# ----------------------------------------------------------------- T11
def test_t11_update_and_delete_before_create(spark):
    log = log_df(spark, [(1, 1, 10, "u", "x", 1), (2, 2, 11, "d", None, 1)])
    h = changes.scd2_history(log, "CustomerID", ["Name"]).collect()
    assert [(r.CustomerID, r.Name, r.is_current) for r in h] == [(1, "x", True)]


# --------------------------------------------------------------- STR-5
def test_str5_older_event_in_later_batch(spark):
    log = log_df(spark, [(1, 2, 20, "u", "new", 1), (1, 1, 10, "u", "old", 2)])
    guarded = changes.current_state(log, "CustomerID", ["Name"]).first()
    assert guarded.Name == "new"
    ref = changes.current_state(log, "CustomerID", ["Name"], order_guard=False, batch="batch").first()
    assert ref.Name == "old"


# --------------------------------------------------------------- FLT-9
def test_flt9_dead_letter_reasons(spark):
    rows = [
        msg(1, "c", 10, after=cust(1)),
        msg(2, None, None),                                   # tombstone
        msg(3, "x", 0, raw="{oops"),                          # malformed
        msg(4, "x", 0, raw='{"schema": {}}'),                 # no payload
        msg(5, "c", 10, after={"Name": "nokey"}),             # null key
        msg(6, "d", 12, before=cust(1)),                      # delete: keyed by before image
    ]
    parsed = env.parse_messages(messages(spark, rows), CUST)
    dead = {r.offset: r.reason for r in env.dead_letters(parsed, "CustomerID").collect()}
    assert dead == {2: "null_value", 3: "unparsable", 4: "unparsable", 5: "no_key"}
    ok = env.to_change_log(parsed, "CustomerID", ["CustomerID", "Name"]).collect()
    assert sorted(r.seq for r in ok) == [1, 6]
    legacy = env.dead_letters(parsed, "CustomerID", legacy_null_key=True).collect()
    assert {r.offset for r in legacy} == {2, 3, 4, 5, 6}      # reference drops every delete


# ------------------------------------------------------- AGG-1 / JOIN-1
def test_top_products_null_cases(spark):
    items = spark.createDataFrame([(1, 2.0), (1, None), (2, None), (None, 5.0), (3, 4.0), (4, 1.0)],
                                  "l_partkey long, l_quantity double")
    parts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a"), (None, "z")],
                                  "p_partkey long, p_name string")
    got = {(r.p_name, r.quantity) for r in metrics.top_products(items, parts).collect()}
    assert got == {("a", 3), ("b", 0)}        # same names merge; all-null sum is 0; null keys never match


def test_top_products_ties_in_name_order(spark):
    items = spark.createDataFrame([(i, 1.0) for i in range(12)], "l_partkey long, l_quantity double")
    parts = spark.createDataFrame([(i, f"p{i:02d}") for i in range(12)], "p_partkey long, p_name string")
    got = [r.p_name for r in metrics.top_products(items, parts).collect()]
    assert got == [f"p{i:02d}" for i in range(10)]


# --------------------------------------------------------------- RUL-8
def test_rul8_addresses(spark):
    from cdc_lake.operators.quality import address_violations
    a = spark.createDataFrame([
        (1, 10, True, False), (1, 11, False, True),           # fine
        (2, 20, True, False), (2, 21, True, False),           # two billing
        (3, 30, True, True), (3, 31, False, False),           # both / neither
    ], "customer_id int, address_id int, is_billing boolean, is_shipping boolean")
    got = {(r.customer_id, r.address_id, r.rule) for r in address_violations(a).collect()}
    assert got == {(2, None, "several_billing"), (3, 30, "both_flags"), (3, 31, "no_flag")}


def test_parse_without_before_image(spark):
    rows = [msg(1, "c", 10, after=cust(1)), msg(2, "d", 12, before=cust(1))]
    parsed = env.parse_messages(messages(spark, rows), CUST, with_before=False)
    assert "before" not in parsed.columns
    assert [r.seq for r in env.to_change_log(parsed, "CustomerID", ["CustomerID", "Name"]).collect()] == [1]
    assert [(r.offset, r.reason) for r in env.dead_letters(parsed, "CustomerID").collect()] == [(2, "no_key")]
