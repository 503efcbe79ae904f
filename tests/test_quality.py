"""Rule operators on hand-written rows: the edge semantics the derived fixtures
do not reach (NULL in CHECK rules, null foreign keys, duplicate payments,
reasons without orders), plus the eager upsert and the expiry step of SCD2."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdc_lake.contracts import Contract, ForeignKey
from cdc_lake.operators import changes, ledger, quality


def test_contract_report_check_semantics(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, -1), (2, "b", None), (None, "c", 3)],
                               "id int, name string, qty int")
    c = Contract("t", ("id",), ("name",), {"qty_positive": "qty > 0"})
    got = {(r.rule, r.violations) for r in quality.contract_report(df, c).collect()}
    # NULL passes a CHECK (only FALSE fails); key 1 appears twice.
    assert got == {("not_null:name", 1), ("check:qty_positive", 1), ("pk_unique", 1)}


def test_fk_orphans_null_keys_pass(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (9,)], "pid int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    fk = ForeignKey("c_p", "c", "pid", "p", "id")
    got = [(r.fk_name, r.child_key, r.n_rows) for r in quality.fk_orphans({"c": child, "p": parent}, [fk]).collect()]
    assert got == [("c_p", 9, 1)]


def test_fk_orphans_several_keys_and_parents(spark):
    # Two FKs of one child to one parent, one to another; a key orphaned by
    # both FKs of the same parent is reported once per FK.
    child = spark.createDataFrame([(1, 5, 7), (9, 9, 7), (9, None, 8), (2, 9, 8)], "a int, b int, c int")
    p1 = spark.createDataFrame([(1,), (2,), (5,)], "id long")
    p2 = spark.createDataFrame([(7,)], "id int")
    fks = [ForeignKey("c_a", "c", "a", "p1", "id"), ForeignKey("c_b", "c", "b", "p1", "id"),
           ForeignKey("c_c", "c", "c", "p2", "id")]
    got = sorted((r.fk_name, r.child_key, r.n_rows)
                 for r in quality.fk_orphans({"c": child, "p1": p1, "p2": p2}, fks).collect())
    assert got == [("c_a", 9, 2), ("c_b", 9, 2), ("c_c", 8, 2)]


def test_payment_rules(spark):
    orders = spark.createDataFrame([
        (1, 3, Decimal("10.00")), (2, 4, Decimal("5.00")), (3, 1, Decimal("7.00")), (4, 3, Decimal("8.00"))],
        "o_orderkey long, status_id int, total decimal(18,2)")
    pays = spark.createDataFrame([
        (10, 1, 2, Decimal("10.00")),            # fine
        (11, 2, 2, Decimal("5.00")),             # paid a returned order
        (12, 3, 1, Decimal("7.00")),             # cash before delivery
        (13, 4, 2, Decimal("9.00")),             # wrong amount
        (14, 4, 3, Decimal("8.00")),             # second payment of order 4
        (15, 99, 2, Decimal("1.00")),            # no such order
    ], "payment_id long, o_orderkey long, method_id long, amount decimal(18,2)")
    got = sorted((r.payment_id, r.rule) for r in quality.payment_violations(pays, orders).collect())
    assert got == [(11, "paid_returned_or_cancelled"), (12, "cash_before_delivery"),
                   (13, "amount_mismatch"), (13, "duplicate_payment"), (14, "duplicate_payment"),
                   (15, "order_missing")]


def test_reason_rules(spark):
    orders = spark.createDataFrame([(1, 4), (2, 5), (3, 4), (4, 3)], "o_orderkey long, status_id int")
    reasons = spark.createDataFrame([(1, "Return"), (2, "Return"), (4, "Cancellation"), (7, "Return")],
                                    "o_orderkey long, reason_type string")
    got = sorted((r.o_orderkey, r.violation) for r in quality.reason_violations(orders, reasons).collect())
    assert got == [(2, "wrong_type"), (3, "missing_reason"), (4, "unexpected_reason"), (7, "unexpected_reason")]


def test_illegal_transitions(spark):
    ts = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    chg = spark.createDataFrame([
        (1, 1, ts[0], "c", 1), (1, 2, ts[1], "u", 2), (1, 3, ts[2], "u", 3),    # lawful
        (2, 1, ts[0], "c", 1), (2, 2, ts[2], "u", 3),                           # skips Shipped
        (3, 1, ts[0], "c", 2),                                                  # starts at Shipped
        (4, 1, ts[0], "c", 1), (4, 2, ts[1], "u", 3), (4, 3, ts[3], "u", 2),    # goes back
    ], "o_orderkey long, seq int, ts timestamp_ntz, op string, status_id int")
    got = sorted((r.o_orderkey, r.from_status, r.to_status) for r in quality.illegal_transitions(chg).collect())
    assert got == [(2, 1, 3), (3, None, 2), (4, 1, 3), (4, 3, 2)]


def test_reviews_need_a_delivered_purchase(spark):
    lineitem = spark.createDataFrame([(1, 100), (2, 100), (3, 200)], "l_orderkey long, l_partkey long")
    orders = spark.createDataFrame([(1, 7, 3), (2, 8, 1), (3, 9, 3)], "o_orderkey long, o_custkey long, status_id int")
    reviews = spark.createDataFrame([(100, 7, 5), (100, 8, 4), (200, 7, 3)],
                                    "l_partkey long, custkey long, rating int")
    bought = quality.delivered_purchases(lineitem, orders)
    ok = {(r.l_partkey, r.custkey) for r in quality.verified_reviews(reviews, bought).collect()}
    bad = {(r.l_partkey, r.custkey) for r in quality.verified_reviews(reviews, bought, verified=False).collect()}
    assert ok == {(100, 7)} and bad == {(100, 8), (200, 7)}


def test_order_total_reconcile_decimal(spark):
    orders = spark.createDataFrame([(1, 21.78)], "o_orderkey long, o_totalprice double")
    lines = spark.createDataFrame([(1, 10.0, 0.1, 0.1), (1, 12.0, 0.0, 0.0)],
                                  "l_orderkey long, l_extendedprice double, l_discount double, l_tax double")
    (r,) = quality.order_total_reconcile(orders, lines).collect()
    assert (r.computed_total, r.difference, r.n_lines) == (Decimal("21.90"), Decimal("-0.12"), 2)


def test_stock_ledger_goes_negative(spark):
    d = [dt.datetime(2024, 1, i) for i in range(1, 4)]
    sales = spark.createDataFrame([(1, 10, 1, 5, d[0], 1.0, 4), (1, 11, 1, 5, d[1], 1.0, 4), (2, 12, 1, 5, d[2], 1.0, 1)],
                                  "p_partkey long, l_orderkey long, l_linenumber int, l_suppkey long, "
                                  "l_shipdate timestamp_ntz, l_extendedprice double, qty int")
    stock = spark.createDataFrame([(1, 6), (3, 2)], "p_partkey long, qty_in_stock int")
    rows = sorted((r.p_partkey, r.l_orderkey, r.balance, r.oversold)
                  for r in ledger.stock_ledger(sales, stock).collect())
    assert rows == [(1, 10, 2, False), (1, 11, -2, True), (2, 12, None, None)]
    bal = {r.p_partkey: (r.sold, r.balance) for r in ledger.stock_balance(sales, stock).collect()}
    assert bal == {1: (8, -2), 3: (0, 2)}


def test_upsert_and_expire(spark):
    snap = spark.createDataFrame([(1, 1, 1, "c", "a"), (2, 2, 2, "c", "b")], "k int, ts long, seq long, op string, v string")
    chg = spark.createDataFrame([(1, 5, 5, "u", "a2"), (2, 6, 6, "d", None), (3, 7, 7, "c", "c")],
                                "k int, ts long, seq long, op string, v string")
    got = sorted((r.k, r.v) for r in changes.upsert(snap, chg, "k", ["v"], order_guard=False).collect())
    assert got == [(1, "a2"), (3, "c")]
    merged = changes.upsert(snap, chg, "k", ["v"])            # the deleted key stays as a tombstone
    assert sorted((r.k, r.op, r.v) for r in merged.collect()) == [(1, "u", "a2"), (2, "d", None), (3, "c", "c")]
    late = spark.createDataFrame([(1, 3, 3, "u", "old"), (2, 4, 4, "u", "old"), (3, 8, 8, "u", "c2")],
                                 "k int, ts long, seq long, op string, v string")
    again = changes.upsert(merged, late, "k", ["v"])          # older changes lose, also against a tombstone
    assert sorted((r.k, r.op, r.v) for r in again.collect()) == [(1, "u", "a2"), (2, "d", None), (3, "u", "c2")]
    plain = changes.upsert(snap.drop("op"), chg, "k", ["v"])
    assert sorted((r.k, r.v) for r in plain.collect()) == [(1, "a2"), (3, "c")]
    with pytest.raises(ValueError):
        changes.upsert(snap.drop("ts"), chg, "k", ["v"])
    hist = spark.createDataFrame([(1, "x", 1, 2, False), (1, "y", 2, None, True), (2, "z", 1, None, True)],
                                 "k int, v string, effective_date int, end_date int, is_current boolean")
    keys = spark.createDataFrame([(1,), (1,), (5,)], "k int")
    out = sorted((r.k, r.v, r.end_date, r.is_current) for r in changes.scd2_expire(hist, keys, "k", 9).collect())
    assert out == [(1, "x", 2, False), (1, "y", 9, False), (2, "z", None, True)]


def test_reason_rules_equal_full_outer_join(spark):
    orders = spark.createDataFrame([(1, 4), (2, 4), (3, 5), (5, 5), (6, 3), (None, 4)],
                                   "o_orderkey long, status_id int")
    reasons = spark.createDataFrame(
        [(1, "Return"), (1, "Return"), (2, "Cancellation"), (None, "Return"), (5, None), (6, None), (8, "Return")],
        "o_orderkey long, reason_type string")
    orders.createOrReplaceTempView("t_orders")
    reasons.createOrReplaceTempView("t_reasons")
    want = spark.sql("""
        SELECT * FROM (
          SELECT COALESCE(n.o_orderkey, r.o_orderkey) AS o_orderkey, n.status_id, r.reason_type,
                 CASE WHEN r.reason_type IS NULL THEN 'missing_reason'
                      WHEN n.status_id IS NULL THEN 'unexpected_reason'
                      WHEN r.reason_type <> CASE n.status_id WHEN 4 THEN 'Return' WHEN 5 THEN 'Cancellation' END
                      THEN 'wrong_type' END AS violation
          FROM (SELECT * FROM t_orders WHERE status_id IN (4, 5)) n
          FULL OUTER JOIN t_reasons r ON n.o_orderkey = r.o_orderkey) x
        WHERE violation IS NOT NULL""")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = sorted((tuple(r) for r in quality.reason_violations(orders, reasons).collect()), key=key)
    assert got == sorted((tuple(r) for r in want.collect()), key=key)
    assert len(got) == 7


def test_history_head_equals_head_of_full_history(spark):
    # Key 1 has only a delete (no version), key None sorts first, key 3 has many versions.
    rows = [(None, 1, 5, "c", "n"), (1, 2, 1, "d", None), (2, 3, 2, "c", "a"), (2, 4, 9, "d", None),
            *[(3, 10 + i, 10 + i, "u", f"v{i}") for i in range(12)], (4, 40, 3, "c", "z")]
    log = spark.createDataFrame(rows, "k int, seq long, ts long, op string, v string")
    for n in (1, 3, 10):
        full = changes.scd2_history(log, "k", ["v"]).orderBy(F.col("k").asc_nulls_first(), "valid_from").limit(n)
        head = changes.history_head(log, "k", ["v"], n)
        assert [tuple(r) for r in head.collect()] == [tuple(r) for r in full.collect()]


def test_scd2_refresh_equals_full_history(spark):
    old = [(1, 1, 10, "c", "a"), (1, 2, 30, "u", "b"), (2, 3, 15, "c", "x"), (3, 4, 5, "c", "q")]
    new = [(1, 5, 20, "u", "late"),          # falls between key 1's two versions
           (2, 6, 40, "d", None),            # closes key 2
           (4, 7, 50, "c", "n")]             # a new key; key 3 is untouched
    schema = "k int, seq long, ts long, op string, v string"
    log = spark.createDataFrame(old + new, schema)
    stored = changes.scd2_history(spark.createDataFrame(old, schema), "k", ["v"])
    got = changes.scd2_refresh(stored, log, spark.createDataFrame(new, schema), "k", ["v"])
    want = changes.scd2_history(log, "k", ["v"])
    key = lambda r: (r.k, r.valid_from)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert [(r.v, r.valid_to) for r in sorted(got.where("k = 1").collect(), key=key)] == \
        [("a", 20), ("late", 30), ("b", None)]
    got.collect()                              # AQE's final plan: stored rows are not shuffled
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in p and re.search(r"BroadcastHashJoin \[k#\d+\], \[k#\d+\], LeftAnti", p)


def test_source_contracts_one_violation_per_rule(spark):
    from cdc_lake.contracts import SOURCE_CONTRACTS, SOURCE_FOREIGN_KEYS
    assert len(SOURCE_CONTRACTS) == 15 and len(SOURCE_FOREIGN_KEYS) == 16
    cols = {t: {*c.pk, *c.not_null, *[k for k in c.checks]} for t, c in SOURCE_CONTRACTS.items()}
    for fk in SOURCE_FOREIGN_KEYS:
        cols[fk.child].add(fk.child_col)
        cols[fk.parent].add(fk.parent_col)
    tables, want = {}, {}
    for t, c in SOURCE_CONTRACTS.items():
        names = sorted(cols[t])
        text = [n for n in names if not n.endswith("ID")]
        good = {n: "Return" if n in text else 1 for n in names}
        rows = [good, good]                                              # the key twice
        want[t, "pk_unique"] = 1
        for i, n in enumerate(c.not_null):
            rows.append({**good, c.pk[0]: 100 + i, n: None})
            want[t, f"not_null:{n}"] = 1
        for i, n in enumerate(c.checks):
            rows.append({**good, c.pk[0]: 200 + i, n: "Other"})
            want[t, f"check:{n}"] = 1
        for i, fk in enumerate(f for f in SOURCE_FOREIGN_KEYS if f.child == t):
            rows.append({**good, c.pk[0]: 300 + i, fk.child_col: 9000 + i})
            want[t, f"fk:{fk.name}"] = 1
        schema = ", ".join(f"{n} {'string' if n in text else 'int'}" for n in names)
        tables[t] = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    got = {(r.table_name, r.rule): r.violations
           for r in quality.check_tables(tables, SOURCE_CONTRACTS, SOURCE_FOREIGN_KEYS).collect()}
    assert got == want
    few = {t: tables[t] for t in ("Orders", "Customers")}
    rules = {r.rule for r in quality.check_tables(few, SOURCE_CONTRACTS, SOURCE_FOREIGN_KEYS).collect()}
    assert rules == {"pk_unique", "fk:Orders_CustomerID"}


def test_null_status_is_illegal(spark):
    chg = spark.createDataFrame([(1, 1, 1, 1), (1, None, 2, 2), (1, 2, 3, 3), (2, None, 1, 4)],
                                "o_orderkey long, status_id int, ts long, seq long")
    got = quality.illegal_transitions(chg).orderBy("o_orderkey", "ts").collect()
    assert [tuple(r) for r in got] == [(1, 1, None, 2), (1, None, 2, 3), (2, None, None, 1)]
