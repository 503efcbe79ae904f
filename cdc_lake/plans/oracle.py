"""SQL oracles: for every catalogue entry, the same result written as plain SQL.

DuckDB runs them over the driver tables (registered as views) and the result
is compared with the Spark plan, order-insensitively.  Derived feeds are
common table expressions with the same definitions as
:mod:`cdc_lake.sources.feeds`; each query pulls in the ones it needs.
"""

from __future__ import annotations

from cdc_lake.contracts import CONTRACTS, FOREIGN_KEYS

FEEDS: dict[str, tuple[tuple[str, ...], str]] = {
    "chg_users": ((), """
        SELECT user_id, event_id AS seq, ts, CAST(ts AS DATE) AS batch_day,
               CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
               value, props
        FROM events"""),
    "chg_users_late": (("chg_users",), """
        SELECT *, CASE WHEN seq % 7 = 0 THEN batch_day + 1 ELSE batch_day END AS arrival_day
        FROM chg_users"""),
    "stock": ((), """
        SELECT p_partkey, CAST((p_partkey * 37) % 1001 AS INT) AS qty_in_stock,
               CAST(10 + p_partkey % 41 AS INT) AS reorder_threshold,
               CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost
        FROM part"""),
    "order_final": ((), """
        SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
               CASE WHEN o_orderkey % 33 = 0 THEN 4 WHEN o_orderkey % 50 = 1 THEN 5
                    WHEN o_orderstatus = 'F' THEN 3 WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS status_id
        FROM orders"""),
    "chg_order_status": ((), """
        SELECT o_orderkey, 1 AS seq, o_orderdate AS ts, 'c' AS op, 1 AS status_id FROM orders
        UNION ALL
        SELECT o_orderkey, 2, o_orderdate + INTERVAL 1 DAY, 'u', 2 FROM orders
        WHERE o_orderstatus IN ('P', 'F') AND o_orderkey % 97 <> 0
        UNION ALL
        SELECT o_orderkey, 3, o_orderdate + INTERVAL 3 DAY, 'u', 3 FROM orders WHERE o_orderstatus = 'F'"""),
    "payments": (("order_final",), """
        SELECT o_orderkey AS payment_id, o_orderkey, 1 + o_orderkey % 5 AS method_id, total AS amount
        FROM order_final
        WHERE (status_id NOT IN (4, 5) AND NOT (o_orderkey % 5 = 0 AND status_id <> 3)) OR o_orderkey % 89 = 0"""),
    "reasons": (("order_final",), """
        SELECT o_orderkey,
               CASE WHEN status_id = 4 AND o_orderkey % 2 = 0 THEN 'Return' ELSE 'Cancellation' END AS reason_type
        FROM order_final WHERE (status_id IN (4, 5) AND o_orderkey % 7 <> 0) OR o_orderkey % 101 = 0"""),
    "reviews": (("order_final",), """
        SELECT DISTINCT l_partkey, o_custkey + CASE WHEN l_orderkey % 4 = 0 THEN 1 ELSE 0 END AS custkey,
               3 + l_linenumber % 3 AS rating
        FROM lineitem JOIN order_final ON l_orderkey = o_orderkey
        WHERE (l_orderkey * 7 + l_linenumber) % 20 = 0"""),
    "lineitem_spoiled": ((), """
        SELECT * REPLACE (CASE WHEN l_orderkey % 113 = 0 THEN l_partkey + 10000000 ELSE l_partkey END AS l_partkey)
        FROM lineitem"""),
    "sales": ((), """
        SELECT l_partkey AS p_partkey, l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice,
               CAST(l_quantity AS INT) AS qty
        FROM lineitem"""),
    "history": (("chg_users",), """
        SELECT user_id, value, props, ts AS valid_from, nts AS valid_to, nts IS NULL AS is_current
        FROM (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, seq) AS nts FROM chg_users) x
        WHERE op <> 'd'"""),
    "last_day": (("chg_users",), "SELECT MAX(batch_day) AS d FROM chg_users"),
}


def with_feeds(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in FEEDS[n][0]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({FEEDS[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


def _latest(src: str, part: str, order: str = "ts DESC, seq DESC") -> str:
    return (f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {part} ORDER BY {order}) AS rk "
            f"FROM {src}) z WHERE rk = 1)")


def _collapsed(src: str) -> str:
    return f"""(SELECT user_id, value, props, batch_day AS effective_date, nb AS end_date, nb IS NULL AS is_current
        FROM (SELECT *, LEAD(batch_day) OVER (PARTITION BY user_id ORDER BY batch_day) AS nb
              FROM {_latest(src, 'user_id, batch_day')} l) n
        WHERE op <> 'd')"""


def _contract_sql() -> str:
    parts = []
    for name, c in CONTRACTS.items():
        for col in c.not_null:
            parts.append(f"SELECT '{name}' AS table_name, 'not_null:{col}' AS rule, "
                         f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS violations FROM {name}")
        for rule, expr in c.checks.items():
            parts.append(f"SELECT '{name}', 'check:{rule}', "
                         f"CAST(COUNT(*) FILTER (WHERE NOT ({expr})) AS BIGINT) FROM {name}")
        pk = ", ".join(c.pk)
        parts.append(f"SELECT '{name}', 'pk_unique', CAST(COUNT(*) AS BIGINT) "
                     f"FROM (SELECT {pk} FROM {name} GROUP BY {pk} HAVING COUNT(*) > 1) d")
    return with_feeds("\nUNION ALL\n".join(parts), "reasons", "chg_users")


#: The tables after the batch of changes of ``fk_orphans_refresh``.
_FK_CHANGED = {
    "lineitem": "(SELECT CASE WHEN l_orderkey % 50 = 11 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey, l_partkey, "
                "l_suppkey FROM lineitem)",
    "customer": "(SELECT * FROM customer WHERE c_custkey % 40 <> 7)",
}


def _fk_sql(tables: dict[str, str]) -> str:
    """Orphans of all foreign keys; ``tables`` replaces tables by others."""
    parts = []
    for fk in FOREIGN_KEYS:
        child, parent = tables.get(fk.child, fk.child), tables.get(fk.parent, fk.parent)
        parts.append(
            f"SELECT '{fk.name}' AS fk_name, CAST(c.{fk.child_col} AS BIGINT) AS child_key, COUNT(*) AS n_rows "
            f"FROM {child} c WHERE c.{fk.child_col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{fk.parent_col} = c.{fk.child_col}) "
            f"GROUP BY c.{fk.child_col}")
    return with_feeds("\nUNION ALL\n".join(parts), "lineitem_spoiled", "payments", "reasons", "reviews")


_PAY_RULES = (
    ("paid_returned_or_cancelled", "status_id IN (4, 5)"),
    ("cash_before_delivery", "method_id = 1 AND status_id <> 3"),
    ("amount_mismatch", "amount <> total"),
    ("duplicate_payment", "n > 1"),
    ("order_missing", "status_id IS NULL"),
)

_USERS_MSG = """
    SELECT seq * 2 AS "offset", op, (epoch_us(ts) // 1000) AS ts_ms, user_id,
           CASE WHEN op <> 'd' THEN value END AS after_value,
           CASE WHEN op <> 'd' THEN props END AS after_props,
           CASE WHEN op <> 'c' THEN value END AS before_value
    FROM chg_users
    UNION ALL
    SELECT seq * 2 + 1, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
           CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE)
    FROM chg_users WHERE op = 'd' OR seq % 500 IN (0, 250)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["top_products"] = """
        SELECT p_name, CAST(COALESCE(SUM(CAST(l_quantity AS INT)), 0) AS BIGINT) AS quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_name IS NOT NULL
        GROUP BY p_name ORDER BY quantity DESC, p_name ASC LIMIT 10"""
    q["top_products_by_id"] = """
        SELECT p_partkey, p_name, CAST(COALESCE(SUM(CAST(l_quantity AS INT)), 0) AS BIGINT) AS quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_partkey, p_name ORDER BY quantity DESC, p_partkey ASC LIMIT 10"""
    q["parse_envelope"] = with_feeds(_USERS_MSG, "chg_users")
    q["valid_changes"] = with_feeds("""
        SELECT user_id, seq * 2 AS seq, (epoch_us(ts) // 1000) AS ts_ms, op,
               CASE WHEN op <> 'd' THEN value END AS value, CASE WHEN op <> 'd' THEN props END AS props
        FROM chg_users""", "chg_users")
    q["dead_letter"] = with_feeds("""
        SELECT 'users' AS topic, seq * 2 + 1 AS "offset",
               CASE WHEN op = 'd' THEN 'null_value' ELSE 'unparsable' END AS reason
        FROM chg_users WHERE op = 'd' OR seq % 500 IN (0, 250)""", "chg_users")
    q["epoch_ns_to_ts"] = """
        WITH x AS (SELECT event_id, epoch_us(ts) * 1000 + event_id % 1000 AS ts_ns FROM events)
        SELECT event_id, ts_ns, make_timestamp(ts_ns // 1000) AS ts_exact, ts_ns // 1000 AS us_exact,
               CAST(trunc(ts_ns / 1000000000 * 1000000) AS BIGINT) AS us_double,
               ts_ns // 1000 - CAST(trunc(ts_ns / 1000000000 * 1000000) AS BIGINT) AS off_by_us
        FROM x"""
    q["decode_decimal"] = """
        SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS amount_b64,
               CAST(c_acctbal AS DECIMAL(18,2)) AS amount_num
        FROM customer"""
    q["route_by_type"] = with_feeds("""
        SELECT o_orderkey, o_orderkey * 4 + seq AS seq, (epoch_us(ts) // 1000) AS ts_ms, op, status_id
        FROM chg_order_status""", "chg_order_status")
    q["change_keys"] = with_feeds(
        "SELECT DISTINCT batch_day, user_id FROM chg_users WHERE op IN ('u', 'd')", "chg_users")
    q["change_counts"] = with_feeds(
        "SELECT batch_day, op, COUNT(*) AS n_changes FROM chg_users GROUP BY batch_day, op", "chg_users")
    q["latest_per_key"] = with_feeds(
        f"SELECT user_id, ts, seq, op, value, props, batch_day FROM {_latest('chg_users', 'user_id')} l",
        "chg_users")
    q["latest_per_key_per_batch"] = with_feeds(
        f"SELECT user_id, batch_day, ts, seq, op, value, props "
        f"FROM {_latest('chg_users', 'user_id, batch_day')} l", "chg_users")
    current = f"SELECT user_id, ts, seq, op, value, props FROM {_latest('chg_users', 'user_id')} l WHERE op <> 'd'"
    q["current_state"] = with_feeds(current, "chg_users")
    q["current_state_keep_deleted"] = with_feeds(
        "SELECT user_id, ts, seq, op, value, props FROM "
        + _latest("(SELECT * FROM chg_users WHERE op <> 'd')", "user_id") + " l", "chg_users")
    q["last_batch_wins"] = with_feeds(
        "SELECT user_id, arrival_day, ts, seq, op, value, props FROM "
        + _latest("(SELECT * FROM chg_users_late WHERE op <> 'd')", "user_id",
                  "arrival_day DESC, ts DESC, seq DESC") + " l", "chg_users_late")
    q["upsert_snapshot"] = with_feeds(current, "chg_users")
    q["touch_updated_at"] = with_feeds(f"""
        SELECT l.user_id, l.value, l.props, a.created_at, l.ts AS updated_at, a.n_changes
        FROM {_latest('chg_users', 'user_id')} l
        JOIN (SELECT c.user_id, COUNT(*) AS n_changes,
                     MIN(CASE WHEN g.ts IS NULL OR c.ts > g.ts OR (c.ts = g.ts AND c.seq > g.seq) THEN c.ts END)
                       AS created_at
              FROM chg_users c LEFT JOIN (
                SELECT * FROM (SELECT user_id, ts, seq, ROW_NUMBER() OVER (
                  PARTITION BY user_id ORDER BY ts DESC, seq DESC) AS rk FROM chg_users WHERE op = 'd') x WHERE rk = 1) g
                ON g.user_id = c.user_id
              GROUP BY c.user_id) a
          ON a.user_id = l.user_id
        WHERE l.op <> 'd'""", "chg_users")
    q["bootstrap_union"] = """
        SELECT o_orderkey, 0 AS seq, o_orderdate AS ts, 'r' AS op, 1 AS status_id FROM orders
        UNION ALL
        SELECT o_orderkey, 2, o_orderdate + INTERVAL 1 DAY, 'u', 2 FROM orders
        WHERE o_orderstatus IN ('P', 'F') AND o_orderkey % 97 <> 0
        UNION ALL
        SELECT o_orderkey, 3, o_orderdate + INTERVAL 3 DAY, 'u', 3 FROM orders WHERE o_orderstatus = 'F'"""
    q["scd2_history"] = with_feeds("SELECT * FROM history", "history")
    q["scd2_history_hot"] = q["scd2_history"]
    q["log_history"] = with_feeds("""
        SELECT user_id, value, props, date_trunc('milliseconds', valid_from) AS valid_from,
               date_trunc('milliseconds', valid_to) AS valid_to, is_current FROM history""", "history")
    q["log_current_state"] = with_feeds(
        f"SELECT user_id, value, props, op FROM {_latest('chg_users', 'user_id')} l WHERE op <> 'd'", "chg_users")
    q["decimal_envelope"] = """
        SELECT o_orderkey AS seq,
               CASE WHEN o_orderkey % 70 <> 0 AND o_orderkey % 50 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS total,
               CASE WHEN o_orderkey % 70 = 0 THEN 'bad_op' WHEN o_orderkey % 50 = 0 THEN 'bad_decimal' END AS reason
        FROM orders"""
    q["address_violations"] = """
        WITH a AS (SELECT c_custkey AS customer_id, c_custkey * 2 AS address_id, c_custkey % 50 <> 7 AS b, c_custkey % 40 = 0 AS s
                   FROM customer
                   UNION ALL
                   SELECT c_custkey, c_custkey * 2 + 1, c_custkey % 30 = 0, c_custkey % 30 <> 0 AND c_custkey % 45 <> 1
                   FROM customer)
        SELECT customer_id, address_id, CASE WHEN b THEN 'both_flags' ELSE 'no_flag' END AS rule FROM a WHERE b = s
        UNION ALL
        SELECT customer_id, NULL, 'several_billing' FROM a WHERE b GROUP BY customer_id HAVING count(*) > 1"""
    q["scd2_refresh"] = with_feeds("SELECT * FROM history", "history")     # refreshed = full history
    q["scd2_collapsed"] = with_feeds(f"SELECT * FROM {_collapsed('chg_users')} c", "chg_users")
    q["scd2_reference_mode"] = with_feeds("""
        , s AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
                   PARTITION BY batch_day, CASE WHEN op = 'd' THEN NULL ELSE user_id END
                   ORDER BY ts DESC, seq DESC) AS rk FROM chg_users) x WHERE rk = 1),
        i AS (SELECT user_id, value, props, batch_day FROM s WHERE op IN ('c', 'u')),
        e AS (SELECT DISTINCT user_id, batch_day FROM s WHERE op IN ('u', 'd'))
        SELECT i.user_id, i.value, i.props, i.batch_day AS effective_date, MIN(e.batch_day) AS end_date,
               MIN(e.batch_day) IS NULL AS is_current
        FROM i LEFT JOIN e ON e.user_id = i.user_id AND e.batch_day > i.batch_day
        GROUP BY i.user_id, i.value, i.props, i.batch_day""", "chg_users")
    q["scd2_expire"] = with_feeds(f"""
        , hist AS {_collapsed('(SELECT * FROM chg_users WHERE batch_day < (SELECT d FROM last_day))')},
        keys AS (SELECT DISTINCT user_id FROM chg_users
                 WHERE batch_day >= (SELECT d FROM last_day) AND op IN ('u', 'd'))
        SELECT h.user_id, h.value, h.props, h.effective_date,
               CASE WHEN k.user_id IS NOT NULL AND h.is_current THEN (SELECT d FROM last_day) ELSE h.end_date END
                 AS end_date,
               CASE WHEN k.user_id IS NOT NULL AND h.is_current THEN false ELSE h.is_current END AS is_current
        FROM hist h LEFT JOIN keys k ON k.user_id = h.user_id""", "chg_users", "last_day")
    q["scd2_current"] = with_feeds("SELECT user_id, value, props, valid_from FROM history WHERE is_current",
                                   "history")
    q["history_lookup"] = with_feeds("SELECT * FROM history WHERE user_id = 7 ORDER BY valid_from", "history")
    q["history_head"] = with_feeds("SELECT * FROM history ORDER BY user_id, valid_from LIMIT 10", "history")
    q["contract_report"] = _contract_sql()
    q["pk_duplicates"] = """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""
    q["fk_orphans"] = _fk_sql({"lineitem": "lineitem_spoiled"})
    q["fk_orphans_refresh"] = _fk_sql(_FK_CHANGED)
    q["order_total_reconcile"] = """
        SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS stored_total, computed_total, n_lines,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) - computed_total AS DECIMAL(18,2)) AS difference
        FROM orders JOIN (
            SELECT l_orderkey,
                   CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                            * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS DECIMAL(18,2)) AS computed_total,
                   COUNT(*) AS n_lines
            FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o_orderkey"""
    q["stock_ledger"] = with_feeds("""
        SELECT s.p_partkey, s.l_orderkey, s.l_linenumber, s.l_suppkey, s.l_shipdate, s.qty, st.qty_in_stock,
               s.sold_to_date, st.qty_in_stock - s.sold_to_date AS balance,
               st.qty_in_stock - s.sold_to_date < 0 AS oversold
        FROM (SELECT *, CAST(SUM(qty) OVER (PARTITION BY p_partkey
                  ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice DESC, l_suppkey DESC
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS sold_to_date
              FROM sales) s
        LEFT JOIN stock st ON st.p_partkey = s.p_partkey""", "sales", "stock")
    q["stock_ledger_hot"] = q["stock_ledger"]
    q["stock_ledger_refresh"] = q["stock_ledger"]
    q["stock_balance"] = with_feeds("""
        SELECT st.p_partkey, st.qty_in_stock, COALESCE(s.sold, 0) AS sold,
               st.qty_in_stock - COALESCE(s.sold, 0) AS balance, st.qty_in_stock - COALESCE(s.sold, 0) < 0 AS oversold
        FROM stock st LEFT JOIN (SELECT p_partkey, CAST(SUM(qty) AS BIGINT) AS sold FROM sales GROUP BY p_partkey) s
          ON s.p_partkey = st.p_partkey""", "sales", "stock")
    q["illegal_transitions"] = with_feeds("""
        SELECT o_orderkey, prev AS from_status, status_id AS to_status, ts
        FROM (SELECT *, LAG(status_id) OVER (PARTITION BY o_orderkey ORDER BY ts, seq) AS prev
              FROM chg_order_status) x
        WHERE status_id IS NULL
           OR NOT ((COALESCE(prev, 0) = 0 AND status_id = 1) OR (COALESCE(prev, 0) = 1 AND status_id = 2)
                   OR (COALESCE(prev, 0) = 2 AND status_id = 3))""", "chg_order_status")
    q["status_timeline"] = with_feeds("""
        SELECT o_orderkey, status_id, ts AS valid_from,
               LEAD(ts) OVER (PARTITION BY o_orderkey ORDER BY ts, seq) AS valid_to
        FROM chg_order_status""", "chg_order_status")
    pay = "\nUNION ALL\n".join(
        f"SELECT payment_id, o_orderkey, '{name}' AS rule FROM j WHERE {cond}" for name, cond in _PAY_RULES)
    q["payment_violations"] = with_feeds(f"""
        , j AS (SELECT p.payment_id, p.o_orderkey, p.method_id, p.amount, f.status_id, f.total, c.n
               FROM payments p LEFT JOIN order_final f ON f.o_orderkey = p.o_orderkey
               JOIN (SELECT o_orderkey, COUNT(*) AS n FROM payments GROUP BY o_orderkey) c
                 ON c.o_orderkey = p.o_orderkey)
        {pay}""", "payments")
    q["reason_violations"] = with_feeds("""
        , need AS (SELECT o_orderkey, status_id FROM order_final WHERE status_id IN (4, 5)),
        j AS (SELECT COALESCE(n.o_orderkey, r.o_orderkey) AS o_orderkey, n.status_id, r.reason_type
              FROM need n FULL OUTER JOIN reasons r ON n.o_orderkey = r.o_orderkey)
        SELECT * FROM (
            SELECT o_orderkey, status_id, reason_type,
                   CASE WHEN reason_type IS NULL THEN 'missing_reason'
                        WHEN status_id IS NULL THEN 'unexpected_reason'
                        WHEN reason_type <> CASE status_id WHEN 4 THEN 'Return' WHEN 5 THEN 'Cancellation' END
                          THEN 'wrong_type' END AS violation
            FROM j) v
        WHERE violation IS NOT NULL""", "reasons")
    reviewed = """
        SELECT * FROM reviews r WHERE {neg} EXISTS (
            SELECT 1 FROM lineitem l JOIN order_final f ON l.l_orderkey = f.o_orderkey
            WHERE f.status_id = 3 AND l.l_partkey = r.l_partkey AND f.o_custkey = r.custkey)"""
    q["verified_reviews"] = with_feeds(reviewed.format(neg=""), "reviews")
    q["unverified_reviews"] = with_feeds(reviewed.format(neg="NOT"), "reviews")
    q["low_stock"] = with_feeds(
        "SELECT p_partkey, qty_in_stock, reorder_threshold FROM stock WHERE qty_in_stock <= reorder_threshold",
        "stock")
    q["seeded_pick"] = with_feeds("""
        SELECT o_orderkey, o_custkey, total FROM order_final WHERE status_id = 1
        ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey LIMIT 5""", "order_final")
    return {k: v.strip() for k, v in q.items()}
