"""Data-quality rules over the lake tables.

Each rule is one declarative plan: CHECK / NOT NULL counts in a single
aggregate pass per table, key uniqueness as a grouped count, foreign keys as
anti joins of the *distinct* child keys (the child side is aggregated map-side
before its shuffle, so a hot child key costs one row per task), business rules
as joins on the order key.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdc_lake.contracts import Contract, ForeignKey
from cdc_lake.sources.feeds import CANCELLED, CASH_METHOD, DELIVERED, RETURNED
from cdc_lake.operators.sequence import keyed_next, keyed_prev


def contract_report(df: DataFrame, c: Contract) -> DataFrame:
    """``(table_name, rule, violations)`` for every NOT NULL and CHECK rule and the PK.

    The rule counts are a global aggregate: no row is shuffled for them.  The
    uniqueness check is a second, narrow pass that shuffles only the key and a
    count (combined map-side).
    """
    rules: list[tuple[str, Column]] = []
    for col in c.not_null:
        rules.append((f"not_null:{col}", F.col(col).isNull()))
    for name, expr in c.checks.items():
        rules.append((f"check:{name}", ~F.expr(expr)))
    table = F.lit(c.table)
    counts = df.agg(*[F.count_if(cond).cast("long").alias(f"r{i}") for i, (_, cond) in enumerate(rules)],
                    F.lit(0).alias("_any"))
    twice = df.groupBy(*c.pk).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).cast("long").alias("pk"))
    unique = twice.select(table.alias("table_name"), F.lit("pk_unique").alias("rule"), F.col("pk").alias("violations"))
    if not rules:
        return unique
    return counts.select(F.inline(F.array(*[
        F.struct(table.alias("table_name"), F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, (n, _) in enumerate(rules)]))).unionByName(unique)


def pk_duplicates(df: DataFrame, pk: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def fk_orphans(tables: dict[str, DataFrame], fks) -> DataFrame:
    """Child keys with no parent row: ``(fk_name, child_key, n_rows)``.  Null keys pass.

    All foreign keys are checked by one join on ``(parent, key)``:

    * each child table is read once; a row gives one ``(parent id, key)`` per FK
      with a count in the slot of that FK among the FKs of its parent; the
      union is summed per
      ``(parent, key)`` (partial aggregation before the shuffle, so a hot key
      is one row per task);
    * every parent column is read once and made distinct per ``(parent, key)``;
    * both sides are hash-partitioned on ``(parent, key)`` by their
      aggregates, so the join adds no exchange: two shuffles in all, however
      many foreign keys there are.
    """
    fks = list(fks)
    parents = list(dict.fromkeys((fk.parent, fk.parent_col) for fk in fks))
    pid = {p: i for i, p in enumerate(parents)}
    slot: list[int] = []
    for i, fk in enumerate(fks):
        slot.append(sum(1 for g in fks[:i] if (g.parent, g.parent_col) == (fk.parent, fk.parent_col)))
    slots = [f"_n{j}" for j in range(max(slot) + 1)]

    # One scan per child table, whatever number of foreign keys it has.
    by_child: dict[str, list[Column]] = {}
    for i, fk in enumerate(fks):
        by_child.setdefault(fk.child, []).append(F.struct(
            F.lit(pid[(fk.parent, fk.parent_col)]).alias("parent"), F.col(fk.child_col).cast("long").alias("key"),
            *[F.lit(int(j == slot[i])).alias(c) for j, c in enumerate(slots)]))
    children = union_all([tables[child].select(F.inline(F.array(*rows))) for child, rows in by_child.items()])
    keys = (children.where(F.col("key").isNotNull())
            .groupBy("parent", "key").agg(*[F.sum(c).alias(c) for c in slots]))
    par = union_all([tables[t].select(F.lit(pid[(t, c)]).alias("parent"), F.col(c).cast("long").alias("key"))
                     for t, c in parents]).distinct()
    orphans = keys.join(par.withColumn("_found", F.lit(True)), ["parent", "key"], "left").where(
        F.col("_found").isNull())

    def name_of(j: int) -> Column:
        """FK name of slot ``j``, looked up by parent id (null: no such FK)."""
        names = [None] * len(parents)
        for i, fk in enumerate(fks):
            if slot[i] == j:
                names[pid[(fk.parent, fk.parent_col)]] = fk.name
        return F.element_at(F.array(*[F.lit(n).cast("string") for n in names]), F.col("parent") + 1)

    per_slot = F.array(*[F.struct(name_of(j).alias("fk_name"), F.col(c).alias("n_rows"))
                         for j, c in enumerate(slots)])
    return (orphans.select(F.col("key").alias("child_key"), F.inline(per_slot))
            .where(F.col("n_rows") > 0).select("fk_name", "child_key", "n_rows"))


def check_tables(tables: dict[str, DataFrame], contracts: dict, fks) -> DataFrame:
    """``(table_name, rule, violations)`` of every contract and foreign key that the given tables allow:
    a foreign key is checked when child and parent are both there."""
    reports = [contract_report(df, contracts[t]) for t, df in tables.items() if t in contracts]
    usable = [fk for fk in fks if fk.child in tables and fk.parent in tables]
    if usable:
        orphans = fk_orphans(tables, usable).groupBy("fk_name").agg(F.sum("n_rows").cast("long").alias("n"))
        names = orphans.sparkSession.createDataFrame([(fk.child, fk.name) for fk in usable], "t string, fk string")
        reports.append(names.join(orphans, names["fk"] == orphans["fk_name"], "left").select(
            F.col("t").alias("table_name"), F.concat(F.lit("fk:"), "fk").alias("rule"),
            F.coalesce("n", F.lit(0).cast("long")).alias("violations")))
    return union_all(reports)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def order_total_reconcile(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Stored order total vs the sum of its lines, in DECIMAL(18,2).

    Lines are summed per order before the join (map-side partial aggregation);
    both sides then meet on the order key.
    """
    one = F.lit(Decimal(1))
    line = (F.col("l_extendedprice").cast("decimal(18,2)")
            * (one - F.col("l_discount").cast("decimal(4,2)"))
            * (one + F.col("l_tax").cast("decimal(4,2)")))
    lines = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(line).cast("decimal(18,2)").alias("computed_total"),
        F.count(F.lit(1)).alias("n_lines"))
    o = orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("stored_total"))
    j = o.join(lines, "o_orderkey")
    return j.select("o_orderkey", "stored_total", "computed_total", "n_lines",
                    (F.col("stored_total") - F.col("computed_total")).cast("decimal(18,2)").alias("difference"))


# The lawful order status transitions (from -> to); 0 = no earlier status.
ALLOWED_TRANSITIONS = ((0, 1), (1, 2), (2, 3))


def _allowed(prev: Column, cur: Column) -> Column:
    """A null status is no lawful status."""
    p = F.coalesce(prev, F.lit(0))
    conds = [(p == a) & (cur == b) for a, b in ALLOWED_TRANSITIONS]
    return F.coalesce(reduce(lambda x, y: x | y, conds), F.lit(False))


def status_transitions(chg: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Each status change with the status before it (``lag`` per order)."""
    return keyed_prev(chg, ["o_orderkey"], ["ts", "seq"], ["status_id"], bucket)


def illegal_transitions(chg: DataFrame, bucket: Column | None = None) -> DataFrame:
    t = status_transitions(chg, bucket)
    return t.where(~_allowed(F.col("prev_status_id"), F.col("status_id"))).select(
        "o_orderkey", F.col("prev_status_id").alias("from_status"),
        F.col("status_id").alias("to_status"), "ts")


def status_timeline(chg: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Status versions per order: valid from its event to the next one."""
    t = keyed_next(chg, ["o_orderkey"], ["ts", "seq"], ["ts"], bucket)
    return t.select("o_orderkey", "status_id", F.col("ts").alias("valid_from"),
                    F.col("next_ts").alias("valid_to"))


def payment_violations(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payment rules: none for returned/cancelled orders, cash only once
    delivered, amount equal to the order total, at most one per order."""
    p = payments.where(F.col("o_orderkey").isNotNull())
    j = p.join(orders.select("o_orderkey", "status_id", "total"), "o_orderkey", "left")
    s = F.col("status_id")
    rules = [
        ("paid_returned_or_cancelled", s.isin(RETURNED, CANCELLED)),
        ("cash_before_delivery", (F.col("method_id") == CASH_METHOD) & (s != DELIVERED)),
        ("amount_mismatch", F.col("amount") != F.col("total")),
        ("order_missing", s.isNull()),
    ]
    flags = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
    # Orders paid more than once, counted map-side.  Their keys are compared as text: the join then deals both sides out
    # itself instead of reusing the count's partitioning, so Spark can split a key with very many payments in either join.
    twice = p.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        F.col("o_orderkey").cast("string").alias("_k"))
    again = p.join(twice, p["o_orderkey"].cast("string") == F.col("_k"), "left_semi")
    return j.select("payment_id", "o_orderkey", F.explode(flags).alias("rule")).unionByName(
        again.select("payment_id", "o_orderkey", F.lit("duplicate_payment").alias("rule")))


def reason_violations(orders: DataFrame, reasons: DataFrame) -> DataFrame:
    """A reason must exist exactly for returned/cancelled orders, of the matching type.

    The result of a full outer join of the orders needing a reason with the
    reasons, written as two joins whose skew Spark can split at run time
    (a full outer join cannot be split): every reason row against its order
    (left join, reasons streamed), and the orders with no reason at all (anti
    join against the distinct reason keys, combined map-side).
    """
    need = orders.where(F.col("status_id").isin(RETURNED, CANCELLED)).select("o_orderkey", "status_id")
    rs = reasons.select("o_orderkey", "reason_type")
    s, r = F.col("status_id"), F.col("reason_type")
    expected = F.when(s == RETURNED, F.lit("Return")).when(s == CANCELLED, F.lit("Cancellation"))
    v = (F.when(r.isNull(), F.lit("missing_reason"))
         .when(s.isNull(), F.lit("unexpected_reason"))
         .when(r != expected, F.lit("wrong_type")))
    per_reason = rs.join(need, "o_orderkey", "left").select(
        "o_orderkey", "status_id", "reason_type", v.alias("violation")).where(F.col("violation").isNotNull())
    missing = need.join(rs.select("o_orderkey").distinct(), "o_orderkey", "left_anti").select(
        "o_orderkey", "status_id", F.lit(None).cast("string").alias("reason_type"),
        F.lit("missing_reason").alias("violation"))
    return per_reason.unionByName(missing)


def delivered_purchases(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct (product, customer) pairs of delivered orders.

    Distinct so that a pair bought a billion times is one row: the duplicates
    are combined map-side before the shuffle, and the review join, keyed the
    same way, reuses that partitioning (a semi join cannot split a skewed
    build side at run time).
    """
    li = lineitem.select("l_orderkey", "l_partkey")
    o = orders.where(F.col("status_id") == DELIVERED).select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select("l_partkey", "o_custkey").distinct()


def verified_reviews(reviews: DataFrame, purchases: DataFrame, verified: bool = True) -> DataFrame:
    """Reviews whose author holds a delivered order with the product (or not)."""
    p = purchases.select(F.col("l_partkey").alias("_p"), F.col("o_custkey").alias("_c"))
    cond = (reviews.l_partkey == p._p) & (reviews.custkey == p._c)
    return reviews.join(p, cond, "left_semi" if verified else "left_anti")


def address_violations(addresses: DataFrame, customer: str = "customer_id", address: str = "address_id",
                       billing: str = "is_billing", shipping: str = "is_shipping") -> DataFrame:
    """Addresses: exactly one of billing/shipping each; at most one billing
    address per customer.  ``(customer, address, rule)``; the per-customer
    rule reports the customer with a null address id."""
    b, s = F.coalesce(F.col(billing), F.lit(False)), F.coalesce(F.col(shipping), F.lit(False))
    per_address = addresses.where(b == s).select(
        customer, address, F.when(b, F.lit("both_flags")).otherwise(F.lit("no_flag")).alias("rule"))
    per_customer = (addresses.groupBy(customer).agg(F.count_if(b).alias("_nb")).where(F.col("_nb") > 1)
                    .select(customer, F.lit(None).cast(addresses.schema[address].dataType).alias(address),
                            F.lit("several_billing").alias("rule")))
    return per_address.unionByName(per_customer)


def low_stock(stock: DataFrame) -> DataFrame:
    """Products at or below their reorder threshold."""
    return stock.where(F.col("qty_in_stock") <= F.col("reorder_threshold")).select(
        "p_partkey", "qty_in_stock", "reorder_threshold")


def seeded_pick(df: DataFrame, key: str, k: int, seed: str) -> DataFrame:
    """Reproducible random pick of ``k`` rows: order by ``md5(key || ':' || seed)``.

    Plans as ``TakeOrderedAndProject``: each task keeps its best ``k`` rows.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(":" + seed)))
    return df.orderBy(h, F.col(key)).limit(k)
