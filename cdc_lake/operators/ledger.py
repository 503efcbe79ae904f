"""Stock ledger: every sold item lowers the stock of its product.

The running balance is a per-product running sum split by time bucket (see
:mod:`cdc_lake.operators.sequence`): a best-selling product is spread over its
months instead of landing in one task.  The opening stock is joined by
product.

**Kept ledger.**  With the running balance stored in every row, one late sale would
change all later rows of its product.  The kept form stores two things instead:

* *rows* with the sum sold so far within their time bucket (``bucket`` of
  ``DAYS`` days), which a late sale changes in its own bucket only;
* a *tree* of totals per product: level 0 has the buckets' totals, a node of level
  l + 1 the sum of ``BRANCH`` neighbouring nodes of level l.  A late sale adds to
  one node per level.

The sum sold before a bucket is, per level, the total of the elder siblings of its
ancestor: at most ``BRANCH`` nodes on each of ``LEVELS`` levels, however long the
history is.

**What moves.**  The rows are laid out by (product, bucket), the tree by product (a
product's nodes are bounded by the weeks of its history, its sales are combined
map-side first).  Every step on them keeps that layout: the steps are windows,
groupings and unions of equally laid out tables, and the only join of the rows is by
product and bucket.  From the sales to the view each sale's row is shuffled once, its
week's total twice and the sum before its week once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdc_lake.operators.sequence import keyed_running_sum

# Movement order inside a product: ship date, then the unique line identity.
LEDGER_ORDER = (("l_shipdate", "asc"), ("l_orderkey", "asc"), ("l_linenumber", "asc"),
                ("l_extendedprice", "desc"), ("l_suppkey", "desc"))


def _ledger_order():
    return [getattr(F.col(c), d)() for c, d in LEDGER_ORDER]


def stock_ledger(sales: DataFrame, stock: DataFrame, bucket: Column | None = None) -> DataFrame:
    """One row per sold item: quantity, stock sold so far, balance after the sale."""
    key = "p_partkey"
    opening = stock.select(key, "qty_in_stock")
    x = keyed_running_sum(sales, [key], _ledger_order(), "qty", "sold_to_date", bucket, carry=opening)
    bal = F.col("qty_in_stock") - F.col("sold_to_date")
    return x.select(key, "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "qty",
                    "qty_in_stock", "sold_to_date", bal.alias("balance"), (bal < 0).alias("oversold"))


def stock_balance(sales: DataFrame, stock: DataFrame) -> DataFrame:
    """Per product: opening stock, quantity sold, closing balance."""
    sold = sales.groupBy("p_partkey").agg(F.sum("qty").cast("long").alias("sold"))
    j = stock.select("p_partkey", "qty_in_stock").join(sold, "p_partkey", "left")
    s = F.coalesce(F.col("sold"), F.lit(0).cast("long"))
    bal = F.col("qty_in_stock") - s
    return j.select("p_partkey", "qty_in_stock", s.alias("sold"), bal.alias("balance"),
                    (bal < 0).alias("oversold"))


# ------------------------------------------------------------- kept ledger
DAYS = 7        # days in a bucket
BRANCH = 16     # children of a tree node
LEVELS = 4
NO_DATE = -(1 << 40)    # bucket of sales without a date: before all others, as null dates sort first

NODE = ("p_partkey", "level", "node")
MOVE = ("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice", "qty")


def time_bucket(col: str = "l_shipdate") -> Column:
    return F.coalesce(F.floor(F.unix_date(F.col(col).cast("date")) / DAYS), F.lit(NO_DATE)).cast("long")


def _sold_in_bucket(moves: DataFrame) -> DataFrame:
    """Rows with the sum sold so far in their bucket; a window holds one product's sales of one bucket."""
    w = Window.partitionBy("p_partkey", "bucket").orderBy(*_ledger_order()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return moves.select("p_partkey", *MOVE, "bucket", F.sum("qty").over(w).cast("long").alias("sold_in_bucket"))


def ledger_rows(sales: DataFrame) -> DataFrame:
    """The kept rows of all sales."""
    return _sold_in_bucket(sales.select("p_partkey", *MOVE, time_bucket().alias("bucket")))


def ledger_tree(sales: DataFrame) -> DataFrame:
    """(p_partkey, level, node, sold): the totals of a table of sales on every level.

    The buckets' totals are combined map-side; a product's (as many as its weeks) then meet in one task, where its nodes
    of all levels are summed without another shuffle."""
    per = sales.groupBy("p_partkey", time_bucket().alias("_b")).agg(F.sum("qty").cast("long").alias("sold"))
    nodes = F.array(*[F.struct(F.lit(level).alias("level"), F.floor(F.col("_b") / BRANCH ** level).cast("long").alias("node"))
                      for level in range(LEVELS)])
    return per.repartition("p_partkey").select("p_partkey", "sold", F.inline(nodes)).groupBy(
        "p_partkey", "level", "node").agg(F.sum("sold").cast("long").alias("sold")).select(*NODE, "sold")


def _nodes_met(tree: DataFrame, new: DataFrame) -> DataFrame:
    """Per node of either table: ``_old`` its total in ``tree``, ``_new`` that in ``new``, ``_hit`` whether ``new`` has it.

    A grouping of the union, not a join: tables laid out by product meet where they are."""
    none = F.lit(None).cast("long")
    both = tree.select(*NODE, F.col("sold").alias("_old"), none.alias("_new"), F.lit(False).alias("_hit")).unionByName(
        new.select(*NODE, none.alias("_old"), F.col("sold").alias("_new"), F.lit(True).alias("_hit")))
    return both.groupBy(*NODE).agg(*[F.max(c).alias(c) for c in ("_old", "_new", "_hit")])


def ledger_add(rows: DataFrame, tree: DataFrame, late: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept rows and tree brought up to date with ``late`` sales of any date.

    Returns (the rows of the time buckets that change, all of them; the rows of the other buckets as they were; the
    changed tree nodes with their new totals).  With rows stored by ``bucket`` the first is what to overwrite and only
    its buckets are read: their numbers are collected (as many as there are weeks) and named in the scan's filter.
    """
    moves = late.select("p_partkey", *MOVE, time_bucket().alias("bucket"))
    weeks = sorted(r.bucket for r in moves.select("bucket").distinct().collect())
    hit = F.col("bucket").isin(weeks) if weeks else F.lit(False)
    own = rows.where(hit)
    # Kept and late rows of a (product, bucket) meet in one window; with kept rows laid out so, only the late ones move.
    met = own.withColumn("_late", F.lit(False)).unionByName(
        moves.repartition("p_partkey", "bucket").withColumn("_late", F.lit(True)), allowMissingColumns=True)
    pair = Window.partitionBy("p_partkey", "bucket").orderBy(*_ledger_order())
    touched = F.max("_late").over(pair.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    again = F.sum("qty").over(pair.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long")
    changed = met.withColumn("sold_in_bucket", F.when(touched, again).otherwise(F.col("sold_in_bucket"))).select(
        *own.columns)
    new = _nodes_met(tree, ledger_tree(late)).where("_hit").select(
        *NODE, (F.col("_new") + F.coalesce("_old", F.lit(0).cast("long"))).alias("sold"))
    return changed, rows.where(~hit), new


def tree_with(tree: DataFrame, new: DataFrame) -> DataFrame:
    """The whole tree after the changed nodes ``new``."""
    return _nodes_met(tree, new).select(*NODE, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("_old")).alias("sold"))


def sold_before(tree: DataFrame) -> DataFrame:
    """(p_partkey, bucket, sold_before): the sum sold before every bucket, from the elder siblings on every level.

    One pass over a product's nodes in the order of the tree: a node comes after all that ends before it and before its
    children.  The elder siblings of a node are the nodes of its level between its parent and itself.
    """
    level, node = F.col("level"), F.col("node")
    span = F.element_at(F.array(*[F.lit(BRANCH ** n).cast("long") for n in range(LEVELS)]), level + 1)
    w = Window.partitionBy("p_partkey").orderBy("_start", F.desc("level"))
    past, here = (w.rowsBetween(Window.unboundedPreceding, end) for end in (-1, Window.currentRow))

    def at(n: int, sums: str) -> Column:
        """A column's value at the ancestor on level ``n`` (the row itself on its own level)."""
        return F.last(F.when(level == n, F.col(sums)), ignorenulls=True).over(here)

    x = tree.withColumn("_start", node * span)
    x = x.select("*", *[F.coalesce(F.sum(F.when(level == n, F.col("sold"))).over(past), F.lit(0)).cast("long").alias(f"_sum{n}")
                        for n in range(LEVELS)])
    # The nodes of the top level are siblings of each other.
    before = at(LEVELS - 1, f"_sum{LEVELS - 1}")
    for n in range(LEVELS - 1):
        before = before + at(n, f"_sum{n}") - at(n + 1, f"_sum{n}")
    return x.select("p_partkey", "level", "node", before.alias("sold_before")).where("level = 0").select(
        "p_partkey", F.col("node").alias("bucket"), "sold_before")


def ledger_view(rows: DataFrame, tree: DataFrame, stock: DataFrame) -> DataFrame:
    """The ledger as :func:`stock_ledger` gives it, from the kept rows and tree; sales without a product are left out.

    The stock is joined to the sums before the buckets, which are by product as it is, not to the rows."""
    before = sold_before(tree).join(stock.select("p_partkey", "qty_in_stock"), "p_partkey", "left")
    x = rows.join(before, ["p_partkey", "bucket"])
    x = x.withColumn("sold_to_date", F.col("sold_before") + F.col("sold_in_bucket"))
    bal = F.col("qty_in_stock") - F.col("sold_to_date")
    return x.select("p_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "qty",
                    "qty_in_stock", "sold_to_date", bal.alias("balance"), (bal < 0).alias("oversold"))


def balance_at(rows: DataFrame, tree: DataFrame, stock: DataFrame, product: int, day) -> DataFrame:
    """Balance of one product at the end of ``day``: at most ``BRANCH`` nodes a level and one bucket of rows."""
    day = F.lit(day).cast("date")
    b = F.coalesce(F.floor(F.unix_date(day) / DAYS), F.lit(NO_DATE)).cast("long")
    node = F.col("node")
    top = F.col("level") == LEVELS - 1
    at = F.floor(b / F.pow(F.lit(float(BRANCH)), F.col("level"))).cast("long")
    elder = (node < at) & (top | (F.floor(node / BRANCH) == F.floor(at / BRANCH)))
    whole = tree.where((F.col("p_partkey") == F.lit(product)) & elder).select("sold")
    part = rows.where((F.col("p_partkey") == F.lit(product)) & (F.col("bucket") == b) & (
        F.col("l_shipdate").isNull() | (F.col("l_shipdate").cast("date") <= day))).select(F.col("qty").alias("sold"))
    sold = whole.unionByName(part).agg(F.coalesce(F.sum("sold"), F.lit(0)).cast("long").alias("sold_to_date"))
    return stock.where(F.col("p_partkey") == F.lit(product)).select("p_partkey", "qty_in_stock").join(
        sold, F.lit(True), "left").select("p_partkey", "qty_in_stock", "sold_to_date",
                                          (F.col("qty_in_stock") - F.col("sold_to_date")).alias("balance"))
