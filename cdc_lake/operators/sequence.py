"""Per-key sequence operators (next row, previous row, running sum) that split hot keys.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; when
one key holds a third of the table that task holds a third of the table.  The
operators here partition the window by ``(key, bucket)`` instead, where
``bucket`` is any expression that is monotone in the sort order (an hour of the
event time, a day, a block of sequence numbers).  Rows at the edge of a bucket
get their neighbour from a per-``(key, bucket)`` summary: one row per bucket,
aggregated map-side before its shuffle, then ordered per key with a window
whose size is the number of buckets of the key, not its number of rows.

The big side is shuffled once, by ``(key, bucket)``; the join with the summary
reuses that partitioning, so only the summary moves a second time.

With ``bucket=None`` the operators fall back to the plain per-key window.

``bucket=HotSplit(...)`` splits only the keys that hold more rows than one
task should get (``rows_per_bucket``, whatever their share of the table).
They are found before the plan is built: a bounded sketch of the most frequent
keys (``approx_top_k`` of a key hash, combined map-side, no shuffle of rows)
gives at most ``CANDIDATES`` candidates, which alone are counted exactly; the
sketch misses no key that holds more than about 1 / 28,000 of the rows.  Every
other key stays in a single bucket and adds no summary rows, so the summary is
``hot keys x buckets`` rows instead of up to one per row.  When no key is hot
the operators use the plain per-key window: no join, no summary.

Split and plain windows give the same rows, also for null keys and null order
values: the summary is joined by a struct of key and bucket, in which nulls
are equal, and a null order value falls into the null bucket, which sorts first
as the null does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_B = "_bucket"
_HOT = "_hot"


# Most frequent keys taken from the sketch, and keys that the sketch tracks.
CANDIDATES, TRACKED = 10_000, 100_000
_G = "_group"


@dataclass(frozen=True)
class HotSplit:
    """Split the keys holding more than ``rows_per_bucket`` rows (and more than
    ``share`` of the rows, if given).

    Either by a fixed ``bucket`` expression, or adaptively: with
    ``order_value`` (an integral column monotone in the sort order, e.g.
    epoch microseconds) each hot key's value range is first cut at
    ``ranges - 1`` approximate quantiles (equi-depth: each range holds about
    the same number of its rows, however they cluster in time), and each
    range into equal-width pieces sized so that a piece holds about
    ``rows_per_bucket`` rows.  A key with a third of a 100 TB table is then
    cut into pieces of that size, and a burst of its rows in a short span is
    cut as finely as the rest.

    Rows of a hot key with one and the same order value are told apart by
    ``tie`` (integral, the next sort column, e.g. the sequence number): a value that
    alone holds more than ``rows_per_bucket`` rows of its key is cut again, at
    quantiles of the tie-break, so the cuts are composite splitters (order value,
    tie-break) as in a sample sort.  Without ``tie`` such rows stay together.
    """
    bucket: Column | None = None
    share: float = 0.0
    order_value: Column | None = None
    tie: Column | None = None
    rows_per_bucket: int = 1_000_000
    ranges: int = 64

    @property
    def min_rows(self) -> int:
        """A fixed bucket with a share splits by the share alone."""
        return 0 if self.order_value is None and self.share else self.rows_per_bucket


def _join_keys(df: DataFrame, keys: DataFrame, key: list[str], how: str) -> DataFrame:
    """``df`` joined with a bounded, broadcast key list; null keys match."""
    small = keys.select(*[F.col(k).alias(f"_hk{i}") for i, k in enumerate(key)],
                        *[c for c in keys.columns if c not in key])
    on = F.lit(True)
    for i, k in enumerate(key):
        on = on & df[k].eqNullSafe(small[f"_hk{i}"])
    return df.join(F.broadcast(small), on, how).drop(*[f"_hk{i}" for i in range(len(key))])


def _hot_rows(df: DataFrame, key: list[str], share: float, value: Column | None = None, min_rows: int = 0):
    """Rows ``(*key, _n[, _lo, _hi])`` of the keys holding more than ``share``
    of all rows and more than ``min_rows``, and their schema: at most ``CANDIDATES`` rows."""
    found = (df.select(F.xxhash64(*key).alias("_h"))
             .agg(F.expr(f"approx_top_k(_h, {CANDIDATES}, {TRACKED})").alias("top"), F.count("*").alias("rows")).first())
    floor = max(found["rows"] * share, min_rows)
    # The sketch's counts are upper bounds.
    hashes = [(t["item"],) for t in found["top"] or [] if t["count"] > floor]
    aggs = [F.count(F.lit(1)).alias("_n")]
    if value is not None:
        aggs += [F.min(value).alias("_lo"), F.max(value).alias("_hi")]
    if not hashes:
        return [], df.limit(0).groupBy(*key).agg(*aggs).schema
    near = df.sparkSession.createDataFrame(hashes, "_h long")
    own = df.join(F.broadcast(near), F.xxhash64(*key) == F.col("_h"), "left_semi")
    top = own.groupBy(*key).agg(*aggs).where(F.col("_n") > F.lit(floor))
    return top.collect(), top.schema


def hot_keys(df: DataFrame, key: list[str], share: float, value: Column | None = None) -> DataFrame:
    """Keys with more than ``share`` of all rows: at most ``CANDIDATES`` rows.
    With ``value``, also the key's row count and value range."""
    rows, schema = _hot_rows(df, key, share, value)
    return df.sparkSession.createDataFrame(rows, schema)


def _equi_depth_ranges(df: DataFrame, key: list[str], rows, schema, split: HotSplit) -> DataFrame:
    """Per hot key: ``_bounds`` (the inner quantiles of its order values),
    the low end ``_lows`` and sub-bucket width ``_widths`` of every range.

    One aggregate over the hot keys' rows only (the bounded key list is
    broadcast); ``percentile_approx`` is combined map-side, so a key holding a
    third of the table is one sketch per task before the shuffle.
    """
    spark = df.sparkSession
    m = split.ranges
    keys = spark.createDataFrame(rows, schema).select(*key)
    v = split.order_value.cast("long")
    qs = (_join_keys(df, keys, key, "inner")       # at most CANDIDATES keys: bounded
          .groupBy(*key).agg(F.percentile_approx(v, [i / m for i in range(1, m)], 1000).alias("_q"))
          .collect())
    by_key = {tuple(r[k] for k in key): r["_q"] for r in qs}
    out = []
    for r in rows:
        n, lo, hi = r["_n"], r["_lo"], r["_hi"]
        q = by_key.get(tuple(r[k] for k in key))
        if lo is None or not q:              # no order values: one range
            bounds, lows, widths = [], [lo or 0], [1.0]
        else:
            # Every stride-th quantile: at least as many ranges as the key needs (at most m), all of the same depth but
            # the last, cut into pieces of about rows_per_bucket rows.
            stride = max(1, m // min(m, -(-n // split.rows_per_bucket)))
            bounds = list(q[stride - 1::stride])
            edges = [lo, *bounds, hi + 1]
            lows = edges[:-1]
            depth = n * stride / m
            widths = [max((edges[i + 1] - edges[i]) * split.rows_per_bucket / depth, 1.0) for i in range(len(lows))]
        # Pad to a power of two so the range index is a fixed binary search
        # (bounds: +inf; unused ranges are never selected).
        size = _pow2(m)
        bounds = bounds + [_LONG_MAX] * (size - 1 - len(bounds))
        lows = lows + [lows[-1]] * (size - len(lows))
        widths = widths + [1.0] * (size - len(widths))
        out.append((*[r[k] for k in key], bounds, lows, widths))
    kt = [schema[k] for k in key]
    return spark.createDataFrame(out, T.StructType([
        *[T.StructField(f.name, f.dataType) for f in kt],
        T.StructField("_bounds", T.ArrayType(T.LongType())), T.StructField("_lows", T.ArrayType(T.LongType())),
        T.StructField("_widths", T.ArrayType(T.DoubleType()))])).select(*key, F.lit(True).alias(_HOT), "_bounds",
                                                                     "_lows", "_widths")


_LONG_MAX = (1 << 63) - 1


def _pow2(n: int) -> int:
    return 1 << max(n - 1, 0).bit_length()


def _piece(marked: DataFrame, value: Column, ranges: int, kind: str) -> tuple[DataFrame, Column]:
    """The piece that ``value`` falls into, by the columns ``_bounds``, ``_lows`` and ``_widths`` (+ ``kind``).

    Range index = number of bounds <= value, by binary search over the padded bounds: log2(ranges) steps of one array
    read each (code-generated; every step is its own projection, which Catalyst keeps because the index is read more
    than once).
    """
    name = f"_q{kind}"
    marked = marked.withColumn(name, F.lit(0))
    q = F.col(name)
    step = _pow2(ranges) // 2
    while step:
        marked = marked.withColumn(name, q + F.when(
            F.element_at(f"_bounds{kind}", q + step) <= value, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    lo, width = F.element_at(f"_lows{kind}", q + 1), F.element_at(f"_widths{kind}", q + 1)
    return marked, q.cast("long") * F.lit(1 << 31) + F.floor((value - lo).cast("double") / width).cast("long")


def _heavy_values(df: DataFrame, key: list[str], rows, schema, split: HotSplit):
    """(per key the sorted heavy order values, per heavy (key, value) the cuts of its tie-break), None without any.

    Found as the hot keys are: a sketch of (key, value) over the hot keys' rows, then exact counts and quantiles of the
    at most ``CANDIDATES`` candidates."""
    spark = df.sparkSession
    own = _join_keys(df, spark.createDataFrame(rows, schema).select(*key), key, "inner").withColumn(
        "_v", split.order_value.cast("long"))
    pair = [*key, "_v"]
    tie = split.tie.cast("long")
    found, found_schema = _hot_rows(own, pair, 0.0, tie, split.rows_per_bucket)
    if not found:
        return None
    cuts = _equi_depth_ranges(own, pair, found, found_schema, HotSplit(
        order_value=split.tie, rows_per_bucket=split.rows_per_bucket, ranges=split.ranges))
    cuts = cuts.withColumnsRenamed({_HOT: "_heavy", **{c: f"{c}_tie" for c in ("_bounds", "_lows", "_widths")}})
    per: dict[tuple, list[int]] = {}
    for r in found:
        per.setdefault(tuple(r[k] for k in key), []).extend([] if r["_v"] is None else [r["_v"]])
    values = spark.createDataFrame([(*k, sorted(v)) for k, v in per.items()], T.StructType(
        [*[T.StructField(k, schema[k].dataType) for k in key], T.StructField("_values", T.ArrayType(T.LongType()))]))
    return values, cuts


def _with_bucket(df: DataFrame, key: list[str], bucket):
    """``df`` with the ``_bucket`` column, and a filter selecting the rows that
    need a summary (None: all rows).  None instead of the pair when a
    ``HotSplit`` finds no hot key: the plain per-key window is then exact."""
    if not isinstance(bucket, HotSplit):
        return df.withColumn(_B, bucket), None
    adaptive = bucket.order_value is not None
    rows, schema = _hot_rows(df, key, bucket.share, bucket.order_value.cast("long") if adaptive else None,
                             bucket.min_rows)
    if not rows:
        return None
    spark = df.sparkSession
    if bucket.order_value is None:
        hot = spark.createDataFrame(rows, schema).select(*key, F.lit(True).alias(_HOT))
        fine = bucket.bucket.cast("long")
    else:
        hot = _equi_depth_ranges(df, key, rows, schema, bucket)
        # Bounded broadcast: at most CANDIDATES hot keys, collected above.
        marked = _join_keys(df, hot, key, "left").withColumn("_v", bucket.order_value.cast("long"))
        marked, fine = _piece(marked, F.col("_v"), bucket.ranges, "")
        heavy = None if bucket.tie is None else _heavy_values(df, key, rows, schema, bucket)
        if heavy is not None:
            values, cuts = heavy
            marked = _join_keys(_join_keys(marked, values, key, "left").withColumn("_t", bucket.tie.cast("long")),
                                cuts, [*key, "_v"], "left")
            marked, within = _piece(marked, F.col("_t"), bucket.ranges, "_tie")
            cut = F.coalesce(F.col("_heavy"), F.lit(False))
            below = F.size(F.filter(F.coalesce("_values", F.array().cast("array<bigint>")), lambda h: h < F.col("_v")))
            # In order: the piece, the heavy values at or below, the place within a heavy value.
            place = F.when(F.col("_v").isNull(), F.lit(0)).otherwise(2 * below + cut.cast("int"))
            is_hot = F.coalesce(F.col(_HOT), F.lit(False))
            marked = marked.withColumn(_B, F.struct(
                F.when(is_hot, fine).otherwise(F.lit(0).cast("long")).alias("piece"),
                F.when(is_hot, place).otherwise(F.lit(0)).alias("place"),
                F.when(cut, within).otherwise(F.lit(0).cast("long")).alias("within")))
            return marked.withColumn(_HOT, is_hot), F.col(_HOT)
        is_hot = F.coalesce(F.col(_HOT), F.lit(False))
        marked = marked.withColumn(_B, F.when(is_hot, fine).otherwise(F.lit(0).cast("long")))
        return marked.withColumn(_HOT, is_hot), F.col(_HOT)
    # Bounded broadcast: at most CANDIDATES hot keys, collected above.
    marked = _join_keys(df, hot, key, "left")
    is_hot = F.coalesce(F.col(_HOT), F.lit(False))
    marked = marked.withColumn(_B, F.when(is_hot, fine).otherwise(F.lit(0).cast("long")))
    return marked.withColumn(_HOT, is_hot), F.col(_HOT)


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])


def keyed_next(df: DataFrame, key: list[str], order: list[str], cols: list[str],
               bucket: Column | HotSplit | None = None, prefix: str = "next_") -> DataFrame:
    """Add ``next_<c>``: the value of ``c`` on the following row of the same key."""
    return _neighbour(df, key, order, cols, bucket, prefix, forward=True)


def keyed_prev(df: DataFrame, key: list[str], order: list[str], cols: list[str],
               bucket: Column | HotSplit | None = None, prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<c>``: the value of ``c`` on the preceding row of the same key."""
    return _neighbour(df, key, order, cols, bucket, prefix, forward=False)


def _neighbour(df, key, order, cols, bucket, prefix, forward):
    shift = F.lead if forward else F.lag
    base_cols = df.columns
    if bucket is None:
        w = Window.partitionBy(*key).orderBy(*order)
        return df.select("*", *[shift(c).over(w).alias(prefix + c) for c in cols])

    split = _with_bucket(df, key, bucket)
    if split is None:
        return _neighbour(df, key, order, cols, None, prefix, forward)
    x, needs_summary = split
    x = x.withColumn(_G, F.struct(*key, _B))
    w = Window.partitionBy(_G).orderBy(*order)
    src = x if needs_summary is None else x.where(needs_summary)
    x = x.select("*", shift(F.lit(True)).over(w).alias("_inner"),
                 *[shift(c).over(w).alias("_n_" + c) for c in cols])

    # Edge row of each (key, bucket): first row when looking forward, last when back.
    if list(cols) == [order[0]]:
        # Only the leading sort column is wanted: a plain min/max (hash aggregate).
        pick1 = F.min if forward else F.max
        edge = F.struct(pick1(cols[0]).alias(cols[0]))
    else:
        pick = F.min_by if forward else F.max_by
        edge = pick(F.struct(*[F.col(c) for c in cols]), _order_struct(order))
    edges = src.groupBy(_G).agg(edge.alias("_edge"))
    wb = Window.partitionBy(*[F.col(f"{_G}.{k}") for k in key]).orderBy(f"{_G}.{_B}")
    edges = edges.select(_G, shift("_edge").over(wb).alias("_adj"))

    j = x.join(edges, _G, "left")
    return j.select(
        *base_cols,
        *[F.when(F.col("_inner").isNotNull(), F.col("_n_" + c)).otherwise(F.col("_adj." + c)).alias(prefix + c)
          for c in cols],
    )


def keyed_running_sum(df: DataFrame, key: list[str], order: list, value: str, out: str,
                      bucket: Column | HotSplit | None = None, carry: DataFrame | None = None) -> DataFrame:
    """Add ``out``: SQL ``SUM(value)`` over the key's rows up to and including this one.

    ``carry`` (one row per key, e.g. an opening balance) is joined by key and its
    columns appear on every row; the adaptive skew join splits a hot key there.  Null handling follows SQL: the sum is null only while every value so
    far is null.
    """
    frame = (Window.unboundedPreceding, Window.currentRow)
    if bucket is None:
        w = Window.partitionBy(*key).orderBy(*order).rowsBetween(*frame)
        x = df.withColumn(out, F.sum(value).over(w))
        return x.join(carry, key, "left") if carry is not None else x

    base_cols = df.columns
    split = _with_bucket(df, key, bucket)
    if split is None:
        return keyed_running_sum(df, key, order, value, out, None, carry)
    x, needs_summary = split
    src = x if needs_summary is None else x.where(needs_summary)
    x = x.withColumn(_G, F.struct(*key, _B))
    w = Window.partitionBy(_G).orderBy(*order).rowsBetween(*frame)
    x = x.withColumn("_in_s", F.sum(value).over(w)).withColumn("_in_n", F.count(value).over(w))

    totals = src.groupBy(F.struct(*key, _B).alias(_G)).agg(F.sum(value).alias("_ts"), F.count(value).alias("_tn"))
    wb = (Window.partitionBy(*[F.col(f"{_G}.{k}") for k in key]).orderBy(f"{_G}.{_B}")
          .rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(_G, F.sum("_ts").over(wb).alias("_bs"), F.sum("_tn").over(wb).alias("_bn"))
    j = x.join(totals, _G, "left")
    n = F.coalesce(F.col("_bn"), F.lit(0)) + F.col("_in_n")
    total = F.when(n == 0, F.lit(None)).otherwise(
        F.coalesce(F.col("_bs"), F.lit(0)) + F.coalesce(F.col("_in_s"), F.lit(0)))
    out_rows = j.select(*base_cols, total.alias(out))
    return out_rows.join(carry, key, "left") if carry is not None else out_rows
