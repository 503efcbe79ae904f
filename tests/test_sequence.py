"""Hot-key split windows equal the plain per-key window; change-log operators
equal a small Python model on random op sequences."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdc_lake.operators import changes
from cdc_lake.operators.sequence import HotSplit, _with_bucket, hot_keys, keyed_next, keyed_prev, keyed_running_sum


def _skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else rnd.randrange(1, 40)      # key 0 holds ~40 % of rows
        rows.append((key, i, rnd.randrange(0, 5000), rnd.choice([None, rnd.randrange(-5, 20)])))
    return spark.createDataFrame(rows, "k int, seq long, ts long, v int")


def _as_set(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def test_split_next_prev_equal_plain(spark):
    df = _skewed(spark)
    bucket = F.floor(F.col("ts") / 250)
    for fn, p in ((keyed_next, "next_"), (keyed_prev, "prev_")):
        plain = fn(df, ["k"], ["ts", "seq"], ["v", "seq"])
        split = fn(df, ["k"], ["ts", "seq"], ["v", "seq"], bucket=bucket)
        cols = ["k", "seq", p + "v", p + "seq"]
        assert _as_set(plain, cols) == _as_set(split, cols)


def test_hot_split_equal_plain(spark):
    df = _skewed(spark)
    assert [r.k for r in hot_keys(df, ["k"], 0.1).collect()] == [0]
    for split in (HotSplit(F.floor(F.col("ts") / 250), share=0.1),
                  HotSplit(share=0.1, order_value=F.col("ts"), rows_per_bucket=50)):
        _check_split(spark, df, split)


def _check_split(spark, df, split):
    for fn, p in ((keyed_next, "next_"), (keyed_prev, "prev_")):
        plain = fn(df, ["k"], ["ts", "seq"], ["v", "seq"])
        hot = fn(df, ["k"], ["ts", "seq"], ["v", "seq"], bucket=split)
        cols = ["k", "seq", p + "v", p + "seq"]
        assert _as_set(plain, cols) == _as_set(hot, cols)
    carry = spark.createDataFrame([(k, 100 + k) for k in range(40)], "k int, opening int")
    plain = keyed_running_sum(df, ["k"], ["ts", "seq"], "v", "rs", carry=carry)
    hot = keyed_running_sum(df, ["k"], ["ts", "seq"], "v", "rs", bucket=split, carry=carry)
    assert _as_set(plain, ["seq", "rs", "opening"]) == _as_set(hot, ["seq", "rs", "opening"])


def test_split_equals_plain_with_null_keys_and_null_times(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 0, 0, 1, 2]), i, rnd.choice([None, rnd.randrange(400)]), rnd.choice([None, rnd.randrange(9)]))
            for i in range(1500)]
    df = spark.createDataFrame(rows, "k int, seq long, ts long, v int")
    for split in (F.floor(F.col("ts") / 50), HotSplit(F.floor(F.col("ts") / 50), share=0.1),
                  HotSplit(order_value=F.col("ts"), rows_per_bucket=40)):
        for fn, p in ((keyed_next, "next_"), (keyed_prev, "prev_")):
            plain, hot = (fn(df, ["k"], ["ts", "seq"], ["ts"], bucket=b) for b in (None, split))
            assert _as_set(plain, ["k", "seq", p + "ts"]) == _as_set(hot, ["k", "seq", p + "ts"])
        plain, hot = (keyed_running_sum(df, ["k"], ["ts", "seq"], "v", "rs", bucket=b) for b in (None, split))
        assert _as_set(plain, ["k", "seq", "rs"]) == _as_set(hot, ["k", "seq", "rs"])


def test_keys_are_split_by_their_rows_whatever_their_share(spark):
    df = spark.range(30_000).selectExpr("id % 300 AS k", "id AS seq", "id AS ts")      # 100 rows each, 0.33 % of all
    marked, _ = _with_bucket(df, ["k"], HotSplit(order_value=F.col("ts"), rows_per_bucket=60))
    assert marked.where("_hot").select("k").distinct().count() == 300
    assert _with_bucket(df, ["k"], HotSplit(order_value=F.col("ts"), rows_per_bucket=100)) is None


def test_split_running_sum_equal_plain(spark):
    df = _skewed(spark)
    plain = keyed_running_sum(df, ["k"], ["ts", "seq"], "v", "rs")
    split = keyed_running_sum(df, ["k"], ["ts", "seq"], "v", "rs", bucket=F.floor(F.col("ts") / 100))
    assert _as_set(plain, ["seq", "rs"]) == _as_set(split, ["seq", "rs"])


def test_split_history_equal_plain(spark):
    df = _skewed(spark).select(
        "k", "seq", "ts", F.when(F.col("seq") % 5 == 0, "d").otherwise("u").alias("op"), "v")
    a = changes.scd2_history(df, "k", ["v"])
    b = changes.scd2_history(df, "k", ["v"], bucket=F.floor(F.col("ts") / 300))
    cols = ["k", "v", "valid_from", "valid_to", "is_current"]
    assert _as_set(a, cols) == _as_set(b, cols)


# ----------------------------------------------------------- property test
ops = st.lists(st.tuples(st.integers(0, 4), st.sampled_from("cud"), st.integers(0, 9)), min_size=1, max_size=40)


def _model(events):
    """Apply events in (ts, seq) order to a dict: the SCD1 truth."""
    state = {}
    for key, op, val, ts, seq in sorted(events, key=lambda e: (e[3], e[4])):
        if op == "d":
            state.pop(key, None)
        else:
            state[key] = val
    return state


def _history_model(events):
    out = []
    by_key = {}
    for e in sorted(events, key=lambda e: (e[3], e[4])):
        by_key.setdefault(e[0], []).append(e)
    for key, evs in by_key.items():
        for i, (k, op, val, ts, seq) in enumerate(evs):
            if op == "d":
                continue
            nxt = evs[i + 1][3] if i + 1 < len(evs) else None
            out.append((k, val, ts, nxt, nxt is None))
    return sorted(out, key=lambda r: (r[0], r[2], r[1], -1 if r[3] is None else r[3]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ops, st.randoms(use_true_random=False))
def test_current_state_and_history_match_model(spark, evs, rnd):
    events = [(k, op, v, rnd.randrange(0, 6), seq) for seq, (k, op, v) in enumerate(evs)]
    df = spark.createDataFrame(events, "k int, op string, v int, ts long, seq long")
    cur = {r.k: r.v for r in changes.current_state(df, "k", ["v"]).collect()}
    assert cur == _model(events)
    hist = changes.scd2_history(df, "k", ["v"], bucket=F.floor(F.col("ts") / 2))
    got = sorted(((r.k, r.v, r.valid_from, r.valid_to, r.is_current) for r in hist.collect()),
                 key=lambda r: (r[0], r[2], r[1], -1 if r[3] is None else r[3]))
    assert got == _history_model(events)


def test_adaptive_buckets_are_balanced(spark):
    from cdc_lake.operators.sequence import _with_bucket
    df = _skewed(spark, n=20000)
    marked, _ = _with_bucket(df, ["k"], HotSplit(share=0.1, order_value=F.col("ts"), rows_per_bucket=200))
    sizes = [r["count"] for r in marked.where("k = 0").groupBy("_bucket").count().collect()]
    assert len(sizes) >= 30                    # ~8000 rows of the hot key cut into ~40 pieces
    assert max(sizes) <= 3 * 200


def test_no_hot_key_gives_the_plain_window(spark):
    df = _skewed(spark)
    split = HotSplit(share=0.9, order_value=F.col("ts"))      # no key holds 90 % of the rows
    for fn, p in ((keyed_next, "next_"), (keyed_prev, "prev_")):
        got = fn(df, ["k"], ["ts", "seq"], ["v"], bucket=split)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan
        cols = ["k", "seq", p + "v"]
        assert _as_set(got, cols) == _as_set(fn(df, ["k"], ["ts", "seq"], ["v"]), cols)


def test_bursty_hot_key_is_cut_evenly(spark):
    """A hot key whose rows mostly arrive in a short burst: the equi-depth
    ranges cut the burst as finely as the rest, and the result equals the
    plain window."""
    from cdc_lake.operators.sequence import _with_bucket
    rnd = random.Random(3)
    rows = []
    for i in range(20000):
        if rnd.random() < 0.4:                                   # key 0: 40 % of the rows ...
            ts = rnd.randrange(1000, 1050) if rnd.random() < 0.9 else rnd.randrange(0, 100000)
            rows.append((0, i, ts, rnd.randrange(0, 9)))         # ... 90 % of them within 50 units
        else:
            rows.append((rnd.randrange(1, 40), i, rnd.randrange(0, 100000), rnd.randrange(0, 9)))
    df = spark.createDataFrame(rows, "k int, seq long, ts long, v int")
    split = HotSplit(share=0.1, order_value=F.col("ts"), rows_per_bucket=200)
    marked, _ = _with_bucket(df, ["k"], split)
    sizes = [r["count"] for r in marked.where("k = 0").groupBy("_bucket").count().collect()]
    assert max(sizes) <= 3 * 200, max(sizes)
    _check_split(spark, df, split)


def test_hot_key_detection_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = [(k, i) for i, k in enumerate(rnd.choice(range(40)) if rnd.random() < 0.8 else rnd.randrange(40, 3000)
                                         for _ in range(20000))]
    df = spark.createDataFrame(rows, "k int, seq long")
    counts = {}
    for k, _ in rows:
        counts[k] = counts.get(k, 0) + 1
    for share in (0.01, 0.02, 0.03):
        want = sorted(k for k, n in counts.items() if n > share * len(rows))
        assert sorted(r.k for r in hot_keys(df, ["k"], share).collect()) == want


def test_range_count_not_a_power_of_two(spark):
    """Padding of the quantile bounds: 10 ranges search a 16-slot array."""
    df = _skewed(spark, n=6000)
    _check_split(spark, df, HotSplit(share=0.1, order_value=F.col("ts"), rows_per_bucket=100, ranges=10))
    _check_split(spark, df, HotSplit(share=0.1, order_value=F.col("ts"), rows_per_bucket=100, ranges=1))


def test_one_order_value_is_cut_by_the_tie_break(spark):
    """Most rows of the hot key (and of a null key) share one timestamp: composite splitters cut them into pieces within
    1.2 of the mean, in order, and the answers equal the plain window's."""
    from cdc_lake.operators.sequence import _with_bucket
    rnd = random.Random(5)
    rows = []
    for i in range(20000):
        r = rnd.random()
        if r < 0.5:
            ts = rnd.choice([500, 500, 500, 500, 700, None]) if rnd.random() < 0.9 else rnd.randrange(400, 800)
            rows.append((0 if r < 0.4 else None, i * 3, ts, rnd.randrange(9)))
        else:
            rows.append((rnd.randrange(1, 60), i * 3, rnd.randrange(1000), rnd.randrange(9)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, seq long, ts long, v int").repartition(4)
    split = HotSplit(order_value=F.col("ts"), tie=F.col("seq"), rows_per_bucket=250)
    marked, _ = _with_bucket(df, ["k"], split)
    one = marked.where("k = 0 AND ts = 500").groupBy("_bucket").agg(F.count("*").alias("n"), F.min("seq").alias("lo"),
                                                                    F.max("seq").alias("hi")).orderBy("_bucket").collect()
    sizes = [r.n for r in one]
    assert len(sizes) >= sum(sizes) // 250 > 15 and max(sizes) <= 1.2 * sum(sizes) / len(sizes)
    assert all(a.hi < b.lo for a, b in zip(one, one[1:]))
    per = [r["count"] for r in marked.where("k = 0").groupBy("_bucket").count().collect()]
    assert max(per) <= 1.2 * 250                              # no piece of the key is larger
    _check_split(spark, df, split)
