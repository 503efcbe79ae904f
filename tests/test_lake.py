"""Lake table handle (naming, existence, tolerant read), point lookup argument
check, and the sink's per-batch counters and empty-batch guard."""

import pytest
from pyspark.sql import types as T

from cdc_lake.contracts import ROW_SCHEMAS
from cdc_lake.operators import changes
from cdc_lake.sources.lake import LakeTable, table_path
from cdc_lake.streaming.pipeline import MESSAGE_SCHEMA, ChangeLogSink, TableSpec


def test_naming_rule():
    assert table_path("s3a://lake/", "OrderItems") == "s3a://lake/orderitems"


def test_missing_table_reads_empty(spark, scratch):
    t = LakeTable(spark, scratch, "Products")
    assert not t.exists()
    schema = T.StructType([T.StructField("ProductID", T.IntegerType())])
    assert t.read_or_empty(schema).count() == 0
    t.overwrite(spark.createDataFrame([(1,)], schema))
    assert t.exists()
    assert t.read_or_empty(schema).count() == 1


def test_folder_without_data_is_no_table(spark, scratch):
    """A batch with rejected messages only (or none) leaves a folder without data files."""
    spec = TableSpec("Customers", "customers", ROW_SCHEMAS["Customers"], "CustomerID")
    sink = ChangeLogSink(spec, scratch)
    sink(spark.createDataFrame([("customers", 0, 1, b"no json")], MESSAGE_SCHEMA), 0)
    log = sink.log_table(spark)
    assert not log.exists() and log.rows().count() == 0
    assert log.rows().columns[:4] == ["CustomerID", "seq", "ts_ms", "op"]
    assert sink.dead_letter_table(spark).read().first()["reason"] == "unparsable"


def test_sink_decodes_decimals_and_rejects_what_it_cannot(spark, scratch):
    def msgs(values):
        return spark.createDataFrame(
            [("orders", 0, i, f'{{"payload": {{"op": "{op}", "ts_ms": {i}, "after": {{"OrderID": {i}, "TotalAmount": {v}}}}}}}'
              .encode()) for i, (op, v) in enumerate(values)], MESSAGE_SCHEMA)

    for enc, values, want in (
            ("base64", [("c", '"MDk="'), ("c", '"+1M="'), ("c", "null"), ("c", '"*"'), ("x", '"MDk="')],
             {0: "123.45", 1: "-11.97", 2: None}),
            ("number", [("c", "123.45"), ("c", "-11.97"), ("c", "null"), ("c", '"abc"'), ("x", "1")],
             {0: "123.45", 1: "-11.97", 2: None})):
        lake = f"{scratch}/{enc}"
        spec = TableSpec("Orders", "orders", ROW_SCHEMAS["Orders"], "OrderID", ("CreatedAt", "UpdatedAt"), enc)
        sink = ChangeLogSink(spec, lake)
        sink(msgs(values), 0)
        got = {r.OrderID: None if r.TotalAmount is None else str(r.TotalAmount) for r in sink.log_table(spark).rows().collect()}
        assert got == want
        dead = sorted((r.offset, r.reason, r.raw is not None) for r in sink.dead_letter_table(spark).read().collect())
        assert dead == [(3, "bad_decimal", True), (4, "bad_op", True)]


def test_other_read_errors_are_raised(spark, scratch):
    t = LakeTable(spark, scratch, "bad")
    with open(t.path, "w") as f:        # a file where a table folder is expected
        f.write("not parquet")
    with pytest.raises(Exception):
        t.read_or_empty(T.StructType([T.StructField("x", T.IntegerType())])).collect()


def test_history_lookup_checks_argument(spark):
    h = spark.createDataFrame([(7, 2, "b"), (7, 1, "a"), (8, 1, "z")], "user_id int, valid_from int, v string")
    assert [r.v for r in changes.history_lookup(h, "user_id", "7").collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        changes.history_lookup(h, "user_id", "seven")


def test_sink_counts_and_empty_batch(spark, scratch):
    spec = TableSpec("Customers", "customers", ROW_SCHEMAS["Customers"], "CustomerID")
    sink = ChangeLogSink(spec, scratch)
    sink(spark.createDataFrame([], MESSAGE_SCHEMA), 0)
    assert not sink.log_table(spark).exists()
    rows = [("customers", 0, 1, b'{"payload": {"op": "c", "ts_ms": 1, "after": {"CustomerID": 1}}}'),
            ("customers", 0, 2, b'{"payload": {"op": "u", "ts_ms": 2, "after": {"CustomerID": 1}}}'),
            ("customers", 0, 3, b'{"payload": {"op": "d", "ts_ms": 3, "before": {"CustomerID": 1}}}'),
            ("customers", 0, 4, None)]
    sink(spark.createDataFrame(rows, MESSAGE_SCHEMA), 1)
    assert sink.last_counts == {"batch_id": 1, "c": 1, "u": 1, "d": 1, "r": 0}
    assert sink.dead_letter_table(spark).read().count() == 1


def test_delta_merge_sink_is_gated():
    from cdc_lake.streaming import delta_sink
    try:
        import delta  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError):
            delta_sink._delta()
        return
    assert delta_sink._delta() is not None


def test_table_handle_is_shared_and_refreshable(spark):
    from conftest import SF_SMALL
    from cdc_lake.sources.tables import Tables
    a, b = Tables.of(spark, SF_SMALL), Tables.of(spark, SF_SMALL + "/")
    assert a is b                                   # one handle per session and folder
    first = a.orders
    assert a.orders is first                        # resolved once
    a.refresh()
    assert a.orders is not first                    # re-read after refresh
    assert a.orders.count() == first.count()


def test_history_of_filters_first(spark):
    log = spark.createDataFrame([(7, 1, 10, "c", "a"), (7, 2, 20, "u", "b"), (8, 3, 15, "c", "x")],
                                "user_id long, seq long, ts long, op string, v string")
    full = changes.history_lookup(changes.scd2_history(log, "user_id", ["v"]), "user_id", 7)
    one = changes.history_of(log, "user_id", "7", ["v"])
    assert [tuple(r) for r in one.collect()] == [tuple(r) for r in full.collect()]
    with pytest.raises(ValueError):
        changes.history_of(log, "user_id", "seven", ["v"])


@pytest.mark.parametrize("master, refused", [("spark://host:7077", True), ("local-cluster[2,1,1024]", True), ("yarn", True),
                                             ("local[4]", False), ("local", False)])
def test_a_cluster_needs_a_shared_checkpoint_folder(master, refused):
    from types import SimpleNamespace

    from cdc_lake.session import checkpoint_dir

    conf, used = {}, []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=used.append)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=conf.get, set=conf.__setitem__))
    if refused:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(session)
        assert not used and not conf
        conf["spark.checkpoint.dir"] = "/shared/ckpt"
        assert checkpoint_dir(session) == "/shared/ckpt" and used == ["/shared/ckpt"]
    else:
        assert checkpoint_dir(session) == used[0]
