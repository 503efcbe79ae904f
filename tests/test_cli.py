"""End to end through the command line: process change files, then read
history, current state and the Top-k products from the lake."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from cdc_lake import cli
from cdc_lake.streaming.pipeline import MESSAGE_SCHEMA
from cdc_lake.streaming.topk import RankedTotals

NS = 1_700_000_000_000_000_000


def _env(table, offset, op, ts_ms, before=None, after=None):
    p = {"op": op, "ts_ms": ts_ms}
    if before:
        p["before"] = before
    if after:
        p["after"] = after
    return (table, 0, offset, json.dumps({"payload": p}).encode())


def _cust(i, name):
    return {"CustomerID": i, "Name": name, "Email": f"{name}@x", "PhoneNumber": "1", "CreatedAt": NS, "UpdatedAt": NS}


def _prod(i, name):
    return {"ProductID": i, "Name": name, "Description": "", "Price": 5.5, "CategoryID": 1, "SellerID": 1,
            "CreatedAt": NS, "UpdatedAt": NS}


def _item(i, prod, qty):
    return {"OrderItemID": i, "OrderID": 1, "ProductID": prod, "Quantity": qty, "CurrentPrice": 5.5,
            "CreatedAt": NS, "UpdatedAt": NS}


def test_cli_end_to_end(spark, scratch, capsys):
    src, lake, ckpt = (os.path.join(scratch, x) for x in ("src", "lake", "ckpt"))
    files = {
        "customers": [_env("Customers", 1, "c", 1000, after=_cust(1, "ann")),
                      _env("Customers", 2, "u", 2000, before=_cust(1, "ann"), after=_cust(1, "anna")),
                      _env("Customers", 3, "c", 1500, after=_cust(2, "bob")),
                      _env("Customers", 4, "d", 3000, before=_cust(2, "bob"))],
        "products": [_env("Products", 1, "c", 1000, after=_prod(1, "pen")),
                     _env("Products", 2, "c", 1000, after=_prod(2, "cup")),
                     _env("Products", 3, "c", 1000, after=_prod(3, "pen"))],
        "orderitems": [_env("OrderItems", 1, "c", 1000, after=_item(1, 1, 2)),
                       _env("OrderItems", 2, "c", 1000, after=_item(2, 2, 3)),
                       _env("OrderItems", 3, "c", 1000, after=_item(3, 3, 2)),
                       _env("OrderItems", 4, "u", 2000, before=_item(2, 2, 3), after=_item(2, 2, 1)),
                       _env("OrderItems", 5, "d", 3000, before=_item(3, 3, 2))],
    }
    for name, rows in files.items():
        spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.parquet(os.path.join(src, name))

    assert cli.main(["process", "--lake", lake, "--source-dir", src, "--checkpoint", ckpt,
                     "--tables", "Customers,Products,OrderItems", "--available-now"], spark=spark) == 0

    hist = cli.history_table(spark, lake, "Customers").orderBy("CustomerID", "valid_from").collect()
    assert [(r.CustomerID, r.Name, r.is_current) for r in hist] == [(1, "ann", False), (1, "anna", True),
                                                                    (2, "bob", False)]
    assert hist[0].valid_to == hist[1].valid_from == dt.datetime(1970, 1, 1, 0, 0, 2)
    assert hist[0].CreatedAt == dt.datetime(2023, 11, 14, 22, 13, 20)       # ns image -> timestamp

    cur = cli.current_table(spark, lake, "Customers").collect()
    assert [(r.CustomerID, r.Name) for r in cur] == [(1, "anna")]

    top = [(r.Name, r.quantity) for r in cli.top_products_table(spark, lake).collect()]
    assert top == [("pen", 2), ("cup", 1)]

    assert "customers_history" in cli.register_views(spark, lake)
    rows = spark.sql("SELECT Name FROM customers_history WHERE CustomerID = :id ORDER BY valid_from",
                     args={"id": 1}).collect()
    assert [r.Name for r in rows] == ["ann", "anna"]

    cli.main(["serve", "--lake", lake, "--source-dir", os.path.join(src, "orderitems"),
              "--checkpoint", os.path.join(scratch, "serve_ckpt"), "--available-now"], spark=spark)
    served = [(r.name, r.quantity) for r in RankedTotals(spark, os.path.join(lake, "top_products")).served()
              .orderBy(F.desc("quantity"), "name").collect()]
    assert served == top
    capsys.readouterr()
    assert cli.main(["top-products", "--lake", lake, "--served"], spark=spark) == 0
    assert "pen" in capsys.readouterr().out

    cli.main(["compact", "--lake", lake], spark=spark)
    assert "Customers: compacted up to batch 0" in capsys.readouterr().out
    again = cli.history_table(spark, lake, "Customers").orderBy("CustomerID", "valid_from").collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in hist]
    assert again[0].effective_date == again[0].valid_from and again[0].end_date == again[0].valid_to
    assert again[0].source_created_at == again[0].CreatedAt
    assert [(r.CustomerID, r.Name) for r in cli.current_table(spark, lake, "Customers").collect()] == [(1, "anna")]
    assert [(r.Name, r.quantity) for r in cli.top_products_table(spark, lake).collect()] == top

    assert cli.main(["history", "--lake", lake, "--limit", "2"], spark=spark) == 0
    assert "only the first 2 rows are shown" in capsys.readouterr().out
    full = os.path.join(scratch, "history_out")
    cli.main(["history", "--lake", lake, "--out", full], spark=spark)
    assert spark.read.parquet(full).count() == 3
    assert cli.main(["history", "--lake", lake, "seven"], spark=spark) == 2
    assert cli.main(["history", "--lake", lake, "--table", "Orders"], spark=spark) == 1
    assert cli.main(["current", "--lake", lake, "--table", "Nope"], spark=spark) == 2
    assert cli.main(["top-products", "--lake", os.path.join(scratch, "nothing")], spark=spark) == 1
    said = capsys.readouterr().out
    assert "must be an integer" in said and "no data yet for Orders" in said and "unknown table Nope" in said
    cli.main(["check", "--lake", lake], spark=spark)
    report = capsys.readouterr().out
    assert "fk:OrderItems_ProductID" in report and "pk_unique" in report and "Orders_CustomerID" not in report
    cli.main(["history", "--lake", lake, "1"], spark=spark)
    cli.main(["history", "--lake", lake, "99"], spark=spark)
    cli.main(["top-products", "--lake", lake, "-k", "3"], spark=spark)
    out = capsys.readouterr().out
    assert "anna" in out and "no history for CustomerID = 99" in out and "pen" in out
