"""Table contracts: primary keys, NOT NULL columns, CHECK rules and foreign keys.

The source database states these in DDL; here they are data, evaluated by the
rule operators in :mod:`cdc_lake.operators.quality`.  CHECK rules are SQL
boolean expressions with SQL's CHECK meaning: a row fails only when the
expression is FALSE (NULL passes).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    child_col: str
    parent: str
    parent_col: str


@dataclass(frozen=True)
class Contract:
    table: str
    pk: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)


CONTRACTS = {
    "region": Contract("region", ("r_regionkey",), ("r_name",)),
    "nation": Contract("nation", ("n_nationkey",), ("n_name", "n_regionkey")),
    "customer": Contract("customer", ("c_custkey",), ("c_name", "c_nationkey"),
                         {"acctbal_range": "c_acctbal BETWEEN -1000 AND 10000"}),
    "supplier": Contract("supplier", ("s_suppkey",), ("s_name", "s_nationkey")),
    "part": Contract("part", ("p_partkey",), ("p_name",),
                     {"price_positive": "p_retailprice > 0", "size_positive": "p_size > 0"}),
    "orders": Contract("orders", ("o_orderkey",), ("o_custkey", "o_orderdate"),
                       {"status_known": "o_orderstatus IN ('F', 'O', 'P')",
                        "total_non_negative": "o_totalprice >= 0"}),
    "lineitem": Contract("lineitem", ("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey", "l_shipdate"),
                         {"quantity_positive": "l_quantity > 0",
                          "discount_range": "l_discount BETWEEN 0 AND 1",
                          "returnflag_known": "l_returnflag IN ('A', 'N', 'R')"}),
    "reasons": Contract("reasons", ("o_orderkey",), ("o_orderkey",),
                        {"reason_type_known": "reason_type IN ('Cancellation', 'Return')"}),
    "chg_users": Contract("chg_users", ("seq",), ("user_id", "ts", "op"),
                          {"op_known": "op IN ('c', 'u', 'd', 'r')"}),
}

FOREIGN_KEYS = (
    ForeignKey("lineitem_order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ForeignKey("lineitem_part", "lineitem", "l_partkey", "part", "p_partkey"),
    ForeignKey("lineitem_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ForeignKey("orders_customer", "orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey("customer_nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ForeignKey("supplier_nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ForeignKey("nation_region", "nation", "n_regionkey", "region", "r_regionkey"),
    ForeignKey("payments_order", "payments", "o_orderkey", "orders", "o_orderkey"),
    ForeignKey("reasons_order", "reasons", "o_orderkey", "orders", "o_orderkey"),
    ForeignKey("reviews_part", "reviews", "l_partkey", "part", "p_partkey"),
    ForeignKey("reviews_customer", "reviews", "custkey", "customer", "c_custkey"),
)

# Primary key, NOT NULL columns and CHECK rules of the 15 source tables.
SOURCE_CONTRACTS = {
    "Sellers": Contract("Sellers", ("SellerID",)),
    "Customers": Contract("Customers", ("CustomerID",)),
    "ProductCategories": Contract("ProductCategories", ("CategoryID",), ("CategoryName",)),
    "Products": Contract("Products", ("ProductID",)),
    "OrderStatus": Contract("OrderStatus", ("StatusID",), ("StatusName",)),
    "Orders": Contract("Orders", ("OrderID",)),
    "Reasons": Contract("Reasons", ("ReasonID",), ("OrderID", "ReasonType", "ReasonDescription"),
                        {"ReasonType": "ReasonType IN ('Cancellation', 'Return')"}),
    "OrderItems": Contract("OrderItems", ("OrderItemID",)),
    "ShoppingCarts": Contract("ShoppingCarts", ("CartID",)),
    "CartItems": Contract("CartItems", ("CartItemID",)),
    "PaymentMethods": Contract("PaymentMethods", ("PaymentMethodID",), ("MethodName",)),
    "Payments": Contract("Payments", ("PaymentID",)),
    "Reviews": Contract("Reviews", ("ReviewID",)),
    "Addresses": Contract("Addresses", ("AddressID",)),
    "Inventory": Contract("Inventory", ("InventoryID",)),
}

# The 16 foreign keys of the source tables (name, child, child column, parent, parent column).
SOURCE_FOREIGN_KEYS = (
    ForeignKey("Products_CategoryID", "Products", "CategoryID", "ProductCategories", "CategoryID"),
    ForeignKey("Products_SellerID", "Products", "SellerID", "Sellers", "SellerID"),
    ForeignKey("Orders_CustomerID", "Orders", "CustomerID", "Customers", "CustomerID"),
    ForeignKey("Orders_StatusID", "Orders", "StatusID", "OrderStatus", "StatusID"),
    ForeignKey("Reasons_OrderID", "Reasons", "OrderID", "Orders", "OrderID"),
    ForeignKey("OrderItems_OrderID", "OrderItems", "OrderID", "Orders", "OrderID"),
    ForeignKey("OrderItems_ProductID", "OrderItems", "ProductID", "Products", "ProductID"),
    ForeignKey("ShoppingCarts_CustomerID", "ShoppingCarts", "CustomerID", "Customers", "CustomerID"),
    ForeignKey("CartItems_CartID", "CartItems", "CartID", "ShoppingCarts", "CartID"),
    ForeignKey("CartItems_ProductID", "CartItems", "ProductID", "Products", "ProductID"),
    ForeignKey("Payments_OrderID", "Payments", "OrderID", "Orders", "OrderID"),
    ForeignKey("Payments_PaymentMethodID", "Payments", "PaymentMethodID", "PaymentMethods", "PaymentMethodID"),
    ForeignKey("Reviews_ProductID", "Reviews", "ProductID", "Products", "ProductID"),
    ForeignKey("Reviews_CustomerID", "Reviews", "CustomerID", "Customers", "CustomerID"),
    ForeignKey("Addresses_CustomerID", "Addresses", "CustomerID", "Customers", "CustomerID"),
    ForeignKey("Inventory_ProductID", "Inventory", "ProductID", "Products", "ProductID"),
)

# Row images of the captured source tables, as they arrive in change
# envelopes (DATETIME2 values as epoch nanoseconds, DECIMAL(18,2) as decimals).
_TS = T.LongType()
ROW_SCHEMAS = {
    "Customers": T.StructType([
        T.StructField("CustomerID", T.IntegerType()), T.StructField("Name", T.StringType()),
        T.StructField("Email", T.StringType()), T.StructField("PhoneNumber", T.StringType()),
        T.StructField("CreatedAt", _TS), T.StructField("UpdatedAt", _TS)]),
    "Orders": T.StructType([
        T.StructField("OrderID", T.IntegerType()), T.StructField("OrderNumber", T.StringType()),
        T.StructField("TotalAmount", T.DecimalType(18, 2)), T.StructField("StatusID", T.IntegerType()),
        T.StructField("CustomerID", T.IntegerType()), T.StructField("CreatedAt", _TS),
        T.StructField("UpdatedAt", _TS)]),
    "OrderItems": T.StructType([
        T.StructField("OrderItemID", T.IntegerType()), T.StructField("OrderID", T.IntegerType()),
        T.StructField("ProductID", T.IntegerType()), T.StructField("Quantity", T.IntegerType()),
        T.StructField("CurrentPrice", T.DecimalType(18, 2)), T.StructField("CreatedAt", _TS),
        T.StructField("UpdatedAt", _TS)]),
    "Products": T.StructType([
        T.StructField("ProductID", T.IntegerType()), T.StructField("Name", T.StringType()),
        T.StructField("Description", T.StringType()), T.StructField("Price", T.DecimalType(18, 2)),
        T.StructField("CategoryID", T.IntegerType()), T.StructField("SellerID", T.IntegerType()),
        T.StructField("CreatedAt", _TS), T.StructField("UpdatedAt", _TS)]),
    "Inventory": T.StructType([
        T.StructField("InventoryID", T.IntegerType()), T.StructField("InventoryName", T.StringType()),
        T.StructField("ProductID", T.IntegerType()), T.StructField("QuantityInStock", T.IntegerType()),
        T.StructField("ReorderThreshold", T.IntegerType()), T.StructField("UnitCost", T.DecimalType(18, 2)),
        T.StructField("CreatedAt", _TS), T.StructField("UpdatedAt", _TS)]),
}
PRIMARY_KEYS = {"Customers": "CustomerID", "Orders": "OrderID", "OrderItems": "OrderItemID",
                "Products": "ProductID", "Inventory": "InventoryID"}

# Row image of the derived user feed.
USER_ROW = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType())])
ORDER_STATUS_ROW = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("status_id", T.IntegerType())])
