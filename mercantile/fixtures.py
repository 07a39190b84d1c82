"""The retail tables as views over the driver's star-schema Parquet files.

Types follow :mod:`mercantile.schemas`; money is cast to DECIMAL once here
(exact for the test data).  Each view is lazy: only the columns a query needs
reach the Parquet scans.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scalar import money, month_label

# The latest order date in the test data, used as "today".
AS_OF = dt.date(2001, 8, 1)

# Supplier contacts become customers from this id on.
CONTACT_IDS = 1_000_000_000

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


_RAW: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's Parquet table.  The DataFrame (file listing and schema) is
    made once per session and path; every query still plans its own scan."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _RAW.get((id(spark), path))
    if hit is None or hit[0] is not spark:
        hit = (spark, spark.read.parquet(path))
        _RAW[(id(spark), path)] = hit
    return hit[1]


def stores(spark, sf_dir) -> DataFrame:
    n = raw(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias("store_id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("location"),
        F.lit(None).cast("int").alias("manager_id"),
    )


def employees(spark, sf_dir) -> DataFrame:
    c = raw(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("employee_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("role"),
        F.col("c_nationkey").alias("store_id"),
        F.abs(F.col("c_acctbal")).cast("decimal(10,2)").alias("salary"),
        F.when(key < 5, F.lit(None).cast("bigint"))
         .otherwise(F.floor((key - 5) / F.lit(8.0)).cast("bigint")).alias("manager_id"),
        F.date_add(F.lit(dt.date(1990, 1, 1)), ((key * 37) % 4000).cast("int")).alias("hire_date"),
    )


def customers(spark, sf_dir) -> DataFrame:
    c = raw(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        (F.lit(8000000000) + F.col("c_custkey")).cast("string").alias("phone"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("city"),
    )


def suppliers(spark, sf_dir) -> DataFrame:
    s = raw(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("Contact "), F.col("s_name")).alias("contact_person"),
        (F.lit(9000000000) + F.col("s_suppkey")).cast("string").alias("phone"),
        F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("city"),
    )


def products(spark, sf_dir) -> DataFrame:
    p = raw(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        (F.col("p_size") * 30).cast("int").alias("stock"),
        (F.col("p_partkey") % 10).alias("supplier_id"),
    )


def orders(spark, sf_dir) -> DataFrame:
    """Orders get the customer's nation as store (nations 23 and 24 sell
    nothing, so those orders have no store).  Left join: an order whose
    customer is unknown keeps a NULL store instead of vanishing."""
    o = raw(spark, sf_dir, "orders")
    c = raw(spark, sf_dir, "customer").select(
        F.col("c_custkey"), F.col("c_nationkey"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    return j.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("c_nationkey") >= 23, F.lit(None).cast("int"))
         .otherwise(F.col("c_nationkey")).alias("store_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        money("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
    )


def order_heads(spark, sf_dir) -> DataFrame:
    """The orders without their store, straight from one scan."""
    return raw(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        money("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
    )


def gap_customers(spark, sf_dir) -> DataFrame:
    """Customers and supplier contacts, who never order."""
    contacts = suppliers(spark, sf_dir).select(
        (F.lit(CONTACT_IDS) + F.col("supplier_id")).alias("customer_id"),
        F.col("contact_person").alias("name"),
        F.concat(F.lower("name"), F.lit("@supplier.example")).alias("email"), "phone", "city")
    return customers(spark, sf_dir).unionByName(contacts)


def gap_orders(spark, sf_dir) -> DataFrame:
    """Order heads; orders in progress are guest orders without a customer."""
    return order_heads(spark, sf_dir).withColumn(
        "customer_id", F.when(F.col("order_status") != "P", F.col("customer_id")))


def order_items(spark, sf_dir) -> DataFrame:
    li = raw(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("price"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_shipdate").cast("date").alias("arrival"),
    )


ARRIVAL = ["arrival", "order_id", "line_no", "product_id", "quantity", "price"]


def keyed_items(spark, sf_dir) -> DataFrame:
    """Order lines with a primary key, numbered in order of arrival."""
    from .functions.keys import dense_keys
    items = dense_keys(order_items(spark, sf_dir), ARRIVAL, out="order_item_id")
    return items.select("order_item_id", *[c for c in items.columns if c != "order_item_id"])


def payments(spark, sf_dir) -> DataFrame:
    o = raw(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderdate").cast("date").alias("payment_date"),
    )


def shipments(spark, sf_dir) -> DataFrame:
    """One shipment of ``p_size`` units per product, and a second one of 10
    units for every PROMO product (so some products get two deliveries)."""
    p = raw(spark, sf_dir, "part")
    first = p.select(
        F.col("p_partkey").alias("shipment_id"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_size").cast("int").alias("quantity"),
    )
    second = p.where(F.col("p_type") == "PROMO").select(
        (F.lit(1000000000) + F.col("p_partkey")).alias("shipment_id"),
        F.col("p_partkey").alias("product_id"),
        F.lit(10).alias("quantity"),
    )
    return first.unionByName(second).withColumn(
        "shipment_date", F.lit(AS_OF))


def monthly_sales(spark, sf_dir) -> DataFrame:
    """Total sales per store and calendar month, over all years."""
    return (
        orders(spark, sf_dir).where(F.col("store_id").isNotNull())
        .groupBy("store_id", month_label("order_date").alias("month"))
        .agg(F.sum("total_amount").alias("total_sales"))
    )


def employee_audit(spark, sf_dir=None) -> DataFrame:
    from .schemas import SCHEMAS
    return spark.createDataFrame([], SCHEMAS["employee_audit"])


BUILDERS = {
    "stores": stores, "employees": employees, "customers": customers,
    "suppliers": suppliers, "products": products, "orders": orders,
    "order_items": order_items, "payments": payments, "shipments": shipments,
    "order_heads": order_heads, "gap_customers": gap_customers, "gap_orders": gap_orders,
    "keyed_items": keyed_items,
    "monthly_sales": monthly_sales, "employee_audit": employee_audit,
}


def load_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    names = names or BUILDERS.keys()
    return {n: BUILDERS[n](spark, sf_dir) for n in names}


def register_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Temp views named as the tables (orders as ``shop_orders`` too)."""
    tables = load_tables(spark, sf_dir)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    tables["orders"].createOrReplaceTempView("shop_orders")
    return tables
