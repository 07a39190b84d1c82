"""The stored-procedure surface (P1-P4) over the bulk operators.

The six reachable procedures become functions over DataFrames (one call may
carry one row or a whole batch), and the two that return rows are also SQL
table functions so SQL users can call them; Spark cannot parse
``CREATE PROCEDURE``.  Filters on the arguments reach the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SCHEMAS
from . import admission, changes, reports


def add_customer(customers: DataFrame, name: str, email: str, phone: str, city: str) -> changes.Added:
    """sp_AddCustomer: one new customer, key after the current maximum."""
    spark = customers.sparkSession
    batch = spark.createDataFrame([(name, email, phone, city, 0)],
                                  "name string, email string, phone string, city string, seq int")
    return changes.add_customers(customers, batch, ["seq"])


def update_customer(customers: DataFrame, customer_id: int, name: str, email: str,
                    phone: str, city: str) -> changes.Upsert:
    """sp_UpdateCustomer: full overwrite of one customer; unknown id is a no-op."""
    spark = customers.sparkSession
    patch = spark.createDataFrame([(customer_id, name, email, phone, city)], SCHEMAS["customers"])
    return changes.update_by_key(customers, patch, "customer_id", table="customers")


def delete_customer(tables: dict[str, DataFrame], customer_id: int) -> changes.Refusal:
    """sp_DeleteCustomer: refused while the customer has any order."""
    ids = tables["customers"].sparkSession.createDataFrame([(customer_id,)], "customer_id bigint")
    return changes.delete_customers(tables, ids)


def get_customer_orders(orders: DataFrame, customer_id: int) -> DataFrame:
    """sp_GetCustomerOrders."""
    return reports.orders_for(orders, [customer_id])


def add_product_stock(products: DataFrame, product_id: int, quantity: int) -> changes.Deltas:
    """sp_AddProductStock: stock + quantity (CHECK stock >= 0 holds)."""
    d = products.sparkSession.createDataFrame([(product_id, quantity)], "product_id bigint, quantity int")
    return changes.add_deltas(products, d)


def generate_sales_report(stores: DataFrame, orders: DataFrame, order_items: DataFrame,
                          year: int, month: int) -> DataFrame:
    """sp_GenerateSalesReport(p_year, p_month): no cursor, a DataFrame."""
    return reports.sales_report_item_price(stores, orders, order_items, year, month)


def place_order_lines(items: DataFrame, products: DataFrame) -> admission.Admission:
    """P1 stock trigger: lines inserted one by one (greedy)."""
    return admission.admit(items, products, mode="greedy")


def register_sql(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "mercantile_") -> None:
    """Temp views ``<prefix><table>`` and the SQL table functions
    ``<prefix>customer_orders(id)`` and ``<prefix>sales_report(year, month)``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}customer_orders(p_customer_id BIGINT)
        RETURNS TABLE (order_id BIGINT, customer_id BIGINT, store_id INT, order_date DATE,
                       total_amount DECIMAL(12,2), order_status STRING)
        RETURN SELECT order_id, customer_id, store_id, order_date, total_amount, order_status
               FROM {prefix}orders WHERE customer_id = p_customer_id""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}sales_report(p_year INT, p_month INT)
        RETURNS TABLE (store_name STRING, monthly_revenue DECIMAL(38,2))
        RETURN WITH chosen AS (
                 SELECT order_id, store_id FROM {prefix}orders
                 WHERE store_id IS NOT NULL AND order_date >= make_date(p_year, p_month, 1)
                   AND order_date < add_months(make_date(p_year, p_month, 1), 1)),
               sold AS (SELECT store_id, SUM(quantity * price) AS total
                        FROM chosen JOIN {prefix}order_items USING (order_id) GROUP BY store_id)
               SELECT name, SUM(total) FROM sold JOIN {prefix}stores USING (store_id) GROUP BY name""")
