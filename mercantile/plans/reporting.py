"""Named report queries Q1, Q2, Q13-Q17."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reports
from . import twins
from .catalog import doubles, iso_dates, register, tables

Q14_YEAR, Q14_MONTH = 1996, "Mar"
Q15_YEAR, Q15_MONTH = 1998, 7
Q13_CUSTOMERS = (1, 42, 777, 1001)


@register("Q1", twins.PRODUCT_TOTALS)
def q1(spark, sf):
    t = tables(spark, sf, "order_items", "products")
    return reports.top_selling_products(t["order_items"], t["products"])


@register("Q1_top10", twins.PRODUCT_TOP10)
def q1_top10(spark, sf):
    t = tables(spark, sf, "order_items", "products")
    return reports.top_selling_products(t["order_items"], t["products"], k=10)


@register("Q2", twins.STORE_TOTALS)
def q2(spark, sf):
    t = tables(spark, sf, "stores", "orders")
    return doubles(reports.store_revenue(t["stores"], t["orders"]), "total_revenue")


@register("Q13", twins.orders_of(f"customer_id IN {Q13_CUSTOMERS}"))
def q13(spark, sf):
    t = tables(spark, sf, "orders")
    out = reports.orders_for(t["orders"], Q13_CUSTOMERS)
    return iso_dates(doubles(out, "total_amount"), "order_date")


@register("Q13_bulk", twins.orders_of(
    "customer_id IN (SELECT customer_id FROM customers WHERE city = 'NATION_7')", "customers"))
def q13_bulk(spark, sf):
    """Orders of every customer in one city: the id set is a DataFrame."""
    t = tables(spark, sf, "orders", "customers")
    ids = t["customers"].where(F.col("city") == "NATION_7").select("customer_id")
    out = reports.orders_for(t["orders"], ids)
    return iso_dates(doubles(out, "total_amount"), "order_date")


@register("Q14", twins.list_price_report(Q14_YEAR, 3))
def q14(spark, sf):
    t = tables(spark, sf, "stores", "orders", "order_items", "products")
    out = reports.sales_report_list_price(t["stores"], t["orders"], t["order_items"],
                                          t["products"], Q14_YEAR, Q14_MONTH)
    return doubles(out, "monthly_sales")


@register("Q15", twins.item_price_report(Q15_YEAR, Q15_MONTH))
def q15(spark, sf):
    t = tables(spark, sf, "stores", "orders", "order_items")
    out = reports.sales_report_item_price(t["stores"], t["orders"], t["order_items"],
                                          Q15_YEAR, Q15_MONTH)
    return doubles(out, "monthly_revenue")


@register("Q16", twins.SPENDING)
def q16(spark, sf):
    t = tables(spark, sf, "customers", "order_heads")
    return doubles(reports.customer_spending(t["customers"], t["order_heads"]), "total_spending")


@register("Q17", twins.MONTHLY_REVENUE)
def q17(spark, sf):
    t = tables(spark, sf, "stores", "orders")
    return doubles(reports.monthly_store_revenue(t["stores"], t["orders"]), "monthly_revenue")


@register("P2_orders", twins.orders_of("customer_id = 42"))
def p2_orders(spark, sf):
    """sp_GetCustomerOrders as a SQL table function."""
    from ..operators.procedures import register_sql
    register_sql(spark, tables(spark, sf, "orders", "stores", "order_items"))
    out = spark.sql("SELECT * FROM mercantile_customer_orders(42)")
    return iso_dates(doubles(out, "total_amount"), "order_date")


@register("P2_report", twins.item_price_report(Q15_YEAR, Q15_MONTH))
def p2_report(spark, sf):
    """sp_GenerateSalesReport(p_year, p_month) as a SQL table function."""
    from ..operators.procedures import register_sql
    register_sql(spark, tables(spark, sf, "orders", "stores", "order_items"))
    out = spark.sql(f"SELECT * FROM mercantile_sales_report({Q15_YEAR}, {Q15_MONTH})")
    return doubles(out, "monthly_revenue")
