"""Revenue, sales and spending reports (Q1, Q2, Q13-Q17).

Every fact table is aggregated on its foreign key *before* it meets a
dimension: the partial/final aggregation collapses hot keys map-side, and the
join then sees one row per key.  Catalyst does not move aggregates below joins
on its own, so the order is written out here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import in_month, month_number


def top_selling_products(order_items: DataFrame, products: DataFrame,
                         k: int | None = None, ordered: bool = True) -> DataFrame:
    """Q1: product_id, product_name, total_quantity_sold; unsold products are
    absent (inner join).  ``k`` turns it into a top-k report."""
    sold = order_items.groupBy("product_id").agg(
        F.sum("quantity").cast("bigint").alias("total_quantity_sold"))
    out = sold.join(products.select("product_id", F.col("name").alias("product_name")),
                    "product_id", "inner").select(
        "product_id", "product_name", "total_quantity_sold")
    if ordered or k is not None:
        out = out.orderBy(F.desc("total_quantity_sold"), F.asc("product_id"))
    return out.limit(k) if k is not None else out


def store_revenue(stores: DataFrame, orders: DataFrame, ordered: bool = True) -> DataFrame:
    """Q2: store_id, store_name, total_revenue (sum of order totals, 0 for a
    store without orders)."""
    rev = (orders.where(F.col("store_id").isNotNull())
           .groupBy("store_id").agg(F.sum("total_amount").alias("_rev")))
    out = stores.select("store_id", F.col("name").alias("store_name")).join(
        rev, "store_id", "left").select(
        "store_id", "store_name",
        F.coalesce(F.col("_rev"), F.lit(0).cast("decimal(22,2)")).alias("total_revenue"))
    return out.orderBy(F.desc("total_revenue"), F.asc("store_id")) if ordered else out


def customer_spending(customers: DataFrame, orders: DataFrame, ordered: bool = True) -> DataFrame:
    """Q16: customer_id, customer_name, total_spending (0 when no orders)."""
    spend = (orders.where(F.col("customer_id").isNotNull())
             .groupBy("customer_id").agg(F.sum("total_amount").alias("_spend")))
    out = customers.select("customer_id", F.col("name").alias("customer_name")).join(
        spend, "customer_id", "left").select(
        "customer_id", "customer_name",
        F.coalesce(F.col("_spend"), F.lit(0).cast("decimal(22,2)")).alias("total_spending"))
    return out.orderBy(F.desc("total_spending"), F.asc("customer_id")) if ordered else out


def monthly_store_revenue(stores: DataFrame, orders: DataFrame, ordered: bool = True) -> DataFrame:
    """Q17: store_id, store_name, year, month, monthly_revenue — one row per
    store and month with orders."""
    per_month = (orders.where(F.col("store_id").isNotNull())
                 .groupBy("store_id",
                          F.year("order_date").alias("year"),
                          F.month("order_date").alias("month"))
                 .agg(F.sum("total_amount").alias("monthly_revenue")))
    out = per_month.join(stores.select("store_id", F.col("name").alias("store_name")),
                         "store_id", "inner").select(
        "store_id", "store_name", "year", "month", "monthly_revenue")
    return out.orderBy("store_name", "year", "month") if ordered else out


def orders_for(orders: DataFrame, ids: Iterable[int] | DataFrame,
               key: str = "customer_id") -> DataFrame:
    """Q13: all orders of the given customers.  A short id list becomes an
    ``IN`` filter pushed to the scan; an id DataFrame becomes a semi join."""
    if isinstance(ids, DataFrame):
        keys = ids.select(F.col(ids.columns[0]).alias("_k")).where(F.col("_k").isNotNull())
        return orders.join(keys, orders[key] == keys["_k"], "left_semi")
    return orders.where(F.col(key).isin(list(ids)))


def sales_report_list_price(stores: DataFrame, orders: DataFrame, order_items: DataFrame,
                            products: DataFrame, year: int, month: str | int) -> DataFrame:
    """Q14: store_name, monthly_sales = sum(quantity x current product price)
    for orders of that month.  The month filter makes the store-order join
    inner, so stores without orders that month are absent; a store with orders
    but no priced lines shows 0.  Grouped by name, so equal names merge.

    The month filter reaches the orders scan as a date range; the month's
    orders then meet their lines (one join), the lines their list price, and
    the sum is taken per store before the store names are attached."""
    m = month if isinstance(month, int) else month_number(month)
    month_orders = orders.where(in_month("order_date", year, m) & F.col("store_id").isNotNull()) \
        .select("order_id", "store_id")
    lines = month_orders.join(order_items.select("order_id", "product_id", "quantity"), "order_id", "left")
    # Quantities per (store, product) first: the products meet that, not every line.
    sold = lines.groupBy("store_id", "product_id").agg(F.sum("quantity").cast("decimal(19,0)").alias("_sold"))
    priced = sold.join(products.select("product_id", F.col("price").alias("_list")), "product_id", "left")
    per_store = priced.groupBy("store_id").agg(F.sum(F.col("_sold") * F.col("_list")).alias("_value"))
    return (per_store.join(stores.select("store_id", F.col("name").alias("store_name")),
                           "store_id", "inner")
            .groupBy("store_name")
            .agg(F.coalesce(F.sum("_value"), F.lit(0).cast("decimal(32,2)")).alias("monthly_sales"))
            .orderBy("store_name"))


def sales_report_item_price(stores: DataFrame, orders: DataFrame, order_items: DataFrame,
                            year: int, month: int) -> DataFrame:
    """Q15: store_name, monthly_revenue = sum(item price x quantity), inner
    joins, revenue descending (one join of the month's orders with their
    lines, summed per store, then named)."""
    month_orders = orders.where(in_month("order_date", year, month) & F.col("store_id").isNotNull()) \
        .select("order_id", "store_id")
    per_store = (month_orders.join(order_items.select("order_id", "quantity", "price"), "order_id", "inner")
                 .groupBy("store_id").agg(F.sum(F.col("price") * F.col("quantity")).alias("_value")))
    return (per_store.join(stores.select("store_id", F.col("name").alias("store_name")),
                           "store_id", "inner")
            .groupBy("store_name").agg(F.sum("_value").alias("monthly_revenue"))
            .orderBy(F.desc("monthly_revenue"), F.asc("store_name")))


def inactive_customers(customers: DataFrame, orders: DataFrame, as_of=None, years: int = 2) -> DataFrame:
    """Q12: customers with no order in the ``years`` up to ``as_of``, with the
    NULL rules of ``NOT IN`` (see :func:`mercantile.operators.joins.not_in`)."""
    from ..functions.scalar import years_before
    from .joins import not_in
    recent = orders.where(F.col("order_date") >= years_before(as_of, years)).select("customer_id")
    return not_in(customers, "customer_id", recent)
