"""Live store revenue and top products (the two views, kept current).

Streaming aggregates over the order and order-line streams.  Every micro-batch
writes the totals that changed (update mode) as a version of its own; nothing
is rewritten in place, so a reader always finds whole versions and a replayed
batch only replaces its own.  The live totals are the newest row of each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def store_revenue_stream(orders: DataFrame) -> DataFrame:
    return (orders.where(F.col("store_id").isNotNull())
            .groupBy("store_id").agg(F.sum("total_amount").alias("revenue")))


def product_sales_stream(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("product_id").agg(F.sum("quantity").cast("bigint").alias("sold"))


def changes_sink(path: str):
    """``foreachBatch`` function adding a micro-batch's changed totals."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path))
    return write


def live_totals(versions: DataFrame, key: str) -> DataFrame:
    """The newest row of each key over all versions."""
    cols = [c for c in versions.columns if c not in (key, "_batch")]
    return versions.groupBy(key).agg(*[F.max_by(c, "_batch").alias(c) for c in cols])


def with_dimension(totals: DataFrame, stores: DataFrame) -> DataFrame:
    """Q2's shape from the live totals: every store, 0 when it sold nothing."""
    return (stores.select("store_id", F.col("name").alias("store_name"))
            .join(totals, "store_id", "left")
            .select("store_id", "store_name",
                    F.coalesce(F.col("revenue"), F.lit(0).cast("decimal(22,2)")).alias("total_revenue")))


def top_products(totals: DataFrame, products: DataFrame) -> DataFrame:
    """Q1's shape from the live totals (sold products only, best first)."""
    return (totals.join(products.select("product_id", F.col("name").alias("product_name")), "product_id", "inner")
            .select("product_id", "product_name", F.col("sold").alias("total_quantity_sold"))
            .orderBy(F.desc("total_quantity_sold"), F.asc("product_id")))
