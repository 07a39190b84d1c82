"""Named stream queries R1-R3: inputs are fed as ordered file slices, the
result is read back from the sink."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import admission as r1, audit as r2, compaction, revenue as r3
from . import twins
from .admitting import GREEDY_CTE, RANKED_CTE
from .catalog import doubles, iso_dates, register, tables
from .feeder import run_slices
from .oracle import with_fixtures

R2_STORE = 5
R2_FIRST_ROLES = ("AUTOMOBILE", "BUILDING")
R2_TIMES = (dt.datetime(2001, 8, 1, 9, 0, 0), dt.datetime(2001, 8, 1, 17, 0, 0))


def _by_year(df, col):
    """Slices of ``df`` per calendar year of ``col``, oldest first; year bounds
    come from one small aggregate, slices are date ranges."""
    first, last = df.agg(F.year(F.min(col)), F.year(F.max(col))).first()
    day = lambda y: F.lit(dt.date(y, 1, 1))
    return [df.where((F.col(col) >= day(y)) & (F.col(col) < day(y + 1))) for y in range(first, last + 1)]


GREEDY_SQL = with_fixtures("""
SELECT r.order_id, r.line_no, r.product_id, r.quantity,
       strftime(r.arrival, '%Y-%m-%d') AS arrival, f.accepted
FROM ranked r JOIN fold f ON r.product_id = f.product_id AND r.rn = f.rn""",
                           "order_items", "products", extra=RANKED_CTE, recursive=GREEDY_CTE)


def _admitted(spark, slices, products):
    base = scratch_path(spark, "r1")
    out = f"{base}/out"
    run_slices(spark, slices, f"{base}/in",
               lambda s: s.writeStream.foreachBatch(r1.admission_sink(products, f"{base}/stock", out)),
               f"{base}/checkpoint")
    back = spark.read.parquet(out)
    return iso_dates(back.select("order_id", "line_no", "product_id", "quantity", "arrival", "accepted"), "arrival")


@register("R1", GREEDY_SQL)
def stream_admission(spark, sf):
    """Order lines streamed one shipping year per micro-batch; must equal the
    batch greedy result."""
    t = tables(spark, sf, "order_items", "products")
    return _admitted(spark, _by_year(t["order_items"], "arrival"), t["products"])


# Products are topped up by their shipments when the lines of TOPUP_YEAR begin.
TOPUP_YEAR = 1999
TOPUP_CTE = f"""arrived AS (
    SELECT oi.*, p.stock, (SELECT COALESCE(SUM(quantity), 0) FROM shipments s WHERE s.product_id = p.product_id) AS more,
           year(oi.arrival) >= {TOPUP_YEAR} AS late,
           ROW_NUMBER() OVER (PARTITION BY oi.product_id
                              ORDER BY oi.arrival, oi.order_id, oi.line_no, oi.quantity, oi.price) AS rn
    FROM order_items oi JOIN products p ON oi.product_id = p.product_id),
ranked AS (SELECT *, late AND NOT COALESCE(LAG(late) OVER (PARTITION BY product_id ORDER BY rn), false) AS turns
           FROM arrived)"""
TOPUP_FOLD = """fold(product_id, rn, remaining, accepted) AS (
    SELECT product_id, rn, stock + more * turns::INT - quantity * (quantity <= stock + more * turns::INT)::INT,
           quantity <= stock + more * turns::INT
    FROM ranked WHERE rn = 1
    UNION ALL
    SELECT r.product_id, r.rn,
           f.remaining + r.more * r.turns::INT - r.quantity * (r.quantity <= f.remaining + r.more * r.turns::INT)::INT,
           r.quantity <= f.remaining + r.more * r.turns::INT
    FROM fold f JOIN ranked r ON r.product_id = f.product_id AND r.rn = f.rn + 1)"""


@register("R1_batch", with_fixtures("""
SELECT r.order_id, r.line_no, r.product_id, r.quantity,
       strftime(r.arrival, '%Y-%m-%d') AS arrival, f.accepted
FROM ranked r JOIN fold f ON r.product_id = f.product_id AND r.rn = f.rn""",
                                    "order_items", "products", "shipments", extra=TOPUP_CTE, recursive=TOPUP_FOLD))
def stream_admission_topups(spark, sf):
    """R1 with top-up events in the stream: one year's micro-batch brings the
    shipments of every product with its lines."""
    t = tables(spark, sf, "order_items", "products", "shipments")
    lines = t["order_items"].withColumn("kind", F.lit("line"))
    topups = t["shipments"].select(
        F.lit(None).cast("bigint").alias("order_id"), "product_id", "quantity",
        F.lit(None).cast("decimal(12,2)").alias("price"), F.lit(None).cast("bigint").alias("line_no"),
        F.lit(dt.date(TOPUP_YEAR, 1, 1)).alias("arrival"), F.lit("topup").alias("kind"))
    feed = lines.unionByName(topups.select(*[F.col(c).cast(lines.schema[c].dataType) for c in lines.columns]))
    return _admitted(spark, _by_year(feed, "arrival"), t["products"])


@register("R2", with_fixtures(f"""
SELECT ROW_NUMBER() OVER (ORDER BY CASE WHEN role IN {R2_FIRST_ROLES} THEN 1 ELSE 2 END, employee_id)
         AS audit_id,
       employee_id, name, role, store_id, CAST(salary AS DOUBLE) AS salary, manager_id,
       CASE WHEN role IN {R2_FIRST_ROLES} THEN '{R2_TIMES[0]:%Y-%m-%d %H:%M:%S}'
            ELSE '{R2_TIMES[1]:%Y-%m-%d %H:%M:%S}' END AS deleted_at
FROM employees WHERE store_id = {R2_STORE}""", "employees"))
def stream_audit(spark, sf):
    """Delete requests for one store's staff in two micro-batches (the second
    repeats the first): each employee is audited once, ids continue."""
    t = tables(spark, sf, "employees")
    staff = t["employees"].where(F.col("store_id") == R2_STORE).select("employee_id")
    first_ids = (t["employees"].where((F.col("store_id") == R2_STORE) & F.col("role").isin(*R2_FIRST_ROLES))
                 .select("employee_id"))
    slices = [first_ids.withColumn("requested_at", F.lit(R2_TIMES[0])),
              staff.withColumn("requested_at", F.lit(R2_TIMES[1]))]
    base = scratch_path(spark, "r2")
    table = f"{base}/audit"
    run_slices(spark, slices, f"{base}/in",
               lambda s: r2.audit_stream(s, t["employees"]).writeStream
               .foreachBatch(r2.audit_sink(table)).outputMode("append"),
               f"{base}/checkpoint")
    back = spark.read.parquet(table).drop("_batch")
    return doubles(back, "salary").withColumn("deleted_at", F.date_format("deleted_at", "yyyy-MM-dd HH:mm:ss"))


@register("R3", twins.STORE_TOTALS)
def stream_revenue(spark, sf):
    """Orders streamed one year per micro-batch into a live revenue
    snapshot; the final snapshot equals Q2."""
    t = tables(spark, sf, "orders", "stores")
    base = scratch_path(spark, "r3")
    snap = f"{base}/snapshot"
    run_slices(spark, _by_year(t["orders"], "order_date"), f"{base}/in",
               lambda s: r3.store_revenue_stream(s).writeStream
               .foreachBatch(r3.changes_sink(snap)).outputMode("update"),
               f"{base}/checkpoint")
    return doubles(r3.with_dimension(
        r3.live_totals(spark.read.parquet(snap), "store_id"), t["stores"]), "total_revenue")


@register("R3_products", twins.PRODUCT_TOTALS)
def stream_top_products(spark, sf):
    """Order lines streamed one shipping year per micro-batch into a live
    product-sales snapshot; the final snapshot equals Q1."""
    t = tables(spark, sf, "order_items", "products")
    base = scratch_path(spark, "r3p")
    snap = f"{base}/snapshot"
    run_slices(spark, _by_year(t["order_items"], "arrival"), f"{base}/in",
               lambda s: r3.product_sales_stream(s).writeStream
               .foreachBatch(r3.changes_sink(snap)).outputMode("update"),
               f"{base}/checkpoint")
    return r3.top_products(r3.live_totals(spark.read.parquet(snap), "product_id"), t["products"])


@register("R3_compacted", twins.PRODUCT_TOTALS)
def stream_compacted_products(spark, sf):
    """R3_products with its versions kept as levelled runs; a fan of two makes
    three levels of the seven years."""
    t = tables(spark, sf, "order_items", "products")
    base = scratch_path(spark, "r3c")
    runs = f"{base}/runs"
    run_slices(spark, _by_year(t["order_items"], "arrival"), f"{base}/in",
               lambda s: r3.product_sales_stream(s).writeStream
               .foreachBatch(compaction.compacting_sink(runs, ["product_id"], fan=2)).outputMode("update"),
               f"{base}/checkpoint")
    return r3.top_products(compaction.current_totals(spark, runs, ["product_id"]), t["products"])
