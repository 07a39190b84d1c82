"""Named queries for stock-checked admission."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import admission
from .catalog import iso_dates, register, tables
from .oracle import with_fixtures


@register("M16_atomic", with_fixtures("""
SELECT p.product_id, p.stock, CAST(SUM(oi.quantity) AS BIGINT) AS demand
FROM order_items oi JOIN products p ON oi.product_id = p.product_id
GROUP BY p.product_id, p.stock
HAVING SUM(oi.quantity) > p.stock""", "order_items", "products"))
def m16_atomic(spark, sf):
    """All order lines as one batch: the products whose demand exceeds stock
    (any of them refuses the whole batch)."""
    t = tables(spark, sf, "order_items", "products")
    return admission.admit(t["order_items"], t["products"], mode="atomic").shortages


DEMAND_CTE = "demand AS (SELECT product_id, SUM(quantity) AS demand FROM order_items GROUP BY product_id)"
STOCKED_UP = 100_000


def _atomic_stock_sql(extra_stock: int) -> str:
    return with_fixtures(f"""
SELECT product_id, CAST(stock + {extra_stock} - CASE WHEN EXISTS (
         SELECT 1 FROM demand d JOIN products q USING (product_id) WHERE d.demand > q.stock + {extra_stock})
       THEN 0 ELSE COALESCE((SELECT demand FROM demand d WHERE d.product_id = p.product_id), 0) END AS INTEGER) AS stock
FROM products p""", "order_items", "products", extra=DEMAND_CTE)


@register("M16_atomic_stock", _atomic_stock_sql(0))
def m16_atomic_stock(spark, sf):
    """All lines as one batch: one short product refuses it, no stock moves."""
    t = tables(spark, sf, "order_items", "products")
    return admission.admit(t["order_items"], t["products"], mode="atomic").products.select("product_id", "stock")


@register("M16_atomic_accepted", _atomic_stock_sql(STOCKED_UP))
def m16_atomic_accepted(spark, sf):
    """The same batch with every product stocked up: it passes, all stock falls."""
    t = tables(spark, sf, "order_items", "products")
    stocked = t["products"].withColumn("stock", (F.col("stock") + STOCKED_UP).cast("int"))
    return admission.admit(t["order_items"], stocked, mode="atomic").products.select("product_id", "stock")


GREEDY_CTE = """fold(product_id, rn, remaining, accepted) AS (
    SELECT product_id, rn,
           CASE WHEN quantity <= stock THEN stock - quantity ELSE stock END,
           quantity <= stock
    FROM ranked WHERE rn = 1
    UNION ALL
    SELECT r.product_id, r.rn,
           CASE WHEN r.quantity <= f.remaining THEN f.remaining - r.quantity ELSE f.remaining END,
           r.quantity <= f.remaining
    FROM fold f JOIN ranked r ON r.product_id = f.product_id AND r.rn = f.rn + 1)"""
RANKED_CTE = """ranked AS (
    SELECT oi.*, p.stock,
           ROW_NUMBER() OVER (PARTITION BY oi.product_id
                              ORDER BY oi.arrival, oi.order_id, oi.line_no, oi.quantity, oi.price) AS rn
    FROM order_items oi JOIN products p ON oi.product_id = p.product_id)"""


def _greedy(spark, sf):
    t = tables(spark, sf, "order_items", "products")
    return admission.admit(t["order_items"], t["products"], mode="greedy")


@register("M16_greedy", with_fixtures("""
SELECT r.order_id, r.line_no, r.product_id, r.quantity,
       strftime(r.arrival, '%Y-%m-%d') AS arrival, f.accepted
FROM ranked r JOIN fold f ON r.product_id = f.product_id AND r.rn = f.rn""",
                                      "order_items", "products", extra=RANKED_CTE, recursive=GREEDY_CTE))
def m16_greedy(spark, sf):
    """Every line, admitted one by one in arrival order: accepted or not."""
    res = _greedy(spark, sf)
    cols = ["order_id", "line_no", "product_id", "quantity", "arrival"]
    lines = (res.accepted.select(*cols, F.lit(True).alias("accepted"))
             .unionByName(res.refused.select(*cols, F.lit(False).alias("accepted"))))
    return iso_dates(lines, "arrival")


@register("M16_greedy_stock", with_fixtures("""
SELECT p.product_id,
       CAST(p.stock - COALESCE(SUM(CASE WHEN f.accepted THEN r.quantity END), 0) AS INTEGER) AS stock
FROM products p
LEFT JOIN ranked r ON r.product_id = p.product_id
LEFT JOIN fold f ON r.product_id = f.product_id AND r.rn = f.rn
GROUP BY p.product_id, p.stock""", "order_items", "products", extra=RANKED_CTE, recursive=GREEDY_CTE))
def m16_greedy_stock(spark, sf):
    return _greedy(spark, sf).products.select("product_id", "stock")


LOADS_CTE = """lines AS (SELECT strftime(arrival, '%Y-%m-%d') AS load, product_id, quantity FROM order_items),
loads AS (SELECT load, ROW_NUMBER() OVER (ORDER BY load) AS rn FROM (SELECT DISTINCT load FROM lines)),
demand AS (SELECT l.rn, x.product_id, SUM(x.quantity) AS d
           FROM lines x JOIN loads l ON x.load = l.load GROUP BY l.rn, x.product_id)"""
# The working table of each step is the whole stock table; a window over it
# decides whether the step's load fits every product.
LOADS_STEPS = """state(k, product_id, remaining, accepted) AS (
    SELECT 0, product_id, CAST(stock AS BIGINT), CAST(NULL AS BOOLEAN) FROM products
    UNION ALL
    SELECT s.k + 1, s.product_id,
           CASE WHEN BOOL_AND(s.remaining IS NULL OR COALESCE(d.d, 0) <= s.remaining) OVER ()
                THEN s.remaining - COALESCE(d.d, 0) ELSE s.remaining END,
           BOOL_AND(s.remaining IS NULL OR COALESCE(d.d, 0) <= s.remaining) OVER ()
    FROM state s LEFT JOIN demand d ON d.rn = s.k + 1 AND d.product_id = s.product_id
    WHERE s.k < (SELECT MAX(rn) FROM loads))"""


@register("M16_loads", with_fixtures("""
SELECT l.load, v.accepted, CASE WHEN v.accepted THEN NULL ELSE 'not enough stock' END AS reason
FROM loads l JOIN (SELECT DISTINCT k, accepted FROM state WHERE k > 0) v ON v.k = l.rn""",
                                     "order_items", "products", extra=LOADS_CTE, recursive=LOADS_STEPS))
def m16_loads(spark, sf):
    """The ingest path of the stock trigger: each day's shipped order lines
    are one load (one workbook, one transaction), applied day by day; a load
    is refused whole when a product falls short."""
    t = tables(spark, sf, "order_items", "products")
    lines = t["order_items"].withColumn("load", F.date_format("arrival", "yyyy-MM-dd"))
    return admission.admit_loads(lines, t["products"], "load").loads
