"""A key that holds most rows is split by AQE where its other side is an
aggregate or distinct keys."""

import re

import pytest

from pyspark.sql import functions as F

from mercantile.functions.keys import PID, place
from mercantile.operators import admission, joins, quality

SMALL = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
         "spark.sql.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def _orders(spark):
    """Customer 7 has 80% of the orders; customers 150 to 199 do not exist."""
    return spark.range(0, 20000).selectExpr(
        "id AS order_id", "CASE WHEN id % 10 < 8 THEN 7 ELSE id % 200 END AS customer_id",
        "DATE '2001-01-01' AS order_date", "CAST(1 AS DECIMAL(10,2)) AS total_amount")


def _customers(spark):
    return spark.range(0, 150).selectExpr("id AS customer_id", "concat('c', id) AS name")


ORPHANS = sum(1 for i in range(20000) if i % 10 >= 8 and i % 200 >= 150)


def test_hot_manager(skewed):
    staff = skewed.range(0, 20000).selectExpr(
        "id AS employee_id", "concat('e', id) AS name",
        "CASE WHEN id % 10 < 8 THEN 7 ELSE id % 200 END AS manager_id")
    rows, plan = _plan(joins.same_manager_peers(staff))
    assert "skew=true" in plan, plan
    assert len(rows) == 20000 and max(r.peer_count for r in rows) == 16000 - 1


def test_hot_foreign_key_in_violations(skewed):
    rows, plan = _plan(quality.violations(_orders(skewed), "orders", {"customers": _customers(skewed)}))
    assert "skew=true" in plan, plan
    assert sum(r.rule == "foreign_key:customers" for r in rows) == ORPHANS


def test_hot_foreign_key_in_validate(skewed):
    good, bad = quality.validate(_orders(skewed), "orders", {"customers": _customers(skewed)})
    rows, plan = _plan(bad)
    assert "skew=true" in plan, plan
    assert len(rows) == ORPHANS and good.count() == 20000 - ORPHANS


def test_hot_foreign_key_in_the_report(skewed):
    rows, plan = _plan(quality.quality_report({"orders": _orders(skewed), "customers": _customers(skewed)}))
    assert "skew=true" in plan, plan
    assert {r.violations for r in rows if r.rule == "foreign_key:customers"} == {ORPHANS}


def test_hot_product_in_greedy_rounds(skewed):
    """80% of the lines ask for one product: its lines meet the ends of a round
    in many pieces, and the result is that of a fold."""
    items = skewed.range(0, 8000).selectExpr(
        "id AS order_id", "CAST(1 AS INT) AS line_no", "DATE '2001-01-01' AS arrival",
        "CASE WHEN id % 10 < 8 THEN 7 ELSE id % 200 END AS product_id", "CAST(1 + id % 9 AS INT) AS quantity",
        "CAST(1 AS DECIMAL(12,2)) AS price")
    products = skewed.range(0, 200).selectExpr("id AS product_id", "CAST(100 AS INT) AS stock")
    left, want = {p: 100 for p in range(200)}, set()
    for i in range(8000):
        product, quantity = (7 if i % 10 < 8 else i % 200), 1 + i % 9
        if quantity <= left[product]:
            left[product] -= quantity
            want.add(i)
    res = admission.admit(items, products, mode="greedy")
    assert {r.order_id for r in res.accepted.collect()} == want
    assert {r.product_id: r.stock for r in res.products.collect()} == left
    placed = place(items.withColumn("_r", F.lit(100)), ["product_id"], ["arrival", "order_id"])
    assert placed.where("product_id = 7").select(PID).distinct().count() > 1
    rounds = admission._settle(placed, "product_id", "quantity", *admission._prefix("product_id", "quantity"))
    rows, plan = _plan(rounds)
    assert len(rows) == 8000
    # The lines' outer join with the ends is on the piece, not on the product alone.
    outer = re.findall(r"Join \[([^\]]*)\], \[[^\]]*\], LeftOuter", plan.split("== Initial Plan ==")[0])
    assert outer and all("_pid" in keys and "product_id" in keys for keys in outer), plan
