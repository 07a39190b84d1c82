import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from mercantile.operators import admission
from mercantile.session import path_exists, scratch_path
from mercantile.streaming import admission as r1, audit as r2, revenue as r3
from mercantile.plans.feeder import run_slices


def test_stream_admission_equals_greedy_and_topups(spark):
    items = spark.createDataFrame(
        [(i, 1, 1 + i % 3, dt.date(2000, 1, 1) + dt.timedelta(days=i), 4 + (i % 5)) for i in range(60)],
        "order_id bigint, line_no int, product_id bigint, arrival date, quantity int",
    ).withColumn("price", F.lit(1).cast("decimal(12,2)"))
    products = spark.createDataFrame([(1, 40), (2, 25), (3, 0)], "product_id bigint, stock int")
    slices = [items.where(f"order_id >= {a} AND order_id < {b}") for a, b in ((0, 20), (20, 45), (45, 60))]
    base = scratch_path(spark, "r1-test")
    run_slices(spark, slices, f"{base}/in",
               lambda s: s.writeStream.foreachBatch(
                   r1.admission_sink(products, f"{base}/stock", f"{base}/out")), f"{base}/ck")
    got = {r.order_id: r.accepted for r in spark.read.parquet(f"{base}/out").collect()}
    batch = admission.admit(items, products, mode="greedy")
    want = {r.order_id: True for r in batch.accepted.collect()}
    want.update({r.order_id: False for r in batch.refused.collect()})
    assert got == want


def test_stream_audit_once_per_employee(spark):
    emp = spark.createDataFrame(
        [(1, "a", "M", 1, Decimal("1.00"), None), (2, "b", "C", 1, Decimal("2.00"), 1)],
        "employee_id bigint, name string, role string, store_id int, salary decimal(10,2), manager_id bigint")
    t0, t1 = dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
    slices = [spark.createDataFrame([(2, t0), (9, t0)], "employee_id bigint, requested_at timestamp_ntz"),
              spark.createDataFrame([(2, t1), (1, t1)], "employee_id bigint, requested_at timestamp_ntz")]
    base = scratch_path(spark, "r2-test")
    run_slices(spark, slices, f"{base}/in",
               lambda s: r2.audit_stream(s, emp).writeStream.foreachBatch(r2.audit_sink(f"{base}/audit")),
               f"{base}/ck")
    got = rows(spark.read.parquet(f"{base}/audit"), "audit_id", "employee_id", "deleted_at")
    assert got == [(1, 2, t0), (2, 1, t1)]


def test_audit_state_stays_flat_and_late_repeats_are_found_in_the_table(spark):
    emp = spark.range(1, 61).selectExpr("id AS employee_id", "'n' AS name", "'r' AS role", "1 AS store_id",
                                        "CAST(1 AS DECIMAL(10,2)) AS salary", "CAST(NULL AS BIGINT) AS manager_id")
    day = lambda n: dt.datetime(2001, 1, 1) + dt.timedelta(days=n)
    schema = "employee_id bigint, requested_at timestamp_ntz"
    # Twelve new ids a micro-batch; each repeats those of two batches ago, asked for long before.
    slices = [spark.createDataFrame([(12 * n + i, day(n)) for i in range(1, 13)]
                                    + [(12 * (n - 2) + i, day(-n)) for i in range(1, 13) if n > 1], schema)
              for n in range(5)]
    base = scratch_path(spark, "r2-flat")
    sizes = []

    def start(stream):
        if path_exists(spark, f"{base}/ck/state"):
            sizes.append(spark.read.format("statestore").load(f"{base}/ck").count())
        return (r2.audit_stream(stream, emp, "0 seconds").writeStream
                .foreachBatch(r2.audit_sink(f"{base}/audit")))

    run_slices(spark, slices, f"{base}/in", start, f"{base}/ck")
    sizes.append(spark.read.format("statestore").load(f"{base}/ck").count())
    assert len(sizes) == 5
    assert max(sizes) <= 24
    back = rows(spark.read.parquet(f"{base}/audit"), "audit_id", "employee_id", "deleted_at")
    assert back == [(k, k, day((k - 1) // 12)) for k in range(1, 61)]


def test_live_revenue_equals_batch(spark):
    orders = spark.createDataFrame([(1, 1, Decimal("2.00")), (2, 1, Decimal("3.00")), (3, None, Decimal("4.00")),
                                    (4, 2, Decimal("1.00"))], "order_id bigint, store_id int, total_amount decimal(12,2)")
    stores = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "store_id int, name string")
    base = scratch_path(spark, "r3-test")
    run_slices(spark, [orders.where("order_id <= 2"), orders.where("order_id > 2")], f"{base}/in",
               lambda s: r3.store_revenue_stream(s).writeStream.foreachBatch(r3.changes_sink(f"{base}/snap"))
               .outputMode("update"), f"{base}/ck")
    out = r3.with_dimension(r3.live_totals(spark.read.parquet(f"{base}/snap"), "store_id"), stores)
    assert rows(out) == [(1, "a", Decimal("5.00")), (2, "b", Decimal("1.00")), (3, "c", Decimal("0.00"))]


def test_stream_topups_raise_remaining_stock(spark):
    schema = "order_id bigint, line_no int, product_id bigint, arrival date, quantity int, kind string"
    d = dt.date(2000, 1, 1)
    first = spark.createDataFrame([(1, 1, 1, d, 8, "line"), (2, 1, 1, d + dt.timedelta(1), 5, "line"),
                                   (3, 1, 7, d, 1, "line")], schema)
    second = spark.createDataFrame([(4, 1, 1, d + dt.timedelta(2), 6, "topup"), (5, 1, 1, d + dt.timedelta(3), 5, "line"),
                                    (6, 1, 1, d + dt.timedelta(4), None, "line"), (7, 1, 1, d + dt.timedelta(5), 0, "line")],
                                   schema)
    products = spark.createDataFrame([(1, 10)], "product_id bigint, stock int")
    base = scratch_path(spark, "r1-topup")
    run_slices(spark, [first, second], f"{base}/in",
               lambda s: s.writeStream.foreachBatch(
                   r1.admission_sink(products, f"{base}/stock", f"{base}/out")), f"{base}/ck")
    got = {r.order_id: (r.accepted, r.reason) for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {1: (True, None), 2: (False, "not enough stock"), 3: (False, "unknown product"),
                   5: (True, None), 6: (False, "quantity is null"), 7: (False, "quantity must be positive")}
    last = spark.read.parquet(f"{base}/stock").where("_batch = 1").collect()
    assert [(r.product_id, r.stock) for r in last] == [(1, 10 - 8 + 6 - 5)]


def test_foreach_batch_admission_with_hot_product(spark):
    from test_keys_admission import _items
    _, _, items, products = _items(spark, n=1500, seed=11)
    valid = items.where("quantity IS NOT NULL")
    slices = [valid.where(F.col("arrival") < d) if i == 0 else
              valid.where((F.col("arrival") >= prev) & (F.col("arrival") < d))
              for i, (prev, d) in enumerate([(None, dt.date(2000, 6, 1)), (dt.date(2000, 6, 1), dt.date(2000, 12, 1)),
                                             (dt.date(2000, 12, 1), dt.date(2002, 1, 1))])]
    base = scratch_path(spark, "r1b-test")
    run_slices(spark, slices, f"{base}/in",
               lambda s: s.writeStream.foreachBatch(
                   r1.admission_sink(products, f"{base}/stock", f"{base}/out")),
               f"{base}/ck")
    got = {(r.order_id, r.line_no): r.accepted for r in spark.read.parquet(f"{base}/out").collect()}
    batch = admission.admit(valid, products, mode="greedy")
    want = {(r.order_id, r.line_no): True for r in batch.accepted.collect()}
    want.update({(r.order_id, r.line_no): False for r in batch.refused.collect()})
    assert got == want
