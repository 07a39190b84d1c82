import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from mercantile import fixtures
from mercantile.operators import admission, procedures


def test_procedures_single_calls(spark):
    t = fixtures.load_tables(spark, SF_SMALL, ["customers", "orders", "order_items", "payments",
                                                "products", "stores"])
    added = procedures.add_customer(t["customers"], "Neu", "neu@example.com", "7000000001", "NATION_1")
    new_id = added.added.first().customer_id
    assert new_id == t["customers"].agg(F.max("customer_id")).first()[0] + 1
    dup = procedures.add_customer(added.table, "Neu2", "neu@example.com", "7000000002", "NATION_1")
    assert dup.added.isEmpty() and dup.rejected.count() == 1
    upd = procedures.update_customer(added.table, new_id, "Neu", "neu@example.com", "7000000001", "NATION_2")
    assert upd.table.where(F.col("customer_id") == new_id).first().city == "NATION_2"
    t2 = dict(t, customers=upd.table)
    assert procedures.delete_customer(t2, new_id).blocked.isEmpty()           # no orders: deleted
    has_orders = t["orders"].first().customer_id
    refused = procedures.delete_customer(t, has_orders)
    assert refused.blocked.first().reason.startswith("Customer cannot be deleted")
    assert procedures.get_customer_orders(t["orders"], has_orders).count() >= 1
    pid = t["products"].first().product_id
    stock0 = t["products"].where(F.col("product_id") == pid).first().stock
    up = procedures.add_product_stock(t["products"], pid, 30).table
    assert up.where(F.col("product_id") == pid).first().stock == stock0 + 30
    down = procedures.add_product_stock(t["products"], pid, -(stock0 + 1))
    assert down.table.where(F.col("product_id") == pid).first().stock == stock0
    rep = procedures.generate_sales_report(t["stores"], t["orders"], t["order_items"], 1998, 7)
    assert rep.columns == ["store_name", "monthly_revenue"]


line = st.tuples(st.integers(1, 4), st.integers(0, 60), st.one_of(st.none(), st.integers(-2, 30)))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines=st.lists(line, min_size=1, max_size=40),
       stock=st.lists(st.integers(0, 60), min_size=4, max_size=4))
def test_greedy_properties(spark, lines, stock):
    data = [(i, 1, p, dt.date(2000, 1, 1) + dt.timedelta(days=d), q) for i, (p, d, q) in enumerate(lines)]
    items = spark.createDataFrame(data, "order_id bigint, line_no int, product_id bigint, arrival date, quantity int")
    items = items.withColumn("price", F.lit(1).cast("decimal(12,2)"))
    products = spark.createDataFrame([(i + 1, s) for i, s in enumerate(stock)], "product_id bigint, stock int")
    res = admission.admit(items, products)
    left = dict(enumerate(stock, start=1))
    want = {}
    for oid, _, p, day, q in sorted(data, key=lambda x: (x[3], x[0])):
        ok = q is not None and 0 < q <= left[p]
        if ok:
            left[p] -= q
        want[oid] = ok
    got = {r.order_id: True for r in res.accepted.collect()}
    got.update({r.order_id: False for r in res.refused.collect()})
    assert got == want
    new_stock = dict(rows(res.products))
    assert new_stock == left and min(new_stock.values()) >= 0
    if admission.admit(items, products, mode="atomic").refused.isEmpty():
        assert all(want.values())


keys = st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=keys, right=keys)
def test_not_in_matches_sql(spark, left, right):
    from mercantile.operators.joins import not_in
    l_df = spark.createDataFrame([(k,) for k in left], "k int")
    r_df = spark.createDataFrame([(k,) for k in right], "k int")
    l_df.createOrReplaceTempView("prop_l")
    r_df.createOrReplaceTempView("prop_r")
    ref = spark.sql("SELECT k FROM prop_l WHERE k NOT IN (SELECT k FROM prop_r)")
    assert rows(not_in(l_df, "k", r_df)) == rows(ref)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(orders=st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 5))), max_size=12),
       items=st.lists(st.one_of(st.none(), st.integers(0, 12)), max_size=15),
       gone=st.lists(st.integers(0, 5), max_size=4))
def test_cascade_leaves_no_orphans_property(spark, orders, items, gone):
    from mercantile.operators.changes import delete_rows
    customers = spark.createDataFrame([(i, f"c{i}") for i in range(6)], "customer_id bigint, name string")
    o = spark.createDataFrame([(i, c) for i, (_, c) in enumerate(orders)], "order_id bigint, customer_id bigint")
    it = spark.createDataFrame([(j, k) for j, k in enumerate(items)], "line bigint, order_id bigint")
    res = delete_rows({"customers": customers, "orders": o, "order_items": it}, "customers",
                      spark.createDataFrame([(g,) for g in gone], "customer_id bigint"))
    out = res.tables
    gone_set = set(gone)
    kept_orders = {i for i, (_, c) in enumerate(orders) if c is None or c not in gone_set}
    assert {r.order_id for r in out["orders"].collect()} == kept_orders
    assert sorted((r.line for r in out["order_items"].collect())) == sorted(
        j for j, k in enumerate(items) if k is None or k >= len(orders) or k in kept_orders)
