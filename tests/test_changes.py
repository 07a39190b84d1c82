import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from mercantile.operators import changes


def _shop(spark):
    t = {
        "stores": spark.createDataFrame([(1, "S1", "L", None), (2, "S2", "L", None)],
                                        "store_id int, name string, location string, manager_id int"),
        "customers": spark.createDataFrame(
            [(1, "a", "a@x", "1", "c"), (2, "b", "b@x", "2", "c"), (3, "c", "c@x", "3", "c")],
            "customer_id bigint, name string, email string, phone string, city string"),
        "orders": spark.createDataFrame(
            [(10, 1, 1), (11, 1, 2), (12, 2, 1), (13, None, 2)],
            "order_id bigint, customer_id bigint, store_id int").withColumn("order_status", F.lit("F")),
        "order_items": spark.createDataFrame(
            [(10, 100, 1), (10, 101, 2), (11, 100, 1), (12, 100, 5), (None, 100, 1)],
            "order_id bigint, product_id bigint, quantity int"),
        "payments": spark.createDataFrame([(1, 10), (2, 12), (3, 13)], "payment_id bigint, order_id bigint"),
        "monthly_sales": spark.createDataFrame([(2, "Jan", Decimal("1.00"))],
                                               "store_id int, month string, total_sales decimal(22,2)"),
    }
    return t


def test_cascade_leaves_no_orphans(spark):
    t = _shop(spark)
    res = changes.delete_rows(t, "customers", spark.createDataFrame([(1,), (None,)], "k bigint"))
    out = res.tables
    assert rows(out["customers"], "customer_id") == [(2,), (3,)]
    assert rows(out["orders"], "order_id") == [(12,), (13,)]          # NULL customer stays
    assert rows(out["order_items"], "order_id") == [(None,), (12,)]   # NULL order stays
    assert rows(out["payments"], "payment_id") == [(2,), (3,)]
    counts = {r.table_name: (r.rows_before, r.rows_after, r.rows_deleted) for r in res.counts.collect()}
    assert counts["order_items"] == (5, 2, 3)
    for child, parent, col in [("orders", "customers", "customer_id"), ("order_items", "orders", "order_id"),
                               ("payments", "orders", "order_id")]:
        orphans = (out[child].where(F.col(col).isNotNull())
                   .join(out[parent], col, "left_anti"))
        assert orphans.isEmpty(), child


def test_set_null_and_no_action(spark):
    t = _shop(spark)
    ok = changes.delete_rows(t, "stores", spark.createDataFrame([(1,)], "store_id int"))
    assert ok.violations.isEmpty()
    assert rows(ok.tables["orders"], "order_id", "store_id") == [(10, None), (11, 2), (12, None), (13, 2)]
    nulled = {r.table_name: r.rows_nulled for r in ok.counts.collect()}
    assert nulled["orders"] == 2
    blocked = changes.delete_rows(t, "stores", spark.createDataFrame([(2,)], "store_id int"))
    v = blocked.violations.collect()
    assert [(r.table_name, r.key, r.rows) for r in v] == [("monthly_sales", "2", 1)]
    assert rows(blocked.tables["stores"], "store_id") == [(1,), (2,)]  # refused: unchanged


def test_uplift_rounds_half_up_and_compounds(spark):
    p = spark.createDataFrame(
        [(1, "E", Decimal("2499.00")), (2, "E", Decimal("1499.00")), (3, "E", Decimal("299.00")),
         (4, "E", Decimal("0.05")), (5, "G", Decimal("80.00")), (6, "E", None)],
        "product_id bigint, category string, price decimal(10,2)")
    once = changes.uplift(p, F.col("category") == "E", "price", "1.10")
    got = dict(rows(once, "product_id", "price"))
    assert got == {1: Decimal("2748.90"), 2: Decimal("1648.90"), 3: Decimal("328.90"),
                   4: Decimal("0.06"), 5: Decimal("80.00"), 6: None}
    twice = changes.uplift(once, F.col("category") == "E", "price", "1.10")
    assert dict(rows(twice, "product_id", "price"))[3] == Decimal("361.79")


def test_add_deltas_atomic_and_per_key(spark):
    p = spark.createDataFrame([(1, 10), (2, 5), (3, 0)], "product_id bigint, stock int")
    d = spark.createDataFrame([(1, 5), (1, 5), (2, -6), (9, 3)], "product_id bigint, quantity int")
    per_key = changes.add_deltas(p, d, atomic=False)
    assert rows(per_key.table) == [(1, 20), (2, 5), (3, 0)]
    assert rows(per_key.refused, "product_id") == [(2,)]
    atomic = changes.add_deltas(p, d, atomic=True)
    assert rows(atomic.table) == [(1, 10), (2, 5), (3, 0)]
    fine = changes.add_deltas(p, d.where("quantity > 0"), atomic=True)
    assert rows(fine.table) == [(1, 20), (2, 5), (3, 0)]


def test_backfill_add_column_truncate(spark):
    e = spark.createDataFrame([(1, None), (2, dt.date(2020, 1, 1))], "employee_id bigint, hire_date date")
    patch = spark.createDataFrame([(1, dt.date(2016, 1, 15)), (2, dt.date(1999, 1, 1)), (7, dt.date(2000, 1, 1))],
                                  "employee_id bigint, hire_date date")
    assert rows(changes.backfill(e, patch, "employee_id", "hire_date")) == [
        (1, dt.date(2016, 1, 15)), (2, dt.date(2020, 1, 1))]
    assert changes.add_column(e, "hire_date", "date").columns == e.columns
    assert changes.add_column(e, "x", "int").columns == ["employee_id", "hire_date", "x"]
    empty = changes.truncate(e)
    assert empty.schema == e.schema and empty.isEmpty()


def test_update_by_key(spark):
    c = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "customer_id bigint, name string, city string")
    patch = spark.createDataFrame([(1, "A", None), (3, "C", "z"), (2, "B1", "q"), (2, "B2", "q")],
                                  "customer_id bigint, name string, city string")
    res = changes.update_by_key(c, patch, "customer_id")
    assert rows(res.table) == [(1, "A", None), (2, "b", "y")]
    assert rows(res.rejected, "customer_id") == [(2,), (2,)]


def test_add_customers_keys_and_uniques(spark):
    c = spark.createDataFrame([(5, "a", "a@x", "1", "c"), (9, "b", "b@x", "2", "c")],
                              "customer_id bigint, name string, email string, phone string, city string")
    batch = spark.createDataFrame(
        [("n1", "n1@x", "10", "c", 3), ("n2", "a@x", "11", "c", 1), ("n3", "n3@x", "12", None, 2),
         ("n4", "n4@x", "13", "c", 0), ("n5", "n4@x", "14", "c", 4)],
        "name string, email string, phone string, city string, seq int")
    res = changes.add_customers(c, batch, ["seq"])
    assert rows(res.added, "customer_id", "name") == [(10, "n4"), (11, "n1")]
    assert sorted(r.name for r in res.rejected.collect()) == ["n2", "n3", "n5"]
    assert res.table.count() == 4


def test_delete_customers_and_employees(spark):
    t = _shop(spark)
    ids = spark.createDataFrame([(1,), (3,)], "customer_id bigint")
    res = changes.delete_customers(t, ids)
    assert rows(res.blocked, "customer_id") == [(1,)]
    assert rows(res.tables["customers"], "customer_id") == [(1,), (2,)]
    t["orders"] = t["orders"].withColumn("order_status", F.when(F.col("order_id") == 11, "O").otherwise("F"))
    res_b = changes.delete_customers(t, spark.createDataFrame([(1,), (2,)], "customer_id bigint"),
                                     blocking=F.col("order_status") != "F")
    assert rows(res_b.blocked, "customer_id") == [(1,)]
    assert rows(res_b.tables["orders"], "order_id") == [(10,), (11,), (13,)]

    emp = spark.createDataFrame(
        [(1, "boss", "M", 1, Decimal("10.00"), None, None), (2, "mid", "M", 1, Decimal("5.00"), 1, None),
         (3, "low", "C", 2, Decimal("1.00"), 2, None)],
        "employee_id bigint, name string, role string, store_id int, salary decimal(10,2), "
        "manager_id bigint, hire_date date")
    from mercantile.schemas import SCHEMAS
    audit0 = spark.createDataFrame([(7, 99, "old", "C", 1, Decimal("1.00"), None, dt.datetime(2000, 1, 1))],
                                   SCHEMAS["employee_audit"])
    tt = {"employees": emp, "stores": t["stores"], "employee_audit": audit0}
    res_e = changes.delete_employees(tt, spark.createDataFrame([(2,), (1,)], "employee_id bigint"),
                                     dt.datetime(2001, 8, 1, 12))
    aud = rows(res_e.audit, "audit_id", "employee_id", "manager_id")
    assert aud == [(8, 1, None), (9, 2, 1)]                      # original manager_id kept
    assert rows(res_e.tables["employees"], "employee_id", "manager_id") == [(3, None)]
    assert res_e.tables["employee_audit"].count() == 3


def test_change_report(spark):
    b = spark.createDataFrame([(1, Decimal("1.00")), (2, None), (3, Decimal("3.00"))], "k int, price decimal(10,2)")
    a = spark.createDataFrame([(1, Decimal("1.10")), (2, None), (3, Decimal("3.00"))], "k int, price decimal(10,2)")
    assert rows(changes.change_report(b, a, "k", ["price"])) == [(1, Decimal("1.00"), Decimal("1.10"))]


def test_update_by_key_rejects_rule_breaks(spark):
    c = spark.createDataFrame([(1, "a", "a@x", "1", "x")], "customer_id bigint, name string, email string, "
                                                             "phone string, city string")
    patch = spark.createDataFrame([(1, None)], "customer_id bigint, name string")
    res = changes.update_by_key(c, patch, "customer_id", table="customers")
    assert rows(res.table) == rows(c) and res.rejected.count() == 1


def test_update_refuses_taken_unique_values(spark):
    c = spark.createDataFrame([(1, "a", "a@x", "1", "p"), (2, "b", "b@x", "2", "p"), (3, "c", "c@x", "3", "p"),
                               (4, "d", "d@x", "4", "p")],
                              "customer_id bigint, name string, email string, phone string, city string")
    patch = spark.createDataFrame([(2, "a@x"), (3, "same@x"), (4, "same@x"), (1, "new@x")],
                                  "customer_id bigint, email string")
    res = changes.update_by_key(c, patch, "customer_id", table="customers")
    assert rows(res.table, "customer_id", "email") == [(1, "new@x"), (2, "b@x"), (3, "c@x"), (4, "d@x")]
    assert rows(res.rejected, "customer_id") == [(2,), (3,), (4,)]


def _one_by_one(customers, batch):
    """The procedure called once per row."""
    emails, phones = {c[2] for c in customers}, {c[3] for c in customers}
    key, added, refused = max(c[0] for c in customers), [], []
    for name, email, phone, city, seq in sorted(batch, key=lambda r: r[4]):
        bad = None in (name, email, phone, city) or email in emails or phone in phones
        if bad or len(phone) > 20:
            refused.append(seq)
            continue
        key += 1
        emails.add(email)
        phones.add(phone)
        added.append((key, name, email, phone, city))
    return added, sorted(refused)


def test_bulk_sign_up_is_one_call_per_row(spark):
    import random
    rng = random.Random(3)
    customers = [(i, f"n{i}", f"e{i}", f"p{i}", "c") for i in range(1, 6)]
    c = spark.createDataFrame(customers, "customer_id int, name string, email string, phone string, city string")
    for trial in range(3):
        batch = [(rng.choice(["x", "x", None]), rng.choice([f"e{rng.randrange(14)}"] * 9 + [None]),
                  rng.choice([f"p{rng.randrange(14)}"] * 6 + [None, "9" * 21]), rng.choice(["c"] * 9 + [None]), seq)
                 for seq in rng.sample(range(100), 40)]
        if trial == 0:  # a chain: every other row of it gets in
            batch = [("x", f"m{i // 2}", f"q{(i + 1) // 2}", "c", i) for i in range(9)] + [(None, "m0", "z", "c", -1)]
        b = spark.createDataFrame(batch, "name string, email string, phone string, city string, seq int")
        res = changes.add_customers(c, b, ["seq"])
        added, refused = _one_by_one(customers, batch)
        assert sorted(tuple(r) for r in res.added.collect()) == added
        assert sorted(r.seq for r in res.rejected.collect()) == refused
        assert res.table.count() == len(customers) + len(added)


def test_update_of_unknown_ids_changes_nothing(spark):
    c = spark.createDataFrame([(1, "a", "a@x", "1", "c"), (2, "b", "b@x", "2", "c")],
                              "customer_id int, name string, email string, phone string, city string")
    patch = spark.createDataFrame([(1, "new@x"), (99, "new@x"), (99, "other@x")], "customer_id int, email string")
    res = changes.update_by_key(c, patch, "customer_id", table="customers")
    assert sorted((r.customer_id, r.email) for r in res.table.collect()) == [(1, "new@x"), (2, "b@x")]
    assert [r.customer_id for r in res.applied.collect()] == [1] and res.rejected.count() == 0
