import datetime as dt
from decimal import Decimal

from conftest import rows
from mercantile.operators import quality


def test_validate_rules(spark):
    products = spark.createDataFrame(
        [(1, "ok", "A", Decimal("1.00"), 5, 1), (2, "neg", "A", Decimal("-1.00"), 5, 1),
         (3, "nullprice", "A", None, 5, None), (4, None, "A", Decimal("1.00"), 1, 1),
         (5, "orphan", "A", Decimal("1.00"), 1, 77), (5, "dup", "A", Decimal("1.00"), 1, 1),
         (6, "x" * 300, "A", Decimal("1.00"), 1, 1)],
        "product_id bigint, name string, category string, price decimal(10,2), stock int, supplier_id bigint")
    suppliers = spark.createDataFrame([(1,)], "supplier_id bigint")
    good, bad = quality.validate(products, "products", {"suppliers": suppliers})
    assert rows(good, "product_id") == [(1,), (3,)]          # NULL CHECK and NULL FK pass
    reasons = {r.name: r.reason for r in bad.collect()}
    assert "check:price_non_negative" in reasons["neg"]
    assert "foreign_key(supplier_id)" in reasons["orphan"] and "duplicate(product_id)" in reasons["orphan"]
    assert "max_length(name)" in reasons["x" * 300]
    v = quality.violations(products, "products", {"suppliers": suppliers})
    kinds = sorted({r.rule for r in v.collect()})
    assert kinds == ["check:price_non_negative", "foreign_key:suppliers", "max_length",
                     "not_null", "primary_key_unique"]


def test_unique_nulls_do_not_collide_and_defaults(spark):
    c = spark.createDataFrame([(1, "a", None, "1", "x"), (2, "b", None, "2", "x"), (3, "c", "e", "2", "x")],
                              "customer_id bigint, name string, email string, phone string, city string")
    v = quality.violations(c, "customers")
    assert sorted((r.rule, r.column_name, r.key) for r in v.collect() if r.rule == "unique") == [
        ("unique", "phone", "2")]
    o = spark.createDataFrame([(1, 2, Decimal("1.00"))], "order_id bigint, customer_id bigint, total_amount decimal(10,2)")
    d = quality.apply_defaults(o, "orders", dt.date(2001, 8, 1))
    assert d.columns[:4] == ["order_id", "customer_id", "order_date", "total_amount"]
    assert d.first().order_date == dt.date(2001, 8, 1)
