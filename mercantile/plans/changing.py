"""Named queries for data changes (M1-M17), change reports (Q18, Q19) and
the quality report (V1-V6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.scalar import years_before
from ..operators import changes, quality, reports
from ..schemas import RULES, foreign_keys_of
from . import twins
from .catalog import AS_OF, doubles, iso_dates, register, tables
from .oracle import with_fixtures

UPLIFT_CATEGORY = "PROMO"
CLOSED_STORE = 24        # a store without monthly sales: the delete goes through
BLOCKED_STORE = 3        # a store with monthly sales: NO ACTION refuses the delete
AUDIT_STORE = 5
DELETED_AT = dt.datetime(2001, 8, 1, 12, 0, 0)
NO_DATE_ROLE = "AUTOMOBILE"


def _uplifted(t):
    return changes.uplift(t["products"], F.col("category") == UPLIFT_CATEGORY, "price", "1.10")


@register("M1", with_fixtures(f"""
SELECT product_id, category,
       CAST(CASE WHEN category = '{UPLIFT_CATEGORY}' THEN CAST(price * 1.10 AS DECIMAL(10,2))
                 ELSE price END AS DOUBLE) AS price
FROM products""", "products"))
def m1(spark, sf):
    t = tables(spark, sf, "products")
    return doubles(_uplifted(t).select("product_id", "category", "price"), "price")


@register("Q18", with_fixtures(f"""
SELECT product_id, CAST(price AS DOUBLE) AS old_price,
       CAST(CAST(price * 1.10 AS DECIMAL(10,2)) AS DOUBLE) AS new_price
FROM products
WHERE category = '{UPLIFT_CATEGORY}' AND CAST(price * 1.10 AS DECIMAL(10,2)) <> price""", "products"))
def q18(spark, sf):
    t = tables(spark, sf, "products")
    rep = changes.change_report(t["products"], _uplifted(t), "product_id", ["price"])
    return doubles(rep, "old_price", "new_price")


@register("M2", with_fixtures("""
SELECT e.employee_id, strftime(MIN(o.order_date), '%Y-%m-%d') AS hire_date
FROM employees e LEFT JOIN shop_orders o ON o.customer_id = e.employee_id
GROUP BY e.employee_id""", "employees", "shop_orders"))
def m2(spark, sf):
    """M11 + M2: drop hire_date, add it back empty, backfill it with the
    person's first order date (a patch derived from the orders)."""
    t = tables(spark, sf, "employees", "orders")
    e = changes.add_column(t["employees"].drop("hire_date"), "hire_date", "date")
    patch = t["orders"].groupBy(F.col("customer_id").alias("employee_id")).agg(
        F.min("order_date").alias("hire_date"))
    out = changes.backfill(e, patch, "employee_id", "hire_date")
    return iso_dates(out.select("employee_id", "hire_date"), "hire_date")


@register("M2_partial", with_fixtures(f"""
SELECT employee_id, strftime(CASE WHEN role <> '{NO_DATE_ROLE}' THEN hire_date ELSE first_day END, '%Y-%m-%d') AS hire_date
FROM employees LEFT JOIN (SELECT customer_id, MIN(order_date) AS first_day FROM shop_orders GROUP BY 1)
  ON customer_id = employee_id""", "employees", "shop_orders"))
def m2_partial(spark, sf):
    """Backfill where only some hire dates are missing: the others stay."""
    t = tables(spark, sf, "employees", "order_heads")
    holes = t["employees"].withColumn("hire_date", F.when(F.col("role") != NO_DATE_ROLE, F.col("hire_date")))
    patch = t["order_heads"].groupBy(F.col("customer_id").alias("employee_id")).agg(
        F.min("order_date").alias("hire_date"))
    out = changes.backfill(holes, patch, "employee_id", "hire_date")
    return iso_dates(out.select("employee_id", "hire_date"), "hire_date")


@register("M3", with_fixtures(f"""
SELECT employee_id,
       CAST(CASE WHEN hire_date < DATE '{AS_OF}' - INTERVAL 5 YEAR
                 THEN CAST(salary * 1.05 AS DECIMAL(10,2)) ELSE salary END AS DOUBLE) AS salary
FROM employees""", "employees"))
def m3(spark, sf):
    t = tables(spark, sf, "employees")
    out = changes.uplift(t["employees"], F.col("hire_date") < years_before(AS_OF, 5), "salary", "1.05")
    return doubles(out.select("employee_id", "salary"), "salary")


@register("Q18_salaries", with_fixtures(f"""
SELECT employee_id, CAST(salary AS DOUBLE) AS old_salary,
       CAST(round(salary * 1.05, 2) AS DOUBLE) AS new_salary
FROM employees WHERE hire_date < {twins.years_back(5)} AND round(salary * 1.05, 2) <> salary""", "employees"))
def q18_salaries(spark, sf):
    e = tables(spark, sf, "employees")["employees"]
    raised = changes.uplift(e, F.col("hire_date") < years_before(AS_OF, 5), "salary", "1.05")
    return doubles(changes.change_report(e, raised, "employee_id", ["salary"]), "old_salary", "new_salary")


@register("Q18_stock", with_fixtures("""
SELECT product_id, stock AS old_stock, CAST(stock + q AS INTEGER) AS new_stock
FROM products JOIN (SELECT product_id, SUM(quantity) AS q FROM shipments GROUP BY product_id) USING (product_id)
WHERE q <> 0""", "products", "shipments"))
def q18_stock(spark, sf):
    t = tables(spark, sf, "products", "shipments")
    after = changes.add_deltas(t["products"], t["shipments"]).table
    return changes.change_report(t["products"], after, "product_id", ["stock"])


@register("M4", with_fixtures("""
SELECT p.product_id, CAST(p.stock + COALESCE(s.q, 0) AS INTEGER) AS stock
FROM products p
LEFT JOIN (SELECT product_id, SUM(quantity) AS q FROM shipments GROUP BY product_id) s
  ON p.product_id = s.product_id""", "products", "shipments"))
def m4(spark, sf):
    t = tables(spark, sf, "products", "shipments")
    return changes.add_deltas(t["products"], t["shipments"]).table.select("product_id", "stock")


@register("M15", with_fixtures(f"""
SELECT p.product_id,
       CAST(CASE WHEN p.stock + COALESCE(d.q, 0) < 0 THEN p.stock
                 ELSE p.stock + COALESCE(d.q, 0) END AS INTEGER) AS stock
FROM products p
LEFT JOIN (SELECT product_id, -SUM(quantity) AS q FROM order_items
           GROUP BY product_id) d
  ON p.product_id = d.product_id""", "products", "order_items"))
def m15(spark, sf):
    """Per-product stock moves (sp_AddProductStock per product): take all
    shipped quantities out of stock; a product that would go below zero keeps
    its stock (CHECK stock >= 0)."""
    t = tables(spark, sf, "products", "order_items")
    sold = t["order_items"].select("product_id", (-F.col("quantity")).alias("quantity"))
    return changes.add_deltas(t["products"], sold, atomic=False).table.select("product_id", "stock")


def _counts_sql(rows: list[tuple[str, str, str]], extra: str, *names: str) -> str:
    """rows: (table name, FROM relation, surviving-rows WHERE)."""
    parts = [f"""SELECT '{n}' AS table_name, (SELECT COUNT(*) FROM {rel}) AS rows_before,
       (SELECT COUNT(*) FROM {rel} WHERE {cond}) AS rows_after""" for n, rel, cond in rows]
    body = ("SELECT table_name, rows_before, rows_after, rows_before - rows_after AS rows_deleted, "
            "CAST(0 AS BIGINT) AS rows_nulled FROM (\n" + "\nUNION ALL\n".join(parts) + ")")
    return with_fixtures(body, *names, extra=extra)


CASCADE_ROWS = [
    ("customers", "customers", "customer_id NOT IN (SELECT customer_id FROM gone)"),
    ("orders", "shop_orders", "customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM gone)"),
    ("order_items", "order_items", "order_id IS NULL OR order_id NOT IN (SELECT order_id FROM gone_orders)"),
    ("payments", "payments", "order_id IS NULL OR order_id NOT IN (SELECT order_id FROM gone_orders)"),
]


@register("M5", _counts_sql(CASCADE_ROWS, twins.INACTIVE_CTE, "customers", "shop_orders", "order_items", "payments"))
def m5(spark, sf):
    """Delete inactive customers; CASCADE takes their orders, the orders'
    lines and payments.  Result: before / after counts per table."""
    t = tables(spark, sf, "customers", "orders", "order_items", "payments")
    gone = reports.inactive_customers(t["customers"], t["orders"], AS_OF).select("customer_id")
    return changes.delete_rows(t, "customers", gone).counts


@register("Q19", _counts_sql(
    [("customers", "customers", "customer_id NOT IN (SELECT customer_id FROM gone)")],
    twins.INACTIVE_CTE, "customers", "shop_orders"))
def q19(spark, sf):
    """Before / after count of customers around the deletion of the inactive ones."""
    t = tables(spark, sf, "customers", "orders")
    gone = reports.inactive_customers(t["customers"], t["orders"], AS_OF).select("customer_id")
    after = t["customers"].join(gone, "customer_id", "left_anti")
    return changes.change_counts({"customers": t["customers"]}, {"customers": after})


FIRST_ORDER_CTE = "gone_orders AS (SELECT MIN(order_id) AS order_id FROM shop_orders)"


@register("M6", _counts_sql([
    ("orders", "shop_orders", "order_id NOT IN (SELECT order_id FROM gone_orders)"),
    ("order_items", "order_items", "order_id IS NULL OR order_id NOT IN (SELECT order_id FROM gone_orders)"),
    ("payments", "payments", "order_id IS NULL OR order_id NOT IN (SELECT order_id FROM gone_orders)"),
], FIRST_ORDER_CTE, "shop_orders", "order_items", "payments"))
def m6(spark, sf):
    """Delete one order by key (the first one); its lines and payments go by CASCADE."""
    t = tables(spark, sf, "orders", "order_items", "payments")
    key = t["orders"].select(F.min("order_id").alias("order_id"))
    return changes.delete_rows(t, "orders", key).counts


@register("M8", with_fixtures(f"""
SELECT table_name, rows_before, rows_after, rows_before - rows_after AS rows_deleted, rows_nulled FROM (
  SELECT 'stores' AS table_name, (SELECT COUNT(*) FROM stores) AS rows_before,
         (SELECT COUNT(*) FROM stores WHERE store_id <> {CLOSED_STORE}) AS rows_after,
         CAST(0 AS BIGINT) AS rows_nulled
  UNION ALL
  SELECT 'employees', (SELECT COUNT(*) FROM employees), (SELECT COUNT(*) FROM employees),
         (SELECT COUNT(*) FROM employees WHERE store_id = {CLOSED_STORE})
  UNION ALL
  SELECT 'orders', (SELECT COUNT(*) FROM shop_orders), (SELECT COUNT(*) FROM shop_orders),
         (SELECT COUNT(*) FROM shop_orders WHERE store_id = {CLOSED_STORE})
  UNION ALL
  SELECT 'monthly_sales', (SELECT COUNT(*) FROM monthly_sales), (SELECT COUNT(*) FROM monthly_sales),
         CAST(0 AS BIGINT))""", "stores", "employees", "shop_orders", "monthly_sales"))
def m8(spark, sf):
    """Close a store: employees and orders keep their rows, store_id becomes NULL."""
    t = tables(spark, sf, "stores", "employees", "orders", "monthly_sales")
    key = t["stores"].where(F.col("store_id") == CLOSED_STORE).select("store_id")
    return changes.delete_rows(t, "stores", key).counts


@register("M8_orders", with_fixtures(f"""
SELECT * FROM (VALUES
  ('stores', (SELECT COUNT(*) FROM stores), (SELECT COUNT(*) - 1 FROM stores), 1::BIGINT, 0::BIGINT),
  ('employees', (SELECT COUNT(*) FROM employees), (SELECT COUNT(*) FROM employees), 0::BIGINT,
   (SELECT COUNT(*) FROM employees WHERE store_id = {AUDIT_STORE})),
  ('orders', (SELECT COUNT(*) FROM shop_orders), (SELECT COUNT(*) FROM shop_orders), 0::BIGINT,
   (SELECT COUNT(*) FROM shop_orders WHERE store_id = {AUDIT_STORE}))
) v(table_name, rows_before, rows_after, rows_deleted, rows_nulled)""", "stores", "employees", "shop_orders"))
def m8_orders(spark, sf):
    """A store with staff and orders closes before any sales summary exists:
    both keep their rows and lose the store."""
    t = tables(spark, sf, "stores", "employees", "orders")
    key = t["stores"].where(F.col("store_id") == AUDIT_STORE).select("store_id")
    return changes.delete_rows(t, "stores", key).counts


@register("M9", with_fixtures(f"""
SELECT 'monthly_sales' AS table_name, 'store_id' AS column_name, 'stores' AS parent,
       CAST(store_id AS VARCHAR) AS key, COUNT(*) AS rows
FROM monthly_sales WHERE store_id = {BLOCKED_STORE} GROUP BY store_id""",
                              "monthly_sales"))
def m9(spark, sf):
    """Deleting a store that monthly_sales still references is refused (NO ACTION)."""
    t = tables(spark, sf, "stores", "employees", "orders", "monthly_sales")
    key = t["stores"].where(F.col("store_id") == BLOCKED_STORE).select("store_id")
    return changes.delete_rows(t, "stores", key).violations


@register("M12", with_fixtures("""
SELECT (SELECT MAX(customer_id) FROM customers) + ROW_NUMBER() OVER (ORDER BY supplier_id) AS customer_id,
       name, lower(name) || '@supplier.example' AS email, phone, city
FROM suppliers""", "customers", "suppliers"))
def m12(spark, sf):
    """Every supplier contact signs up as a customer; existing customers that
    sign up again are rejected (email and phone already used)."""
    t = tables(spark, sf, "customers", "suppliers")
    batch = t["suppliers"].select(
        "name", F.concat(F.lower("name"), F.lit("@supplier.example")).alias("email"),
        "phone", "city", F.col("supplier_id").alias("seq"))
    again = t["customers"].where(F.col("city") == "NATION_3").select(
        "name", "email", "phone", "city", (F.lit(10**12) + F.col("customer_id")).alias("seq"))
    return changes.add_customers(t["customers"], batch.unionByName(again), ["seq"]).added


@register("M12_rejected", with_fixtures("""
SELECT COUNT(*) AS rejected FROM customers WHERE city = 'NATION_3'""", "customers"))
def m12_rejected(spark, sf):
    t = tables(spark, sf, "customers", "suppliers")
    again = t["customers"].where(F.col("city") == "NATION_3").select(
        "name", "email", "phone", "city", F.col("customer_id").alias("seq"))
    return changes.add_customers(t["customers"], again, ["seq"]).rejected.agg(
        F.count(F.lit(1)).alias("rejected"))


@register("M12_chains", with_fixtures("""
SELECT (SELECT MAX(customer_id) FROM customers) + ROW_NUMBER() OVER (ORDER BY supplier_id, k) AS customer_id,
       name || CASE k WHEN 1 THEN ' one' ELSE ' three' END AS name, phone || CASE k WHEN 1 THEN '-a' ELSE '-c' END AS phone
FROM suppliers CROSS JOIN (VALUES (1), (3)) AS kinds(k)""", "customers", "suppliers"))
def m12_chains(spark, sf):
    """Four sign-ups per supplier: the first lacks its name, so the second may
    have the email; the third wants the phone of the second and is refused, so
    the fourth may have the email of the third."""
    t = tables(spark, sf, "customers", "suppliers")
    mail = lambda k: F.concat(F.lower("name"), F.lit(f"@{k}.example"))
    row = lambda k, name, m, p: F.struct(
        F.lit(k).alias("k"), name.alias("name"), mail(m).alias("email"), F.concat("phone", F.lit(p)).alias("phone"))
    kinds = F.array(row(0, F.lit(None).cast("string"), "first", "-x"), row(1, F.concat("name", F.lit(" one")), "first", "-a"),
                    row(2, F.concat("name", F.lit(" two")), "second", "-a"), row(3, F.concat("name", F.lit(" three")), "second", "-c"))
    batch = t["suppliers"].select("supplier_id", "city", F.explode(kinds).alias("r")).select(
        "r.name", "r.email", "r.phone", "city", "supplier_id", "r.k")
    return changes.add_customers(t["customers"], batch, ["supplier_id", "k"]).added.select("customer_id", "name", "phone")


@register("M13_unknown", with_fixtures("""
SELECT customer_id, CASE WHEN city = 'NATION_1' THEN CAST(customer_id + 7000000000 AS VARCHAR) ELSE phone END AS phone
FROM customers""", "customers"))
def m13_unknown(spark, sf):
    """New numbers for NATION_1; the same numbers asked for unknown customers
    change nothing and hinder nobody."""
    c = tables(spark, sf, "customers")["customers"]
    patch = c.where(F.col("city") == "NATION_1").select(
        "customer_id", (F.lit(7000000000) + F.col("customer_id")).cast("string").alias("phone"))
    unknown = patch.select((F.col("customer_id") + F.lit(10**12)).alias("customer_id"), "phone")
    return (changes.update_by_key(c, patch.unionByName(unknown), "customer_id", table="customers").table
            .select("customer_id", "phone"))


@register("M13", with_fixtures("""
SELECT customer_id, name,
       CASE WHEN city = 'NATION_0' THEN upper(email) ELSE email END AS email, phone,
       CASE WHEN city = 'NATION_0' THEN 'NATION_1' ELSE city END AS city
FROM customers""", "customers"))
def m13(spark, sf):
    """Customers of NATION_0 move to NATION_1 and get an upper-case email."""
    t = tables(spark, sf, "customers")
    patch = (t["customers"].where(F.col("city") == "NATION_0")
             .select("customer_id", F.upper("email").alias("email"), F.lit("NATION_1").alias("city")))
    return changes.update_by_key(t["customers"], patch, "customer_id", table="customers").table


@register("M13_clash", with_fixtures("""
SELECT customer_id, CASE WHEN city = 'NATION_1' OR (city = 'NATION_0' AND customer_id = (SELECT MAX(customer_id) FROM customers))
                         THEN CAST(customer_id + CASE city WHEN 'NATION_1' THEN 7000000000 ELSE 8000000001 END AS VARCHAR)
                         ELSE phone END AS phone
FROM customers""", "customers"))
def m13_clash(spark, sf):
    """NATION_0 asks for the phone numbers of the next customers, which are
    taken (UNIQUE refuses them); NATION_1 gets free numbers."""
    c = tables(spark, sf, "customers")["customers"]
    number = F.when(F.col("city") == "NATION_0", F.lit(8000000001)).otherwise(F.lit(7000000000)) + F.col("customer_id")
    patch = (c.where(F.col("city").isin("NATION_0", "NATION_1"))
             .select("customer_id", number.cast("string").alias("phone")))
    return changes.update_by_key(c, patch, "customer_id", table="customers").table.select("customer_id", "phone")


@register("M14a_deleted", with_fixtures("""
SELECT * FROM (VALUES ('customers', (SELECT COUNT(*) FROM gap_customers),
   (SELECT COUNT(*) FROM gap_customers WHERE customer_id < 1000000000),
   (SELECT COUNT(*) FROM suppliers), 0::BIGINT),
  ('orders', (SELECT COUNT(*) FROM gap_orders), (SELECT COUNT(*) FROM gap_orders), 0::BIGINT, 0::BIGINT)
) v(table_name, rows_before, rows_after, rows_deleted, rows_nulled)""", "gap_customers", "gap_orders", "suppliers"))
def m14a_deleted(spark, sf):
    """Ask to delete the supplier contacts, who have no order, and everybody
    with a finished order: only the contacts go."""
    t = tables(spark, sf, "gap_customers", "gap_orders", "suppliers")
    ids = (t["suppliers"].select((F.lit(1_000_000_000) + F.col("supplier_id")).alias("customer_id"))
           .unionByName(t["gap_orders"].where(F.col("order_status") == "F").select("customer_id")))
    return changes.delete_customers({"customers": t["gap_customers"], "orders": t["gap_orders"]}, ids).counts


@register("M14a", with_fixtures(f"""
SELECT g.customer_id, '{changes.HAS_ORDERS}' AS reason FROM gone g
WHERE EXISTS (SELECT 1 FROM shop_orders o WHERE o.customer_id = g.customer_id)""",
                                "customers", "shop_orders", extra=twins.INACTIVE_CTE))
def m14a(spark, sf):
    """Ask to delete every inactive customer; customers with any order are refused."""
    t = tables(spark, sf, "customers", "orders", "order_items", "payments")
    ids = reports.inactive_customers(t["customers"], t["orders"], AS_OF).select("customer_id")
    return changes.delete_customers(t, ids).blocked


M14B_CTE = twins.INACTIVE_CTE.replace("gone_orders AS", "unused AS") + """,
ok AS (SELECT customer_id FROM gone
       EXCEPT SELECT customer_id FROM shop_orders WHERE order_status IN ('O', 'P')),
gone_orders AS (SELECT order_id FROM shop_orders WHERE customer_id IN (SELECT customer_id FROM ok))"""


@register("M14b", _counts_sql([
    ("customers", "customers", "customer_id NOT IN (SELECT customer_id FROM ok)"),
    ("orders", "shop_orders", "customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM ok)"),
    ("order_items", "order_items", "order_id IS NULL OR order_id NOT IN (SELECT order_id FROM gone_orders)"),
    ("payments", "payments", "order_id IS NULL OR order_id NOT IN (SELECT order_id FROM gone_orders)"),
], M14B_CTE, "customers", "shop_orders", "order_items", "payments"))
def m14b(spark, sf):
    """Older rule: only orders not yet finished (status other than 'F') block;
    finished orders of a deleted customer go by CASCADE."""
    t = tables(spark, sf, "customers", "orders", "order_items", "payments")
    ids = reports.inactive_customers(t["customers"], t["orders"], AS_OF).select("customer_id")
    return changes.delete_customers(t, ids, blocking=F.col("order_status") != "F").counts


@register("M17", with_fixtures(f"""
SELECT ROW_NUMBER() OVER (ORDER BY employee_id) AS audit_id, employee_id, name, role, store_id,
       CAST(salary AS DOUBLE) AS salary, manager_id, '{DELETED_AT:%Y-%m-%d %H:%M:%S}' AS deleted_at
FROM employees WHERE store_id = {AUDIT_STORE}""", "employees"))
def m17(spark, sf):
    t = tables(spark, sf, "employees", "stores", "employee_audit")
    ids = t["employees"].where(F.col("store_id") == AUDIT_STORE).select("employee_id")
    audit = changes.delete_employees(t, ids, DELETED_AT).audit
    return doubles(audit, "salary").withColumn(
        "deleted_at", F.date_format("deleted_at", "yyyy-MM-dd HH:mm:ss"))


@register("M17_counts", with_fixtures(f"""
SELECT 'employees' AS table_name, (SELECT COUNT(*) FROM employees) AS rows_before,
       (SELECT COUNT(*) FROM employees WHERE store_id IS NULL OR store_id <> {AUDIT_STORE}) AS rows_after,
       (SELECT COUNT(*) FROM employees WHERE store_id = {AUDIT_STORE}) AS rows_deleted,
       (SELECT COUNT(*) FROM employees e WHERE (e.store_id IS NULL OR e.store_id <> {AUDIT_STORE})
          AND e.manager_id IN (SELECT employee_id FROM employees WHERE store_id = {AUDIT_STORE})) AS rows_nulled
""", "employees"))
def m17_counts(spark, sf):
    """Subordinates of deleted employees keep their row with manager_id NULL."""
    t = tables(spark, sf, "employees", "employee_audit")
    ids = t["employees"].where(F.col("store_id") == AUDIT_STORE).select("employee_id")
    return changes.delete_employees(t, ids, DELETED_AT).counts.where(F.col("table_name") == "employees")


# ------------------------------------------------------------ quality report

QUALITY_TABLES = ("stores", "employees", "customers", "suppliers", "products", "orders",
                  "order_items", "payments", "shipments")
SQL_NAME = {"orders": "shop_orders", "order_items": "keyed_items"}


def _rule_sql(table: str, rule: str, col: str, broken: str = "") -> str:
    rel = broken + SQL_NAME.get(table, table)
    r = RULES[table]
    if rule in ("primary_key_not_null", "not_null"):
        cond = f"{col} IS NULL"
    elif rule.startswith("check:"):
        cond = f"NOT COALESCE({r.checks[rule[6:]]}, TRUE)"
    elif rule == "max_length":
        cond = f"length({col}) > {r.max_length[col]}"
    elif rule == "decimal_range":
        p, s = r.decimals[col]
        cond = f"{col} IS NOT NULL AND TRY_CAST({col} AS DECIMAL({p},{s})) IS NULL"
    elif rule in ("primary_key_unique", "unique"):
        return (f"(SELECT COUNT(*) FROM (SELECT {col} FROM {rel} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING COUNT(*) > 1))")
    elif rule.startswith("foreign_key:"):
        parent = rule.split(":", 1)[1]
        fk = next(f for f in foreign_keys_of(table) if f.column == col and f.parent == parent)
        prel = broken + SQL_NAME.get(parent, parent)
        cond = (f"{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {prel} p "
                f"WHERE p.{fk.parent_column} = {rel}.{col})")
    else:
        raise ValueError(rule)
    return f"(SELECT COUNT(*) FROM {rel} WHERE {cond})"


def _quality_sql(broken: str = "", extra: str = "") -> str:
    rows = []
    for t in QUALITY_TABLES:
        cols = fixtures_columns(t)
        for rule, col in quality.declared_rules(t, cols, set(QUALITY_TABLES)):
            rows.append(f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{col}' AS column_name, "
                        f"{_rule_sql(t, rule, col, broken)} AS violations")
    names = [SQL_NAME.get(t, t) for t in QUALITY_TABLES]
    return with_fixtures("\nUNION ALL\n".join(rows), *names, extra=extra)


# Rows that break rules, added to the whole tables: copies of existing rows
# with some columns spoiled.  {table: (rows that are copied, {column: value})}
LONG = "repeat('long text ', 30)"
SPOILED = {
    "stores": ("store_id = 3", {"location": "NULL"}),
    "employees": ("store_id = 5", {"name": "NULL", "salary": "-salary", "manager_id": "employee_id + 1000000000"}),
    "customers": ("city = 'NATION_3'", {"name": "NULL", "city": LONG}),
    "suppliers": ("city = 'NATION_3'", {"supplier_id": "NULL", "contact_person": "NULL"}),
    "products": ("category = 'PROMO'", {"category": LONG, "price": "-price", "stock": "-stock - 1", "supplier_id": "1000000000"}),
    "orders": ("order_status = 'P'", {"order_date": "NULL", "customer_id": "customer_id + 1000000000", "store_id": "99",
                                      "total_amount": "-total_amount - 1"}),
    "order_items": ("quantity = 7", {"order_item_id": "CASE WHEN line_no > 1 THEN order_item_id END", "quantity": "0", "price": "-price", "order_id": "order_id + 1000000000",
                                     "product_id": "product_id + 1000000000"}),
    "payments": ("payment_method = '1-URGENT'", {"payment_method": LONG, "payment_date": "NULL", "amount": "-amount",
                                                 "order_id": "order_id + 1000000000"}),
    "shipments": ("quantity = 10", {"quantity": "NULL", "product_id": "product_id + 1000000000"}),
}
SPOILED_CTE = ",\n".join(
    f"broken_{SQL_NAME.get(t, t)} AS (SELECT * FROM {SQL_NAME.get(t, t)} UNION ALL SELECT * REPLACE ("
    + ", ".join(f"{v} AS {c}" for c, v in cols.items()) + f") FROM {SQL_NAME.get(t, t)} WHERE {cond})"
    for t, (cond, cols) in SPOILED.items())


def _spoil(df, table):
    cond, cols = SPOILED[table]
    bad = df.where(cond).select(*[F.expr(cols[c]).cast(df.schema[c].dataType).alias(c) if c in cols else F.col(c)
                                  for c in df.columns])
    return df.unionByName(bad)


def fixtures_columns(table: str) -> list[str]:
    from ..schemas import SCHEMAS
    return SCHEMAS[table].fieldNames()


def _quality_tables(spark, sf):
    fixture = {name: "keyed_items" if name == "order_items" else name for name in QUALITY_TABLES}
    t = tables(spark, sf, *fixture.values())
    return {name: t[f] for name, f in fixture.items()}


@register("V", _quality_sql())
def quality_report(spark, sf):
    """One violation count per declared rule (V1-V6) over every fixture table."""
    return quality.quality_report(_quality_tables(spark, sf))


@register("V_broken", _quality_sql("broken_", SPOILED_CTE))
def quality_report_broken(spark, sf):
    """The same report after rows that break the rules were added to every table."""
    t = _quality_tables(spark, sf)
    return quality.quality_report({name: _spoil(df, name) for name, df in t.items()})


@register("V7", with_fixtures(f"""
SELECT payment_id, payment_method, '{AS_OF}' AS payment_date FROM payments""", "payments"))
def v7(spark, sf):
    """Payments that came without a date column get the default date."""
    p = tables(spark, sf, "payments")["payments"].drop("payment_date")
    out = quality.apply_defaults(p, "payments", AS_OF)
    return iso_dates(out.select("payment_id", "payment_method", "payment_date"), "payment_date")


@register("M10", with_fixtures(f"""
SELECT 'employee_audit' AS table_name,
       (SELECT COUNT(*) FROM employees WHERE store_id = {AUDIT_STORE}) AS rows_before,
       CAST(0 AS BIGINT) AS rows_after,
       (SELECT COUNT(*) FROM employees WHERE store_id = {AUDIT_STORE}) AS rows_deleted,
       CAST(0 AS BIGINT) AS rows_nulled""", "employees"))
def m10(spark, sf):
    """TRUNCATE of the audit table filled by M17: counts before and after."""
    t = tables(spark, sf, "employees", "employee_audit")
    ids = t["employees"].where(F.col("store_id") == AUDIT_STORE).select("employee_id")
    audit = changes.delete_employees(t, ids, DELETED_AT).tables["employee_audit"]
    return changes.change_counts({"employee_audit": audit}, {"employee_audit": changes.truncate(audit)})
