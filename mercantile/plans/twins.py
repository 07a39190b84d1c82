"""DuckDB twins of the reports, each defined once.

Written from the definitions of the reports, by another route than the
operators: facts are summed first or zero rows are added for parents without
facts, months are date ranges, hierarchies climb from the employee to the root.
"""

from __future__ import annotations

import datetime as dt

from ..fixtures import AS_OF
from .oracle import with_fixtures


def years_back(n: int) -> str:
    return f"DATE '{AS_OF.replace(year=AS_OF.year - n)}'"


def month_of(column: str, year: int, month: int) -> str:
    first, after = dt.date(year, month, 1), dt.date(year + month // 12, month % 12 + 1, 1)
    return f"{column} >= DATE '{first}' AND {column} < DATE '{after}'"


PRODUCT_TOTALS_CTE = """per_product AS (
    SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold FROM order_items GROUP BY product_id)"""
PRODUCT_TOTALS_BODY = """
SELECT product_id, (SELECT any_value(name) FROM products d WHERE d.product_id = t.product_id) AS product_name,
       total_quantity_sold
FROM per_product t WHERE product_id IN (SELECT product_id FROM products)"""
PRODUCT_TOTALS = with_fixtures(PRODUCT_TOTALS_BODY, "order_items", "products", extra=PRODUCT_TOTALS_CTE)
PRODUCT_TOP10 = with_fixtures(f"SELECT * FROM ({PRODUCT_TOTALS_BODY}) ORDER BY 3 DESC, 1 LIMIT 10",
                              "order_items", "products", extra=PRODUCT_TOTALS_CTE)


def parent_totals(parents: str, key: str, label: str, total: str) -> str:
    """Sum of order totals per parent; the parents' own zero rows keep those without orders."""
    return with_fixtures(f"""
SELECT {key}, max(label) AS {label}, CAST(SUM(amount) AS DOUBLE) AS {total} FROM (
  SELECT {key}, name AS label, CAST(0 AS DECIMAL(12,2)) AS amount FROM {parents}
  UNION ALL
  SELECT {key}, NULL, total_amount FROM shop_orders WHERE {key} IN (SELECT {key} FROM {parents}))
GROUP BY {key}""", parents, "shop_orders")


STORE_TOTALS = parent_totals("stores", "store_id", "store_name", "total_revenue")
SPENDING = parent_totals("customers", "customer_id", "customer_name", "total_spending")


def item_price_report(year: int, month: int) -> str:
    return with_fixtures("""
SELECT (SELECT name FROM stores n WHERE n.store_id = v.store_id) AS store_name,
       CAST(v.total AS DOUBLE) AS monthly_revenue FROM by_store v""", "stores", "shop_orders", "order_items", extra=f"""
by_order AS (SELECT order_id, SUM(price * quantity) AS worth FROM order_items GROUP BY order_id),
by_store AS (SELECT store_id, SUM(worth) AS total FROM by_order JOIN shop_orders USING (order_id)
             WHERE store_id IS NOT NULL AND {month_of('order_date', year, month)} GROUP BY store_id)""")


def list_price_report(year: int, month: int) -> str:
    return with_fixtures("""
SELECT (SELECT name FROM stores n WHERE n.store_id = v.store_id) AS store_name,
       CAST(COALESCE(v.total, 0) AS DOUBLE) AS monthly_sales FROM by_store v""",
                         "stores", "shop_orders", "order_items", "products", extra=f"""
worth AS (SELECT order_id, SUM(quantity * (SELECT price FROM products p WHERE p.product_id = i.product_id)) AS w
          FROM order_items i GROUP BY order_id),
by_store AS (SELECT store_id, SUM(w) AS total FROM shop_orders LEFT JOIN worth USING (order_id)
             WHERE store_id IS NOT NULL AND {month_of('order_date', year, month)} GROUP BY store_id)""")


MONTHLY_REVENUE = with_fixtures("""
SELECT store_id, (SELECT name FROM stores n WHERE n.store_id = m.store_id) AS store_name,
       CAST(year(first_day) AS INTEGER) AS year, CAST(month(first_day) AS INTEGER) AS month,
       CAST(total AS DOUBLE) AS monthly_revenue FROM per_month m""", "stores", "shop_orders", extra="""
per_month AS (SELECT store_id, date_trunc('month', order_date) AS first_day, SUM(total_amount) AS total
              FROM shop_orders WHERE store_id IS NOT NULL GROUP BY ALL)""")

ORDER_COLUMNS = """order_id, customer_id, store_id, strftime(order_date, '%Y-%m-%d') AS order_date,
       CAST(total_amount AS DOUBLE) AS total_amount, order_status"""


def orders_of(condition: str, *names: str) -> str:
    return with_fixtures(f"SELECT {ORDER_COLUMNS} FROM shop_orders WHERE {condition}", "shop_orders", *names)


# Customers without an order in two years: the newest order of each decides.
INACTIVE_CTE = f"""newest AS (SELECT customer_id, max(order_date) AS last_day FROM shop_orders
           WHERE customer_id IS NOT NULL GROUP BY customer_id),
gone AS (SELECT customer_id FROM customers LEFT JOIN newest USING (customer_id)
         WHERE COALESCE(last_day, DATE '0001-01-01') < {years_back(2)}
           AND NOT EXISTS (SELECT 1 FROM shop_orders WHERE customer_id IS NULL AND order_date >= {years_back(2)})),
gone_orders AS (SELECT order_id FROM shop_orders WHERE customer_id IN (SELECT customer_id FROM gone))"""


def climb(employees: str = "employees") -> str:
    """Every employee climbs to the root; who never arrives is on or under a cycle."""
    return f"""up(who, boss, hops) AS (
    SELECT employee_id, manager_id, 0 FROM {employees}
    UNION ALL
    SELECT up.who, e.manager_id, up.hops + 1 FROM up JOIN {employees} e ON e.employee_id = up.boss
    WHERE up.hops < 40)"""


def levels_body(employees: str = "employees") -> str:
    return f"""
SELECT e.employee_id, e.name, e.role, e.manager_id, top.hops AS level
FROM {employees} e JOIN up top ON top.who = e.employee_id WHERE top.boss IS NULL"""


def unreachable_body(employees: str = "employees") -> str:
    return f"""
SELECT employee_id, name, role, manager_id FROM {employees}
WHERE employee_id NOT IN (SELECT who FROM up WHERE boss IS NULL)"""


def why_unreachable_body(employees: str) -> str:
    """A climber who meets its own number is on a cycle; who meets such a one is below it."""
    member = "(SELECT who FROM up WHERE boss = who)"
    return f"""
SELECT e.employee_id, e.name, e.role, e.manager_id,
       CASE WHEN bool_or(u.boss = u.who) THEN 'on a cycle'
            WHEN bool_or(u.boss IN {member}) THEN 'below a cycle'
            ELSE 'below a missing manager' END AS reason,
       COALESCE(MIN(u.boss) FILTER (WHERE u.boss IN {member}),
                MAX(u.boss) FILTER (WHERE u.boss NOT IN (SELECT employee_id FROM {employees}))) AS cause
FROM {employees} e JOIN up u ON u.who = e.employee_id
GROUP BY ALL HAVING NOT bool_or(u.boss IS NULL)"""
