"""DuckDB SQL twins of the named queries.

The driver registers the raw star-schema tables as views; the retail tables
are rebuilt here as CTEs with the same definitions as
:mod:`mercantile.fixtures` (``orders`` is ``shop_orders`` because the raw
table already owns that name).  Result types follow the contract of
:mod:`mercantile.plans.catalog`: keys BIGINT, small ints INTEGER, money
DOUBLE of an exact decimal sum, dates ISO text.
"""

from __future__ import annotations

FIXTURE_SQL: dict[str, str] = {
    "stores": """
        SELECT n_nationkey AS store_id, n_name AS name,
               concat('Region ', CAST(n_regionkey AS VARCHAR)) AS location,
               CAST(NULL AS INTEGER) AS manager_id
        FROM nation""",
    "employees": """
        SELECT c_custkey AS employee_id, c_name AS name, c_mktsegment AS role,
               c_nationkey AS store_id, CAST(abs(c_acctbal) AS DECIMAL(10,2)) AS salary,
               CASE WHEN c_custkey < 5 THEN NULL
                    ELSE CAST(floor((c_custkey - 5) / 8.0) AS BIGINT) END AS manager_id,
               DATE '1990-01-01' + CAST((c_custkey * 37) % 4000 AS INTEGER) AS hire_date
        FROM customer""",
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS name,
               concat(lower(c_name), '@example.com') AS email,
               CAST(8000000000 + c_custkey AS VARCHAR) AS phone,
               concat('NATION_', CAST(c_nationkey AS VARCHAR)) AS city
        FROM customer""",
    "suppliers": """
        SELECT s_suppkey AS supplier_id, s_name AS name,
               concat('Contact ', s_name) AS contact_person,
               CAST(9000000000 + s_suppkey AS VARCHAR) AS phone,
               concat('NATION_', CAST(s_nationkey AS VARCHAR)) AS city
        FROM supplier""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price,
               CAST(p_size * 30 AS INTEGER) AS stock, p_partkey % 10 AS supplier_id
        FROM part""",
    "shop_orders": """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
               CASE WHEN c.c_nationkey >= 23 THEN NULL ELSE c.c_nationkey END AS store_id,
               CAST(o.o_orderdate AS DATE) AS order_date,
               CAST(o.o_totalprice AS DECIMAL(12,2)) AS total_amount,
               o.o_orderstatus AS order_status
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "gap_customers": """
        SELECT * FROM customers
        UNION ALL
        SELECT 1000000000 + supplier_id, contact_person, lower(name) || '@supplier.example', phone, city
        FROM suppliers""",
    "gap_orders": """
        SELECT * REPLACE (CASE WHEN order_status <> 'P' THEN customer_id END AS customer_id) FROM shop_orders""",
    "order_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               l_linenumber AS line_no, CAST(l_shipdate AS DATE) AS arrival
        FROM lineitem""",
    "keyed_items": """
        SELECT ROW_NUMBER() OVER (ORDER BY arrival, order_id, line_no, product_id, quantity, price) AS order_item_id, *
        FROM order_items""",
    "payments": """
        SELECT o_orderkey AS payment_id, o_orderkey AS order_id,
               CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
               o_orderpriority AS payment_method, CAST(o_orderdate AS DATE) AS payment_date
        FROM orders""",
    "shipments": """
        SELECT p_partkey AS shipment_id, p_partkey AS product_id,
               CAST(p_size AS INTEGER) AS quantity, DATE '2001-08-01' AS shipment_date
        FROM part
        UNION ALL
        SELECT 1000000000 + p_partkey, p_partkey, 10, DATE '2001-08-01'
        FROM part WHERE p_type = 'PROMO'""",
    "monthly_sales": """
        SELECT store_id, strftime(order_date, '%b') AS month,
               SUM(total_amount) AS total_sales
        FROM shop_orders
        WHERE store_id IS NOT NULL
        GROUP BY store_id, strftime(order_date, '%b')""",
}

DEPENDS = {"monthly_sales": ("shop_orders",), "gap_customers": ("customers", "suppliers"),
           "gap_orders": ("shop_orders",), "keyed_items": ("order_items",)}
ORDER = ("stores", "employees", "customers", "suppliers", "products", "shop_orders",
         "order_items", "payments", "shipments", "monthly_sales", "gap_customers", "gap_orders",
         "keyed_items")


def with_fixtures(body: str, *names: str, recursive: str = "", extra: str = "") -> str:
    """Prefix ``body`` with the fixture CTEs it names (plus dependencies).

    ``recursive`` is a recursive CTE placed after the fixtures (the clause
    becomes ``WITH RECURSIVE``); ``extra`` holds further plain CTEs."""
    need: set[str] = set()
    for n in names:
        need.add(n)
        need.update(DEPENDS.get(n, ()))
    parts = [f"{n} AS ({FIXTURE_SQL[n]})" for n in ORDER if n in need]
    if extra:
        parts.append(extra)
    if recursive:
        parts.append(recursive)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body
