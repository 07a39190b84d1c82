"""Named queries Q3-Q12: hierarchy, pivot, joins, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import MONTH_LABELS
from ..operators import hierarchy, joins, pivot, reports, setops
from . import twins
from .catalog import AS_OF, doubles, iso_dates, register, tables
from .oracle import with_fixtures

@register("Q3", with_fixtures(twins.levels_body(), "employees", recursive=twins.climb()))
def q3(spark, sf):
    t = tables(spark, sf, "employees")
    return hierarchy.hierarchy(t["employees"]).levels


@register("Q3b", with_fixtures(f"""
SELECT employee_id, level, format('{{}}Level {{}}: Employee ID: {{}}, Name: {{}}, Role: {{}}, Manager ID: {{}}',
       repeat('  ', level), level, employee_id, name, role, COALESCE(CAST(manager_id AS VARCHAR), 'None')) AS line
FROM ({twins.levels_body()})""", "employees", recursive=twins.climb()))
def q3b(spark, sf):
    t = tables(spark, sf, "employees")
    return hierarchy.indent_lines(hierarchy.hierarchy(t["employees"]).levels)


# Employee 1 reports to 13, who reports to 1: their teams hang on a cycle.
CYCLE_CTE = """looped AS (SELECT * REPLACE (CASE WHEN employee_id = 1 THEN 13 ELSE manager_id END AS manager_id)
           FROM employees)"""


def _looped(spark, sf):
    e = tables(spark, sf, "employees")["employees"]
    return hierarchy.hierarchy(e.withColumn(
        "manager_id", F.when(F.col("employee_id") == 1, F.lit(13)).otherwise(F.col("manager_id"))))


@register("Q3_cycle", with_fixtures(twins.levels_body("looped"), "employees", extra=CYCLE_CTE,
                                    recursive=twins.climb("looped")))
def q3_cycle(spark, sf):
    return _looped(spark, sf).levels


@register("Q3_unreachable", with_fixtures(twins.unreachable_body("looped"), "employees", extra=CYCLE_CTE,
                                          recursive=twins.climb("looped")))
def q3_unreachable(spark, sf):
    return _looped(spark, sf).unreachable


# As above, and everyone who reported to employee 2 reports to somebody unknown.
BROKEN_CTE = """broken AS (SELECT * REPLACE (CASE WHEN employee_id = 1 THEN 13 WHEN manager_id = 2 THEN -2
                                ELSE manager_id END AS manager_id) FROM employees)"""


@register("Q3_why", with_fixtures(twins.why_unreachable_body("broken"), "employees", extra=BROKEN_CTE,
                                  recursive=twins.climb("broken")))
def q3_why(spark, sf):
    e = tables(spark, sf, "employees")["employees"]
    boss = (F.when(F.col("employee_id") == 1, F.lit(13)).when(F.col("manager_id") == 2, F.lit(-2))
            .otherwise(F.col("manager_id")))
    return hierarchy.why_unreachable(hierarchy.hierarchy(e.withColumn("manager_id", boss)).unreachable)


_PIVOT_COLS = ",\n       ".join(
    f"CAST(SUM(CASE WHEN month = '{m}' THEN total_sales END) AS DOUBLE) AS \"{m}\""
    for m in MONTH_LABELS)


@register("Q4", with_fixtures(f"""
SELECT store_id,
       {_PIVOT_COLS}
FROM monthly_sales GROUP BY store_id""", "monthly_sales"))
def q4(spark, sf):
    t = tables(spark, sf, "monthly_sales")
    return doubles(pivot.pivot_months(t["monthly_sales"]), *MONTH_LABELS)


@register("Q4_display", with_fixtures("""
SELECT store_id, """ + ", ".join(
    f"""COALESCE(CAST(CAST(SUM(total_sales) FILTER (WHERE month = '{m}') AS DECIMAL(38,2)) AS VARCHAR), '0.00') AS "{m}\""""
    for m in MONTH_LABELS) + " FROM monthly_sales GROUP BY store_id", "monthly_sales"))
def q4_display(spark, sf):
    """The pivot as text, missing cells shown as 0.00."""
    t = tables(spark, sf, "monthly_sales")
    return pivot.pivot_to_text(pivot.pivot_months(t["monthly_sales"]))


# Outer joins over tables with gaps on both sides: supplier contacts are
# customers without orders, guest orders have no customer.  The twin lists
# matched pairs and adds the lonely rows of either side.
MATCHED = """SELECT c.customer_id, c.name AS customer_name, o.order_id, o.order_date, o.total_amount
  FROM gap_customers c, gap_orders o WHERE c.customer_id = o.customer_id"""
LONELY = """SELECT customer_id, name, NULL, NULL, NULL FROM gap_customers
  WHERE customer_id NOT IN (SELECT customer_id FROM gap_orders WHERE customer_id IS NOT NULL)"""
GUESTS = """SELECT NULL, NULL, order_id, order_date, total_amount FROM gap_orders
  WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM gap_customers)"""
PARTS = {"inner": [MATCHED], "left": [MATCHED, LONELY], "right": [MATCHED, GUESTS],
         "full": [MATCHED, LONELY, GUESTS]}
CUSTOMER_TEXT = """,
       COALESCE(CAST(customer_id AS VARCHAR), 'No Customer') AS customer_id_text,
       COALESCE(customer_name, 'N/A') AS customer_name_text"""
ORDER_TEXT = """,
       COALESCE(CAST(order_id AS VARCHAR), 'No Order') AS order_id_text,
       COALESCE(strftime(order_date, '%Y-%m-%d'), 'N/A') AS order_date_text,
       COALESCE(CAST(CAST(total_amount AS DECIMAL(38,2)) AS VARCHAR), '0.00') AS total_amount_text"""


def _join_sql(how: str, display: bool = False) -> str:
    text = (CUSTOMER_TEXT * (how in ("right", "full")) + ORDER_TEXT * (how in ("left", "full"))) * display
    return with_fixtures("""
SELECT customer_id, customer_name, order_id, strftime(order_date, '%Y-%m-%d') AS order_date,
       CAST(total_amount AS DOUBLE) AS total_amount""" + text + " FROM (" + " UNION ALL ".join(PARTS[how]) + ")",
                         "gap_customers", "gap_orders")


def _join_query(how: str, display: bool = False):
    def run(spark, sf):
        t = tables(spark, sf, "gap_customers", "gap_orders")
        out = joins.customer_orders_join(t["gap_customers"], t["gap_orders"], how, display=display)
        return iso_dates(doubles(out, "total_amount"), "order_date")
    run.__name__ = f"customer_orders_{how}"
    return run


for _name, _how in (("Q5", "inner"), ("Q6", "left"), ("Q7", "right"), ("Q8", "full")):
    register(_name, _join_sql(_how))(_join_query(_how))
    if _how != "inner":
        register(f"{_name}_display", _join_sql(_how, True))(_join_query(_how, True))


# Brute-force twin: everybody counts the others under the same manager.
PEERS_CTE = """peers AS (SELECT employee_id, name, manager_id,
    (SELECT COUNT(*) FROM employees x WHERE x.manager_id = e.manager_id AND x.employee_id <> e.employee_id) AS others
    FROM employees e)"""


@register("Q9", with_fixtures("""
SELECT employee_id, name AS employee_name, manager_id, others AS peer_count FROM peers WHERE others > 0""",
                              "employees", extra=PEERS_CTE))
def q9(spark, sf):
    t = tables(spark, sf, "employees")
    return joins.same_manager_peers(t["employees"])


@register("Q9_pairs", with_fixtures("""
SELECT manager_id, COUNT(*) AS reports, CAST(SUM(others) AS BIGINT) AS pairs FROM peers
WHERE others > 0 GROUP BY manager_id""", "employees", extra=PEERS_CTE))
def q9_pairs(spark, sf):
    t = tables(spark, sf, "employees")
    return joins.manager_pair_counts(t["employees"])


@register("Q10", with_fixtures("""
SELECT name, type FROM (SELECT name, 'Customer' AS type FROM customers
                        UNION ALL SELECT name, 'Employee' FROM employees) GROUP BY ALL""", "customers", "employees"))
def q10(spark, sf):
    t = tables(spark, sf, "customers", "employees")
    return setops.people_list(t["customers"], t["employees"])


@register("Q11", with_fixtures(f"""
SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date,
       unnest(CASE WHEN order_date < {twins.years_back(1)} THEN ['Active', 'Inactive'] ELSE ['Active'] END)
         AS order_status
FROM shop_orders""", "shop_orders"))
def q11(spark, sf):
    t = tables(spark, sf, "order_heads")
    return iso_dates(setops.order_status_list(t["order_heads"], AS_OF), "order_date")


@register("Q12", with_fixtures("SELECT * FROM customers WHERE customer_id IN (SELECT customer_id FROM gone)",
                               "customers", "shop_orders", extra=twins.INACTIVE_CTE))
def q12(spark, sf):
    t = tables(spark, sf, "customers", "order_heads")
    return reports.inactive_customers(t["customers"], t["order_heads"], AS_OF)


@register("Q12_count", with_fixtures("SELECT COUNT(*) AS inactive_customers FROM gone",
                                     "customers", "shop_orders", extra=twins.INACTIVE_CTE))
def q12_count(spark, sf):
    t = tables(spark, sf, "customers", "order_heads")
    return reports.inactive_customers(t["customers"], t["order_heads"], AS_OF).agg(
        F.count(F.lit(1)).alias("inactive_customers"))
