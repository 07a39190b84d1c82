"""Joins J1-J8.

Skew: one customer may own a third of all orders.  Outer joins are therefore
written so that the big, possibly skewed side (orders) is the *streamed*
(left) side of a left or inner join — the shapes AQE's skew-join split
supports — and the "unmatched dimension rows" part comes from an anti join
against the *distinct* fact keys, which partial aggregation shrinks map-side.
A FULL OUTER join of the two tables, which AQE cannot split, never appears.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import placeholder, two_decimals
from ..session import written

JOIN_COLUMNS = ("customer_id", "customer_name", "order_id", "order_date", "total_amount")


def customer_orders_join(customers: DataFrame, orders: DataFrame, how: str = "inner",
                         display: bool = False, ordered: bool = True) -> DataFrame:
    """Customers joined with their orders.

    Columns customer_id (customer side), customer_name, order_id, order_date,
    total_amount.  ``how`` is inner / left / right / full; ``display`` adds the
    text columns with the placeholders 'No Order', 'N/A', '0.00' and
    'No Customer' for NULLs (only NULL counts as missing)."""
    how = {"left_outer": "left", "right_outer": "right", "outer": "full",
           "full_outer": "full"}.get(how, how)
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unsupported join type {how!r}")
    c = customers.select(F.col("customer_id").alias("_ck"), F.col("name").alias("customer_name"))
    o = orders.select(F.col("customer_id").alias("_ok"), "order_id", "order_date", "total_amount")
    cond = F.col("_ok") == F.col("_ck")
    fact_side = o.join(c, cond, "inner" if how in ("inner", "left") else "left")
    if how in ("left", "full"):
        order_keys = o.where(F.col("_ok").isNotNull()).select("_ok").distinct()
        lonely = c.join(order_keys, cond, "left_anti").select(
            "_ck", "customer_name",
            F.lit(None).cast(orders.schema["order_id"].dataType).alias("order_id"),
            F.lit(None).cast(orders.schema["order_date"].dataType).alias("order_date"),
            F.lit(None).cast(orders.schema["total_amount"].dataType).alias("total_amount"))
        fact_side = fact_side.select(*lonely.columns).unionByName(lonely)
    out = fact_side.select(F.col("_ck").alias("customer_id"), "customer_name",
                           "order_id", "order_date", "total_amount")
    if display:
        out = out.withColumns(display_columns(how))
    if ordered:
        # order_id breaks ties, and lets the range sort split a hot customer.
        keys = {"inner": [F.asc("customer_id"), F.asc("order_id")],
                "left": [F.asc("customer_id"), F.asc("order_id")],
                "right": [F.asc("order_id")],
                "full": [F.asc_nulls_last("customer_id"), F.asc_nulls_last("order_id")]}[how]
        out = out.orderBy(*keys)
    return out


def display_columns(how: str) -> dict[str, Column]:
    cols: dict[str, Column] = {}
    if how in ("right", "full"):
        cols["customer_id_text"] = placeholder("customer_id", "No Customer")
        cols["customer_name_text"] = placeholder("customer_name", "N/A")
    if how in ("left", "full"):
        cols["order_id_text"] = placeholder("order_id", "No Order")
        cols["order_date_text"] = placeholder(F.date_format("order_date", "yyyy-MM-dd"), "N/A")
        cols["total_amount_text"] = F.coalesce(two_decimals("total_amount"), F.lit("0.00"))
    return cols


def same_manager_peers(employees: DataFrame) -> DataFrame:
    """J5, re-aimed: one row per employee who shares a manager with someone.

    The reference lists every ordered pair (e1, e2) with the same manager,
    which is quadratic in the team size (a manager over a third of the staff
    would give ~N²/9 rows).  The pair relation is fully described by team
    membership, so we return employee_id, employee_name, manager_id and
    peer_count (the number of pairs in which the employee is e1).  The team
    sizes are written before they meet the staff, so AQE splits a hot manager."""
    staff = employees.where(F.col("manager_id").isNotNull()).select(
        "employee_id", F.col("name").alias("employee_name"), "manager_id")
    sizes = written(staff.groupBy("manager_id").agg(F.count(F.lit(1)).alias("_team")))
    return (staff.join(sizes, "manager_id", "inner")
            .where(F.col("_team") > 1)
            .select("employee_id", "employee_name", "manager_id",
                    (F.col("_team") - 1).alias("peer_count")))


def manager_pair_counts(employees: DataFrame) -> DataFrame:
    """Per manager: team size and the number of ordered same-manager pairs
    (the row count of the reference's self join for that manager)."""
    return (employees.where(F.col("manager_id").isNotNull())
            .groupBy("manager_id").agg(F.count(F.lit(1)).alias("reports"))
            .where(F.col("reports") > 1)
            .select("manager_id", "reports",
                    (F.col("reports") * (F.col("reports") - 1)).alias("pairs")))


def not_in(df: DataFrame, key: str, sub: DataFrame, sub_key: str | None = None) -> DataFrame:
    """``df WHERE key NOT IN (SELECT sub_key FROM sub)`` with SQL's NULL rules.

    * empty subquery: every row qualifies (a NULL key too);
    * a NULL in the subquery: no row qualifies;
    * otherwise rows with a NULL key drop out, the rest is an anti join.

    Spark plans a single-column NOT IN as a null-aware anti join only when the
    subquery side can be broadcast, and otherwise falls back to a nested loop.
    Here the anti join runs on the distinct non-null keys (any size, shuffled
    or broadcast by statistics), and the two special cases come from one
    scalar subquery (one row) instead of a cross join."""
    sub_key = sub_key or key
    # One distinct pass over the subquery feeds both the flags and the anti
    # join (the same exchange is reused, so the subquery is read once).
    keys = sub.select(F.col(sub_key).alias("_nk")).distinct()
    flags = keys.select(F.struct(
        (F.count(F.lit(1)) > 0).alias("any_row"),
        F.coalesce(F.max(F.col("_nk").isNull()), F.lit(False)).alias("any_null"),
    ).alias("_f")).scalar()
    distinct_keys = keys.where(F.col("_nk").isNotNull())
    kept = df.join(distinct_keys, df[key] == distinct_keys["_nk"], "left_anti")
    any_row, any_null = flags.getField("any_row"), flags.getField("any_null")
    return kept.where(~any_row | (~any_null & F.col(key).isNotNull()))


def not_exists(df: DataFrame, sub: DataFrame, on: list[str] | str) -> DataFrame:
    """``NOT EXISTS`` (NULL keys never match) as a left anti join."""
    return df.join(sub, on, "left_anti")
