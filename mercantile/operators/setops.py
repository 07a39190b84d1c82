"""Set operations: UNION (Q10) and UNION ALL (Q11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import years_before


def people_list(customers: DataFrame, employees: DataFrame) -> DataFrame:
    """Q10: ``SELECT name, 'Customer' ... UNION SELECT name, 'Employee' ...``.

    Distinct on (name, type): a name can occur once under each type."""
    return (customers.select("name", F.lit("Customer").alias("type"))
            .union(employees.select("name", F.lit("Employee").alias("type")))
            .distinct())


def order_status_list(orders: DataFrame, as_of: dt.date | str | None = None, years: int = 1) -> DataFrame:
    """Q11: every order as 'Active', and orders placed before ``as_of - years``
    once more as 'Inactive' (UNION ALL, so old orders occur twice).

    One scan: each row explodes into one or two tagged rows instead of
    reading the table twice."""
    old = F.col("order_date") < years_before(as_of, years)
    tags = F.when(old, F.array(F.lit("Active"), F.lit("Inactive"))).otherwise(F.array(F.lit("Active")))
    return orders.select("order_id", "order_date", F.explode(tags).alias("order_status"))
