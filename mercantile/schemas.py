"""Table declarations: Spark schemas, integrity rules and the foreign-key graph.

Parquet tables do not enforce keys, NOT NULL or CHECK clauses, so the rules
live here as data and are applied by :mod:`mercantile.operators.quality` and
the change operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

# The retail schema (column name, Spark type) per table.
SCHEMAS: dict[str, T.StructType] = {
    "stores": T.StructType([
        T.StructField("store_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("manager_id", T.IntegerType()),
    ]),
    "employees": T.StructType([
        T.StructField("employee_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("salary", MONEY),
        T.StructField("manager_id", T.LongType()),
        T.StructField("hire_date", T.DateType()),
    ]),
    "customers": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("city", T.StringType()),
    ]),
    "suppliers": T.StructType([
        T.StructField("supplier_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("contact_person", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("city", T.StringType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("stock", T.IntegerType()),
        T.StructField("supplier_id", T.LongType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("total_amount", T.DecimalType(12, 2)),
        T.StructField("order_status", T.StringType()),
    ]),
    "order_items": T.StructType([
        T.StructField("order_item_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DecimalType(12, 2)),
        T.StructField("line_no", T.IntegerType()),
        T.StructField("arrival", T.DateType()),
    ]),
    "payments": T.StructType([
        T.StructField("payment_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("payment_method", T.StringType()),
        T.StructField("payment_date", T.DateType()),
    ]),
    "employee_audit": T.StructType([
        T.StructField("audit_id", T.LongType()),
        T.StructField("employee_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("salary", MONEY),
        T.StructField("manager_id", T.LongType()),
        T.StructField("deleted_at", T.TimestampNTZType()),
    ]),
    "monthly_sales": T.StructType([
        T.StructField("store_id", T.IntegerType()),
        T.StructField("month", T.StringType()),
        T.StructField("total_sales", T.DecimalType(22, 2)),
    ]),
    "shipments": T.StructType([
        T.StructField("shipment_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("shipment_date", T.DateType()),
    ]),
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str
    on_delete: str  # "CASCADE" | "SET NULL" | "NO ACTION"


@dataclass(frozen=True)
class TableRules:
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    # SQL boolean expressions; a NULL result passes, as for SQL CHECK.
    checks: dict[str, str] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)
    # Columns filled from ``as_of`` when the input lacks them.
    defaults: dict[str, str] = field(default_factory=dict)


# Keys, NOT NULL, UNIQUE, CHECK and length rules of the schema.
RULES: dict[str, TableRules] = {
    "stores": TableRules(
        primary_key=("store_id",), not_null=("name", "location"),
        max_length={"name": 255, "location": 255}),
    "employees": TableRules(
        primary_key=("employee_id",), not_null=("name", "role"),
        checks={"salary_non_negative": "salary >= 0"},
        max_length={"name": 255, "role": 100}, decimals={"salary": (10, 2)}),
    "customers": TableRules(
        primary_key=("customer_id",), not_null=("name", "email", "phone", "city"),
        unique=("email", "phone"),
        max_length={"name": 255, "email": 255, "phone": 20, "city": 255}),
    "suppliers": TableRules(
        primary_key=("supplier_id",), not_null=("name", "contact_person", "phone", "city"),
        unique=("phone",),
        max_length={"name": 255, "contact_person": 255, "phone": 20, "city": 255}),
    "products": TableRules(
        primary_key=("product_id",), not_null=("name", "category"),
        checks={"price_non_negative": "price >= 0", "stock_non_negative": "stock >= 0"},
        max_length={"name": 255, "category": 100}, decimals={"price": (10, 2)}),
    "orders": TableRules(
        primary_key=("order_id",), not_null=("order_date",),
        checks={"total_non_negative": "total_amount >= 0"},
        decimals={"total_amount": (10, 2)}, defaults={"order_date": "current_date"}),
    "order_items": TableRules(
        primary_key=("order_item_id",),
        checks={"quantity_positive": "quantity > 0", "price_non_negative": "price >= 0"},
        decimals={"price": (10, 2)}),
    "payments": TableRules(
        primary_key=("payment_id",), not_null=("payment_method", "payment_date"),
        checks={"amount_non_negative": "amount >= 0"},
        max_length={"payment_method": 50}, decimals={"amount": (10, 2)},
        defaults={"payment_date": "current_date"}),
    "employee_audit": TableRules(
        primary_key=("audit_id",), defaults={"deleted_at": "current_timestamp"}),
    "monthly_sales": TableRules(),
    "shipments": TableRules(
        primary_key=("shipment_id",), not_null=("quantity",),
        defaults={"shipment_date": "current_date"}),
}

# The foreign keys and their ON DELETE actions.
FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("employees", "store_id", "stores", "store_id", "SET NULL"),
    ForeignKey("employees", "manager_id", "employees", "employee_id", "SET NULL"),
    ForeignKey("products", "supplier_id", "suppliers", "supplier_id", "CASCADE"),
    ForeignKey("orders", "customer_id", "customers", "customer_id", "CASCADE"),
    ForeignKey("orders", "store_id", "stores", "store_id", "SET NULL"),
    ForeignKey("order_items", "order_id", "orders", "order_id", "CASCADE"),
    ForeignKey("order_items", "product_id", "products", "product_id", "CASCADE"),
    ForeignKey("payments", "order_id", "orders", "order_id", "CASCADE"),
    ForeignKey("monthly_sales", "store_id", "stores", "store_id", "NO ACTION"),
    ForeignKey("shipments", "product_id", "products", "product_id", "NO ACTION"),
)

# Parents before children; the employees self edge is handled in place.
TABLE_ORDER: tuple[str, ...] = (
    "stores", "suppliers", "customers", "employees", "products", "orders",
    "order_items", "payments", "monthly_sales", "shipments", "employee_audit",
)


def foreign_keys_from(parent: str) -> list[ForeignKey]:
    return [fk for fk in FOREIGN_KEYS if fk.parent == parent]


def foreign_keys_of(child: str) -> list[ForeignKey]:
    return [fk for fk in FOREIGN_KEYS if fk.child == child]


def check_names(table: str, columns: list[str] | tuple[str, ...]) -> None:
    """Refuse unknown table or column names instead of pasting them into SQL."""
    if table not in SCHEMAS:
        raise ValueError(f"unknown table {table!r}")
    known = set(SCHEMAS[table].fieldNames())
    bad = [c for c in columns if c not in known]
    if bad:
        raise ValueError(f"unknown columns for {table}: {bad}")
