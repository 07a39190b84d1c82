"""Named queries for sources and sinks (S1-S10): each writes to the shared
scratch folder and reads the files back with the library's readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import reports
from ..session import scratch_path
from ..sources import export, ingest, tables as table_ops, workbook
from . import twins
from .catalog import AS_OF, doubles, iso_dates, register, tables
from .oracle import with_fixtures

ORDER_COLS = ["order_id", "customer_id", "store_id", "order_date", "total_amount", "order_status"]
ORDERS_SQL = with_fixtures("""
SELECT order_id, customer_id, store_id, strftime(order_date, '%Y-%m-%d') AS order_date,
       CAST(total_amount AS DOUBLE) AS total_amount, order_status
FROM shop_orders""", "shop_orders")


@register("S1", with_fixtures("""
SELECT product_id, name, category, CAST(price AS DOUBLE) AS price, stock, supplier_id
FROM products""", "products"))
def s1(spark, sf):
    """Table scan, all columns in declared order."""
    return doubles(tables(spark, sf, "products")["products"], "price")


def _orders_out(df):
    return iso_dates(doubles(df.select(*ORDER_COLS), "total_amount"), "order_date")


@register("S3", ORDERS_SQL)
def s3(spark, sf):
    """Orders exported as CSV files, ingested back with the table's rules
    (parents: customers, stores) and the all-or-nothing rule per file."""
    t = tables(spark, sf, "orders", "customers", "stores")
    folder = scratch_path(spark, "orders-csv")
    t["orders"].repartition(4).write.option("header", True).csv(folder)
    res = ingest.ingest(spark, folder, "orders", "csv",
                        parents={"customers": t["customers"], "stores": t["stores"]})
    return _orders_out(res.accepted)


@register("S2", ORDERS_SQL)
def s2(spark, sf):
    """Orders exported as workbooks (one per task), ingested back."""
    t = tables(spark, sf, "orders", "customers", "stores")
    folder = scratch_path(spark, "orders-xlsx")
    workbook.write_workbooks(t["orders"].repartition(4), folder, "Orders")
    res = ingest.ingest(spark, folder, "orders", "xlsx",
                        parents={"customers": t["customers"], "stores": t["stores"]})
    return _orders_out(res.accepted)


SPENDING_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("customer_name", T.StringType()),
    T.StructField("total_spending", T.DecimalType(22, 2))])
REVENUE_SCHEMA = T.StructType([
    T.StructField("store_id", T.IntegerType()), T.StructField("store_name", T.StringType()),
    T.StructField("total_revenue", T.DecimalType(22, 2))])


@register("S6", twins.SPENDING)
def s6(spark, sf):
    """Customer spending exported as CSV (format name in any case), read back."""
    t = tables(spark, sf, "customers", "orders")
    rep = reports.customer_spending(t["customers"], t["orders"], ordered=False)
    folder = export.export(rep, scratch_path(spark, "spending-csv"), "csv",
                           order_by=["total_spending", "customer_id"])
    back = ingest.read_csv(spark, folder, SPENDING_SCHEMA)
    return doubles(back.select(*SPENDING_SCHEMA.fieldNames()), "total_spending")


@register("S7", twins.STORE_TOTALS)
def s7(spark, sf):
    """Store revenue exported as workbooks (sheet 'Store Revenue'), read back."""
    t = tables(spark, sf, "stores", "orders")
    rep = reports.store_revenue(t["stores"], t["orders"], ordered=False)
    folder = export.export(rep, scratch_path(spark, "revenue-xlsx"), "XLSX",
                           order_by=["store_id"], sheet="Store Revenue")
    back = workbook.read_workbooks(spark, folder, REVENUE_SCHEMA)
    return doubles(back.select(*REVENUE_SCHEMA.fieldNames()), "total_revenue")


@register("S4", with_fixtures("""
SELECT 1000000 + supplier_id AS customer_id, name, lower(name) || '@supplier.example' AS email,
       phone, city
FROM suppliers""", "suppliers"))
def s4(spark, sf):
    """Insert-if-absent: suppliers sign up twice (the first copy wins) and the
    customers of NATION_5 are sent again (existing keys win)."""
    t = tables(spark, sf, "customers", "suppliers")
    sup = t["suppliers"].select(
        (F.lit(1000000) + F.col("supplier_id")).alias("customer_id"), "name",
        F.concat(F.lower("name"), F.lit("@supplier.example")).alias("email"), "phone", "city")
    batch = (sup.withColumn("seq", F.lit(1))
             .unionByName(sup.withColumn("name", F.concat("name", F.lit(" (again)"))).withColumn("seq", F.lit(2)))
             .unionByName(t["customers"].where(F.col("city") == "NATION_5").withColumn("seq", F.lit(0))))
    res = table_ops.append_new(t["customers"], batch, "customer_id", ["seq"], unique=("email", "phone"))
    return res.added


@register("S10", with_fixtures("""
SELECT product_id, name, category, CAST(price AS DOUBLE) AS price, stock, supplier_id
FROM products WHERE name = 'small ring'""", "products"))
def s10(spark, sf):
    """Products written clustered by name; a lookup by name reads back."""
    t = tables(spark, sf, "products")
    path = table_ops.write_clustered(t["products"], scratch_path(spark, "products-by-name"), ["name"])
    return doubles(spark.read.parquet(path).where(F.col("name") == "small ring"), "price")


@register("S5", with_fixtures("""
SELECT s.supplier_id AS customer_id, CAST(2 AS BIGINT) AS rows
FROM suppliers s JOIN customers c ON c.customer_id = s.supplier_id""", "suppliers", "customers"))
def s5(spark, sf):
    """Plain INSERT of supplier contacts keyed by supplier id: every key that
    already exists is a duplicate, so the batch is refused; the report lists
    the duplicate keys."""
    t = tables(spark, sf, "customers", "suppliers")
    batch = t["suppliers"].select(
        F.col("supplier_id").alias("customer_id"), "name",
        F.concat(F.lower("name"), F.lit("@supplier.example")).alias("email"), "phone", "city")
    return table_ops.append(t["customers"], batch, "customer_id").duplicates


# Files of payments as they come in: by column order, without the date column,
# with a date that does not parse, and with keys of earlier files.
LAYOUTS_SQL = with_fixtures(f"""
SELECT payment_id, CAST(amount AS DOUBLE) AS amount, payment_method,
       CASE WHEN payment_method = '2-HIGH' THEN '{AS_OF}' ELSE strftime(payment_date, '%Y-%m-%d') END AS payment_date
FROM payments WHERE payment_method <> '3-MEDIUM'""", "payments")


def _layouts(spark, sf, fmt):
    p = tables(spark, sf, "payments")["payments"]
    base = scratch_path(spark, f"payments-{fmt}")
    of = lambda m: p.where(F.col("payment_method") == m)
    parts = {
        "a": of("1-URGENT").select(*reversed(p.columns)),
        "b": of("2-HIGH").drop("payment_date"),
        "c": of("3-MEDIUM").withColumn("payment_date", F.date_format("payment_date", "yyyyMMdd")),
        "d": of("1-URGENT").withColumn("amount", F.lit("1.00").cast("decimal(12,2)")),
        "e": p.where(~F.col("payment_method").isin("1-URGENT", "2-HIGH", "3-MEDIUM")),
    }
    for name, df in parts.items():
        if fmt == "csv":
            export.export_csv(df.repartition(2), f"{base}/{name}")
        else:
            workbook.write_workbooks(df.repartition(2), f"{base}/{name}", "Payments")
    got = ingest.ingest(spark, base, "payments", fmt, as_of=AS_OF).accepted
    return iso_dates(doubles(got.select("payment_id", "amount", "payment_method", "payment_date"), "amount"),
                     "payment_date")


@register("S3_layouts", LAYOUTS_SQL)
def s3_layouts(spark, sf):
    """CSV files with shuffled columns, a missing DEFAULT column, bad dates
    (refused) and repeated keys in later files (refused)."""
    return _layouts(spark, sf, "csv")


@register("S2_layouts", LAYOUTS_SQL)
def s2_layouts(spark, sf):
    """The same as workbooks."""
    return _layouts(spark, sf, "xlsx")


@register("S3_quotes", with_fixtures("""
SELECT customer_id, 'Joe "' || name || '" Shop, Main' AS name, city || chr(10) || 'second line' AS city
FROM customers""", "customers"))
def s3_quotes(spark, sf):
    """Quotes, commas and line breaks inside fields, written and read back."""
    c = tables(spark, sf, "customers")["customers"]
    odd = c.withColumns({"name": F.concat(F.lit('Joe "'), "name", F.lit('" Shop, Main')),
                         "city": F.concat("city", F.lit("\nsecond line"))})
    folder = export.export_csv(odd, scratch_path(spark, "customers-csv"), ["customer_id"])
    return ingest.ingest(spark, folder, "customers", "csv").accepted.select("customer_id", "name", "city")


@register("S4_nulls", with_fixtures("""
SELECT 'customer_id' AS column_name, CAST(NULL AS VARCHAR) AS value, COUNT(*) AS rows
FROM suppliers WHERE city = 'NATION_3' HAVING COUNT(*) > 0""", "suppliers"))
def s4_nulls(spark, sf):
    """Insert-if-absent with NULL keys in the batch: they refuse the statement."""
    t = tables(spark, sf, "customers", "suppliers")
    batch = _contacts(t["suppliers"]).withColumn("seq", F.lit(1))
    res = table_ops.append_new(t["customers"], batch, "customer_id", ["seq"], unique=("email", "phone"))
    return res.conflicts


@register("S5_nulls", with_fixtures("""
SELECT CAST(NULL AS BIGINT) AS customer_id, COUNT(*) AS rows
FROM suppliers WHERE city = 'NATION_3' HAVING COUNT(*) > 0""", "suppliers"))
def s5_nulls(spark, sf):
    """Plain INSERT with NULL keys: the batch is refused."""
    t = tables(spark, sf, "customers", "suppliers")
    return table_ops.append(t["customers"], _contacts(t["suppliers"]), "customer_id").duplicates


def _contacts(suppliers):
    """Supplier contacts as customers; those of NATION_3 lack their key."""
    return suppliers.select(
        F.when(F.col("city") != "NATION_3", F.lit(1_000_000_000) + F.col("supplier_id")).alias("customer_id"), "name",
        F.concat(F.lower("name"), F.lit("@supplier.example")).alias("email"), "phone", "city")


@register("S7_keys", with_fixtures("""
SELECT order_status, COUNT(*) AS rows, CAST(1 AS BIGINT) AS keys_in_a_file FROM shop_orders GROUP BY order_status""",
                                   "shop_orders"))
def s7_keys(spark, sf):
    """Orders exported twice to one folder as workbooks of one status each: the
    second export replaces the first, and no file mixes keys."""
    o = tables(spark, sf, "order_heads")["order_heads"]
    folder = scratch_path(spark, "orders-by-status")
    for _ in range(2):
        export.export(o, folder, "xlsx", order_by=["order_id"], partition_by=["order_status"])
    back = workbook.read_workbooks(spark, folder, o.schema)
    files = back.groupBy("_file").agg(F.count_distinct("order_status").alias("k"))
    return (back.join(files, "_file").groupBy("order_status")
            .agg(F.count(F.lit(1)).alias("rows"), F.max("k").alias("keys_in_a_file")))


@register("S9", f"""
SELECT r.report, f.format, r.rows, r.total FROM (
  SELECT 'monthly_revenue_per_store' AS report, COUNT(*) AS rows, CAST(SUM(CAST(total_revenue AS DECIMAL(22,2))) AS DOUBLE) AS total
  FROM ({twins.STORE_TOTALS})
  UNION ALL
  SELECT 'customer_total_spending', COUNT(*), CAST(SUM(CAST(total_spending AS DECIMAL(22,2))) AS DOUBLE) FROM ({twins.SPENDING})) r,
  (VALUES ('csv'), ('xlsx')) f(format)""")
def s9(spark, sf):
    """Both reports exported in both formats and read back."""
    t = tables(spark, sf, "stores", "orders", "customers")
    reps = {"monthly_revenue": reports.store_revenue(t["stores"], t["orders"], ordered=False),
            "customer_spending": reports.customer_spending(t["customers"], t["orders"], ordered=False)}
    schemas = {"monthly_revenue_per_store": REVENUE_SCHEMA, "customer_total_spending": SPENDING_SCHEMA}
    out = []
    for name, folder in export.export_all(reps, scratch_path(spark, "exports")).items():
        report, fmt = name.rsplit(".", 1)
        read = ingest.read_csv if fmt == "csv" else workbook.read_workbooks
        back = read(spark, folder, schemas[report])
        total = [c for c in schemas[report].fieldNames() if c.startswith("total")][0]
        out.append(back.agg(F.lit(report).alias("report"), F.lit(fmt).alias("format"),
                            F.count(F.lit(1)).alias("rows"), F.sum(total).cast("double").alias("total")))
    return reduce(DataFrame.unionByName, out)


@register("M18", with_fixtures("SELECT shipment_id, product_id, quantity FROM shipments", "shipments"))
def m18(spark, sf):
    """CREATE TABLE IF NOT EXISTS: empty at first, a filled table stays as it is."""
    rows = tables(spark, sf, "shipments")["shipments"]
    snaps = table_ops.Snapshots(spark, scratch_path(spark, "snapshots"))
    made = snaps.create_if_absent("shipments", rows.schema)
    snaps.write("shipments", made.unionByName(rows))
    return snaps.create_if_absent("shipments", rows.schema).select("shipment_id", "product_id", "quantity")


@register("M19", with_fixtures("""
SELECT product_id, stock * 2 AS stock FROM products""", "products"))
def m19(spark, sf):
    """A view over a table shows the rows after the table changed."""
    products = tables(spark, sf, "products")["products"]
    snaps = table_ops.Snapshots(spark, scratch_path(spark, "snapshots"))
    snaps.write("products", products)
    snaps.view("products", "live_products")
    snaps.write("products", snaps.read("products").withColumn("stock", F.col("stock") * 2))
    return spark.sql("SELECT product_id, stock FROM live_products")


@register("M19_report", f"""
SELECT store_id, store_name, 2 * CAST(total_revenue AS DOUBLE) AS total_revenue FROM ({twins.STORE_TOTALS})""")
def m19_report(spark, sf):
    """The revenue view over two tables follows a write of one of them: every
    order is booked a second time."""
    t = tables(spark, sf, "stores", "orders")
    snaps = table_ops.Snapshots(spark, scratch_path(spark, "snapshots"))
    for name in t:
        snaps.write(name, t[name])
    snaps.define_view("live_store_revenue", ["stores", "orders"],
                      lambda stores, orders: reports.store_revenue(stores, orders, ordered=False))
    snaps.write("orders", snaps.read("orders").unionByName(t["orders"]))
    return spark.sql("SELECT store_id, store_name, CAST(total_revenue AS DOUBLE) AS total_revenue FROM live_store_revenue")
