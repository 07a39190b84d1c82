from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from mercantile.operators import joins


def _co(spark):
    customers = spark.createDataFrame(
        [(0, "Zero"), (1, "One"), (2, "Two")], "customer_id bigint, name string")
    orders = spark.createDataFrame(
        [(10, 0, "2001-01-01", Decimal("5.00")), (11, 0, "2001-01-02", Decimal("0.00")),
         (12, None, "2001-01-03", Decimal("7.50")), (13, 9, "2001-01-04", Decimal("1.25"))],
        "order_id bigint, customer_id bigint, order_date string, total_amount decimal(12,2)",
    ).withColumn("order_date", F.to_date("order_date"))
    return customers, orders


def test_outer_joins_match_sql(spark):
    customers, orders = _co(spark)
    customers.createOrReplaceTempView("tc")
    orders.createOrReplaceTempView("tor")
    for how, kw in [("inner", "INNER"), ("left", "LEFT"), ("right", "RIGHT"), ("full", "FULL")]:
        ours = joins.customer_orders_join(customers, orders, how)
        ref = spark.sql(f"""SELECT c.customer_id, c.name AS customer_name, o.order_id, o.order_date,
                                   o.total_amount FROM tc c {kw} JOIN tor o ON c.customer_id = o.customer_id""")
        assert rows(ours) == rows(ref), how
    assert len(rows(joins.customer_orders_join(customers, orders, "full"))) == 6


def test_full_join_order_and_placeholders(spark):
    customers, orders = _co(spark)
    out = joins.customer_orders_join(customers, orders, "full", display=True).collect()
    ids = [r.customer_id for r in out]
    assert ids[-2:] == [None, None]            # NULLs last
    zero = [r for r in out if r.customer_id == 0]
    assert all(r.customer_id_text == "0" for r in zero)      # key 0 is a value
    assert {r.total_amount_text for r in zero} == {"5.00", "0.00"}
    lonely = [r for r in out if r.customer_id == 2][0]
    assert (lonely.order_id_text, lonely.order_date_text, lonely.total_amount_text) == ("No Order", "N/A", "0.00")
    orphan = [r for r in out if r.order_id == 12][0]
    assert (orphan.customer_id_text, orphan.customer_name_text) == ("No Customer", "N/A")


def test_not_in_null_rules(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    empty = spark.createDataFrame([], "k bigint")
    assert rows(joins.not_in(df, "k", empty)) == [(None,), (1,), (2,)]
    assert rows(joins.not_in(df, "k", spark.createDataFrame([(1,)], "k bigint"))) == [(2,)]
    with_null = spark.createDataFrame([(1,), (None,)], "k bigint")
    assert rows(joins.not_in(df, "k", with_null)) == []
    df.createOrReplaceTempView("ni_df")
    for sub in (empty, with_null, spark.createDataFrame([(3,)], "k bigint")):
        sub.createOrReplaceTempView("ni_sub")
        ref = spark.sql("SELECT k FROM ni_df WHERE k NOT IN (SELECT k FROM ni_sub)")
        assert rows(joins.not_in(df, "k", sub)) == rows(ref)


def test_same_manager_peers_counts_pairs(spark):
    emp = spark.createDataFrame(
        [(1, "a", None), (2, "b", 1), (3, "c", 1), (4, "d", 1), (5, "e", 2), (6, "f", None)],
        "employee_id bigint, name string, manager_id bigint")
    emp.createOrReplaceTempView("peers_emp")
    brute = spark.sql("""SELECT e1.employee_id, COUNT(*) AS n FROM peers_emp e1 JOIN peers_emp e2
                         ON e1.manager_id = e2.manager_id WHERE e1.employee_id != e2.employee_id
                         GROUP BY e1.employee_id""")
    ours = joins.same_manager_peers(emp).select("employee_id", "peer_count")
    assert rows(ours) == rows(brute) == [(2, 2), (3, 2), (4, 2)]
    assert rows(joins.manager_pair_counts(emp)) == [(1, 3, 6)]


def test_hot_customer_is_split_by_aqe(spark):
    """One customer owns most orders: the right join keeps orders as the
    streamed side, so AQE's skew split applies."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        customers = spark.range(0, 200).selectExpr("id AS customer_id", "concat('c', id) AS name")
        orders = spark.range(0, 20000).selectExpr(
            "id AS order_id", "CASE WHEN id % 10 < 8 THEN 7 ELSE id % 200 END AS customer_id",
            "current_date() AS order_date", "CAST(1 AS DECIMAL(12,2)) AS total_amount")
        out = joins.customer_orders_join(customers, orders, "right", ordered=False)
        assert len(out.collect()) == 20000
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_customer_is_split_in_the_sorted_join(spark):
    """80% of the orders belong to one customer: the final sort spreads them."""
    orders = spark.range(20_000).selectExpr(
        "id AS order_id", "CASE WHEN id % 5 < 4 THEN 7 ELSE id % 100 END AS customer_id",
        "DATE '2001-01-01' AS order_date", "CAST(1 AS DECIMAL(12,2)) AS total_amount")
    customers = spark.range(100).selectExpr("id AS customer_id", "concat('c', id) AS name")
    def count_rows(batches):
        import pyarrow as pa
        yield pa.RecordBatch.from_pydict({"n": [sum(b.num_rows for b in batches)]})

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for how in ("inner", "left"):
            out = joins.customer_orders_join(customers, orders, how)
            parts = out.mapInArrow(count_rows, "n long").collect()
            assert max(r.n for r in parts) < 0.5 * out.count()  # one key holds 80%
            got = [(r.customer_id, r.order_id or -1) for r in out.collect()]
            assert got == sorted(got)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

