"""Bitmaps of key sets: no key is lost, few other rows pass, and a cascade
shuffles only the rows that pass."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from mercantile.functions import keybits
from mercantile.operators import changes

LONG = st.one_of(st.none(), st.integers(-5, 40), st.integers(-(1 << 63), (1 << 63) - 1))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LONG, max_size=25), st.lists(LONG, max_size=25))
def test_rows_of_a_key_always_pass(spark, keys, held):
    k = spark.createDataFrame([(x,) for x in keys], "k bigint")
    df = spark.createDataFrame([(x, i) for i, x in enumerate(held)], "c bigint, n int")
    clear, rest = keybits.split(df, [("c", keybits.key_bits(k, "k"))])
    known = {x for x in keys if x is not None}
    assert not {r.c for r in clear.collect()} & known
    assert sorted(r.n for r in clear.unionByName(rest).collect()) == list(range(len(held)))


def test_widths_and_texts_agree_and_few_others_pass(spark):
    keys = spark.range(0, 2_000_000, 1000).select(F.col("id").alias("k"))
    bits = keybits.key_bits(keys, "k")
    df = spark.range(2_000_000).select(F.col("id").cast("int").alias("c"), F.lit("x").alias("k"))
    clear, rest = keybits.split(df, [("c", bits)])
    assert rest.where("c % 1000 = 0").count() == 2000
    assert rest.count() < 2000 + 2_000_000 // keybits.PER_KEY * 2 and clear.columns == ["c", "k"]
    text = spark.createDataFrame([("a",), ("é",), (None,)], "t string")
    _, rest = keybits.split(text, [("t", keybits.key_bits(text.where("t = 'é'"), "t"))])
    assert rows(rest) == [("é",)]


def _shuffled(df):
    """Rows that the stages right under the result wrote to exchanges."""
    out = df.collect()
    top = df._jdf.queryExecution().executedPlan().executedPlan()
    if top.getClass().getSimpleName() == "ResultQueryStageExec":
        top = top.plan()
    leaves = top.collectLeaves()
    stages = [leaves.apply(i) for i in range(leaves.size())]
    stages = [s for s in stages if s.getClass().getSimpleName() == "ShuffleQueryStageExec"]
    return out, sum(s.plan().metrics().apply("shuffleRecordsWritten").value() for s in stages)


def test_a_cascade_moves_only_rows_of_deleted_keys(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        customers = spark.range(1000).selectExpr("id AS customer_id", "'n' AS name")
        orders = spark.range(50_000).selectExpr("id AS order_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS customer_id",
                                                "CAST(1 AS DECIMAL(10,2)) AS total_amount")
        orders = orders.checkpoint()
        gone = spark.createDataFrame([(8,), (9,), (None,)], "customer_id bigint")
        out = changes.delete_rows({"customers": customers, "orders": orders}, "customers", gone)
        left, moved = _shuffled(out.tables["orders"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = orders.where("customer_id NOT IN (8, 9)").count()
    hit = 50_000 - want
    assert len(left) == want and left[0].total_amount == Decimal("1.00")
    assert hit <= moved <= hit + 100  # the keys themselves included
    counts = {r.table_name: (r.rows_before, r.rows_deleted, r.rows_after) for r in out.counts.collect()}
    assert counts["orders"] == (50_000, hit, want) and counts["customers"] == (1000, 2, 998)
