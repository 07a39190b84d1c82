import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows
from mercantile.functions.keys import dense_keys, running_total
from mercantile.operators import admission


def test_dense_keys_contiguous_in_order(spark):
    df = spark.range(0, 5000).selectExpr("id * 7 % 5000 AS k", "id AS v")
    out = dense_keys(df, ["k"], start=100, out="key", partitions=7)
    got = [(r.k, r.key) for r in out.orderBy("k").collect()]
    assert [key for _, key in got] == list(range(101, 5101))


def test_running_total_hot_group_matches_pandas(spark):
    data = [(0 if i % 3 else (i % 7), i, (i * 13) % 11 + 1) for i in range(3000)]  # group 0 is hot
    df = spark.createDataFrame(data, "g int, o int, v int")
    out = running_total(df, ["g"], ["o"], "v", "cum", partitions=6)
    got = {(r.g, r.o): r.cum for r in out.collect()}
    cum: dict[int, int] = {}
    for g, o, v in sorted(data, key=lambda x: (x[0], x[1])):
        cum[g] = cum.get(g, 0) + v
        assert got[(g, o)] == cum[g]


def _brute(lines, stock):
    left = dict(stock)
    ok = {}
    for ln in sorted(lines, key=lambda x: (x[3], x[0], x[1])):
        oid, no, pid, arrival, q = ln
        if q is None or q <= 0 or pid not in left:
            ok[(oid, no)] = False
        elif left[pid] is None or q <= left[pid]:
            ok[(oid, no)] = True
            if left[pid] is not None:
                left[pid] -= q
        else:
            ok[(oid, no)] = False
    return ok, left


def _items(spark, n=4000, seed=7):
    rnd = random.Random(seed)
    lines = []
    for i in range(n):
        pid = 1 if rnd.random() < 0.4 else rnd.randint(2, 30)           # product 1 is hot
        q = rnd.choice([1, 2, 3, 5, 8, 13, 40])
        lines.append((i, 1, pid, dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 500)), q))
    lines += [(n + 1, 1, 2, dt.date(2000, 1, 1), None), (n + 2, 1, 3, dt.date(2000, 1, 1), 0),
              (n + 3, 1, 999, dt.date(2000, 1, 1), 1)]
    stock = {p: rnd.randint(0, 400) for p in range(1, 31)}
    stock[1] = 900
    stock[30] = None
    items = spark.createDataFrame(lines, "order_id bigint, line_no int, product_id bigint, arrival date, quantity int")
    items = items.withColumn("price", F.lit(1).cast("decimal(12,2)"))
    products = spark.createDataFrame(list(stock.items()), "product_id bigint, stock int")
    return lines, stock, items, products


def test_greedy_rounds_match_bruteforce(spark):
    lines, stock, items, products = _items(spark)
    want, left = _brute(lines, stock)
    res = admission.admit(items, products, mode="greedy")
    got = {(r.order_id, r.line_no): True for r in res.accepted.collect()}
    got.update({(r.order_id, r.line_no): False for r in res.refused.collect()})
    assert got == want
    assert dict(rows(res.products)) == left
    assert all(v is None or v >= 0 for v in dict(rows(res.products)).values())


def test_greedy_needs_few_rounds_for_a_hot_product(spark, monkeypatch):
    """Half of the lines on one product, in the order that would settle two
    lines a round (1, 100, 1, 99, ...): rounds stay below log2(stock) + 2."""
    lines, stock = [], {1: 5000, 2: 700}
    for i in range(1500):
        q = 1 if i % 2 == 0 else 4800 - 3 * i if i < 1000 else 1 + i % 300
        lines.append((i, 1, 1, dt.date(2000, 1, 1), q))
        lines.append((i, 2, 2 + i % 9, dt.date(2000, 1, 1), 1 + i % 40))
    stock |= {p: 50 * p for p in range(3, 11)}
    items = spark.createDataFrame(lines, "order_id bigint, line_no int, product_id bigint, arrival date, quantity int")
    items = items.withColumn("price", F.lit(1).cast("decimal(12,2)"))
    products = spark.createDataFrame(list(stock.items()), "product_id bigint, stock int")
    rounds, settle = [], admission._settle
    monkeypatch.setattr(admission, "_settle", lambda *a: (rounds.append(1), settle(*a))[1])
    res = admission.admit(items, products)
    want, left = _brute(lines, stock)
    assert {(r.order_id, r.line_no) for r in res.accepted.collect()} == {k for k, v in want.items() if v}
    assert dict(rows(res.products)) == left
    assert len(rounds) <= (5000).bit_length() + 1


def test_levels_match_a_fold_on_random_cases(spark):
    """Many small products at once: every product is one random case."""
    rnd = random.Random(11)
    lines, stock = [], {}
    for p in range(3000):
        top = rnd.choice([2, 5, 17, 64, 200])
        stock[p] = rnd.randint(0, 3 * top)
        lines += [(p, n, p, dt.date(2000, 1, 1), rnd.randint(1, top)) for n in range(rnd.randint(1, 14))]
    items = spark.createDataFrame(lines, "order_id bigint, line_no int, product_id bigint, arrival date, quantity int")
    items = items.withColumn("price", F.lit(1).cast("decimal(12,2)"))
    products = spark.createDataFrame(list(stock.items()), "product_id bigint, stock int")
    want, left = _brute(lines, stock)
    res = admission.admit(items, products)
    assert {(r.order_id, r.line_no) for r in res.accepted.collect()} == {k for k, v in want.items() if v}
    assert dict(rows(res.products)) == left


def test_atomic_all_or_nothing(spark):
    lines, stock, items, products = _items(spark, n=300)
    res = admission.admit(items, products, mode="atomic")
    assert res.accepted.isEmpty()
    assert dict(rows(res.products)) == stock
    small = items.where("quantity = 1 AND product_id BETWEEN 2 AND 29")
    ok = admission.admit(small, products.withColumn("stock", F.lit(10**6)), mode="atomic")
    assert ok.refused.isEmpty() and ok.accepted.count() == small.count()
    # atomic acceptance implies greedy accepts every line
    g = admission.admit(small, products.withColumn("stock", F.lit(10**6)), mode="greedy")
    assert g.refused.isEmpty()


def _brute_loads(lines, stock):
    """Loads in order; a load passes only if all lines are valid and every
    product's load total fits what is left."""
    left = dict(stock)
    verdict = {}
    for lid in sorted({ln[0] for ln in lines}):
        rows = [ln for ln in lines if ln[0] == lid]
        if any(q is None or q <= 0 or p not in left for _, p, q in rows):
            verdict[lid] = False
            continue
        need = {}
        for _, p, q in rows:
            need[p] = need.get(p, 0) + q
        if all(left[p] is None or d <= left[p] for p, d in need.items()):
            for p, d in need.items():
                if left[p] is not None:
                    left[p] -= d
            verdict[lid] = True
        else:
            verdict[lid] = False
    return verdict, left


def test_admit_loads_matches_bruteforce(spark):
    rnd = random.Random(5)
    lines = []
    for lid in range(60):
        for _ in range(rnd.randint(1, 6)):
            pid = 1 if rnd.random() < 0.5 else rnd.randint(2, 8)       # product 1 is hot
            lines.append((lid, pid, rnd.choice([1, 2, 3, 5, 8])))
    lines += [(60, 2, None), (61, 99, 1), (62, 3, 0)]
    stock = {1: 60, 2: 20, 3: 15, 4: 9, 5: 0, 6: 30, 7: None, 8: 12}
    items = spark.createDataFrame([(lid, i, p, q) for i, (lid, p, q) in enumerate(lines)],
                                  "load bigint, line bigint, product_id bigint, quantity int")
    products = spark.createDataFrame(list(stock.items()), "product_id bigint, stock int")
    want, left = _brute_loads(lines, stock)
    res = admission.admit_loads(items, products, "load")
    got = {r.load: r.accepted for r in res.loads.collect()}
    assert got == want
    assert dict(rows(res.products)) == left
    assert res.accepted.count() + res.refused.count() == len(lines)
