import datetime as dt
import random
from decimal import Decimal

from conftest import rows
from mercantile.operators import hierarchy, pivot, setops


def test_hierarchy_levels_and_cycle(spark):
    emp = spark.createDataFrame(
        [(1, "root", "Manager", None), (2, "b", "Clerk", 1), (3, "c", "Clerk", 2),
         (4, "x", "Clerk", 5), (5, "y", "Clerk", 4), (6, "z", "Clerk", 4), (7, "r2", "Manager", None)],
        "employee_id bigint, name string, role string, manager_id bigint")
    h = hierarchy.hierarchy(emp)
    assert [(r.employee_id, r.level) for r in h.levels.collect()] == [(1, 0), (7, 0), (2, 1), (3, 2)]
    assert sorted(r.employee_id for r in h.unreachable.collect()) == [4, 5, 6]
    lines = {r.employee_id: r.line for r in hierarchy.indent_lines(h.levels).collect()}
    assert lines[3] == "    Level 2: Employee ID: 3, Name: c, Role: Clerk, Manager ID: 2"
    assert lines[1].endswith("Manager ID: None")


def test_hierarchy_matches_recursive_sql(spark):
    emp = spark.range(0, 400).selectExpr(
        "id AS employee_id", "concat('e', id) AS name", "'r' AS role",
        "CASE WHEN id < 3 THEN NULL ELSE CAST(floor((id - 3) / 3) AS BIGINT) END AS manager_id")
    emp.createOrReplaceTempView("h_emp")
    ref = spark.sql("""WITH RECURSIVE eh AS (
        SELECT employee_id, name, role, manager_id, 0 AS level FROM h_emp WHERE manager_id IS NULL
        UNION ALL SELECT e.employee_id, e.name, e.role, e.manager_id, eh.level + 1
        FROM h_emp e JOIN eh ON e.manager_id = eh.employee_id) SELECT * FROM eh""")
    assert rows(hierarchy.hierarchy(emp).levels) == rows(ref)


def test_pivot_correct_labels_sum_and_last(spark):
    ms = spark.createDataFrame(
        [(1, "Jan", Decimal("5000.00"), 1), (1, "Feb", Decimal("7000.00"), 2), (1, "Mar", Decimal("8000.00"), 3),
         (2, "Jan", Decimal("6000.00"), 4), (2, "Feb", Decimal("7500.00"), 5), (2, "Jan", Decimal("1.00"), 6)],
        "store_id int, month string, total_sales decimal(10,2), seq int")
    out = {r.store_id: r for r in pivot.pivot_months(ms, ["Jan", "Feb", "Mar"]).collect()}
    assert (out[1].Jan, out[1].Feb, out[1].Mar) == (Decimal("5000.00"), Decimal("7000.00"), Decimal("8000.00"))
    assert (out[2].Jan, out[2].Mar) == (Decimal("6001.00"), None)
    last = {r.store_id: r for r in pivot.pivot_months(ms, ["Jan", "Feb", "Mar"], agg="last", order="seq").collect()}
    assert last[2].Jan == Decimal("1.00")
    text = {r.store_id: r for r in pivot.pivot_to_text(pivot.pivot_months(ms, ["Jan", "Feb", "Mar"]),
                                                       ["Jan", "Feb", "Mar"]).collect()}
    assert text[2].Mar == "0.00" and text[1].Jan == "5000.00"


def test_union_and_union_all(spark):
    c = spark.createDataFrame([("Ann",), ("Bob",), ("Ann",)], "name string")
    e = spark.createDataFrame([("Ann",), ("Cid",)], "name string")
    assert rows(setops.people_list(c, e)) == [("Ann", "Customer"), ("Ann", "Employee"),
                                             ("Bob", "Customer"), ("Cid", "Employee")]
    o = spark.createDataFrame([(1, dt.date(2000, 1, 1)), (2, dt.date(2001, 7, 1)), (3, dt.date(2000, 8, 1))],
                              "order_id bigint, order_date date")
    got = rows(setops.order_status_list(o, dt.date(2001, 8, 1)), "order_id", "order_status")
    assert got == [(1, "Active"), (1, "Inactive"), (2, "Active"), (3, "Active")]


def test_doubling_equals_levels_with_cycles_and_dangling(spark):
    import random
    rnd = random.Random(3)
    data = []
    for i in range(1, 600):
        if i < 4:
            mgr = None
        elif i < 550:
            mgr = rnd.randint(1, i - 1)          # forest, depth grows
        elif i < 560:
            mgr = i + 1 if i < 559 else 550       # a ten-node cycle
        elif i < 580:
            mgr = rnd.randint(550, i - 1)         # hanging below the cycle
        else:
            mgr = 10_000 + i                      # manager missing
        data.append((i, f"e{i}", "r", mgr))
    chain = [(1000 + k, f"c{k}", "r", None if k == 0 else 1000 + k - 1) for k in range(70)]  # deep chain
    emp = spark.createDataFrame(data + chain, "employee_id bigint, name string, role string, manager_id bigint")
    db = hierarchy.hierarchy(emp)
    boss = {r[0]: r[3] for r in data + chain}
    want = {}
    for e in boss:
        at, hops = e, 0
        while at is not None and at in boss and hops < 100:
            at, hops = boss[at], hops + 1
        if at is None:
            want[e] = hops - 1
    assert {r.employee_id: r.level for r in db.levels.collect()} == want
    short = hierarchy.hierarchy(emp, max_depth=2)
    assert {r.employee_id for r in short.levels.collect()} == {e for e, v in want.items() if v <= 2}
    assert rows(short.unreachable) == rows(db.unreachable)
    assert len(rows(db.unreachable)) == 50   # 10 on the cycle, 20 below it, 20 under missing managers
    assert max(r.level for r in db.levels.collect()) == 69


def test_years_before_leap_day_and_default(spark):
    from pyspark.sql import functions as F
    from mercantile.functions.scalar import month_number, years_before
    r = spark.range(1).select(years_before(dt.date(2004, 2, 29), 1).alias("a"),
                              years_before(None, 1).alias("b"),
                              F.add_months(F.current_date(), -12).alias("c")).first()
    assert r.a == dt.date(2003, 2, 28) and r.b == r.c
    assert month_number("jan") == 1 and month_number("DEC") == 12


def _follow(bosses):
    """Brute force of why_unreachable: walk up from every employee."""
    out = {}
    for who in bosses:
        path, at = [], who
        while at in bosses and at not in path:
            path.append(at)
            at = bosses[at]
        if at is None:
            continue
        if at not in bosses:
            out[who] = ("below a missing manager", at)
        else:
            loop = path[path.index(at):]
            out[who] = ("on a cycle" if who in loop else "below a cycle", min(loop))
    return out


def test_why_unreachable_names_the_cycle_or_the_missing_manager(spark):
    rnd = random.Random(7)
    graphs = [{i: (None if i == 0 else rnd.randrange(0, 60)) for i in range(45)},
              {i: (i + 1) % 37 for i in range(37)} | {100 + i: 99 + i for i in range(40)},  # a long loop, a long tail
              {1: 1, 2: 1, 3: 2, 4: 9, 5: 4, 6: None}, {1: None}, {5: 6, 6: 5, 7: 8, 8: 7, 9: 6}]
    for bosses in graphs:
        emp = spark.createDataFrame([(i, f"e{i}", "r", m) for i, m in bosses.items()],
                                    "employee_id bigint, name string, role string, manager_id bigint")
        got = hierarchy.why_unreachable(hierarchy.hierarchy(emp).unreachable)
        assert {r.employee_id: (r.reason, r.cause) for r in got.collect()} == _follow(bosses)
        assert got.columns == ["employee_id", "name", "role", "manager_id", "reason", "cause"]
