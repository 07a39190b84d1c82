import datetime as dt
import io
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from mercantile.schemas import SCHEMAS
from mercantile.session import scratch_path
from mercantile.sources import export, ingest, tables, workbook


def test_workbook_codec_roundtrip():
    buf = io.BytesIO()
    workbook.write_workbook(buf, "Store Revenue", ["a", "b", "c"],
                            [(1, "x & <y>", None), (2, None, dt.date(2001, 8, 1)), (3, "", Decimal("1.50"))])
    header, data = workbook.read_workbook(buf.getvalue())
    assert header == ["a", "b", "c"]
    assert data == [["1", "x & <y>"], ["2", None, "2001-08-01"], ["3", "", "1.50"]]
    assert workbook.column_letters(0) == "A" and workbook.column_letters(27) == "AB"
    assert workbook.column_index("AB12") == 27


def _orders(spark):
    return spark.createDataFrame(
        [(1, 1, 1, dt.date(2001, 1, 1), Decimal("10.00"), "F"), (2, 2, None, dt.date(2001, 1, 2), Decimal("5.00"), "O")],
        SCHEMAS["orders"])


def test_workbook_ingest_all_or_nothing(spark):
    folder = scratch_path(spark, "wb-test")
    good = _orders(spark)
    workbook.write_workbooks(good.coalesce(1), folder, "Orders")
    bad_path = workbook.local_path(folder) + "/bad.xlsx"
    with open(bad_path, "wb") as f:
        workbook.write_workbook(f, "Orders", ["order_id", "customer_id", "order_date", "total_amount"],
                                [(3, 1, "2001-01-03", "1.00"), (4, 1, "not a date", "2.00")])
    with open(workbook.local_path(folder) + "/broken.xlsx", "wb") as f:
        f.write(b"not a zip")
    res = ingest.ingest(spark, folder, "orders", "xlsx")
    assert rows(res.accepted, "order_id") == [(1,), (2,)]
    bad_files = {os.path.basename(r._file): r.first_reason for r in res.bad_files.collect()}
    assert set(bad_files) == {"bad.xlsx", "broken.xlsx"}
    assert "order_date" in bad_files["bad.xlsx"]
    held = {r.order_id: r.reason for r in res.quarantine.collect()}
    assert held[3] == "file has bad rows"


def test_csv_ingest_and_rules(spark):
    folder = workbook.local_path(scratch_path(spark, "csv-test"))
    os.makedirs(folder)
    with open(folder + "/a.csv", "w") as f:
        f.write("order_id,customer_id,store_id,order_date,total_amount,order_status\n"
                "1,1,1,2001-01-01,10.00,F\n2,1,,2001-01-02,5.00,O\n")
    with open(folder + "/b.csv", "w") as f:
        f.write("order_id,customer_id,store_id,order_date,total_amount,order_status\n"
                "3,1,1,2001-01-01,-1.00,F\n4,1,1,2001-01-01,1.00,F\n")
    res = ingest.ingest(spark, folder, "orders", "csv")
    assert rows(res.accepted, "order_id") == [(1,), (2,)]
    assert rows(res.bad_files, "bad_rows") == [(1,)]


def test_export_dispatch(spark):
    df = spark.createDataFrame([(1, "a", Decimal("2.50")), (2, None, Decimal("0.00"))],
                               "customer_id bigint, customer_name string, total_spending decimal(22,2)")
    with pytest.raises(ValueError):
        export.export(df, scratch_path(spark, "x"), "pdf")
    assert export.export(df.where("false"), scratch_path(spark, "x"), "csv") is None
    out = export.export(df, scratch_path(spark, "csv"), "Csv", order_by=["customer_id"])
    back = spark.read.option("header", True).csv(out)
    assert rows(back) == [("1", "a", "2.50"), ("2", None, "0.00")]
    written = export.export_all({"customer_spending": df}, scratch_path(spark, "all"))
    assert set(written) == {"customer_total_spending.csv", "customer_total_spending.xlsx"}
    wb = workbook.read_workbooks(spark, written["customer_total_spending.xlsx"], df.schema)
    assert rows(wb, "customer_id", "customer_name", "total_spending") == rows(df)


def test_append_new_and_append(spark):
    existing = spark.createDataFrame([(1, "old")], "k bigint, v string")
    batch = spark.createDataFrame([(1, "new", 0), (2, "first", 1), (2, "second", 2), (3, "x", 5)],
                                  "k bigint, v string, seq int")
    res = tables.append_new(existing, batch, "k", ["seq"])
    assert rows(res.table) == [(1, "old"), (2, "first"), (3, "x")]
    again = tables.append_new(res.table, batch, "k", ["seq"])
    assert rows(again.table) == rows(res.table)                     # idempotent
    clean = tables.append(existing, spark.createDataFrame([(5, "n")], "k bigint, v string"), "k")
    assert rows(clean.table) == [(1, "old"), (5, "n")] and clean.duplicates.isEmpty()
    dup = tables.append(existing, spark.createDataFrame([(1, "n"), (6, "m")], "k bigint, v string"), "k")
    assert rows(dup.table) == [(1, "old")] and rows(dup.duplicates, "k") == [(1,)]


def test_clustered_layout_pushes_filter(spark):
    df = spark.range(0, 2000).selectExpr("id AS product_id", "concat('p', lpad(cast(id as string), 5, '0')) AS name")
    path = tables.write_clustered(df, scratch_path(spark, "clustered"), ["name"], partitions=4)
    q = spark.read.parquet(path).where(F.col("name") == "p00042")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(name), EqualTo(name,p00042)]" in plan
    assert rows(q, "product_id") == [(42,)]


def test_snapshots(spark):
    snap = tables.Snapshots(spark, scratch_path(spark, "snap"))
    t = snap.create_if_absent("stores", SCHEMAS["stores"])
    assert t.isEmpty()
    v = snap.write("stores", spark.createDataFrame([(1, "a", "l", None)], SCHEMAS["stores"]))
    assert v == 2 and snap.read("stores").count() == 1
    assert snap.create_if_absent("stores", SCHEMAS["stores"]).count() == 1   # kept as is
    snap.view("stores", "live_stores")
    assert spark.sql("SELECT count(*) FROM live_stores").first()[0] == 1


def test_append_new_other_unique_clash_refuses(spark):
    existing = spark.createDataFrame([(1, "a@x")], "k bigint, email string")
    ok = tables.append_new(existing, spark.createDataFrame([(2, "b@x", 0)], "k bigint, email string, seq int"),
                           "k", ["seq"], unique=["email"])
    assert rows(ok.table) == [(1, "a@x"), (2, "b@x")] and ok.conflicts.isEmpty()
    bad = tables.append_new(existing, spark.createDataFrame([(2, "a@x", 0), (3, "c@x", 1)],
                                                            "k bigint, email string, seq int"),
                            "k", ["seq"], unique=["email"])
    assert rows(bad.table) == [(1, "a@x")]
    assert rows(bad.conflicts) == [("email", "a@x", 2)]


def test_load_order_lines_file_by_file(spark):
    folder = scratch_path(spark, "lines-xlsx")
    local = workbook.local_path(folder)
    os.makedirs(local)
    header = ["order_id", "product_id", "quantity", "price", "line_no", "arrival", "order_item_id"]
    files = {"a.xlsx": [(1, 1, 5, "1.00", 1, "2001-01-01"), (1, 2, 1, "1.00", 2, "2001-01-01")],
             "b.xlsx": [(2, 1, 6, "1.00", 1, "2001-01-02")],                  # product 1 would go below 0
             "c.xlsx": [(3, 1, 4, "1.00", 1, "2001-01-03"), (3, 2, 2, "1.00", 2, "2001-01-03")],
             "d.xlsx": [(4, 2, -1, "1.00", 1, "2001-01-04")]}                 # CHECK quantity > 0
    for name, data in files.items():
        with open(f"{local}/{name}", "wb") as f:
            workbook.write_workbook(f, "Lines", header, [(*row, f"{row[0]}{k}") for k, row in enumerate(data)])
    products = spark.createDataFrame([(1, 10), (2, 5)], "product_id bigint, stock int")
    got, adm = ingest.load_order_lines(spark, folder, products)
    verdict = {os.path.basename(r._file): r.accepted for r in adm.loads.collect()}
    assert verdict == {"a.xlsx": True, "b.xlsx": False, "c.xlsx": True}
    assert [os.path.basename(r._file) for r in got.bad_files.collect()] == ["d.xlsx"]
    assert rows(adm.products) == [(1, 1), (2, 2)]


def test_damaged_version_log_is_an_error_not_an_empty_history(spark):
    root = scratch_path(spark, "snap-damaged")
    snap = tables.Snapshots(spark, root)
    three = spark.createDataFrame([(1,), (2,), (3,)], "k bigint")
    assert snap.write("t", three) == 1
    log = workbook.local_path(root) + "/_versions"
    for name in os.listdir(log):
        if name.endswith(".parquet"):
            with open(f"{log}/{name}", "wb") as f:
                f.write(b"damaged")
            crc = f"{log}/.{name}.crc"
            if os.path.exists(crc):
                os.remove(crc)
    with pytest.raises(Exception):
        snap.write("t", three.limit(1))
    assert spark.read.parquet(snap.path("t", 1)).count() == 3


def test_null_keys_are_refused(spark):
    existing = spark.createDataFrame([(1, "a")], "k bigint, v string")
    batch = spark.createDataFrame([(None, "x", 0), (None, "y", 1), (2, "z", 2)], "k bigint, v string, seq int")
    res = tables.append_new(existing, batch, "k", ["seq"])
    assert rows(res.table) == [(1, "a")] and rows(res.conflicts) == [("k", None, 2)]
    plain = tables.append(existing, batch.drop("seq"), "k")
    assert rows(plain.table) == [(1, "a")] and rows(plain.duplicates) == [(None, 2)]


def test_csv_by_header_quotes_defaults_and_order_of_files(spark):
    folder = workbook.local_path(scratch_path(spark, "csv-layouts"))
    os.makedirs(folder)
    files = {
        "a.csv": "payment_method,amount,order_id,payment_id\n\"cash, \"\"big\"\"\",1.50,1,1\n\"two\nlines\",2.00,1,2\n",
        "b.csv": "payment_id,order_id,amount,payment_method,payment_date\n2,1,9.00,x,2001-01-01\n3,1,9.00,x,2001-01-01\n",
        "c.csv": "payment_id,order_id,amount,payment_method,payment_date\n3,1,3.00,x,2001-01-02\n",
        "d.csv": "payment_id,order_id,amount,payment_method,payment_date\n4,1,3.00,x,20240101\n",
        "e.csv": "payment_id,order_id,amount,payment_method,payment_date\n5,1,3.00,x,99999999999\n6,1,3.00,x,7\n",
        "f.csv": "payment_id,order_id,amount,payment_method,place\n7,1,3.00,x,here\n",
        "g.csv": "payment_id,order_id,amount,payment_method\n8,1,3.00,x\n8,1,3.00,y\n",
    }
    for name, text in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    res = ingest.ingest(spark, folder, "payments", "csv", as_of=dt.date(2001, 8, 1))
    got = rows(res.accepted, "payment_id", "payment_method", "payment_date")
    assert got == [(1, 'cash, "big"', dt.date(2001, 8, 1)), (2, "two\nlines", dt.date(2001, 8, 1)),
                   (3, "x", dt.date(2001, 1, 2))]
    why = {os.path.basename(r._file): r.first_reason for r in res.bad_files.collect()}
    assert set(why) == {"b.csv", "d.csv", "e.csv", "f.csv", "g.csv"}
    assert "duplicate" in why["b.csv"] and "unknown" in why["f.csv"] and "payment_date" in why["d.csv"]


def test_workbook_cells_dates_and_control_characters(spark):
    buf = io.BytesIO()
    workbook.write_workbook(buf, "s", ["payment_id", "payment_method", "payment_date"],
                            [(1, "bell\x07 _x0041_", 37104), (2, "plain", "7"), (3, "x", 99999999999)])
    header, data = workbook.read_workbook(buf.getvalue())
    assert data[0][1] == "bell\x07 _x0041_"
    folder = workbook.local_path(scratch_path(spark, "wb-dates"))
    os.makedirs(folder)
    with open(folder + "/a.xlsx", "wb") as f:
        f.write(buf.getvalue())
    back = {r.payment_id: (r.payment_date, r._problem)
            for r in workbook.read_workbooks(spark, folder, SCHEMAS["payments"]).collect()}
    assert back[1] == (dt.date(2001, 8, 1), None)
    assert back[2] == (None, "bad value in payment_date") and back[3] == (None, "bad value in payment_date")


def test_workbook_export_replaces_and_keeps_keys_apart(spark):
    df = spark.range(400).selectExpr("id % 40 AS k", "id AS v")
    folder = scratch_path(spark, "wb-keys")
    for _ in range(2):
        export.export(df, folder, "xlsx", order_by=["v"], partition_by=["k"])
    back = workbook.read_workbooks(spark, folder, df.schema)
    assert rows(back, "k", "v") == rows(df)
    per_file = back.groupBy("_file").agg(F.count_distinct("k").alias("n")).collect()
    assert len(per_file) >= 40 and {r.n for r in per_file} == {1}
    assert not [n for n in os.listdir(workbook.local_path(folder)) if not n.endswith(".xlsx")]


def test_sheet_names_are_not_cut(spark):
    with pytest.raises(ValueError):
        export.export_all({"x" * 32: spark.range(1).toDF("a")}, scratch_path(spark, "names"))


def _csv_rows(n, seed):
    import random
    rng = random.Random(seed)
    words = ["plain", "two words", 'say "hi"', "a,b", "line\nbreak", 'end"', '"', "\n", "x" * 300, "é\U0001F600", 'q"\n"r', ","]
    return [[str(i), rng.choice(words), rng.choice(words) + rng.choice(words), str(i * 7)] for i in range(n)]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_one_csv_file_is_read_by_many_tasks(spark, ending):
    """Quoted line breaks, commas and quotes across block bounds."""
    import csv as csv_module

    from pyspark.sql import types as T

    from mercantile.sources import csv_blocks
    folder = workbook.local_path(scratch_path(spark, "csv-blocks"))
    os.makedirs(folder)
    rows = _csv_rows(3000, len(ending))
    rows[1500][1] = "very\nlong " * 2000  # spans several blocks
    with open(folder + "/big.csv", "w", newline="") as f:
        out = csv_module.writer(f, lineterminator=ending)
        out.writerow(["id", "a", "b", "c"])
        out.writerows(rows)
    with open(folder + "/small.csv", "w", newline="") as f:
        f.write("﻿c,id,a" + ending + '5,1,"x' + ending + 'y"' + ending + ending + 'id,2,3' + ending)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "a", "b", "c")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert csv_blocks.block_states(spark, folder).where("file LIKE '%big.csv'").count() > 20
        assert csv_blocks._lines(spark, folder).rdd.getNumPartitions() > 20
        got = ingest.read_csv(spark, folder, schema)
        big = {tuple(r[:4]) for r in got.where("_file LIKE '%big.csv'").collect()}
        assert got.where("_problem IS NOT NULL").count() == 0
        small = sorted(tuple(r[:4]) for r in got.where("_file LIKE '%small.csv'").collect())
        over = csv_blocks.csv_records(spark, folder, longest=2000)
        assert [r.record[:5] for r in over.where("NOT whole").collect()] == ["1500,"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert big == {tuple(x if x else None for x in r) for r in rows}
    assert small == [("1", "x\ny", None, "5"), ("2", "3", None, "id")]


def test_quotes_at_line_ends():
    from mercantile.sources.csv_blocks import quoted_after
    cases = [("a,b", False, False), ('"a', False, True), ('a"', True, False), ('""', False, False), ('""', True, True),
             ('a,"b""', False, True), ('5" pipe,"x', False, True), ('5" pipe', False, False), ('x","y', True, True),
             ('",', True, False), ('"a"b,"c', False, True)]
    for line, before, after in cases:
        assert quoted_after(line, before) is after, (line, before)


def test_a_write_that_died_is_no_obstacle(spark):
    root = scratch_path(spark, "crashed")
    snap = tables.Snapshots(spark, root)
    snap.write("t", spark.range(3))
    spark.range(9).write.parquet(f"{root}/t/v=2")  # data without its log entry
    again = tables.Snapshots(spark, root)
    assert again.read("t").count() == 3
    assert again.write("t", spark.range(5)) == 2 and snap.read("t").count() == 5


def test_views_follow_writes(spark):
    snap = tables.Snapshots(spark, scratch_path(spark, "views"))
    snap.write("t", spark.range(3))
    snap.write("u", spark.range(2))
    snap.view("t", "follow_t")
    snap.define_view("follow_both", ["t", "u"], lambda t, u: t.join(u, "id"))
    tables.Snapshots(spark, snap.root).write("t", spark.range(1, 9))
    assert spark.sql("SELECT max(id) FROM follow_t").first()[0] == 8
    assert [r.id for r in spark.sql("SELECT id FROM follow_both").collect()] == [1]


def test_a_workbook_is_parsed_in_small_batches():
    """A sheet's rows are never held at once as text cells or as a frame."""
    import tracemalloc

    import pyarrow as pa
    buf = io.BytesIO()
    n = 30_000
    workbook.write_workbook(buf, "s", ["payment_id", "payment_method"], ((i, f"method {i}") for i in range(n)))
    files = pa.RecordBatch.from_pydict({"path": pa.array(["a.xlsx"]), "content": pa.array([buf.getvalue()], pa.binary())})
    seen = 0
    tracemalloc.start()
    try:
        for part in workbook._parse_files(SCHEMAS["payments"])(iter([files])):
            assert 0 < part.num_rows <= 10_000
            assert part.column("payment_id")[0].as_py() == str(seen)
            seen += part.num_rows
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert seen == n
    assert peak < 12e6


def test_a_workbook_that_breaks_off_gives_one_problem_row(spark):
    """Also after several batches of good rows."""
    import zipfile
    buf = io.BytesIO()
    workbook.write_workbook(buf, "s", ["payment_id"], ((i,) for i in range(25_000)))
    folder = workbook.local_path(scratch_path(spark, "wb-late"))
    os.makedirs(folder)
    with zipfile.ZipFile(buf) as old, zipfile.ZipFile(folder + "/late.xlsx", "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            data = old.read(name)
            new.writestr(name, data[:-40] if name.endswith("sheet1.xml") else data)
    with open(folder + "/whole.xlsx", "wb") as f:
        f.write(buf.getvalue())
    back = workbook.read_workbooks(spark, folder, SCHEMAS["payments"])
    late = back.where("_file LIKE '%late.xlsx'").collect()
    assert [(r.payment_id, r._problem) for r in late] == [(None, "unreadable workbook: ParseError")]
    whole = back.where("_file LIKE '%whole.xlsx'").agg(F.count("payment_id"), F.min("_row"), F.max("_row")).first()
    assert tuple(whole) == (25_000, 2, 25_001)


def test_shared_strings_of_a_workbook():
    import zipfile
    ns = f'xmlns="{workbook.MAIN_NS}"'
    cells = "".join(f'<row r="{i + 1}"><c r="A{i + 1}" t="s"><v>{i}</v></c></row>' for i in range(9000))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/_rels/workbook.xml.rels", workbook.WORKBOOK_RELS)
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{workbook.REL_NS}"><sheets>'
                                      '<sheet name="s" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{cells}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(
            f"<si><r><t>w{i}</t></r><r><t> _x0041_</t></r></si>" for i in range(9000)) + "</sst>")
    assert list(workbook.sheet_rows(io.BytesIO(buf.getvalue()))) == [[f"w{i} A"] for i in range(9000)]


def test_rows_of_a_large_file_stay_in_many_tasks(spark):
    """Few files with many rows: nothing but a file's verdict is joined by file,
    and claims by file are made only for values that come again."""
    folder = workbook.local_path(scratch_path(spark, "few-files"))
    os.makedirs(folder)
    head = "order_id,customer_id,store_id,order_date,total_amount,order_status\n"
    ids = {"a": range(0, 300), "b": range(200, 500), "c": range(400, 700), "d": [*range(700, 800), 700]}
    for name, keys in ids.items():  # a keeps b out, so c may come in; d repeats its own key
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(head + "".join(f"{k},1,1,2001-01-01,1.00,F\n" for k in keys))
    res = ingest.ingest(spark, folder, "orders", "csv")
    for df in (res.accepted, res.quarantine):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [_file" not in plan and "BroadcastHashJoin [_file" in plan
    assert rows(res.accepted, "order_id") == [(k,) for k in [*ids["a"], *ids["c"]]]
    why = {os.path.basename(r._file): (r.bad_rows, r.first_reason) for r in res.bad_files.collect()}
    assert why == {"b.csv": (1, "duplicate(order_id)"), "d.csv": (1, "duplicate(order_id)")}
    old = spark.range(650, 651).withColumnRenamed("id", "order_id")
    res = ingest.ingest(spark, folder, "orders", "csv", existing=old)
    assert rows(res.accepted, "order_id") == [(k,) for k in ids["a"]]
