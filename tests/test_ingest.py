"""CSV reading, dates, quarantine, upsert, and the ingest job."""

import datetime
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tallyloom import jobs
from tallyloom.functions.dates import parse_date
from tallyloom.operators import upsert
from tallyloom.schemas import TABLES
from tallyloom.sources import csv_files, warehouse

HEADERS = {
    "customers": "customer_id,customer_name,email,phone number,city,country",
    "products": "product_id,product_name,category,price",
    "orders": "order_id,customer_id,order_date,status",
    "order_items": "item_id,order_id,product_id,quantity,price",
    "payments": "payment_id,amount,order_id,payment_method,payment_date",
}
GOOD = {
    "customers": "1,Ann,ann@example.com,555,Oslo,Norway\n",
    "products": "1,lamp,Home & Kitchen,19.99\n",
    "orders": "1,1,01/02/2020,shipped\n",
    "order_items": "1,1,1,2,19.99\n",
    "payments": "1,39.98,1,Card,01/05/2020\n",
}


def put(folder, name, body, header=None):
    folder.mkdir(exist_ok=True)
    path = folder / f"{name}.csv"
    path.write_text((header or HEADERS[name]) + "\n" + body, encoding="utf-8")
    return str(path)


def put_all(folder, **bodies):
    for name, body in {**GOOD, **bodies}.items():
        put(folder, name, body)
    return str(folder)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("01/02/2020", datetime.date(2020, 1, 2)),
        ("1/2/2020", datetime.date(2020, 1, 2)),
        ("2020-01-02", datetime.date(2020, 1, 2)),
        ("2020-1-2", datetime.date(2020, 1, 2)),
        ("02/29/2020", datetime.date(2020, 2, 29)),
        ("02/29/2021", None),
        ("13/40/2020", None),
        ("001/02/2020", None),
        ("1/2/20", None),
        ("2020/01/02", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(parse_date(F.col("t"))).first()[0] == expected


def test_every_table_reads_with_its_types(spark, tmp_path):
    root = put_all(tmp_path / "in")
    for name, table in TABLES.items():
        frame = csv_files.read_table(spark, name, f"{root}/{name}.csv")
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in table.schema]
        assert frame.count() == 1
    customer = csv_files.read_customers(spark, f"{root}/customers.csv").first()
    assert customer.phone_number == "555"
    payment = csv_files.read_payments(spark, f"{root}/payments.csv").first()
    assert (payment.amount, payment.payment_date) == (Decimal("39.98"), datetime.date(2020, 1, 5))


def test_quotes_commas_breaks_and_non_ascii(spark, tmp_path):
    body = '1,"Ann, the ""first""",a@example.com,,"Two\nlines",Åland\n'
    row = csv_files.read_customers(spark, put(tmp_path, "customers", body)).first()
    assert row.customer_name == 'Ann, the "first"'
    assert (row.city, row.country, row.phone_number) == ("Two\nlines", "Åland", None)


def test_columns_go_by_header_name(spark, tmp_path):
    path = put(tmp_path, "products", "9.50,Toys,7,extra,puzzle\n", "price,category,product_id,note,product_name")
    assert csv_files.read_products(spark, path).first().asDict() == {
        "product_id": 7,
        "product_name": "puzzle",
        "category": "Toys",
        "price": Decimal("9.50"),
    }


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_with_other_column_order_are_not_misread(spark, tmp_path, multi_line):
    """One folder takes its columns from one header; a file that differs fails instead of shifting."""
    folder = tmp_path / "products.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("product_id,product_name,category,price\n1,lamp,Toys,2.00\n")
    (folder / "b.csv").write_text("price,category,product_name,product_id\n3.00,Toys,desk,2\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="[ab].csv"):
        csv_files.read_products(spark, str(folder), multi_line).collect()


def test_missing_column_fails(spark, tmp_path):
    with pytest.raises(AnalysisException):
        csv_files.read_products(spark, put(tmp_path, "products", "1,x\n", "product_id,product_name"))


@pytest.mark.parametrize("multi_line", [True, False])
def test_short_and_surplus_rows_are_faults(spark, tmp_path, multi_line):
    bodies = ["1,Ann,a@example.com", "2,Bo,b@example.com,5,Oslo,Norway,surplus"]
    path = put(tmp_path, "customers", "\n".join([*bodies, "3,Cy,c@example.com,,,"]) + "\n")
    raw = csv_files.read_raw(spark, TABLES["customers"], path, multi_line)
    good, bad = csv_files.split_quarantine(raw, TABLES["customers"])
    assert [r.customer_id for r in good.collect()] == [3]
    assert sorted(r.reason for r in bad.collect()) == [f"wrong number of fields: {b}" for b in bodies]
    with pytest.raises(PySparkException, match="wrong number of fields"):
        csv_files.read_customers(spark, path, multi_line).collect()


def test_line_breaks_are_kept_when_files_are_to_be_split(spark, tmp_path):
    body = '1,Ann,a@x,1,"New\nYork",US\n2,Bo,b@x,2,Oslo,"Nor\nway"\n'
    path = put(tmp_path, "customers", body)
    for multi_line in (True, False, None):
        found = {r.customer_id: (r.city, r.country) for r in csv_files.read_customers(spark, path, multi_line).collect()}
        assert found == {1: ("New\nYork", "US"), 2: ("Oslo", "Nor\nway")}


def test_no_price_differs_from_its_text(spark, tmp_path):
    prices = ["10.129", "0.000001", "10.1290001", "7", "1e-3", "999999999999.999999", "1000000000000", "0.00000000000000000001"]
    body = "".join(f"{n},x,Toys,{p}\n" for n, p in enumerate(prices))
    raw = csv_files.read_raw(spark, TABLES["products"], put(tmp_path, "products", body))
    good, bad = csv_files.split_quarantine(raw, TABLES["products"])
    assert {r.product_id: r.price for r in good.collect()} == {n: Decimal(prices[n]) for n in (0, 1, 3, 4, 5)}
    assert {r.product_id for r in bad.collect()} == {"2", "6", "7"}


@pytest.mark.parametrize(
    ("name", "body", "reason"),
    [
        ("orders", "x,1,01/02/2020,shipped\n", "order_id: bad value x"),
        ("orders", "5.0,1,01/02/2020,shipped\n", "order_id: bad value 5.0"),
        ("orders", "1,,01/02/2020,shipped\n", "customer_id: missing"),
        ("orders", "1,1,13/40/2020,shipped\n", "order_date: bad value 13/40/2020"),
        ("orders", "1,1,,shipped\n", "order_date: missing"),
        ("products", "1,lamp,Toys,nan\n", "price: bad value nan"),
        ("products", "1,lamp,Toys,\n", "price: missing"),
        ("customers", "1,,a@example.com,,,\n", "customer_name: missing"),
    ],
)
def test_bad_rows_fail_or_are_set_aside(spark, tmp_path, name, body, reason):
    path = put(tmp_path, name, body + GOOD[name].replace("1,", "8,", 1))
    with pytest.raises(PySparkException, match=reason.split(":")[0]):
        csv_files.read_table(spark, name, path).collect()
    raw = csv_files.read_raw(spark, TABLES[name], path)
    good, bad = csv_files.split_quarantine(raw, TABLES[name])
    assert [r[0] for r in good.collect()] == [8]
    assert [r.reason for r in bad.collect()] == [reason]


def test_strict_read_fails_without_ansi_too(spark, tmp_path):
    path = put(tmp_path, "orders", "x,1,01/02/2020,shipped\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException):
            csv_files.read_orders(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_strict_read_fails_whichever_column_is_used(spark, tmp_path):
    path = put(tmp_path, "products", "1,lamp,Toys,x\n2,desk,Toys,1.00\n")
    with pytest.raises(PySparkException, match="products: price: bad value x"):
        csv_files.read_products(spark, path).agg(F.sum("price")).collect()


def test_csv_round_trip(spark, tmp_path):
    source = csv_files.read_table(spark, "customers", put(tmp_path, "customers", '1,"A ""b"", c",e,+1,"x\ny",Z\n'))
    out = str(tmp_path / "out.csv")
    csv_files.write_table(source, "customers", out)
    assert "phone number" in spark.read.csv(out, header=True).columns
    assert csv_files.read_customers(spark, out).collect() == source.collect()


def test_latest_by_key_prefers_the_last_row(spark):
    data = [(1, 1, "old"), (1, 2, "new"), (2, 1, "only"), (3, 5, "a"), (3, 4, "b")]
    frame = spark.createDataFrame(data, "k int, n int, v string")
    found = upsert.latest_by_key(frame, ["k"], ["n"])
    assert {r.k: r.v for r in found.collect()} == {1: "new", 2: "only", 3: "a"}


def test_upsert_replaces_and_keeps(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([("x", 2, 1), ("c", 2, 2), ("d", 3, 3)], "v string, k int, n int")
    merged = upsert.upsert_latest_by_key(existing, batch, ["k"], ["n"])
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_ingest_last_row_wins_and_absent_rows_stay(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    first = put_all(tmp_path / "one", products="1,lamp,Toys,1.00\n2,chair,Toys,2.00\n1,lamp two,Toys,3.00\n")
    assert jobs.ingest(spark, first, root) == {
        "customers": 1, "products": 3, "orders": 1, "order_items": 1, "payments": 1,
    }
    products = {r.product_id: r.product_name for r in warehouse.read(spark, root, "products").collect()}
    assert products == {1: "lamp two", 2: "chair"}

    second = put_all(tmp_path / "two", products="2,stool,Toys,9.00\n3,desk,Toys,5.00\n2,bench,Toys,8.00\n")
    assert jobs.ingest(spark, second, root)["products"] == 3
    products = {r.product_id: (r.product_name, r.price) for r in warehouse.read(spark, root, "products").collect()}
    assert products == {1: ("lamp two", Decimal("3.00")), 2: ("bench", Decimal("8.00")), 3: ("desk", Decimal("5.00"))}
    assert warehouse.last_load(spark, root) == 2


def test_last_row_wins_across_many_rows_and_files(spark, tmp_path):
    folder = tmp_path / "in"
    put_all(folder)
    (folder / "products.csv").unlink()
    files = folder / "products.csv"
    files.mkdir()
    for part in range(3):
        body = "".join(f"{n % 50},v{part}-{n},Toys,1.00\n" for n in range(400))
        (files / f"part-{part}.csv").write_text(HEADERS["products"] + "\n" + body)
    root = str(tmp_path / "warehouse")
    assert jobs.ingest(spark, str(folder), root)["products"] == 1200
    found = {r.product_id: r.product_name for r in warehouse.read(spark, root, "products").collect()}
    assert found == {n: f"v2-{350 + n}" for n in range(50)}


def test_failed_load_leaves_nothing_visible(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    jobs.ingest(spark, put_all(tmp_path / "one"), root)
    bad = put_all(tmp_path / "two", products="1,other,Toys,4.00\n", payments="1,oops,1,Card,01/05/2020\n")
    with pytest.raises(PySparkException):
        jobs.ingest(spark, bad, root)
    assert warehouse.read(spark, root, "products").first().product_name == "lamp"
    # The load can be repeated with good rows.
    jobs.ingest(spark, put_all(tmp_path / "three", products="1,other,Toys,4.00\n"), root)
    assert warehouse.read(spark, root, "products").first().product_name == "other"


def test_tables_answer_sql(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    jobs.ingest(spark, put_all(tmp_path / "one"), root)
    warehouse.register_views(spark, root)
    found = spark.sql(
        "SELECT date_format(o.order_date, 'yyyy-MM') AS month, SUM(i.quantity * i.price) AS revenue "
        "FROM orders o JOIN order_items i ON o.order_id = i.order_id GROUP BY 1"
    )
    assert [tuple(r) for r in found.collect()] == [("2020-01", Decimal("39.98"))]


def test_nothing_to_read_before_the_first_load(spark, tmp_path):
    with pytest.raises(ValueError, match="no finished load"):
        warehouse.read(spark, str(tmp_path), "orders")


def test_ingest_with_quarantine(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    source = put_all(tmp_path / "one", orders="1,1,01/02/2020,shipped\n2,1,99/99/2020,shipped\n")
    assert jobs.ingest(spark, source, root, quarantine=True)["orders"] == 1
    aside = rows(spark.read.json(f"{root}/quarantine/load=1-*/orders"))
    assert [(r["order_id"], r["reason"]) for r in aside] == [("2", "order_date: bad value 99/99/2020")]


def test_single_line_reading_keeps_the_order_of_rows(spark, tmp_path):
    body = "".join(f"{n % 10},v{n},Toys,1.00\n" for n in range(20_000))
    source = put_all(tmp_path / "one", products=body)
    root = str(tmp_path / "warehouse")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        jobs.ingest(spark, source, root, multi_line=False)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = {r.product_id: r.product_name for r in warehouse.read(spark, root, "products").collect()}
    assert found == {n: f"v{19_990 + n}" for n in range(10)}


def test_of_two_loads_at_once_one_is_listed(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "warehouse")
    first, second = put_all(tmp_path / "one"), put_all(tmp_path / "two", products="1,other,Toys,4.00\n")
    listed, done = warehouse.record_load, []

    def late(*args):
        if not done:  # the first load is about to be listed when a second one runs from start to end
            done.append(True)
            jobs.ingest(spark, second, root)
        listed(*args)

    monkeypatch.setattr(warehouse, "record_load", late)
    with pytest.raises(RuntimeError, match="another load"):
        jobs.ingest(spark, first, root)
    assert [r["load"] for r in warehouse.loads(spark, root)] == [1]
    assert warehouse.read(spark, root, "products").first().product_name == "other"
    jobs.ingest(spark, first, root)
    assert warehouse.read(spark, root, "products").first().product_name == "lamp"


def test_a_log_entry_is_made_once(spark, tmp_path):
    path = str(tmp_path / "loads" / "1.json")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda n: warehouse._publish(spark, path, f"{n}\n"), range(24)))
    assert sum(made) == 1
    assert (tmp_path / "loads" / "1.json").read_text() == f"{made.index(True)}\n"
    assert [f.name for f in (tmp_path / "loads").iterdir()] == ["1.json"]


def test_bad_rows_of_a_failed_load_are_not_listed_twice(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "warehouse")
    source = put_all(tmp_path / "one", orders="1,1,01/02/2020,shipped\n2,1,99/99/2020,shipped\n")
    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "record_load", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.ingest(spark, source, root, quarantine=True)
    jobs.ingest(spark, source, root, quarantine=True)
    load_id = warehouse.loads(spark, root)[0]["id"]
    assert spark.read.json(f"{root}/quarantine/{load_id}/orders").count() == 1


def test_counters_say_what_became_of_rows(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    bodies = ["1,a,Toys,1.00\n2,b,Toys,x\n3,c,Toys,1.00\n1,d,Toys,1.00\n", "3,e,Toys,1.00\n4,f,Toys,1.00\n4,g,Toys,2.00\n", ""]
    for k, body in enumerate(bodies):
        put(tmp_path / str(k), "products", body)
        jobs.ingest(spark, str(tmp_path / str(k)), root, quarantine=True, names=["products"])
    names = ["load", "rows_read", "rows_refused", "rows_superseded", "rows_replaced", "rows_inserted", "rows_kept"]
    found = sorted(tuple(r[c] for c in names) for r in warehouse.load_counts(spark, root).collect())
    assert found == [(1, 4, 1, 1, 0, 2, 0), (2, 3, 0, 1, 1, 1, 1), (3, 0, 0, 0, 0, 0, 3)]
    assert warehouse.rows_of(warehouse.loads(spark, root), "products") == warehouse.read(spark, root, "products").count() == 3


def test_buckets_can_be_raised(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    body = "".join(f"{n},v{n},Toys,1.00\n" for n in range(2000))
    put(tmp_path / "all", "products", body)
    put(tmp_path / "few", "products", "7,new,Toys,2.00\n2001,more,Toys,2.00\n")

    def ingest(batch, **more):
        jobs.ingest(spark, str(tmp_path / batch), root, names=["products"], **more)
        entry = warehouse.loads(spark, root)[-1]
        rows = {r.product_id: r.product_name for r in warehouse.read(spark, root, "products").collect()}
        return len(entry["parts"]), {p["of"] for p in entry["parts"]}, rows

    want = {n: f"v{n}" for n in range(2000)}
    assert ingest("all") == (16, {16}, want)
    want |= {7: "new", 2001: "more"}
    parts, of, found = ingest("few", buckets=256)
    assert parts > 200 and of == {256} and found == want
    # A batch of two keys now writes two of 256 buckets, whatever a later load asks for below that.
    for more in ({}, {"buckets": 16}):
        parts, of, found = ingest("few", **more)
        assert parts <= 2 and of == {256} and found == want
    touched = warehouse.loads(spark, root)[-1]["parts"]
    rows = warehouse.read(spark, root, "products", only=[p["bucket"] for p in touched]).count()
    assert rows < 60
    assert {r.product_id for r in warehouse.read(spark, root, "products", load=1).collect()} == set(range(2000))


def test_an_empty_first_load_can_be_followed(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    put(tmp_path / "none", "products", "")
    put(tmp_path / "one", "products", "1,lamp,Toys,1.00\n")
    jobs.ingest(spark, str(tmp_path / "none"), root, names=["products"])
    assert warehouse.read(spark, root, "products").count() == 0
    jobs.ingest(spark, str(tmp_path / "one"), root, names=["products"])
    assert warehouse.read(spark, root, "products").count() == 1
