"""The layered sales job on a small received file with planted faults."""

import datetime as dt
import pathlib
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidewell.operators.audit import AuditLog
from tidewell.operators import stored
from tidewell.plans import sales
from tidewell.sinks import append
from tidewell.sources import read_csv_strings

# 50 transactions, three a day from 2024-01-01, the products and their
# stores taking turns; only quantity and discount differ from row to row.
PRODUCTS = [
    ("P01", "Laptop", "Electronics", "S01", 500),
    ("P02", "Smartphone", "Electronics", "S02", 1200),
    ("P03", "Desk", "Furniture", "S03", 300),
]
STORES = [
    ("S01", "Bangalore Store", "South"),
    ("S02", "Mumbai Store", "West"),
    ("S03", "Delhi Store", "North"),
]
QUANTITIES = [
    [2, 1, 3], [1, 2, 4], [3, 1, 2], [0, 1, -1], [2, 3, 1], [4, 2, 2], [1, 1, 3], [2, 2, 4],
    [3, 1, 2], [1, 3, 1], [2, 2, 3], [4, 1, 2], [1, 2, 1], [3, 1, 2], [2, 3, 1], [4, 2, 3], [1, 1],
]
DISCOUNTS = {
    1: 50, 3: 20, 5: 100, 7: 50, 14: 200, 16: 100, 21: 50, 23: 100, 29: 300, 34: 100, 40: 50,
    44: 200,
}
UNKNOWN_STORE = 11


def lines():
    number = 0
    for day, quantities in enumerate(QUANTITIES):
        for (product, _, _, store, price), quantity in zip(PRODUCTS, quantities):
            number += 1
            discount = DISCOUNTS.get(number, 0)
            shop = "S99" if number == UNKNOWN_STORE else store
            date = dt.date(2024, 1, 1) + dt.timedelta(day)
            total = quantity * price - discount
            yield f"T{number:03},{date},{product},{shop},{quantity},{price},{discount},{total},INR"


HEADER = (
    "transaction_id,transaction_date,product_id,store_id,quantity,unit_price,discount,"
    "total_amount,currency"
)


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("\n".join([HEADER, *lines()]) + "\n")
    return str(path)


@pytest.fixture
def stores(spark):
    return spark.createDataFrame(STORES, "store_id string, store_name string, region string")


@pytest.fixture
def products(spark):
    named = [p[:3] for p in PRODUCTS]
    return spark.createDataFrame(named, "product_id string, product_name string, category string")


def test_whole_job(spark, source, stores, products, folder):
    log = AuditLog(spark, f"{folder}/log")
    assert sales.run_bronze(spark, source, folder, log) == {"n_rows": 50}
    # Bronze only grows: a second delivery brings every row again.
    sales.run_bronze(spark, source, folder, log)
    bronze = spark.read.parquet(f"{folder}/bronze/sales")
    assert bronze.count() == 100
    assert dict(bronze.dtypes)["quantity"] == "string"
    assert bronze.filter("source_system <> 'manual_csv' OR ingestion_timestamp IS NULL").count() == 0

    counts = sales.run_silver(spark, stores.select("store_id"), folder, log)
    assert counts == {"n_rows": 47, "n_rejected": 3}
    schema = sales.judged(bronze, stores.select("store_id")).schema
    good, bad = sales.read_silver(spark, folder, schema)
    assert good.count() == 47
    assert rows(bad.select("transaction_id", "reject_reason")) == [
        ("T010", "quantity"),
        ("T011", "store_id"),
        ("T012", "quantity"),
    ]
    assert good.agg(F.sum("correct_total")).first()[0] == Decimal("60480.00")
    assert good.filter("correct_total <> total_amount").count() == 0

    database = "gold_test"
    try:
        assert sales.run_gold(spark, good, stores, products, database, log) == {"n_rows": 16}
        daily = spark.table(f"{database}.daily_sales")
        expected = {
            1: 3030, 2: 4000, 3: 3250, 5: 4700, 6: 4900, 7: 2550, 8: 4500, 9: 3300, 10: 4100,
            11: 4300, 12: 3700, 13: 3200, 14: 3250, 15: 4700, 16: 5300, 17: 1700,
        }
        assert {r[0].day: r[1] for r in daily.collect()} == expected
        monthly = spark.table(f"{database}.monthly_region")
        assert rows(monthly) == [
            (1, "North", 10130.0),
            (1, "South", 17650.0),
            (1, "West", 32700.0),
        ]
        performance = spark.table(f"{database}.product_performance")
        assert rows(performance) == [
            ("Desk", "Furniture", 10130.0),
            ("Laptop", "Electronics", 17650.0),
            ("Smartphone", "Electronics", 32700.0),
        ]
        assert rows(sales.total_revenue(daily)) == [(60480.0,)]
        assert [r[0].day for r in sales.daily_trend(daily).collect()] == list(expected)
        assert [r.region for r in sales.monthly_by_region(monthly, "West").collect()] == ["West"]
        assert [r[0] for r in sales.top_products(performance, 2).collect()] == [
            "Smartphone",
            "Laptop",
        ]
        assert rows(sales.category_revenue(performance)) == [
            ("Electronics", 50350.0),
            ("Furniture", 10130.0),
        ]
        gold = {
            "daily": (daily, "daily_revenue"),
            "monthly": (monthly, "monthly_revenue"),
            "product": (performance, "total_revenue"),
        }
        assert {r.diff for r in sales.reconcile(good, gold).collect()} == {0.0}
        short = {"daily": (daily.filter("daily_revenue < 5000"), "daily_revenue")}
        assert sales.reconcile(good, short).first().diff == -5300.0
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")

    kinds = log.read().groupBy("pipeline_layer", "event_type").agg(F.max("record_count"))
    assert rows(kinds) == [
        ("bronze", "END", 50),
        ("bronze", "START", 0),
        ("gold", "END", 16),
        ("gold", "START", 0),
        ("silver", "END", 47),
        ("silver", "REJECTED", 3),
        ("silver", "START", 0),
    ]


def test_valid_and_quarantine_are_the_two_halves(spark, source, stores):
    received = read_csv_strings(spark, source)
    ids = stores.select("store_id")
    good, bad = sales.silver_valid(received, ids), sales.silver_quarantine(received, ids)
    judged = sales.judged(received, ids)
    assert rows(good) == rows(judged.filter("is_valid").drop("is_valid", "reject_reason"))
    assert good.count() + bad.count() == 50


def test_text_that_is_no_number_is_rejected(spark, stores):
    columns = HEADER.split(",")
    received = spark.createDataFrame(
        [
            ("A", "2024-01-01", "P01", "S01", "two", "500", "0", "0", "INR"),
            ("B", "2024-01-01", "P01", "S01", "2", "x", "0", "0", "INR"),
            ("C", "2024-01-01", "P01", None, "2", "500", "0", "0", "INR"),
            ("D", "not a day", "P01", "S01", "2", "1.25", "0.5", "0", "INR"),
        ],
        ", ".join(f"{c} string" for c in columns),
    )
    ids = stores.select("store_id")
    bad = sales.silver_quarantine(received, ids).select("transaction_id", "reject_reason")
    assert rows(bad) == [("A", "quantity"), ("B", "unit_price"), ("C", "store_id")]
    good = sales.silver_valid(received, ids).first()
    assert good.transaction_id == "D"
    assert good.correct_total == Decimal("2.00") and good.transaction_date is None


def test_dedup_keeps_the_row_received_last(spark):
    df = spark.createDataFrame(
        [("A", "old", dt.datetime(2024, 1, 1)), ("A", "new", dt.datetime(2024, 1, 2))],
        "transaction_id string, note string, ingestion_timestamp timestamp",
    )
    assert [r.note for r in sales.dedup(df).collect()] == ["new"]


def valid_rows(spark, made):
    rows_ = [(key, dt.date(2024, month, 3), n) for key, month, n in made]
    return spark.createDataFrame(rows_, "transaction_id string, transaction_date date, n int")


def test_merge_job(spark, folder):
    log, path = AuditLog(spark, f"{folder}/log"), f"{folder}/silver"
    first = valid_rows(spark, [("A", 1, 1), ("B", 2, 1), (None, 2, 7)])
    assert sales.run_merge(spark, path, first, log) == {"n_rows": 3}
    later = valid_rows(spark, [("B", 3, 2), ("C", 2, 2), (None, 2, 7), (None, 2, 8)])
    for _ in range(2):  # the second time changes nothing
        assert sales.run_merge(spark, path, later, log) == {"n_rows": 4}
        merged = sales.read_merged(spark, path).select("transaction_id", "n")
        assert rows(merged) == [(None, 7), (None, 8), ("A", 1), ("B", 2), ("C", 2)]


def received_rows(spark, made):
    columns = HEADER.split(",")
    full = [(key, "2024-01-05", "P01", store, quantity, price, "0", "0", "INR") for key, store, quantity, price in made]
    return sales.bronze(spark.createDataFrame(full, ", ".join(f"{c} string" for c in columns)))


def test_runs_take_what_is_new(spark, stores, folder, monkeypatch):
    """Two arrivals; the second run reads only the second, and a batch that comes again changes nothing."""
    log, ids = AuditLog(spark, f"{folder}/log"), stores.select("store_id")
    seen = []
    judged = sales.judged
    monkeypatch.setattr(sales, "judged", lambda batch, s: (seen.append(batch.count()), judged(batch, s))[1])
    append(received_rows(spark, [("A", "S01", "1", "2"), ("B", "S02", "1", "3"), ("X", "S77", "1", "1")]), f"{folder}/bronze/sales")
    assert sales.run_increment(spark, ids, folder, log) == {"n_rows": 2, "n_rejected": 1}
    append(received_rows(spark, [("B", "S02", "5", "3"), ("A", "S01", "0", "2")]), f"{folder}/bronze/sales")
    assert sales.run_increment(spark, ids, folder, log) == {"n_rows": 1, "n_rejected": 1}
    assert sales.run_increment(spark, ids, folder, log) == {"n_rows": 0, "n_rejected": 0}
    assert seen == [3, 2]

    def state():
        silver = sales.read_merged(spark, f"{folder}/silver/sales").select("transaction_id", "correct_total")
        bad = sales.read_quarantine(spark, folder).select("transaction_id", "reject_reason", "batch")
        return rows(silver), rows(bad)

    # The later row of A is invalid, so the one before it stays.
    good, bad = state()
    assert [(k, float(v)) for k, v in good] == [("A", 2.0), ("B", 15.0)]
    assert bad == [("A", "quantity", 1), ("X", "store_id", 0)]

    # The last batch was merged, but the stream did not get to note it.
    commits = pathlib.Path(folder) / "_checkpoints" / "silver" / "commits"
    for name in ("1", ".1.crc"):
        (commits / name).unlink()
    assert sales.run_increment(spark, ids, folder, log) == {"n_rows": 0, "n_rejected": 0}
    assert seen == [3, 2] and state() == (good, bad)
    # It was not even noted as merged: it is merged again, with the same result.
    for name in ("1", ".1.crc"):
        (commits / name).unlink()
    (pathlib.Path(folder) / "silver" / "_merged" / "1").rmdir()
    assert sales.run_increment(spark, ids, folder, log) == {"n_rows": 1, "n_rejected": 1}
    assert seen == [3, 2, 2] and state() == (good, bad)


def test_a_run_stores_what_it_judged_once(spark, stores, folder, monkeypatch):
    """The merge reads the judged rows where they lie; no second copy is made, and none is left."""
    made, log, ids = [], AuditLog(spark, f"{folder}/log"), stores.select("store_id")

    def noted(session, label):
        made.append(f"{folder}/scratch/{label}-{len(made)}")
        return made[-1]

    for module in (sales, stored):
        monkeypatch.setattr(module, "fresh_path", noted)
    for arrived in ([("A", "S01", "1", "2"), ("X", "S77", "1", "1")], [("A", "S02", "5", "3")], [("B", "S77", "1", "1")]):
        append(received_rows(spark, arrived), f"{folder}/bronze/sales")
        sales.run_increment(spark, ids, folder, log)
    assert [p.rpartition("/")[2] for p in made] == ["judged-0", "judged-1", "judged-2"]
    assert not list((pathlib.Path(folder) / "scratch").iterdir())
    silver = sales.read_merged(spark, f"{folder}/silver/sales")
    assert rows(silver.select("transaction_id", "store_id")) == [("A", "S02")]
    assert "reject_reason" not in silver.columns and "is_valid" not in silver.columns
    bad = sales.read_quarantine(spark, folder)
    assert sales.MONTH not in bad.columns
    assert rows(bad.select("transaction_id", "reject_reason", "batch")) == [("B", "store_id", 2), ("X", "store_id", 0)]


def test_month_with_and_without_year(spark, stores):
    silver = spark.createDataFrame(
        [(dt.date(2023, 1, 5), "S01", 1.0), (dt.date(2024, 1, 5), "S01", 2.0)],
        "transaction_date date, store_id string, correct_total double",
    )
    assert rows(sales.monthly_region(silver, stores)) == [(1, "South", 3.0)]
    assert rows(sales.monthly_region(silver, stores, with_year=True)) == [
        (2023, 1, "South", 1.0),
        (2024, 1, "South", 2.0),
    ]


def test_rollup_over_a_repeated_dimension_row(spark, stores):
    """Adding up before the join gives what the plain join gives, also then."""
    silver = spark.createDataFrame(
        [(dt.date(2024, 1, 5), s, 1.5) for s in ["S01", "S01", "S02", "S77", None]],
        "transaction_date date, store_id string, correct_total double",
    )
    doubled = stores.union(stores.filter("store_id = 'S01'"))
    plain = (
        silver.join(doubled, "store_id")
        .groupBy(F.month("transaction_date").cast("bigint").alias("month"), "region")
        .agg(F.sum("correct_total"))
    )
    assert rows(sales.monthly_region(silver, doubled)) == rows(plain)


def test_command_line(spark, source, tmp_path, capsys):
    from tidewell.__main__ import main

    head = {"stores": "store_id,store_name,region", "products": "product_id,product_name,category"}
    body = {"stores": STORES, "products": [p[:3] for p in PRODUCTS]}
    for name in head:
        lines_ = [head[name], *[",".join(r) for r in body[name]]]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines_) + "\n")
    base = str(tmp_path / "base")
    try:
        main(
            ["sales", source, str(tmp_path / "stores.csv"), str(tmp_path / "products.csv"), base]
            + ["--database", "gold_cli"]
        )
        assert rows(sales.total_revenue(spark.table("gold_cli.daily_sales"))) == [(60480.0,)]
    finally:
        spark.sql("DROP DATABASE IF EXISTS gold_cli CASCADE")
    main(["orders", _order_file(tmp_path), str(tmp_path / "orders")])
    assert "PAID" in capsys.readouterr().out


def _order_file(tmp_path):
    path = tmp_path / "o.csv"
    path.write_text(
        "order_id,order_timestamp,customer_id,country,amount,currency,status\n"
        "O-1,2025-11-01T10:07:00Z,C-1,IN,960.81,INR,CREATED\n"
        "O-2,2025-11-01T10:14:00Z,C-2,US,20.5,USD,PAID\n"
    )
    return str(path)
