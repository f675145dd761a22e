import datetime as dt
import json
import pathlib
from collections import Counter
from decimal import Decimal

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import generate
from tidewell.plans import orders, pos, taxi
from tidewell.sinks import overwrite_partitioned
from tidewell.streaming import ExpectationMeter, expect_or_drop, read_stream_table, run_available

# -- order table -------------------------------------------------------------

COUNTRIES = ["US", "IN", "GB", "CA", "AU"]
STATUSES = ["CREATED", "PAID", "CANCELLED"]


def made_orders(n=100):
    start = dt.datetime(2025, 11, 1, 10, 7)
    return [
        (
            f"O-{1001 + i}",
            start + dt.timedelta(minutes=7 * i),
            f"C-{i % 40:04}",
            COUNTRIES[i % 5],
            round((i * 37 % 101) * 4.99 + 12.5, 2),
            "USD",
            STATUSES[i % 3],
        )
        for i in range(n)
    ]


@pytest.fixture
def order_csv(tmp_path):
    path = tmp_path / "orders.csv"
    head = "order_id,order_timestamp,customer_id,country,amount,currency,status"
    body = [",".join([o[0], o[1].strftime("%Y-%m-%dT%H:%M:%SZ"), *map(str, o[2:])]) for o in made_orders()]
    path.write_text("\n".join([head, *body]) + "\n")
    return str(path)


def test_order_table_job(spark, order_csv, folder):
    schema = orders.ORDER_SCHEMA + ", payment_method string, coupon_code string"
    day = dt.datetime(2025, 12, 3, 9)
    late = [("N-1", day, "C-1", "US", 75.5, "USD", "PAID", "CARD", "SPRING"), ("N-2", day, "C-2", "IN", 640.0, "INR", "CREATED", "CASH", None)]
    table = orders.run(spark, order_csv, f"{folder}/orders", spark.createDataFrame(late, schema))
    # The same changes on a dict.
    state = {o[0]: (o[3], o[4], o[6]) for o in made_orders()}
    paid = [k for k, (c, _, s) in state.items() if c == "IN" and s == "CREATED"]
    state |= {k: (state[k][0], state[k][1], "PAID") for k in paid}
    state |= {o[0]: (o[3], o[4], o[6]) for o in late}
    small = [k for k, (c, a, _) in state.items() if c == "US" and a < 100]
    state |= {k: (state[k][0], state[k][1], "CANCELLED") for k in small}
    gone = [k for k, (_, a, _) in state.items() if a < 50]
    for k in gone:
        del state[k]
    assert paid and gone and "N-1" in small
    for found in (table, spark.read.parquet(f"{folder}/orders_clustered")):
        listed = found.select("order_id", "country", "amount", "status").collect()
        assert {r[0]: tuple(r[1:]) for r in listed} == state and len(listed) == len(state)
    brought = table.filter("payment_method IS NOT NULL").select("order_id", "coupon_code", "order_date")
    assert rows(brought) == [("N-1", "SPRING", dt.date(2025, 12, 3)), ("N-2", None, dt.date(2025, 12, 3))]


def test_pruned_scan_reads_one_folder(spark, folder):
    schema = (
        "order_id string, order_timestamp timestamp, customer_id string, country string, "
        "amount double, currency string, status string"
    )
    dated = orders.with_order_date(spark.createDataFrame(made_orders(), schema))
    overwrite_partitioned(dated, f"{folder}/t", orders.PARTITIONS)
    stored = spark.read.parquet(f"{folder}/t")
    found = orders.pruned(stored, "US", "2025-11-01")
    text = plan(found)
    assert "PartitionFilters" in text and "country" in text.split("PartitionFilters")[1][:120]
    assert "order_date" in text.split("PartitionFilters")[1][:200]
    assert len(found.inputFiles()) > 0
    assert found.count() == dated.filter("country = 'US' AND order_date = '2025-11-01'").count() > 0
    assert orders.pruned(stored, "US", "2025-11-05").count() == 0


# -- trips ---------------------------------------------------------------------

TRIPS = (
    T.StructType()
    .add("tpep_pickup_datetime", "timestamp_ntz")
    .add("fare_amount", "double")
    .add("trip_distance", "double")
    .add("pickup_zip", "integer")
    .add("dropoff_zip", "integer")
)
SUNDAY, MONDAY = dt.datetime(2024, 1, 7, 12), dt.datetime(2024, 1, 8, 12)


def trips(spark, made):
    return spark.createDataFrame(made, TRIPS)


FIRST = [
    (SUNDAY, 50.0, 9.0, 1, 1),
    (SUNDAY, 50.01, 9.0, 1, 1),
    (MONDAY, 60.0, 4.99, 1, 2),
    (MONDAY, 60.0, 5.0, 1, 2),
    (MONDAY, 99.0, 0.0, 1, 1),
    (MONDAY, 99.0, -1.0, 1, 1),
    (MONDAY, 99.0, None, 1, 1),
]
MORE = [(MONDAY, 70.0, 2.0, 3, 4), (MONDAY, 80.0, 1.0, 5, 6), (MONDAY, 10.0, 0.0, 5, 6)]


def test_trip_job_takes_each_row_once(spark, folder):
    source, base = f"{folder}/source", f"{folder}/out"
    trips(spark, FIRST).write.parquet(source)
    assert taxi.run(spark, source, TRIPS, base) == {"n_in": 7, "n_dropped": 3, "n_top": 2}
    # Nothing new: nothing is read, nothing added.
    assert taxi.run(spark, source, TRIPS, base) == {"n_in": 0, "n_dropped": 0, "n_top": 2}
    trips(spark, MORE).write.mode("append").parquet(source)
    assert taxi.run(spark, source, TRIPS, base) == {"n_in": 3, "n_dropped": 1, "n_top": 3}

    assert spark.read.parquet(f"{base}/raw").count() == 6
    week1, week2 = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    assert rows(spark.read.parquet(f"{base}/flagged")) == [
        (week1, 1, 50.01, 9.0),
        (week2, 1, 60.0, 4.99),
        (week2, 3, 70.0, 2.0),
        (week2, 5, 80.0, 1.0),
    ]
    assert rows(spark.read.parquet(f"{base}/weekly")) == [
        (week1, 50.005, 9.0),
        (week2, 67.5, 3.2475),
    ]
    top = spark.read.parquet(f"{base}/top").orderBy(F.desc("fare_amount"))
    assert [tuple(r) for r in top.collect()] == [
        (week2, 67.5, 3.248, 80.0, 1.0, 5),
        (week2, 67.5, 3.248, 70.0, 2.0, 3),
        (week2, 67.5, 3.248, 60.0, 4.99, 1),
    ]


def test_backlog_is_taken_in_batches_and_counted_whole(spark, folder):
    for i in range(5):
        trips(spark, FIRST).coalesce(1).write.mode("append").parquet(f"{folder}/source")
    meter = ExpectationMeter()
    spark.streams.addListener(meter)
    try:
        lines = read_stream_table(spark, f"{folder}/source", TRIPS, max_files_per_batch=2)
        kept = expect_or_drop(lines, taxi.valid_distance())
        query = run_available(kept, f"{folder}/raw", f"{folder}/checkpoint")
        assert meter.counts(query) == {"n_in": 35, "n_dropped": 15}
        assert query.lastProgress.batchId == 2
    finally:
        spark.streams.removeListener(meter)
    # A report that never comes does not fail a load that is done.
    assert ExpectationMeter().counts(query, timeout=0.01) == {"n_in": None, "n_dropped": None}
    assert spark.read.parquet(f"{folder}/raw").count() == 20


def test_top_rides_keep_a_week_without_averages(spark):
    flagged = taxi.flagged_rides(trips(spark, FIRST).filter(taxi.valid_distance()))
    weekly = taxi.weekly_stats(trips(spark, FIRST)).filter("week > '2024-01-05'")
    found = taxi.top_rides(flagged, weekly, 5).collect()
    assert [(r.fare_amount, r.avg_amount is None) for r in found] == [(60.0, False), (50.01, True)]


# -- point of sale ---------------------------------------------------------------

POS = (
    "transaction_id bigint, store_name string, date date, quantity int, total decimal(18,2), "
    "customer_id int, promo_code string"
)


def sale(i, store="Mall", day=1, quantity=2, total="10.00", customer=7, promo="DISC5"):
    amount = None if total is None else Decimal(total)
    return (i, store, dt.date(2025, 10, day), quantity, amount, customer, promo)


def test_clean_and_derive(spark):
    made = [
        sale(1),
        sale(1),
        sale(2, total="20.00", customer=None, promo=None),
        sale(3, total=None, quantity=0),
    ]
    found = pos.derive(pos.clean(spark.createDataFrame(made, POS)))
    chosen = found.select(
        "transaction_id", "total", "customer_id", "promo_code", "revenue_per_item", "month", "day_of_week"
    )
    assert rows(chosen) == [
        (1, Decimal("10.00"), "7", "DISC5", 5.0, 10, "Wednesday"),
        (2, Decimal("20.00"), "Unknown", "No Code", 10.0, 10, "Wednesday"),
        (3, Decimal("15.00"), "7", "DISC5", None, 10, "Wednesday"),
    ]


@pytest.mark.parametrize(
    ("kind", "given", "mean"),
    [
        ("decimal(18,7)", [Decimal("1.0000400"), Decimal("2.0000000")], Decimal("1.5000200")),
        ("decimal(9,1)", [Decimal("0.1"), Decimal("0.2")], Decimal("0.2")),
        ("double", [1.00004, 2.0], 1.50002),
        ("int", [1, 2], 1.5),
        ("double", [], None),
    ],
)
def test_totals_keep_their_type_and_digits(spark, kind, given, mean):
    made = [(t, 1, "x", str(i)) for i, t in enumerate([*given, None])]
    found = pos.clean(spark.createDataFrame(made, f"total {kind}, customer_id int, promo_code string, k string"))
    assert dict(found.dtypes)["total"] == ("double" if kind == "int" else kind)
    assert {r.k: r.total for r in found.collect()} == {str(i): t for i, t in enumerate([*given, mean])}


def test_filters_at_their_edges(spark):
    made = [sale(1, day=1), sale(2, day=2, total="5.00"), sale(3, day=3, store=None, total="5.01"), sale(4, day=4)]
    df = spark.createDataFrame(made, POS)
    ids = lambda d: [r[0] for r in rows(d.select("transaction_id"))]
    assert ids(pos.by_dates(df, "2025-10-02", "2025-10-03")) == [2, 3]
    assert ids(pos.high_value(df, 5.0)) == [1, 3, 4]
    assert ids(pos.by_store(df, "Mall")) == [1, 2, 4]


def test_filters_reach_the_scan(spark, folder):
    spark.createDataFrame([sale(1)], POS).write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    assert "EqualTo(store_name,Mall)" in plan(pos.by_store(stored, "Mall"))
    dated = plan(pos.by_dates(stored, "2025-10-02", "2025-10-03").select("total"))
    assert "GreaterThanOrEqual(date,2025-10-02)" in dated
    assert "ReadSchema: struct<date:date,total:decimal(18,2)>" in dated


POS_SCHEMA = (
    "transaction_id int, store_name string, date string, quantity int, total double, customer_id int, promo_code string"
)


@pytest.mark.parametrize("schema", [None, POS_SCHEMA])
def test_pos_job_writes_json(spark, tmp_path, schema):
    csv = tmp_path / "sample.csv"
    csv.write_text(
        "transaction_id,store_name,date,quantity,total,customer_id,promo_code\n"
        "1,Mall,2025-10-02,2,10.0,7,DISC5\n1,Mall,2025-10-02,2,10.0,7,DISC5\n"
        "2,Airport,2025-10-04,4,30.0,,\n"
    )
    n, statistics = pos.run(spark, str(csv), str(tmp_path / "out"), schema)
    assert n == 2
    assert rows(statistics) == [(20.0, 20.0, 40.0, 20.0)]
    records = [
        json.loads(line)
        for part in pathlib.Path(tmp_path / "out").glob("part-*")
        for line in part.read_text().splitlines()
    ]
    found = {r["transaction_id"]: r for r in records}
    assert found[2]["customer_id"] == "Unknown" and found[2]["date"] == "2025-10-04"
    assert found[2]["revenue_per_item"] == 7.5 and found[2]["day_of_week"] == "Saturday"


def test_extend(spark, tmp_path):
    csv = tmp_path / "sample.csv"
    csv.write_text(
        "transaction_id,store_id,store_name,date,product_id,product_name,quantity,unit_price,total,"
        "customer_id,promo_code\n"
        "10,1,Downtown,2025-10-01,501,Notebook,2,3.50,7.00,2001,\n"
    )
    found = pos.extend(spark, str(csv), str(tmp_path / "out"), n=990)
    assert rows(found["shape"]) == [(1 + 990 + 9, 11)]
    assert rows(found["ids"]) == [(10, 1000)]
    missing = dict(rows(found["missing"]))
    assert 20 < missing["customer_id"] < 90 and 350 < missing["promo_code"] < 500
    assert missing["total"] == missing["date"] == 0
    assert [r.transaction_id for r in found["first"].collect()][0] == 10
    written = spark.read.option("header", True).csv(str(tmp_path / "out"))
    ids = [int(r.transaction_id) for r in written.collect()]
    assert ids != sorted(ids)


# -- made-up rows ------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 99, 990, 12345])
def test_generated_ids_and_copies(spark, n):
    made = generate.generate_sales(spark, after_id=100, n=n).select("transaction_id")
    seen = Counter(r[0] for r in made.collect())
    assert sorted(seen) == list(range(101, 101 + n))
    assert sorted(seen.values(), reverse=True)[: n // 100] == [2] * (n // 100)
    assert sum(seen.values()) == n + n // 100


def test_copies_lie_all_over_and_depend_on_the_seed(spark):
    n = 524286

    def copied(seed):
        made = generate.generate_sales(spark, 0, n, seed).groupBy("transaction_id").count()
        return {r[0] for r in made.filter("count = 2").collect()}

    one, other = copied(1), copied(2)
    assert len(one) == len(other) == n // 100
    assert one == copied(1)
    assert len(one & other) < n // 100 // 10
    for half in (one, other):
        assert n // 100 * 0.4 < sum(i <= n // 2 for i in half) < n // 100 * 0.6
        assert len({i % 100 for i in half}) == 100


def test_generated_rows_are_plausible(spark):
    df = generate.generate_sales(spark, after_id=0, n=20000)
    prices = {p[0]: (p[1], Decimal(p[2])) for p in generate.PRODUCTS}
    stores = dict(generate.STORES)
    for r in df.limit(500).collect():
        assert stores[r.store_id] == r.store_name
        assert prices[r.product_id] == (r.product_name, r.unit_price)
        assert r.total == r.quantity * r.unit_price
        assert 1 <= r.quantity <= 10 and r.date.year == 2025
        assert r.customer_id is None or 2001 <= r.customer_id <= 2100
    share = df.agg(
        F.avg(F.col("customer_id").isNull().cast("int")).alias("no_customer"),
        F.avg(F.col("promo_code").isNull().cast("int")).alias("no_promo"),
        F.avg("quantity").alias("quantity"),
        F.countDistinct("store_id").alias("stores"),
        F.countDistinct("product_id").alias("products"),
        F.countDistinct("date").alias("days"),
    ).first()
    assert share.no_customer == pytest.approx(0.05, abs=0.01)
    assert share.no_promo == pytest.approx(3 / 7, abs=0.02)
    assert share.quantity == pytest.approx(5.5, abs=0.1)
    assert (share.stores, share.products, share.days) == (5, 10, 365)


def test_generated_rows_do_not_depend_on_partitions(spark):
    ids = spark.range(500).select("id")
    one = generate.sales_rows(ids.coalesce(1), 42)
    many = generate.sales_rows(ids.repartition(7), 42)
    assert rows(one) == rows(many)
    assert rows(one) != rows(generate.sales_rows(ids, 43))
