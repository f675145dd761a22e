import datetime as dt
import json
import pathlib
from decimal import Decimal

import pytest
from helpers import rows

from tidewell.operators.keys import DuplicateKeyError
from tidewell.operators.quality import QualityError
from tidewell.plans import warehouse
from tidewell.session import move_path
from tidewell.sinks import swap

DAY = "2025-03-10"


def order(order_id, at, quantity=1, customer=1, product=1, amount="5.00", currency="USD", **more):
    made = {
        "order_id": order_id,
        "order_timestamp": at,
        "customer_id": customer,
        "product_id": product,
        "quantity": quantity,
        "total_amount": amount,
        "currency": currency,
        "status": "NEW",
    }
    return {**made, **more}


def land(base, day, orders, customers=("1,Ann,Lee,a@x.org,2024-01-05,US",), products=("1,Pen,Desk,1.5",)):
    stamp = day.replace("-", "")
    header = {
        "customers": "customer_id,first_name,last_name,email,signup_date,country",
        "products": "product_id,product_name,category,unit_price",
    }
    for name, lines in (("customers", customers), ("products", products)):
        place = pathlib.Path(base) / name
        place.mkdir(parents=True, exist_ok=True)
        (place / f"{name}_{stamp}.csv").write_text("\n".join([header[name], *lines]) + "\n")
    place = pathlib.Path(base) / "orders"
    place.mkdir(parents=True, exist_ok=True)
    text = "\n".join(json.dumps(o) for o in orders)
    (place / f"orders_{stamp}.json").write_text(text + "\n\n")


def schema(df_rows, spark):
    return spark.createDataFrame(df_rows, warehouse.ORDER_SCHEMA)


def test_fact_rules(spark):
    at = [dt.datetime(2025, 3, 10, h) for h in range(6)]
    dec = Decimal("5.00")
    staged = schema(
        [
            ("older valid", at[0], 1, 1, 2, dec, "USD", "NEW"),
            ("older valid", at[1], 1, 1, 0, dec, "USD", "NEW"),
            ("no time", at[2], 1, 1, 3, dec, "USD", "OLD"),
            ("no time", None, 1, 1, 4, dec, "USD", "LATEST"),
            ("euro", at[1], 1, 1, 1, dec, "EUR", "NEW"),
            ("no currency", at[1], 1, 1, 1, dec, None, "NEW"),
            ("no customer", at[1], None, 1, 1, dec, "USD", "NEW"),
            ("no product", at[1], 1, None, 1, dec, "USD", "NEW"),
            ("no quantity", at[1], 1, 1, None, dec, "USD", "NEW"),
        ],
        spark,
    )
    day = dt.date(2025, 3, 10)
    assert rows(warehouse.fact_orders(staged)) == [
        ("euro", at[1], day, 1, 1, 1, None, "EUR", True, "NEW"),
        ("no currency", at[1], day, 1, 1, 1, None, None, False, "NEW"),
        ("no time", None, None, 1, 1, 4, dec, "USD", False, "LATEST"),
    ]
    matched = warehouse.rowcount_match(staged, warehouse.fact_orders(staged))
    assert rows(matched) == [(None, 1, 1, True), (day, 2, 2, True)]


def fact(spark, base):
    found = spark.read.parquet(f"{base}/fact_orders")
    return rows(found.select("order_id", "order_date", "quantity", "total_amount_usd"))


def test_two_days_and_a_rerun(spark, folder):
    landing, base = f"{folder}/in", f"{folder}/dwh"
    many = [order(f"O{i}", f"{DAY}T10:00:0{i}") for i in range(9)]
    land(landing, DAY, [*many, order("bad", f"{DAY}T11:00:00", quantity=0)])
    found = warehouse.run_daily(spark, landing, base, DAY)
    assert found == {"customers": 1, "products": 1, "orders": 10, "low_volume": True}
    summary = spark.read.json(f"{base}/anomalies/low_volume_orders_{DAY}")
    assert rows(summary.select("order_count", "order_date", "threshold")) == [(9, DAY, 10)]
    first = fact(spark, base)
    assert len(first) == 9

    # Again, with one order changed and one from the day before: the day is
    # replaced, the other day's order is added once.
    late = order("LATE", "2025-03-09T23:00:00", amount="7.25")
    land(landing, DAY, [*many[1:], order("O0", f"{DAY}T12:00:00", quantity=6), late])
    for _ in range(2):
        warehouse.run_daily(spark, landing, base, DAY, min_orders=9)
        again = fact(spark, base)
        assert len(again) == 10
        assert ("O0", dt.date(2025, 3, 10), 6, Decimal("5.00")) in again
        assert ("LATE", dt.date(2025, 3, 9), 1, Decimal("7.25")) in again

    # The next day updates a customer, adds another and keeps the facts so far.
    customers = ("1,Ann,Ray,a@x.org,2024-01-05,IN", "2,Bo,Lee,b@x.org,2024-02-05,US")
    land(landing, "2025-03-11", [order("N1", "2025-03-11T09:00:00")], customers)
    warehouse.run_daily(spark, landing, base, "2025-03-11", min_orders=1)
    dimension = spark.read.parquet(f"{base}/dim_customers")
    assert rows(dimension.select("customer_id", "last_name", "country")) == [
        (1, "Ray", "IN"),
        (2, "Lee", "US"),
    ]
    assert len(fact(spark, base)) == 11


def test_day_that_became_empty_is_cleared(spark, folder):
    landing, base = f"{folder}/in", f"{folder}/dwh"
    land(landing, DAY, [order("A", f"{DAY}T10:00:00")])
    warehouse.run_daily(spark, landing, base, DAY)
    land(landing, DAY, [order("A", f"{DAY}T10:00:00", quantity=0)])
    assert warehouse.run_daily(spark, landing, base, DAY)["low_volume"]
    assert fact(spark, base) == []


def test_conflicting_customers_stop_before_writing(spark, folder):
    landing, base = f"{folder}/in", f"{folder}/dwh"
    two = ("1,Ann,Lee,a@x.org,2024-01-05,US", "1,Ann,Ray,a@x.org,2024-01-05,US")
    land(landing, DAY, [order("A", f"{DAY}T10:00:00")], two)
    with pytest.raises(DuplicateKeyError, match="customer_id"):
        warehouse.run_daily(spark, landing, base, DAY)
    assert not pathlib.Path(f"{base}/dim_customers").exists()


def test_empty_dimension_fails_the_checks(spark, folder):
    landing, base = f"{folder}/in", f"{folder}/dwh"
    land(landing, DAY, [order("A", f"{DAY}T10:00:00")], customers=())
    with pytest.raises(QualityError, match="dim_customers_not_empty"):
        warehouse.run_daily(spark, landing, base, DAY)


def test_a_failed_write_leaves_the_old_day(spark, folder):
    fact_path, day = f"{folder}/fact_orders", dt.datetime(2025, 3, 10, 9)
    staged = schema([("A", day, 1, 1, 2, Decimal("5.00"), "USD", "NEW")], spark)
    warehouse.load_fact_slice(spark, fact_path, warehouse.fact_orders(staged), DAY)
    before = rows(spark.read.parquet(fact_path))

    def fails(*args):
        raise OSError("no room")

    new = warehouse.fact_orders(schema([("B", day, 1, 1, 2, Decimal("5.00"), "USD", "NEW")], spark))
    for name in ("overwrite", "publish"):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(warehouse, name, fails)
            with pytest.raises(OSError, match="no room"):
                warehouse.load_fact_slice(spark, fact_path, new, DAY)
        assert rows(spark.read.parquet(fact_path)) == before
    with pytest.MonkeyPatch.context() as patch:
        moves = []

        def second_fails(session, source, target):
            moves.append(target)
            if len(moves) == 2:
                raise OSError("no room")
            return move_path(session, source, target)

        patch.setattr(swap, "move_path", second_fails)
        with pytest.raises(OSError, match="no room"):
            warehouse.load_fact_slice(spark, fact_path, new, DAY)
    assert len(moves) > 2 and rows(spark.read.parquet(fact_path)) == before
    warehouse.load_fact_slice(spark, fact_path, new, DAY)
    assert rows(spark.read.parquet(fact_path).select("order_id")) == [("B",)]


def test_a_dimension_whose_swap_was_left_half_done(spark, folder):
    kind = "customer_id int, name string"
    load = lambda r: warehouse.load_dimension(spark, folder, "dim", "customer_id", spark.createDataFrame(r, kind))
    load([(1, "Ann"), (2, "Bo")])
    # A writer died after it had moved the old table away.
    aside = pathlib.Path(folder) / f".old-dim-0-{'a' * 32}"
    aside.mkdir()
    (pathlib.Path(folder) / "dim").rename(aside / "t")
    (pathlib.Path(folder) / f".new-dim-{'b' * 32}").mkdir()
    assert load([(2, "Bea"), (3, "Cy")]) == 3
    assert rows(spark.read.parquet(f"{folder}/dim")) == [(1, "Ann"), (2, "Bea"), (3, "Cy")]
    assert [p.name for p in pathlib.Path(folder).iterdir()] == ["dim"]
