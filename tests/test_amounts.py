"""Numbers as received: judged as they are, multiplied without a cut."""

import random
from decimal import Decimal, getcontext

import pytest
from helpers import final_plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import exact_number
from tidewell.operators import quality
from tidewell.operators.amounts import add_amount
from tidewell.plans import sales
from tidewell.sources import read_csv_positional, read_json_lines

getcontext().prec = 120


@pytest.mark.parametrize(
    ("text", "kept"),
    [
        ("0.004", "0.004"), ("1.125", "1.125"), (" 7 ", "7"), ("-3.50", "-3.5"), ("1e3", "1000"), ("2.5E-3", "0.0025"),
        ("0.000000004", "4e-9"), ("0.000000000000000001", "1e-18"), ("0.1000000000000000000000", "0.1"),
        ("9999999999999999999", "9999999999999999999"), ("x", None), ("", None), (None, None), ("1,5", None),
        # What does not fit is not rounded to what does.
        ("0.0000000000000000001", None), ("1.0000000000000000001", None), ("1e-19", None), ("99999999999999999999", None),
    ],
)
def test_texts_keep_their_digits(spark, text, kept):
    found = spark.createDataFrame([(text,)], "t string").select(exact_number("t", "string").alias("n")).first().n
    assert found == (None if kept is None else Decimal(kept))


def test_doubles_and_decimals(spark):
    one = lambda v, kind: spark.createDataFrame([(v,)], f"t {kind}").select(exact_number("t", kind)).first()[0]
    assert one(0.1, "double") == Decimal("0.1") and one(1e-30, "double") is None and one(1e30, "double") is None
    assert one(float("nan"), "double") is None and one(7, "bigint") == 7
    assert one(Decimal("1.5"), "decimal(38,30)") == Decimal("1.5")
    assert one(Decimal("1e-30"), "decimal(38,30)") is None and one(Decimal(10) ** 25, "decimal(38,2)") is None


def test_products_against_decimals(spark):
    rng, made = random.Random(5), []

    def number():
        digits, places = rng.randint(1, 18), rng.randint(0, 18)
        return str(Decimal(rng.randint(-(10**digits), 10**digits)).scaleb(-places))

    for _ in range(3000):
        made.append((number(), number(), number()))
    made += [("0.004", "1000", "0"), ("1.125", "1000", "0"), (None, "1", "1"), ("1", "1", None), ("0.000000001", "0.000000001", "0")]
    found = add_amount(spark.createDataFrame(made, "q string, p string, d string"), ("q", "p"), "d", "amount").collect()
    held = 0
    for r in found:
        want = None
        if None not in (r.q, r.p, r.d):
            want = Decimal(r.q) * Decimal(r.p) - Decimal(r.d)
            if want != round(want, 18) or abs(want) >= 10**19:
                want = None
        # An intermediate sum may be over the limit where the result is just below; nothing else may differ.
        if r.amount != want:
            assert r.amount is None and abs(Decimal(r.q) * Decimal(r.p)) >= 10**18
        held += r.amount is not None
    assert held > 500


def received(spark, made):
    kind = "transaction_id string, transaction_date string, product_id string, store_id string, quantity string, unit_price string, discount string"
    return spark.createDataFrame([(k, "2024-01-02", "P", "S", *numbers) for k, *numbers in made], kind)


def test_small_and_broken_quantities_are_valid(spark):
    stores = spark.createDataFrame([("S",)], "store_id string")
    made = [
        ("small", "0.004", "1000", "0"), ("broken", "1.125", "1000", "0"), ("cheap", "3", "0.000000004", "0"),
        ("zero", "0.000", "5", "0"), ("long", "0.0000000001", "0.0000000001", "0"), ("none", "2", "3", None),
    ]
    good = {r.transaction_id: r.correct_total for r in sales.silver_valid(received(spark, made), stores).collect()}
    assert good == {"small": 4, "broken": 1125, "cheap": Decimal("1.2e-8"), "none": None}
    bad = sales.silver_quarantine(received(spark, made), stores)
    assert rows(bad.select("transaction_id", "reject_reason")) == [("long", "correct_total"), ("zero", "quantity")]


def test_gold_tables_read_silver_once(spark, folder):
    made = [(i % 7, i % 3, i % 5, Decimal(i) / 8) for i in range(100)]
    kind = "transaction_date int, store_id int, product_id int, correct_total decimal(37,18)"
    dated = spark.createDataFrame(made, kind).withColumn("transaction_date", F.date_add(F.lit("2024-01-01"), F.col("transaction_date")))
    dated.write.parquet(f"{folder}/silver")
    silver = spark.read.parquet(f"{folder}/silver")
    sums = sales.presummed(silver)
    assert final_plan(sums).count("FileScan") == 1
    stores = spark.createDataFrame([(0, "N"), (1, "S")], "store_id int, region string")
    for whole, part in (
        (sales.daily_sales(silver), sales.daily_sales(sums)),
        (sales.monthly_region(silver, stores), sales.monthly_region(sums, stores)),
    ):
        assert rows(whole) == rows(part)


def test_low_volume_days_group_once(spark, folder):
    days = spark.range(40).filter("id % 9 > 3").select(F.date_add(F.lit("2024-02-20"), F.col("id").cast("int")).alias("d"))
    days.union(days.filter("day(d) % 2 = 0")).write.parquet(f"{folder}/t")
    found = quality.low_volume_days(spark.read.parquet(f"{folder}/t"), "d", 2)
    assert final_plan(found).count("FileScan") == 1
    counts = {r.d: r.n for r in spark.read.parquet(f"{folder}/t").groupBy("d").agg(F.count("*").alias("n")).collect()}
    first, last = min(counts), max(counts)
    calendar = [first + (last - first) / (last - first).days * i for i in range((last - first).days + 1)]
    assert {r.order_date: r.order_count for r in found.collect()} == {d: counts.get(d, 0) for d in calendar if counts.get(d, 0) < 2}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_field_that_does_not_fit_fails_the_load(spark, tmp_path, ansi):
    schema = T.StructType().add("k", "integer").add("day", "date")
    csv, json = tmp_path / "c.csv", tmp_path / "j.json"
    csv.write_text("k,day\n1,2024-01-02\nbad, 2024-01-03\n")
    json.write_text('{"k": 1, "day": null}\n{"k": 2, "day": "soon"}\n')
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="k is no int in .*c.csv: bad, 2024-01-03"):
            read_csv_positional(spark, str(csv), schema).collect()
        with pytest.raises(PySparkException, match="day is no date in .*j.json"):
            read_json_lines(spark, str(json), schema).collect()
        csv.write_text("k,day\n1,2024-01-02\n")
        assert read_csv_positional(spark, str(csv), schema).count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
