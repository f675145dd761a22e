import datetime as dt
import random
import statistics
from fractions import Fraction
from decimal import Decimal

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tidewell.functions import day_name, fill_text, keep_domain, ratio, to_utc, trimmed, week_start
from tidewell.operators import preview, quality, stats
from tidewell.operators.audit import LOG_SCHEMA, AuditLog


def test_report_and_enforce(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    checks = quality.report(
        quality.not_empty(df, "has rows"),
        quality.not_empty(df.filter("a > 9"), "has large"),
        quality.bad_rows(df, {"a": F.col("a").isNull(), "small": F.col("b") < 0}),
    )
    assert rows(checks) == [
        ("a", 1, False),
        ("has large", 1, False),
        ("has rows", 0, True),
        ("small", 0, True),
    ]
    with pytest.raises(quality.QualityError, match=r"has large \(1\)"):
        quality.enforce(checks)
    quality.enforce(quality.not_empty(df, "has rows"))


def test_count_match_with_null_and_one_sided_days(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "d string")
    b = spark.createDataFrame([("x",), ("x",), (None,), ("z",)], "d string")
    assert rows(quality.count_match(a, b, "d")) == [
        (None, 1, 1, True),
        ("x", 2, 2, True),
        ("y", 1, 0, False),
        ("z", 0, 1, False),
    ]


def days(spark, counts):
    made = [(dt.date(2025, 1, d),) for d, n in counts.items() for _ in range(n)]
    return spark.createDataFrame([*made, (None,)], "d date")


def test_low_volume_days(spark):
    df = days(spark, {1: 10, 2: 9, 4: 12})
    found = quality.low_volume_days(df, "d", 10)
    assert rows(found.select("order_date", "order_count")) == [
        (dt.date(2025, 1, 2), 9),
        (dt.date(2025, 1, 3), 0),
    ]
    assert quality.low_volume_days(df.filter("false"), "d", 10).count() == 0


def test_low_volume_on_a_day(spark):
    df = days(spark, {1: 10, 2: 9})
    assert quality.low_volume_on(df, "d", "2025-01-01", 10).count() == 0
    for day, n in (("2025-01-02", 9), ("2025-01-03", 0)):
        assert rows(quality.low_volume_on(df, "d", day, 10)) == [
            (dt.date.fromisoformat(day), n, 10, quality.LOW_VOLUME_MESSAGE)
        ]


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 1001])
@pytest.mark.parametrize("spread", [3, 10**6, 10**11])
def test_amount_stats(spark, n, spread):
    pick = random.Random(n * spread)
    cents = [pick.randint(-spread, spread) for _ in range(n)]
    df = spark.createDataFrame([(Decimal(c) / 100,) for c in cents] + [(None,)], "a decimal(18,2)")
    mean, median, total, basket = stats.amount_stats(df, "a").first()
    assert total == pytest.approx(sum(cents) / 100, rel=1e-14, abs=1e-9)
    assert mean == basket == pytest.approx(sum(cents) / 100 / n, rel=1e-12, abs=1e-9)
    assert median == pytest.approx(statistics.median(cents) / 100, rel=1e-12, abs=1e-9)


def test_amount_stats_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([(None,)], "a decimal(18,2)")
    assert rows(stats.amount_stats(empty, "a")) == [(None, None, None, None)]
    same = spark.range(1000).select(F.lit("2.50").cast("decimal(18,2)").alias("a"))
    assert rows(stats.amount_stats(same, "a")) == [(2.5, 2.5, 2500.0, 2.5)]


@pytest.mark.parametrize("kind", ["double", "decimal(38,18)", "decimal(38,0)", "bigint", "float"])
def test_median_at_any_scale(spark, kind):
    rng = random.Random(kind)
    for n in (2, 3, 10, 501, 2000):
        if kind in ("double", "float"):
            made = [rng.choice([-1, 1]) * 10.0 ** rng.randint(-30, 30) * rng.random() for _ in range(n)] + [0.0] * (n % 3)
            made += [float("nan"), None]
        elif kind == "decimal(38,18)":
            made = [Decimal(f"{rng.randint(-(10**digits), 10**digits)}e-18") for digits in rng.choices(range(1, 37), k=n)]
        else:
            made = [rng.choice([-1, 1]) * rng.randint(0, 10 ** rng.randint(1, 18)) for _ in range(n)]
            made = [Decimal(m) for m in made] if "dec" in kind else made
        df = spark.createDataFrame([(m,) for m in made], f"a {kind}")
        kept = sorted(r.a for r in df.collect() if r.a is not None and r.a == r.a)
        found = stats.amount_stats(df.repartition(3), "a").first()
        assert found.median == pytest.approx(float(statistics.median(kept)), rel=1e-15, abs=0)
        assert found.sum == pytest.approx(float(sum(map(Fraction, kept))), rel=1e-12)


def test_sums_far_apart_and_extremes(spark):
    stat = lambda kind, *v: stats.amount_stats(spark.createDataFrame([(x,) for x in v], f"a {kind}"), "a").first()
    apart = stat("decimal(38,18)", Decimal("2e16"), Decimal("1e-7"), Decimal("-2e16"))
    assert apart.sum == 1e-7 and apart.median == 1e-7
    assert stat("double", 2e16, 1e-7, -2e16).sum == 1e-7
    assert stat("double", 1.7e308, -1.7e308, 1e308).median == 1e308
    assert stat("double", 5e-324, 1e-323, 1.5e-323).median == 1e-323
    assert stat("double", float("inf"), 1.0, 2.0).median == 2.0
    assert stat("decimal(18,2)", Decimal("123456789012345.67"), Decimal("1.00")).median == 61728394506173.335


def test_search_of_the_median_writes_nothing(spark, monkeypatch, folder):
    spark.range(5000).select((F.col("id") * 7 % 4999).cast("decimal(18,5)").alias("a")).write.parquet(f"{folder}/t")
    monkeypatch.setattr(stats, "SEARCH_STEPS", 16)
    plans = []
    original = stats._step_at
    monkeypatch.setattr(stats, "_step_at", lambda *a: (plans.append(plan(original(*a))), original(*a))[1])
    assert stats.amount_stats(spark.read.parquet(f"{folder}/t"), "a").first().median == 2498.5
    assert len(plans) > 2 and not any("Write" in p for p in plans)


def test_describe_categorical(spark):
    df = spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "s string")
    assert rows(stats.describe_categorical(df, "s")) == [(3, 2, "c", 2)]
    tie = spark.createDataFrame([("b",), ("a",)], "s string")
    assert rows(stats.describe_categorical(tie, "s")) == [(2, 2, "a", 1)]
    assert rows(stats.describe_categorical(df.filter("false"), "s")) == [(0, 0, None, None)]


def test_table_descriptions(spark):
    df = spark.createDataFrame([(1, "x"), (5, None), (3, None)], "id int, s string")
    assert rows(stats.null_counts(df)) == [("id", 0), ("s", 2)]
    assert rows(stats.table_info(df)) == [("id", "int", 3), ("s", "string", 1)]
    assert rows(stats.table_shape(df)) == [(3, 2)]
    assert rows(stats.id_range(df, "id")) == [(1, 5)]
    totals = spark.createDataFrame([("a", 1.5), ("a", 2.5), (None, 9.0)], "s string, t double")
    assert rows(stats.total_by(totals, "s", "t")) == [("a", 4.0)]


def test_previews(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in preview.first_n(df, ["id"], 3).collect()] == [0, 1, 2]
    assert [r.id for r in preview.last_n(df, ["id"], 3).collect()] == [99, 98, 97]
    mixed = [r.id for r in preview.shuffle_rows(df, ["id"], 42).collect()]
    assert sorted(mixed) == list(range(100)) and mixed != sorted(mixed)
    assert mixed == [r.id for r in preview.shuffle_rows(df.repartition(3), ["id"], 42).collect()]
    assert mixed != [r.id for r in preview.shuffle_rows(df, ["id"], 43).collect()]


def test_expressions(spark):
    df = spark.createDataFrame(
        [("2024-01-07 10:00:00", " \t a b\r", "b"), ("2024-01-08 00:00:00", None, "z")],
        "at string, s string, c string",
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    found = df.select(
        week_start("at"),
        day_name("at"),
        trimmed("s"),
        keep_domain("c", ["b", "a", "c"]),
        fill_text("s", "none"),
        ratio(F.lit(1), F.lit(0)),
        to_utc("at", "Asia/Kolkata"),
        to_utc("at"),
    )
    sunday, monday = dt.datetime(2024, 1, 7, 10), dt.datetime(2024, 1, 8)
    half_past_five = dt.timedelta(hours=5, minutes=30)
    assert rows(found) == [
        (dt.date(2024, 1, 1), "Sunday", "a b", "b", " \t a b\r", None, sunday - half_past_five, sunday),
        (dt.date(2024, 1, 8), "Monday", None, None, "none", None, monday - half_past_five, monday),
    ]


def test_week_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-31 02:30:00' AS at")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert df.select(week_start("at")).first()[0] == dt.date(2024, 3, 25)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_audit_log(spark, folder):
    log = AuditLog(spark, f"{folder}/log")
    assert log.step("silver", "work", lambda: {"n_rows": 5, "n_rejected": 2})["n_rows"] == 5

    def fail():
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError, match="broken"):
        log.step("gold", "work", fail)
    again = AuditLog(spark, f"{folder}/log")
    again.event("bronze", "work", "START", 0, "RUNNING")
    assert log.read().schema == LOG_SCHEMA
    events = log.read().select(
        "pipeline_layer", "event_type", "record_count", "status", "error_message"
    )
    assert rows(events) == [
        ("bronze", "START", 0, "RUNNING", None),
        ("gold", "ERROR", 0, "FAILED", "broken"),
        ("gold", "START", 0, "RUNNING", None),
        ("silver", "END", 5, "SUCCESS", None),
        ("silver", "REJECTED", 2, "SUCCESS", None),
        ("silver", "START", 0, "RUNNING", None),
    ]
    assert log.read().select("run_id").distinct().count() == 2
    assert log.read().filter("event_timestamp IS NULL").count() == 0
