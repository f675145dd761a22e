import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidewell.operators import changes, keys, sets
from tidewell.operators.validity import (
    add_membership,
    add_verdict,
    expectation_counts,
    keep_members,
)


def test_latest_null_time_wins_and_ties_are_settled(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "y"), ("b", 2, "z"), ("b", 2, "w"), ("c", 1, None), ("c", 1, "q")],
        "k string, at int, v string",
    )
    for shuffled in (df, df.repartition(5), df.orderBy(F.desc("v"))):
        found = keys.latest_per_key(shuffled, ["k"], [F.desc_nulls_first("at")])
        assert rows(found) == [("a", None, "y"), ("b", 2, "w"), ("c", 1, None)]


def test_duplicate_keys_ignore_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert rows(keys.duplicate_keys(df, ["k"])) == [(1, 2)]
    keys.require_unique(df.filter("k = 2 OR k IS NULL"), ["k"])
    with pytest.raises(keys.DuplicateKeyError, match=r"\(1,\)"):
        keys.require_unique(df, ["k"])
    keys.require_unique(df, ["k"], within=spark.createDataFrame([(2,)], "k int"))
    with pytest.raises(keys.DuplicateKeyError):
        keys.require_unique(df, ["k"], within=spark.createDataFrame([(1,)], "k int"))


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 10), (2, "b", None), (3, None, 30)], "id int, s string, n int"
    )


def test_update_null_is_untouched_and_sees_old_values(table):
    changed = changes.update_where(table, F.col("n") > 5, {"n": F.col("id"), "id": F.col("n")})
    assert rows(changed) == [(10, "a", 1), (2, "b", None), (30, None, 3)]


def test_delete_keeps_null(table):
    assert rows(changes.delete_where(table, F.col("n") > 5)) == [(2, "b", None)]


def test_append_evolved(spark, table):
    new = spark.createDataFrame([(4, "x")], "id int, extra string")
    assert rows(changes.append_evolved(table, new)) == [
        (1, "a", 10, None),
        (2, "b", None, None),
        (3, None, 30, None),
        (4, None, None, "x"),
    ]


def test_merge(spark, table):
    source = spark.createDataFrame(
        [(3, "c", None), (4, "d", 40), (None, "e", 0)], "id int, s string, n int"
    )
    expected = [(None, "e", 0), (1, "a", 10), (2, "b", None), (3, "c", None), (4, "d", 40)]
    once = changes.merge_upsert(table, source, ["id"])
    assert rows(once) == expected
    # A NULL key matches nothing, so it comes in again.
    twice = changes.merge_upsert(once, source, ["id"])
    assert rows(twice) == sorted([*expected, (None, "e", 0)], key=lambda t: (t[0] is not None, str(t)))
    assert rows(changes.merge_upsert(table, source, ["id"], unique_target=False)) == expected


def test_merge_updates_every_copy_when_the_target_repeats_keys(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "id int, s string")
    source = spark.createDataFrame([(1, "new"), (3, "d"), (None, "m")], "id int, s string")
    merged = changes.merge_upsert(target, source, ["id"], unique_target=False)
    assert rows(merged) == [
        (None, "m"),
        (None, "n"),
        (1, "new"),
        (1, "new"),
        (2, "c"),
        (3, "d"),
    ]


def test_merge_two_sources_for_one_row(spark, table):
    clash = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "id int, s string, n int")
    with pytest.raises(keys.DuplicateKeyError):
        changes.merge_upsert(table, clash, ["id"])
    unmatched = spark.createDataFrame([(9, "x", 1), (9, "y", 2)], "id int, s string, n int")
    assert changes.merge_upsert(table, unmatched, ["id"]).count() == 5


def test_upsert_dimension(spark, table):
    same_twice = spark.createDataFrame([(1, "z", 1), (1, "z", 1), (5, "e", 5)], table.schema)
    assert rows(changes.upsert_dimension(table, same_twice, ["id"])) == [
        (1, "z", 1),
        (2, "b", None),
        (3, None, 30),
        (5, "e", 5),
    ]
    clash = spark.createDataFrame([(8, "x", 1), (8, "y", 1)], table.schema)
    with pytest.raises(keys.DuplicateKeyError, match="8"):
        changes.upsert_dimension(table, clash, ["id"])


def test_replace_slice_twice_is_the_same(spark):
    def day(n):
        return dt.date(2025, 1, n)

    schema = "order_id string, day date, q int"
    target = spark.createDataFrame(
        [("a", day(1), 1), ("b", day(2), 1), ("c", None, 1)], schema
    )
    incoming = spark.createDataFrame(
        [("a2", day(1), 5), ("b", day(2), 9), ("d", day(3), 2), ("c", None, 7)], schema
    )
    first = F.lit("2025-01-01").cast("date")
    once = changes.replace_slice(target, incoming, "day", first, "order_id")
    expected = [("a2", day(1), 5), ("b", day(2), 1), ("c", None, 1), ("d", day(3), 2)]
    assert rows(once) == expected
    assert rows(changes.replace_slice(once, incoming, "day", first, "order_id")) == expected
    emptied = changes.replace_slice(once, incoming.filter("false"), "day", first, "order_id")
    assert rows(emptied) == expected[1:]


def test_sets(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (2,)], "k int")
    assert rows(sets.except_rows(left, right)) == [(None,), (1,)]
    assert rows(sets.except_rows(left, spark.createDataFrame([(None,)], "k int"))) == [(1,), (2,)]
    assert sets.union_rows(left, right).count() == 7


def test_verdict_null_is_rejected(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (None, 1), (1, None)], "a int, b int")
    judged = add_verdict(df, {"a": F.col("a") > 0, "b": F.col("b") > 0})
    assert rows(judged) == [
        (None, 1, "a", False),
        (0, 0, "a", False),
        (1, None, "b", False),
        (1, 1, None, True),
    ]


def test_membership(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "s string")
    members = spark.createDataFrame([("x",), ("x",), (None,)], "m string")
    assert rows(add_membership(df, members, "s", "ok")) == [
        (None, False),
        ("x", True),
        ("y", False),
    ]
    assert rows(keep_members(df, members, "s")) == [("x",)]


def test_expectation_counts(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "d double")
    assert rows(expectation_counts(df, F.col("d") > 0)) == [(4, 3, 1)]


def test_rows_without_a_key_are_added_to_other_days_once(spark):
    schema = "day string, id int"
    target = spark.createDataFrame([("b", 1)], schema)
    incoming = spark.createDataFrame([("a", 5), ("b", None), ("b", 1), ("b", 2)], schema)
    for _ in range(3):
        target = spark.createDataFrame(
            changes.replace_slice(target, incoming, "day", F.lit("a"), "id").collect(), schema
        )
        assert rows(target) == [("a", 5), ("b", None), ("b", 1), ("b", 2)]
