"""What has to hold on a cluster with skewed data, read from the plans."""

import contextlib
import pathlib
import re

import pytest
from helpers import final_plan, plan, rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidewell.queries import all_queries
from tidewell.functions import MONEY
from tidewell.operators import changes, keys, preview, rollups, sets, stats, validity
from tidewell.plans import pos, taxi
from tidewell.session import fresh_path, materialized, path_exists, tune_for, working_folder

SMALL = "/root/testdata/sf0.001"
PACKAGE = pathlib.Path(contract.__file__).parent / "tidewell"


@contextlib.contextmanager
def settings(spark, **values):
    named = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    try:
        for k, v in named.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def large_sides(spark):
    """As with tables far over the broadcast limit, at a size tests can bear."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
    )


def skewed(spark, n=60000):
    """A third of the rows has one key."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"),
        F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("padding"),
    )


def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark):
    bad = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow")
    for name, build in all_queries().items():
        assert not bad.search(plan(build(spark, SMALL))), name


def test_source_has_no_unchecked_broadcast_or_local_copy():
    text = "\n".join(p.read_text() for p in PACKAGE.rglob("*.py") if "llm" not in p.parts)
    for word in ("broadcast(", "localCheckpoint", "crossJoin", "toPandas", ".rdd", "@udf", "pandas_udf"):
        assert word not in text, word


def test_latest_row_is_reduced_before_the_shuffle(spark):
    text = final_plan(keys.latest_per_key(skewed(spark), ["k"], [F.desc("v")]))
    below = text.split("Exchange hashpartitioning(k")[1]
    assert "row_number(), 1, Partial" in below
    # 8 tasks hold 5000 keys each: at most that many rows are shuffled, not 60,000.
    found = keys.latest_per_key(skewed(spark), ["k"], [F.desc("v")])
    assert found.count() == 5000
    assert rows(found.filter("k = 7").select("v")) == [(59997,)]


def test_rollup_adds_up_before_the_join(spark):
    fact = skewed(spark).withColumn("amount", F.lit("1.5").cast(MONEY))
    dimension = spark.range(5000).select(
        F.col("id").alias("k"), (F.col("id") % 3).alias("group")
    )
    with large_sides(spark):
        found = rollups.sum_by_attribute(fact, dimension, "k", [], ["group"], "amount", "total")
        text = final_plan(found)
    join = text.split("Join")[1]
    assert "partial_sum" in join
    assert sum(r.total for r in found.collect()) == 90000.0


@pytest.mark.parametrize("shape", ["membership", "keep", "merge", "merge_copies"])
def test_a_hot_key_is_split_in_joins(spark, shape):
    left = skewed(spark)
    right = spark.range(2500).select(
        F.col("id").alias("k"), F.col("id").alias("v"), F.lit("new").alias("padding")
    )
    with large_sides(spark):
        if shape == "membership":
            found = validity.add_membership(left, right.select("k"), "k", "ok").filter("ok")
        elif shape == "keep":
            found = validity.keep_members(left, right.select("k"), "k")
        elif shape == "merge":
            found = changes.merge_upsert(left, right.filter("k <> 7"), ["k"])
        else:
            found = changes.merge_upsert(left, right, ["k"], unique_target=False)
        assert "skew=true" in final_plan(found)
        count = found.count()
    if shape in ("membership", "keep"):
        assert count == left.filter("k < 2500").count()
    elif shape == "merge":
        assert count == left.filter("k >= 2500 OR k = 7").count() + 2499
    else:
        assert count == 60000


def test_small_sides_are_broadcast_by_their_size(spark):
    right = spark.range(100).select(F.col("id").alias("k"))
    text = final_plan(validity.keep_members(skewed(spark), right, "k"))
    assert "BroadcastHashJoin" in text and "hint" not in text


def test_copies_are_merged_before_set_operations_shuffle(spark):
    copies = spark.range(0, 60000, 1, 8).select(F.lit(1).alias("k"))
    with large_sides(spark):
        found = sets.except_rows(copies, spark.range(5).select((F.col("id") + 10).cast("int").alias("k")))
        text = final_plan(found)
    for part in text.split("Exchange hashpartitioning")[1:]:
        assert "HashAggregate" in part.split("Exchange")[0]
    assert rows(found) == [(1,)]


def test_mean_fill_scans_once(spark):
    made = spark.range(1000).select(
        F.lit("s").alias("store_name"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 50).cast("decimal(18,2)").alias("total"),
        F.col("id").alias("customer_id"),
        F.lit("p").alias("promo_code"),
    )
    path = fresh_path(spark, "scan-once")
    made.write.parquet(path)
    text = final_plan(pos.clean(spark.read.parquet(path)))
    assert "ReusedExchange" in text


def test_best_rides_are_found_without_a_full_sort(spark):
    trips = contract.queries()["flagged_rides"](spark, SMALL)
    weekly = contract.queries()["weekly_stats"](spark, SMALL)
    text = final_plan(taxi.top_rides(trips, weekly, 3))
    assert text.count("TakeOrderedAndProject") == 2
    assert "rangepartitioning" not in text.split("TakeOrderedAndProject")[-1]
    assert "TakeOrderedAndProject" in plan(preview.last_n(spark.range(10), ["id"], 3))


def test_only_needed_columns_are_read(spark):
    text = plan(contract.queries()["gold_daily_sales"](spark, SMALL))
    scan = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("l_orderkey" in s and "l_tax" not in s and "l_returnflag" not in s for s in scan)
    daily = plan(contract.queries()["id_range"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in daily
    bulk = plan(contract.queries()["except_rows"](spark, SMALL))
    assert "GreaterThan(l_quantity,45.0)" in bulk


def test_search_of_the_median_keeps_few_rows_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(stats, "SEARCH_STEPS", 16)
    df = spark.range(20001).select((F.col("id") * F.col("id")).cast("decimal(18,2)").alias("a"))
    assert stats.amount_stats(df, "a").first().median == 100000000.0


def test_intermediate_tables(spark):
    with materialized(spark.range(5), "five") as five:
        path = re.sub(r"/[^/]*$", "", five.inputFiles()[0])
        bare = [re.sub("^file:/+", "/", p) for p in (path, working_folder(spark))]
        assert bare[0].startswith(bare[1])
        assert path_exists(spark, path) and five.count() == 5
    assert not path_exists(spark, path)


def test_tuning(spark):
    with settings(spark, spark__sql__shuffle__partitions=8, spark__sql__files__maxPartitionBytes="128MB"):
        for size, expected in ((10**9, "8"), (10**12, "4769"), (10**14, "476838")):
            tune_for(spark, size)
            assert spark.conf.get("spark.sql.shuffle.partitions") == expected
