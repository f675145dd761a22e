import pathlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from helpers import final_plan, rows
from pyspark.sql import functions as F

from tidewell.operators import layout
from tidewell.operators.versions import VersionedTable
from tidewell.session import path_bytes


def orders(spark):
    return spark.createDataFrame(
        [
            (1, "US", "NEW", 10.0),
            (2, "US", "PAID", 200.0),
            (3, "IN", "NEW", 30.0),
            (4, "IN", None, 40.0),
            (5, None, "NEW", 50.0),
        ],
        "id int, country string, status string, amount double",
    )


@pytest.fixture
def table(spark, folder):
    made = VersionedTable(spark, f"{folder}/orders", ["country"])
    assert made.create(orders(spark)) == 5
    return made


def slices(folder, version):
    place = pathlib.Path(f"{folder}/orders/data/_version={version}")
    return sorted(p.parent.name for p in place.glob("*/country=*/*.parquet"))


def test_versions_stay_readable(spark, table, folder):
    assert table.update(F.col("status") == "NEW", {"status": F.lit("PAID")}) == 3
    evolved = spark.createDataFrame(
        [(6, "IN", "NEW", 5.0, "CARD")],
        "id int, country string, status string, amount double, method string",
    )
    assert table.append(evolved) == 1
    assert table.delete(F.col("amount") < 20) == 2
    assert table.compact() == 4

    assert rows(table.as_of(0)) == rows(orders(spark))
    assert table.as_of(0).columns == ["id", "country", "status", "amount"]
    assert rows(table.as_of(1).select("id", "status")) == [
        (1, "PAID"),
        (2, "PAID"),
        (3, "PAID"),
        (4, None),
        (5, "PAID"),
    ]
    assert rows(table.as_of(2).select("id", "method")) == [
        (1, None),
        (2, None),
        (3, None),
        (4, None),
        (5, None),
        (6, "CARD"),
    ]
    assert rows(table.as_of(3).select("id")) == [(2,), (3,), (4,), (5,)]
    assert rows(table.current()) == rows(table.as_of(3))
    assert rows(table.history().select("version", "operation", "n_rows")) == [
        (0, "WRITE", 5),
        (1, "UPDATE", 3),
        (2, "APPEND", 1),
        (3, "DELETE", 2),
        (4, "COMPACT", 4),
    ]
    assert table.latest_version() == 4
    with pytest.raises(ValueError, match="no version 5"):
        table.as_of(5)
    with pytest.raises(ValueError, match="exists"):
        table.create(orders(spark))


def test_only_touched_partitions_are_rewritten(table, folder):
    table.update(F.col("id") == 3, {"status": F.lit("PAID")})
    assert slices(folder, 1) == ["country=IN"]
    table.update(F.col("id") == 99, {"status": F.lit("PAID")})
    assert slices(folder, 2) == []
    assert table.current().count() == 5
    with pytest.raises(ValueError, match="partition columns"):
        table.update(F.col("id") == 1, {"country": F.lit("CA")})


def test_partition_deleted_whole(table):
    assert table.delete(F.col("country") == "US") == 2
    assert rows(table.current().select("id")) == [(3,), (4,), (5,)]
    assert table.as_of(0).count() == 5


def test_null_partition_can_be_changed(table):
    assert table.update(F.col("country").isNull(), {"amount": F.lit(0.0)}) == 1
    assert rows(table.current().filter("amount = 0").select("id", "country")) == [(5, None)]


def test_merge_moves_a_row_to_its_new_partition(spark, table):
    source = spark.createDataFrame(
        [(1, "IN", "MOVED", 1.0), (9, "CA", "NEW", 9.0)], orders(spark).schema
    )
    assert table.merge(source, ["id"]) == 2
    assert rows(table.current().select("id", "country", "status")) == [
        (1, "IN", "MOVED"),
        (2, "US", "PAID"),
        (3, "IN", "NEW"),
        (4, "IN", None),
        (5, None, "NEW"),
        (9, "CA", "NEW"),
    ]


def test_unfinished_change_is_not_seen(spark, table, folder):
    stray = f"{folder}/orders/data/_version=1/_slice=v1-0"
    orders(spark).write.partitionBy("country").parquet(stray)
    assert table.current().count() == 5
    assert table.delete(F.col("id") == 1) == 1
    assert rows(table.current().select("id")) == [(2,), (3,), (4,), (5,)]


def test_reads_skip_replaced_folders(table):
    table.update(F.col("country") == "IN", {"amount": F.lit(1.0)})
    text = final_plan(table.as_of(1))
    assert "dynamicpruning" in text
    assert "PartitionFilters: [isnotnull(_version" in text


def test_a_change_reads_no_other_partition(table, folder):
    """Everything but one country's files is made unreadable."""
    for part in pathlib.Path(f"{folder}/orders/data").rglob("*.parquet"):
        if part.parent.name != "country=IN":
            part.write_bytes(b"no parquet")
    india = F.col("country") == "IN"
    assert table.update(india & (F.col("status") == "NEW"), {"amount": F.lit(1.0)}) == 1
    assert table.update(india, {"status": F.lit("DONE")}) == 2
    assert table.delete(india & (F.col("amount") > 30)) == 1
    assert rows(table.current().filter(india).select("id", "status", "amount")) == [(3, "DONE", 1.0)]


def test_partition_column_is_needed(spark, folder):
    with pytest.raises(ValueError, match="partition column"):
        VersionedTable(spark, folder, [])


def test_text_partition_values_keep_their_type(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", ["code"])
    table.create(spark.createDataFrame([("01", 1), ("1", 2)], "code string, n int"))
    assert rows(table.current().select("code", "n")) == [("01", 1), ("1", 2)]


def many_files(spark, path):
    df = spark.range(4000).select(
        F.pmod(F.xxhash64("id"), F.lit(500)).alias("customer"),
        F.when(F.col("id") % 10 < 7, "US").otherwise("IN").alias("country"),
        F.col("id").alias("id"),
    )
    df.repartition(20).write.partitionBy("country").parquet(path)


def test_compact(spark, folder):
    many_files(spark, f"{folder}/a")
    layout.compact(spark, f"{folder}/a", f"{folder}/b", ["country"])
    before = layout.file_inventory(spark, f"{folder}/a", ["country"])
    after = layout.file_inventory(spark, f"{folder}/b", ["country"])
    assert rows(before.select("country", "n_rows")) == rows(after.select("country", "n_rows"))
    assert rows(before.select("n_files")) == [(20,), (20,)]
    assert rows(after.select("n_files")) == [(1,), (1,)]
    assert rows(spark.read.parquet(f"{folder}/a")) == rows(spark.read.parquet(f"{folder}/b"))
    assert rows(layout.file_inventory(spark, f"{folder}/b").select("n_files", "n_rows")) == [(2, 4000)]


def test_cluster_narrows_files(spark, folder):
    many_files(spark, f"{folder}/a")
    size = path_bytes(spark, f"{folder}/a")
    layout.cluster(spark, f"{folder}/a", f"{folder}/b", "customer", file_bytes=size // 10)
    ranges = []
    for part in pathlib.Path(f"{folder}/b").glob("*.parquet"):
        column = pq.read_table(part, columns=["customer"]).column("customer").to_pylist()
        assert column == sorted(column)
        ranges.append((min(column), max(column)))
    ranges.sort()
    assert len(ranges) >= 8
    # Neighbouring files share at most the customer they were cut at.
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    columns = ["customer", "country", "id"]
    again = spark.read.parquet(f"{folder}/b").select(*columns)
    assert rows(again) == rows(spark.read.parquet(f"{folder}/a").select(*columns))


def test_cluster_cuts_a_hot_value(spark, folder):
    hot = spark.range(4000).select(
        F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("customer"), F.lit("x").alias("v")
    )
    hot.repartition(4).write.parquet(f"{folder}/a")
    size = path_bytes(spark, f"{folder}/a")
    layout.cluster(spark, f"{folder}/a", f"{folder}/b", "customer", file_bytes=size // 8)
    sizes = [pq.read_metadata(p).num_rows for p in pathlib.Path(f"{folder}/b").glob("*.parquet")]
    assert sum(sizes) == 4000
    assert max(sizes) < 4000 / 3


def test_cluster_bounds_what_a_task_sorts(spark, folder, monkeypatch):
    """Rows that a file packs to almost nothing are as large as ever in the task that sorts them."""
    packed = spark.range(4000).select(
        (F.col("id") % 400).alias("customer"),
        F.lit("v" * 1000).alias("v"),
        F.array(F.lit("w" * 1000)).alias("w"),
        F.lit(None).cast("string").alias("nothing"),
    )
    packed.repartition(4).write.parquet(f"{folder}/a")
    assert path_bytes(spark, f"{folder}/a") < 200_000
    monkeypatch.setattr(layout, "SORT_BYTES", 1_000_000)
    layout.cluster(spark, f"{folder}/a", f"{folder}/b", "customer")
    sizes = [pq.read_metadata(p).num_rows for p in pathlib.Path(f"{folder}/b").glob("*.parquet")]
    assert sum(sizes) == 4000
    assert max(sizes) * 2000 < 2 * layout.SORT_BYTES
    assert rows(spark.read.parquet(f"{folder}/b")) == rows(spark.read.parquet(f"{folder}/a"))


def test_cluster_of_an_empty_table(spark, folder):
    spark.createDataFrame([], "customer long, v string").write.parquet(f"{folder}/a")
    layout.cluster(spark, f"{folder}/a", f"{folder}/b", "customer")
    assert spark.read.parquet(f"{folder}/b").count() == 0


def test_cluster_within_partitions(spark, folder):
    many_files(spark, f"{folder}/a")
    layout.cluster(spark, f"{folder}/a", f"{folder}/b", "customer", ["country"])
    found = layout.file_inventory(spark, f"{folder}/b", ["country"])
    assert rows(found.select("country", "n_rows")) == [("IN", 1200), ("US", 2800)]


def test_partition_inventory(spark):
    found = layout.partition_inventory(orders(spark), ["country"])
    assert rows(found) == [(None, 1), ("IN", 2), ("US", 2)]


def test_compaction_in_place_takes_only_folders_of_small_files(spark, folder):
    path = f"{folder}/t"
    schema = "k string, v int"
    for i in range(3):
        spark.createDataFrame([("a", i), (None, i)], schema).coalesce(1).write.mode("append").partitionBy("k").parquet(path)
    spark.createDataFrame([("b", 9)], schema).coalesce(1).write.mode("append").partitionBy("k").parquet(path)
    before = {f for f in spark.read.parquet(path).inputFiles() if "k=b" in f}
    assert layout.compact_small(spark, path, ["k"]) == 2
    found = spark.read.parquet(path)
    assert Counter(tuple(r) for r in found.select("k", "v").collect()) == Counter(
        [("a", 0), ("a", 1), ("a", 2), (None, 0), (None, 1), (None, 2), ("b", 9)]
    )
    files = set(found.inputFiles())
    assert len(files) == 3 and before <= files
    assert layout.compact_small(spark, path, ["k"]) == 0
    assert set(spark.read.parquet(path).inputFiles()) == files
