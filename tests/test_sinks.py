import json
import pathlib
from tidewell.sinks import replace_folder

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tidewell import sinks, sources
from tidewell.operators.layout import file_inventory
from tidewell.plans.warehouse import CUSTOMER_SCHEMA
from tidewell.queries import stored, views
from tidewell.session import fresh_path, path_bytes
from tidewell.sinks import files
from tidewell.sources import read_named, read_path


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(
        [(1, "US", "a"), (2, "US", None), (3, "IN", "c")], "id int, country string, note string"
    )


def test_overwrite_and_append_count(spark, sample, folder):
    assert sinks.overwrite(sample, f"{folder}/t") == 3
    assert sinks.append(sample.limit(2), f"{folder}/t") == 2
    assert read_path(spark, f"{folder}/t").count() == 5
    assert sinks.overwrite(sample, f"{folder}/t") == 3
    assert read_path(spark, f"{folder}/t").count() == 3


def test_counts_of_nothing(spark, sample, folder):
    assert sinks.overwrite(sample.filter("id > 9"), f"{folder}/t") == 0
    assert sinks.overwrite(sample.filter(F.lit(False)), f"{folder}/u") == 0


def test_counts_after_a_shuffle(spark, folder):
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sinks.overwrite(grouped, f"{folder}/t") == 7


def test_append_with_new_column(spark, sample, folder):
    sinks.append(sample, f"{folder}/t")
    sinks.append(sample.withColumn("extra", F.lit("x")), f"{folder}/t")
    found = read_path(spark, f"{folder}/t", merge_schema=True)
    assert "extra" in found.columns
    assert found.filter("extra IS NULL").count() == 3


def test_partitioned_write_prunes(spark, sample, folder):
    path = f"{folder}/t"
    assert sinks.overwrite_partitioned(sample, path, ["country", "note"]) == 3
    assert sorted(p.name for p in pathlib.Path(path).iterdir() if p.is_dir()) == [
        "country=IN",
        "country=US",
    ]
    pruned = spark.read.parquet(path).filter("country = 'US'")
    assert "PartitionFilters: [isnotnull(country" in plan(pruned)
    assert pruned.count() == 2
    per_country = file_inventory(spark, path, ["country"])
    assert rows(per_country.select("country", "n_files", "n_rows")) == [("IN", 1, 1), ("US", 2, 2)]


def test_split_in_one_write(spark, sample, folder):
    flagged = sample.withColumn("ok", F.col("id") < 3)
    assert sinks.write_split(flagged, f"{folder}/t", "ok") == {"n_good": 2, "n_bad": 1}
    good, bad = sinks.read_split(flagged, f"{folder}/t", "ok")
    assert rows(good.select("id")) == [(1,), (2,)]
    assert rows(bad.select("id")) == [(3,)]
    all_good = sample.withColumn("ok", F.lit(True))
    assert sinks.write_split(all_good, f"{folder}/t", "ok") == {"n_good": 3, "n_bad": 0}
    assert sinks.read_split(all_good, f"{folder}/t", "ok")[1].count() == 0


def test_json_records(spark, sample, folder):
    dated = sample.withColumn("day", F.lit("2025-01-02").cast("date"))
    assert sinks.write_json_records(dated, f"{folder}/j") == 3
    lines = [
        json.loads(line)
        for part in pathlib.Path(f"{folder}/j").glob("part-*")
        for line in part.read_text().splitlines()
    ]
    assert {"id": 2, "country": "US", "note": None, "day": "2025-01-02"} in lines


def test_json_records_compressed(spark, folder, monkeypatch):
    """Fewer bytes, the same records; no file is larger than a task should read."""
    monkeypatch.setattr(files, "PACKED_ROWS", 300)
    wide = spark.range(1000).select("id", F.when(F.col("id") > 1, F.lit("x" * 50)).alias("note")).coalesce(1)
    assert sinks.write_json_records(wide, f"{folder}/plain") == 1000
    assert sinks.write_json_records(wide, f"{folder}/packed", compression="snappy") == 1000
    assert path_bytes(spark, f"{folder}/packed") < path_bytes(spark, f"{folder}/plain") / 2
    parts = list(pathlib.Path(f"{folder}/packed").glob("part-*"))
    assert len(parts) == 4 and all(p.name.endswith(".json.snappy") for p in parts)
    assert rows(sources.read_json_lines(spark, f"{folder}/packed", wide.schema)) == rows(wide)


def test_staging_query_lands_compressed_orders(spark, monkeypatch):
    """Both days' orders are written and loaded; their lines take less room than uncompressed ones."""
    made = []

    def noted(*args):
        made.append(fresh_path(*args))
        return made[-1]

    monkeypatch.setattr(stored, "fresh_path", noted)
    small = "/root/testdata/sf0.001"
    stored.stored_staging_reloaded(spark, small)
    plain = fresh_path(spark, "plain")
    n_rows = sinks.write_json_records(views.staged_orders(spark, small), plain)
    landing, base = made
    for day in ("20240105", "20240106"):
        assert path_bytes(spark, f"{landing}/orders/orders_{day}.json") < path_bytes(spark, plain) / 2
    assert spark.read.parquet(f"{base}/stg_orders").count() == n_rows > 0


def test_csv_has_header(spark, sample, folder):
    assert sinks.write_csv(sample, f"{folder}/c") == 3
    again = spark.read.option("header", True).csv(f"{folder}/c")
    assert again.columns == sample.columns and again.count() == 3


def test_write_only_if_any(spark, sample, folder):
    assert not sinks.write_if_any(sample.filter("id > 9"), f"{folder}/none")
    assert not pathlib.Path(f"{folder}/none").exists()
    assert sinks.write_if_any(sample, f"{folder}/some")


def test_catalog(spark, sample, folder):
    sinks.ensure_database(spark, "shop_test")
    sinks.ensure_database(spark, "shop_test")
    sinks.use_database(spark, "shop_test")
    try:
        assert rows(sinks.current_namespace(spark)) == [("spark_catalog", "shop_test")]
        sinks.save_managed(sample, "sample")
        sinks.save_managed(sample.limit(1), "sample")
        assert read_named(spark, "sample").count() == 1
        sinks.ensure_named_table(spark, "declared", CUSTOMER_SCHEMA)
        sinks.ensure_named_table(spark, "declared", CUSTOMER_SCHEMA)
        assert read_named(spark, "declared").schema == CUSTOMER_SCHEMA
        sinks.overwrite_partitioned(sample, f"{folder}/ext", ["country"])
        sinks.register_folder(spark, "ext", f"{folder}/ext", ["country"])
        assert read_named(spark, "ext").count() == 3
        assert rows(sinks.list_partitions(spark, "ext")) == [("country=IN",), ("country=US",)]
        for name in ("sample", "ext", "ext"):
            sinks.drop_table(spark, name)
        assert spark.catalog.listTables() == [] or not spark.catalog.tableExists("sample")
    finally:
        sinks.use_database(spark, "default")
        spark.sql("DROP DATABASE shop_test CASCADE")


def test_failed_replacement_leaves_the_old_rows(spark, folder):
    path = f"{folder}/dimension"
    assert replace_folder(spark.range(3), path) == 3
    broken = spark.range(2).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        replace_folder(broken, path)
    assert spark.read.parquet(path).count() == 3 and len(list(pathlib.Path(folder).iterdir())) == 1
    assert replace_folder(spark.read.parquet(path).filter("id > 0"), path) == 2  # reads what it replaces
