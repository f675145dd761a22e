"""Queries that write a table, change its files and read it back.

Each works in a folder of its own below the shared working folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import sinks, sources
from tidewell.operators import layout, quality, stored
from tidewell.operators.audit import AuditLog
from tidewell.plans import sales as sales_plan
from tidewell.plans import warehouse
from tidewell.queries import views
from tidewell.queries.register import query
from tidewell.queries.steps import COUNTRY
from tidewell.session import fresh_path, materialize

_PARTITIONS = ["country", "status"]

_CUSTOMER_LINE = (
    T.StructType()
    .add("c_custkey", "long")
    .add("c_name", "string")
    .add("c_acctbal", "double")
)
_ORDER_LINE = (
    T.StructType()
    .add("order_id", "string")
    .add("order_timestamp", "timestamp_ntz")
    .add("customer_id", "long")
    .add("product_id", "long")
    .add("quantity", "integer")
    .add("total_amount", "decimal(18,2)")
    .add("currency", "string")
    .add("status", "string")
)


@query
def stored_csv_strings(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    customers = views.table(spark, folder, "customer")
    sinks.write_csv(customers.select("c_custkey", "c_name", "c_mktsegment"), path)
    return sources.read_csv_strings(spark, path)


@query
def stored_csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    orders = views.table(spark, folder, "orders")
    day = F.to_date("o_orderdate").alias("day")
    sinks.write_csv(orders.select("o_orderkey", "o_orderstatus", "o_totalprice", day), path)
    inferred = sources.read_csv_with_date(spark, path, "day")
    # How wide an integer is inferred depends on the largest key.
    return inferred.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


def _customer_lines(spark: SparkSession, folder: str) -> str:
    """Padded fields; every tenth line has a field too many; headers of other words than the columns."""
    path = fresh_path(spark, "lines")
    line = F.concat_ws(
        ",",
        F.col("c_custkey"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")),
        F.col("c_acctbal"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit("surplus")),
    )
    customers = views.table(spark, folder, "customer").select(line.alias("value"))
    customers.withColumnRenamed("value", "Customer, by line").write.options(
        header=True, quote="", sep="\x01", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


@query
def stored_csv_positional(spark: SparkSession, folder: str) -> DataFrame:
    return sources.read_csv_positional(spark, _customer_lines(spark, folder), _CUSTOMER_LINE)


@query
def stored_csv_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return sources.rejected_lines(spark, _customer_lines(spark, folder), _CUSTOMER_LINE)


@query
def stored_json_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "json")
    sinks.write_json_records(views.staged_orders(spark, folder), path)
    return sources.read_json_lines(spark, path, _ORDER_LINE)


@query
def stored_bronze_appended(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "bronze")
    for _ in range(2):
        sinks.append(sales_plan.bronze(views.sales(spark, folder)), path)
    return sources.read_path(spark, path).drop("ingestion_timestamp")


@query
def stored_new_columns(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "evolved")
    orders = views.table(spark, folder, "orders")
    odd = orders.filter(F.col("o_orderkey") % 2 != 0)
    even = orders.filter(F.col("o_orderkey") % 2 == 0)
    sinks.append(odd.select("o_orderkey", "o_orderstatus"), path)
    sinks.append(even.select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return sources.read_path(spark, path, merge_schema=True)


def _partitioned(spark: SparkSession, folder: str) -> str:
    path = fresh_path(spark, "partitioned")
    sinks.overwrite_partitioned(views.order_book(spark, folder), path, _PARTITIONS)
    return path


@query
def stored_partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    table = sources.read_path(spark, _partitioned(spark, folder))
    return table.filter((F.col("country") == COUNTRY) & (F.col("status") == "O"))


@query
def stored_partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = layout.file_inventory(spark, _partitioned(spark, folder), _PARTITIONS)
    return found.select(*_PARTITIONS, "n_rows")


@query
def stored_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "judged")
    judged = sales_plan.judged(views.sales(spark, folder), views.valid_stores(spark, folder))
    sinks.write_split(judged, path, "is_valid")
    return sinks.read_split(judged, path, "is_valid")[1]


@query
def stored_compacted(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "compacted")
    layout.compact(spark, _partitioned(spark, folder), target, _PARTITIONS)
    return sources.read_path(spark, target)


@query
def stored_small_files_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Folders of many files, rewritten in place."""
    path = fresh_path(spark, "small_files")
    spread = views.order_book(spark, folder).repartition(4, "order_id")
    spread.write.partitionBy(*_PARTITIONS).parquet(path)
    layout.compact_small(spark, path, _PARTITIONS)
    return sources.read_path(spark, path)


@query
def stored_clustered(spark: SparkSession, folder: str) -> DataFrame:
    source, target = fresh_path(spark, "source"), fresh_path(spark, "clustered")
    sinks.overwrite(views.order_book(spark, folder), source)
    layout.cluster(spark, source, target, "customer_id")
    return sources.read_path(spark, target)


@query
def stored_merge(spark: SparkSession, folder: str) -> DataFrame:
    """One country's orders are partly changed and partly new; only its partition is rewritten."""
    book, path = views.order_book(spark, folder), fresh_path(spark, "merged")
    sinks.overwrite_partitioned(book, path, ["country"])
    changed = book.filter((F.col("order_id") % 5 == 0) & (F.col("country") == COUNTRY)).withColumn(
        "amount", F.col("amount") * 2
    )
    added = changed.withColumn("order_id", -1 - F.col("order_id"))
    stored.merge_stored(changed.unionByName(added), path, ["order_id"], ["country"], book.schema)
    return stored.read_stored(spark, path, book.schema)


@query
def stored_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A table updated and cut down in place, partition by partition."""
    book, path = views.order_book(spark, folder), fresh_path(spark, "changed")
    sinks.overwrite_partitioned(book, path, _PARTITIONS)
    paid = (F.col("country") == COUNTRY) & (F.col("customer_id") % 2 == 0)
    stored.update_stored(spark, path, _PARTITIONS, paid, {"amount": F.col("amount") + 1}, book.schema)
    stored.delete_stored(spark, path, _PARTITIONS, F.col("amount") < 5000, book.schema)
    return stored.read_stored(spark, path, book.schema)


@query
def audit_trail(spark: SparkSession, folder: str) -> DataFrame:
    """The log of judging all sales: start, valid rows, rejected rows."""
    log = AuditLog(spark, fresh_path(spark, "log"))

    def work() -> dict[str, int]:
        judged = sales_plan.judged(views.sales(spark, folder), views.valid_stores(spark, folder))
        counts = sinks.write_split(judged, fresh_path(spark, "judged"), "is_valid")
        return {"n_rows": counts["n_good"], "n_rejected": counts["n_bad"]}

    log.step("silver", "silver_processing", work)
    return log.read().select(
        "pipeline_layer", "event_type", "record_count", "status", "error_message"
    )


@query
def run_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Of a load and its log: rows, rows without a time, distinct load times or run ids."""
    path, log = fresh_path(spark, "bronze"), AuditLog(spark, fresh_path(spark, "log"))
    received = sales_plan.bronze(views.sales(spark, folder))
    log.step("bronze", "bronze_ingestion", lambda: {"n_rows": sinks.append(received, path)})

    def properties(name: str, rows: DataFrame, time: str, mark: str) -> DataFrame:
        return rows.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(time).isNull()).alias("n_without_time"),
            F.count_distinct(mark).alias("n_marks"),
        ).withColumn("table", F.lit(name))

    when = "ingestion_timestamp"
    load = properties("bronze", sources.read_path(spark, path), when, when)
    return load.unionByName(properties("log", log.read(), "event_timestamp", "run_id"))


def _arrivals(received: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sales received first, and later ones, partly of the same transactions."""
    key = F.col(sales_plan.KEY)
    later = received.filter(key % 3 != 0).withColumn("discount", F.col("discount") * 2)
    return received.filter(key % 2 == 0), later


@query
def stored_silver_merged(spark: SparkSession, folder: str) -> DataFrame:
    """A first batch of sales becomes the silver table, a second one is merged into it."""
    path, log = fresh_path(spark, "silver"), AuditLog(spark, fresh_path(spark, "log"))
    for batch in _arrivals(views.sales(spark, folder)):
        valid = sales_plan.silver_valid(batch, views.valid_stores(spark, folder))
        sales_plan.run_merge(spark, path, valid, log)
    return sales_plan.read_merged(spark, path)


@query
def stored_silver_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrivals in bronze, each judged and merged by a run that reads only what is new."""
    base = fresh_path(spark, "sales")
    log, stores = AuditLog(spark, f"{base}/log"), views.valid_stores(spark, folder)
    for arrived in _arrivals(views.sales(spark, folder)):
        sinks.append(sales_plan.bronze(arrived), f"{base}/bronze/sales")
        sales_plan.run_increment(spark, stores, base, log)
    return sales_plan.read_merged(spark, f"{base}/silver/sales").drop("ingestion_timestamp", "source_system")


def _named(spark: SparkSession) -> str:
    sinks.ensure_database(spark, "tidewell_queries")
    return f"tidewell_queries.t_{uuid.uuid4().hex}"


@query
def stored_managed_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table declared empty, replaced by rows, read by its name."""
    name, orders = _named(spark), views.order_book(spark, folder)
    sinks.ensure_named_table(spark, name, orders.schema)
    try:
        sinks.save_managed(orders, name)
        return materialize(sources.read_named(spark, name), "managed")
    finally:
        sinks.drop_table(spark, name)


@query
def stored_registered_folder(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned folder that is given a name, read by it."""
    name = _named(spark)
    sinks.register_folder(spark, name, _partitioned(spark, folder), _PARTITIONS)
    try:
        return materialize(sources.read_named(spark, name), "registered")
    finally:
        sinks.drop_table(spark, name)


@query
def stored_staging_reloaded(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of the second of two days, each loaded from its dated files."""
    landing, base = fresh_path(spark, "landing"), fresh_path(spark, "staging")
    customers = views.customers(spark, folder).select(
        "customer_id",
        F.col("name").alias("first_name"),
        F.lit("x").alias("last_name"),
        F.concat("customer_id", F.lit("@x.org")).alias("email"),
        F.lit("2024-01-05").alias("signup_date"),
        "country",
    )
    for day, rows in (("2024-01-05", customers), ("2024-01-06", customers.filter("customer_id % 2 = 1"))):
        sinks.write_csv(rows, sources.dated_path(landing, "customers", day, "csv"))
        products = sources.dated_path(landing, "products", day, "csv")
        sinks.write_csv(views.catalogue(spark, folder), products)
        orders = sources.dated_path(landing, "orders", day, "json")
        sinks.write_json_records(views.staged_orders(spark, folder), orders, compression="snappy")
        warehouse.load_staging(spark, landing, base, day)
    return sources.read_path(spark, f"{base}/stg_customers")


@query
def stored_low_volume_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary as its file holds it; no file where no day is low."""
    path = fresh_path(spark, "summary")
    days = views.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    summary = quality.low_volume_days(days, "day", threshold=3)
    written = sinks.write_if_any(summary, path)
    return spark.read.schema(summary.schema).json(path) if written else summary.filter("false")
